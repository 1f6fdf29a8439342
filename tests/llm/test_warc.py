import base64
import gzip
import hashlib
import random
import re

from terracask.llm import warc

from .conftest import write

PAGES = "page_id bigint, url string, html string"


def record(i, payload=b"<p>payload</p>", **more):
    return warc.encode_record(i, f"http://x/{i}", payload, hashlib.sha256(payload).hexdigest(), **more)


def ids(data):
    return [r["page_id"] for r in warc.salvage(data) if r["status"] == "record"]


def gaps(data):
    return [(r["start"], r["length"]) for r in warc.salvage(data) if r["status"] == "gap"]


def test_whole_archives_have_no_gaps():
    plain = b"".join(record(i) for i in range(4))
    packed = b"\0".join(gzip.compress(record(i)) for i in range(4)) + b"\0\0"
    mixed = gzip.compress(record(0)) + record(1) + gzip.compress(record(2, refers_to=0))
    assert ids(plain) == ids(packed) == [0, 1, 2, 3] and ids(mixed) == [0, 1, 2]
    assert not gaps(plain) and not gaps(packed) and not gaps(mixed) and not list(warc.salvage(b""))


def test_damage_costs_only_what_it_hits():
    members = [gzip.compress(record(i, b"<p>%d</p>" % i * 50)) for i in range(5)]
    at = len(members[0]) + len(members[1])
    bad = bytearray(b"".join(members))
    bad[at + 25] ^= 0xFF
    assert ids(bytes(bad)) == [0, 1, 3, 4] and gaps(bytes(bad)) == [(at, len(members[2]))]
    cut = b"".join(members)[: -len(members[4]) // 2]
    assert ids(cut) == [0, 1, 2, 3] and len(gaps(cut)) == 1
    junk = b"junk" + members[0] + b"WARC/1.1\r\nno: end" + record(1) + b"\x1f\x8b\x08tail"
    assert ids(junk) == [0, 1] and [g[0] for g in gaps(junk)] == [0, 4 + len(members[0]), len(junk) - 7]


def test_checks_of_plain_records():
    good = record(1)
    for bad in (good.replace(b"payload</p>", b"PAYLOAD</p>"), good.replace(b"Content-Length: 1", b"Content-Length: 2", 1), good.replace(b"sha256:", b"sha256:0"), good[:-3], b"WARC/9" + good[6:]):
        assert ids(bad + record(2)) == [2] and gaps(bad + record(2)) == [(0, len(bad))]


def test_random_damage_never_yields_a_wrong_payload():
    draw = random.Random(8)
    payloads = {i: bytes(draw.randrange(256) for _ in range(200)) for i in range(6)}
    whole = b"".join(gzip.compress(record(i, p)) for i, p in payloads.items())
    for _ in range(60):
        bad = bytearray(whole)
        for _ in range(3):
            bad[draw.randrange(len(bad))] = draw.randrange(256)
        rows = list(warc.salvage(bytes(bad)))
        assert sum(r["length"] for r in rows) == len(bad)
        for r in rows:
            if r["status"] == "record":
                assert r["payload"] == payloads[r["page_id"]]


def test_query_on_odd_rows(spark, tmp_path):
    big = "é" * 300_000
    rows = [(5, "u", big), (3, "u", big), (9, None, big), (1, "a\r\nb", "short"), (2, "c", "short"), (4, "d", None), (6, "e", ""), (None, "f", big), (3, "u", big), (7, "g", "x" * 100), (8, "h", "x" * 100), (10, "h", "x" * 99), (11, "h", "x" * 99)]
    got = warc.op10_warc_salvage(spark, write(spark, tmp_path, pages=spark.createDataFrame(rows, PAGES))).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[3]["record_type"] == "response" and by[5]["refers_to"] == by[9]["refers_to"] == by[None]["refers_to"] == 3
    assert by[2]["record_type"] == by[4]["record_type"] == by[11]["record_type"] == "response" and by[8]["refers_to"] == 7
    for i, _, html in rows:
        payload = (html or "").encode()
        assert by[i]["payload_bytes"] == len(payload) and by[i]["payload_digest"] == hashlib.sha256(payload).hexdigest()


def test_files_urls_and_gaps_through_spark(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://h/{i}\n", f"<p>{i}</p>", "clash") for i in range(25)], PAGES + ", digest string")
    warc.write_archives(df.coalesce(1), str(tmp_path / "w"), file_bytes=3000)
    files = sorted((tmp_path / "w").glob("part-*"))
    assert len(files) >= 3 and all(f.name.endswith(".warc.gz") and f.stat().st_size <= 3000 for f in files)
    texts = [gzip.decompress(f.read_bytes()) for f in files]  # nothing but gzip members
    assert all(t.startswith(b"WARC/1.1\r\n") and t.endswith(b"\r\n\r\n") for t in texts)
    named = re.findall(rb"WARC-Record-ID: (\S+)", b"".join(texts))
    assert len(set(named)) == len(named) == 25
    rows = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert {r["page_id"]: bytes(r["payload"]) for r in rows} == {i: b"<p>%d</p>" % i for i in range(25)}
    assert all(r["url"].endswith("%0A") for r in rows)
    (tmp_path / "d").mkdir()
    data = files[0].read_bytes()
    (tmp_path / "d" / "one.warc.gz").write_bytes(data[:40] + bytes([data[40] ^ 255]) + data[41:])
    kinds = [r["status"] for r in warc.read_archives(spark, str(tmp_path / "d")).collect()]
    assert kinds[0] == "gap" and set(kinds[1:]) == {"record"}


def test_drill_is_quarantined_and_repeated_rows_have_ids_of_their_own(spark, tmp_path):
    df = spark.createDataFrame([(i % 40, "u", f"<p>{i % 40}</p>" * 30) for i in range(80)] + [(None, None, None)] * 2, PAGES)
    warc.write_archives(df, str(tmp_path / "w"), drill=10)
    rows = warc.read_archives(spark, str(tmp_path / "w")).collect()
    records, gaps_ = [r for r in rows if r["status"] == "record"], [r for r in rows if r["status"] == "gap"]
    assert len(records) == 82 == len({r["record_id"] for r in records}) and len(gaps_) == 8 and all(r["reason"] and r["length"] > 0 for r in gaps_)
    assert {r["page_id"] for r in records if r["gap_before"]} == {0, 10, 20, 30}


def test_records_of_other_writers():
    def other(kind, block, **fields):
        lines = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in fields.items())
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    body = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>hi</p>"
    sha1 = base64.b32encode(hashlib.sha1(b"<p>hi</p>").digest()).decode()
    http = "application/http; msgtype=response"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n2\r\nhi\r\n0\r\n\r\n"
    good = [
        other("warcinfo", b"software: x\r\n"),
        other("response", body, Content_Type=http, WARC_Payload_Digest=f"sha1:{sha1}", WARC_Block_Digest="blake9:ABC"),
        other("request", b"GET / HTTP/1.1\r\n\r\n", Content_Type="application/http; msgtype=request"),
        other("metadata", b""),
        other("resource", b"raw", WARC_Payload_Digest="md5:" + hashlib.md5(b"raw").hexdigest()),
        other("response", chunked, Content_Type=http, WARC_Payload_Digest=f"sha1:{sha1}"),
    ]
    kinds = ["warcinfo", "response", "request", "metadata", "resource", "response"]
    wrong = other("response", body, Content_Type=http, WARC_Payload_Digest=f"sha1:{sha1[::-1]}")
    for whole in (b"".join(good), gzip.compress(b"".join(good)), b"".join(map(gzip.compress, good))):
        rows = list(warc.salvage(whole))
        assert [r["record_type"] for r in rows] == kinds and rows[1]["payload"] == b"<p>hi</p>"
    rows = list(warc.salvage(gzip.compress(good[0] + wrong + good[2]) + gzip.compress(good[3])))
    assert [r.get("record_type") for r in rows] == ["warcinfo", None, "request", "metadata"] and "digest" in rows[1]["reason"]


def test_large_records_end_members_too(monkeypatch):
    payload = random.Random(1).randbytes(17_000_000)
    member = warc._member(record(1, payload))
    assert member[-1] == 0 and gzip.decompress(member) == record(1, payload)
    rows = list(warc.salvage(member + warc._member(record(2))))
    assert [r["page_id"] for r in rows] == [1, 2] and rows[0]["payload"] == payload and sum(r["length"] for r in rows) < len(member) * 2
    monkeypatch.setattr(warc, "MOST_BYTES", 1000)
    assert [r["status"] for r in warc.salvage(gzip.compress(record(1, b"0" * 5000)) + gzip.compress(record(2)))] == ["gap", "record"]


def test_empty_table(spark, tmp_path):
    assert warc.op10_warc_salvage(spark, write(spark, tmp_path, pages=spark.createDataFrame([], PAGES))).count() == 0
