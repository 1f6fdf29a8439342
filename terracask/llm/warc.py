"""Operator 10: WARC archives, written with revisits and read back by a salvage reader.

Writer: each page becomes a gzip member of its own that holds one WARC/1.1 record, and a file
is nothing but such members, one after another, ``.warc.gz``. Tasks put members together to
about ``FILE_BYTES`` and hand each such run to Spark's text sink as one line of a file of its
own, so archives land wherever Spark can write. The sink ends a line with a separator, here a
NUL byte; as a member ends with its length, whose last byte is 0 below 16 MB, the separator is
that byte (after a larger record comes an empty member for it). Of records with equal payloads
of at least ``MIN_BYTES`` bytes the one with the smallest id is a response and the others are
revisits that refer to it. Record ids are unique; pages are named in a field of their own.

Salvage reader: goes through a file record by record. A record counts if its gzip member is
whole (checksum and length), its header block parses, its block has the stated length, and
block and payload agree with what the header states of them: digests by SHA-256, SHA-1 or MD5
(hexadecimal or base 32), the HTTP header's content length. Records of all types are read, in
members of one or several or plain. After a failed check the reader searches for the next gzip
magic or ``WARC/`` version line that begins a valid record, goes on there, and logs the bytes
between as a quarantined gap.

Memory: a file is read as one row of about ``FILE_BYTES``, or of one record if that is larger;
a record may inflate to ``MOST_BYTES``, the limit of a cell, and is a gap beyond.

Defined cases: null payload is empty; a null id is left out of the header and read back as
null; rows that share digest and smallest id are all responses, rows with a null id are revisits
of their payload's smallest id if there is one; CR and LF in a URL are percent-encoded in the
header; an empty table gives no records and no gaps; other columns are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shared_path, table, write_table

MIN_BYTES = 100
#: Bytes of a file, but for one larger record; and of an inflated record at most.
FILE_BYTES = 1 << 26
MOST_BYTES = (1 << 31) - 1
#: Bytes fed to the decompressor at a time.
CHUNK = 1 << 14
DATE = "2024-01-01T00:00:00Z"
GZIP_MAGIC = b"\x1f\x8b\x08"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE, REFERS_TO = "X-Page-ID", "X-Refers-To-Page-ID"
#: Repeated digests up to which the table of revisits is broadcast (some 10 MB); beyond it, a shuffled join.
BROADCAST_DIGESTS = 100_000

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("gap_before", T.BooleanType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


# ------------------------------------------------------------------- one record


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None = None, record_id: str | None = None, refers_url: str | None = None) -> bytes:
    """One WARC record, a response or (with ``refers_to``) a revisit, uncompressed."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{record_id or uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _line(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        fields.append((PAGE, str(page_id)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To-Target-URI", _line(refers_url)), ("WARC-Refers-To-Date", DATE), (REFERS_TO, str(refers_to))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _line(url: str | None) -> str:
    return (url or "").replace("\r", "%0D").replace("\n", "%0A")


class Damaged(ValueError):
    """A record that fails one of the reader's checks."""


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d{1,19}", text) else None


def _agrees(stated: str | None, data: bytes) -> bool:
    """Whether a digest field is right; what names no known algorithm or form can't be wrong."""
    name, _, value = (stated or "").partition(":")
    kind = {"sha256": hashlib.sha256, "sha1": hashlib.sha1, "md5": hashlib.md5}.get(name.strip().lower().replace("-", ""))
    if kind is None or not value.isalnum():
        return True
    found = kind(data)
    if len(value) == 2 * found.digest_size:
        return value.lower() == found.hexdigest()
    return value.upper() == base64.b32encode(found.digest()).decode().rstrip("=")


def _http(block: bytes) -> tuple[bytes, dict[bytes, bytes]] | None:
    """Payload and fields of an HTTP message, if the block is one."""
    end = block.find(b"\r\n\r\n")
    if end < 0 or not block.startswith(b"HTTP/"):
        return None
    lines = (line.partition(b":") for line in block[:end].split(b"\r\n")[1:])
    return block[end + 4 :], {k.strip().lower(): v.strip() for k, _, v in lines}


def decode_record(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The plain record that begins at ``at``, checked, and where it ends."""
    if not VERSION_LINE.match(data, at):
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Damaged("header block without end")
    if VERSION_LINE.search(data, at + 1, end + 2):
        raise Damaged("version line within a header block")
    head = {}
    try:
        for line in data[at:end].decode().split("\r\n")[1:]:
            name, mark, value = line.partition(":")
            if not mark:
                raise Damaged("header line without colon")
            head[name.strip().lower()] = value.strip()
    except UnicodeDecodeError as e:
        raise Damaged("header block is not UTF-8") from e
    size = head.get("content-length", "")
    if not size.isdigit():
        raise Damaged("no content length")
    stop = end + 4 + int(size)
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise Damaged("content length does not lead to a record end")
    block = data[end + 4 : stop]
    kind = head.get("warc-type")
    message = _http(block) if head.get("content-type", "").lower().startswith("application/http") else None
    payload, http = message or (block, {})
    stated = http.get(b"content-length", b"")
    whole = not http.get(b"transfer-encoding") and "warc-truncated" not in head  # else lengths and digests are of something else
    if not _agrees(head.get("warc-block-digest"), block):
        raise Damaged("block digest is wrong")
    if kind != "revisit" and whole and (not _agrees(head.get("warc-payload-digest"), payload) or (stated.isdigit() and int(stated) != len(payload))):
        raise Damaged("payload digest or length is wrong")
    row = {
        "record_type": kind,
        "record_id": head.get("warc-record-id"),
        "page_id": _number(head.get(PAGE.lower())),
        "url": head.get("warc-target-uri"),
        "refers_to": _number(head.get(REFERS_TO.lower())),
        "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        "payload_bytes": int(stated) if kind == "revisit" and stated.isdigit() else len(payload),
        "payload": payload if kind != "revisit" else None,
    }
    return row, stop + 4


# ---------------------------------------------------------------------- salvage


def _inflated(data: bytes, at: int) -> tuple[bytes, int]:
    """The gzip member at ``at``, checked, and where it ends."""
    engine = zlib.decompressobj(wbits=31)  # one member only; checks CRC-32 and length
    parts, end_at, held = [], at, 0
    try:
        while not engine.eof:
            fed = engine.unconsumed_tail
            if not fed:
                fed = data[end_at : end_at + CHUNK]
                end_at += len(fed)
            part = engine.decompress(fed, 1 << 24)
            if not fed and not part and not engine.eof:
                raise Damaged("gzip member is cut off")
            held += len(part)
            if held > MOST_BYTES:
                raise Damaged("gzip member inflates beyond a cell")
            parts.append(part)
    except zlib.error as e:
        raise Damaged(f"gzip member: {e}") from e
    return b"".join(parts), end_at - len(engine.unused_data)


def _decode_at(data: bytes, at: int) -> tuple[list[dict], int]:
    """The records at ``at``, a plain one or all those of a gzip member with the gaps between them,
    and where they end."""
    if not data.startswith(GZIP_MAGIC, at):
        row, end = decode_record(data, at)
        return [row], end
    plain, end = _inflated(data, at)
    rows = list(salvage(plain))
    if rows and all(r["status"] == "gap" for r in rows):
        raise Damaged(rows[0]["reason"])
    return rows, end


def _next_start(data: bytes, at: int) -> int:
    """The next place after ``at`` that looks like a member or a version line, or the end."""
    member = data.find(GZIP_MAGIC, at)
    line = VERSION_LINE.search(data, at)
    return min(member if member >= 0 else len(data), line.start() if line else len(data))


def salvage(data: bytes) -> Iterator[dict]:
    """All valid records of an archive, in order, and the gaps between them.

    A gap is a row with status ``gap``, the reason of its first failed check, and no record.
    Padding by NUL bytes between records is no gap. The records of a member share its place, and
    gaps within it count inflated bytes.
    """
    at = gap = 0
    reason = ""
    while True:
        while gap == at and data[at : at + 1] == b"\0":
            at = gap = at + 1
        if at >= len(data):
            break
        try:
            rows, end = _decode_at(data, at)
        except Damaged as e:
            reason = reason or str(e)
            at = _next_start(data, at + 1)
            continue
        after = at > gap
        if after:
            yield {"status": "gap", "reason": reason, "start": gap, "length": at - gap}
        for row in rows:
            if row.get("status") == "gap":
                yield row | {"start": at, "reason": f"within a member: {row['reason']}"}
                continue
            yield row | {"status": "record", "reason": None, "start": at, "length": end - at, "gap_before": after or row.get("gap_before", False)}
            after = False
        at = gap = end
        reason = ""
    if len(data) > gap:
        yield {"status": "gap", "reason": reason or "no record", "start": gap, "length": len(data) - gap}


# ----------------------------------------------------------------------- Spark


def plan_revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to, refers_url) from (page_id, url, html); ``refers_to``
    is null for a response.

    The smallest ids come from a small aggregate over the digests that occur more than once.
    Payloads stay where they are unless these digests are too many for a broadcast.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    hashed = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = hashed.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("page_id").isNotNull(), F.struct(F.col("page_id").alias("first"), F.col("url").alias("refers_url")))).alias("m")
    )
    repeated, _ = write_table(pages.sparkSession, large.where("n > 1 AND m IS NOT NULL").select("digest", "m.first", "m.refers_url"), "digests")
    few = repeated.count() <= BROADCAST_DIGESTS
    joined = hashed.join(F.broadcast(repeated) if few else repeated, "digest", "left")
    revisit = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    return joined.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to"), F.when(revisit, F.col("refers_url")).alias("refers_url"))


def _member(record: bytes) -> bytes:
    """The record as a gzip member that ends with a NUL byte (behind it an empty member, if need be)."""
    member = gzip.compress(record, 6, mtime=0)
    return member if member[-1] == 0 else member + gzip.compress(b"", 6, mtime=0)


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, file_bytes: int = FILE_BYTES, drill: int = 0) -> None:
    """Writes (page_id, url, html) as ``.warc.gz`` files below ``path``.

    ``drill``: pages whose id it divides get a broken copy of their record in front, cut short
    and with a flipped byte, to exercise the reader.
    """

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, at = TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        size = 0
        for b in batches:
            for page, url, payload, digest, refers, refers_url in zip(*(b[c].tolist() for c in ("page_id", "url", "payload", "digest", "refers_to", "refers_url"))):
                page, refers = (None if pd.isna(x) else int(x) for x in (page, refers))
                record_id = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{task} {at} {page} {digest}"))
                at += 1
                member = _member(encode_record(page, url, payload, digest, refers, record_id, refers_url))
                if drill and page is not None and page % drill == 0:
                    broken = bytearray(member[: max(20, 2 * len(member) // 3)])
                    broken[len(broken) // 2] ^= 0xFF
                    member = bytes(broken) + member
                if held and size + len(member) > file_bytes:
                    yield pd.DataFrame({"run": [b"".join(held)[:-1]]})
                    held, size = [], 0
                held.append(member)
                size += len(member)
        if held:
            yield pd.DataFrame({"run": [b"".join(held)[:-1]]})

    planned = plan_revisits(pages, min_bytes).withColumns({c: F.col(c).cast("decimal(20,0)") for c in ("page_id", "refers_to")})
    runs = planned.mapInPandas(encode, "run binary").select(F.col("run").cast("string").alias("value"))
    runs.write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)
    _rename(pages.sparkSession, path)


def _rename(spark: SparkSession, path: str) -> None:
    """Gives the files below ``path`` the ending of archives: a rename per file, no data is moved."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("part-") and name.endswith(".txt"):
            target = jvm.org.apache.hadoop.fs.Path(folder, name.removesuffix(".txt") + ".warc.gz")
            if not files.rename(status.getPath(), target):
                raise OSError(f"could not rename {name}")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of all archives below ``path`` (``RECORD_SCHEMA``)."""
    names = RECORD_SCHEMA.names

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, content in zip(b["path"], b["content"]):
                rows, held = [], 0
                for row in salvage(bytes(content)):
                    rows.append([file if n == "file" else row.get(n) for n in names])
                    held += len(row.get("payload") or b"") + 500
                    if held > 1 << 24:
                        yield _frame(rows)
                        rows, held = [], 0
                if rows:
                    yield _frame(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(read, RECORD_SCHEMA)


def _frame(rows: list[list]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=RECORD_SCHEMA.names, dtype=object)
    longs = [f.name for f in RECORD_SCHEMA if isinstance(f.dataType, T.LongType)]
    return frame.astype({c: "Int64" for c in longs})


#: The query's drill: about one page in so many gets a broken record in front of it.
DRILL = 97


def op10_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives, some broken records among them, and read back; ``gap_before``
    tells that the reader had to quarantine bytes in front of a record."""
    path = shared_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path, drill=DRILL)
    records = read_archives(spark, path).where("status = 'record'")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "gap_before")


OP10_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p),
r AS (SELECT *, n >= {MIN_BYTES} AND first IS NOT NULL AND (page_id IS NULL OR page_id > first) AS revisit FROM f)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN revisit THEN first END AS refers_to, coalesce(page_id % {DRILL} = 0, false) AS gap_before
FROM r
"""

QUERIES = {"op10_warc_salvage": op10_warc_salvage}
SQL = {"op10_warc_salvage": OP10_SQL}
