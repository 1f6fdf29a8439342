import hashlib
from collections import Counter

from pyspark.sql import functions as F

from terracask.llm import common
from terracask.llm import fingerprint as fp

from .conftest import write


def prints(make, texts):
    df = fp.fingerprint(make([(i, t, None, None, None) for i, t in enumerate(texts)]))
    return [r["fingerprint"] for r in df.orderBy("doc_id").collect()]


def test_order_independence_and_equality(make):
    a, b, c, empty, null = prints(make, ["x one.\ny two.\nz", "z\nx one.\ny two.", "z\nx one.\ny two.\nz", "", None])
    assert a == b and a != c and empty == null and set(empty) <= set("0-")


def test_insert_and_delete(spark):
    df = spark.createDataFrame([("p, q\nr. s", "new one", "p, q\nr. s\nnew one")], "a string, b string, ab string")
    for name in ("a", "b", "ab"):
        df = fp.with_lanes(df, name, f"{name}_l")
    row = df.select(fp.combine(F.col("a_l"), F.col("b_l")).alias("sum"), "ab_l", fp.combine(F.col("ab_l"), F.col("b_l"), -1).alias("diff"), "a_l").first()
    assert row["sum"] == row["ab_l"] and row["diff"] == row["a_l"]


def test_lanes_against_brute_force(spark):
    text = "alpha, beta. gamma\n\nalpha\ndelta, "
    lanes = fp.with_lanes(spark.createDataFrame([(text,)], "t string"), "t", "l").first()["l"]
    want = [0] * fp.LIKENESS_LANES
    for clause in ("alpha", "beta", "gamma", "alpha", "delta"):
        b = int(hashlib.md5(clause.encode()).hexdigest()[:2], 16) & 127
        want[b // 2] += 1 if b % 2 == 0 else -1
    words = [hashlib.sha256(p.encode()).hexdigest() for p in ("alpha, beta. gamma", "alpha", "delta, ")]
    want = [w % fp.MODULUS for w in want] + [sum(int(h[8 * k : 8 * k + 8], 16) for h in words) % fp.MODULUS for k in range(8)]
    assert lanes == want


def order(rows):
    """(doc_id, text) in the query's order: by id, nulls last, then by the MD5 of the text, descending."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()), reverse=True)


def edits(rows):
    """(doc_id, SHA-256 of the edited text) of each row, by a plain version."""
    rows = order([(i, t or "") for i, t in rows])
    out = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        k = len(t) // 3
        out.append((i, hashlib.sha256((t[: len(t) - k] + after[:k]).encode()).hexdigest()))
    return Counter(out)


def test_query_on_odd_rows(spark, odd_docs, tmp_path):
    rows = fp.op1_document_fingerprints(spark, write(spark, tmp_path, documents=odd_docs)).collect()
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in rows) == edits([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert all(0 <= r[c] <= 1 for r in rows for c in ("near_edited", "near_next"))


def test_hot_ids_and_equal_rows(spark, make, tmp_path, monkeypatch):
    rows = [(7, f"text number {i}. and more") for i in range(300)] + [(9, "the same, again.")] * 200 + [(None, f"none {i % 40}, yes") for i in range(200)] + [(i, f"own {i}") for i in range(20, 90)]
    docs = write(spark, tmp_path, documents=make([(i, t, None, None, None) for i, t in rows]))
    for most in (1 << 16, 15):
        monkeypatch.setattr(common, "COPIES_AT_ONCE", most)
        got = fp.op1_document_fingerprints(spark, docs).collect()
        assert Counter((r["doc_id"], r["edited_sha256"]) for r in got) == edits(rows)
    assert sum(r["near_next"] == 1.0 for r in got if r["doc_id"] == 9) >= 199


def test_likeness_without_clauses(spark):
    df = spark.createDataFrame([(".", ",", "", "\n"), ("", "\n", ".", ".")], "a string, b string, c string, d string")
    for name in "abcd":
        df = fp.with_lanes(df, name, f"{name}_l")
    rows = fp.with_likeness(df, {"ab": ("a_l", "b_l"), "cd": ("c_l", "d_l")}).collect()
    assert [(r["ab"], r["cd"]) for r in rows] == [(0.0, 1.0), (1.0, 1.0)]


def test_empty_table_and_one_row(spark, make, tmp_path):
    assert fp.op1_document_fingerprints(spark, write(spark, tmp_path / "a", documents=make([]))).count() == 0
    row = fp.op1_document_fingerprints(spark, write(spark, tmp_path / "b", documents=make([(1, "abcdef", None, None, None)]))).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and row["near_next"] == 1.0


def test_near_follows_the_edit(spark, make, prose, tmp_path):
    texts = [". ".join(t[i : i + 30] for i in range(0, len(t), 30)) for t in prose]
    rows = fp.op1_document_fingerprints(spark, write(spark, tmp_path, documents=make([(i * 7, t, None, None, None) for i, t in enumerate(texts)]))).collect()
    assert sum(r["near_edited"] for r in rows) / len(rows) > 0.5
