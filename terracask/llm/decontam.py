"""Operator 6: benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by how many distinct word shingles they have, in powers of two.
A document is cut into overlapping windows of shingles, for each partition as long as its
items need (an unbroken copy of an item lies wholly in one window), so that the Jaccard
similarity of item and window stays high enough for MinHash, however long the document
is. A window and an item that agree in any of ``HASHES`` minwise values make a candidate,
which is verified against the item's and the document's full shingle sets: it counts if
the share of the item's distinct shingles that the document has is ``THRESHOLD`` or more.
At the threshold a copy is missed with a probability below 1e-5.

Items of the same words are one class, named by its smallest id and looked for once; the
members are in ``item_classes``. The index holds classes, not documents, and goes to each task.
They are indexed in blocks of at most ``BLOCK_SHINGLES`` words, one block at the driver at a time;
more items mean more passes over the documents, never a larger index.

Defined cases: words are runs of ASCII letters and digits and of all other non-ASCII
characters, A-Z as a-z; an item of fewer than ``WORDS`` words is one shingle of its whole
length and is looked for as such; null or empty items and documents match nothing; ids may
be null or repeated and are returned as they are; other columns are not looked at; an
empty table gives an empty result. ``drop_leaks`` judges each row by its own text, whatever
its id, and carries all columns along.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shingles as S
from .common import ascii_lower, table

WORDS = 5
THRESHOLD = 0.8
HASHES = 64
BLOCK_SHINGLES = 1 << 20
_MULTIPLIERS = S.stream(61, HASHES) | S.U(1)
_OFFSETS = S.stream(62, HASHES)

HIT_SCHEMA = "doc_id bigint, item_id bigint, n_items bigint, n_shingles bigint, shared bigint, containment double"


class Index:
    """A block of item classes (id, members, text): their shingle sets, and minwise values by size class."""

    def __init__(self, items: list[tuple[int | None, int, str | None]], k: int = WORDS):
        texts = pa.array([t for *_, t in items], pa.large_string())
        raw, at = S.text_bytes(texts)
        hashes, word_at = S.words(raw, at, S.ALPHANUMERIC)
        self.ids = [i for i, *_ in items]
        self.members = [n for _, n, _ in items]
        self.words = np.diff(word_at)
        values, offsets = S.distinct(*S.shingles(hashes, word_at, k))
        self.sets = [values[offsets[i] : offsets[i + 1]] for i in range(len(items))]
        self.k = k
        self.short = {int(m): np.flatnonzero(self.words == m) for m in set(self.words[(self.words > 0) & (self.words < k)])}
        self.classes: dict[int, tuple[list[np.ndarray], list[np.ndarray], np.ndarray]] = {}
        full = [i for i in range(len(items)) if self.words[i] >= k]
        for c in sorted({int(len(self.sets[i])).bit_length() - 1 for i in full}):
            members = np.array([i for i in full if int(len(self.sets[i])).bit_length() - 1 == c])
            with np.errstate(over="ignore"):
                minima = np.array([[(self.sets[i] * a + b).min() for i in members] for a, b in zip(_MULTIPLIERS, _OFFSETS)], S.U)
            orders = [np.argsort(m, kind="stable") for m in minima]
            marks = np.zeros((HASHES, 1 << 16), bool)
            for h in range(HASHES):
                marks[h, (minima[h] >> S.U(48)).astype(np.int64)] = True
            self.classes[c] = ([m[o] for m, o in zip(minima, orders)], [members[o] for o in orders], marks)

    def candidates(self, values: np.ndarray, offsets: np.ndarray) -> set[tuple[int, int]]:
        """(row, item) pairs that agree in a minwise value of some window."""
        found: set[tuple[int, int]] = set()
        sizes = np.diff(offsets)
        grids = {c: _blocks(offsets, sizes, 2 << c) for c in self.classes}
        if not len(values):
            return found
        for h in range(HASHES):
            with np.errstate(over="ignore"):
                hashed = values * _MULTIPLIERS[h] + _OFFSETS[h]
            for c, (minima, members, marks) in self.classes.items():
                starts, rows = grids[c]
                low = np.minimum.reduceat(hashed, starts)
                same = rows[1:] == rows[:-1]
                low[:-1] = np.where(same, np.minimum(low[:-1], low[1:]), low[:-1])
                maybe = np.flatnonzero(marks[h, (low >> S.U(48)).astype(np.int64)])
                if not len(maybe):
                    continue
                left = np.searchsorted(minima[h], low[maybe], "left")
                right = np.searchsorted(minima[h], low[maybe], "right")
                for w, a, b in zip(maybe, left, right):
                    found.update((int(rows[w]), int(i)) for i in members[h][a:b])
        return found

    def short_candidates(self, hashes: np.ndarray, word_at: np.ndarray) -> set[tuple[int, int]]:
        found: set[tuple[int, int]] = set()
        for m, members in self.short.items():
            runs = S.sequence_hash(hashes, m)
            wanted = {}
            for i in members:
                wanted.setdefault(self.sets[i][0], []).append(int(i))
            places = np.flatnonzero(np.isin(runs, np.array(list(wanted), S.U)))
            rows = np.searchsorted(word_at, places, "right") - 1
            for p, r in zip(places, rows):
                if p + m <= word_at[r + 1]:
                    found.update((int(r), i) for i in wanted[runs[p]])
        return found


def _blocks(offsets: np.ndarray, sizes: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the rows' blocks of ``stride`` values, and each block's row."""
    counts = -(-sizes // stride)
    rows = np.repeat(np.arange(len(sizes)), counts)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    return offsets[:-1][rows] + (np.arange(len(rows)) - first[rows]) * stride, rows


def _hits(index: Index, threshold: float, column: pa.Array) -> Iterator[tuple[int, int, int]]:
    """(row, item, shared shingles) of the texts that hold an item, verified on full sets."""
    hashes, word_at = S.words(*S.text_bytes(column), S.ALPHANUMERIC)
    values, offsets = S.shingles(hashes, word_at, index.k)
    for r, i in sorted(index.candidates(values, offsets) | index.short_candidates(hashes, word_at)):
        item = index.sets[i]
        shared = 1 if index.words[i] < index.k else int(np.isin(item, values[offsets[r] : offsets[r + 1]]).sum())
        if shared >= threshold * len(item):
            yield r, i, shared


def _search(index: Index, threshold: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in HIT_SCHEMA.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.float64()]
        for whole in batches:
            for batch in S.slices(whole, "text"):
                ids = batch.column("doc_id")
                rows = [(ids[r].as_py(), index.ids[i], index.members[i], len(index.sets[i]), n, n / len(index.sets[i])) for r, i, n in _hits(index, threshold, batch.column("text"))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    return search


def _clean(index: Index, threshold: float, text: str):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in S.slices(whole, text):
                keep = np.ones(batch.num_rows, bool)
                keep[[r for r, *_ in _hits(index, threshold, batch.column(text))]] = False
                if keep.any():
                    yield batch if keep.all() else batch.filter(pa.array(keep))

    return clean


def _words(text: Column) -> Column:
    """A text's words, one space between them."""
    return F.trim(F.regexp_replace(ascii_lower(text), r"[^0-9a-z\x{80}-\x{10FFFF}]+", " "))


def item_classes(benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, class_id, words): each item that has words, and the smallest id of those with the same words."""
    items = benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), _words(F.col(item_text)).alias("words")).where("words <> ''")
    return items.join(items.groupBy("words").agg(F.min("item_id").alias("class_id")), "words").select("item_id", "class_id", "words")


def _blocks_of(benchmark: DataFrame, words: int, block_shingles: int, item_id: str, item_text: str) -> Iterator[Index]:
    """The item classes in blocks of bounded size, as indexes."""
    texts = _words(F.col(item_text)).alias("words")
    classes = benchmark.select(F.col(item_id).cast("bigint").alias("id"), texts).where("words <> ''").groupBy("words").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    size = classes.agg(F.sum(F.length("words"))).first()[0] or 0
    blocks = max(1, -(-size // (2 * block_shingles)))  # a word has at least two characters with its space
    for b in range(blocks):
        chosen = classes.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b) if blocks > 1 else classes
        yield Index([(r["id"], r["n"], r["words"]) for r in chosen.collect()], words)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    block_shingles: int = BLOCK_SHINGLES,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """A row per document and item class of which the document holds ``threshold`` or more (``HIT_SCHEMA``)."""
    queries = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    parts = [queries.mapInArrow(_search(index, threshold), HIT_SCHEMA) for index in _blocks_of(benchmark, words, block_shingles, item_id, item_text)]
    return functools.reduce(DataFrame.unionByName, parts)


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    block_shingles: int = BLOCK_SHINGLES,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` without the rows that hold a test item. Rows pass where they are, nothing is shuffled."""
    for index in _blocks_of(benchmark, words, block_shingles, item_id, item_text):
        docs = docs.mapInArrow(_clean(index, threshold, text), docs.schema)
    return docs


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items; items of the same words are one."""
    hits = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.withColumn("containment", F.round("containment", 6))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql_words(name: str, key: str, source: str) -> str:
    return rf"""
{name}_w AS (
  SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM {source})"""


def _sql_shingles(name: str, key: str) -> str:
    return f"""
{name} AS (
  SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= {WORDS}
    THEN list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM {name}_w)"""


#: For items of at least five words, as all of the benchmark tables have.
OP6_SQL = f"""
WITH {_sql_words("d", "doc_id", "documents")}, {_sql_shingles("d", "doc_id")}, {_sql_words("i", "item_id", "benchmark")},
b_w AS (SELECT w, min(item_id) AS item_id, count(*) AS n_items FROM i_w WHERE len(w) > 0 GROUP BY w), {_sql_shingles("b", "item_id")},
n AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id)
SELECT doc_id, item_id, any_value(n_items)::BIGINT AS n_items, n::BIGINT AS n_shingles, count(*)::BIGINT AS shared, round(count(*)::DOUBLE / n, 6) AS containment
FROM d JOIN b USING (s) JOIN n USING (item_id) JOIN b_w USING (item_id) GROUP BY doc_id, item_id, n HAVING count(*) >= {THRESHOLD} * n
"""

QUERIES = {"op6_benchmark_decontamination": op6_benchmark_decontamination}
SQL = {"op6_benchmark_decontamination": OP6_SQL}
