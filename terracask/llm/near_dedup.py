"""Operator 2: near-duplicate groups by a chosen-path set similarity join.

Documents are sets of word shingles. In each of ``TREES`` independent trees the documents
of a node are branched by minwise tokens: each of ``COORDINATES`` minwise hash functions is
chosen with probability 1/(similarity * COORDINATES), by a hash of the node alone, and a
document goes to the child that its token of each chosen function names. A pair at the
threshold so keeps one common child per node on average, however deep, while unlike
documents part after a level or two. Since a node's choices depend on the node alone, each
document finds its own way down ``DEPTH`` levels without a shuffle. Nodes of at most
``NODE`` documents are compared exhaustively (by signature, then on full sets). Larger ones
are compared in blocks of rows, as exhaustively, where that copies their rows at most about
as often as branching would; what is larger yet is branched on, round by round, each node in
``SUBTREES`` independent ways: in one way a pair at the threshold stays together with a
probability of 0.37 only, in none of eight with 0.63**8, about 0.02. Pairs at the threshold are
missed with a probability of (1 - 0.37)**24, about 1e-5, at the first ``DEPTH`` levels, which
deeper rounds raise by less than a fifth, however many; more similar ones far less often.

Work is saved only where it can't lose a link between components: equal sets are one
class; before nodes are compared, each document is confirmed against the smallest document
that it most often meets (where their signatures are alike), and pairs inside a component that
is already connected are not compared again; pairs are passed over when their sizes, or 128 minwise values, rule the
threshold out (a chance below 1e-5). All links are confirmed on full sets. What is still
too large after ``ROUNDS`` rounds is compared in blocks too.

No task ever holds a node of unbounded size: sizes are counted first, with partial sums;
only small nodes are gathered; large ones go through joins that adaptive execution splits.

Defined cases: null or wordless text is an empty set, linked with nothing; repeated rows
are equal sets; rows that share an id count as one document with the sets of all of them;
rows with null id are linked with nothing, their component_id is null and they are kept;
an empty table gives an empty result. ``drop_near_duplicates`` judges rows, not ids: of rows
that share an id, those whose own text repeats a smaller id's go and the others stay, once
each if their texts are equal; extra columns are carried along, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shingles as S
from .common import arrow_rows, drop_path, fresh, table, write_table
from .components import components

WORDS = 5
#: Intersection over union of at least so many hundredths.
PERCENT = 85
TREES = 24
DEPTH = 3
COORDINATES = 128
#: Documents of a node that is compared exhaustively, and of a block of one that is still larger at last.
NODE = 2048
ROUNDS = 8
BLOCK = NODE // 2
#: Independent ways in which an oversize node is branched on.
SUBTREES = 8
#: Copies of its rows, on average, up to which an oversize node is compared in blocks at once; in each
#: later round so many times more, as its rows were copied before.
COPIES = 16
#: Shingles that the documents of such a node may have together.
WEIGHT = 1 << 23
#: Shingles of sets that are compared by 16 bits of each first.
NARROW = 2048
#: Ids of documents that are sent to the texts at once, some 16 MB.
BROADCAST_IDS = 1 << 20
#: Rows, and pairs with both sets, in a batch that Python is handed.
ROWS_AT_ONCE, PAIRS_AT_ONCE = 1024, 64
#: Nodes whose coordinates are drawn at a time.
CHOSEN_AT_ONCE = 1 << 12
#: Rows that are compared with a node's others at a time.
BAND = 128
_MULTIPLIERS = S.stream(21, COORDINATES) | S.U(1)
_OFFSETS = S.stream(22, COORDINATES)
_ROOTS = S.stream(23, 4096)
_WAYS = S.stream(24, SUBTREES)

FEATURES = "doc_id bigint, mark bigint, n_shingles bigint, k1 bigint, k2 bigint, sig binary, nodes array<bigint>"


# ----------------------------------------------------------------- branching


def _chosen(nodes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """For each node the coordinates chosen in it, as (index into nodes, coordinate)."""
    limit = S.U(int((1 << 64) * (100 / percent) / COORDINATES))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for start in range(0, len(nodes), CHOSEN_AT_ONCE):
        with np.errstate(over="ignore"):
            draws = S.mix(nodes[start : start + CHOSEN_AT_ONCE, None] ^ _OFFSETS[None, :])
        at, coordinate = np.nonzero(draws < limit)
        found.append((at + start, coordinate))
    return np.concatenate([a for a, _ in found]), np.concatenate([c for _, c in found])


def descend(tokens: np.ndarray, rows: np.ndarray, nodes: np.ndarray, depth: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Moves (row, node) pairs down ``depth`` levels; ``tokens`` is row x coordinate."""
    for _ in range(depth):
        at, coordinate = _chosen(nodes, percent)
        rows = rows[at]
        with np.errstate(over="ignore"):
            nodes = S.mix(nodes[at] + S.mix(tokens[rows, coordinate].astype(S.U) + _MULTIPLIERS[coordinate]))
    return rows, nodes


def ways(rows: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, node) pairs with each node once for every independent way to branch on it."""
    return np.repeat(rows, SUBTREES), S.mix(nodes[:, None] ^ _WAYS[None, :]).ravel()


def minwise(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row x coordinate minwise hashes of sets that are not empty."""
    out = np.empty((len(offsets) - 1, COORDINATES), S.U)
    with np.errstate(over="ignore"):
        for c in range(COORDINATES):
            out[:, c] = np.minimum.reduceat(S.mix1(values, _MULTIPLIERS[c], _OFFSETS[c]), offsets[:-1])
    return out


def _sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    hashes, word_at = S.words(*S.text_bytes(batch.column("text")), S.WHITESPACE)
    return S.distinct(*S.shingles(hashes, word_at, WORDS))


def _features(percent: int, trees: int):
    roots = _ROOTS[:trees]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in S.slices(whole, "text"):
                values, offsets = _sets(batch)
                sizes = np.diff(offsets)
                full = np.flatnonzero(sizes > 0)
                k1, k2 = np.zeros(len(sizes), S.U), np.zeros(len(sizes), S.U)
                paths: list = [[]] * len(sizes)
                sigs: list = [b""] * len(sizes)
                if len(full):
                    starts = np.concatenate([offsets[:-1][full], offsets[-1:]])
                    with np.errstate(over="ignore"):
                        k1[full] = np.add.reduceat(S.mix(values), starts[:-1])
                        k2[full] = np.add.reduceat(S.mix(values ^ _OFFSETS[0]), starts[:-1])
                    tokens = minwise(values, starts)
                    low = S.mix(tokens).astype(np.uint8)
                    # All trees begin with every document, so the rows share their roots' choices.
                    rows = np.tile(np.arange(len(full)), trees)
                    rows, nodes = descend(tokens, rows, np.repeat(roots, len(full)), DEPTH, percent)
                    order = np.argsort(rows, kind="stable")
                    rows, nodes = rows[order], nodes[order].view(np.int64)
                    cuts = np.searchsorted(rows, np.arange(len(full) + 1))
                    for j, r in enumerate(full):
                        paths[r] = np.unique(nodes[cuts[j] : cuts[j + 1]])
                        sigs[r] = low[j].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("mark"),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(k1.view(np.int64)),
                        pa.array(k2.view(np.int64)),
                        pa.array(sigs, pa.binary()),
                        pa.array(paths, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "mark", "n_shingles", "k1", "k2", "sig", "nodes"],
                )

    return run


def _branch(percent: int):
    """(node, id, n, sig) to the children's (node, id, n), DEPTH levels down, by signature bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = _matrix(batch)
            nodes = batch.column("node").to_numpy().view(S.U)
            step = 4096 // SUBTREES
            for at in range(0, len(nodes), step):
                part = np.arange(at, min(at + step, len(nodes)))
                rows, children = descend(tokens, *ways(part, nodes[part]), DEPTH, percent)
                kept = batch.select(["id", "n"]).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([pa.array(children.view(np.int64)), *kept.columns], ["node", "id", "n"])

    return run


def _matrix(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(-1, COORDINATES)


# ------------------------------------------------------------------ comparing


def least_agreement(percent: int) -> int:
    """Of 128 minwise values, so many that a pair at the threshold agrees in as many all but surely."""
    p = percent / 100
    return int(COORDINATES * p - 4.7 * (COORDINATES * p * (1 - p)) ** 0.5)


def _close(sig: np.ndarray, size: np.ndarray, comp: np.ndarray, side: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of a node's rows that may be a link between different components, a band of
    rows at a time. Of an oversize node's two blocks (sides 1 and 2), only pairs across them."""
    least, places = least_agreement(percent), np.arange(len(size))
    for at in range(0, len(size), BAND):
        i = places[at : at + BAND, None]
        maybe = (places > i) & (comp != comp[i]) & ((side == 0) | (side != side[i]))
        maybe &= 100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])
        left, right = np.nonzero(maybe)
        left += at
        for k in range(0, len(left), 1 << 15):
            x, y = left[k : k + (1 << 15)], right[k : k + (1 << 15)]
            close = (sig[x] == sig[y]).sum(1) >= least
            if close.any():
                yield x[close], y[close]


def _by_node(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows with equal node, from batches sorted by node, one node at a time; by what
    was counted before, a node's rows are few."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        node = batch.column("node").to_numpy()
        cuts = [0, *(np.flatnonzero(node[1:] != node[:-1]) + 1).tolist(), len(node)]
        for a, b in zip(cuts, cuts[1:]):
            if held and held[-1].column("node")[0].as_py() != node[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _contested(percent: int):
    """Of each node's rows, those that may have a link to another component in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_node(batches):
            if len(rows) < 2:
                continue
            comp, size, side = (rows.column(c).to_numpy() for c in ("comp", "n", "side"))
            found = np.zeros(len(rows), bool)
            for left, right in _close(_matrix(rows), size, comp, side, percent):
                found[left] = found[right] = True
            if found.any():
                yield from rows.select(["node", "id", "side", "home"]).filter(pa.array(found)).combine_chunks().to_batches()

    return run


def _links(percent: int, narrow: int):
    """The links of each node's rows between different components, by 32 bits of each shingle (16, in
    sets of at most ``narrow``).

    A pair that meets in several nodes is compared in the one with the smallest number; the
    blocks of an oversize node are its, and as one node here (``home``). Bits that are the same by chance can only add pairs, which are confirmed on full sets later;
    shingles of one text that share their bits are allowed for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_node(batches):
            if len(rows) < 2:
                continue
            here = rows.column("home")[0].as_py()
            ids, comp, size, side = (rows.column(c).to_numpy() for c in ("id", "comp", "n", "side"))
            held = (x for c in rows.column("low").chunks for x in c)
            sets = [np.frombuffer(x.as_buffer(), np.uint16 if k <= narrow else np.uint32) for x, k in zip(held, size)]
            met = _met_before(rows.column("nodes").to_pylist(), here)
            out: list[tuple[int, int]] = []
            for left, right in _close(_matrix(rows), size, comp, side, percent):
                new = ~(met[left] & met[right]).any(1)
                for i, j in zip(left[new].tolist(), right[new].tolist()):
                    u, v = sets[i], sets[j]
                    if u.dtype != v.dtype:  # of sets of either width the bits that both have
                        u, v = (np.unique(x.astype(np.uint16)) for x in (u, v))
                    small, large = (u, v) if len(u) <= len(v) else (v, u)
                    at = np.searchsorted(large, small)
                    at[at == len(large)] = 0
                    both = int((large[at] == small).sum()) + int(min(size[i] - len(u), size[j] - len(v)))
                    if 100 * both >= percent * (int(size[i]) + int(size[j]) - both):
                        out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _met_before(nodes: list[list[int]], here: int) -> np.ndarray:
    """For each row a bit set of the smaller nodes that it shares with any other row."""
    earlier = [[v for v in row if v < here] for row in nodes]
    counts = Counter(v for row in earlier for v in row)
    places = {v: k for k, v in enumerate(v for v, n in counts.items() if n > 1)}
    bits = np.zeros((len(nodes), len(places) // 64 + 1), S.U)
    for r, row in enumerate(earlier):
        for v in row:
            if (k := places.get(v)) is not None:
                bits[r, k >> 6] |= S.U(1 << (k & 63))
    return bits


def _all_sets(narrow: int):
    """Full shingle sets, sorted, and sorted without repeats in 32 bits, or in 16 those of at most ``narrow``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in S.slices(whole, "text"):
                values, offsets = _sets(batch)
                full = [values[a:b] for a, b in zip(offsets, offsets[1:])]
                low = [np.unique(v.astype(np.uint16 if len(v) <= narrow else np.uint32)).tobytes() for v in full]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([v.tobytes() for v in full], pa.binary()), pa.array(low, pa.binary())], ["id", "set", "low"])

    return run


def _alike(percent: int):
    """Of pairs with their signatures, those that agree in enough values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COORDINATES) for c in ("sig_a", "sig_b"))
                yield batch.select(["a", "b"]).filter(pa.array((left == right).sum(1) >= least_agreement(percent)))

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"))):
                u, v = np.frombuffer(x.as_buffer(), S.U), np.frombuffer(y.as_buffer(), S.U)
                small, large = (u, v) if len(u) <= len(v) else (v, u)
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                both = int((large[at] == small).sum()) if len(large) else 0
                if 100 * both >= percent * (len(u) + len(v) - both):
                    keep.append(i)
            if keep:
                yield batch.select(["a", "b"]).take(pa.array(keep))

    return run


# ----------------------------------------------------------------------- Spark


class _Join:
    """The state of one similarity join: classes of equal sets, confirmed links, components."""

    def __init__(self, docs: DataFrame, percent: int, trees: int):
        self.spark, self.percent = docs.sparkSession, percent
        self.paths: list[str] = []
        self.docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
        marked = self.docs.withColumn("mark", F.xxhash64("text"))
        self.features = self.keep(marked.mapInArrow(_features(percent, trees), FEATURES), "features")
        linked = self.features.where("n_shingles > 0 AND doc_id IS NOT NULL")
        same = linked.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep"))
        self.classes = self.keep(same, "classes")
        joined = linked.join(self.classes, ["k1", "k2", "n_shingles"]).where("doc_id = rep")
        self.reps = self.keep(joined.dropDuplicates(["doc_id", "k1", "k2"]).select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sig", "nodes"), "reps")
        self.labels = self.keep(self.reps.select(F.col("id").alias("node"), F.col("id").alias("comp")), "labels")

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        kept, path = write_table(self.spark, df, label)
        self.paths.append(path)
        return kept

    def info(self) -> DataFrame:
        """(id, n, sig, comp) of every class."""
        return self.reps.select("id", "n", "sig").join(self.labels.withColumnRenamed("node", "id"), "id")

    def counted(self, members: DataFrame) -> DataFrame:
        """(node, id, n, size, weight, first) of the nodes that have at least two members. Tables that
        grow with the corpus, as here, are joined by shuffles at every size."""
        sizes = members.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"), F.min("id").alias("first")).where("size > 1")
        return self.keep(members.join(sizes.hint("merge"), "node"), "members")

    def sets_of(self, ids: DataFrame, column: str) -> DataFrame:
        """(id, ``column``) of the documents with these ids (distinct), their sets made anew from their
        texts. The texts stay where they are if the ids are few enough to be sent to them."""
        ids = self.keep(ids.select(F.col("id").alias("doc_id")), "ids")
        few = ids.count() <= BROADCAST_IDS
        texts = self.docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
        return self.keep(texts.mapInArrow(_all_sets(NARROW), "id bigint, set binary, low binary").select("id", column), "sets")

    def confirm(self, pairs: DataFrame) -> None:
        """Joins the components of the pairs (a, b) that are links on their full sets."""
        pairs = self.keep(pairs, "pairs")
        sets = self.sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "set")
        with_a = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
        with_b = with_a.join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b")
        with arrow_rows(self.spark, PAIRS_AT_ONCE):
            links = self.keep(with_b.mapInArrow(_confirm(self.percent), "a bigint, b bigint"), "links")
        self.merge(links)
        self.drop("sets", "ids", "pairs")

    def alike(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that sizes and signatures don't rule out."""
        for end in ("a", "b"):
            pairs = pairs.join(self.reps.select(F.col("id").alias(end), F.col("n").alias(f"n_{end}"), F.col("sig").alias(f"sig_{end}")).hint("merge"), end)
        return pairs.where(100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")).mapInArrow(_alike(self.percent), "a bigint, b bigint")

    def merge(self, links: DataFrame) -> None:
        """Joins the components that ``links`` connect."""
        for end in ("a", "b"):
            labels = self.labels.select(F.col("node").alias(end), F.col("comp").alias(f"comp_{end}"))
            links = links.join(labels, end)
        edges = self.keep(links.where("comp_a <> comp_b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")).distinct(), "edges")
        if not edges.limit(1).count():
            return
        merged, path = components(self.spark, edges)
        new = self.labels.join(merged.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left")
        old = self.paths.index(next(p for p in self.paths if "/labels-" in p))
        self.labels = self.keep(new.select("node", F.coalesce("to", "comp").alias("comp")), "labels")
        drop_path(self.spark, self.paths.pop(old))
        drop_path(self.spark, path)

    def drop(self, *labels: str) -> None:
        for path in [p for p in self.paths if any(f"/{x}-" in p for x in labels)]:
            drop_path(self.spark, path)
            self.paths.remove(path)

    def run(self) -> None:
        members = self.counted(self.reps.select(F.explode("nodes").alias("node"), "id", "n"))
        # First the document that each one most often meets as a node's smallest.
        meets = members.where("id > first").groupBy("id", "first").agg(F.count(F.lit(1)).alias("times"))
        best = meets.groupBy("id").agg(F.max(F.struct("times", -F.col("first"))).alias("m"))
        self.confirm(self.alike(best.select((-F.col("m.col2")).alias("a"), F.col("id").alias("b"))))
        for round_ in range(ROUNDS + 1):
            rows = members.drop("n", "first").join(self.info(), "id")
            mixed = rows.groupBy("node").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("node")
            rows = self.keep(rows.join(mixed, "node", "left_semi"), "open")
            fits = (F.col("size") <= NODE) & (F.col("weight") <= WEIGHT)
            small = rows.where(fits).select("node", "id", "n", "sig", "comp", F.lit(0).alias("side"), F.col("node").alias("home"))
            large = rows.where(~fits)
            if not large.limit(1).count():
                self.compare(small)
                return
            plans = self.keep(self.planned(large), "plans")
            at_once = F.lit(True) if round_ == ROUNDS else F.col("copies") <= COPIES ** (round_ + 1)
            self.compare(small.unionByName(self.blocks(large.join(plans.where(at_once), "node"))))
            deeper = plans.where(~at_once).select("node")
            if not deeper.limit(1).count():
                return
            children = large.join(deeper, "node", "left_semi").select("node", "id", "n", "sig").mapInArrow(_branch(self.percent), "node bigint, id bigint, n bigint")
            members = self.counted(children.distinct())

    def compare(self, small: DataFrame) -> None:
        """Compares small nodes exhaustively and joins what is linked."""

        def dealt(rows: DataFrame) -> DataFrame:
            return rows.repartition("node").sortWithinPartitions("node")

        found = dealt(small).mapInArrow(_contested(self.percent), "node bigint, id bigint, side int, home bigint")
        contested = self.keep(found, "contested")
        lists = contested.groupBy("id").agg(F.collect_set("home").alias("nodes"))  # a document's own nodes
        rows = contested.join(lists, "id").join(self.info(), "id").join(self.sets_of(contested.select("id").distinct(), "low"), "id")
        found = self.keep(dealt(rows).mapInArrow(_links(self.percent, NARROW), "a bigint, b bigint").distinct(), "found")
        self.drop("sets", "ids", "contested")
        self.confirm(found)
        self.drop("found")

    def planned(self, large: DataFrame) -> DataFrame:
        """(node, main, a, b, copies) of oversize nodes: the component with most rows in it, the
        blocks of its rows and those of the others, and how often blocks copy a row on average."""
        each = large.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("held"))
        main = F.max(F.struct("rows", "held", "comp")).alias("main")
        nodes = each.groupBy("node").agg(main, F.sum("rows").alias("rows"), F.sum("held").alias("held"))

        def parts(rows: Column, held: Column) -> Column:
            return F.ceil(F.greatest(rows / BLOCK, 2 * held / WEIGHT)).cast("int")

        rest = F.col("rows") - F.col("main.rows")
        nodes = nodes.withColumn("a", parts(F.col("main.rows"), F.col("main.held"))).withColumn("b", parts(rest, F.col("held") - F.col("main.held")))
        return nodes.select("node", F.col("main.comp").alias("main"), "a", "b", (F.col("b") + F.col("a") * rest / F.col("rows")).alias("copies"))

    def blocks(self, planned: DataFrame) -> DataFrame:
        """An oversize node as small nodes of two blocks each, for every pair of its blocks but
        those of its main component, which hold no pair of different components."""
        own = F.col("comp") == F.col("main")
        key = F.xxhash64("id")
        dealt = planned.withColumn("part", F.when(own, F.pmod(key, F.col("a"))).otherwise(F.col("a") + F.pmod(key, F.col("b"))).cast("int"))
        other = F.explode(F.sequence(F.when(own, F.col("a")).otherwise(0), F.col("a") + F.col("b") - 1)).alias("other")
        both = dealt.select("node", "id", "n", "sig", "comp", "part", other)
        low, high = F.least("part", "other"), F.greatest("part", "other")
        side = F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1).otherwise(2)
        return both.select(F.xxhash64("node", low, high).alias("node"), "id", "n", "sig", "comp", side.cast("int").alias("side"), F.col("node").alias("home"))


def _verdicts(docs: DataFrame, percent: int, trees: int) -> DataFrame:
    """(doc_id, mark, n_shingles, component_id, kept) per row; ``mark`` is the hash of its text."""
    with arrow_rows(docs.sparkSession, ROWS_AT_ONCE):
        join = _Join(docs, percent, trees)
        join.run()
    join.drop("reps", "members", "open", "plans", "contested", "sets", "ids", "found", "pairs", "links", "edges")
    rows = join.features.select("doc_id", "mark", "n_shingles", "k1", "k2")
    classed = rows.join(join.classes, ["k1", "k2", "n_shingles"], "left")
    labelled = classed.join(join.labels.withColumnRenamed("node", "rep"), "rep", "left")
    whole = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return labelled.select("doc_id", "mark", "n_shingles", whole.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def near_duplicates(docs: DataFrame, percent: int = PERCENT, trees: int = TREES) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): ``doc_id``, ``n_shingles``, ``component_id``, ``kept``."""
    return _verdicts(docs, percent, trees).drop("mark")


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT, trees: int = TREES) -> DataFrame:
    """``docs`` with one document of each group; of repeated rows with one id, one row.

    Texts move only where rows of one id and text occur more than once, or where the rows to
    drop are too many for a broadcast."""
    key, mark = fresh(docs, "__id"), fresh(docs, "__mark")
    marked = docs.withColumns({key: F.col("doc_id").cast("bigint"), mark: F.xxhash64("text")})
    verdicts = _verdicts(docs, percent, trees).where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key), F.col("mark").alias(mark))
    judged, _ = write_table(docs.sparkSession, verdicts.agg(F.bool_and("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("NOT kept OR n > 1"), "verdicts")
    left = marked.join(judged.where("NOT kept").select(key, mark), [key, mark], "left_anti")
    repeated = judged.where("kept").select(key, mark)
    if repeated.limit(1).count():
        once = left.join(repeated, [key, mark], "left_semi").dropDuplicates([key, mark])
        left = left.join(repeated, [key, mark], "left_anti").unionByName(once)
    return left.select(*docs.columns)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))


OP2_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= {WORDS} THEN list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
x AS (SELECT doc_id, unnest(s) AS s FROM s),
e AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM x JOIN x y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= {PERCENT} * (na.n + nb.n - i)),
c AS (
  SELECT doc_id, doc_id AS root FROM n
  UNION
  SELECT e.b, c.root FROM c JOIN e ON e.a = c.doc_id WHERE c.root < e.b),
m AS (SELECT doc_id, min(root) AS component_id FROM c GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN m USING (doc_id)
"""

QUERIES = {"op2_near_duplicates": op2_near_duplicates}
SQL = {"op2_near_duplicates": OP2_SQL}
