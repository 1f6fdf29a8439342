"""Tree ensembles: extremely randomised trees and random forests, scoring, calibration and selection.

Small training tables (``PACKED_CELLS``) go to the tasks as one packed row, and each tree is a task's
work. Larger ones stay where they are: the nodes of all trees that hold more than ``SMALL`` rows are
split level by level from two aggregates, the ranges of their features and the classes to the left
of their candidate cuts; the rows of smaller nodes are then grouped and each node is finished by a
task. So the driver holds split nodes only, about rows/SMALL of them per tree, and no task more than
``SMALL`` rows of a node. A model is a table of nodes, and scoring walks it in numpy, batch by batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settled
from . import metrics

NODES = "tree int, node bigint, feature int, threshold double, left_child bigint, right_child bigint, value double, weight double, gain double"
#: Cells (rows by features) of a training table that is packed into one broadcast row, 64 MB.
PACKED_CELLS = 8_000_000
#: Rows of a node that one task finishes.
SMALL = 50_000
#: Cuts that a forest tries on a feature.
CUTS = 19


def _gini(w0: np.ndarray, w1: np.ndarray) -> np.ndarray:
    total = w0 + w1
    safe = np.where(total > 0, total, 1)
    return total * (1 - (w0 / safe) ** 2 - (w1 / safe) ** 2)


def build_tree(x: np.ndarray, y: np.ndarray, weight: np.ndarray, draw: np.random.Generator, leaf: int, depth: int | None, every_cut: bool) -> list[tuple]:
    """One tree as rows (node, feature, threshold, left, right, value, weight, gain).

    Each node tries about sqrt(features) features with one random cut each (or, for a forest, with
    ``every_cut``, the best of ``CUTS``) and keeps the one with the largest Gini gain. Rows of weight 0
    are not in the tree's sample.
    """
    tries = max(1, int(np.sqrt(x.shape[1])))
    nodes: list[list] = []
    stack = [(np.flatnonzero(weight > 0), 0, -1, 0)]
    while stack:
        at, level, parent, slot = stack.pop()
        node = len(nodes)
        if parent >= 0:
            nodes[parent][3 + slot] = node
        w0, w1 = float(weight[at][y[at] == 0].sum()), float(weight[at][y[at] == 1].sum())
        nodes.append([node, -1, 0.0, -1, -1, w1 / (w0 + w1) if w0 + w1 else 0.0, w0 + w1, 0.0])
        if len(at) < 2 * leaf or not w0 or not w1 or depth is not None and level >= depth:
            continue
        best, tested = None, 0
        for f in draw.permutation(x.shape[1]):
            column = x[at, f]
            low, high = column.min(), column.max()
            if low == high:
                continue
            cuts = np.unique(np.quantile(column, np.linspace(0.05, 0.95, CUTS))) if every_cut else [draw.uniform(low, high)]
            for cut in cuts:
                left = column <= cut
                n = int(left.sum())
                if n < leaf or len(at) - n < leaf:
                    continue
                ones = y[at] == 1
                lw1, lw0 = weight[at][left & ones].sum(), weight[at][left & ~ones].sum()
                gain = float(_gini(np.array(w0), np.array(w1)) - _gini(lw0, lw1) - _gini(w0 - lw0, w1 - lw1))
                if best is None or gain > best[0]:
                    best = (gain, int(f), float(cut), left)
            tested += 1
            if tested >= tries:
                break
        if best is None:
            continue
        gain, f, cut, left = best
        nodes[node][1], nodes[node][2], nodes[node][7] = f, cut, gain
        stack.append((at[~left], level + 1, node, 1))
        stack.append((at[left], level + 1, node, 0))
    return [tuple(n) for n in nodes]


def _sampled(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in a tree's bootstrap sample: Poisson of mean 1, by the row's hash."""
    with np.errstate(over="ignore"):
        z = keys.view(np.uint64) + np.uint64(tree * 0x9E3779B97F4A7C15 + seed & 0xFFFFFFFFFFFFFFFF)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    u = (z >> np.uint64(11)).astype(float) / (1 << 53)
    return np.searchsorted(np.cumsum([0.36787944, 0.36787944, 0.18393972, 0.06131324, 0.01532831, 0.00306566]), u).astype(float)


def _weights(y: np.ndarray, keys: np.ndarray, tree: int, seed: int, balanced: Sequence[float], bootstrap: bool) -> np.ndarray:
    weight = np.asarray(balanced)[y]
    return weight * _sampled(keys, tree, seed) if bootstrap else weight


class _Top:
    """The nodes that were split over the whole table: per tree, rows like ``NODES`` by node number."""

    def __init__(self, trees: int):
        self.trees: list[list[list]] = [[[0, -1, 0.0, -1, -1, 0.0, 0.0, 0.0]] for _ in range(trees)]
        self.levels: list[list[int]] = [[0] for _ in range(trees)]

    def walk(self, tree: int, x: np.ndarray) -> np.ndarray:
        """The node that each row has come to."""
        nodes = self.trees[tree]
        feature, cut, left, right = (np.array([n[k] for n in nodes]) for k in (1, 2, 3, 4))
        at = np.zeros(len(x), np.int64)
        open_ = np.flatnonzero(feature[at] >= 0)
        while len(open_):
            n = at[open_]
            at[open_] = np.where(x[open_, feature[n]] <= cut[n], left[n], right[n])
            open_ = open_[feature[at[open_]] >= 0]
        return at

    def split(self, tree: int, node: int, feature: int, cut: float, gain: float) -> list[int]:
        nodes, children = self.trees[tree], []
        for slot in (3, 4):
            nodes[node][slot] = len(nodes)
            children.append(len(nodes))
            nodes.append([len(nodes), -1, 0.0, -1, -1, 0.0, 0.0, 0.0])
            self.levels[tree].append(self.levels[tree][node] + 1)
        nodes[node][1], nodes[node][2], nodes[node][7] = feature, cut, gain
        return children


def _matrices(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.stack(batch["x"].to_numpy()) if len(batch) else np.zeros((0, 1)), batch["y"].to_numpy(np.int64), batch["k"].to_numpy(np.int64)


def _ranges(data: DataFrame, top: _Top, open_: list[tuple[int, int]], weigh) -> dict:
    """(tree, node): rows, class weights, and least and greatest value of each feature."""
    wanted: dict[int, list[int]] = {}
    for tree, node in open_:
        wanted.setdefault(tree, []).append(node)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, y, keys = _matrices(batch)
            rows = []
            for tree, nodes in wanted.items():
                at, w = top.walk(tree, x), weigh(y, keys, tree)
                for node in nodes:
                    here = (at == node) & (w > 0)
                    if here.any():
                        rows.append((tree, node, int(here.sum()), w[here & (y == 0)].sum(), w[here & (y == 1)].sum(), x[here].min(0).tolist(), x[here].max(0).tolist()))
            yield pd.DataFrame(rows, columns=["tree", "node", "n", "w0", "w1", "lo", "hi"])

    parts = data.mapInPandas(run, "tree int, node int, n bigint, w0 double, w1 double, lo array<double>, hi array<double>")
    each = parts.select("tree", "node", "n", "w0", "w1", F.posexplode(F.arrays_zip("lo", "hi")).alias("f", "r"))
    ends = each.groupBy("tree", "node", "f").agg(F.sum("n").alias("n"), F.sum("w0").alias("w0"), F.sum("w1").alias("w1"), F.min("r.lo").alias("lo"), F.max("r.hi").alias("hi"))
    out: dict = {}
    for r in ends.collect():  # a row per open node and feature
        out.setdefault((r["tree"], r["node"]), (r["n"], r["w0"], r["w1"], {}))[3][r["f"]] = (r["lo"], r["hi"])
    return out


def _gains(data: DataFrame, top: _Top, tried: dict[tuple[int, int], list[tuple[int, float]]], weigh) -> dict:
    """(tree, node, candidate): rows and class weights to the left of the cut."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, y, keys = _matrices(batch)
            rows, walked = [], {}
            for (tree, node), cuts in tried.items():
                if tree not in walked:
                    walked = {tree: (top.walk(tree, x), weigh(y, keys, tree))}
                at, w = walked[tree]
                here = (at == node) & (w > 0)
                for i, (f, cut) in enumerate(cuts):
                    left = here & (x[:, f] <= cut)
                    rows.append((tree, node, i, int(left.sum()), w[left & (y == 0)].sum(), w[left & (y == 1)].sum()))
            yield pd.DataFrame(rows, columns=["tree", "node", "i", "n", "w0", "w1"])

    sums = data.mapInPandas(run, "tree int, node int, i int, n bigint, w0 double, w1 double").groupBy("tree", "node", "i").agg(*(F.sum(c).alias(c) for c in ("n", "w0", "w1")))
    return {(r["tree"], r["node"], r["i"]): (r["n"], r["w0"], r["w1"]) for r in sums.collect()}  # a row per candidate


def _grow_top(data: DataFrame, trees: int, leaf: int, depth: int | None, every_cut: bool, seed: int, small: int, weigh) -> _Top:
    """Splits the nodes of more than ``small`` rows, a level of all trees at a time."""
    top = _Top(trees)
    open_ = [(t, 0) for t in range(trees)]
    while open_:
        ranges = _ranges(data, top, open_, weigh)
        tried = {}
        for (tree, node), (n, w0, w1, ends) in sorted(ranges.items()):
            row = top.trees[tree][node]
            row[5], row[6] = (w1 / (w0 + w1) if w0 + w1 else 0.0), w0 + w1
            if n <= small or n < 2 * leaf or not w0 or not w1 or depth is not None and top.levels[tree][node] >= depth:
                continue
            draw = np.random.default_rng([seed, tree, node])
            several = [f for f in draw.permutation(len(ends)) if ends[f][0] < ends[f][1]][: max(1, int(np.sqrt(len(ends))))]
            cuts = [(int(f), float(c)) for f in several for c in (np.linspace(*ends[f], CUTS + 2)[1:-1] if every_cut else [draw.uniform(*ends[f])])]
            if cuts:
                tried[tree, node] = cuts
        left = _gains(data, top, tried, weigh) if tried else {}
        open_ = []
        for (tree, node), cuts in tried.items():
            n, w0, w1, _ = ranges[tree, node]
            best = None
            for i, (f, cut) in enumerate(cuts):
                ln, l0, l1 = left.get((tree, node, i), (0, 0.0, 0.0))
                if min(ln, n - ln) >= leaf:
                    gain = float(_gini(np.array(w0), np.array(w1)) - _gini(np.array(l0), np.array(l1)) - _gini(np.array(w0 - l0), np.array(w1 - l1)))
                    if best is None or gain > best[0]:
                        best = (gain, f, cut)
            if best:
                open_ += [(tree, c) for c in top.split(tree, node, best[1], best[2], best[0])]
    return top


def fit_trees(df: DataFrame, features: Sequence[str], label: str, trees: int = 600, leaf: int = 4, depth: int | None = None, balanced: bool = True, bootstrap: bool = False, seed: int = 42, small: int = SMALL, packed_cells: int = PACKED_CELLS) -> DataFrame:
    """The ensemble's node table. ``bootstrap`` and a depth give a random forest, whose samples are
    Poisson weights by the row's hash (so equal rows share theirs)."""
    spark = df.sparkSession
    x = F.array(*(F.col(f).cast("double") for f in features))
    data = settled(df.select(x.alias("x"), F.col(label).cast("int").alias("y"), F.xxhash64(*features, label).alias("k")))
    counts = {r["y"]: r["n"] for r in data.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    shares = [n / (2.0 * max(counts.get(c, 0), 1)) if balanced else 1.0 for c in (0, 1)]
    names = [p.split()[0] for p in NODES.split(", ")]

    def weigh(y: np.ndarray, keys: np.ndarray, tree: int) -> np.ndarray:
        return _weights(y, keys, tree, seed, shares, bootstrap)

    if n * len(features) <= packed_cells:

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = [b for b in batches if len(b)]
            if held:
                x_, y_, k_ = _matrices(pd.concat(held))
                order = np.lexsort((y_, k_))  # the same trees however the rows came
                yield pd.DataFrame({"x": [x_[order].tobytes()], "y": [y_[order].tobytes()], "k": [k_[order].tobytes()]})

        def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for t, xb, yb, kb in zip(batch["id"], batch["x"], batch["y"], batch["k"]):
                    x_, y_, k_ = np.frombuffer(xb).reshape(-1, len(features)), np.frombuffer(yb, np.int64), np.frombuffer(kb, np.int64)
                    rows = build_tree(x_, y_, weigh(y_, k_, int(t)), np.random.default_rng([seed, int(t)]), leaf, depth, bootstrap)
                    yield pd.DataFrame([(int(t), *r) for r in rows], columns=names)

        packed = data.coalesce(1).mapInPandas(pack, "x binary, y binary, k binary")
        each = spark.range(0, trees, 1, min(trees, 4 * spark.sparkContext.defaultParallelism)).crossJoin(F.broadcast(packed))  # one row of a checked size
        return each.mapInPandas(grow, NODES)

    top = _grow_top(data, trees, leaf, depth, bootstrap, seed, small, weigh)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x_, y_, k_ = _matrices(batch)
            for tree in range(trees):
                w = weigh(y_, k_, tree)
                here = w > 0
                yield pd.DataFrame({"tree": tree, "top": top.walk(tree, x_)[here], "x": batch["x"].to_numpy()[here], "y": y_[here], "w": w[here]})

    def finish(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree, at = (int(k) for k in key)
        level = top.levels[tree][at]
        x_, y_, w_ = np.stack(group["x"].to_numpy()), group["y"].to_numpy(np.int64), group["w"].to_numpy()
        order = np.lexsort((*x_.T, y_))
        if len(group) <= small:
            rows = build_tree(x_[order], y_[order], w_[order], np.random.default_rng([seed, tree, at, 1]), leaf, None if depth is None else max(depth - level, 0), bootstrap)
        else:  # a large node that can't be split
            row = top.trees[tree][at]
            rows = [(0, -1, 0.0, -1, -1, row[5], row[6], 0.0)]

        def number(j: int) -> int:  # the group's root is the top's node
            return at if j == 0 else -1 if j < 0 else (at + 1 << 32) + j

        return pd.DataFrame([(tree, number(r[0]), r[1], r[2], number(r[3]), number(r[4]), *r[5:]) for r in rows], columns=names)

    done = data.mapInPandas(deal, "tree int, top bigint, x array<double>, y int, w double").groupBy("tree", "top").applyInPandas(finish, NODES)
    split = [(t, *n) for t, nodes in enumerate(top.trees) for n in nodes if n[1] >= 0]
    return done.unionByName(spark.createDataFrame(split, NODES)) if split else done


def importances(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean decrease in impurity per feature, summing to 1."""
    gains = nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum("gain").alias("g"))
    totals = gains.groupBy("tree").agg(F.sum("g").alias("t"))
    per = gains.join(totals, "tree").groupBy("feature").agg(F.sum(F.col("g") / F.col("t")).alias("s"))
    whole = per.agg(F.sum("s").alias("w"))
    names = F.array(*map(F.lit, features))
    return per.crossJoin(F.broadcast(whole)).select(F.get(names, F.col("feature")).alias("feature"), (F.col("s") / F.col("w")).alias("importance"))


def load_nodes(nodes: DataFrame) -> list[tuple[np.ndarray, ...]]:
    """The node table as arrays per tree; bounded by the model's size, not by data."""
    table = nodes.orderBy("tree", "node").toPandas()
    out = []
    for _, g in table.groupby("tree", sort=True):
        numbers = g["node"].to_numpy()
        left, right = (np.searchsorted(numbers, g[c].to_numpy()) for c in ("left_child", "right_child"))
        out.append((g["feature"].to_numpy(), g["threshold"].to_numpy(), left, right, g["value"].to_numpy()))
    return out


def predict_proba(trees: list[tuple[np.ndarray, ...]], x: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x))
    for feature, threshold, left, right, value in trees:
        at = np.zeros(len(x), np.int64)
        open_ = np.flatnonzero(feature[at] >= 0)
        while len(open_):
            node = at[open_]
            goes = x[open_, feature[node]] <= threshold[node]
            at[open_] = np.where(goes, left[node], right[node])
            open_ = open_[feature[at[open_]] >= 0]
        total += value[at]
    return total / max(1, len(trees))


def score(df: DataFrame, nodes: DataFrame, features: Sequence[str], out: str = "probability") -> DataFrame:
    """Adds the ensemble's probability; the columns must be the model's features, by name."""
    if missing := [f for f in features if f not in df.columns]:
        raise KeyError(f"features missing: {missing}")
    shared = df.sparkSession.sparkContext.broadcast(load_nodes(nodes))

    @F.pandas_udf("double")
    def probability(*columns: pd.Series) -> pd.Series:
        return pd.Series(predict_proba(shared.value, np.column_stack([c.to_numpy(np.float64) for c in columns])))

    return df.withColumn(out, probability(*(F.col(f).cast("double") for f in features)))


def calibrated(df: DataFrame, features: Sequence[str], label: str, folds: int = 3, method: str = "sigmoid", **args) -> list[tuple[DataFrame, float, float]]:
    """Models with sigmoid calibrators, one per fold: trees of the other folds' rows, and a logistic
    regression of the held out fold's labels on their scores."""
    if method != "sigmoid":
        raise ValueError(f"unsupported calibration {method}")
    folded = df.withColumn("__fold", F.pmod(F.xxhash64(*features, label), F.lit(folds)))
    models = []
    for k in range(folds):
        nodes = settled(fit_trees(folded.where(F.col("__fold") != k), features, label, **args))
        held = score(folded.where(F.col("__fold") == k), nodes, features, "__score")
        ready = VectorAssembler(inputCols=["__score"], outputCol="__x").transform(held)
        fitted = LogisticRegression(featuresCol="__x", labelCol=label, probabilityCol="__p", rawPredictionCol="__r", predictionCol="__k").fit(ready)
        models.append((nodes, float(fitted.coefficients[0]), float(fitted.intercept)))
    return models


def score_calibrated(df: DataFrame, models: Sequence[tuple[DataFrame, float, float]], features: Sequence[str], out: str = "probability") -> DataFrame:
    """Adds the mean of the folds' calibrated probabilities."""
    parts = []
    for i, (nodes, slope, intercept) in enumerate(models):
        df = score(df, nodes, features, f"__score{i}")
        parts.append(1 / (1 + F.exp(-(slope * F.col(f"__score{i}") + intercept))))
    return df.withColumn(out, reduce(lambda a, b: a + b, parts) / len(parts)).drop(*(f"__score{i}" for i in range(len(models))))


def sweep(train: DataFrame, validation: DataFrame, candidates: Sequence[dict], features: Sequence[str], label: str, by: str, least_recall: float = 0.75) -> tuple[DataFrame, dict[int, DataFrame]]:
    """Fits each candidate on ``train`` and judges it on ``validation`` alone.

    A candidate has an ``id``, arguments of ``fit_trees`` and maybe ``features``, a subset (an ablation
    set), and ``calibration``. Returns the tuning table, a row per candidate with its threshold, metrics,
    the worst group's average precision and ``selected``, and each candidate's node table. Candidates
    are a short list; the test rows are never seen here."""
    rows, tables = [], {}
    for c in candidates:
        used = list(c.get("features", features))
        if unknown := set(used) - set(features):
            raise KeyError(f"unknown features: {sorted(unknown)}")
        args = {k: v for k, v in c.items() if k not in ("id", "features", "calibration")}
        if c.get("calibration", "none") == "none":
            tables[c["id"]] = settled(fit_trees(train, used, label, **args))
            scored = score(validation, tables[c["id"]], used)
        else:
            scored = score_calibrated(validation, calibrated(train, used, label, method=c["calibration"], **args), used)
        scored = settled(scored.select(by, F.col(label).cast("int").alias("target"), "probability"))
        one = scored.withColumn("rows", F.lit("validation"))
        best = metrics.select_threshold(metrics.threshold_sweep(one, ["rows"]), ["rows"], recall=least_recall)
        ranked = metrics.average_precision(one, ["rows"]).withColumnRenamed("average_precision", "pr_auc")
        worst = metrics.average_precision(scored, [by]).agg(F.min("average_precision").alias("worst_pr_auc"))
        row = best.join(ranked, "rows").crossJoin(worst)  # one row each
        rows.append(row.select(F.lit(c["id"]).alias("candidate_id"), F.lit(len(used)).alias("feature_count"), "threshold", "precision", "recall", "f1", "fpr", "pr_auc", "worst_pr_auc", "eligible"))
    table = settled(reduce(DataFrame.unionByName, rows))
    chosen = metrics.select_model(table, F.col("eligible"), ["pr_auc", "worst_pr_auc", "f1"], "candidate_id").first()["candidate_id"]
    return table.withColumn("selected", F.col("candidate_id") == chosen), tables
