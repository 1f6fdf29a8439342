"""Distribution drift between two splits: SMD, PSI and JSD per feature, and error profiles.

Features come in long form (feature, split, value) with their names, never by position.
Bin edges are exact order statistics found without gathering a feature's values: an
approximate histogram of the distinct values tells which range of values holds each wanted
rank, and only those ranges are sorted, as values with their counts; so neither many rows nor a
value that many share come into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .metrics import error_type

BINS, EPSILON = 10, 1e-6
SEVERE = {"smd": 0.8, "psi": 0.25, "jsd": 0.10}
#: Ranges of values that a feature's ranks are looked for in.
RANGES = 64


def order_statistics(df: DataFrame, by: str, value: str, fractions: Sequence[float]) -> DataFrame:
    """Per ``by``: the exact quantiles at ``fractions`` as ``quantiles``, linearly interpolated."""
    shares = [i / RANGES for i in range(1, RANGES)]
    counted = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("m"))
    cuts = counted.groupBy(by).agg(F.percentile_approx(value, shares, 20 * RANGES).alias("cuts"), F.sum("m").alias("n"))
    ranged = counted.join(cuts, by).withColumn("range", F.size(F.filter("cuts", lambda c: c <= F.col(value)))).drop("cuts")
    held = ranged.groupBy(by, "range").agg(F.sum("m").alias("held"), F.max("n").alias("n"))
    before = Window.partitionBy(by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.withColumn("start", F.coalesce(F.sum("held").over(before), F.lit(0)))
    at = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q")) for i, q in enumerate(fractions)))).alias("w")
    place = (F.col("n") - 1) * F.col("w.q")
    low = F.floor(place).cast("bigint")
    ends = F.explode(F.array(F.struct(F.lit(0).alias("end"), low.alias("rank")), F.struct(F.lit(1).alias("end"), F.least(low + 1, F.col("n") - 1).alias("rank")))).alias("e")
    wanted = starts.select(by, "range", "start", "held", "n", at).select(by, "range", "start", "held", F.col("w.i").alias("i"), (place - F.floor(place)).alias("weight"), ends)
    wanted = wanted.where((F.col("e.rank") >= F.col("start")) & (F.col("e.rank") < F.col("start") + F.col("held"))).select(by, "range", "start", "i", "weight", "e.end", "e.rank")
    within = Window.partitionBy(by, "range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    sorted_ = ranged.join(wanted.select(by, "range").distinct(), [by, "range"], "left_semi").withColumn("first", F.coalesce(F.sum("m").over(within), F.lit(0)))
    found = sorted_.join(wanted, [by, "range"]).where((F.col("rank") >= F.col("start") + F.col("first")) & (F.col("rank") < F.col("start") + F.col("first") + F.col("m")))
    pairs = found.groupBy(by, "i").agg(*(F.max(F.when(F.col("end") == k, F.col(value))).alias(c) for k, c in ((0, "a"), (1, "b"))), F.max("weight").alias("w"))
    a, b, w = F.col("a"), F.col("b"), F.col("w")
    # both ends of the interpolation are exact, so that an edge on a data value equals it
    mixed = F.when(w < 0.5, a + (b - a) * w).otherwise(b - (b - a) * (1 - w))
    return pairs.select(by, "i", mixed.alias("x")).groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("quantiles"))


def drift_table(df: DataFrame, reference: str, comparison: str, bins: int = BINS, epsilon: float = EPSILON, feature: str = "feature", split: str = "split", value: str = "value") -> DataFrame:
    """SMD, PSI and JSD of each feature between two splits."""
    both = df.where(F.col(split).isin(reference, comparison)).select(feature, (F.col(split) == comparison).cast("int").alias("c"), value)
    edges = order_statistics(both, feature, value, [*(i * (1 / bins) for i in range(bins)), 1.0])  # an evenly stepped grid
    edges = edges.select(feature, F.array_distinct("quantiles").alias("edges"))
    inner = edges.select(feature, F.expr("CASE WHEN size(edges) > 2 THEN slice(edges, 2, size(edges) - 2) ELSE cast(array() as array<double>) END").alias("inner"), (F.size("edges") < 2).alias("flat"))
    placed = both.join(inner, feature)  # a row per feature: broadcast at run time where small
    placed = placed.withColumn("bin", F.size(F.filter("inner", lambda e: F.col(value) >= e)))
    counted = placed.groupBy(feature, "bin").agg(F.count_if(F.col("c") == 0).alias("n0"), F.count_if(F.col("c") == 1).alias("n1"))
    grid = inner.select(feature, "flat", F.explode(F.expr("sequence(0, size(inner))")).alias("bin"))
    full = grid.join(counted, [feature, "bin"], "left").fillna(0, ["n0", "n1"])
    whole = Window.partitionBy(feature)
    p = (F.col("n0") + epsilon) / F.sum(F.col("n0") + epsilon).over(whole)
    q = (F.col("n1") + epsilon) / F.sum(F.col("n1") + epsilon).over(whole)
    shares = full.select(feature, "flat", p.alias("p"), q.alias("q")).withColumn("m", (F.col("p") + F.col("q")) / 2)
    p, q, mid = F.col("p"), F.col("q"), F.col("m")
    div = shares.groupBy(feature, "flat").agg(
        F.sum((q - p) * F.ln(q / p)).alias("psi"), (F.sum(p * F.log2(p / mid)) / 2 + F.sum(q * F.log2(q / mid)) / 2).alias("jsd")
    )
    moments = both.groupBy(feature).agg(
        *(f(F.when(F.col("c") == k, F.col(value))).alias(f"{name}{k}") for k in (0, 1) for name, f in (("mean", F.avg), ("var", F.var_pop)))
    )
    scale = F.sqrt((F.col("var0") + F.col("var1")) / 2)
    smd = F.when(scale > epsilon, F.abs(F.col("mean1") - F.col("mean0")) / scale).otherwise(F.lit(0.0))
    zero = F.col("flat")
    return moments.join(div, feature).select(
        feature, F.col("mean0").alias("reference_mean"), F.col("mean1").alias("comparison_mean"), smd.alias("smd"),
        F.when(zero, F.lit(0.0)).otherwise(F.col("psi")).alias("psi"), F.when(zero, F.lit(0.0)).otherwise(F.col("jsd")).alias("jsd"),
    )


def severe(limits: dict[str, float] = SEVERE) -> Column:
    return (F.abs(F.col("smd")) >= limits["smd"]) | (F.col("psi") >= limits["psi"]) | (F.col("jsd") >= limits["jsd"])


def weighted(drift: DataFrame, importances: DataFrame) -> DataFrame:
    """Adds model importance (0 where unknown) and the importance-weighted SMD."""
    joined = drift.join(importances, "feature", "left").withColumn("importance", F.coalesce("importance", F.lit(0.0)))
    return joined.withColumn("importance_weighted_smd", F.col("smd") * F.col("importance"))


def top_features(drift: DataFrame, score: str, n: int) -> DataFrame:
    return drift.orderBy(F.desc(score), F.asc("feature")).limit(n)


def ablation_sets(drift: DataFrame, score: str, sizes: Sequence[int]) -> DataFrame:
    """(n_removed, rank, feature): the ``n`` most drifted features for each size."""
    top = top_features(drift, score, max(sizes)).withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), F.asc("feature"))))
    return top.select("feature", "rank", F.explode(F.array(*map(F.lit, sizes))).alias("n_removed")).where("rank <= n_removed")


def error_analysis(df: DataFrame, by: Sequence[str], label: str = "target", score: str = "probability", loss: str | None = None) -> DataFrame:
    """Counts, mean probability and (of a ``loss`` column) mean loss fraction by error type."""
    typed = df.withColumn("error_type", error_type(F.col(label), F.col("prediction")))
    more = [F.avg(loss).alias("mean_loss_fraction")] if loss else []
    return typed.groupBy(*by, "error_type").agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_probability"), *more)


def spatial_error_grid(df: DataFrame, by: Sequence[str], size: int = 512, label: str = "target") -> DataFrame:
    """Error counts and rate per grid cell of ``size`` pixels."""
    y, p = F.col(label), F.col("prediction")
    celled = df.withColumns({"grid_row": F.floor(F.col("row_off") / size).cast("bigint"), "grid_col": F.floor(F.col("col_off") / size).cast("bigint")})
    out = celled.groupBy(*by, "grid_row", "grid_col").agg(
        F.count(F.lit(1)).alias("n"), F.avg(y).alias("positive_rate"), F.count_if((y == 0) & (p == 1)).alias("fp"), F.count_if((y == 1) & (p == 0)).alias("fn")
    )
    return out.withColumn("error_rate", (F.col("fp") + F.col("fn")) / F.col("n"))


def prevalence_ratio(df: DataFrame, split: str, comparison: str, reference: str, label: str = "target") -> DataFrame:
    return df.agg(
        F.avg(F.when(F.col(split) == reference, F.col(label))).alias("reference_prevalence"),
        F.avg(F.when(F.col(split) == comparison, F.col(label))).alias("comparison_prevalence"),
    ).withColumn("ratio", F.try_divide("comparison_prevalence", "reference_prevalence"))
