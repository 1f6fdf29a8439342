"""Threshold, ranking and confusion metrics as grouped plans.

Every metric takes grouping columns and is one or two aggregations; the threshold sweep
counts rows into threshold buckets first, so its size is the grid's, not the rows' times it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import ratio
from .numbering import sums_before

#: Thresholds 0, 0.001, ..., 1.
GRID = 1000


def with_prediction(df: DataFrame, threshold: float, score: str = "probability") -> DataFrame:
    return df.withColumn("prediction", (F.col(score) >= F.lit(threshold)).cast("int"))


def alert_summary(df: DataFrame, group: str = "aoi_id", score: str = "probability") -> DataFrame:
    """Per group (null is one): counts, alerts, mean and largest probability, alert rate."""
    out = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("patch_count"),
        F.sum("prediction").cast("bigint").alias("alert_count"),
        F.avg(score).alias("mean_probability"),
        F.max(score).alias("max_probability"),
    )
    return out.withColumn("alert_rate", ratio(F.col("alert_count"), F.col("patch_count")))


def error_type(label: Column, prediction: Column) -> Column:
    return (
        F.when((label == 1) & (prediction == 1), "TP").when((label == 0) & (prediction == 1), "FP").when((label == 1) & (prediction == 0), "FN").otherwise("TN")
    )


def confusion(df: DataFrame, by: Sequence[str], label: str = "target") -> DataFrame:
    def n(y: int, p: int) -> Column:
        return F.count_if((F.col(label) == y) & (F.col("prediction") == p))

    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), n(0, 0).alias("tn"), n(0, 1).alias("fp"), n(1, 0).alias("fn"), n(1, 1).alias("tp"))


def prf(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1, FNR and FPR of a confusion table; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
            "fnr": ratio(fn, tp + fn),
            "fpr": ratio(fp, fp + tn),
        }
    )


def score_steps(df: DataFrame, by: Sequence[str], label: str = "target", score: str = "probability") -> DataFrame:
    """Positives and negatives per distinct score: what ranking metrics need, ties together."""
    return df.groupBy(*by, F.col(score).alias("score")).agg(F.sum(label).cast("bigint").alias("pos"), F.count(F.lit(1)).alias("n"))


def roc_auc(df: DataFrame, by: Sequence[str], **names) -> DataFrame:
    """Area under the ROC curve, ties counted half; null without both classes."""
    steps = score_steps(df, by, **names)
    steps = sums_before(steps.withColumn("neg", F.col("n") - F.col("pos")), by, "score", ["neg"])
    neg = F.col("neg")
    won = steps.withColumn("won", F.col("pos") * (F.col("neg_before") + neg / 2.0))
    out = won.groupBy(*by).agg(F.sum("won").alias("won"), F.sum("pos").alias("pos"), F.sum(neg).alias("neg"))
    pairs = F.col("pos") * F.col("neg")
    return out.select(*by, F.when(pairs > 0, F.col("won") / pairs).alias("roc_auc"))


def average_precision(df: DataFrame, by: Sequence[str], **names) -> DataFrame:
    """Step-wise average precision: precision at each distinct score times the recall gained there."""
    steps = score_steps(df, by, **names)
    before = sums_before(steps, by, "score", ["pos", "n"], descending=True)
    seen = before.withColumns({"tp": F.col("pos_before") + F.col("pos"), "m": F.col("n_before") + F.col("n")})
    out = seen.groupBy(*by).agg(F.sum(F.col("pos") * F.col("tp") / F.col("m")).alias("s"), F.sum("pos").alias("p"))
    return out.select(*by, ratio(F.col("s"), F.col("p")).alias("average_precision"))


def grid_value(k: Column) -> Column:
    return F.when(k == GRID, F.lit(1.0)).otherwise(k.cast("double") * F.lit(0.001))


def threshold_sweep(df: DataFrame, by: Sequence[str] = (), label: str = "target", score: str = "probability") -> DataFrame:
    """Confusion counts and metrics at each of the 1001 thresholds.

    A row is counted at the highest threshold that it reaches; counts at or above a
    threshold are running sums from the top. A score that is null or outside [0, 1] is an error.
    """
    checked = F.when(F.col(score).between(0, 1), F.col(score)).otherwise(F.raise_error(F.concat(F.lit("score outside [0, 1]: "), F.coalesce(F.col(score).cast("string"), F.lit("null")))))
    df = df.withColumn(score, checked)
    near = F.floor(F.col(score) * GRID).cast("int")
    k = F.when((near < GRID) & (F.col(score) >= grid_value(near + 1)), near + 1).when(F.col(score) < grid_value(near), near - 1).otherwise(near)
    counted = df.groupBy(*by, k.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.sum(label).cast("bigint").alias("pos"))
    groups = counted.select(*by).distinct() if by else counted.limit(0).sparkSession.range(1).select()
    grid = groups.select(*by, F.explode(F.sequence(F.lit(0), F.lit(GRID))).alias("k"))
    full = grid.join(counted, [*by, "k"], "left").fillna(0, ["n", "pos"])
    down = Window.partitionBy(*by).orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    swept = full.select(*by, grid_value(F.col("k")).alias("threshold"), F.sum("n").over(down).alias("m"), F.sum("pos").over(down).alias("tp"), F.sum("n").over(whole).alias("all"), F.sum("pos").over(whole).alias("p"))
    swept = swept.withColumns({"fp": F.col("m") - F.col("tp"), "fn": F.col("p") - F.col("tp"), "tn": F.col("all") - F.col("m") - F.col("p") + F.col("tp")})
    return prf(swept.drop("m", "all", "p"))


def _first(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("__rn = 1").drop("__rn")


def select_threshold(swept: DataFrame, by: Sequence[str] = (), recall: float | None = None, precision: float | None = None) -> DataFrame:
    """The best row by F1, precision and threshold among those that meet the minimum, or,
    if none does, among all; ``eligible`` tells which."""
    ok = F.col("recall") >= recall if recall is not None else F.col("precision") >= precision
    return _first(swept.withColumn("eligible", ok), by, [F.desc("eligible"), F.desc("f1"), F.desc("precision"), F.desc("threshold")])


def least_violation(swept: DataFrame, recall: float, fpr: float, by: Sequence[str] = ()) -> DataFrame:
    """The row with the least summed shortfall in recall and excess in FPR, then the best F1
    and the highest threshold."""
    gap = F.greatest(F.lit(0.0), recall - F.col("recall")) + F.greatest(F.lit(0.0), F.col("fpr") - fpr)
    return _first(swept.withColumn("violation", gap), by, [F.asc("violation"), F.desc("f1"), F.desc("threshold")])


def gates(metrics: DataFrame, limits: Sequence[tuple[str, str, float]]) -> DataFrame:
    """A row per gate (metric, operator >= or <=, limit) and metric row, with ``passed``."""
    cells = [F.struct(F.lit(m).alias("metric"), F.lit(op).alias("operator"), F.lit(v).alias("limit"), F.col(m).alias("value")) for m, op, v in limits]
    kept = [c for c in metrics.columns if c not in {m for m, _, _ in limits}]
    long = metrics.select(*kept, F.inline(F.array(*cells)))
    return long.withColumn("passed", F.when(F.col("operator") == ">=", F.col("value") >= F.col("limit")).otherwise(F.col("value") <= F.col("limit")))


def metric_deltas(new: DataFrame, old: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    joined = new.select(*keys, *metrics).join(old.select(*keys, *(F.col(m).alias(f"{m}__old") for m in metrics)), list(keys))
    return joined.select(*keys, *((F.col(m) - F.col(f"{m}__old")).alias(f"{m}_delta") for m in metrics))


def select_model(candidates: DataFrame, eligible: Column, keys: Sequence[str], id_: str) -> DataFrame:
    """The best eligible candidate (of all, if none is) by ``keys``, then the lowest id."""
    order = [F.desc("eligible"), *(F.desc(k) for k in keys), F.asc(id_)]
    return _first(candidates.withColumn("eligible", eligible), [], order)
