"""Quality check suites of sources, labels, model selection, experiments and drift; grid alignment."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import checks as ch
from ..operators import drift, metrics, raster, relational
from .adapters import SCORES, scores, table
from .drift_queries import _DRIFT, _features
from .metric_queries import THRESHOLD, _conf
from .model_queries import _empty, _rows, _unique
from .raster_queries import _LABEL, _label_px


def _grids(spark, sf_dir, shift: float):
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    left = k * F.lit(10.0) + F.when(k % 5 == 0, F.lit(shift)).otherwise(F.lit(0.0))
    return n.select(
        F.col("n_name").alias("aoi_id"), F.lit(32719).alias("epsg"), left.alias("left"), (k * F.lit(20.0)).alias("top"), F.lit(10.0).alias("resolution"),
        (k + 30).alias("width"), (k + F.when((k % 7 == 0) & F.lit(shift > 0), 1).otherwise(0)).alias("height"),
    )


def grid_alignment(spark, sf_dir):
    """Grids against a copy with some origins and heights moved."""
    return raster.aligned(_grids(spark, sf_dir, 0.0), _grids(spark, sf_dir, 0.5))


def dq_source_rasters(spark, sf_dir):
    """Ranges and key set of the tree cover and loss sources."""
    l, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    px = l.join(p, l.l_partkey == p.p_partkey).select("l_partkey", "l_returnflag", (F.col("p_size") * 2).alias("tree"), (F.col("l_suppkey") % 26).alias("loss"))
    keys = relational.key_audit(p.select(F.col("p_partkey").alias("l_partkey")), l, ["l_partkey"])
    rows = ch.run_checks(px, [ch.Check("treecover_range", F.col("tree").between(0, 100)), ch.Check("lossyear_range", F.col("loss").between(0, 25)), ch.Check("loss_below_20", F.col("loss") < 20)])
    return ch.union(rows, ch.empty_check(keys, "key_set"))


def dq_labels(spark, sf_dir):
    """Label values, and eligible pixels equal to positives and negatives together."""
    px = _label_px(spark, sf_dir)
    totals = px.groupBy("aoi_id").agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n"), F.count_if(F.col("label") != 255).alias("e"))
    return ch.union(ch.run_checks(px, [ch.Check("label_values", F.col("label").isin(0, 1, 255))]), ch.empty_check(totals.where("p + n <> e"), "eligible_is_sum"))


def _candidates(spark, sf_dir):
    p = metrics.with_prediction(scores(spark, sf_dir), THRESHOLD)
    return metrics.prf(metrics.confusion(p, ["aoi_id"]))


def dq_model_selection(spark, sf_dir):
    """Exactly one candidate is selected, the best one; deltas to another threshold and gates as computed anew."""
    c = _candidates(spark, sf_dir)
    best = metrics.select_model(c, F.col("recall") >= 0.6, ["f1"], "aoi_id").select("aoi_id", F.lit(True).alias("chosen"))
    flagged = c.join(best, "aoi_id", "left").withColumns({"selected": F.coalesce("chosen", F.lit(False)), "eligible": F.col("recall") >= 0.6, "number": F.dense_rank().over(Window.orderBy("aoi_id"))})  # a row per area
    old = metrics.prf(metrics.confusion(metrics.with_prediction(scores(spark, sf_dir), 0.4), ["aoi_id"]))
    deltas = metrics.metric_deltas(c, old, ["aoi_id"], ["precision", "recall"])
    p = metrics.with_prediction(scores(spark, sf_dir), THRESHOLD).withColumn("other", (F.col("probability") >= 0.4).cast("int"))

    def shares(column):
        return F.avg(F.when(F.col(column) == 1, F.col("target"))), F.avg(F.when(F.col("target") == 1, F.col(column)))

    (p1, r1), (p0, r0) = shares("prediction"), shares("other")
    again = p.groupBy("aoi_id").agg((p1 - p0).alias("precision_delta"), (r1 - r0).alias("recall_delta"))
    return ch.union(ch.selection_checks(flagged, "selected", "eligible", ["f1"], "number"), ch.recompute_check(deltas, again, ["aoi_id"], ["precision_delta", "recall_delta"], "deltas_reproduce"))


def dq_experiments(spark, sf_dir):
    """Ablation sets are complete, without repeats, and of known features."""
    sets = drift.ablation_sets(drift.drift_table(_features(spark, sf_dir), "train", "test"), "smd", (10, 20))
    wrong = sets.groupBy("n_removed").agg(F.count(F.lit(1)).alias("n")).where("n <> n_removed")
    known = _features(spark, sf_dir).select("feature").distinct()
    return ch.union(ch.empty_check(wrong, "sets_complete"), ch.unique_check(sets, "no_repeats", ["n_removed", "feature"]), ch.empty_check(sets.join(known, "feature", "left_anti"), "known_features"))


def dq_drift(spark, sf_dir):
    """Drift statistics are not negative, divergence is at most 1, and error groups add up."""
    table_ = drift.drift_table(_features(spark, sf_dir), "train", "test")
    p = metrics.with_prediction(scores(spark, sf_dir), THRESHOLD)
    parts = drift.error_analysis(p, ["role"]).groupBy("role").agg(F.sum("n").alias("m"))
    gap = parts.join(p.groupBy("role").agg(F.count(F.lit(1)).alias("n")), "role").where("m <> n")
    rows = ch.run_checks(table_, [ch.Check("not_negative", (F.col("smd") >= 0) & (F.col("psi") >= 0) & (F.col("jsd") >= 0)), ch.Check("jsd_at_most_1", F.col("jsd") <= 1)])
    weighed = drift.weighted(table_, table_.select("feature", F.lit(0.5).alias("importance")))
    identity = weighed.where(~(F.abs(F.col("importance_weighted_smd") - F.col("smd") / 2) <= 1e-12))
    return ch.union(rows, ch.empty_check(gap, "partition_totals"), ch.empty_check(identity, "weighted_identity"))


QUERIES = {f.__name__: f for f in (grid_alignment, dq_source_rasters, dq_labels, dq_model_selection, dq_experiments, dq_drift)}
SQL = {
    "grid_alignment": "SELECT n_name AS aoi_id, NOT (n_nationkey % 5 = 0 OR n_nationkey % 7 = 0) AS same FROM nation",
    "dq_source_rasters": "WITH px AS (SELECT p_size * 2 AS tree, l_suppkey % 26 AS loss FROM lineitem JOIN part ON l_partkey = p_partkey) "
    + _rows("px", [("treecover_range", "tree BETWEEN 0 AND 100"), ("lossyear_range", "loss BETWEEN 0 AND 25"), ("loss_below_20", "loss < 20")])
    + " UNION ALL "
    + _empty("(SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem) UNION ALL (SELECT l_partkey FROM lineitem EXCEPT SELECT p_partkey FROM part)", "key_set"),
    "dq_labels": f"WITH {_LABEL} {_rows('lpx', [('label_values', 'label IN (0, 1, 255)')])} UNION ALL {_empty("SELECT aoi_id FROM lpx GROUP BY aoi_id HAVING count(*) FILTER (label = 1) + count(*) FILTER (label = 0) <> count(*) FILTER (label <> 255)", 'eligible_is_sum')}",
    "dq_model_selection": f"""WITH {SCORES}, {_conf('aoi_id')}, {_conf('aoi_id', 0.4, 'o')}, f AS (SELECT aoi_id, 2 * tp / (2 * tp + fp + fn)::DOUBLE AS f1, tp / (tp + fn)::DOUBLE >= 0.6 AS ok, tp / (tp + fp)::DOUBLE AS p, tp / (tp + fn)::DOUBLE AS r FROM c),
  s AS (SELECT *, row_number() OVER (ORDER BY ok DESC, f1 DESC, aoi_id) = 1 AS selected FROM f), g AS (SELECT aoi_id, tp / (tp + fp)::DOUBLE AS p, tp / (tp + fn)::DOUBLE AS r FROM o), d AS (SELECT aoi_id, s.p - g.p AS dp, s.r - g.r AS dr FROM s JOIN g USING (aoi_id)),
  a AS (SELECT aoi_id, avg(target) FILTER (probability >= {THRESHOLD}::DOUBLE) - avg(target) FILTER (probability >= 0.4::DOUBLE) AS dp, avg((probability >= {THRESHOLD}::DOUBLE)::INT) FILTER (target = 1) - avg((probability >= 0.4::DOUBLE)::INT) FILTER (target = 1) AS dr FROM scores GROUP BY aoi_id)
  {_empty("SELECT 1 FROM s HAVING count(*) FILTER (selected) <> 1", "one_selected")} UNION ALL {_empty("SELECT * FROM s x, s y WHERE x.selected AND (y.ok > x.ok OR (y.ok = x.ok AND y.f1 > x.f1))", "ranking_reproduces")}
  UNION ALL {_empty("SELECT * FROM d FULL JOIN a USING (aoi_id) WHERE NOT coalesce(abs(d.dp - a.dp) <= 1e-12 AND abs(d.dr - a.dr) <= 1e-12, false)", "deltas_reproduce")}""",
    "dq_experiments": f"{_DRIFT}, r AS (SELECT feature, row_number() OVER (ORDER BY smd DESC, feature) AS rank FROM t), ab AS (SELECT feature, n_removed FROM r, (VALUES (10), (20)) v(n_removed) WHERE rank <= n_removed) "
    + _empty("SELECT n_removed FROM ab GROUP BY n_removed HAVING count(*) <> n_removed", "sets_complete")
    + " UNION ALL " + _unique("ab", "no_repeats", "n_removed, feature") + " UNION ALL " + _empty("SELECT feature FROM ab WHERE feature NOT IN (SELECT feature FROM t)", "known_features"),
    "dq_drift": f"{_DRIFT}, {SCORES} {_rows('t', [('not_negative', 'smd >= 0 AND psi >= 0 AND jsd >= 0'), ('jsd_at_most_1', 'jsd <= 1')])} UNION ALL {_empty("SELECT role FROM (SELECT role, sum(n) AS m FROM (SELECT role, target, probability >= 0.536::DOUBLE AS pr, count(*) AS n FROM scores GROUP BY ALL) GROUP BY role) g JOIN (SELECT role, count(*) AS n FROM scores GROUP BY role) USING (role) WHERE m <> n", 'partition_totals')} UNION ALL {_empty("SELECT feature FROM t WHERE NOT abs(smd * 0.5 - smd / 2) <= 1e-12", 'weighted_identity')}",
}
