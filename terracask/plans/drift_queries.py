"""Drift and error-profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift, metrics, patches
from .adapters import PATCH_PX, SCORES, patch_px, scores
from .metric_queries import _PRF, THRESHOLD, _conf


def _rounded(df, places, *columns):
    return df.withColumns({c: F.round(c, places) for c in columns})


def _features(spark, sf_dir):
    """Every position of the vectors as a feature."""
    return patch_px(spark, sf_dir).select(F.format_string("pos%02d__value", F.col("channel") * 16 + F.col("px")).alias("feature"), "split", "value")


DRIFT = ("reference_mean", "comparison_mean", "smd", "psi", "jsd")


def drift_table(spark, sf_dir):
    table = drift.drift_table(_features(spark, sf_dir), "train", "test")
    return _rounded(table.withColumn("severe", drift.severe()), 6, *DRIFT)


def drift_topk(spark, sf_dir):
    """The three features of the largest SMD: a top-k report."""
    return _rounded(drift.top_features(drift.drift_table(_features(spark, sf_dir), "train", "test"), "smd", 3).select("feature", "smd"), 6, "smd")


def _importances(table):
    return table.select("feature", ((F.substring("feature", 4, 2).cast("int") + 1) / F.lit(2080.0)).alias("importance")).where("feature <> 'pos63__value'")


def drift_weighted(spark, sf_dir):
    """Drift weighted by importances, 0 for the feature that has none."""
    table = drift.drift_table(_features(spark, sf_dir), "train", "test").select("feature", "smd")
    return _rounded(drift.weighted(table, _importances(table)), 6, "smd", "importance", "importance_weighted_smd")


def drift_ablation_sets(spark, sf_dir):
    return drift.ablation_sets(drift.drift_table(_features(spark, sf_dir), "train", "test"), "smd", (10, 20))


def patch_summary_5stat(spark, sf_dir):
    return _rounded(patches.summarize(patch_px(spark, sf_dir), ["vec_id", "channel"], patches.FIVE), 6, "mean", "std")


def patch_summary_9stat(spark, sf_dir):
    return _rounded(patches.summarize(patch_px(spark, sf_dir), ["vec_id", "channel"], patches.NINE), 6, "mean", "std", "p10", "p25", "p75", "p90")


def feature_names(spark, sf_dir):
    """Named long features of every patch, with the channel and statistic read back from the name."""
    from ..functions.scalars import split_feature

    long = patches.feature_table(patches.summarize(patch_px(spark, sf_dir), ["vec_id", "channel"], ("min", "max")), "vec_id", "channel", ("min", "max"))
    channel, stat = split_feature(F.col("feature"))
    return long.withColumns({"channel": channel, "statistic": stat})


def channel_moments(spark, sf_dir):
    """Mergeable running statistics of each channel: count, mean, deviation, range."""
    px = patch_px(spark, sf_dir)
    out = px.groupBy("channel").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    return _rounded(out, 6, "mean", "std")


def _predicted(spark, sf_dir):
    return metrics.with_prediction(scores(spark, sf_dir), THRESHOLD)


def error_profile(spark, sf_dir):
    out = metrics.prf(metrics.confusion(_predicted(spark, sf_dir), ["aoi_id", "role"]))
    return _rounded(out.withColumn("positive_rate", (F.col("tp") + F.col("fn")) / F.col("n")), 9, "precision", "recall", "f1", "fnr", "fpr", "positive_rate")


def error_analysis(spark, sf_dir):
    p = _predicted(spark, sf_dir).withColumn("loss_fraction", (F.col("row_off") % 97) / F.lit(96.0))
    return _rounded(drift.error_analysis(p, ["role", "aoi_id"], loss="loss_fraction"), 9, "mean_probability", "mean_loss_fraction")


def spatial_error_grid(spark, sf_dir):
    return _rounded(drift.spatial_error_grid(_predicted(spark, sf_dir), ["role", "aoi_id"]), 9, "positive_rate", "error_rate")


def prevalence_ratio(spark, sf_dir):
    return _rounded(drift.prevalence_ratio(scores(spark, sf_dir), "role", "geographic_holdout", "dataset_development"), 9, "reference_prevalence", "comparison_prevalence", "ratio")


QUERIES = {
    f.__name__: f
    for f in (
        drift_table, drift_topk, drift_weighted, drift_ablation_sets, patch_summary_5stat, patch_summary_9stat, feature_names, channel_moments,
        error_profile, error_analysis, spatial_error_grid, prevalence_ratio,
    )
}

_DRIFT = f"""WITH {PATCH_PX},
f AS (SELECT printf('pos%02d__value', channel * 16 + px) AS feature, split, value FROM patch_px WHERE split IN ('train', 'test')),
v AS (SELECT feature, list(value ORDER BY value) AS v, count(*) AS n FROM f GROUP BY feature),
h AS (SELECT feature, v, n, unnest(range(11)) AS i FROM v),
q AS (SELECT feature, i, v[lo + 1] AS a, v[least(lo + 2, n)] AS b, w FROM (SELECT *, floor((n - 1) * (CASE WHEN i = 10 THEN 1 ELSE i * 0.1::DOUBLE END))::BIGINT AS lo, (n - 1) * (CASE WHEN i = 10 THEN 1 ELSE i * 0.1::DOUBLE END) - floor((n - 1) * (CASE WHEN i = 10 THEN 1 ELSE i * 0.1::DOUBLE END)) AS w FROM h)),
e AS (SELECT feature, list_sort(list_distinct(list(CASE WHEN w < 0.5 THEN a + (b - a) * w ELSE b - (b - a) * (1 - w) END))) AS e FROM q GROUP BY feature),
k AS (SELECT feature, split, len(list_filter(e[2:len(e) - 1], lambda x: value >= x)) AS bin FROM f JOIN e USING (feature)),
g AS (SELECT feature, unnest(range(len(e) - 1)) AS bin FROM e),
c AS (SELECT g.feature, g.bin, count(*) FILTER (split = 'train') + 1e-6::DOUBLE AS n0, count(*) FILTER (split = 'test') + 1e-6::DOUBLE AS n1 FROM g LEFT JOIN k ON g.feature = k.feature AND g.bin = k.bin GROUP BY ALL),
s AS (SELECT feature, n0 / sum(n0) OVER (PARTITION BY feature) AS p, n1 / sum(n1) OVER (PARTITION BY feature) AS q FROM c),
d AS (SELECT feature, sum((q - p) * ln(q / p)) AS psi, sum(p * log2(p / ((p + q) / 2))) / 2 + sum(q * log2(q / ((p + q) / 2))) / 2 AS jsd FROM s GROUP BY feature),
m AS (SELECT feature, avg(value) FILTER (split = 'train') AS reference_mean, avg(value) FILTER (split = 'test') AS comparison_mean,
  sqrt((var_pop(value) FILTER (split = 'train') + var_pop(value) FILTER (split = 'test')) / 2) AS sd FROM f GROUP BY feature),
t AS (SELECT feature, reference_mean, comparison_mean, CASE WHEN sd > 1e-6::DOUBLE THEN abs(comparison_mean - reference_mean) / sd ELSE 0 END AS smd, psi, jsd FROM m JOIN d USING (feature))"""
_STATS = "round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS min, max(value) AS max, median(value) AS median"
_TYPED = f"""WITH {SCORES}, p AS (SELECT *, (probability >= {THRESHOLD}::DOUBLE)::INT AS pr FROM scores)"""

SQL = {
    "drift_table": f"{_DRIFT} SELECT feature, round(reference_mean, 6) AS reference_mean, round(comparison_mean, 6) AS comparison_mean, round(smd, 6) AS smd, round(psi, 6) AS psi, round(jsd, 6) AS jsd, smd >= 0.8 OR psi >= 0.25 OR jsd >= 0.1 AS severe FROM t",
    "drift_topk": f"{_DRIFT} SELECT feature, round(smd, 6) AS smd FROM t ORDER BY t.smd DESC, feature LIMIT 3",
    "drift_weighted": f"{_DRIFT}, i AS (SELECT feature, CASE WHEN feature = 'pos63__value' THEN 0 ELSE (substr(feature, 4, 2)::INT + 1) / 2080::DOUBLE END AS imp, smd FROM t) SELECT feature, round(smd, 6) AS smd, round(imp, 6) AS importance, round(smd * imp, 6) AS importance_weighted_smd FROM i",
    "drift_ablation_sets": f"{_DRIFT}, r AS (SELECT feature, row_number() OVER (ORDER BY smd DESC, feature)::INTEGER AS rank FROM t) SELECT feature, rank, n_removed FROM r, (VALUES (10), (20)) s(n_removed) WHERE rank <= n_removed",
    "patch_summary_5stat": f"WITH {PATCH_PX} SELECT vec_id, channel, {_STATS} FROM patch_px GROUP BY vec_id, channel",
    "patch_summary_9stat": f"WITH {PATCH_PX} SELECT vec_id, channel, {_STATS}, " + ", ".join(f"round(quantile_cont(value, {p / 100}), 6) AS p{p}" for p in (10, 25, 75, 90)) + " FROM patch_px GROUP BY vec_id, channel",
    "feature_names": f"WITH {PATCH_PX}, s AS (SELECT vec_id, channel::VARCHAR AS channel, min(value) AS lo, max(value) AS hi FROM patch_px GROUP BY ALL) SELECT vec_id, channel, 'min' AS statistic, channel || '__min' AS feature, lo AS value FROM s UNION ALL SELECT vec_id, channel, 'max', channel || '__max', hi FROM s",
    "channel_moments": f"WITH {PATCH_PX} SELECT channel, count(value)::BIGINT AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS min, max(value) AS max FROM patch_px GROUP BY channel",
    "error_profile": f"WITH {SCORES}, {_conf('aoi_id, role')} SELECT *, {_PRF}, round((tp + fn)::DOUBLE / n, 9) AS positive_rate FROM c",
    "error_analysis": f"{_TYPED} SELECT role, aoi_id, CASE WHEN target = 1 AND pr = 1 THEN 'TP' WHEN target = 0 AND pr = 1 THEN 'FP' WHEN target = 1 THEN 'FN' ELSE 'TN' END AS error_type, count(*)::BIGINT AS n, round(avg(probability), 9) AS mean_probability, round(avg((row_off % 97) / 96::DOUBLE), 9) AS mean_loss_fraction FROM p GROUP BY ALL",
    "spatial_error_grid": f"{_TYPED} SELECT role, aoi_id, row_off // 512 AS grid_row, col_off // 512 AS grid_col, count(*)::BIGINT AS n, round(avg(target), 9) AS positive_rate, count(*) FILTER (target = 0 AND pr = 1)::BIGINT AS fp, count(*) FILTER (target = 1 AND pr = 0)::BIGINT AS fn, round(count(*) FILTER (target <> pr)::DOUBLE / count(*), 9) AS error_rate FROM p GROUP BY ALL",
    "prevalence_ratio": f"WITH {SCORES} SELECT round(avg(target) FILTER (role = 'dataset_development'), 9) AS reference_prevalence, round(avg(target) FILTER (role = 'geographic_holdout'), 9) AS comparison_prevalence, round((avg(target) FILTER (role = 'geographic_holdout')) / (avg(target) FILTER (role = 'dataset_development')), 9) AS ratio FROM scores",
}
