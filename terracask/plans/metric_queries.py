"""Metric queries over the scored patches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as m
from .adapters import SCORES, scores

THRESHOLD = 0.536
GATES = (("recall", ">=", 0.75), ("precision", ">=", 0.5), ("fpr", "<=", 0.10))


def _predicted(spark, sf_dir, threshold=THRESHOLD):
    return m.with_prediction(scores(spark, sf_dir), threshold)


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in columns})


PRF = ("precision", "recall", "f1", "fnr", "fpr")


def aoi_alert_summary(spark, sf_dir):
    return _rounded(m.alert_summary(_predicted(spark, sf_dir)), "mean_probability", "alert_rate")


def confusion_by_role(spark, sf_dir):
    return m.confusion(_predicted(spark, sf_dir), ["role"])


def prf_by_aoi(spark, sf_dir):
    return _rounded(m.prf(m.confusion(_predicted(spark, sf_dir), ["aoi_id"])), *PRF)


def roc_auc_by_aoi(spark, sf_dir):
    return _rounded(m.roc_auc(scores(spark, sf_dir), ["aoi_id"]), "roc_auc")


def average_precision_by_aoi(spark, sf_dir):
    return _rounded(m.average_precision(scores(spark, sf_dir), ["aoi_id"]), "average_precision")


def worst_aoi_average_precision(spark, sf_dir):
    by = m.average_precision(scores(spark, sf_dir), ["role", "aoi_id"])
    return by.groupBy("role").agg(F.round(F.min("average_precision"), 9).alias("worst_aoi_pr_auc"))


def _swept(spark, sf_dir):
    return m.threshold_sweep(scores(spark, sf_dir), ["role"])


def threshold_sweep(spark, sf_dir):
    return _rounded(_swept(spark, sf_dir), *PRF)


def threshold_argmax_recall(spark, sf_dir):
    return _rounded(m.select_threshold(_swept(spark, sf_dir), ["role"], recall=0.75), *PRF)


def threshold_argmax_precision(spark, sf_dir):
    return _rounded(m.select_threshold(_swept(spark, sf_dir), ["role"], precision=0.75), *PRF)


def threshold_least_violation(spark, sf_dir):
    return _rounded(m.least_violation(_swept(spark, sf_dir), 0.9, 0.05, ["role"]), *PRF, "violation")


def quality_gates(spark, sf_dir):
    table = m.prf(m.confusion(_predicted(spark, sf_dir), ["role"])).select("role", "recall", "precision", "fpr")
    return _rounded(m.gates(table, GATES), "value")


def metric_deltas(spark, sf_dir):
    new = m.prf(m.confusion(_predicted(spark, sf_dir), ["role"]))
    old = m.prf(m.confusion(_predicted(spark, sf_dir, 0.4), ["role"]))
    return _rounded(m.metric_deltas(new, old, ["role"], ["precision", "recall", "f1"]), "precision_delta", "recall_delta", "f1_delta")


def model_select(spark, sf_dir):
    """Each area plays a candidate: the best average precision among those with enough recall."""
    base = _predicted(spark, sf_dir)
    table = m.average_precision(base, ["aoi_id"]).join(m.prf(m.confusion(base, ["aoi_id"])), "aoi_id")
    best = m.select_model(table, F.col("recall") >= 0.6, ["average_precision", "f1"], "aoi_id")
    return _rounded(best.select("aoi_id", "average_precision", "f1", "recall", "eligible"), "average_precision", "f1", "recall")


QUERIES = {
    f.__name__: f
    for f in (
        aoi_alert_summary, confusion_by_role, prf_by_aoi, roc_auc_by_aoi, average_precision_by_aoi, worst_aoi_average_precision, threshold_sweep,
        threshold_argmax_recall, threshold_argmax_precision, threshold_least_violation, quality_gates, metric_deltas, model_select,
    )
}


def _conf(by: str, threshold: float = THRESHOLD, name: str = "c") -> str:
    return f"""{name} AS (SELECT {by}, count(*)::BIGINT AS n, count(*) FILTER (target = 0 AND probability < {threshold}::DOUBLE)::BIGINT AS tn,
  count(*) FILTER (target = 0 AND probability >= {threshold}::DOUBLE)::BIGINT AS fp, count(*) FILTER (target = 1 AND probability < {threshold}::DOUBLE)::BIGINT AS fn,
  count(*) FILTER (target = 1 AND probability >= {threshold}::DOUBLE)::BIGINT AS tp FROM scores GROUP BY {by})"""


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0 ELSE ({a})::DOUBLE / ({b}) END"


_P, _R, _F1, _FNR, _FPR = _ratio("tp", "tp + fp"), _ratio("tp", "tp + fn"), _ratio("2 * tp", "2 * tp + fp + fn"), _ratio("fn", "tp + fn"), _ratio("fp", "fp + tn")
_PRF = f"round({_P}, 9) AS precision, round({_R}, 9) AS recall, round({_F1}, 9) AS f1, round({_FNR}, 9) AS fnr, round({_FPR}, 9) AS fpr"
_RAW = f"{_P} AS precision, {_R} AS recall, {_F1} AS f1, {_FNR} AS fnr, {_FPR} AS fpr"


def _ap(by: str, name: str = "ap") -> str:
    return f"""{name}_s AS (SELECT {by}, probability, sum(target) AS pos, count(*) AS n FROM scores GROUP BY {by}, probability),
{name}_w AS (SELECT {by}, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS m FROM {name}_s WINDOW w AS (PARTITION BY {by} ORDER BY probability DESC)),
{name} AS (SELECT {by}, sum(pos * tp::DOUBLE / m) / sum(pos) AS average_precision FROM {name}_w GROUP BY {by})"""


_SWEPT = f"""WITH {SCORES},
g AS (SELECT CASE WHEN k = 1000 THEN 1::DOUBLE ELSE k * 0.001::DOUBLE END AS threshold FROM range(1001) r(k)),
c AS (SELECT role, threshold, count(*) FILTER (target = 1 AND probability >= threshold)::BIGINT AS tp, count(*) FILTER (target = 0 AND probability >= threshold)::BIGINT AS fp,
  count(*) FILTER (target = 1 AND probability < threshold)::BIGINT AS fn, count(*) FILTER (target = 0 AND probability < threshold)::BIGINT AS tn FROM scores, g GROUP BY role, threshold),
s AS (SELECT *, {_RAW} FROM c)"""
_ROUNDED = "role, threshold, tp, fp, fn, tn, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, round(fnr, 9) AS fnr, round(fpr, 9) AS fpr"


def _argmax(ok: str) -> str:
    return f"""{_SWEPT} SELECT {_ROUNDED}, eligible FROM (SELECT *, {ok} AS eligible, row_number() OVER (PARTITION BY role ORDER BY {ok} DESC, f1 DESC, precision DESC, threshold DESC) AS rn FROM s) WHERE rn = 1"""


SQL = {
    "aoi_alert_summary": f"""WITH {SCORES} SELECT aoi_id, count(*)::BIGINT AS patch_count, sum((probability >= {THRESHOLD}::DOUBLE)::INT)::BIGINT AS alert_count,
  round(avg(probability), 9) AS mean_probability, max(probability) AS max_probability, round(avg((probability >= {THRESHOLD}::DOUBLE)::INT), 9) AS alert_rate FROM scores GROUP BY aoi_id""",
    "confusion_by_role": f"WITH {SCORES}, {_conf('role')} SELECT * FROM c",
    "prf_by_aoi": f"WITH {SCORES}, {_conf('aoi_id')} SELECT *, {_PRF} FROM c",
    "roc_auc_by_aoi": f"""WITH {SCORES}, r AS (SELECT aoi_id, target, rank() OVER w + (count(*) OVER (PARTITION BY aoi_id, probability) - 1) / 2.0 AS rk FROM scores WINDOW w AS (PARTITION BY aoi_id ORDER BY probability)),
  s AS (SELECT aoi_id, sum(rk) FILTER (target = 1) AS rs, sum(target)::DOUBLE AS p, count(*) - sum(target)::DOUBLE AS n FROM r GROUP BY aoi_id)
  SELECT aoi_id, round((rs - p * (p + 1) / 2) / (p * n), 9)::DOUBLE AS roc_auc FROM s""",
    "average_precision_by_aoi": f"WITH {SCORES}, {_ap('aoi_id')} SELECT aoi_id, round(average_precision, 9) AS average_precision FROM ap",
    "worst_aoi_average_precision": f"WITH {SCORES}, {_ap('role, aoi_id')} SELECT role, round(min(average_precision), 9) AS worst_aoi_pr_auc FROM ap GROUP BY role",
    "threshold_sweep": f"{_SWEPT} SELECT {_ROUNDED} FROM s",
    "threshold_argmax_recall": _argmax("recall >= 0.75::DOUBLE"),
    "threshold_argmax_precision": _argmax("precision >= 0.75::DOUBLE"),
    "threshold_least_violation": f"""{_SWEPT}, v AS (SELECT *, greatest(0, 0.9::DOUBLE - recall) + greatest(0, fpr - 0.05::DOUBLE) AS violation FROM s)
  SELECT {_ROUNDED}, round(violation, 9) AS violation FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY violation, f1 DESC, threshold DESC) AS rn FROM v) WHERE rn = 1""",
    "quality_gates": f"""WITH {SCORES}, {_conf('role')}, p AS (SELECT role, {_RAW} FROM c),
  l AS (SELECT role, unnest(['recall', 'precision', 'fpr']) AS metric, unnest(['>=', '>=', '<=']) AS operator, unnest([0.75, 0.5, 0.1])::DOUBLE AS "limit", unnest([recall, precision, fpr]) AS value FROM p)
  SELECT role, metric, operator, "limit", round(value, 9) AS value, CASE WHEN operator = '>=' THEN value >= "limit" ELSE value <= "limit" END AS passed FROM l""",
    "metric_deltas": f"""WITH {SCORES}, {_conf('role')}, {_conf('role', 0.4, 'o')}, a AS (SELECT role, {_RAW} FROM c), b AS (SELECT role, {_RAW} FROM o)
  SELECT role, round(a.precision - b.precision, 9) AS precision_delta, round(a.recall - b.recall, 9) AS recall_delta, round(a.f1 - b.f1, 9) AS f1_delta FROM a JOIN b USING (role)""",
    "model_select": f"""WITH {SCORES}, {_ap('aoi_id')}, {_conf('aoi_id')}, p AS (SELECT aoi_id, {_RAW} FROM c)
  SELECT aoi_id, round(average_precision, 9) AS average_precision, round(f1, 9) AS f1, round(recall, 9) AS recall, recall >= 0.6::DOUBLE AS eligible
  FROM ap JOIN p USING (aoi_id) ORDER BY recall >= 0.6::DOUBLE DESC, average_precision DESC, f1 DESC, aoi_id LIMIT 1""",
}
