"""Dataset split queries over the scored patches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import splits
from .adapters import SCORES, scores

_HOLD = "role <> 'dataset_development'"
_BLOCKS = f"""WITH {SCORES},
b AS (SELECT *, row_off // 512 AS block_row, col_off // 512 AS block_col, row_off % 512 + 32 <= 512 AND col_off % 512 + 32 <= 512 AS inside_block FROM scores),
k AS (SELECT * FROM b WHERE {_HOLD} OR inside_block),
s AS (SELECT *, CASE WHEN NOT ({_HOLD}) THEN ('0x' || substr(sha256('42|' || aoi_id || '|' || block_row || '|' || block_col), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616 END AS block_score FROM k),
d AS (SELECT *, CASE role WHEN 'geographic_holdout' THEN 'test' WHEN 'final_geographic_holdout' THEN 'final_test' ELSE CASE WHEN block_score < 0.2::DOUBLE THEN 'validation' ELSE 'train' END END AS split FROM s)
"""


def _dataset(spark, sf_dir):
    blocked = splits.with_blocks(scores(spark, sf_dir))
    return splits.block_split(splits.drop_boundary(blocked, F.col("role") != "dataset_development"))


def spatial_block_split(spark, sf_dir):
    return _dataset(spark, sf_dir).select("patch_key", "aoi_id", "block_row", "block_col", "inside_block", "block_score", "split")


def split_summary(spark, sf_dir):
    return splits.split_summary(_dataset(spark, sf_dir))


def loao_folds(spark, sf_dir):
    return splits.loao_folds(scores(spark, sf_dir).select("patch_key", "aoi_id", "role"))


def boundary_drop_counts(spark, sf_dir):
    blocked = splits.with_blocks(scores(spark, sf_dir))
    return blocked.groupBy("aoi_id", "role").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("inside_block")).alias("crossing"))


QUERIES = {f.__name__: f for f in (spatial_block_split, split_summary, loao_folds, boundary_drop_counts)}
SQL = {
    "spatial_block_split": _BLOCKS + "SELECT patch_key, aoi_id, block_row, block_col, inside_block, block_score, split FROM d",
    "split_summary": _BLOCKS + "SELECT split, aoi_id, target, count(*)::BIGINT AS n FROM d GROUP BY GROUPING SETS ((split, aoi_id), (split, target), (split))",
    "loao_folds": f"""WITH {SCORES},
a AS (SELECT DISTINCT aoi_id FROM scores WHERE role = 'dataset_development'),
f AS (SELECT printf('fold_%02d', row_number() OVER (ORDER BY aoi_id)) AS fold_id, aoi_id AS validation_aoi FROM a)
SELECT patch_key, aoi_id, role, fold_id, validation_aoi, CASE WHEN aoi_id = validation_aoi THEN 'validation' ELSE 'train' END AS fold_split FROM scores, f WHERE role = 'dataset_development'
UNION ALL SELECT patch_key, aoi_id, role, CASE role WHEN 'geographic_holdout' THEN 'diagnostic' ELSE 'final' END, NULL, CASE role WHEN 'geographic_holdout' THEN 'diagnostic_holdout' ELSE 'final_holdout' END FROM scores WHERE role <> 'dataset_development'""",
    "boundary_drop_counts": f"""WITH {SCORES} SELECT aoi_id, role, count(*)::BIGINT AS n,
  count(*) FILTER (NOT (row_off % 512 + 32 <= 512 AND col_off % 512 + 32 <= 512))::BIGINT AS crossing FROM scores GROUP BY ALL""",
}
