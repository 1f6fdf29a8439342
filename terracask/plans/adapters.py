"""Views that give the star-schema test tables the roles of the engine's relations.

Each is a DataFrame function and the same definition as DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored patches from orders: key, aoi, role, offsets, probability and label."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    p = ((F.col("o_orderkey") * 7919 + F.col("o_custkey") * 104729) % 10007) / F.lit(10006.0)
    draw = ((F.col("o_orderkey") * 31 + F.col("o_custkey") * 17) % 997) / F.lit(997.0)
    role = (
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "geographic_holdout")
        .when(F.col("o_orderpriority") == "5-LOW", "final_geographic_holdout")
        .otherwise("dataset_development")
    )
    return o.select(
        F.col("o_orderkey").alias("patch_key"),
        F.col("o_orderpriority").alias("aoi_id"),
        role.alias("role"),
        ((F.col("o_orderkey") % 256) * 8).alias("row_off"),
        ((F.col("o_custkey") % 256) * 8).alias("col_off"),
        p.alias("probability"),
        (draw < p).cast("int").alias("target"),
    )


SCORES = """scores AS (
  SELECT o_orderkey AS patch_key, o_orderpriority AS aoi_id,
    CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'geographic_holdout' WHEN '5-LOW' THEN 'final_geographic_holdout' ELSE 'dataset_development' END AS role,
    (o_orderkey % 256) * 8 AS row_off, (o_custkey % 256) * 8 AS col_off,
    ((o_orderkey * 7919 + o_custkey * 104729) % 10007)::DOUBLE / 10006 AS probability,
    (((o_orderkey * 31 + o_custkey * 17) % 997)::DOUBLE / 997 < ((o_orderkey * 7919 + o_custkey * 104729) % 10007)::DOUBLE / 10006)::INTEGER AS target
  FROM orders)"""


def patch_px(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patch tensors in long form from embeddings: 4 channels of 16 pixels."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("pos", "value"))
    return e.select("vec_id", "label", split_of_label().alias("split"), F.floor(F.col("pos") / 16).cast("int").alias("channel"), (F.col("pos") % 16).alias("px"), F.col("value").cast("double").alias("value"))


def split_of_label():
    return F.when(F.col("label") <= 5, "train").when(F.col("label") <= 7, "validation").otherwise("test")


PATCH_PX = """patch_px AS (
  SELECT vec_id, label, CASE WHEN label <= 5 THEN 'train' WHEN label <= 7 THEN 'validation' ELSE 'test' END AS split,
    (pos // 16)::INTEGER AS channel, (pos % 16)::INTEGER AS px, value
  FROM (SELECT vec_id, label, unnest(range(len(embedding))) AS pos, unnest(embedding)::DOUBLE AS value FROM embeddings))"""

EXCLUDED_CLASSES = (0, 1, 3, 8, 9, 10, 11)


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene pixels from lineitem: aoi, cell, scene, class and two bands, unmasked."""
    l = table(spark, sf_dir, "lineitem")
    return l.select(
        F.col("l_returnflag").alias("aoi_id"),
        F.col("l_partkey").alias("cell"),
        F.col("l_linenumber").alias("scene"),
        (F.col("l_suppkey") % 12).cast("int").alias("scl"),
        (F.col("l_extendedprice") / F.lit(99991.0)).alias("nir"),
        (F.col("l_quantity") / F.lit(50.0)).alias("red"),
    )


PIXELS = """pixels AS (
  SELECT l_returnflag AS aoi_id, l_partkey AS cell, l_linenumber AS scene, (l_suppkey % 12)::INTEGER AS scl,
    l_extendedprice / 99991::DOUBLE AS nir, l_quantity / 50::DOUBLE AS red FROM lineitem)"""


def scene_px(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid pixels of scenes: group, scene and pixel (the part, so that a scene sees some of them)."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return l.join(o, l.l_orderkey == o.o_orderkey).select(
        F.col("o_orderpriority").alias("aoi_id"), (F.col("o_orderkey") % 12).alias("scene"), F.col("l_partkey").alias("pixel")
    )


SCENE_PX = """scene_px AS (
  SELECT o_orderpriority AS aoi_id, o_orderkey % 12 AS scene, l_partkey AS pixel
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AOI bounds from nations: boxes of 2 to 3 degrees on a lattice of 2.5 degrees."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    left = F.lit(-75.0) + (k % 5) * F.lit(2.5)
    bottom = F.lit(-18.0) + F.floor(k / 5) * F.lit(2.5)
    size = F.lit(2.0) + (k % 3) * F.lit(0.5)
    return n.select(k.alias("box_id"), F.col("n_name").alias("aoi_id"), left.alias("min_lon"), bottom.alias("min_lat"), (left + size).alias("max_lon"), (bottom + size).alias("max_lat"))


BOXES = """boxes AS (
  SELECT n_nationkey AS box_id, n_name AS aoi_id, -75 + (n_nationkey % 5) * 2.5::DOUBLE AS min_lon, -18 + (n_nationkey // 5) * 2.5::DOUBLE AS min_lat,
    -75 + (n_nationkey % 5) * 2.5::DOUBLE + 2 + (n_nationkey % 3) * 0.5::DOUBLE AS max_lon,
    -18 + (n_nationkey // 5) * 2.5::DOUBLE + 2 + (n_nationkey % 3) * 0.5::DOUBLE AS max_lat FROM nation)"""
