"""Sinks: manifests, reports, map features, JSON line shards, models and run folders.

All go through Spark's writers and commit protocol, so nothing is half written; existing
output is an error unless ``overwrite`` is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.relational import shards


def _mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def manifest(df: DataFrame, path: str, fields: Sequence[str], overwrite: bool = False, single: bool = False) -> None:
    """CSV with exactly ``fields``, in order, and a header also where there are no rows."""
    out = df.select(*fields)
    (out.coalesce(1) if single else out).write.mode(_mode(overwrite)).option("header", True).csv(path)


def report(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """A one-row report as JSON."""
    df.coalesce(1).write.mode(_mode(overwrite)).json(path)


def geojson(features: DataFrame, path: str, feature: str = "feature", overwrite: bool = False) -> None:
    """Newline-delimited GeoJSON features, as many files as partitions."""
    features.select(F.col(feature).alias("value")).write.mode(_mode(overwrite)).text(path)


def feature_collection(features: DataFrame, path: str, feature: str = "feature", overwrite: bool = False, most: int = 10_000) -> None:
    """FeatureCollection documents of about ``most`` features at most, dealt out by their hash, for
    viewers that want whole documents."""
    documents = max(1, -(-features.count() // most))
    whole = features.groupBy(F.pmod(F.xxhash64(feature), F.lit(documents)).alias("p")).agg(F.array_join(F.sort_array(F.collect_list(feature)), ",").alias("f"))
    text = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.col("f"), F.lit("]}"))
    whole.select(text.alias("value")).write.mode(_mode(overwrite)).text(path)


def json_line_shards(df: DataFrame, path: str, records: int = 500, overwrite: bool = False, text: str | None = None, keys: Sequence[str] = ()) -> None:
    """JSON lines in files of at most ``records``. Rows whose ``text`` is blank are left out; no row is
    an error. With numeric ``keys``, shards are numbered in their order, from ``part-00001``, each a
    folder of its own (``shard=part-00001``)."""
    kept = df if text is None else df.where(F.length(F.trim(text)) > 0)
    if kept.limit(1).count() == 0:
        raise ValueError("no records to shard")
    if not keys:
        kept.write.mode(_mode(overwrite)).option("maxRecordsPerFile", records).json(path)
        return
    numbered = shards(kept.withColumn("__one", F.lit(1)), "__one", keys, records).withColumnRenamed("shard_name", "shard__name").drop("__one", "shard")
    numbered.withColumnRenamed("shard__name", "shard").repartition("shard").sortWithinPartitions(*keys).write.mode(_mode(overwrite)).partitionBy("shard").json(path)


def tensor_payload(id_columns: Sequence[str], tensor: str) -> Column:
    return F.to_json(F.struct(*id_columns, F.col(tensor).alias("features")))


def model(nodes: DataFrame, metadata: DataFrame, path: str, overwrite: bool = False) -> None:
    nodes.write.mode(_mode(overwrite)).parquet(f"{path}/nodes")
    report(metadata, f"{path}/metadata", overwrite)


def run_folder(path: str, predictions: DataFrame, rejected: DataFrame, summary: DataFrame, report_: DataFrame, overwrite: bool = False) -> None:
    for name, df in (("predictions", predictions), ("rejected", rejected), ("aoi_summary", summary)):
        df.write.mode(_mode(overwrite)).parquet(f"{path}/{name}")
    report(report_, f"{path}/run_report", overwrite)
