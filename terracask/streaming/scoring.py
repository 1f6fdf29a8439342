"""JSON line scoring as a stream: an extension for continuous delivery of feature records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.trees import score


def scored_stream(spark: SparkSession, path: str, schema: str, nodes: DataFrame, features: Sequence[str], threshold: float) -> DataFrame:
    """Records that arrive as JSON line files below ``path``, with probability and prediction."""
    records = spark.readStream.schema(schema).json(path)
    scored = score(records, nodes, features)
    return scored.withColumns({"prediction": (F.col("probability") >= threshold).cast("int"), "threshold": F.lit(threshold)})


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All available records once, exactly once per file, to Parquet."""
    return df.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
