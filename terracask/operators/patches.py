"""Patch tensors: named summary statistics, windows, ids and label counts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIVE = ("mean", "std", "min", "max", "median")
NINE = (*FIVE, "p10", "p25", "p75", "p90")


def statistic(name: str, value: Column) -> Column:
    """One of the known statistics; an error for any other name."""
    plain = {"mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max, "median": F.median}
    if name in plain:
        return plain[name](value)
    if name.startswith("p") and name[1:].isdigit():
        return F.percentile(value, int(name[1:]) / 100)
    raise ValueError(f"unknown statistic {name}")


def summarize(px: DataFrame, keys: Sequence[str], statistics: Sequence[str] = FIVE, value: str = "value") -> DataFrame:
    """A row per key with the statistics of its pixels (nulls left out)."""
    return px.groupBy(*keys).agg(*(statistic(s, F.col(value)).alias(s) for s in statistics))


def feature_table(summary: DataFrame, key: str, channel: str, statistics: Sequence[str]) -> DataFrame:
    """Long features (key, feature, value) named ``channel__statistic``."""
    cells = [F.struct(F.concat_ws("__", F.col(channel), F.lit(s)).alias("feature"), F.col(s).alias("value")) for s in statistics]
    return summary.select(key, F.inline(F.array(*cells)))


def windows(grids: DataFrame, size: int = 32, stride: int = 8, height: str = "height", width: str = "width") -> DataFrame:
    """All window offsets of each grid (none where it is smaller than a window)."""

    def offsets(extent: str) -> Column:
        last = F.col(extent) - size
        return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)).cast("int"), F.lit(stride))).otherwise(F.array().cast("array<int>"))

    rows = grids.withColumn("row_off", F.explode(offsets(height)))
    return rows.withColumn("col_off", F.explode(offsets(width)))


def raster_blocks(grids: DataFrame, size: int = 512, height: str = "height", width: str = "width") -> DataFrame:
    """The blocks that a raster is read in: offsets, and sizes cut off at the raster's edges."""
    rows = grids.withColumn("block_row_off", F.explode(F.sequence(F.lit(0), F.col(height) - 1, F.lit(size))))
    cells = rows.withColumn("block_col_off", F.explode(F.sequence(F.lit(0), F.col(width) - 1, F.lit(size))))
    return cells.withColumns({"block_height": F.least(F.lit(size), F.col(height) - F.col("block_row_off")), "block_width": F.least(F.lit(size), F.col(width) - F.col("block_col_off"))})


def window_valid_fraction(px: DataFrame, keys: Sequence[str], height: Column, width: Column, size: int = 32, stride: int = 8, valid: str = "valid") -> DataFrame:
    """Share of valid pixels of each window, as ``windows`` gives them, that holds a valid one.

    ``height`` and ``width``: the raster's, of each row. Pixels are summed first into blocks as
    large as fit into both size and stride; only the block sums are copied to the windows that they
    lie in, so rows are copied (size/stride)**2 times per block, not per pixel.
    """
    unit = math.gcd(size, stride)
    blocked = px.where(F.col(valid)).groupBy(*keys, F.floor(F.col("row") / unit).cast("int").alias("br"), F.floor(F.col("col") / unit).cast("int").alias("bc"))
    blocks = blocked.agg(F.count(F.lit(1)).alias("n"), F.max(height).alias("__height"), F.max(width).alias("__width"))

    def origins(block: str, extent: str) -> Column:
        """Numbers of the windows that hold the block."""
        first = F.greatest(F.ceil((F.col(block) * unit + unit - size) / stride), F.lit(0)).cast("int")
        last = F.least(F.floor(F.col(block) * unit / stride), F.floor((F.col(extent) - size) / stride)).cast("int")
        return F.when(first <= last, F.sequence(first, F.greatest(first, last))).otherwise(F.array().cast("array<int>"))

    spread = blocks.withColumn("wr", F.explode(origins("br", "__height"))).withColumn("wc", F.explode(origins("bc", "__width")))
    summed = spread.groupBy(*keys, (F.col("wr") * stride).alias("row_off"), (F.col("wc") * stride).alias("col_off")).agg(F.sum("n").alias("valid_pixels"))
    return summed.withColumn("valid_fraction", F.col("valid_pixels") / float(size * size))


def footprint_inside(height: Column, width: Column, size: int = 32, row: str = "row_off", col: str = "col_off") -> Column:
    """Whether a patch lies within its raster."""
    return F.coalesce((F.col(row) >= 0) & (F.col(col) >= 0) & (F.col(row) + size <= height) & (F.col(col) + size <= width), F.lit(False))


def label_counts(px: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    """Positive and negative pixels of each patch and the positives' share (null without any)."""
    out = px.groupBy(*keys).agg(F.count_if(F.col(label) == 1).alias("positive"), F.count_if(F.col(label) == 0).alias("negative"))
    return out.withColumn("loss_fraction", F.try_divide(F.col("positive").cast("double"), F.col("positive") + F.col("negative")))


def binary_label(fraction: Column, threshold: float = 0.0) -> Column:
    """1 above the threshold; an error outside [0, 1]."""
    ok = (fraction >= 0) & (fraction <= 1)
    return F.when(ok, (fraction > threshold).cast("int")).when(fraction.isNull(), F.lit(None)).otherwise(F.raise_error(F.lit("fraction outside [0, 1]")))


#: Parts of a group that are capped by themselves first.
CAP_PARTS = 64


def seeded_cap(df: DataFrame, group: str, key: str, seed: int, most: int | None) -> DataFrame:
    """At most ``most`` rows per group, the first in a seeded hash order; all if None.

    The cap is this operator's purpose: a sample of fixed size per group. A group is capped in
    ``CAP_PARTS`` ranges of the hash first, so that none of its tasks holds it whole.
    """
    if most is None:
        return df
    hashed = df.withColumn("__h", F.sha2(F.concat_ws(":", F.lit(seed), F.col(group), F.col(key)), 256))
    hashed = hashed.withColumn("__part", F.conv(F.substring("__h", 1, 2), 16, 10).cast("int") % CAP_PARTS)
    for parts in ([group, "__part"], [group]):
        rank = F.row_number().over(Window.partitionBy(*parts).orderBy("__h", key))
        hashed = hashed.withColumn("__n", rank).where(F.col("__n") <= most).drop("__n")
    return hashed.drop("__h", "__part")
