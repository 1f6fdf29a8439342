"""Raster map algebra on pixels in long form: masks, scaling, composites, indices, labels.

A pixel is a row (aoi, row, col or cell, ...), so map algebra is a projection, a composite
an aggregation, alignment an equi-join on the cell, and Catalyst prunes bands and areas.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import finite

#: Scene classes that mask a pixel, their nodata, reflectance scale, label codes.
EXCLUDED_CLASSES = (0, 1, 3, 8, 9, 10, 11)
CLASS_NODATA = 255
SCALE = 0.0001
NODATA = -9999.0
LABEL_NODATA = 255
EPSILON = 1e-6
NDVI_LIMIT, CHANGE_LIMIT = 1.0001, 2.0002
TREE_COVER, LOSS_FROM, LOSS_TO = 30, 19, 22


def class_valid(scl: Column, inside: Column | None = None) -> Column:
    """Inside the area, with a class that is known and not excluded; never null."""
    ok = scl.isNotNull() & (scl != CLASS_NODATA) & ~scl.isin(*EXCLUDED_CLASSES)
    return F.coalesce(ok if inside is None else ok & inside, F.lit(False))


def reflectance(raw: Column, valid: Column, scale: float = SCALE) -> Column:
    """Scaled raw values; null where masked or not positive (0 is nodata)."""
    return F.when(valid & (raw > 0), raw * F.lit(scale))


#: Side of the centred window that tells a band's units.
SAMPLE = 512


def detect_scale(px: DataFrame, bands: Sequence[str], height: int, width: int, scale: float = SCALE, limit: float = 2.0) -> DataFrame:
    """One row: the scale of the bands' values. Integers are scaled; else the 99th percentile of each
    band in the centred window (a bounded number of cells) tells, if any is over ``limit``."""
    kinds = dict(px.dtypes)
    whole = any(kinds[b] in ("tinyint", "smallint", "int", "bigint") for b in bands)
    size = min(SAMPLE, height, width)
    top, left = (height - size) // 2, (width - size) // 2
    sample = px.where((F.col("row") >= top) & (F.col("row") < top + size) & (F.col("col") >= left) & (F.col("col") < left + size))
    highest = F.greatest(*(F.percentile(F.col(b).cast("double"), 0.99) for b in bands)) if len(bands) > 1 else F.percentile(F.col(bands[0]).cast("double"), 0.99)
    row = sample.agg(highest.alias("p99"))
    needed = F.lit(scale != 1.0) & (F.lit(whole) | F.coalesce(F.col("p99") > limit, F.lit(False)))
    return row.withColumn("scale", F.when(needed, F.lit(scale)).otherwise(F.lit(1.0)))


def composite(px: DataFrame, keys: Sequence[str], bands: Sequence[str]) -> DataFrame:
    """Median of each band over a cell's scenes, nulls left out; a cell counts as valid if
    every band has a value. A cell's scenes are few, so a group is small."""
    out = px.groupBy(*keys).agg(*(F.median(b).alias(b) for b in bands), F.count(bands[0]).alias("observations"))
    valid = F.lit(True)
    for b in bands:
        valid = valid & F.col(b).isNotNull()
    return out.withColumn("valid", valid)


def ndvi(nir: Column, red: Column, epsilon: float = EPSILON) -> Column:
    """(nir - red) / (nir + red), the denominator moved away from 0 by its sign; null within
    ``epsilon`` of 0."""
    total = nir + red
    return F.when(F.abs(total) > epsilon, (nir - red) / (total + F.signum(total) * epsilon))


def ndvi_valid(before: Column, after: Column) -> Column:
    return F.coalesce(before.between(-NDVI_LIMIT, NDVI_LIMIT) & after.between(-NDVI_LIMIT, NDVI_LIMIT) & (after - before).between(-CHANGE_LIMIT, CHANGE_LIMIT), F.lit(False))


def all_valid(bands: Sequence[Column], mask: Column, nodata: float = NODATA) -> Column:
    """Mask set, and every band finite and not nodata."""
    out = F.coalesce(mask > 0, F.lit(False))
    for b in bands:
        out = out & finite(b) & (b != nodata)
    return out


def pixel_valid(label: Column | None, bands: Sequence[Column], masks: Sequence[Column], before: Column, after: Column) -> Column:
    """The feature stack's validity; without ``label`` that of inference."""
    out = ndvi_valid(before, after)
    for b in bands:
        out = out & finite(b)
    for m in masks:
        out = out & F.coalesce(m, F.lit(False))
    return out if label is None else out & F.coalesce(label.isin(0, 1), F.lit(False))


def loss_label(tree: Column, loss: Column, source_valid: Column, imagery_valid: Column) -> Column:
    """1 lost in the period, 0 kept, 255 not eligible: outside data, too few trees, or lost before."""
    prior = loss.between(1, LOSS_FROM - 1)
    eligible = F.coalesce(source_valid & imagery_valid & (tree >= TREE_COVER) & ~prior, F.lit(False))
    return F.when(~eligible, LABEL_NODATA).when(loss.between(LOSS_FROM, LOSS_TO), 1).otherwise(0)


def annual_loss(px: DataFrame, keys: Sequence[str], loss: str, mask: Column) -> DataFrame:
    return px.where(mask & (F.col(loss) > 0)).groupBy(*keys, (F.col(loss) + 2000).alias("year")).agg(F.count(F.lit(1)).alias("pixels"))


def coverage(px: DataFrame, keys: Sequence[str], valid: Column, eligible: Column) -> DataFrame:
    """Valid and eligible pixel counts and the valid share in percent (null without eligible)."""
    out = px.groupBy(*keys).agg(F.count_if(valid & eligible).alias("valid_pixels"), F.count_if(eligible).alias("eligible_pixels"))
    return out.withColumn("coverage_pct", F.try_divide(100.0 * F.col("valid_pixels"), F.col("eligible_pixels")))


def mosaic(tiles: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """One value per cell where tiles overlap: that of the first tile with data."""
    return tiles.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min_by(value, order).alias(value))


def clip(px: DataFrame, x: str, y: str, left: float, bottom: float, right: float, top: float) -> DataFrame:
    return px.where((F.col(x) >= left) & (F.col(x) < right) & (F.col(y) > bottom) & (F.col(y) <= top))


def aligned(left: DataFrame, right: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Grid specifications (aoi_id, epsg, left, top, resolution, width, height) side by side,
    with ``same``: equal system and shape, equal origin and resolution within tolerance."""
    r = right.select("aoi_id", *(F.col(c).alias(f"other_{c}") for c in right.columns if c != "aoi_id"))
    joined = left.join(r, "aoi_id")
    same = (F.col("epsg") == F.col("other_epsg")) & (F.col("width") == F.col("other_width")) & (F.col("height") == F.col("other_height"))
    for c in ("left", "top", "resolution"):
        same = same & (F.abs(F.col(c) - F.col(f"other_{c}")) <= tolerance)
    return joined.select("aoi_id", same.alias("same"))


def sample_nearest(targets: DataFrame, source: DataFrame, x: Column, y: Column, keys: Sequence[str], bands: Sequence[str]) -> DataFrame:
    """Target cells with the source cell that (x, y), in source cell units, falls into; null outside."""
    at = targets.withColumns({"__col": F.floor(x).cast("bigint"), "__row": F.floor(y).cast("bigint")})
    s = source.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("row").alias("__srow"), F.col("col").alias("__scol"), *bands)
    on = [F.col(k) == F.col(f"__{k}") for k in keys] + [F.col("__row") == F.col("__srow"), F.col("__col") == F.col("__scol")]
    return at.join(s, on, "left").drop("__row", "__col", "__srow", "__scol", *(f"__{k}" for k in keys))


def sample_bilinear(targets: DataFrame, source: DataFrame, x: Column, y: Column, keys: Sequence[str], cell: Sequence[str], bands: Sequence[str]) -> DataFrame:
    """Target cells (named by ``keys`` and ``cell``) with the weighted mean of the up to four
    source cell centres around (x, y) that have data; null without any."""
    placed = targets.withColumns({"__fx": x - 0.5, "__fy": y - 0.5})
    corner = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)))).alias("__c")
    four = placed.select("*", corner)
    dx, dy = F.col("__fx") - F.floor("__fx"), F.col("__fy") - F.floor("__fy")
    weight = F.when(F.col("__c.i") == 1, dx).otherwise(1 - dx) * F.when(F.col("__c.j") == 1, dy).otherwise(1 - dy)
    four = four.select(*keys, *cell, (F.floor("__fx") + F.col("__c.i")).alias("__scol"), (F.floor("__fy") + F.col("__c.j")).alias("__srow"), weight.alias("__w"))
    s = source.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("row").alias("__r"), F.col("col").alias("__k"), *bands)
    on = [F.col(k) == F.col(f"__{k}") for k in keys] + [F.col("__srow") == F.col("__r"), F.col("__scol") == F.col("__k")]
    joined = four.where("__w > 0").join(s, on, "left")
    means = [F.try_divide(F.sum(F.col(b) * F.col("__w")), F.sum(F.when(F.col(b).isNotNull(), F.col("__w")))).alias(b) for b in bands]
    return joined.groupBy(*keys, *cell).agg(*means)


def resolve_bands(described: DataFrame, aliases: dict[str, Sequence[str]], description: str = "description") -> DataFrame:
    """(source, band, index): the one band whose description is an alias; an error if none or several are."""
    pairs = [(name.lower(), alias.lower()) for name, names in aliases.items() for alias in names]
    listed = F.array(*(F.struct(F.lit(n).alias("band"), F.lit(a).alias("alias")) for n, a in pairs))
    wide = described.select("source", "index", F.lower(F.trim(description)).alias("d"), F.explode(listed).alias("p"))
    hits = wide.where(F.col("d") == F.col("p.alias")).groupBy("source", F.col("p.band").alias("band")).agg(F.min("index").alias("index"), F.count_distinct("index").alias("n"))
    wanted = described.select("source").distinct().select("source", F.explode(F.array(*(F.lit(n.lower()) for n in aliases))).alias("band"))
    joined = wanted.join(hits, ["source", "band"], "left")
    clash = F.raise_error(F.concat(F.lit("not exactly one band for "), F.col("band"), F.lit(" in "), F.col("source")))
    return joined.select("source", "band", F.when(F.col("n") == 1, F.col("index")).otherwise(clash).alias("index"))
