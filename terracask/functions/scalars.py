"""Scalar expressions used across the engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unit_interval(key: Column) -> Column:
    """SHA-256 of a string key as a double in [0, 1): its first 64 bits over 2**64."""
    head = F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10)
    return head.cast("decimal(20,0)").cast("double") / F.lit(float(1 << 64))


def hash_seed(key: Column) -> Column:
    """The first 64 bits of a key's SHA-256, as a decimal."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)")


def patch_id(aoi: Column, row: Column, col: Column) -> Column:
    return F.format_string("%s_r%06d_c%06d", aoi, row, col)


def finite(value: Column) -> Column:
    """Not null, NaN or infinite; never null itself."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def null_if_nodata(value: Column, nodata: float) -> Column:
    return F.when(finite(value) & (value != nodata), value)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 where the whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole.cast("double"))


def signed_url(href: Column, token: str) -> Column:
    """The token appended with ``&`` where there is a query already, else with ``?``."""
    return F.concat(href, F.when(F.contains(href, F.lit("?")), "&").otherwise("?"), F.lit(token))


def unix_path(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def normalized_name(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(name)), "[- ]", "_")


def first_column(columns: Sequence[str], names: Sequence[str]) -> str:
    """The first of ``names`` that exists; an error if none does."""
    for name in names:
        if name in columns:
            return name
    raise KeyError(f"none of the columns {list(names)} is there")


def decimal_text(value: Column, places: int = 8) -> Column:
    return F.format_string(f"%.{places}f", value)


def split_feature(name: Column) -> tuple[Column, Column]:
    """Channel and statistic of a feature name (``channel__stat``)."""
    parts = F.split(name, "__", 2)
    return parts[0], parts[1]


def tile_name(version: Column, layer: Column, tile: Column) -> Column:
    """The file name of a source tile."""
    return F.format_string("Hansen_%s_%s_%s.tif", version, layer, tile)


def window_text(start: Column, end: Column) -> Column:
    """A closed interval of days as ISO 8601 times, from first to last second."""
    return F.concat(F.date_format(start, "yyyy-MM-dd"), F.lit("T00:00:00Z/"), F.date_format(end, "yyyy-MM-dd"), F.lit("T23:59:59Z"))


def number(text: Column, coerce: bool = False) -> Column:
    """A string as a number; what is none is an error or, with ``coerce``, null."""
    return text.try_cast("double") if coerce else text.cast("double")


def nested(record: Column, path: str, default: str = "") -> Column:
    """A field of a JSON text by its path, or a default."""
    return F.coalesce(F.get_json_object(record, path), F.lit(default))


def run_constants(df: DataFrame, run_id: str, threshold: float, flag: str = "accepted") -> DataFrame:
    """A run's constants in front of and behind its rows."""
    return df.select(F.lit(run_id).alias("run_id"), *df.columns, F.lit(threshold).alias("threshold"), F.lit(flag).alias("quality_flag"))


def risk_colour(probability: Column) -> Column:
    """Red, orange and green as RGBA components: fixed values."""
    red, orange, green = (F.array(*map(F.lit, c)) for c in ((214, 39, 40, 185), (255, 127, 14, 170), (44, 160, 44, 130)))
    return F.when(probability >= 0.75, red).when(probability >= 0.50, orange).otherwise(green)
