"""Running sums and row numbers in order, dealt out over ranges of the order key.

A plain window over a group puts the whole group into one task. Here rows are first dealt out
by (group, key range); the ranges' totals, a small table, give each range its start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of the unit interval that running sums are dealt out over.
RANGES = 1024


def sums_before(df: DataFrame, by: Sequence[str], key: str, values: Sequence[str], descending: bool = False, ranges: int = RANGES) -> DataFrame:
    """Adds ``<value>_before``: the sum over the group's rows before this one in ``key`` order.

    Keys should lie in the unit interval, as probabilities do, and be unique in their group;
    others only change how rows are dealt out.
    """
    place = F.floor(F.col(key) * ranges)
    dealt = df.withColumn("__range", -place if descending else place)
    parts = [*by, "__range"]
    totals = dealt.groupBy(*parts).agg(*(F.sum(v).alias(f"__{v}") for v in values))
    earlier = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*parts, *(F.coalesce(F.sum(f"__{v}").over(earlier), F.lit(0)).alias(f"__{v}_start") for v in values))
    order = F.col(key).desc() if descending else F.col(key).asc()
    within = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summed = dealt.select("*", *(F.coalesce(F.sum(v).over(within), F.lit(0)).alias(f"__{v}_here") for v in values))
    joined = summed.join(starts, parts)
    return joined.select(*df.columns, *((F.col(f"__{v}_start") + F.col(f"__{v}_here")).alias(f"{v}_before") for v in values))


def _cuts(df: DataFrame, key: str, ranges: int) -> list[float]:
    shares = [i / ranges for i in range(1, ranges)]
    return df.agg(F.percentile_approx(F.col(key).cast("double"), shares, 20 * ranges).alias("c")).first()["c"] or []


def _place(key: str, cuts: Sequence[float]) -> Column:
    """How many cuts lie at or below the key; -1 for null."""
    listed = F.array(*(F.lit(float(c)) for c in sorted(set(cuts)))) if cuts else F.array().cast("array<double>")
    return F.when(F.col(key).isNull(), -1).otherwise(F.size(F.filter(listed, lambda c: c <= F.col(key).cast("double"))))


def numbered(df: DataFrame, by: str, keys: Sequence[str], out: str, ranges: int = 256) -> DataFrame:
    """Adds ``out``: row numbers from 0 within ``by``, which has few values, in the ascending order of
    ``keys``, two numeric columns or one; and ``<out>_count``, the group's size.

    Rows are dealt out by ranges of the first key. A value of it that fills ranges by itself, and
    null, is dealt out by ranges of the second."""
    first, *rest = keys
    cuts = _cuts(df, first, ranges)
    hot = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})
    is_hot = F.col(first).isNull() | (F.coalesce(F.col(first).cast("double").isin(hot), F.lit(False)) if hot else F.lit(False))
    second = _place(rest[0], _cuts(df.where(is_hot), rest[0], ranges)) if rest else F.lit(0)
    # of a range whose lower end is a hot value, that value comes first
    dealt = df.withColumns({"__range": _place(first, cuts), "__sub": F.when(is_hot, second).otherwise(F.lit(ranges))})
    dealt = dealt.withColumn("__group", F.when(F.col(by).isNull(), "").otherwise(F.concat(F.lit("="), F.col(by).cast("string"))))
    parts = ["__group", "__range", "__sub"]
    counts = dealt.groupBy(*parts).agg(F.count(F.lit(1)).alias("__n"))
    group = Window.partitionBy("__group")
    earlier = group.orderBy("__range", "__sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*parts, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"), F.sum("__n").over(group).alias(f"{out}_count"))
    here = F.row_number().over(Window.partitionBy(*parts).orderBy(*(F.col(k).asc_nulls_first() for k in keys))) - 1
    joined = dealt.withColumn("__here", here).join(starts, parts)  # on the window's own partitioning
    return joined.select(*df.columns, (F.col("__start") + F.col("__here")).alias(out), f"{out}_count")
