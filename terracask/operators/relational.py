"""Relational operators over manifests: guarded joins, key audits, selection and shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import risk_colour
from .numbering import numbered


def exactly_once(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each left row with the one right row of its keys; an error where there is none or several.

    Columns of ``left`` override those of ``right`` with the same name.
    """
    extra = [c for c in right.columns if c not in left.columns]
    counted = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *(F.first(c).alias(c) for c in extra))
    joined = left.join(counted, list(keys), "left")
    wrong = F.coalesce("__n", F.lit(0)) != 1
    name = F.concat_ws("/", *(F.col(k).cast("string") for k in keys))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("not exactly once: "), name))).otherwise(F.col("__n"))
    return joined.withColumn("__n", checked).where("__n = 1").drop("__n")


def guarded(df: DataFrame, violations: DataFrame, message: str) -> DataFrame:
    """``df``, or an error with the message if there is any row of ``violations``."""
    found = F.concat(F.lit(f"{message}: "), F.col("__violations").cast("string"))
    none = F.when(F.col("__violations") > 0, F.raise_error(found).cast("boolean")).otherwise(F.lit(True))
    checked = violations.agg(F.count(F.lit(1)).alias("__violations")).where(none)
    return df.crossJoin(F.broadcast(checked)).drop("__violations")  # one row


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a side that must be unique on the keys (many to one); an error if it isn't,
    also where no left row meets the repeated key."""
    return guarded(left.join(right, list(keys), "left"), duplicates(right, keys), "repeated keys on the looked up side")


def one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join whose keys must be the same on both sides, once each; an error if not."""
    l, r = (d.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) for d, n in ((left, "__l"), (right, "__r")))
    wrong = l.join(r, list(keys), "full_outer").where((F.coalesce("__l", F.lit(0)) != 1) | (F.coalesce("__r", F.lit(0)) != 1))
    return guarded(left.join(right, list(keys)), wrong, "keys not once on both sides")


def covering(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join whose sides must have the same set of keys; an error if not."""
    return guarded(left.join(right, list(keys)), key_audit(left, right, keys), "keys that one side lacks")


def paired_years(df: DataFrame, by: str, year: str, first: int, second: int, columns: Sequence[str]) -> DataFrame:
    """A row per ``by`` with the columns of both years side by side; an error unless there is exactly
    one row of each year."""
    here = df.where(F.col(year).isin(first, second))
    cells = [F.max(F.when(F.col(year) == y, F.col(c))).alias(f"{c}_{y}") for c in columns for y in (first, second)]
    counts = [F.count_if(F.col(year) == y).alias(f"__{y}") for y in (first, second)]
    paired = here.groupBy(by).agg(*counts, *cells)
    wrong = F.concat(F.lit("not exactly one row of each year for "), F.coalesce(F.col(by).cast("string"), F.lit("null")))
    ok = (F.col(f"__{first}") == 1) & (F.col(f"__{second}") == 1)
    return paired.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(wrong).cast("boolean"))).drop(f"__{first}", f"__{second}")


def key_audit(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that only one side has, as ``missing`` or ``unexpected``."""
    e, a = expected.select(*keys).distinct(), actual.select(*keys).distinct()
    missing = e.join(a, list(keys), "left_anti").withColumn("problem", F.lit("missing"))
    return missing.unionByName(a.join(e, list(keys), "left_anti").withColumn("problem", F.lit("unexpected")))


def same_set(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: the rows that only either side has, with multiplicity, and ``equal``."""
    a = left.exceptAll(right).agg(F.count(F.lit(1)).alias("only_left"))
    b = right.exceptAll(left).agg(F.count(F.lit(1)).alias("only_right"))
    return a.crossJoin(b).withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def overlap(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that both sides have (none: disjoint)."""
    return left.select(*keys).intersect(right.select(*keys))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def selected(df: DataFrame, ids: DataFrame, key: str, whole: bool = False) -> DataFrame:
    """The rows of the selected ids; with ``whole``, an id without a row is an error."""
    kept = df.join(ids.select(key), key, "left_semi")
    return guarded(kept, ids.select(key).distinct().join(df, key, "left_anti"), "selected ids missing") if whole else kept


def combinations(*sides: DataFrame) -> DataFrame:
    """All combinations of short lists (areas, years, layers)."""
    out = sides[0]
    for side in sides[1:]:
        out = out.crossJoin(F.broadcast(side))  # configuration lists
    return out


def accept_reject(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Adds ``quality_flag`` and ``rejection_reason``: the first rule broken, in order."""
    reason = F.lit(None).cast("string")
    for name, ok in reversed(rules):
        reason = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn("rejection_reason", reason).withColumn("quality_flag", F.when(reason.isNull(), "accepted").otherwise("rejected"))


def accepted(judged: DataFrame) -> DataFrame:
    """The accepted rows of ``accept_reject``; an error if there are rows but none is accepted."""
    whole = judged.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("quality_flag") == "accepted").alias("ok"))
    none = whole.where("all > 0 AND ok = 0")
    return guarded(judged, none, "no row is accepted").where("quality_flag = 'accepted'")


def representative(df: DataFrame, by: str, keys: Sequence[str], total: int) -> DataFrame:
    """``total`` rows, shared out evenly over the classes of ``by`` (the first classes get what is
    left over), each class evenly spaced in the ascending order of ``keys``: positions
    round(i * (n - 1) / (k - 1)), half to even. A sample of fixed size by purpose."""
    placed = numbered(df, by, keys, "__at")
    classes = df.agg(F.array_sort(F.collect_set(by)).alias("__classes"))  # few by contract
    ranked = placed.crossJoin(F.broadcast(classes)).withColumn("__class", F.array_position("__classes", F.col(by)).cast("int") - 1)
    n = F.size("__classes")
    quota = (F.floor(F.lit(total) / n) + F.when(F.col("__class") < F.lit(total) % n, 1).otherwise(0)).cast("int")
    k = F.least(F.col("__at_count"), quota)
    steps = F.sequence(F.lit(0), F.greatest(k - 1, F.lit(0)))
    spots = F.transform(steps, lambda i: F.bround(i * (F.col("__at_count") - 1) / F.greatest(k - 1, F.lit(1)).cast("double")).cast("bigint"))
    return ranked.where((k > 0) & F.array_contains(spots, F.col("__at").cast("bigint"))).drop("__at", "__at_count", "__classes", "__class")


#: Levels of the cells that boxes meet in: cells of 2**level degrees.
LEVELS = (-10, 9)


def overlapping_boxes(boxes: DataFrame, key: str = "box_id") -> DataFrame:
    """Pairs of boxes that overlap in more than an edge (strict inequalities).

    A box belongs to the level whose cells are just as large as it, where it touches four cells at
    most. It is looked for there and listed in the cells of all coarser levels too, so large boxes
    meet small ones at the large ones' level, in the cell of the overlap's lower left corner.
    """
    low, high = LEVELS
    extent = F.greatest(F.col("max_lon") - F.col("min_lon"), F.col("max_lat") - F.col("min_lat"))
    own = F.when(extent <= 2.0**low, low).otherwise(F.least(F.ceil(F.log2(extent)), F.lit(high))).cast("int")
    level = boxes.where(extent.isNotNull()).withColumn("__own", own)

    def cells(df: DataFrame) -> DataFrame:
        side = F.pow(F.lit(2.0), F.col("__level"))
        for name, a, b in (("__x", "min_lon", "max_lon"), ("__y", "min_lat", "max_lat")):
            df = df.withColumn(name, F.explode(F.sequence(F.floor(F.col(a) / side), F.floor(F.col(b) / side))))
        return df

    native = cells(level.withColumn("__level", F.col("__own")))
    listed = cells(level.withColumn("__level", F.explode(F.sequence(F.col("__own"), F.lit(high)))))
    listed = listed.select("__level", "__x", "__y", *(F.col(c).alias(f"o_{c}") for c in (key, "__own", "min_lon", "min_lat", "max_lon", "max_lat")))
    pairs = native.join(listed, ["__level", "__x", "__y"]).where((F.col("o___own") < F.col("__own")) | ((F.col("o___own") == F.col("__own")) & (F.col(key) < F.col(f"o_{key}"))))
    pairs = pairs.where("min_lon < o_max_lon AND o_min_lon < max_lon AND min_lat < o_max_lat AND o_min_lat < max_lat")
    side = F.pow(F.lit(2.0), F.col("__level"))
    corner = (F.floor(F.greatest("min_lon", "o_min_lon") / side) == F.col("__x")) & (F.floor(F.greatest("min_lat", "o_min_lat") / side) == F.col("__y"))
    return pairs.where(corner).select(F.least(key, f"o_{key}").alias("left_id"), F.greatest(key, f"o_{key}").alias("right_id"))


def bounds_valid() -> Column:
    in_range = F.col("min_lon").between(-180, 180) & F.col("max_lon").between(-180, 180) & F.col("min_lat").between(-90, 90) & F.col("max_lat").between(-90, 90)
    return F.coalesce(in_range & (F.col("min_lon") < F.col("max_lon")) & (F.col("min_lat") < F.col("max_lat")), F.lit(False))


def shards(df: DataFrame, group: str, keys: Sequence[str], size: int) -> DataFrame:
    """Adds ``shard`` (from 1) of ``size`` rows each within ``group``, in the order of ``keys``, and its name."""
    out = numbered(df, group, keys, "__at").withColumn("shard", F.floor(F.col("__at") / size).cast("int") + 1)
    return out.withColumn("shard_name", F.format_string("part-%05d", F.col("shard"))).drop("__at", "__at_count")


def unpivot_assets(df: DataFrame, ids: Sequence[str], assets: Sequence[str]) -> DataFrame:
    return df.unpivot(list(ids), list(assets), "asset", "href")


def canonicalize(df: DataFrame, aliases: dict[str, Sequence[str]], required: Sequence[str] = ()) -> DataFrame:
    """Column names trimmed and lower-cased, strings trimmed, aliases renamed; an error if a
    required column is missing."""
    renamed = df.toDF(*(c.strip().lstrip("﻿").lower() for c in df.columns))
    for name, others in aliases.items():
        if name not in renamed.columns and (found := next((o for o in others if o in renamed.columns), None)):
            renamed = renamed.withColumnRenamed(found, name)
    if missing := [r for r in required if r not in renamed.columns]:
        raise KeyError(f"columns missing: {missing}")
    return renamed.select(*(F.trim(c).alias(c) if t == "string" else F.col(c) for c, t in renamed.dtypes))


def forbidden_columns(names: DataFrame, exact: Sequence[str], tokens: Sequence[str], column: str = "feature") -> DataFrame:
    """Predictors that would leak the target: forbidden names, or names with a target token."""
    low = F.lower(F.col(column))
    hit = low.isin(*(e.lower() for e in exact))
    for t in tokens:
        hit = hit | F.contains(low, F.lit(t.lower()))
    return names.where(hit)


def dashboard(predictions: DataFrame, areas: Sequence[str], least: float, alerts_only: bool = False) -> DataFrame:
    """Predictions of the chosen areas of at least a probability, with their colour, the highest first."""
    shown = predictions.where(F.col("aoi_id").isin(*areas) & (F.col("probability") >= least))
    shown = shown.where("prediction = 1") if alerts_only else shown
    return shown.withColumn("fill_color", risk_colour(F.col("probability"))).orderBy(F.desc("probability"))


def ordered(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Rows in the order of a total key, for output that can be reproduced."""
    return df.orderBy(*keys)


def head(df: DataFrame, keys: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows, a smoke test's or a report's limit; an error if there is none."""
    return guarded(df.orderBy(*keys).limit(n), df.agg(F.count(F.lit(1)).alias("n")).where("n = 0"), "no rows")
