"""Leakage-safe dataset splits: spatial blocks, geographic folds and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import unit_interval

BLOCK, PATCH, VALIDATION_SHARE, SEED = 512, 32, 0.20, 42
HOLDOUT_ROLES = {"geographic_holdout": "test", "final_geographic_holdout": "final_test"}
#: Names that the same roles have had in older manifests.
ROLE_ALIASES = {"held_out_test": "geographic_holdout", "diagnostic_holdout": "geographic_holdout"}


def canonical_role(role: Column) -> Column:
    out = role
    for old, new in ROLE_ALIASES.items():
        out = F.when(role == old, F.lit(new)).otherwise(out)
    return out


def role_or_fallback(composite_role: Column, label_role: Column, aoi: Column, holdouts: tuple[str, ...]) -> Column:
    """The composite's role, else the label's, else by the area's name."""
    named = F.when(aoi.isin(*holdouts), F.lit("geographic_holdout")).otherwise(F.lit("dataset_development"))
    return canonical_role(F.coalesce(composite_role, label_role, named))


def classes_per_split(df: DataFrame, label: str = "target", split: str = "split", classes: int = 2) -> DataFrame:
    """Distinct labels of each split, and whether they are all there."""
    out = df.groupBy(split).agg(F.count_distinct(label).alias("classes"))
    return out.withColumn("complete", F.col("classes") == classes)


def with_blocks(df: DataFrame, row: str = "row_off", col: str = "col_off", block: int = BLOCK, patch: int = PATCH) -> DataFrame:
    """Adds the spatial block of a patch's origin, and whether the patch lies within it."""
    inside = (F.col(row) % block + patch <= block) & (F.col(col) % block + patch <= block)
    return df.withColumns(
        {
            "block_row": F.floor(F.col(row) / block).cast("bigint"),
            "block_col": F.floor(F.col(col) / block).cast("bigint"),
            "inside_block": inside,
        }
    )


def drop_boundary(df: DataFrame, holdout: Column) -> DataFrame:
    """Without patches that cross block borders, but for holdouts, which need no blocks."""
    return df.where(holdout | F.col("inside_block"))


def holdout_split(role: Column, aoi: Column, test_aois: tuple[str, ...] = (), final_aois: tuple[str, ...] = ()) -> Column:
    """``test`` or ``final_test`` by role or by list; both at once is an error."""
    role = canonical_role(role)
    test = (role == "geographic_holdout") | aoi.isin(*test_aois) if test_aois else role == "geographic_holdout"
    final = (role == "final_geographic_holdout") | aoi.isin(*final_aois) if final_aois else role == "final_geographic_holdout"
    clash = F.raise_error(F.concat(F.lit("holdouts overlap in "), aoi))
    return F.when(test & final, clash).when(test, "test").when(final, "final_test")


def block_split(df: DataFrame, seed: int = SEED, share: float = VALIDATION_SHARE, aoi: str = "aoi_id", role: str = "role") -> DataFrame:
    """Adds ``block_score`` and ``split``.

    The score is hashed from the block's key, so a block is never divided. It is a scalar of
    columns that each row has; hashing per row costs less than a shuffle to hash each block
    once and join.
    """
    held = holdout_split(F.col(role), F.col(aoi))
    key = F.concat_ws("|", F.lit(seed), F.col(aoi), F.col("block_row"), F.col("block_col"))
    scored = df.withColumn("block_score", F.when(held.isNull(), unit_interval(key)))
    return scored.withColumn("split", F.coalesce(held, F.when(F.col("block_score") < share, "validation").otherwise("train")))


def split_summary(df: DataFrame, aoi: str = "aoi_id", label: str = "target") -> DataFrame:
    """Row counts by split and aoi, by split and label, and by split, in one pass."""
    return df.groupingSets([["split", aoi], ["split", label], ["split"]], "split", aoi, label).agg(F.count(F.lit(1)).alias("n"))


def loao_folds(df: DataFrame, aoi: str = "aoi_id", role: str = "role") -> DataFrame:
    """Leave-one-area-out folds over development rows, and the holdouts as fixed partitions.

    The list of areas is small by nature (a row per area) and is counted off by rank.
    """
    known = ("dataset_development", *HOLDOUT_ROLES)
    canonical = canonical_role(F.col(role))
    checked = df.withColumn("__role", F.when(canonical.isin(*known), canonical).otherwise(F.raise_error(F.concat(F.lit("unknown role "), F.coalesce(canonical, F.lit("null"))))))
    development = checked.where(F.col("__role") == "dataset_development")
    # a row holding the sorted areas, so that their numbers need no global window
    areas = development.agg(F.array_sort(F.collect_set(aoi)).alias("areas"))
    folds = areas.select(F.posexplode("areas").alias("k", "validation_aoi")).select(F.format_string("fold_%02d", F.col("k") + 1).alias("fold_id"), "validation_aoi")
    crossed = development.crossJoin(F.broadcast(folds))  # an area list: bounded by the number of areas
    crossed = crossed.withColumn("fold_split", F.when(F.col(aoi) == F.col("validation_aoi"), "validation").otherwise("train"))
    fixed = checked.where(F.col("__role") != "dataset_development")
    name = F.when(F.col("__role") == "geographic_holdout", "diagnostic").otherwise("final")
    fixed = fixed.withColumns({"fold_id": name, "validation_aoi": F.lit(None).cast("string"), "fold_split": F.concat(name, F.lit("_holdout"))})
    return crossed.unionByName(fixed).drop("__role")
