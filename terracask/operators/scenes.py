"""Scene catalogue operators: item flattening, coverage score, ranking and greedy selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settled

VALID_WEIGHT, CLEAR_WEIGHT = 0.85, 0.15
MIN_COVERAGE, MIN_SCENES, MAX_SCENES = 80.0, 1, 5
ITEM = (
    "struct<id:string,collection:string,bbox:array<double>,properties:struct<datetime:string,`eo:cloud_cover`:double,platform:string,`s2:processing_baseline`:string,`proj:epsg`:int>,"
    "links:array<struct<rel:string,href:string>>,assets:map<string,struct<href:string>>>"
)


def flatten_items(items: DataFrame, required: Sequence[str], collection: str | None = None, item: str = "item") -> DataFrame:
    """Catalogue items (a struct like ``ITEM``) as flat rows with the status of their assets.

    Other columns (the area, its role, year, window and time of the query) are kept; what an item
    lacks is the empty string, its bounding box an empty list, its collection the one asked for."""
    i = F.col(item)
    props = i["properties"]
    names = F.array(*(F.lit(r) for r in required))
    assets = F.coalesce(i["assets"], F.create_map().cast("map<string,struct<href:string>>"))
    missing = F.filter(names, lambda a: ~F.map_contains_key(assets, a))
    own = F.filter(F.coalesce(i["links"], F.array().cast("array<struct<rel:string,href:string>>")), lambda l: l["rel"] == "self")
    kept = [c for c in items.columns if c != item]

    def text(value: Column, default: str = "") -> Column:
        return F.coalesce(value.cast("string"), F.lit(default))

    return items.select(
        *kept,
        text(i["id"]).alias("item_id"),
        text(props["datetime"]).alias("acquisition_datetime"),
        props["eo:cloud_cover"].alias("cloud_cover_pct"),
        text(props["platform"]).alias("platform"),
        text(props["s2:processing_baseline"]).alias("processing_baseline"),
        text(i["collection"], collection or "").alias("collection"),
        text(F.get(own, F.lit(0))["href"]).alias("source_uri"),
        props["proj:epsg"].alias("proj_epsg"),
        F.to_json(F.coalesce(i["bbox"], F.array().cast("array<double>"))).alias("bbox"),
        (F.size(missing) == 0).alias("required_assets_present"),
        F.array_join(missing, ";").alias("missing_assets"),
        *(text(F.try_element_at(assets, F.lit(r))["href"]).alias(f"{r}_href") for r in required),
        F.lit("").alias("local_path"),
        F.when(F.size(missing) == 0, "discovered").otherwise("missing_required_assets").alias("status"),
    )


def within_cloud_limit(items: DataFrame, most: float, cloud: str = "cloud_cover_pct") -> DataFrame:
    """Items with known cloud cover of at most ``most``."""
    return items.where(F.col(cloud) <= most)


def with_score(scenes: DataFrame, valid: str = "valid_pixels", total: str = "aoi_pixels", cloud: str = "cloud_cover") -> DataFrame:
    valid_pct = F.try_divide(100.0 * F.col(valid), F.col(total))
    out = scenes.withColumn("valid_pct", valid_pct).withColumn("invalid_pct", 100 - F.col("valid_pct"))
    return out.withColumn("score", F.round(VALID_WEIGHT * F.col("valid_pct") + CLEAR_WEIGHT * (100 - F.col(cloud)), 4))


def ranked(scenes: DataFrame, by: Sequence[str], item: str = "item_id") -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("valid_pct"), F.asc("cloud_cover"), F.asc("datetime"), F.asc(item))
    return scenes.withColumn("rank", F.row_number().over(order))


def greedy_cover(px: DataFrame, ranks: DataFrame, by: str, item: str, pixel: str, totals: DataFrame, least: float = MIN_COVERAGE, min_scenes: int = MIN_SCENES, max_scenes: int = MAX_SCENES) -> DataFrame:
    """Scenes chosen one after another by the pixels they add, then score, then rank.

    ``px``: valid pixels (by, item, pixel); ``ranks``: (by, item, score, rank); ``totals``:
    (by, total). Stops at coverage ``least`` with ``min_scenes``, at ``max_scenes``, or when nothing
    is added. Pixels are first counted by the set of scenes that see them; a step is one aggregate
    over these patterns, of all groups at once, and its choice (a row per group) is written down, so
    that no group's patterns come together anywhere.
    """
    seen = px.groupBy(by, pixel).agg(F.array_sort(F.collect_set(item)).alias("seen"))
    left = settled(seen.groupBy(by, "seen").agg(F.count(F.lit(1)).alias("pixels")))
    state = totals.select(by, "total", F.lit(0).cast("bigint").alias("covered"))
    steps = []
    for step in range(max_scenes):
        share = 100.0 * F.col("covered") / F.col("total")
        going = state.where(F.lit(step < min_scenes) | ~F.coalesce((F.col("total") > 0) & (share >= least), F.lit(False)))
        gains = left.select(by, F.explode("seen").alias(item), "pixels").groupBy(by, item).agg(F.sum("pixels").alias("gain"))
        best = gains.join(ranks, [by, item]).groupBy(by).agg(F.max(F.struct("gain", "score", -F.col("rank"), item)).alias("best"))
        chosen = going.join(best, by).select(by, F.col(f"best.{item}").alias(item), F.lit(step + 1).alias("selection_order"), F.col("best.gain").alias("gain_pixels"), (F.col("covered") + F.col("best.gain")).alias("covered"), "total")
        chosen = settled(chosen)
        steps.append(chosen)
        left = left.join(chosen.select(by, F.col(item).alias("__chosen")), by).where(~F.array_contains("seen", F.col("__chosen"))).drop("__chosen")
        state = chosen.select(by, "total", "covered")
    rows = reduce(DataFrame.unionByName, steps)
    pct = F.when(F.col("total") > 0, 100.0 * F.col("covered") / F.col("total"))
    return rows.select(by, item, "selection_order", "gain_pixels", F.col("covered").alias("covered_pixels"), pct.alias("coverage_pct"))


def joined_ids(selected: DataFrame, by: Sequence[str], item: str, order: str) -> DataFrame:
    """The selected items of each group in order, as one string."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(item).cast("string").alias("i"))))
    return selected.groupBy(*by).agg(F.array_join(F.transform(listed, lambda s: s["i"]), ";").alias("item_ids"))


def run_status(groups: DataFrame, passed: Column, expected: int) -> DataFrame:
    """One row: whether all of ``expected`` groups are there and passed."""
    out = groups.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.every(passed), F.lit(False)).alias("all_passed"))
    return out.withColumn("status", F.when(F.col("all_passed") & (F.col("groups") == expected), "passed").otherwise("failed"))
