"""Data-quality checks: all predicates over a relation in one aggregate.

A check counts its violations; checks over one relation are fused into a single pass, and
checks that need keys of their own (duplicates, key sets) add one aggregate each. The
result is a relation (name, passed, detail).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """Passes if ``predicate`` is true of every row (null counts as a violation)."""

    name: str
    predicate: Column


def _result(cells: Sequence[tuple[str, Column, Column]]) -> Column:
    return F.inline(F.array(*(F.struct(F.lit(n).alias("name"), p.alias("passed"), d.cast("string").alias("detail")) for n, p, d in cells)))


def run_checks(df: DataFrame, checks: Sequence[Check], non_empty: bool = True) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(~F.coalesce(c.predicate, F.lit(False))).alias(f"v{i}") for i, c in enumerate(checks)))
    cells = [(c.name, F.col(f"v{i}") == 0, F.concat(F.col(f"v{i}"), F.lit(" violations"))) for i, c in enumerate(checks)]
    if non_empty:
        cells.append(("non_empty", F.col("rows") > 0, F.concat(F.col("rows"), F.lit(" rows"))))
    return counts.select(_result(cells))


def unique_check(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("v"))
    return repeated.select(_result([(name, F.col("v") == 0, F.concat(F.col("v"), F.lit(" repeated keys")))]))


def empty_check(violations: DataFrame, name: str) -> DataFrame:
    """Passes if a relation of violations has no row."""
    return violations.agg(F.count(F.lit(1)).alias("v")).select(_result([(name, F.col("v") == 0, F.concat(F.col("v"), F.lit(" violations")))]))


def isolation_check(df: DataFrame, name: str, block: Sequence[str], split: str = "split") -> DataFrame:
    """Passes if no block has rows in two splits."""
    mixed = df.groupBy(*block).agg(F.min(split).alias("lo"), F.max(split).alias("hi")).where("lo <> hi")
    return empty_check(mixed, name)


def values_check(df: DataFrame, name: str, column: str, expected: Sequence) -> DataFrame:
    """Passes if exactly the expected values occur."""
    seen = df.agg(F.array_sort(F.collect_set(column)).alias("s"))  # few by contract: an enumeration
    return seen.select(_result([(name, F.col("s") == F.array_sort(F.array(*(F.lit(e) for e in expected))), F.array_join(F.transform("s", lambda x: x.cast("string")), "|"))]))


def recompute_check(stated: DataFrame, computed: DataFrame, keys: Sequence[str], metrics: Sequence[str], name: str = "metrics_recomputed", tolerance: float = 1e-12) -> DataFrame:
    """Passes if stated metrics equal the recomputed ones within tolerance, on all keys of either side."""
    c = computed.select(*keys, *(F.col(m).alias(f"c_{m}") for m in metrics))
    joined = stated.select(*keys, *metrics).join(c, list(keys), "full_outer")
    near = reduce(lambda x, y: x & y, [F.coalesce(F.abs(F.col(m) - F.col(f"c_{m}")) <= tolerance, F.lit(False)) for m in metrics])
    return empty_check(joined.where(~near), name)


def columns_check(df: DataFrame, name: str, required: Sequence[str]) -> DataFrame:
    """Passes if the relation has all required columns."""
    missing = sorted(set(required) - set(df.columns))
    spark = df.sparkSession
    return spark.range(1).select(F.lit(name).alias("name"), F.lit(not missing).alias("passed"), F.lit("|".join(missing)).alias("detail"))


def keys_check(left: DataFrame, right: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Passes if both sides have the same keys, once each."""
    l, r = (d.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) for d, n in ((left, "l"), (right, "r")))
    wrong = l.join(r, list(keys), "full_outer").where((F.coalesce("l", F.lit(0)) != 1) | (F.coalesce("r", F.lit(0)) != 1))
    return empty_check(wrong, name)


def classes_check(df: DataFrame, name: str, by: Sequence[str], label: str, classes: int = 2) -> DataFrame:
    """Passes if every group has all classes."""
    return empty_check(df.groupBy(*by).agg(F.count_distinct(label).alias("n")).where(F.col("n") < classes), name)


def selection_checks(candidates: DataFrame, selected: str, eligible: str, ranking: Sequence[str], id_: str) -> DataFrame:
    """Exactly one candidate is selected, and it is the best eligible one (of all, if none is) by the
    ranking, then the lowest id."""
    one = candidates.where(F.col(selected))
    best = candidates.agg(F.max(F.struct(F.col(eligible).alias("e"), *(F.col(r) for r in ranking), -F.col(id_))).alias("best"))
    wrong = one.crossJoin(F.broadcast(best)).where(F.col(f"best.col{len(ranking) + 2}") != -F.col(id_))  # one row
    count = one.agg(F.count(F.lit(1)).alias("n")).where("n <> 1")
    return union(empty_check(count, "one_selected"), empty_check(wrong, "ranking_reproduces"))


def protocol_checks(protocol: DataFrame) -> DataFrame:
    """A protocol's flags: selection saw train and validation only, and all was locked before the test,
    which was evaluated once."""
    return run_checks(
        protocol,
        [
            Check("selection_splits", F.array_sort("selection_used_splits") == F.array(F.lit("train"), F.lit("validation"))),
            Check("test_not_used_for_selection", ~F.col("test_used_for_selection")),
            Check("locked_before_test", F.col("locked_at") < F.col("test_evaluated_at")),
            Check("test_evaluated_once", F.col("test_evaluations") == 1),
        ],
    )


def label_audit(areas: DataFrame, composites: DataFrame, labels: DataFrame, years: tuple[int, int], least_coverage: float, least_eligible: float, by: str = "aoi_id") -> DataFrame:
    """Per area: prevalence and the names of the checks that fail, joined by ``|``: composites of both
    years with enough coverage, a single row of labels, enough of them eligible, both classes."""
    c = composites.groupBy(by).agg(
        F.count_if(F.col("target_year") == years[0]).alias("first"), F.count_if(F.col("target_year") == years[1]).alias("second"), F.count(F.lit(1)).alias("composites"), F.min("valid_coverage_pct").alias("min_coverage_pct")
    )
    l = labels.groupBy(by).agg(F.count(F.lit(1)).alias("label_rows"), *(F.max(x).alias(x) for x in ("positive_pixels", "negative_pixels", "eligible_coverage_pct")))
    out = areas.join(c, by, "left").join(l, by, "left").fillna(0, ["first", "second", "composites", "label_rows", "positive_pixels", "negative_pixels", "eligible_coverage_pct"])
    out = out.withColumn("positive_pct", F.coalesce(F.try_divide(100.0 * F.col("positive_pixels"), F.col("positive_pixels") + F.col("negative_pixels")), F.lit(0.0)))
    named = [
        ("has_two_composites", (F.col("first") > 0) & (F.col("second") > 0)),
        ("composite_coverage", F.coalesce((F.col("composites") >= 2) & (F.col("min_coverage_pct") >= least_coverage), F.lit(False))),
        ("single_label_row", F.col("label_rows") == 1),
        ("eligible_coverage", F.col("eligible_coverage_pct") >= least_eligible),
        ("both_classes", (F.col("positive_pixels") > 0) & (F.col("negative_pixels") > 0)),
    ]
    failed = F.filter(F.array(*(F.when(~ok, F.lit(n)) for n, ok in named)), lambda x: x.isNotNull())
    return out.withColumn("failed_checks", F.array_join(failed, "|")).withColumn("status", F.when(F.col("failed_checks") == "", "PASSED").otherwise("FAILED")).drop("first", "second", "composites", "label_rows")


def overall(results: DataFrame) -> DataFrame:
    return results.agg(F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("passed")).alias("failed")).withColumn("status", F.when(F.col("failed") == 0, "PASSED").otherwise("FAILED"))


def union(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)
