import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracask.functions import scalars as sc
from terracask.operators import numbering
from terracask.operators import checks, drift, geo, metrics, patches, raster, relational, scenes, splits, trees


def one(df, column):
    return df.first()[column]


# ---------------------------------------------------------------------- splits


def test_unit_interval_golden(spark):
    keys = {"42|la_pampa|0|2": 0.09541677715699134, "42|mining_training_area|1|0": 0.17566993758620675, "42|la_pampa|0|0": 0.9587123523127611}
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", sc.unit_interval(F.col("k")).alias("u"), sc.hash_seed(F.lit("42:la_pampa")).alias("s"))
    for r in df.collect():
        assert r["u"] == keys[r["k"]] and int(r["s"]) == 11777860368933412830


def test_block_edges_and_routing(spark):
    rows = [(1, "a", "dataset_development", 480, 0), (2, "a", "dataset_development", 481, 0), (3, "b", "held_out_test", 500, 0), (4, "c", "final_geographic_holdout", 500, 5)]
    df = splits.with_blocks(spark.createDataFrame(rows, "patch_key int, aoi_id string, role string, row_off int, col_off int"))
    assert [r["inside_block"] for r in df.orderBy("patch_key").collect()] == [True, False, False, False]
    kept = splits.block_split(splits.drop_boundary(df, F.col("role") != "dataset_development"))
    got = {r["patch_key"]: r["split"] for r in kept.collect()}
    assert got[3] == "test" and got[4] == "final_test" and 2 not in got


def test_overlapping_holdouts_and_unknown_roles_are_errors(spark):
    df = spark.createDataFrame([("a", "geographic_holdout")], "aoi_id string, role string")
    with pytest.raises(Exception, match="overlap"):
        df.select(splits.holdout_split(F.col("role"), F.col("aoi_id"), final_aois=("a",))).collect()
    with pytest.raises(Exception, match="unknown role"):
        splits.loao_folds(spark.createDataFrame([(1, "a", "other")], "patch_key int, aoi_id string, role string")).collect()


# --------------------------------------------------------------------- metrics


def scored(spark, n=400, seed=1, ties=20):
    draw = random.Random(seed)
    rows = [(draw.randrange(ties + 1) / ties, draw.randrange(2)) for _ in range(n)]
    return rows, spark.createDataFrame([("g", p, y) for p, y in rows], "g string, probability double, target int")


def test_auc_and_average_precision_with_ties(spark):
    rows, df = scored(spark)
    pos, neg = [p for p, y in rows if y], [p for p, y in rows if not y]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    assert math.isclose(one(metrics.roc_auc(df, ["g"]), "roc_auc"), auc, rel_tol=1e-12)
    ap, before = 0.0, 0
    for t in sorted({p for p, _ in rows}, reverse=True):
        tp, n = sum(p >= t for p in pos), sum(p >= t for p, _ in rows)
        ap, before = ap + (tp - before) / len(pos) * tp / n, tp
    assert math.isclose(one(metrics.average_precision(df, ["g"]), "average_precision"), ap, rel_tol=1e-12)


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([("g", 0.5, 1), ("g", 0.7, 1)], "g string, probability double, target int")
    assert one(metrics.roc_auc(df, ["g"]), "roc_auc") is None


def test_sweep_equals_plain_counting_on_grid_values(spark):
    ps = [i * 0.001 for i in range(0, 1001, 7)] + [1.0, 0.0, 0.5359999999, 0.9999999]
    df = spark.createDataFrame([("g", p, i % 2) for i, p in enumerate(ps)], "g string, probability double, target int")
    got = {round(r["threshold"] * 1000): r for r in metrics.threshold_sweep(df, ["g"]).collect()}
    assert len(got) == 1001
    for k, r in got.items():
        t = 1.0 if k == 1000 else k * 0.001
        assert r["tp"] == sum(p >= t and i % 2 == 1 for i, p in enumerate(ps)) and r["fp"] == sum(p >= t and i % 2 == 0 for i, p in enumerate(ps))


def test_published_confusion(spark):
    df = spark.createDataFrame([(560, 207, 595, 16090)], "tp int, fp int, fn int, tn int")
    r = metrics.prf(df).first()
    assert (round(r["precision"], 4), round(r["recall"], 4), round(r["f1"], 4)) == (0.7301, 0.4848, 0.5827)


def test_threshold_choice_falls_back_when_none_is_eligible(spark):
    df = spark.createDataFrame([(0.1, 0.2, 0.9, 0.3, 0.5), (0.2, 0.3, 0.8, 0.4, 0.1), (0.3, 0.3, 0.8, 0.4, 0.1)], "threshold double, recall double, precision double, f1 double, fpr double")
    best = metrics.select_threshold(df, recall=0.75).first()
    assert best["threshold"] == 0.3 and not best["eligible"]
    assert metrics.select_threshold(df, precision=0.85).first()["threshold"] == 0.1
    assert metrics.least_violation(df, 0.3, 0.1).first()["threshold"] == 0.3


def test_gates_and_null_group(spark):
    df = spark.createDataFrame([(None, 0.9, 1), (None, 0.1, 0), ("a", 0.2, 0)], "aoi_id string, probability double, target int")
    out = {r["aoi_id"]: r for r in metrics.alert_summary(metrics.with_prediction(df, 0.5)).collect()}
    assert out[None]["alert_rate"] == 0.5 and out["a"]["alert_count"] == 0
    g = metrics.gates(spark.createDataFrame([(0.9, 0.2)], "recall double, fpr double"), [("recall", ">=", 0.75), ("fpr", "<=", 0.1)])
    assert {r["metric"]: r["passed"] for r in g.collect()} == {"recall": True, "fpr": False}


# ----------------------------------------------------------------------- drift


def plain_drift(a, b, bins=10, eps=1e-6):
    edges = np.unique(np.quantile(np.concatenate([a, b]), np.linspace(0, 1, bins + 1)))
    smd = abs(b.mean() - a.mean()) / math.sqrt((a.var() + b.var()) / 2) if a.var() + b.var() > 0 else 0.0
    if len(edges) < 2:
        return smd, 0.0, 0.0
    place = [np.searchsorted(edges[1:-1], v, "right") for v in (a, b)]
    p, q = (np.bincount(x, minlength=len(edges) - 1) + eps for x in place)
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    return smd, float(((q - p) * np.log(q / p)).sum()), float(((p * np.log2(p / m)).sum() + (q * np.log2(q / m)).sum()) / 2)


def test_drift_against_numpy_with_edges_on_values_and_constants(spark):
    draw = np.random.default_rng(2)
    data = {"x": (draw.normal(size=401), draw.normal(0.5, 1.5, 200)), "steps": (draw.integers(0, 4, 300).astype(float), draw.integers(1, 6, 101).astype(float)), "flat": (np.ones(50), np.ones(20))}
    rows = [(f, s, float(v)) for f, pair in data.items() for s, values in zip(("r", "c"), pair) for v in values]
    got = {r["feature"]: r for r in drift.drift_table(spark.createDataFrame(rows, "feature string, split string, value double"), "r", "c").collect()}
    for f, (a, b) in data.items():
        for value, name in zip(plain_drift(a, b), ("smd", "psi", "jsd")):
            assert math.isclose(got[f][name], value, rel_tol=1e-9, abs_tol=1e-9), (f, name)


def test_order_statistics_are_exact(spark):
    draw = np.random.default_rng(3)
    values = np.concatenate([draw.normal(size=3000), np.repeat(0.25, 1500)])
    df = spark.createDataFrame([("f", float(v)) for v in values], "feature string, value double")
    got = one(drift.order_statistics(df, "feature", "value", [0, 0.1, 0.5, 0.77, 1]), "quantiles")
    assert got == [float(x) for x in np.quantile(values, [0, 0.1, 0.5, 0.77, 1])]


# ------------------------------------------------------------- patches, raster


def test_unknown_statistic_is_an_error():
    with pytest.raises(ValueError):
        patches.statistic("mode", F.lit(1))


def test_window_fraction_against_brute_force(spark):
    draw = np.random.default_rng(4)
    grid = draw.random((48, 56)) < 0.6
    px = spark.createDataFrame([("a", r, c, bool(grid[r, c])) for r in range(48) for c in range(56)], "aoi_id string, row int, col int, valid boolean")
    got = {(r["row_off"], r["col_off"]): r["valid_pixels"] for r in patches.window_valid_fraction(px, ["aoi_id"], F.lit(48), F.lit(56)).collect()}
    windows = patches.windows(spark.createDataFrame([("a", 48, 56), ("small", 31, 90)], "aoi_id string, height int, width int")).collect()
    assert len(windows) == 3 * 4
    for w in windows:
        assert got[w["row_off"], w["col_off"]] == grid[w["row_off"] : w["row_off"] + 32, w["col_off"] : w["col_off"] + 32].sum()


@pytest.mark.parametrize("size,stride", [(32, 12), (10, 4), (7, 7), (9, 20)])
def test_window_fraction_of_any_stride_and_none_outside(spark, size, stride):
    draw = np.random.default_rng(5)
    grid = draw.random((50, 61)) < 0.7
    px = spark.createDataFrame([("a", r, c, bool(grid[r, c])) for r in range(50) for c in range(61)], "aoi_id string, row int, col int, valid boolean")
    got = {(r["row_off"], r["col_off"]): r["valid_pixels"] for r in patches.window_valid_fraction(px, ["aoi_id"], F.lit(50), F.lit(61), size, stride).collect()}
    want = {(r, c): int(grid[r : r + size, c : c + size].sum()) for r in range(0, 50 - size + 1, stride) for c in range(0, 61 - size + 1, stride)}
    assert got == {k: v for k, v in want.items() if v}
    whole = patches.window_valid_fraction(px.withColumn("valid", F.lit(True)), ["aoi_id"], F.lit(50), F.lit(61), size, stride)
    assert {r["valid_fraction"] for r in whole.collect()} == {1.0}


def test_raster_blocks_and_footprints(spark):
    blocks = patches.raster_blocks(spark.createDataFrame([("a", 600, 512)], "aoi_id string, height int, width int")).collect()
    assert sorted((r["block_row_off"], r["block_col_off"], r["block_height"], r["block_width"]) for r in blocks) == [(0, 0, 512, 512), (512, 0, 88, 512)]
    df = spark.createDataFrame([(0, 0), (32, 31), (33, 0), (-1, 0), (None, 0)], "row_off int, col_off int").select(patches.footprint_inside(F.lit(64), F.lit(63)).alias("i"))
    assert [r["i"] for r in df.collect()] == [True, True, False, False, False]


def test_scale_by_type_and_by_the_centre(spark):
    rows = [(r, c, 0.5 if 10 <= r < 20 and 10 <= c < 20 else 9.0) for r in range(30) for c in range(30)]
    df = spark.createDataFrame(rows, "row int, col int, v double")
    raster_sample, raster.SAMPLE = raster.SAMPLE, 10
    try:
        assert one(raster.detect_scale(df, ["v"], 30, 30), "scale") == 1.0
        assert one(raster.detect_scale(df.withColumn("w", F.col("v") + 2), ["v", "w"], 30, 30), "scale") == 0.0001
        assert one(raster.detect_scale(df.withColumn("n", F.lit(1)), ["v", "n"], 30, 30), "scale") == 0.0001
        assert one(raster.detect_scale(df.withColumn("n", F.lit(1)), ["n"], 30, 30, scale=1.0), "scale") == 1.0
    finally:
        raster.SAMPLE = raster_sample


def test_seeded_cap(spark):
    df = spark.createDataFrame([("a", i) for i in range(500)] + [("b", 1)], "g string, k int")
    got = patches.seeded_cap(df, "g", "k", 7, 30).collect()
    want = sorted(range(500), key=lambda i: hashlib.sha256(f"7:a:{i}".encode()).hexdigest())[:30]
    assert {r["k"] for r in got if r["g"] == "a"} == set(want) and len(got) == 31
    assert patches.seeded_cap(df, "g", "k", 7, None).count() == 501


def test_numbers_of_hot_keys(spark):
    draw = np.random.default_rng(2)
    rows = [(0.5, int(k)) for k in draw.permutation(400)] + [(float(v), int(k)) for v, k in zip(draw.random(200), draw.permutation(200))] + [(None, int(k)) for k in draw.permutation(50)]
    df = spark.createDataFrame([("g", *r) for r in rows], "by string, p double, k int")
    got = sorted((r["at"], r["p"], r["k"]) for r in numbering.numbered(df, "by", ["p", "k"], "at", ranges=16).collect())
    assert [(p, k) for _, p, k in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])) and [a for a, *_ in got] == list(range(650))


def test_published_window_count(spark):
    grid = spark.createDataFrame([("h", 1338, 1528)], "aoi_id string, height int, width int")
    assert patches.windows(grid).count() == 30832


def test_composite_skips_nulls_and_averages_the_middle(spark):
    rows = [("a", 1, 1.0, None), ("a", 1, 4.0, 2.0), ("a", 1, None, 3.0), ("a", 2, None, None)]
    got = {r["cell"]: r for r in raster.composite(spark.createDataFrame(rows, "aoi_id string, cell int, nir double, red double"), ["aoi_id", "cell"], ["nir", "red"]).collect()}
    assert (got[1]["nir"], got[1]["red"], got[1]["valid"]) == (2.5, 2.5, True) and not got[2]["valid"]


def test_ndvi_near_zero_and_labels(spark):
    df = spark.createDataFrame([(0.5, 0.1), (1e-7, 0.0), (-0.2, 0.1)], "n double, r double").select(raster.ndvi(F.col("n"), F.col("r")).alias("v"))
    a, b, c = [r["v"] for r in df.collect()]
    assert math.isclose(a, 0.4 / 0.600001) and b is None and math.isclose(c, -0.3 / -0.100001)
    rows = [(30, 19, True, True, 1), (30, 22, True, True, 1), (30, 23, True, True, 0), (30, 0, True, True, 0), (29, 20, True, True, 255), (50, 18, True, True, 255), (50, 20, False, True, 255), (None, 20, True, True, 255)]
    df = spark.createDataFrame(rows, "t int, l int, s boolean, i boolean, want int").select(raster.loss_label(F.col("t"), F.col("l"), F.col("s"), F.col("i")).alias("got"), "want")
    assert all(r["got"] == r["want"] for r in df.collect())


def test_resampling_of_a_ramp(spark):
    source = spark.createDataFrame([("a", r, c, float(10 * r + c)) for r in range(6) for c in range(6)], "aoi_id string, row int, col int, v double")
    target = spark.createDataFrame([("a", i, 1.0 + i * 0.5, 2.25) for i in range(5)], "aoi_id string, i int, x double, y double")
    near = raster.sample_nearest(target, source, F.col("x"), F.col("y"), ["aoi_id"], ["v"])
    assert all(r["v"] == 10 * math.floor(r["y"]) + math.floor(r["x"]) for r in near.collect())
    for r in raster.sample_bilinear(target, source, F.col("x"), F.col("y"), ["aoi_id"], ["i"], ["v"]).collect():
        assert math.isclose(r["v"], 10 * (2.25 - 0.5) + (1.0 + r["i"] * 0.5 - 0.5))


def test_bands_resolve_to_exactly_one(spark):
    df = spark.createDataFrame([("s", 1, "Blue"), ("s", 2, "B08 ")], "source string, index int, description string")
    assert {r["band"]: r["index"] for r in raster.resolve_bands(df, {"blue": ["blue", "b02"], "nir": ["b08"]}).collect()} == {"blue": 1, "nir": 2}
    with pytest.raises(Exception, match="exactly one"):
        raster.resolve_bands(df, {"red": ["b04"]}).collect()


# ---------------------------------------------------------------------- scenes


def test_items_flatten_and_cloud_limit(spark):
    items = [("complete", ["B02", "SCL"], 20.0), ("lacks", ["B02"], 20.1), ("null", ["B02", "SCL"], None)]
    rows = [((i, "c", [0.0, 1.0], ("2020", cloud, "p", "02.12", 32719), [("other", "x"), ("self", "http://s/" + i), ("self", "y")], {a: ("h/" + a,) for a in assets}),) for i, assets, cloud in items]
    df = scenes.flatten_items(spark.createDataFrame([*rows, ((None, None, None, None, None, None),)], f"item {scenes.ITEM}"), ["B02", "SCL"], "asked")
    got = {r["item_id"]: r for r in df.collect()}
    assert got["complete"]["status"] == "discovered" and got["lacks"]["missing_assets"] == "SCL" and got["lacks"]["SCL_href"] == "" and got["null"]["source_uri"] == "http://s/null"
    assert got["complete"]["processing_baseline"] == "02.12" and got["complete"]["proj_epsg"] == 32719 and got["complete"]["bbox"] == "[0.0,1.0]"
    bare = got[""]
    assert (bare["collection"], bare["bbox"], bare["missing_assets"], bare["status"], bare["source_uri"]) == ("asked", "[]", "B02;SCL", "missing_required_assets", "")
    assert [r["item_id"] for r in scenes.within_cloud_limit(df, 20.0).collect()] == ["complete"]


def test_published_score(spark):
    df = spark.createDataFrame([(499060, 504173, 12.441118)], "valid_pixels int, aoi_pixels int, cloud_cover double")
    assert one(scenes.with_score(df), "score") == 97.2718


def test_greedy_prefers_gain_then_score_then_rank(spark):
    px = [("a", s, p) for s, ps in {1: range(5), 2: range(4, 12), 3: range(8), 4: range(8)}.items() for p in ps]
    df = spark.createDataFrame(px, "aoi string, scene int, pixel int")
    ranks = spark.createDataFrame([("a", 1, 9.0, 1), ("a", 2, 1.0, 4), ("a", 3, 5.0, 3), ("a", 4, 5.0, 2)], "aoi string, scene int, score double, rank int")
    totals = spark.createDataFrame([("a", 20)], "aoi string, total int")
    got = [(r["scene"], r["gain_pixels"]) for r in scenes.greedy_cover(df, ranks, "aoi", "scene", "pixel", totals).orderBy("selection_order").collect()]
    assert got == [(4, 8), (2, 4)]


def test_signing(spark):
    df = spark.createDataFrame([("h",), ("h?a",)], "u string").select(sc.signed_url(F.col("u"), "t").alias("u"))
    assert [r["u"] for r in df.collect()] == ["h?t", "h?a&t"]


# ------------------------------------------------------------------------- geo

GRIDS = {
    "la_pampa": (-70.0100, -13.0500, -69.8900, -12.9500, 1307, 1112, 1439435),
    "mining_training_area": (-70.4500, -12.9500, -70.3000, -12.8300, 1636, 1337, 2160717),
    "inambari_development": (-70.1800, -13.3000, -70.0400, -13.1800, 1524, 1335, 2013446),
    "iberia_final_holdout": (-69.6500, -11.5000, -69.5100, -11.3800, 1531, 1331, 2026507),
}


def test_published_grids(spark):
    bounds = spark.createDataFrame([(k, *v[:4]) for k, v in GRIDS.items()], "aoi_id string, min_lon double, min_lat double, max_lon double, max_lat double")
    grids = geo.grid_of_bounds(bounds, 32719, 10.0)
    assert {r["aoi_id"]: (r["width"], r["height"]) for r in grids.collect()} == {k: v[4:6] for k, v in GRIDS.items()}
    first = bounds.where("aoi_id = 'la_pampa'")
    assert geo.cells_inside(grids.where("aoi_id = 'la_pampa'"), first, 32719).count() == GRIDS["la_pampa"][6]


def test_footprints_close_and_round_trip(spark):
    df = spark.createDataFrame([("a", 390000.0, 8570000.0, 10.0, 64, 128)], "aoi_id string, left double, top double, resolution double, row_off int, col_off int")
    ring = one(geo.patch_polygons(df, 32719), "polygon")
    assert len(ring) == 5 and ring[0] == ring[4]
    back = spark.createDataFrame([(ring[0][0], ring[0][1])], "lon double, lat double").select(*(c.alias(n) for c, n in zip(geo.to_utm(F.col("lon"), F.col("lat"), 32719), "en"))).first()
    assert math.isclose(back["e"], 391280.0, abs_tol=0.01) and math.isclose(back["n"], 8569360.0, abs_tol=0.01)
    with pytest.raises(ValueError):
        geo.zone_meridian(4326)


# ------------------------------------------------------------------ relational


def test_exactly_once(spark):
    left = spark.createDataFrame([("a", 2018, "x")], "aoi string, year int, item string")
    right = spark.createDataFrame([("a", 2018, "x", "h1")], "aoi string, year int, item string, href string")
    keys = ["aoi", "year", "item"]
    assert relational.exactly_once(left, right, keys).first()["href"] == "h1"
    for bad in (right.union(right), right.limit(0)):
        with pytest.raises(Exception, match="not exactly once"):
            relational.exactly_once(left, bad, keys).collect()
    for repeated in (right.union(right), right.union(right.withColumn("aoi", F.lit("other"))).union(right.withColumn("aoi", F.lit("other")))):
        with pytest.raises(Exception, match="repeated keys"):
            relational.lookup(left, repeated, keys).collect()
    assert relational.lookup(left, right, keys).first()["href"] == "h1"


def test_guarded_joins(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(1, "p"), (2, "q")], "k int, b string")
    assert relational.one_to_one(a, b, ["k"]).count() == relational.covering(a, b, ["k"]).count() == 2
    for bad in (b.where("k = 1"), b.union(b.where("k = 1")), b.union(spark.createDataFrame([(3, "r")], b.schema))):
        with pytest.raises(Exception, match="not once on both sides"):
            relational.one_to_one(a, bad, ["k"]).collect()
    with pytest.raises(Exception, match="one side lacks"):
        relational.covering(a, b.where("k = 1"), ["k"]).collect()
    with pytest.raises(Exception, match="selected ids missing"):
        relational.selected(a, spark.createDataFrame([(1,), (9,)], "k int"), "k", whole=True).collect()
    years = spark.createDataFrame([("x", 2018, 1), ("x", 2022, 2), ("y", 2018, 3)], "aoi string, year int, v int")
    assert relational.paired_years(years.where("aoi = 'x'"), "aoi", "year", 2018, 2022, ["v"]).first().asDict() == {"aoi": "x", "v_2018": 1, "v_2022": 2}
    with pytest.raises(Exception, match="not exactly one row"):
        relational.paired_years(years, "aoi", "year", 2018, 2022, ["v"]).collect()
    judged = relational.accept_reject(a, [("no x", F.col("a") == "x")])
    assert [r["k"] for r in relational.accepted(judged).collect()] == [1]
    with pytest.raises(Exception, match="no row is accepted"):
        relational.accepted(relational.accept_reject(a, [("never", F.length("a") > 5)])).collect()


def test_boxes_of_all_sizes_against_brute_force(spark):
    draw = np.random.default_rng(6)
    rows = [(i, float(x), float(y), float(x + w), float(y + h)) for i, (x, y, w, h) in enumerate(zip(draw.uniform(-60, 60, 120), draw.uniform(-60, 60, 120), draw.choice([0.001, 0.4, 3, 40], 120), draw.choice([0.001, 0.7, 5, 20], 120)))]
    rows.append((200, -180.0, -90.0, 180.0, 90.0))
    got = relational.overlapping_boxes(spark.createDataFrame(rows, "box_id int, min_lon double, min_lat double, max_lon double, max_lat double")).collect()
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] < b[3] and b[1] < a[3] and a[2] < b[4] and b[2] < a[4]}
    assert {(r["left_id"], r["right_id"]) for r in got} == want and len(got) == len(want)


def test_touching_boxes_don_t_overlap(spark):
    rows = [(1, 0.0, 0.0, 2.0, 2.0), (2, 2.0, 0.0, 3.0, 2.0), (3, 1.5, 1.5, 2.5, 2.5), (4, -3.5, -3.5, 9.0, 9.0)]
    got = relational.overlapping_boxes(spark.createDataFrame(rows, "box_id int, min_lon double, min_lat double, max_lon double, max_lat double"))
    assert sorted((r["left_id"], r["right_id"]) for r in got.collect()) == [(1, 3), (1, 4), (2, 3), (2, 4), (3, 4)]


def test_set_checks_and_canonical_names(spark):
    a = spark.createDataFrame([(" x ", 1), ("y", 1)], "` AOI` string, n int")
    c = relational.canonicalize(a, {"aoi_id": ("aoi",)}, ["aoi_id"])
    assert c.columns == ["aoi_id", "n"] and c.first()["aoi_id"] == "x"
    with pytest.raises(KeyError):
        relational.canonicalize(a, {}, ["aoi_id"])
    r = relational.same_set(c, c.union(c.limit(1))).first()
    assert (r["only_left"], r["only_right"], r["equal"]) == (0, 1, False)


def test_checks(spark):
    df = spark.createDataFrame([(1, 0.5, "a"), (1, 2.0, "b"), (2, None, "a")], "id int, p double, s string")
    got = {r["name"]: (r["passed"], r["detail"]) for r in checks.union(checks.run_checks(df, [checks.Check("range", F.col("p") <= 1)]), checks.unique_check(df, "ids", ["id"]), checks.values_check(df, "all", "s", ["a", "b"]), checks.isolation_check(df, "one", ["id"], "s")).collect()}
    assert got == {"range": (False, "2 violations"), "non_empty": (True, "3 rows"), "ids": (False, "1 repeated keys"), "all": (True, "a|b"), "one": (False, "1 violations")}
    stated = spark.createDataFrame([("x", 0.5)], "k string, f1 double")
    assert checks.recompute_check(stated, stated.withColumn("f1", F.col("f1") + 1e-9), ["k"], ["f1"]).first()["passed"] is False
    assert checks.recompute_check(stated, stated, ["k"], ["f1"]).first()["passed"] is True


# ----------------------------------------------------------------------- trees


def test_trees_separate_and_repeat(spark):
    draw = np.random.default_rng(1)
    rows = [(float(a), float(b), int(a + 0.3 * b > 0)) for a, b in draw.normal(size=(300, 2))]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    nodes = trees.fit_trees(df, ["a", "b"], "y", trees=12)
    scored_ = trees.score(df, nodes, ["a", "b"])
    assert one(metrics.roc_auc(scored_.withColumn("g", F.lit(1)), ["g"], label="y"), "roc_auc") > 0.97
    r = scored_.agg(F.min("probability"), F.max("probability")).first()
    assert 0 <= r[0] <= r[1] <= 1
    imp = {r["feature"]: r["importance"] for r in trees.importances(nodes, ["a", "b"]).collect()}
    assert math.isclose(sum(imp.values()), 1) and imp["a"] > imp["b"]
    again = trees.fit_trees(df, ["a", "b"], "y", trees=12).orderBy("tree", "node").collect()
    assert again == nodes.orderBy("tree", "node").collect()
    with pytest.raises(KeyError):
        trees.score(df.drop("a"), nodes, ["a", "b"])


def _points(spark, n=600):
    draw = np.random.default_rng(3)
    return spark.createDataFrame([(float(a), float(b), float(c), int(a + 0.3 * b > 0)) for a, b, c in draw.normal(size=(n, 3))], "a double, b double, c double, y int")


@pytest.mark.parametrize("bootstrap", [False, True])
def test_large_tables_are_split_where_they_are(spark, bootstrap):
    df = _points(spark)
    args = dict(trees=6, bootstrap=bootstrap, depth=12, leaf=3, packed_cells=0, small=60)
    nodes = trees.fit_trees(df, ["a", "b", "c"], "y", **args)
    rows = nodes.collect()
    assert len({(r["tree"], r["node"]) for r in rows}) == len(rows)
    by = {(r["tree"], r["node"]): r for r in rows}
    for r in rows:  # every split has its children, and they share out its weight
        if r["feature"] >= 0:
            left, right = by[r["tree"], r["left_child"]], by[r["tree"], r["right_child"]]
            assert math.isclose(left["weight"] + right["weight"], r["weight"], rel_tol=1e-9)
    assert {r["tree"] for r in rows} == set(range(6)) and max(r["node"] for r in rows) >= 1 << 32
    scored_ = trees.score(df, nodes, ["a", "b", "c"]).withColumn("g", F.lit(1))
    assert one(metrics.roc_auc(scored_, ["g"], label="y"), "roc_auc") > 0.97
    again = trees.fit_trees(df.repartition(7), ["a", "b", "c"], "y", **args).orderBy("tree", "node").collect()
    assert [tuple(r)[:5] for r in again] == [tuple(r)[:5] for r in nodes.orderBy("tree", "node").collect()]


def test_node_statistics_against_numpy(spark):
    """Each node's value and weight are those of the rows that walk to it."""
    df = _points(spark, 300)
    nodes = trees.fit_trees(df, ["a", "b", "c"], "y", trees=2, packed_cells=0, small=40, balanced=False).collect()
    by = {(r["tree"], r["node"]): r for r in nodes}
    rows = [tuple(r) for r in df.collect()]
    for t in (0, 1):
        held = {}
        for r in rows:
            at = 0
            while True:
                held.setdefault(at, []).append(r[3])
                node = by[t, at]
                if node["feature"] < 0:
                    break
                at = node["left_child"] if r[node["feature"]] <= node["threshold"] else node["right_child"]
        assert set(held) == {n for tree, n in by if tree == t}
        for at, labels in held.items():
            assert by[t, at]["weight"] == len(labels) and math.isclose(by[t, at]["value"], sum(labels) / len(labels))


def test_sweep_selects_and_calibration_is_held_out(spark):
    df = _points(spark, 400).withColumn("aoi", F.when(F.col("c") > 0, "p").otherwise("q"))
    train, validation = df.where("b > -0.5"), df.where("b <= -0.5")
    candidates = [{"id": 1, "trees": 4, "features": ["c"]}, {"id": 2, "trees": 8}, {"id": 3, "trees": 4, "calibration": "sigmoid"}]
    table, nodes = trees.sweep(train, validation, candidates, ["a", "b", "c"], "y", "aoi", 0.6)
    rows = {r["candidate_id"]: r for r in table.collect()}
    assert set(nodes) == {1, 2} and [r["feature_count"] for r in rows.values()] == [1, 3, 3]
    assert sum(r["selected"] for r in rows.values()) == 1 and not rows[1]["selected"]
    got = {r["name"]: r["passed"] for r in checks.selection_checks(table, "selected", "eligible", ["pr_auc", "worst_pr_auc", "f1"], "candidate_id").collect()}
    assert got == {"one_selected": True, "ranking_reproduces": True}
    for wrong in (F.lit(True), F.col("candidate_id") == 1):
        bad = checks.selection_checks(table.withColumn("selected", wrong), "selected", "eligible", ["pr_auc", "worst_pr_auc", "f1"], "candidate_id").collect()
        assert not all(r["passed"] for r in bad)
    with pytest.raises(KeyError):
        trees.sweep(train, validation, [{"id": 1, "features": ["z"]}], ["a"], "y", "aoi")
    with pytest.raises(ValueError):
        trees.calibrated(train, ["a"], "y", method="isotonic")
    models = trees.calibrated(train, ["a", "b"], "y", trees=4)
    assert len(models) == 3 and all(slope > 0 for _, slope, _ in models)
    assert trees.score_calibrated(train, models, ["a", "b"]).where("probability NOT BETWEEN 0 AND 1").count() == 0


def test_suites_fail_where_they_should(spark):
    flags = spark.createDataFrame([(["train", "test"], True, 3, 2, 2)], "selection_used_splits array<string>, test_used_for_selection boolean, locked_at int, test_evaluated_at int, test_evaluations int")
    assert [r["passed"] for r in checks.protocol_checks(flags).collect() if r["name"] != "non_empty"] == [False] * 4
    a, b = spark.createDataFrame([(1, 0)], "k int, y int"), spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "k int, y int")
    assert not checks.keys_check(a, b, "keys", ["k"]).first()["passed"] and checks.keys_check(a, a, "keys", ["k"]).first()["passed"]
    assert not checks.classes_check(b, "classes", ["k"], "y").first()["passed"] and checks.classes_check(b.where("k = 1"), "classes", ["k"], "y").first()["passed"]
    assert tuple(checks.columns_check(a, "columns", ["k", "z"]).first()) == ("columns", False, "z")
    areas = spark.createDataFrame([("good",), ("bad",)], "aoi_id string")
    composites = spark.createDataFrame([("good", 2018, 90.0), ("good", 2022, 85.0), ("bad", 2018, 10.0)], "aoi_id string, target_year int, valid_coverage_pct double")
    labels = spark.createDataFrame([("good", 5, 5, 99.0)], "aoi_id string, positive_pixels int, negative_pixels int, eligible_coverage_pct double")
    got = {r["aoi_id"]: (r["status"], r["failed_checks"]) for r in checks.label_audit(areas, composites, labels, (2018, 2022), 80.0, 95.0).collect()}
    assert got == {"good": ("PASSED", ""), "bad": ("FAILED", "has_two_composites|composite_coverage|single_label_row|eligible_coverage|both_classes")}


def test_sweep_refuses_scores_that_are_none(spark):
    for bad in (None, -0.1, 1.5, float("nan")):
        with pytest.raises(Exception, match="outside"):
            metrics.threshold_sweep(spark.createDataFrame([(0.5, 1), (bad, 0)], "probability double, target int")).collect()
