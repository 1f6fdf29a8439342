"""Raster, window and scene queries over adapter views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import patch_id
from ..operators import patches, raster, scenes
from .adapters import PIXELS, SCENE_PX, pixels, scene_px, table

_KEYS = ["aoi_id", "cell"]


def _masked(spark, sf_dir):
    px = pixels(spark, sf_dir)
    ok = raster.class_valid(F.col("scl"))
    return px.withColumns({"nir": F.when(ok, F.col("nir")), "red": F.when(ok, F.col("red"))})


def scl_mask_counts(spark, sf_dir):
    px = pixels(spark, sf_dir).withColumn("valid", raster.class_valid(F.col("scl")))
    return px.groupBy("aoi_id", "scl").agg(F.count_if("valid").alias("valid"), F.count(F.lit(1)).alias("n"))


def nanmedian_composite(spark, sf_dir):
    return raster.composite(_masked(spark, sf_dir), _KEYS, ["nir", "red"])


def reflectance_scaling(spark, sf_dir):
    """Raw values scaled where the class is valid and the value positive."""
    px = pixels(spark, sf_dir).withColumn("raw", (F.col("cell") * 37 % 10001).cast("int"))
    value = raster.reflectance(F.col("raw"), raster.class_valid(F.col("scl")))
    return px.withColumn("v", value).groupBy("aoi_id", "cell").agg(F.count("v").alias("n"), F.round(F.max("v"), 9).alias("most"))


def scale_detection(spark, sf_dir):
    """Of a raster of 600 x 700 cells: two bands of reflectance, two of larger values, two of integers."""
    l = table(spark, sf_dir, "lineitem")
    raw = F.col("l_orderkey") * 37 % 10001
    px = l.select(
        (F.col("l_orderkey") % 600).alias("row"), (F.col("l_partkey") % 700).alias("col"), (raw / F.lit(10001.0)).alias("r0"), (F.col("l_quantity") / F.lit(50.0)).alias("r1"),
        raw.cast("double").alias("v0"), F.col("l_quantity").alias("v1"), raw.cast("int").alias("i0"), F.col("l_linenumber").alias("i1"),
    )
    kinds = [raster.detect_scale(px, bands, 600, 700).withColumn("bands", F.lit(name)) for name, bands in (("reflectance", ["r0", "r1"]), ("values", ["v0", "v1"]), ("integers", ["i0", "i1"]))]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).withColumn("p99", F.round("p99", 6))


def ndvi_features(spark, sf_dir):
    """NDVI of two epochs, odd and even scenes, their change, and the pixel's validity."""
    px = _masked(spark, sf_dir).withColumn("epoch", F.col("scene") % 2)
    both = px.groupBy(*_KEYS).agg(*(F.median(F.when(F.col("epoch") == e, F.col(b))).alias(f"{b}{e}") for e in (0, 1) for b in ("nir", "red")))
    before, after = raster.ndvi(F.col("nir0"), F.col("red0")), raster.ndvi(F.col("nir1"), F.col("red1"))
    both = both.withColumns({"ndvi0": before, "ndvi1": after})
    valid = raster.pixel_valid(None, [F.col(c) for c in ("nir0", "red0", "nir1", "red1")], [], F.col("ndvi0"), F.col("ndvi1"))
    return both.select(*_KEYS, F.round("ndvi0", 9).alias("ndvi0"), F.round("ndvi1", 9).alias("ndvi1"), F.round(F.col("ndvi1") - F.col("ndvi0"), 9).alias("change"), valid.alias("valid"))


def _label_px(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    px = l.join(p, l.l_partkey == p.p_partkey)
    tree, loss = F.col("p_size") * 2, (F.col("l_suppkey") % 26).cast("int")
    label = raster.loss_label(tree, loss, F.col("l_linenumber") <= 6, raster.class_valid(F.col("l_suppkey") % 12))
    return px.select(F.col("l_returnflag").alias("aoi_id"), F.col("l_partkey").alias("cell"), loss.alias("loss"), label.alias("label"))


def label_algebra(spark, sf_dir):
    return _label_px(spark, sf_dir).groupBy("aoi_id", "label").agg(F.count(F.lit(1)).alias("n"))


def patch_label_counts(spark, sf_dir):
    px = _label_px(spark, sf_dir).withColumn("patch", F.floor(F.col("cell") / 16).cast("bigint"))
    out = patches.label_counts(px, ["aoi_id", "patch"])
    return out.withColumns({"loss_binary": patches.binary_label(F.col("loss_fraction")), "loss_fraction": F.round("loss_fraction", 9)})


def annual_loss(spark, sf_dir):
    return raster.annual_loss(_label_px(spark, sf_dir), ["aoi_id"], "loss", F.col("label") != 255)


def valid_coverage(spark, sf_dir):
    px = _label_px(spark, sf_dir)
    return raster.coverage(px, ["aoi_id"], F.col("label") == 1, F.col("label") != 255).withColumn("coverage_pct", F.round("coverage_pct", 9))


def mosaic_first(spark, sf_dir):
    """Overlapping tiles, by line number, of part cells: the first with data wins; clipped."""
    px = pixels(spark, sf_dir).withColumns({"value": F.when(raster.class_valid(F.col("scl")), F.col("scl")), "x": F.col("cell") % 40, "y": F.floor(F.col("cell") / 40).cast("bigint")})
    px = px.withColumn("tile", F.struct("scene", "value"))  # tiles are in order of scene, then value
    return raster.mosaic(raster.clip(px, "x", "y", 5, -1, 30, 40), ["aoi_id", "x", "y"], "value", "tile")


def _grids(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_name").alias("aoi_id"), (F.col("n_nationkey") * 5 + 20).cast("int").alias("height"), (F.col("n_nationkey") * 3 + 32).cast("int").alias("width"))


def sliding_windows(spark, sf_dir):
    w = patches.windows(_grids(spark, sf_dir))
    return w.select("aoi_id", "row_off", "col_off", patch_id(F.col("aoi_id"), F.col("row_off"), F.col("col_off")).alias("patch_id"))


def window_valid_fraction(spark, sf_dir):
    """Valid shares of the windows of 64 x 64 grids."""
    l = table(spark, sf_dir, "lineitem")
    cell = l.select(F.col("l_returnflag").alias("aoi_id"), (F.col("l_partkey") % 64).alias("row"), (F.col("l_orderkey") % 64).alias("col"), F.col("l_quantity"))
    px = cell.groupBy("aoi_id", "row", "col").agg((F.max("l_quantity") >= 25).alias("valid"))
    w = patches.window_valid_fraction(px, ["aoi_id"], F.lit(64), F.lit(64), 32, 12)
    return w.where("valid_fraction >= 0.3")


def _scene_table(spark, sf_dir):
    px = scene_px(spark, sf_dir).distinct()
    totals = px.groupBy("aoi_id").agg(F.count_distinct("pixel").alias("total"))
    s = px.groupBy("aoi_id", "scene").agg(F.count(F.lit(1)).alias("valid_pixels")).join(totals, "aoi_id")
    s = s.withColumns({"aoi_pixels": F.col("total"), "cloud_cover": (F.col("scene") * 7 % 40).cast("double"), "datetime": F.col("scene") % 5})
    return px, totals, scenes.ranked(scenes.with_score(s), ["aoi_id"], "scene")


def scene_rank(spark, sf_dir):
    _, _, r = _scene_table(spark, sf_dir)
    return r.select("aoi_id", "scene", "valid_pixels", F.round("valid_pct", 6).alias("valid_pct"), F.round("invalid_pct", 6).alias("invalid_pct"), "score", "rank")


def greedy_scene_select(spark, sf_dir):
    px, totals, r = _scene_table(spark, sf_dir)
    chosen = scenes.greedy_cover(px, r.select("aoi_id", "scene", "score", "rank"), "aoi_id", "scene", "pixel", totals, least=99.5)
    return chosen.withColumn("coverage_pct", F.round("coverage_pct", 6))


def selected_item_lists(spark, sf_dir):
    """The three best ranked scenes of each area, in one string."""
    _, _, r = _scene_table(spark, sf_dir)
    return scenes.joined_ids(r.where("rank <= 3"), ["aoi_id"], "scene", "rank")


def selection_status(spark, sf_dir):
    _, _, r = _scene_table(spark, sf_dir)
    return scenes.run_status(r.groupBy("aoi_id").agg(F.max("valid_pct").alias("best")), F.col("best") > 10, 5)


QUERIES = {
    f.__name__: f
    for f in (
        scl_mask_counts, nanmedian_composite, reflectance_scaling, scale_detection, ndvi_features, label_algebra, patch_label_counts, annual_loss, valid_coverage,
        mosaic_first, sliding_windows, window_valid_fraction, scene_rank, greedy_scene_select, selected_item_lists, selection_status,
    )
}

_OK = "scl NOT IN (0, 1, 3, 8, 9, 10, 11) AND scl <> 255"
_LABEL = """lpx AS (SELECT l_returnflag AS aoi_id, l_partkey AS cell, (l_suppkey % 26)::INTEGER AS loss,
  CASE WHEN NOT (l_linenumber <= 6 AND l_suppkey % 12 NOT IN (0, 1, 3, 8, 9, 10, 11) AND p_size * 2 >= 30 AND NOT (l_suppkey % 26 BETWEEN 1 AND 18)) THEN 255
    WHEN l_suppkey % 26 BETWEEN 19 AND 22 THEN 1 ELSE 0 END AS label FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_SCENES = f"""{SCENE_PX}, px AS (SELECT DISTINCT * FROM scene_px), tot AS (SELECT aoi_id, count(DISTINCT pixel) AS total FROM px GROUP BY aoi_id),
v AS (SELECT aoi_id, scene, count(*)::BIGINT AS valid_pixels, any_value(total) AS total FROM px JOIN tot USING (aoi_id) GROUP BY aoi_id, scene),
sc AS (SELECT *, 100::DOUBLE * valid_pixels / total AS valid_pct, (scene * 7 % 40)::DOUBLE AS cloud FROM v),
rk AS (SELECT *, 100 - valid_pct AS invalid_pct, round(0.85::DOUBLE * valid_pct + 0.15::DOUBLE * (100 - cloud), 4) AS score FROM sc),
r AS (SELECT *, row_number() OVER (PARTITION BY aoi_id ORDER BY score DESC, valid_pct DESC, cloud, scene % 5, scene)::INTEGER AS rank FROM rk)"""
_NDVI = "CASE WHEN abs({a} + {b}) > 1e-6::DOUBLE THEN ({a} - {b}) / ({a} + {b} + sign({a} + {b}) * 1e-6::DOUBLE) END"

SQL = {
    "scl_mask_counts": f"WITH {PIXELS} SELECT aoi_id, scl, count(*) FILTER ({_OK})::BIGINT AS valid, count(*)::BIGINT AS n FROM pixels GROUP BY ALL",
    "nanmedian_composite": f"""WITH {PIXELS}, k AS (SELECT aoi_id, cell, CASE WHEN {_OK} THEN nir END AS nir, CASE WHEN {_OK} THEN red END AS red FROM pixels)
  SELECT aoi_id, cell, median(nir) AS nir, median(red) AS red, count(nir)::BIGINT AS observations, median(nir) IS NOT NULL AND median(red) IS NOT NULL AS valid FROM k GROUP BY aoi_id, cell""",
    "reflectance_scaling": f"""WITH {PIXELS}, v AS (SELECT aoi_id, cell, CASE WHEN {_OK} AND cell * 37 % 10001 > 0 THEN (cell * 37 % 10001) * 0.0001::DOUBLE END AS v FROM pixels)
  SELECT aoi_id, cell, count(v)::BIGINT AS n, round(max(v), 9) AS most FROM v GROUP BY aoi_id, cell""",
    "scale_detection": """WITH s AS (SELECT (l_orderkey * 37 % 10001)::DOUBLE AS raw, l_quantity AS q, l_linenumber::DOUBLE AS n FROM lineitem WHERE l_orderkey % 600 BETWEEN 44 AND 555 AND l_partkey % 700 BETWEEN 94 AND 605),
  p AS (SELECT 'reflectance' AS bands, greatest(quantile_cont(raw / 10001, 0.99), quantile_cont(q / 50, 0.99)) AS p, false AS whole FROM s UNION ALL SELECT 'values', greatest(quantile_cont(raw, 0.99), quantile_cont(q, 0.99)), false FROM s
    UNION ALL SELECT 'integers', greatest(quantile_cont(raw, 0.99), quantile_cont(n, 0.99)), true FROM s)
  SELECT bands, round(p, 6) AS p99, CASE WHEN whole OR p > 2 THEN 0.0001::DOUBLE ELSE 1::DOUBLE END AS scale FROM p""",
    "ndvi_features": f"""WITH {PIXELS}, k AS (SELECT aoi_id, cell, scene % 2 AS e, CASE WHEN {_OK} THEN nir END AS nir, CASE WHEN {_OK} THEN red END AS red FROM pixels),
  m AS (SELECT aoi_id, cell, median(nir) FILTER (e = 0) AS n0, median(red) FILTER (e = 0) AS r0, median(nir) FILTER (e = 1) AS n1, median(red) FILTER (e = 1) AS r1 FROM k GROUP BY ALL),
  d AS (SELECT *, {_NDVI.format(a='n0', b='r0')} AS a, {_NDVI.format(a='n1', b='r1')} AS b FROM m)
  SELECT aoi_id, cell, round(a, 9) AS ndvi0, round(b, 9) AS ndvi1, round(b - a, 9) AS change,
    coalesce(a BETWEEN -1.0001 AND 1.0001 AND b BETWEEN -1.0001 AND 1.0001 AND b - a BETWEEN -2.0002 AND 2.0002, false) AND n0 IS NOT NULL AND r0 IS NOT NULL AND n1 IS NOT NULL AND r1 IS NOT NULL AS valid FROM d""",
    "label_algebra": f"WITH {_LABEL} SELECT aoi_id, label, count(*)::BIGINT AS n FROM lpx GROUP BY ALL",
    "patch_label_counts": f"""WITH {_LABEL}, c AS (SELECT aoi_id, cell // 16 AS patch, count(*) FILTER (label = 1)::BIGINT AS positive, count(*) FILTER (label = 0)::BIGINT AS negative FROM lpx GROUP BY ALL)
  SELECT *, round(CASE WHEN positive + negative > 0 THEN positive::DOUBLE / (positive + negative) END, 9) AS loss_fraction, CASE WHEN positive + negative > 0 THEN (positive > 0)::INTEGER END AS loss_binary FROM c""",
    "annual_loss": f"WITH {_LABEL} SELECT aoi_id, loss + 2000 AS year, count(*)::BIGINT AS pixels FROM lpx WHERE label <> 255 AND loss > 0 GROUP BY ALL",
    "valid_coverage": f"WITH {_LABEL}, c AS (SELECT aoi_id, count(*) FILTER (label = 1)::BIGINT AS valid_pixels, count(*) FILTER (label <> 255)::BIGINT AS eligible_pixels FROM lpx GROUP BY ALL) SELECT *, CASE WHEN eligible_pixels > 0 THEN round(100::DOUBLE * valid_pixels / eligible_pixels, 9) END AS coverage_pct FROM c",
    "mosaic_first": f"""WITH {PIXELS}, k AS (SELECT aoi_id, cell % 40 AS x, cell // 40 AS y, scl AS value, scene FROM pixels WHERE {_OK}), f AS (SELECT *, row_number() OVER (PARTITION BY aoi_id, x, y ORDER BY scene, value) AS rn FROM k)
  SELECT aoi_id, x, y, value FROM f WHERE x >= 5 AND x < 30 AND y > -1 AND y <= 40 AND rn = 1""",
    "sliding_windows": """WITH g AS (SELECT n_name AS aoi_id, n_nationkey * 5 + 20 AS h, n_nationkey * 3 + 32 AS w FROM nation),
  r AS (SELECT aoi_id, w, unnest(range(0, h - 31, 8))::INTEGER AS row_off FROM g), c AS (SELECT aoi_id, row_off, unnest(range(0, w - 31, 8))::INTEGER AS col_off FROM r)
  SELECT *, format('{}_r{:06d}_c{:06d}', aoi_id, row_off, col_off) AS patch_id FROM c""",
    "window_valid_fraction": """WITH c AS (SELECT l_returnflag AS aoi_id, l_partkey % 64 AS r, l_orderkey % 64 AS k, max(l_quantity) >= 25 AS valid FROM lineitem GROUP BY ALL),
  w AS (SELECT a.aoi_id, r.o AS row_off, k.o AS col_off FROM (SELECT DISTINCT aoi_id FROM c) a, range(0, 33, 12) r(o), range(0, 33, 12) k(o)),
  s AS (SELECT w.aoi_id, row_off::INTEGER AS row_off, col_off::INTEGER AS col_off, count(*)::BIGINT AS valid_pixels FROM w JOIN c ON c.aoi_id = w.aoi_id AND valid AND r >= row_off AND r < row_off + 32 AND k >= col_off AND k < col_off + 32 GROUP BY ALL)
  SELECT *, valid_pixels / 1024::DOUBLE AS valid_fraction FROM s WHERE valid_pixels / 1024::DOUBLE >= 0.3""",
    "scene_rank": f"WITH {_SCENES} SELECT aoi_id, scene, valid_pixels, round(valid_pct, 6) AS valid_pct, round(invalid_pct, 6) AS invalid_pct, score, rank FROM r",
    "greedy_scene_select": f"""WITH RECURSIVE {_SCENES}, lists AS (SELECT aoi_id, scene, list(pixel) AS p FROM px GROUP BY ALL),
  sel AS (
    SELECT aoi_id, NULL::BIGINT AS scene, 0 AS selection_order, 0::BIGINT AS gain, []::BIGINT[] AS covered, total FROM tot
    UNION ALL
    SELECT aoi_id, scene, selection_order, gain, covered, total FROM (
      SELECT s.aoi_id, l.scene, s.selection_order + 1 AS selection_order, len(list_filter(l.p, lambda x: NOT list_contains(s.covered, x)))::BIGINT AS gain,
        list_distinct(list_concat(s.covered, l.p)) AS covered, s.total,
        row_number() OVER (PARTITION BY s.aoi_id ORDER BY len(list_filter(l.p, lambda x: NOT list_contains(s.covered, x))) DESC, r.score DESC, r.rank) AS rn
      FROM sel s JOIN lists l ON l.aoi_id = s.aoi_id JOIN r ON r.aoi_id = l.aoi_id AND r.scene = l.scene
      WHERE s.selection_order < 5 AND NOT (s.selection_order >= 1 AND 100::DOUBLE * len(s.covered) / s.total >= 99.5)) t WHERE rn = 1 AND gain > 0)
  SELECT aoi_id, scene, selection_order, gain AS gain_pixels, len(covered)::BIGINT AS covered_pixels, round(100::DOUBLE * len(covered) / total, 6) AS coverage_pct FROM sel WHERE selection_order > 0""",
    "selected_item_lists": f"WITH {_SCENES} SELECT aoi_id, string_agg(scene::VARCHAR, ';' ORDER BY rank) AS item_ids FROM r WHERE rank <= 3 GROUP BY aoi_id",
    "selection_status": f"WITH {_SCENES}, b AS (SELECT aoi_id, max(valid_pct) AS best FROM r GROUP BY aoi_id) SELECT count(*)::BIGINT AS groups, bool_and(best > 10) AS all_passed, CASE WHEN bool_and(best > 10) AND count(*) = 5 THEN 'passed' ELSE 'failed' END AS status FROM b",
}
