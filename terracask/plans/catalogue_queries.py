"""Grids, resampling, footprints, pixel validity and small catalogue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import geo, patches, raster, relational as rel, splits
from .adapters import BOXES, PIXELS, SCORES, boxes, pixels, scores, table
from .split_queries import _BLOCKS, _dataset

EPSG = 32719
#: Metres of a cell: boxes of some degrees have a few hundred.
CELL = 20_000.0


def target_grids(spark, sf_dir):
    """The projected grid of each box, snapped outward."""
    return geo.grid_of_bounds(boxes(spark, sf_dir), EPSG, CELL, key="box_id")


def polygon_cells(spark, sf_dir):
    """Cells of each grid whose centres lie in the projected box, counted by row."""
    cells = geo.cells_inside(target_grids(spark, sf_dir), boxes(spark, sf_dir), EPSG, key="box_id")
    return cells.groupBy("box_id", "row").agg(F.count(F.lit(1)).alias("cells"), F.min("col").alias("first"), F.max("col").alias("last"))


def patch_polygons(spark, sf_dir):
    """The corners of patches in degrees, to 7 places here."""
    grids = target_grids(spark, sf_dir).withColumns({"row_off": F.lit(1), "col_off": F.lit(2)})
    rings = geo.patch_polygons(grids, EPSG, size=4).select("box_id", F.posexplode("polygon").alias("corner", "p"))
    return rings.select("box_id", "corner", F.round(F.col("p")[0], 7).alias("lon"), F.round(F.col("p")[1], 7).alias("lat"))


def _source_cells(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    return l.groupBy(F.col("l_returnflag").alias("aoi_id"), (F.col("l_orderkey") % 40).alias("row"), (F.col("l_suppkey") % 30).alias("col")).agg(F.max("l_quantity").alias("band"))


def _targets(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    flag = F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("c_custkey") % 3 + 1).cast("int"))
    x, y = (F.col("c_custkey") * 37 % 1000) / F.lit(1000.0) * 34 - 2, (F.col("c_custkey") * 91 % 1000) / F.lit(1000.0) * 44 - 2
    return c.select(flag.alias("aoi_id"), F.col("c_custkey").alias("cell"), x.alias("x"), y.alias("y"))


def resample_nearest(spark, sf_dir):
    """Target cells with the source cell that their centre falls into."""
    out = raster.sample_nearest(_targets(spark, sf_dir), _source_cells(spark, sf_dir), F.col("x"), F.col("y"), ["aoi_id"], ["band"])
    return out.select("aoi_id", "cell", "band")


def resample_bilinear(spark, sf_dir):
    out = raster.sample_bilinear(_targets(spark, sf_dir), _source_cells(spark, sf_dir), F.col("x"), F.col("y"), ["aoi_id"], ["cell"], ["band"])
    return out.withColumn("band", F.round("band", 9))


def _stack(spark, sf_dir):
    """Pixels with two bands, a mask, a label and NDVI of two epochs."""
    px = pixels(spark, sf_dir).withColumns({"label": F.when(F.col("cell") % 5 == 0, 255).otherwise(F.col("cell") % 2), "mask": (F.col("scene") % 4 != 0).cast("int")})
    nir = F.when(F.col("cell") % 23 == 0, F.lit(-9999.0)).when(F.col("cell") % 29 == 0, F.lit(float("nan"))).otherwise(F.col("nir"))
    return px.withColumns({"nir": nir, "before": raster.ndvi(F.col("nir"), F.col("red")), "after": raster.ndvi(F.col("red"), F.col("nir"))})


def pixel_validity(spark, sf_dir):
    """Pixels valid for training (with a label), for inference, and in all bands."""
    px = _stack(spark, sf_dir)
    bands, masks = [F.col("nir"), F.col("red")], [F.col("mask") == 1]
    cells = {
        "training": raster.pixel_valid(F.col("label"), bands, masks, F.col("before"), F.col("after")),
        "inference": raster.pixel_valid(None, bands, masks, F.col("before"), F.col("after")),
        "all_bands": raster.all_valid(bands, F.col("mask")),
    }
    return px.withColumns(cells).groupBy("aoi_id", "scl").agg(*(F.count_if(c).alias(c) for c in cells))


def footprint_containment(spark, sf_dir):
    """Patches by whether they lie within a raster of 2000 x 2040 cells."""
    inside = patches.footprint_inside(F.lit(2000), F.lit(2040))
    return scores(spark, sf_dir).groupBy("aoi_id", inside.alias("inside")).agg(F.count(F.lit(1)).alias("n"))


def raster_blocks(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("aoi_id"), (F.col("n_nationkey") * 100 + 500).alias("height"), (F.col("n_nationkey") * 70 + 513).alias("width"))
    return patches.raster_blocks(n.select("aoi_id", F.col("height").cast("int"), F.col("width").cast("int")))


def tile_names(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.select("n_nationkey", scalars.tile_name(F.lit("v1"), F.lower("n_name"), F.format_string("%02dS", F.col("n_nationkey"))).alias("name"))


def query_windows(spark, sf_dir):
    """Closed windows of days as text, numbers from text with and without, nested fields with a default."""
    e = table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 3 == 0, "x").otherwise(F.col("event_id").cast("string"))
    window = scalars.window_text(F.col("ts"), F.date_add("ts", 30))
    return e.select("event_id", window.alias("window"), scalars.number(text, coerce=True).alias("number"), scalars.nested(F.col("props"), "$.k", "none").alias("k"), scalars.nested(F.col("props"), "$.absent", "none").alias("absent"))


def classes_per_split(spark, sf_dir):
    return splits.classes_per_split(_dataset(spark, sf_dir))


def role_fallback(spark, sf_dir):
    """Roles from composites, else labels, else the area's name."""
    s = scores(spark, sf_dir)
    own = F.when(F.col("patch_key") % 3 == 0, F.when(F.col("patch_key") % 2 == 0, "held_out_test").otherwise("dataset_development"))
    other = F.when(F.col("patch_key") % 5 == 0, "final_geographic_holdout")
    return s.select("aoi_id", splits.role_or_fallback(own, other, F.col("aoi_id"), ("1-URGENT",)).alias("role")).groupBy("aoi_id", "role").agg(F.count(F.lit(1)).alias("n"))


def seeded_cap(spark, sf_dir):
    """Twenty patches of each area in a seeded order: a sample of fixed size by purpose."""
    return patches.seeded_cap(scores(spark, sf_dir).select("aoi_id", "patch_key"), "aoi_id", "patch_key", 42, 20)


def one_to_one_predictions(spark, sf_dir):
    """Manifest and predictions, once each on both sides."""
    s = scores(spark, sf_dir)
    return rel.one_to_one(s.select("patch_key", "aoi_id"), s.select("patch_key", "probability"), ["patch_key"])


def covering_join(spark, sf_dir):
    """Features and labels of the same areas, enforced."""
    s = scores(spark, sf_dir)
    sides = [s.groupBy("aoi_id").agg(f.alias(n)) for n, f in (("patches", F.count(F.lit(1))), ("positives", F.sum("target")))]
    return rel.covering(*sides, ["aoi_id"])


def accepted_rows(spark, sf_dir):
    """The accepted events with the run's constants."""
    judged = rel.accept_reject(table(spark, sf_dir, "events"), [("value out of range", F.col("value") <= 100), ("unknown user", F.col("user_id") >= 10)])
    return scalars.run_constants(rel.accepted(judged).select("event_id"), "run-1", 0.536)


def dataset_order(spark, sf_dir):
    """The split dataset in its reproducible order."""
    return rel.ordered(_dataset(spark, sf_dir).select("aoi_id", "block_row", "block_col", "patch_key", "split"), [F.asc(c) for c in ("aoi_id", "block_row", "block_col", "patch_key")])


def smoke_records(spark, sf_dir):
    """The first 25 turns that aren't blank: a smoke test's limit."""
    c = table(spark, sf_dir, "conversations").where("length(trim(text)) > 0").select("conv_id", "turn", "role", F.length("text").alias("chars"))
    return rel.head(c, [F.asc("conv_id"), F.asc("turn"), F.asc("role"), F.asc("chars")], 25)


QUERIES = {
    f.__name__: f
    for f in (
        target_grids, polygon_cells, patch_polygons, resample_nearest, resample_bilinear, pixel_validity, footprint_containment, raster_blocks, tile_names, query_windows, classes_per_split,
        role_fallback, seeded_cap, one_to_one_predictions, covering_join, accepted_rows, dataset_order, smoke_records,
    )
}


def _forward(source: str, out: str) -> str:
    """CTEs that add the easting ``e`` and northing ``n`` of ``lon`` and ``lat``."""
    m, _ = geo.zone_meridian(EPSG)
    xs = " + ".join(["eta"] + [f"{a!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1)])
    ys = " + ".join(["xi"] + [f"{a!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1)])
    scale = f"{geo.K0 * geo.RECTIFYING!r}::DOUBLE"
    return f"""{out}1 AS (SELECT *, radians(lon - ({m})) AS lam, tan(radians(lat)) AS t FROM {source}),
{out}2 AS (SELECT *, sinh({geo._E!r}::DOUBLE * atanh({geo._E!r}::DOUBLE * t / sqrt(1 + t * t))) AS s FROM {out}1),
{out}3 AS (SELECT *, t * sqrt(1 + s * s) - s * sqrt(1 + t * t) AS p FROM {out}2),
{out}4 AS (SELECT *, atan2(p, cos(lam)) AS xi, asinh(sin(lam) / sqrt(p * p + cos(lam) * cos(lam))) AS eta FROM {out}3),
{out} AS (SELECT * EXCLUDE (lam, t, s, p, xi, eta), 500000 + {scale} * ({xs}) AS e, 10000000 + {scale} * ({ys}) AS n FROM {out}4)"""


_GRIDS = f"""WITH {BOXES}, steps AS (SELECT i / 22::DOUBLE AS f FROM range(22) r(i)),
edge AS (SELECT box_id, min_lon + (max_lon - min_lon) * f AS lon, min_lat AS lat FROM boxes, steps UNION ALL SELECT box_id, max_lon, min_lat + (max_lat - min_lat) * f FROM boxes, steps
  UNION ALL SELECT box_id, max_lon + (min_lon - max_lon) * f, max_lat FROM boxes, steps UNION ALL SELECT box_id, min_lon, max_lat + (min_lat - max_lat) * f FROM boxes, steps),
{_forward('edge', 'pe')},
ends AS (SELECT box_id, floor(min(e) / {CELL}) * {CELL} AS "left", ceil(max(n) / {CELL}) * {CELL} AS top, ceil(max(e) / {CELL}) * {CELL} AS "right", floor(min(n) / {CELL}) * {CELL} AS bottom FROM pe GROUP BY box_id),
grids AS (SELECT box_id, "left"::DOUBLE AS "left", top::DOUBLE AS top, {CELL}::DOUBLE AS resolution, (("right" - "left") / {CELL})::INTEGER AS width, ((top - bottom) / {CELL})::INTEGER AS height, {EPSG} AS epsg FROM ends)"""


def _polygons_sql() -> str:
    m, _ = geo.zone_meridian(EPSG)
    scale = f"{geo.K0 * geo.RECTIFYING!r}::DOUBLE"
    xs = "".join(f" - {b!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, b in enumerate(geo.BETA, 1))
    ys = "".join(f" - {b!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, b in enumerate(geo.BETA, 1))
    steps = []
    for k in range(6):  # Newton's steps to the latitude's tangent
        steps.append(f"""u{k} AS (SELECT *, sinh({geo._E!r}::DOUBLE * atanh({geo._E!r}::DOUBLE * tau / sqrt(1 + tau * tau))) AS sg FROM t{k}),
v{k} AS (SELECT *, tau * sqrt(1 + sg * sg) - sg * sqrt(1 + tau * tau) AS cf FROM u{k}),
t{k + 1} AS (SELECT box_id, corner, x, y, target, tau + (target - cf) / sqrt(1 + cf * cf) * (1 + {1 - geo._E**2!r}::DOUBLE * tau * tau) / ({1 - geo._E**2!r}::DOUBLE * sqrt(1 + tau * tau)) AS tau FROM v{k})""")
    return f"""{_GRIDS}, corners AS (SELECT * FROM (VALUES (0, 1, 2), (1, 1, 6), (2, 5, 6), (3, 5, 2), (4, 1, 2)) c(corner, r, c)),
a AS (SELECT box_id, corner, (top - r * resolution - 10000000) / {scale} AS xi, ("left" + c * resolution - 500000) / {scale} AS eta FROM grids, corners),
b AS (SELECT box_id, corner, eta{xs} AS x, xi{ys} AS y FROM a),
t0 AS (SELECT box_id, corner, x, y, sin(y) / sqrt(sinh(x) * sinh(x) + cos(y) * cos(y)) AS target, sin(y) / sqrt(sinh(x) * sinh(x) + cos(y) * cos(y)) AS tau FROM b),
{", ".join(steps)}
SELECT box_id, corner::INTEGER AS corner, round(round({m} + degrees(atan2(sinh(x), cos(y))), 8), 7) AS lon, round(round(degrees(atan(tau)), 8), 7) AS lat FROM t6"""


_CELLS = "s AS (SELECT l_returnflag AS aoi_id, l_orderkey % 40 AS r, l_suppkey % 30 AS c, max(l_quantity) AS band FROM lineitem GROUP BY ALL)"
_TARGETS = "t AS (SELECT ['A', 'N', 'R'][c_custkey % 3 + 1] AS aoi_id, c_custkey AS cell, (c_custkey * 37 % 1000) / 1000::DOUBLE * 34 - 2 AS x, (c_custkey * 91 % 1000) / 1000::DOUBLE * 44 - 2 AS y FROM customer)"
_OK2 = "nir IS NOT NULL AND isfinite(nir) AND red IS NOT NULL AND mask = 1 AND coalesce(b BETWEEN -1.0001 AND 1.0001 AND a BETWEEN -1.0001 AND 1.0001 AND a - b BETWEEN -2.0002 AND 2.0002, false)"
_NDVI2 = "CASE WHEN abs({0} + {1}) > 1e-6::DOUBLE THEN ({0} - {1}) / ({0} + {1} + sign({0} + {1}) * 1e-6::DOUBLE) END"

SQL = {
    "target_grids": f"{_GRIDS} SELECT * FROM grids",
    "polygon_cells": f"""{_GRIDS}, c AS (SELECT box_id, unnest(['a', 'b', 'c', 'd']) AS k, unnest([min_lon, max_lon, max_lon, min_lon]) AS lon, unnest([min_lat, min_lat, max_lat, max_lat]) AS lat FROM boxes), {_forward('c', 'pc')},
  q AS (SELECT box_id, {", ".join(f"max({v}) FILTER (k = '{k}') AS q_{k}{w}" for k in "abcd" for v, w in (("e", "x"), ("n", "y")))} FROM pc GROUP BY box_id),
  r AS (SELECT g.*, q.* EXCLUDE (box_id), unnest(range(height)) AS r FROM grids g JOIN q USING (box_id)), k AS (SELECT *, unnest(range(width)) AS k FROM r),
  p AS (SELECT *, "left" + (k + 0.5::DOUBLE) * resolution AS px, top - (r + 0.5::DOUBLE) * resolution AS py FROM k)
  SELECT box_id, r::INTEGER AS "row", count(*)::BIGINT AS cells, min(k)::INTEGER AS "first", max(k)::INTEGER AS "last" FROM p
  WHERE {" AND ".join(f"(q_{b}x - q_{a}x) * (py - q_{a}y) - (q_{b}y - q_{a}y) * (px - q_{a}x) >= 0" for a, b in ("ab", "bc", "cd", "da"))} GROUP BY box_id, r""",
    "patch_polygons": _polygons_sql(),
    "resample_nearest": f"WITH {_CELLS}, {_TARGETS} SELECT t.aoi_id, cell, band FROM t LEFT JOIN s ON s.aoi_id = t.aoi_id AND r = floor(y) AND c = floor(x)",
    "resample_bilinear": f"""WITH {_CELLS}, {_TARGETS}, w AS (SELECT t.aoi_id, cell, band, (1 - abs(x - 0.5::DOUBLE - c)) * (1 - abs(y - 0.5::DOUBLE - r)) AS w FROM t JOIN s ON s.aoi_id = t.aoi_id AND abs(x - 0.5::DOUBLE - c) < 1 AND abs(y - 0.5::DOUBLE - r) < 1)
  SELECT t.aoi_id, t.cell, round(sum(band * w) / sum(w), 9) AS band FROM t LEFT JOIN w ON w.aoi_id = t.aoi_id AND w.cell = t.cell GROUP BY t.aoi_id, t.cell""",
    "pixel_validity": f"""WITH {PIXELS}, p AS (SELECT *, CASE WHEN cell % 5 = 0 THEN 255 ELSE cell % 2 END AS label, (scene % 4 <> 0)::INT AS mask, {_NDVI2.format('nir', 'red')} AS b, {_NDVI2.format('red', 'nir')} AS a FROM pixels),
  q AS (SELECT * REPLACE (CASE WHEN cell % 23 = 0 THEN -9999 WHEN cell % 29 = 0 THEN 'nan'::DOUBLE ELSE nir END AS nir) FROM p)
  SELECT aoi_id, scl, count(*) FILTER ({_OK2} AND label IN (0, 1))::BIGINT AS training, count(*) FILTER ({_OK2})::BIGINT AS inference, count(*) FILTER (mask > 0 AND isfinite(nir) AND nir <> -9999 AND red <> -9999)::BIGINT AS all_bands FROM q GROUP BY ALL""",
    "footprint_containment": f"WITH {SCORES} SELECT aoi_id, row_off + 32 <= 2000 AND col_off + 32 <= 2040 AS inside, count(*)::BIGINT AS n FROM scores GROUP BY ALL",
    "raster_blocks": """WITH g AS (SELECT n_name AS aoi_id, (n_nationkey * 100 + 500)::INTEGER AS height, (n_nationkey * 70 + 513)::INTEGER AS width FROM nation), r AS (SELECT *, unnest(range(0, height, 512))::INTEGER AS block_row_off FROM g), c AS (SELECT *, unnest(range(0, width, 512))::INTEGER AS block_col_off FROM r)
  SELECT *, least(512, height - block_row_off)::INTEGER AS block_height, least(512, width - block_col_off)::INTEGER AS block_width FROM c""",
    "tile_names": "SELECT n_nationkey, format('Hansen_v1_{}_{:02d}S.tif', lower(n_name), n_nationkey) AS name FROM nation",
    "query_windows": """SELECT event_id, strftime(ts, '%Y-%m-%d') || 'T00:00:00Z/' || strftime(ts::DATE + INTERVAL 30 DAY, '%Y-%m-%d') || 'T23:59:59Z' AS "window", CASE WHEN event_id % 3 <> 0 THEN event_id::DOUBLE END AS number, props::JSON->>'k' AS k, 'none' AS absent FROM events""",
    "classes_per_split": _BLOCKS + "SELECT split, count(DISTINCT target)::BIGINT AS classes, count(DISTINCT target) = 2 AS complete FROM d GROUP BY split",
    "role_fallback": f"""WITH {SCORES}, r AS (SELECT aoi_id, CASE WHEN patch_key % 6 = 0 THEN 'geographic_holdout' WHEN patch_key % 3 = 0 THEN 'dataset_development' WHEN patch_key % 5 = 0 THEN 'final_geographic_holdout' WHEN aoi_id = '1-URGENT' THEN 'geographic_holdout' ELSE 'dataset_development' END AS role FROM scores)
  SELECT aoi_id, role, count(*)::BIGINT AS n FROM r GROUP BY ALL""",
    "seeded_cap": f"WITH {SCORES}, r AS (SELECT aoi_id, patch_key, row_number() OVER (PARTITION BY aoi_id ORDER BY sha256('42:' || aoi_id || ':' || patch_key)) AS n FROM scores) SELECT aoi_id, patch_key FROM r WHERE n <= 20",
    "one_to_one_predictions": f"WITH {SCORES} SELECT patch_key, aoi_id, probability FROM scores",
    "covering_join": f"WITH {SCORES} SELECT aoi_id, count(*)::BIGINT AS patches, sum(target)::BIGINT AS positives FROM scores GROUP BY aoi_id",
    "accepted_rows": "SELECT 'run-1' AS run_id, event_id, 0.536::DOUBLE AS threshold, 'accepted' AS quality_flag FROM events WHERE value <= 100 AND user_id >= 10",
    "dataset_order": _BLOCKS + "SELECT aoi_id, block_row, block_col, patch_key, split FROM d ORDER BY ALL",
    "smoke_records": "SELECT conv_id, turn, role, length(text)::INTEGER AS chars FROM conversations WHERE length(trim(text)) > 0 ORDER BY conv_id, turn, role, chars LIMIT 25",
}
