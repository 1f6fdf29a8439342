"""Join, key audit, selection, geodesy and lineage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import hash_seed, normalized_name, signed_url, unit_interval
from ..operators import geo, relational as rel
from ..operators.scenes import ITEM, flatten_items
from .adapters import BOXES, SCORES, boxes, scores, table
from .metric_queries import THRESHOLD

EPSG = 32719
ASSETS = ("B02", "B03", "B04", "B08", "SCL")


def exactly_once_lookup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.lit("selection").alias("c_mktsegment"))
    return rel.exactly_once(orders, table(spark, sf_dir, "customer"), ["c_custkey"])


def many_to_one_lookup(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    return rel.lookup(s, table(spark, sf_dir, "nation"), ["n_nationkey"])


def missing_unexpected_keys(spark, sf_dir):
    expected = table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"))
    return rel.key_audit(expected, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), ["k"])


def semi_selected(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return rel.selected(table(spark, sf_dir, "customer"), ids, "c_custkey")


def manifest_set_equality(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return rel.same_set(o.select(F.col("o_custkey").alias("k")).distinct(), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")))


def split_overlap(spark, sf_dir):
    s = scores(spark, sf_dir)
    block = [F.floor(F.col("row_off") / 512).alias("block_row"), F.floor(F.col("col_off") / 512).alias("block_col")]
    return rel.overlap(s.where("role = 'geographic_holdout'").select(*block), s.where("role = 'final_geographic_holdout'").select(*block), ["block_row", "block_col"])


def duplicate_keys(spark, sf_dir):
    return rel.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def expected_combinations(spark, sf_dir):
    years = spark.range(1).select(F.explode(F.array(F.lit(2018), F.lit(2022))).alias("year"))
    return rel.combinations(table(spark, sf_dir, "nation").select(F.col("n_name").alias("aoi_id")), years)


def year_pairs(spark, sf_dir):
    """Baseline and comparison half-year of each area side by side, exactly one of each."""
    half = F.when(F.month("o_orderdate") <= 6, 2018).otherwise(2022)
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("aoi_id"), half.alias("year")).agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("top"))
    return rel.paired_years(n, "aoi_id", "year", 2018, 2022, ["n", "top"])


def accept_reject(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rules = [("missing value", F.col("value").isNotNull()), ("value out of range", F.col("value") <= 100), ("unknown user", F.col("user_id") >= 10)]
    return rel.accept_reject(e, rules).groupBy("quality_flag", "rejection_reason").agg(F.count(F.lit(1)).alias("n"))


def representative_sample(spark, sf_dir):
    s = scores(spark, sf_dir).withColumn("prediction", (F.col("probability") >= THRESHOLD).cast("int"))
    picked = rel.representative(s, "prediction", ["probability", "patch_key"], 51)
    return picked.select("patch_key", "prediction", "probability")


def bbox_overlap_pairs(spark, sf_dir):
    return rel.overlapping_boxes(boxes(spark, sf_dir))


def bounds_validity(spark, sf_dir):
    b = boxes(spark, sf_dir).withColumn("max_lat", F.when(F.col("box_id") % 7 == 0, F.col("min_lat")).otherwise(F.col("max_lat")))
    return b.select("box_id", rel.bounds_valid().alias("valid"))


def jsonl_shards(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").where("length(trim(text)) > 0")
    return rel.shards(c, "role", ["conv_id", "turn"], 50).groupBy("role", "shard", "shard_name").agg(F.count(F.lit(1)).alias("records"))


def dashboard_filter(spark, sf_dir):
    """Alerts of chosen areas over a probability, with their risk colour, by falling probability."""
    s = rel.dashboard(scores(spark, sf_dir).withColumn("prediction", (F.col("probability") >= 0.6).cast("int")), ("1-URGENT", "2-HIGH"), 0.4, alerts_only=True)
    return s.select("patch_key", "aoi_id", "probability", F.array_join("fill_color", ",").alias("fill_color"))


def dashboard_totals(spark, sf_dir):
    s = scores(spark, sf_dir)
    return s.agg(F.count(F.lit(1)).alias("rows"), F.sum((F.col("probability") >= THRESHOLD).cast("int")).alias("alerts"), F.count_if(F.col("probability") >= 0.6).alias("filtered"))


def discovery_summary(spark, sf_dir):
    """Items per area and year: counts, complete ones, and whether all are."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    out = e.groupBy("event_type", F.year("ts").alias("year")).agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("k") >= 5).alias("complete"), F.every(F.col("k") >= 5).alias("all_complete"))
    return out.withColumn("status", F.when(F.col("all_complete"), "complete").otherwise("incomplete"))


def item_flatten(spark, sf_dir):
    """Catalogue items, some without a link, assets, fields or a box, as flat rows of 24 fields."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    i = F.col("event_id")
    asset = F.struct(F.concat(F.lit("s3://a/"), i).alias("href"))
    assets = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, ASSETS)), F.array(*([asset] * 5))), lambda name, _: (i % 7 != 0) | ~name.isin("B08", "SCL"))
    links = F.array(F.struct(F.lit("root").alias("rel"), F.lit("/").alias("href")), *(F.struct(F.when(i % 5 != 0, "self").otherwise("parent").alias("rel"), F.concat(F.lit(f"/{n}/"), i).alias("href")) for n in (1, 2)))
    props = F.struct(F.date_format("ts", "yyyy-MM-dd").alias("datetime"), F.when(i % 11 != 0, F.col("k").cast("double")).alias("eo:cloud_cover"), F.col("event_type").alias("platform"), F.when(i % 3 != 0, "02.12").alias("s2:processing_baseline"), F.when(i % 4 != 0, 32719).alias("proj:epsg"))
    item = F.struct(
        F.concat(F.lit("item-"), i).alias("id"), F.when(i % 6 != 0, F.lit("l2a")).alias("collection"), F.when(i % 9 != 0, F.array((i % 90).cast("double"), F.lit(0.5))).alias("bbox"),
        props.alias("properties"), F.when(i % 13 != 0, links).alias("links"), F.when(i % 17 != 0, assets).alias("assets"),
    )
    areas = e.select(F.col("event_type").alias("aoi_id"), F.lit("inference_only").alias("aoi_role"), F.year("ts").alias("target_year"), F.lit("2018-06-01").alias("window_start"), F.lit("2018-09-30").alias("window_end"), F.lit("2024-01-01T00:00:00Z").alias("query_timestamp_utc"), item.cast(ITEM).alias("item"))
    return flatten_items(areas, ASSETS, "asked")


def cloud_limit(spark, sf_dir):
    from ..operators.scenes import within_cloud_limit

    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 11 != 0, F.get_json_object("props", "$.k").cast("double")).alias("cloud_cover_pct"))
    return within_cloud_limit(e, 20.0)


def text_sha256_lineage(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("bigint").alias("bytes"))


def hashed_unit_interval(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    key = F.concat_ws("|", F.lit(42), "c_name")
    return c.select("c_custkey", unit_interval(key).alias("u"), hash_seed(key).cast("string").alias("seed"))


def utm_project(spark, sf_dir):
    x, y = geo.to_utm(F.col("min_lon"), F.col("min_lat"), EPSG)
    return boxes(spark, sf_dir).select("box_id", F.round(x, 4).alias("easting"), F.round(y, 4).alias("northing"))


def utm_round_trip(spark, sf_dir):
    x, y = geo.to_utm(F.col("min_lon"), F.col("min_lat"), EPSG)
    back = geo.with_lonlat(boxes(spark, sf_dir).withColumns({"e": x, "n": y}), "e", "n", EPSG, "lon", "lat")
    return back.select("box_id", F.round("lon", 8).alias("lon"), F.round("lat", 8).alias("lat"))


def url_signing(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", signed_url(F.split("url", "#")[0], "sig=1").alias("href"))


def name_normalization(spark, sf_dir):
    n = table(spark, sf_dir, "part")
    return n.select("p_partkey", normalized_name(F.col("p_type")).alias("name"))


def asset_lineage(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("b02"), F.col("c_mktsegment").alias("b03"))
    return rel.unpivot_assets(c, ["c_custkey"], ["b02", "b03"])


def forbidden_predictors(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_type").alias("feature")).distinct()
    return rel.forbidden_columns(p, ["probability"], ["large", "label"])


QUERIES = {
    f.__name__: f
    for f in (
        exactly_once_lookup, many_to_one_lookup, missing_unexpected_keys, semi_selected, manifest_set_equality, split_overlap, duplicate_keys, expected_combinations,
        year_pairs, accept_reject, representative_sample, bbox_overlap_pairs, bounds_validity, jsonl_shards, dashboard_filter, dashboard_totals, discovery_summary,
        item_flatten, cloud_limit, text_sha256_lineage, hashed_unit_interval, utm_project, utm_round_trip, url_signing, name_normalization, asset_lineage, forbidden_predictors,
    )
}


def _utm_sql() -> str:
    m, _ = geo.zone_meridian(EPSG)
    xs = " + ".join(["eta"] + [f"{a!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1)])
    ys = " + ".join(["xi"] + [f"{a!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1)])
    return f"""WITH {BOXES}, a AS (SELECT box_id, radians(min_lon - ({m})) AS lam, tan(radians(min_lat)) AS t FROM boxes),
  b AS (SELECT *, sinh({geo._E!r}::DOUBLE * atanh({geo._E!r}::DOUBLE * t / sqrt(1 + t * t))) AS s FROM a),
  c AS (SELECT *, t * sqrt(1 + s * s) - s * sqrt(1 + t * t) AS p FROM b),
  d AS (SELECT box_id, atan2(p, cos(lam)) AS xi, asinh(sin(lam) / sqrt(p * p + cos(lam) * cos(lam))) AS eta FROM c)
  SELECT box_id, round(500000 + {geo.K0 * geo.RECTIFYING!r}::DOUBLE * ({xs}), 4) AS easting, round(10000000 + {geo.K0 * geo.RECTIFYING!r}::DOUBLE * ({ys}), 4) AS northing FROM d"""


SQL = {
    "exactly_once_lookup": "SELECT o_orderkey, c_custkey, 'selection' AS c_mktsegment, c_name, c_nationkey, c_acctbal FROM orders JOIN customer ON o_custkey = c_custkey",
    "many_to_one_lookup": "SELECT s_suppkey, s_nationkey AS n_nationkey, n_name, n_regionkey FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey",
    "missing_unexpected_keys": "WITH e AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 <> 0), a AS (SELECT DISTINCT o_custkey AS k FROM orders) SELECT k, 'missing' AS problem FROM (SELECT k FROM e EXCEPT SELECT k FROM a) UNION ALL SELECT k, 'unexpected' FROM (SELECT k FROM a EXCEPT SELECT k FROM e)",
    "semi_selected": "SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
    "manifest_set_equality": "WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT c_custkey AS k FROM customer), x AS (SELECT count(*)::BIGINT AS n FROM (SELECT k FROM a EXCEPT ALL SELECT k FROM b)), y AS (SELECT count(*)::BIGINT AS n FROM (SELECT k FROM b EXCEPT ALL SELECT k FROM a)) SELECT x.n AS only_left, y.n AS only_right, x.n = 0 AND y.n = 0 AS equal FROM x, y",
    "split_overlap": f"WITH {SCORES} SELECT row_off // 512 AS block_row, col_off // 512 AS block_col FROM scores WHERE role = 'geographic_holdout' INTERSECT SELECT row_off // 512, col_off // 512 FROM scores WHERE role = 'final_geographic_holdout'",
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "expected_combinations": "SELECT n_name AS aoi_id, year FROM nation, (VALUES (2018), (2022)) y(year)",
    "year_pairs": "WITH n AS (SELECT o_orderpriority AS aoi_id, month(o_orderdate) <= 6 AS early, count(*)::BIGINT AS n, max(o_orderkey) AS top FROM orders GROUP BY ALL) SELECT a.aoi_id, a.n AS n_2018, b.n AS n_2022, a.top AS top_2018, b.top AS top_2022 FROM n a JOIN n b ON a.aoi_id = b.aoi_id AND a.early AND NOT b.early",
    "accept_reject": "WITH r AS (SELECT CASE WHEN value IS NULL THEN 'missing value' WHEN value > 100 THEN 'value out of range' WHEN coalesce(user_id, 0) < 10 THEN 'unknown user' END AS rejection_reason FROM events) SELECT CASE WHEN rejection_reason IS NULL THEN 'accepted' ELSE 'rejected' END AS quality_flag, rejection_reason, count(*)::BIGINT AS n FROM r GROUP BY ALL",
    "representative_sample": f"""WITH {SCORES}, p AS (SELECT *, (probability >= {THRESHOLD}::DOUBLE)::INTEGER AS prediction FROM scores),
  q AS (SELECT *, row_number() OVER (PARTITION BY prediction ORDER BY probability, patch_key) - 1 AS pos, count(*) OVER (PARTITION BY prediction) AS n,
    25 + (dense_rank() OVER (ORDER BY prediction) = 1)::INT AS quota FROM p), c AS (SELECT *, least(n, quota) AS k FROM q)
  SELECT patch_key, prediction, probability FROM c WHERE list_contains(list_transform(range(k), lambda i: round_even(i * (n - 1) / greatest(k - 1, 1)::DOUBLE, 0)::BIGINT), pos)""",
    "bbox_overlap_pairs": f"WITH {BOXES} SELECT a.box_id AS left_id, b.box_id AS right_id FROM boxes a JOIN boxes b ON a.box_id < b.box_id AND a.min_lon < b.max_lon AND b.min_lon < a.max_lon AND a.min_lat < b.max_lat AND b.min_lat < a.max_lat",
    "bounds_validity": f"WITH {BOXES}, c AS (SELECT * REPLACE (CASE WHEN box_id % 7 = 0 THEN min_lat ELSE max_lat END AS max_lat) FROM boxes) SELECT box_id, abs(min_lon) <= 180 AND abs(max_lon) <= 180 AND abs(min_lat) <= 90 AND abs(max_lat) <= 90 AND min_lon < max_lon AND min_lat < max_lat AS valid FROM c",
    "jsonl_shards": "WITH n AS (SELECT role, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS rn FROM conversations WHERE length(trim(text)) > 0) SELECT role, ceil(rn / 50.0)::INTEGER AS shard, printf('part-%05d', ceil(rn / 50.0)::INTEGER) AS shard_name, count(*)::BIGINT AS records FROM n GROUP BY ALL",
    "dashboard_filter": f"WITH {SCORES} SELECT patch_key, aoi_id, probability, CASE WHEN probability >= 0.75::DOUBLE THEN '214,39,40,185' WHEN probability >= 0.5::DOUBLE THEN '255,127,14,170' ELSE '44,160,44,130' END AS fill_color FROM scores WHERE aoi_id IN ('1-URGENT', '2-HIGH') AND probability >= 0.6::DOUBLE",
    "dashboard_totals": f"WITH {SCORES} SELECT count(*)::BIGINT AS rows, count(*) FILTER (probability >= {THRESHOLD}::DOUBLE)::BIGINT AS alerts, count(*) FILTER (probability >= 0.6::DOUBLE)::BIGINT AS filtered FROM scores",
    "discovery_summary": "WITH e AS (SELECT event_type, year(ts)::INTEGER AS year, (props::JSON->>'k')::BIGINT AS k FROM events) SELECT event_type, year, count(*)::BIGINT AS items, count(*) FILTER (k >= 5)::BIGINT AS complete, bool_and(k >= 5) AS all_complete, CASE WHEN bool_and(k >= 5) THEN 'complete' ELSE 'incomplete' END AS status FROM e GROUP BY ALL",
    "item_flatten": """WITH e AS (SELECT *, event_id AS i, (props::JSON->>'k')::INTEGER AS k, CASE WHEN event_id % 17 = 0 THEN [] WHEN event_id % 7 = 0 THEN ['B02', 'B03', 'B04'] ELSE ['B02', 'B03', 'B04', 'B08', 'SCL'] END AS has FROM events),
  m AS (SELECT *, list_filter(['B02', 'B03', 'B04', 'B08', 'SCL'], lambda a: NOT list_contains(has, a)) AS missing FROM e)
  SELECT event_type AS aoi_id, 'inference_only' AS aoi_role, year(ts)::INTEGER AS target_year, '2018-06-01' AS window_start, '2018-09-30' AS window_end, '2024-01-01T00:00:00Z' AS query_timestamp_utc,
    'item-' || i AS item_id, strftime(ts, '%Y-%m-%d') AS acquisition_datetime, CASE WHEN i % 11 <> 0 THEN k::DOUBLE END AS cloud_cover_pct, event_type AS platform, CASE WHEN i % 3 <> 0 THEN '02.12' ELSE '' END AS processing_baseline,
    CASE WHEN i % 6 <> 0 THEN 'l2a' ELSE 'asked' END AS collection, CASE WHEN i % 13 <> 0 AND i % 5 <> 0 THEN '/1/' || i ELSE '' END AS source_uri, CASE WHEN i % 4 <> 0 THEN 32719 END AS proj_epsg,
    CASE WHEN i % 9 <> 0 THEN '[' || (i % 90) || '.0,0.5]' ELSE '[]' END AS bbox, len(missing) = 0 AS required_assets_present, array_to_string(missing, ';') AS missing_assets,
    """
    + ", ".join(f"CASE WHEN list_contains(has, '{a}') THEN 's3://a/' || i ELSE '' END AS \"{a}_href\"" for a in ASSETS)
    + ", '' AS local_path, CASE WHEN len(missing) = 0 THEN 'discovered' ELSE 'missing_required_assets' END AS status FROM m",
    "cloud_limit": "WITH e AS (SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN (props::JSON->>'k')::DOUBLE END AS cloud_cover_pct FROM events) SELECT * FROM e WHERE cloud_cover_pct <= 20",
    "text_sha256_lineage": "SELECT doc_id, sha256(text) AS sha256, strlen(text)::BIGINT AS bytes FROM documents",
    "hashed_unit_interval": "SELECT c_custkey, ('0x' || substr(sha256('42|' || c_name), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616 AS u, ('0x' || substr(sha256('42|' || c_name), 1, 16))::UBIGINT::VARCHAR AS seed FROM customer",
    "utm_project": _utm_sql(),
    "utm_round_trip": f"WITH {BOXES} SELECT box_id, round(min_lon, 8) AS lon, round(min_lat, 8) AS lat FROM boxes",
    "url_signing": "SELECT page_id, u || CASE WHEN contains(u, '?') THEN '&' ELSE '?' END || 'sig=1' AS href FROM (SELECT page_id, string_split(url, '#')[1] AS u FROM pages)",
    "name_normalization": "SELECT p_partkey, regexp_replace(lower(trim(p_type)), '[- ]', '_', 'g') AS name FROM part",
    "asset_lineage": "SELECT c_custkey, 'b02' AS asset, c_name AS href FROM customer UNION ALL SELECT c_custkey, 'b03', c_mktsegment FROM customer",
    "forbidden_predictors": "SELECT DISTINCT p_type AS feature FROM part WHERE contains(lower(p_type), 'large') OR contains(lower(p_type), 'label') OR lower(p_type) = 'probability'",
}
