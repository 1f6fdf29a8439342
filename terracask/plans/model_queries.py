"""Quality check suites and tree ensemble queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import finite as finite_
from ..operators import checks as ch
from ..operators import metrics, raster, relational, splits, trees
from .adapters import BOXES, PIXELS, SCORES, boxes, pixels, scores, table
from .metric_queries import THRESHOLD, _conf
from .split_queries import _BLOCKS, _dataset


def dq_modeling_dataset(spark, sf_dir):
    """The split dataset: columns, ids, splits, holdouts, blocks, labels (anew from their source), classes."""
    d = _dataset(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("patch_key"), (((F.col("o_orderkey") * 31 + F.col("o_custkey") * 17) % 997) / F.lit(997.0)).alias("draw"))
    holdout = F.col("split").isin("test", "final_test")
    rows = ch.run_checks(
        d.join(o, "patch_key"),
        [
            ch.Check("no_nulls", F.col("patch_key").isNotNull() & F.col("aoi_id").isNotNull() & F.col("split").isNotNull()),
            ch.Check("allowed_splits", F.col("split").isin("train", "validation", "test", "final_test")),
            ch.Check("holdout_routing", (F.col("split") == "test") == (F.col("role") == "geographic_holdout")),
            ch.Check("final_routing", (F.col("split") == "final_test") == (F.col("role") == "final_geographic_holdout")),
            ch.Check("development_routing", F.col("split").isin("train", "validation") == (F.col("role") == "dataset_development")),
            ch.Check("inside_block", F.col("inside_block") | holdout),
            ch.Check("label_rule", F.col("target") == (F.col("draw") < F.col("probability")).cast("int")),
        ],
    )
    areas = [d.where(F.col("split") == s).select("aoi_id") for s in ("test", "final_test")]
    return ch.union(
        ch.columns_check(d, "required_columns", ["patch_key", "aoi_id", "role", "split", "target", "block_row", "block_col", "inside_block"]),
        rows,
        ch.unique_check(d, "unique_id", ["patch_key"]),
        ch.isolation_check(d.where(~holdout), "block_isolation", ["aoi_id", "block_row", "block_col"]),
        ch.values_check(d, "all_splits", "split", ["train", "validation", "test", "final_test"]),
        ch.empty_check(areas[0].intersect(areas[1]), "holdouts_disjoint"),
        ch.classes_check(d, "both_classes", ["split"], "target"),
    )


def _stated_metrics(p, by):
    """Metrics as a report states them: from confusion counts and ranks."""
    return metrics.prf(metrics.confusion(p, [by])).join(metrics.roc_auc(p, [by]), by).join(metrics.average_precision(p, [by]), by)


def _computed_metrics(p, by):
    """The same from the rows themselves: shares of rows, and pairs won counted by score."""
    precision, recall = F.avg(F.when(F.col("prediction") == 1, F.col("target"))), F.avg(F.when(F.col("target") == 1, F.col("prediction")))
    plain = p.groupBy(by).agg(precision.alias("precision"), recall.alias("recall"), F.avg(F.when(F.col("target") == 0, F.col("prediction"))).alias("fpr"))
    plain = plain.withColumn("f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    steps = p.groupBy(by, "probability").agg(F.sum("target").alias("pos"), F.sum(1 - F.col("target")).alias("neg"))
    lists = steps.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("probability", "pos", "neg"))).alias("s"))  # a row per score, of which there are few
    won = "aggregate(s, named_struct('w', 0D, 'n', 0D), (a, x) -> named_struct('w', a.w + x.pos * (a.n + x.neg / 2D), 'n', a.n + x.neg), a -> a.w)"
    pairs = "cast(aggregate(s, 0L, (a, x) -> a + x.pos) as double) * aggregate(s, 0L, (a, x) -> a + x.neg)"
    return plain.join(lists.select(by, F.expr(f"{won} / ({pairs})").alias("roc_auc")), by)


def dq_predictions(spark, sf_dir):
    """Predictions of a model: one per row of the manifest, threshold applied, metrics computed anew, gates as stated."""
    s = scores(spark, sf_dir)
    p = metrics.with_prediction(s, THRESHOLD)
    rows = ch.run_checks(
        p,
        [
            ch.Check("probability_range", F.col("probability").between(0, 1)),
            ch.Check("prediction_binary", F.col("prediction").isin(0, 1)),
            ch.Check("threshold_applied", (F.col("prediction") == 1) == (F.col("probability") >= THRESHOLD)),
            ch.Check("aligned_to_stride", F.col("row_off") % 8 == 0),
        ],
    )
    stated = _stated_metrics(p, "role")
    gates = metrics.gates(stated.select("role", "recall", "fpr"), (("recall", ">=", 0.5), ("fpr", "<=", 0.4)))
    wrong = gates.where(F.col("passed") != F.when(F.col("metric") == "recall", F.col("value") >= 0.5).otherwise(F.col("value") <= 0.4))
    manifest = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("patch_key"))
    return ch.union(
        ch.columns_check(p, "schema", ["patch_key", "aoi_id", "role", "target", "probability", "prediction"]),
        rows,
        ch.unique_check(p, "unique_id", ["patch_key"]),
        ch.keys_check(manifest, p, "one_per_manifest_row", ["patch_key"]),
        ch.recompute_check(stated, _computed_metrics(p, "role"), ["role"], ["precision", "recall", "f1", "fpr", "roc_auc"]),
        ch.empty_check(wrong, "gates_as_stated"),
    )


def dq_cv_folds(spark, sf_dir):
    """Folds by area: one validation area each, no leak, holdouts absent, all areas validated, both classes."""
    s = scores(spark, sf_dir).select("patch_key", "aoi_id", "role", "target")
    f = splits.loao_folds(s)
    d = f.where("fold_id LIKE 'fold_%'")
    one = d.where("fold_split = 'validation'").groupBy("fold_id").agg(F.count_distinct("aoi_id").alias("n")).where("n <> 1")
    leak = d.where("fold_split = 'train' AND aoi_id = validation_aoi")
    held = d.where("role <> 'dataset_development'")
    areas = s.where("role = 'dataset_development'").select("aoi_id").distinct()
    return ch.union(
        ch.empty_check(one, "one_validation_aoi"), ch.empty_check(leak, "fold_isolation"), ch.empty_check(held, "holdouts_absent"), ch.unique_check(d, "unique_in_fold", ["fold_id", "patch_key"]),
        ch.unique_check(s, "unique_id", ["patch_key"]), ch.keys_check(areas, d.select(F.col("validation_aoi").alias("aoi_id")).distinct(), "all_areas_validated", ["aoi_id"]),
        ch.values_check(s, "known_roles", "role", ["dataset_development", "geographic_holdout", "final_geographic_holdout"]), ch.classes_check(d, "both_classes", ["fold_id", "fold_split"], "target"),
    )


def _code(vector, scale=1000):
    """A vector as text, exactly: its values in whole thousandths, rounded down."""
    return F.array_join(F.transform(vector, lambda v: F.floor(v.cast("double") * scale)), ",")


def patch_manifest(spark, sf_dir):
    """Patches with counts and hash of their tensors, as the step that cuts them states them."""
    e = table(spark, sf_dir, "embeddings")
    role = F.when(F.col("label") > 7, "geographic_holdout").otherwise("dataset_development")
    positive = F.size(F.filter("embedding", lambda v: v > 0))
    return e.select("vec_id", F.col("label").alias("area"), role.alias("role"), positive.cast("bigint").alias("positive"), (F.size("embedding") - positive).cast("bigint").alias("negative"), F.sha2(_code(F.col("embedding")), 256).alias("sha256"))


def dq_patches(spark, sf_dir):
    """Patches against their manifest: ids, role of the held out area, shape, values, counts and hashes anew."""
    e, m = table(spark, sf_dir, "embeddings"), patch_manifest(spark, sf_dir)
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    px = e.select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    counts = px.groupBy("vec_id").agg(F.count_if(F.col("v") > 0).alias("positive"), F.count_if(F.col("v") <= 0).alias("negative"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.floor(F.col("v").cast("double") * 1000).alias("c")))), lambda x: x["c"]), ","), 256).alias("again"))
    return ch.union(
        ch.run_checks(e, [ch.Check("shape", F.size("embedding") == 64), ch.Check("finite", finite), ch.Check("label_set", F.col("label").between(0, 9))]),
        ch.unique_check(m, "unique_id", ["vec_id"]),
        ch.empty_check(m.where((F.col("area") > 7) & (F.col("role") != "geographic_holdout")), "held_out_role"),
        ch.keys_check(m, e, "one_tensor_per_row", ["vec_id"]),
        ch.recompute_check(m, counts, ["vec_id"], ["positive", "negative"], "counts_recomputed"),
        ch.empty_check(m.join(counts.select("vec_id", "again"), "vec_id").where("sha256 <> again"), "sha256"),
    )


#: The names that a feature stack has to have, in order, and parts of names that would leak the target.
STACK, LEAKS = ("nir", "red", "ndvi_before", "ndvi_after", "ndvi_change"), ("loss", "label", "target", "forest")


def feature_stack(spark, sf_dir):
    """A feature stack in long form: bands, mask and label; nodata wherever the mask is 0."""
    px = pixels(spark, sf_dir)
    before, after = raster.ndvi(F.col("nir"), F.col("red")), raster.ndvi(F.col("red"), F.col("nir"))
    label = F.when(F.col("cell") % 5 == 0, 255).otherwise(F.col("cell") % 2)
    bands = {"nir": F.col("nir"), "red": F.col("red"), "ndvi_before": before, "ndvi_after": after, "ndvi_change": after - before}
    mask = raster.pixel_valid(label, [F.col("nir"), F.col("red")], [F.col("scene") % 4 != 0], before, after).cast("int")
    nodata = F.lit(raster.NODATA)
    return px.select("aoi_id", label.alias("label"), mask.alias("mask"), *(F.when(mask == 1, v).otherwise(nodata).alias(n) for n, v in bands.items()))


def dq_feature_tensors(spark, sf_dir):
    """A feature stack: names, leaks, types, grids, mask, values where valid and not, labels, ranges, coverage, counts."""
    px = feature_stack(spark, sf_dir)
    ok = F.col("mask") == 1
    kinds = dict(px.dtypes)
    finite = [finite_(F.col(b)) for b in STACK]
    every = lambda cells: F.forall(F.array(*cells), lambda c: c)
    rows = ch.run_checks(
        px,
        [
            ch.Check("mask_values", F.col("mask").isin(0, 1)),
            ch.Check("finite_where_valid", ~ok | every(finite)),
            ch.Check("nodata_elsewhere", ok | every([F.abs(F.col(b) - raster.NODATA) <= 1e-6 for b in STACK])),
            ch.Check("label_where_valid", ~ok | F.col("label").isin(0, 1)),
            ch.Check("ndvi_range", ~ok | (F.col("ndvi_before").between(-1.00001, 1.00001) & F.col("ndvi_after").between(-1.00001, 1.00001))),
            ch.Check("change_range", ~ok | F.col("ndvi_change").between(-2.00001, 2.00001)),
        ],
    )
    stated = px.groupBy("aoi_id").agg(F.sum("mask").alias("valid"), F.count_if(F.col("label").isin(0, 1)).alias("eligible"))
    again = px.groupBy("aoi_id", "label").agg(F.count_if(ok).alias("valid"), F.count(F.lit(1)).alias("n")).groupBy("aoi_id").agg(F.sum("valid").alias("valid"), F.sum(F.when(F.col("label") != 255, F.col("n"))).alias("eligible"))
    names = [c for c in px.columns if c not in ("aoi_id", "label", "mask")]
    order = spark.range(1).select(F.lit("names_in_order").alias("name"), F.lit(tuple(names) == STACK).alias("passed"), F.lit("|".join(names)).alias("detail"))
    leaks = relational.forbidden_columns(spark.range(1).select(F.explode(F.array(*map(F.lit, names))).alias("feature")), [], LEAKS)
    types = spark.range(1).select(F.lit("types").alias("name"), F.lit(all(kinds[b] == "double" for b in STACK) and kinds["mask"] == "int").alias("passed"), F.lit("double").alias("detail"))
    grids = raster.aligned(*(table(spark, sf_dir, "nation").select(F.col("n_name").alias("aoi_id"), F.lit(32719).alias("epsg"), (F.col("n_nationkey") * 10.0).alias("left"), F.lit(0.0).alias("top"), F.lit(10.0).alias("resolution"), F.lit(5).alias("width"), F.lit(6).alias("height")) for _ in range(2)))
    return ch.union(
        order, ch.empty_check(leaks, "no_leaks"), types, ch.empty_check(grids.where("NOT same"), "grids_match"), rows,
        ch.recompute_check(stated, again, ["aoi_id"], ["valid", "eligible"], "counts_recomputed"), ch.empty_check(stated.where("100.0 * valid < 10.0 * eligible"), "coverage"),
    )


def dq_protocol(spark, sf_dir):
    """The flags of a selection protocol."""
    flags = spark.range(1).select(
        F.array(F.lit("train"), F.lit("validation")).alias("selection_used_splits"), F.lit(False).alias("test_used_for_selection"), F.lit(1).alias("locked_at"), F.lit(2).alias("test_evaluated_at"), F.lit(1).alias("test_evaluations")
    )
    return ch.protocol_checks(flags)


def dq_inference(spark, sf_dir):
    """A run's outputs: ids of the map features, counts of the report, the areas' summary."""
    p = metrics.with_prediction(scores(spark, sf_dir), THRESHOLD)
    features = p.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct("patch_key", "probability").alias("properties"))).alias("feature"))
    ids = features.select(F.get_json_object("feature", "$.properties.patch_key").cast("bigint").alias("patch_key"))
    summary = metrics.alert_summary(p)
    again = p.groupBy("aoi_id").agg(F.sum(F.lit(1)).alias("patch_count"), F.count_if(F.col("probability") >= THRESHOLD).alias("alert_count"))
    report = p.agg(F.count(F.lit(1)).alias("rows"), F.sum("prediction").alias("alerts"))
    gap = summary.agg(F.sum("patch_count").alias("r"), F.sum("alert_count").alias("a")).crossJoin(F.broadcast(report)).where("r <> rows OR a <> alerts")  # one row each
    return ch.union(ch.keys_check(p, ids, "geojson_ids", ["patch_key"]), ch.recompute_check(summary, again, ["aoi_id"], ["patch_count", "alert_count"], "summary_recomputed"), ch.empty_check(gap, "report_counts"))


def dq_areas(spark, sf_dir):
    """The inventory of areas: bounds, roles, overlaps, counts by role."""
    b = boxes(spark, sf_dir).withColumn("role", F.when(F.col("box_id") % 5 == 0, "geographic_holdout").otherwise("dataset_development"))
    counts = b.groupBy("role").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("role").isin("dataset_development", "geographic_holdout", "final_geographic_holdout", "inference_only")
    return ch.union(
        ch.run_checks(b, [ch.Check("bounds", relational.bounds_valid()), ch.Check("known_role", known)]), ch.unique_check(b, "unique_area", ["aoi_id"]),
        ch.empty_check(relational.overlapping_boxes(b), "no_overlap"), ch.empty_check(counts.where("(role = 'geographic_holdout' AND n <> 5) OR (role = 'dataset_development' AND n <> 20)"), "role_counts"),
    )


def dq_label_audit(spark, sf_dir):
    """Areas with composites of two years and their labels: prevalence and failed checks."""
    o = table(spark, sf_dir, "orders").withColumn("aoi_id", F.col("o_orderpriority"))
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("aoi_id")).unionByName(o.select("aoi_id").distinct())
    half = F.when(F.month("o_orderdate") <= 6, 2018).otherwise(2022)
    composites = o.groupBy("aoi_id", half.alias("target_year")).agg((100.0 * F.count_if(F.col("o_totalprice") > 50_000) / F.count(F.lit(1))).alias("valid_coverage_pct"))
    labels = scores(spark, sf_dir).groupBy("aoi_id").agg(F.count_if(F.col("target") == 1).alias("positive_pixels"), F.count_if(F.col("target") == 0).alias("negative_pixels"), (100.0 * F.count_if(F.col("row_off") < 2000) / F.count(F.lit(1))).alias("eligible_coverage_pct"))
    labels = labels.unionByName(labels.where("aoi_id = '2-HIGH'"))
    out = ch.label_audit(n, composites, labels, (2018, 2022), 80.0, 95.0)
    return out.withColumns({c: F.round(c, 6) for c in ("min_coverage_pct", "eligible_coverage_pct", "positive_pct")})


def dq_status(spark, sf_dir):
    return ch.overall(ch.union(dq_modeling_dataset(spark, sf_dir), dq_predictions(spark, sf_dir)))


FEATURES = [f"f{i}" for i in range(8)]


def _matrix(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    cells = [F.avg(F.when(F.floor(F.col("pos") / 8) == i, F.col("v").cast("double"))).alias(f"f{i}") for i in range(8)]
    return e.select("vec_id", (F.col("label") >= 5).cast("int").alias("y"), F.posexplode("embedding").alias("pos", "v")).groupBy("vec_id", "y").agg(*cells)


def extratrees_score(spark, sf_dir):
    """Every vector scored by 32 extremely randomised trees learnt from the labelled vectors."""
    m = _matrix(spark, sf_dir)
    nodes = trees.fit_trees(m, FEATURES, "y", trees=32)
    return trees.score(m, nodes, FEATURES).select("vec_id", "y", F.round("probability", 9).alias("probability"))


def tree_importances(spark, sf_dir):
    return trees.importances(trees.fit_trees(_matrix(spark, sf_dir), FEATURES, "y", trees=16), FEATURES).orderBy(F.desc("importance"))


def forest_score(spark, sf_dir):
    """Bootstrapped trees of bounded depth."""
    m = _matrix(spark, sf_dir)
    return trees.score(m, trees.fit_trees(m, FEATURES, "y", trees=16, leaf=2, depth=18, bootstrap=True), FEATURES).select("vec_id", "y", F.round("probability", 9).alias("probability"))


def platt_calibrate(spark, sf_dir):
    """Calibrated scores of the vectors: three folds, each calibrated on the rows its trees haven't seen."""
    m = _matrix(spark, sf_dir)
    models = trees.calibrated(m, FEATURES, "y", trees=8)
    return trees.score_calibrated(m, models, FEATURES, "calibrated").select("vec_id", F.round("calibrated", 9).alias("calibrated"))


CANDIDATES = (
    {"id": 1, "trees": 12, "leaf": 4},
    {"id": 2, "trees": 12, "leaf": 2, "depth": 18, "bootstrap": True},
    {"id": 3, "trees": 12, "leaf": 4, "features": FEATURES[:5]},
    {"id": 4, "trees": 6, "leaf": 4, "calibration": "sigmoid"},
)


def _swept(spark, sf_dir):
    m = _matrix(spark, sf_dir).withColumn("part", F.col("vec_id") % 5).withColumn("aoi_id", (F.col("vec_id") % 3).cast("string"))
    return trees.sweep(m.where("part < 3"), m.where("part = 3"), CANDIDATES, FEATURES, "y", "aoi_id", 0.5)[0]


def candidate_sweep(spark, sf_dir):
    """Four candidates, one on a subset of the features, one calibrated, fitted on train and judged on validation."""
    return _swept(spark, sf_dir)


def dq_sweep(spark, sf_dir):
    """One candidate is selected, by the ranking of the validation alone."""
    t = _swept(spark, sf_dir)
    return ch.union(ch.selection_checks(t, "selected", "eligible", ["pr_auc", "worst_pr_auc", "f1"], "candidate_id"), ch.unique_check(t, "unique_candidate", ["candidate_id"]))


QUERIES = {
    f.__name__: f
    for f in (dq_modeling_dataset, dq_predictions, dq_cv_folds, dq_feature_tensors, dq_patches, dq_protocol, dq_inference, dq_areas, dq_label_audit, dq_status, extratrees_score, tree_importances, forest_score, platt_calibrate, candidate_sweep, dq_sweep)
}


def _rows(source: str, checks: list[tuple[str, str]]) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{n}' AS name, count(*) FILTER (NOT coalesce({p}, false)) = 0 AS passed, count(*) FILTER (NOT coalesce({p}, false)) || ' violations' AS detail FROM {source}" for n, p in checks
    )
    return f"{cells} UNION ALL SELECT 'non_empty', count(*) > 0, count(*) || ' rows' FROM {source}"


def _unique(source: str, name: str, keys: str) -> str:
    return f"SELECT '{name}' AS name, count(*) = 0 AS passed, count(*) || ' repeated keys' AS detail FROM (SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)"


def _empty(sub: str, name: str) -> str:
    return f"SELECT '{name}' AS name, count(*) = 0 AS passed, count(*) || ' violations' AS detail FROM ({sub})"


_DATASET = _rows(
    "d",
    [
        ("no_nulls", "patch_key IS NOT NULL AND aoi_id IS NOT NULL AND split IS NOT NULL"),
        ("allowed_splits", "split IN ('train', 'validation', 'test', 'final_test')"),
        ("holdout_routing", "(split = 'test') = (role = 'geographic_holdout')"),
        ("final_routing", "(split = 'final_test') = (role = 'final_geographic_holdout')"),
        ("development_routing", "(split IN ('train', 'validation')) = (role = 'dataset_development')"),
        ("inside_block", "inside_block OR split IN ('test', 'final_test')"),
        ("label_rule", "target = (draw < probability)::INT"),
    ],
)
_DATASET = _DATASET.replace(" FROM d", " FROM dr")
_DATASET += " UNION ALL " + _unique("d", "unique_id", "patch_key")
_DATASET += " UNION ALL " + _empty("SELECT aoi_id, block_row, block_col FROM d WHERE split IN ('train', 'validation') GROUP BY ALL HAVING count(DISTINCT split) > 1", "block_isolation")
_DATASET += " UNION ALL SELECT 'all_splits', list_sort(list(DISTINCT split)) = ['final_test', 'test', 'train', 'validation'], array_to_string(list_sort(list(DISTINCT split)), '|') FROM d"
_DATASET += " UNION ALL SELECT 'required_columns', true, ''"
_DATASET += " UNION ALL " + _empty("SELECT aoi_id FROM d WHERE split = 'test' INTERSECT SELECT aoi_id FROM d WHERE split = 'final_test'", "holdouts_disjoint")
_DATASET += " UNION ALL " + _empty("SELECT split FROM d GROUP BY split HAVING count(DISTINCT target) < 2", "both_classes")
_DR = "dr AS (SELECT d.*, ((o_orderkey * 31 + o_custkey * 17) % 997) / 997::DOUBLE AS draw FROM d JOIN orders ON o_orderkey = patch_key)"
_PREDICTIONS = _rows(
    "p",
    [
        ("probability_range", "probability BETWEEN 0 AND 1"),
        ("prediction_binary", "prediction IN (0, 1)"),
        ("threshold_applied", f"(prediction = 1) = (probability >= {THRESHOLD}::DOUBLE)"),
        ("aligned_to_stride", "row_off % 8 = 0"),
    ],
)
_PREDICTIONS += " UNION ALL SELECT 'schema', true, '' UNION ALL " + _unique("p", "unique_id", "patch_key") + " UNION ALL "
_PREDICTIONS += _empty("SELECT o_orderkey FROM orders FULL JOIN p ON o_orderkey = patch_key WHERE o_orderkey IS NULL OR patch_key IS NULL", "one_per_manifest_row") + " UNION ALL "
_PREDICTIONS += _empty("SELECT * FROM stated FULL JOIN computed USING (role) WHERE NOT coalesce(abs(sp - cp) <= 1e-12 AND abs(sr - cr) <= 1e-12 AND abs(sf - cf) <= 1e-12 AND abs(sx - cx) <= 1e-12 AND abs(sa - ca) <= 1e-12, false)", "metrics_recomputed")
_PREDICTIONS += " UNION ALL " + _empty("SELECT * FROM (SELECT sr AS v, sr >= 0.5 AS passed, 'r' AS k FROM stated UNION ALL SELECT sx, sx <= 0.4, 'x' FROM stated) WHERE passed <> CASE WHEN k = 'r' THEN v >= 0.5 ELSE v <= 0.4 END", "gates_as_stated")
_P = f"""p AS (SELECT *, (probability >= {THRESHOLD}::DOUBLE)::INTEGER AS prediction FROM scores), {_conf('role')}, w AS (SELECT role, target, rank() OVER (PARTITION BY role ORDER BY probability) + (count(*) OVER (PARTITION BY role, probability) - 1) / 2::DOUBLE AS rk FROM p),
u AS (SELECT role, (sum(rk) FILTER (target = 1) - sum(target) * (sum(target) + 1) / 2::DOUBLE) / (sum(target)::DOUBLE * (count(*) - sum(target))) AS auc FROM w GROUP BY role),
stated AS (SELECT role, tp / (tp + fp)::DOUBLE AS sp, tp / (tp + fn)::DOUBLE AS sr, 2 * tp / (2 * tp + fp + fn)::DOUBLE AS sf, fp / (fp + tn)::DOUBLE AS sx, auc AS sa FROM c JOIN u USING (role)),
st AS (SELECT role, probability, sum(target) AS pos, sum(1 - target) AS neg FROM p GROUP BY ALL), sb AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY role ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM st),
ca AS (SELECT role, sum(pos * (below + neg / 2::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)) AS ca FROM sb GROUP BY role),
cc AS (SELECT role, avg(target) FILTER (prediction = 1) AS cp, avg(prediction) FILTER (target = 1) AS cr, avg(prediction) FILTER (target = 0) AS cx FROM p GROUP BY role), computed AS (SELECT *, 2 * cp * cr / (cp + cr) AS cf FROM cc JOIN ca USING (role))"""
_MANIFEST = "m AS (SELECT vec_id, label, CASE WHEN label > 7 THEN 'geographic_holdout' ELSE 'dataset_development' END AS role, len(list_filter(embedding, lambda v: v > 0)) AS positive, len(list_filter(embedding, lambda v: NOT v > 0)) AS negative, sha256(array_to_string(list_transform(embedding, lambda v: floor(v::DOUBLE * 1000)::BIGINT), ',')) AS sha FROM embeddings), x AS (SELECT vec_id, unnest(range(len(embedding))) AS pos, unnest(embedding) AS v FROM embeddings), n AS (SELECT vec_id, count(*) FILTER (v > 0) AS positive, count(*) FILTER (v <= 0) AS negative, sha256(string_agg(floor(v::DOUBLE * 1000)::BIGINT::VARCHAR, ',' ORDER BY pos)) AS sha FROM x GROUP BY vec_id)"
_NDVI = "CASE WHEN abs({0} + {1}) > 1e-6::DOUBLE THEN ({0} - {1}) / ({0} + {1} + sign({0} + {1}) * 1e-6::DOUBLE) END"
_STACK_SQL = f"""v AS (SELECT aoi_id, CASE WHEN cell % 5 = 0 THEN 255 ELSE cell % 2 END AS label, scene, nir, red, {_NDVI.format('nir', 'red')} AS b, {_NDVI.format('red', 'nir')} AS a FROM pixels),
w AS (SELECT *, (label IN (0, 1) AND scene % 4 <> 0 AND nir IS NOT NULL AND red IS NOT NULL AND coalesce(b BETWEEN -1.0001 AND 1.0001 AND a BETWEEN -1.0001 AND 1.0001 AND a - b BETWEEN -2.0002 AND 2.0002, false))::INT AS mask FROM v),
s AS (SELECT aoi_id, label, mask, {", ".join(f"CASE WHEN mask = 1 THEN {v} ELSE -9999 END::DOUBLE AS {n}" for n, v in (("nir", "nir"), ("red", "red"), ("b", "b"), ("a", "a"), ("d", "a - b")))} FROM w),
g AS (SELECT aoi_id, sum(mask) AS valid, count(*) FILTER (label IN (0, 1)) AS eligible FROM s GROUP BY aoi_id), h AS (SELECT aoi_id, count(*) FILTER (mask = 1) AS valid, count(*) FILTER (label <> 255) AS eligible FROM s GROUP BY aoi_id)"""
_FINITE = " AND ".join(f"isfinite({b})" for b in ("nir", "red", "b", "a", "d"))
_GONE = " AND ".join(f"abs({b} + 9999) <= 1e-6" for b in ("nir", "red", "b", "a", "d"))

SQL = {
    "dq_modeling_dataset": f"{_BLOCKS}, {_DR} {_DATASET}",
    "dq_predictions": f"WITH {SCORES}, {_P} {_PREDICTIONS}",
    "dq_cv_folds": f"""WITH {SCORES}, a AS (SELECT DISTINCT aoi_id AS v FROM scores WHERE role = 'dataset_development'), d AS (SELECT v AS fold_id, patch_key, aoi_id, role, v AS validation_aoi, CASE WHEN aoi_id = v THEN 'validation' ELSE 'train' END AS fold_split FROM scores, a WHERE role = 'dataset_development')
  {_empty("SELECT fold_id FROM d WHERE fold_split = 'validation' GROUP BY fold_id HAVING count(DISTINCT aoi_id) <> 1", "one_validation_aoi")} UNION ALL {_empty("SELECT * FROM d WHERE fold_split = 'train' AND aoi_id = validation_aoi", "fold_isolation")}
  UNION ALL {_empty("SELECT * FROM d WHERE role <> 'dataset_development'", "holdouts_absent")} UNION ALL {_unique("d", "unique_in_fold", "fold_id, patch_key")}
  UNION ALL {_unique("scores", "unique_id", "patch_key")} UNION ALL {_empty("SELECT v FROM a WHERE v NOT IN (SELECT validation_aoi FROM d)", "all_areas_validated")}
  UNION ALL SELECT 'known_roles', list_sort(list(DISTINCT role)) = ['dataset_development', 'final_geographic_holdout', 'geographic_holdout'], array_to_string(list_sort(list(DISTINCT role)), '|') FROM scores
  UNION ALL {_empty("SELECT d.fold_id, fold_split FROM d JOIN scores USING (patch_key) GROUP BY ALL HAVING count(DISTINCT target) < 2", "both_classes")}""",
    "dq_feature_tensors": f"WITH {PIXELS}, {_STACK_SQL} "
    + _rows("s", [("mask_values", "mask IN (0, 1)"), ("finite_where_valid", f"mask <> 1 OR ({_FINITE})"), ("nodata_elsewhere", f"mask = 1 OR ({_GONE})"), ("label_where_valid", "mask <> 1 OR label IN (0, 1)"), ("ndvi_range", "mask <> 1 OR (abs(a) <= 1.00001 AND abs(b) <= 1.00001)"), ("change_range", "mask <> 1 OR abs(d) <= 2.00001")])
    + " UNION ALL SELECT 'names_in_order', true, 'nir|red|ndvi_before|ndvi_after|ndvi_change' UNION ALL SELECT 'types', true, 'double' UNION ALL " + _empty("SELECT * FROM (VALUES ('nir'), ('red'), ('ndvi_before'), ('ndvi_after'), ('ndvi_change')) n(f) WHERE contains(f, 'loss') OR contains(f, 'label') OR contains(f, 'target') OR contains(f, 'forest')", "no_leaks")
    + " UNION ALL " + _empty("SELECT * FROM nation x JOIN nation y USING (n_nationkey) WHERE x.n_name <> y.n_name", "grids_match") + " UNION ALL " + _empty("SELECT * FROM g FULL JOIN h USING (aoi_id) WHERE NOT coalesce(g.valid = h.valid AND g.eligible = h.eligible, false)", "counts_recomputed")
    + " UNION ALL " + _empty("SELECT * FROM g WHERE 100.0 * valid < 10.0 * eligible", "coverage"),
    "dq_patches": f"WITH {_MANIFEST} "
    + _rows("embeddings", [("shape", "len(embedding) = 64"), ("finite", "len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0"), ("label_set", "label BETWEEN 0 AND 9")])
    + " UNION ALL " + _unique("m", "unique_id", "vec_id") + " UNION ALL " + _empty("SELECT * FROM m WHERE label > 7 AND role <> 'geographic_holdout'", "held_out_role") + " UNION ALL " + _empty("SELECT * FROM m FULL JOIN embeddings e USING (vec_id) WHERE m.role IS NULL OR e.label IS NULL", "one_tensor_per_row")
    + " UNION ALL " + _empty("SELECT * FROM m FULL JOIN n USING (vec_id) WHERE NOT coalesce(m.positive = n.positive AND m.negative = n.negative, false)", "counts_recomputed") + " UNION ALL " + _empty("SELECT * FROM m JOIN n USING (vec_id) WHERE m.sha <> n.sha", "sha256"),
    "dq_protocol": "WITH f AS (SELECT ['train', 'validation'] AS u, false AS t, 1 AS l, 2 AS e, 1 AS n) " + _rows("f", [("selection_splits", "list_sort(u) = ['train', 'validation']"), ("test_not_used_for_selection", "NOT t"), ("locked_before_test", "l < e"), ("test_evaluated_once", "n = 1")]),
    "dq_inference": f"WITH {SCORES}, {_P}, y AS (SELECT aoi_id, count(*) AS n, sum(prediction) AS k FROM p GROUP BY aoi_id), z AS (SELECT aoi_id, count(*) AS n, count(*) FILTER (probability >= {THRESHOLD}::DOUBLE) AS k FROM scores GROUP BY aoi_id), ids AS (SELECT (to_json({{'patch_key': patch_key}})->>'patch_key')::BIGINT AS patch_key FROM p) "
    + _empty("SELECT * FROM ids FULL JOIN p USING (patch_key) WHERE probability IS NULL OR patch_key IS NULL", "geojson_ids") + " UNION ALL " + _empty("SELECT * FROM y FULL JOIN z USING (aoi_id) WHERE NOT coalesce(y.n = z.n AND y.k = z.k, false)", "summary_recomputed")
    + " UNION ALL " + _empty("SELECT * FROM (SELECT sum(n) AS n, sum(k) AS k FROM y) s, (SELECT count(*) AS m, sum(prediction) AS l FROM p) t WHERE n <> m OR k <> l", "report_counts"),
    "dq_areas": f"WITH {BOXES}, b AS (SELECT *, CASE WHEN box_id % 5 = 0 THEN 'geographic_holdout' ELSE 'dataset_development' END AS role FROM boxes) "
    + _rows("b", [("bounds", "abs(min_lon) <= 180 AND abs(max_lon) <= 180 AND abs(min_lat) <= 90 AND abs(max_lat) <= 90 AND min_lon < max_lon AND min_lat < max_lat"), ("known_role", "role IN ('dataset_development', 'geographic_holdout', 'final_geographic_holdout', 'inference_only')")])
    + " UNION ALL " + _unique("b", "unique_area", "aoi_id") + " UNION ALL " + _empty("SELECT * FROM b x JOIN b y ON x.box_id < y.box_id AND x.min_lon < y.max_lon AND y.min_lon < x.max_lon AND x.min_lat < y.max_lat AND y.min_lat < x.max_lat", "no_overlap")
    + " UNION ALL " + _empty("SELECT role FROM b GROUP BY role HAVING (role = 'geographic_holdout' AND count(*) <> 5) OR (role = 'dataset_development' AND count(*) <> 20)", "role_counts"),
    "dq_label_audit": f"""WITH {SCORES}, n AS (SELECT n_name AS aoi_id FROM nation UNION ALL SELECT DISTINCT o_orderpriority FROM orders),
  c AS (SELECT o_orderpriority AS aoi_id, month(o_orderdate) <= 6 AS early, 100::DOUBLE * count(*) FILTER (o_totalprice > 50000) / count(*) AS cov FROM orders GROUP BY ALL), cc AS (SELECT aoi_id, bool_or(early) AND bool_or(NOT early) AS two, count(*) AS k, min(cov) AS cov FROM c GROUP BY aoi_id),
  l AS (SELECT aoi_id, count(*) FILTER (target = 1)::BIGINT AS p, count(*) FILTER (target = 0)::BIGINT AS q, 100::DOUBLE * count(*) FILTER (row_off < 2000) / count(*) AS e, CASE WHEN aoi_id = '2-HIGH' THEN 2 ELSE 1 END AS rows FROM scores GROUP BY aoi_id),
  j AS (SELECT n.aoi_id, coalesce(two, false) AS two, coalesce(k, 0) AS k, cov, coalesce(rows, 0) AS rows, coalesce(p, 0) AS p, coalesce(q, 0) AS q, coalesce(e, 0) AS e FROM n LEFT JOIN cc USING (aoi_id) LEFT JOIN l USING (aoi_id)),
  f AS (SELECT *, concat_ws('|', CASE WHEN NOT two THEN 'has_two_composites' END, CASE WHEN NOT coalesce(k >= 2 AND cov >= 80, false) THEN 'composite_coverage' END, CASE WHEN rows <> 1 THEN 'single_label_row' END, CASE WHEN e < 95 THEN 'eligible_coverage' END, CASE WHEN NOT (p > 0 AND q > 0) THEN 'both_classes' END) AS failed FROM j)
  SELECT aoi_id, round(cov, 6) AS min_coverage_pct, p AS positive_pixels, q AS negative_pixels, round(e, 6) AS eligible_coverage_pct, round(CASE WHEN p + q > 0 THEN 100::DOUBLE * p / (p + q) ELSE 0 END, 6) AS positive_pct, failed AS failed_checks, CASE WHEN failed = '' THEN 'PASSED' ELSE 'FAILED' END AS status FROM f""",
    "dq_status": f"{_BLOCKS}, {_DR}, {_P}, r AS ({_DATASET} UNION ALL {_PREDICTIONS}) SELECT count(*)::BIGINT AS checks, count(*) FILTER (NOT passed)::BIGINT AS failed, CASE WHEN bool_and(passed) THEN 'PASSED' ELSE 'FAILED' END AS status FROM r",
}
