import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracask.operators import geo, trees
from terracask.sources import readers, writers
from terracask.streaming import scoring


def test_manifest_with_byte_order_mark_and_header_only(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes('﻿"AOI ","Year"\n" a ","2018"\n'.encode())
    df = readers.manifest(spark, str(tmp_path / "m.csv"), required=["aoi_id"])
    assert df.columns == ["aoi_id", "year"] and df.first()["aoi_id"] == "a"
    empty = spark.createDataFrame([], "a string, b int, _private string")
    writers.manifest(empty, str(tmp_path / "out"), ["a", "b"], single=True)
    assert [p.read_text() for p in (tmp_path / "out").glob("part-*")] == ["a,b\n"]
    with pytest.raises(Exception):
        writers.manifest(empty, str(tmp_path / "out"), ["a"])


def test_areas():
    good = {"aois": [{"id": "a", "role": "dev", "bounds": [-70, -13, -69, -12]}]}
    assert readers.areas_of(good)[0].aoi_id == "a"
    for bad in ({}, {"aois": []}, {"aois": [{"id": "a", "bounds": [0, 0, 1, 1]}]}, {"aois": [{"id": "a", "role": "r", "bounds": [1, 0, 0, 1]}]}):
        with pytest.raises(ValueError):
            readers.areas_of(bad)


def test_catalogue_and_geojson(spark, tmp_path):
    item = {"id": "i", "properties": {"eo:cloud_cover": 3.5}, "links": [], "assets": {"B02": {"href": "h"}}}
    (tmp_path / "c.json").write_text(json.dumps({"type": "FeatureCollection", "features": [item]}, indent=1))
    assert readers.catalogue_items(spark, str(tmp_path / "c.json")).first()["item"]["assets"]["B02"]["href"] == "h"
    ring = [[-70, -13], [-69, -13], [-69, -12], [-70, -12], [-70, -13]]
    (tmp_path / "g.json").write_text(json.dumps({"features": [{"properties": {"aoi": "x"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}))
    assert tuple(readers.geojson_boxes(spark, str(tmp_path / "g.json")).first()) == ("x", -70.0, -13.0, -69.0, -12.0)


def test_tensors(spark, tmp_path):
    np.savez_compressed(tmp_path / "a.npz", features=np.arange(6, dtype=np.float32).reshape(2, 3))
    row = readers.npz_tensors(spark, str(tmp_path / "a.npz"), shape=(2, 3)).first()
    assert row["shape"] == [2, 3] and row["values"] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    with pytest.raises(Exception, match="shape"):
        readers.npz_tensors(spark, str(tmp_path / "a.npz"), shape=(3, 2)).collect()
    np.savez_compressed(tmp_path / "b.npz", features=np.array([np.nan]))
    with pytest.raises(Exception, match="finite"):
        readers.npz_tensors(spark, str(tmp_path / "b.npz")).collect()


def test_json_lines_and_shards(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"id": "a", "x": 1}\n{"id": "b"}\nnot json\n')
    got = [r["error"] for r in readers.json_lines(spark, str(tmp_path / "r.jsonl"), "id string, x double", ["id", "x"]).collect()]
    assert got == [None, "x is missing", "not valid JSON"]
    df = spark.range(25).coalesce(1)
    writers.json_line_shards(df, str(tmp_path / "s"), 10)
    assert sorted(len(p.read_text().splitlines()) for p in (tmp_path / "s").glob("part-*")) == [5, 10, 10]
    with pytest.raises(ValueError):
        writers.json_line_shards(df.limit(0), str(tmp_path / "t"))


def test_geojson_documents(spark, tmp_path):
    polygon = F.array(F.array(F.lit(1.0), F.lit(2.0)))
    df = spark.range(3).coalesce(1).select(geo.geojson_feature(polygon, F.struct("id")).alias("feature"))
    writers.feature_collection(df, str(tmp_path / "g"))
    document = json.loads(next((tmp_path / "g").glob("part-*")).read_text())
    assert document["type"] == "FeatureCollection" and [f["properties"]["id"] for f in document["features"]] == [0, 1, 2]


def test_model_round_trip_and_stream(spark, tmp_path):
    df = spark.createDataFrame([(float(i), i % 7, int(i > 20)) for i in range(40)], "a double, b int, y int")
    nodes = trees.fit_trees(df, ["a", "b"], "y", trees=5)
    meta = spark.range(1).select(F.array(F.lit("a"), F.lit("b")).alias("features"), F.lit(0.5).alias("threshold"), F.array(F.lit("mean")).alias("statistics"))
    writers.model(nodes, meta, str(tmp_path / "m"))
    found, table = readers.model(spark, str(tmp_path / "m"))
    assert found["features"] == ["a", "b"] and table.count() == nodes.count()
    writers.report(meta.withColumn("threshold", F.lit(1.5)), str(tmp_path / "m" / "metadata"), overwrite=True)
    with pytest.raises(ValueError):
        readers.model(spark, str(tmp_path / "m"))
    df.select("a", "b").write.json(str(tmp_path / "in"))
    stream = scoring.scored_stream(spark, str(tmp_path / "in"), "a double, b int", nodes, ["a", "b"], 0.5)
    scoring.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(60)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 40 and got.where("(probability >= 0.5) <> (prediction = 1)").count() == 0


def test_run_folder(spark, tmp_path):
    p = spark.createDataFrame([("a", 0.5)], "patch_id string, probability double")
    writers.run_folder(str(tmp_path / "run"), p, p.limit(0), p, p)
    assert {k: v.count() for k, v in readers.run_folder(spark, str(tmp_path / "run")).items()} == {"predictions": 1, "rejected": 0, "summary": 1, "report": 1}


def test_missing_files_are_named_and_paths_resolved(spark, tmp_path):
    p = spark.createDataFrame([("a", 0.5)], "patch_id string, probability double")
    p.write.parquet(str(tmp_path / "run" / "predictions"))
    with pytest.raises(FileNotFoundError, match="rejected, aoi_summary, run_report"):
        readers.run_folder(spark, str(tmp_path / "run"))
    (tmp_path / "m" / "x").mkdir(parents=True)
    (tmp_path / "m" / "x" / "f.csv").write_text("a")
    assert readers.resolved(spark, "x\\f.csv", [str(tmp_path), str(tmp_path / "m")]) == str(tmp_path / "m" / "x" / "f.csv")
    assert readers.resolved(spark, str(tmp_path / "m"), []) == str(tmp_path / "m")
    with pytest.raises(FileNotFoundError):
        readers.resolved(spark, "x/g.csv", [str(tmp_path)])


def test_vector_files(spark, tmp_path):
    box = [[[0.0, 1.0], [2.0, 1.0], [2.0, 3.0], [0.0, 1.0]]]
    features = [{"properties": {"aoi": "p"}, "geometry": {"type": "Polygon", "coordinates": box}}, {"properties": {"aoi_id": "m"}, "geometry": {"type": "MultiPolygon", "coordinates": [box, [[[5.0, 5.0], [9.0, 6.0], [5.0, 5.0]]]]}}]
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "crs": {"properties": {"name": "urn:ogc:def:crs:OGC:1.3:CRS84"}}, "features": features}))
    got = {r["aoi_id"]: tuple(r)[1:] for r in readers.geojson_boxes(spark, str(tmp_path / "a.geojson"), "CRS84").collect()}
    assert got == {"p": (0.0, 1.0, 2.0, 3.0), "m": (0.0, 1.0, 9.0, 6.0)}
    with pytest.raises(Exception, match="not the one required"):
        readers.geojson_boxes(spark, str(tmp_path / "a.geojson"), "4326").collect()


def test_shards_are_numbered_and_blanks_left_out(spark, tmp_path):
    df = spark.createDataFrame([(i, " " if i % 5 == 0 else f"t{i}") for i in range(25)], "k int, text string")
    writers.json_line_shards(df, str(tmp_path / "s"), 8, text="text", keys=["k"])
    folders = sorted((tmp_path / "s").glob("shard=*"))
    assert [f.name for f in folders] == ["shard=part-00001", "shard=part-00002", "shard=part-00003"]
    rows = [[json.loads(line)["k"] for f in sorted(folder.glob("part-*")) for line in f.read_text().splitlines()] for folder in folders]
    assert [len(r) for r in rows] == [8, 8, 4] and sum(rows, []) == [i for i in range(25) if i % 5]
    with pytest.raises(ValueError):
        writers.json_line_shards(df.where("k % 5 = 0"), str(tmp_path / "t"), text="text")
