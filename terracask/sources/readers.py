"""Sources: manifests, configurations, catalogues, tensors, JSON lines, models and run folders."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import canonicalize
from ..operators.scenes import ITEM


def manifest(spark: SparkSession, path: str, schema: str | None = None, aliases: dict[str, Sequence[str]] | None = None, required: Sequence[str] = ()) -> DataFrame:
    """A CSV manifest with a header. With ``schema`` columns are typed, else strings; a byte
    order mark and spaces or capitals in names are taken off."""
    reader = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    df = (reader.schema(schema) if schema else reader).csv(path)
    return canonicalize(df, aliases or {"aoi_id": ("aoi",)}, required)


@dataclass(frozen=True)
class Area:
    aoi_id: str
    role: str
    min_lon: float
    min_lat: float
    max_lon: float
    max_lat: float


def areas_of(config: dict) -> list[Area]:
    """The areas of a configuration mapping (``aois``: id, role, bounds); errors say what is wrong."""
    listed = config.get("aois") if isinstance(config, dict) else None
    if not listed:
        raise ValueError("the configuration has no areas")
    out = []
    for entry in listed:
        if not entry.get("role"):
            raise ValueError(f"area {entry.get('id')} has no role")
        bounds = [float(v) for v in entry["bounds"]]
        if len(bounds) != 4 or not (-180 <= bounds[0] < bounds[2] <= 180 and -90 <= bounds[1] < bounds[3] <= 90):
            raise ValueError(f"bounds of {entry.get('id')} are not valid")
        out.append(Area(entry["id"], entry["role"], *bounds))
    return out


def yaml_areas(spark: SparkSession, path: str) -> DataFrame:
    """The areas of a YAML configuration file, read through Spark's file systems."""
    import yaml

    text = spark.read.text(path, wholetext=True).first()["value"]
    return spark.createDataFrame(areas_of(yaml.safe_load(text)))


def catalogue_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of captured feature collections, a row per feature."""
    pages = spark.read.option("multiLine", True).schema(f"features array<{ITEM}>").json(path)
    return pages.select(F.explode("features").alias("item"))


def within_window(items: DataFrame, start: str, end: str, at: str = "item.properties.datetime") -> DataFrame:
    """Items whose time lies in the closed window of days."""
    day = F.substring(F.col(at), 1, 10)
    return items.where((day >= start) & (day <= end))


def geojson_boxes(spark: SparkSession, path: str, crs: str | None = None) -> DataFrame:
    """Bounds of the polygons and multipolygons of GeoJSON files, named by their ``aoi_id`` or ``aoi``
    property. With ``crs``, files must name a coordinate system that ends with it (others are an error)."""
    kind = "crs struct<properties:struct<name:string>>, features array<struct<properties:struct<aoi_id:string,aoi:string>,geometry:struct<type:string,coordinates:string>>>"
    documents = spark.read.option("multiLine", True).schema(kind).json(path)
    if crs:
        named = F.coalesce("crs.properties.name", F.lit(""))
        wrong = F.raise_error(F.concat(F.lit("coordinate system is not the one required: "), named)).cast("boolean")
        documents = documents.where(F.when(named.endswith(crs), F.lit(True)).otherwise(wrong))
    f = documents.select(F.explode("features").alias("f"))
    rings = "array<array<array<double>>>"
    polygons = F.when(F.col("f.geometry.type") == "MultiPolygon", F.from_json("f.geometry.coordinates", f"array<{rings}>")).otherwise(F.array(F.from_json("f.geometry.coordinates", rings)))
    f = f.withColumn("points", F.flatten(F.flatten(polygons)))
    lons, lats = F.transform("points", lambda p: p[0]), F.transform("points", lambda p: p[1])
    return f.select(
        F.coalesce("f.properties.aoi_id", "f.properties.aoi").alias("aoi_id"),
        F.array_min(lons).alias("min_lon"), F.array_min(lats).alias("min_lat"), F.array_max(lons).alias("max_lon"), F.array_max(lats).alias("max_lat"),
    )


def npz_tensors(spark: SparkSession, path: str, key: str = "features", shape: tuple[int, ...] | None = None) -> DataFrame:
    """NPZ files as (path, shape, values), one row each; an error for a wrong shape or a value
    that isn't finite."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"]):
                with np.load(io.BytesIO(content)) as arrays:
                    values = arrays[key]
                if shape is not None and values.shape != shape:
                    raise ValueError(f"{name} has shape {values.shape}")
                if not np.isfinite(values).all():
                    raise ValueError(f"{name} has values that are not finite")
                yield pd.DataFrame({"path": [name], "shape": [list(values.shape)], "values": [values.astype(float).ravel().tolist()]})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(read, "path string, shape array<int>, values array<double>")


def json_lines(spark: SparkSession, path: str, schema: str, required: Sequence[str]) -> DataFrame:
    """JSON lines with ``error``: null, or why the record can't be used."""
    df = spark.read.schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    error = F.when(F.col("_corrupt").isNotNull(), F.lit("not valid JSON"))
    for r in reversed(list(required)):
        error = F.when(F.col("_corrupt").isNull() & F.col(r).isNull(), F.lit(f"{r} is missing")).otherwise(error)
    return df.withColumn("error", error).drop("_corrupt")


def model(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    """A model's metadata, checked, and its node table."""
    meta = spark.read.json(f"{path}/metadata").first().asDict(recursive=True)
    for name in ("features", "threshold", "statistics"):
        if name not in meta:
            raise ValueError(f"model metadata has no {name}")
    if not 0 <= meta["threshold"] <= 1:
        raise ValueError("the model's threshold is outside [0, 1]")
    return meta, spark.read.parquet(f"{path}/nodes")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def resolved(spark: SparkSession, path: str, roots: Sequence[str]) -> str:
    """A path of a manifest, with ``/`` between its parts: as it is if it is absolute, else the first
    that exists below the roots (the project's, the manifest's); an error if there is none."""
    plain = path.replace("\\", "/")
    tried = [plain] if plain.startswith("/") or "://" in plain else [f"{r.rstrip('/')}/{plain}" for r in roots]
    for candidate in tried:
        if exists(spark, candidate):
            return candidate
    raise FileNotFoundError(f"none of {tried} exists")


def run_folder(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The relations of a finished inference run; an error that names those that are missing."""
    if missing := [n for n in ("predictions", "rejected", "aoi_summary", "run_report") if not exists(spark, f"{path}/{n}")]:
        raise FileNotFoundError(f"the run has no {', '.join(missing)}")
    return {
        "predictions": spark.read.parquet(f"{path}/predictions"),
        "rejected": spark.read.parquet(f"{path}/rejected"),
        "summary": spark.read.parquet(f"{path}/aoi_summary"),
        "report": spark.read.json(f"{path}/run_report"),
    }
