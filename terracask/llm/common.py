"""Shared helpers of the training-data operators."""

from __future__ import annotations

import atexit
import bisect
import contextlib
import tempfile
import uuid
from collections.abc import Iterator, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the session. Where none is set, local mode makes a temporary one; a
    cluster has to name one, as its machines don't share their temporary folders."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="terracask-"))
    return context.getCheckpointDir().rstrip("/")


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is run here hands Python batches of at most ``rows`` rows, whose cells may be large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


_written: dict[str, SparkSession] = {}


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends."""
    path = f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
    _written[path] = spark
    return path


def write_table(spark: SparkSession, df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` as Parquet in the shared folder, and its path (see ``drop_path``)."""
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    _written.pop(path, None)


@atexit.register
def _drop_written() -> None:
    for path, spark in list(_written.items()):
        try:
            drop_path(spark, path)
        except Exception:  # the JVM may be gone already
            return


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- range buckets


def range_bounds(df: DataFrame, key: str, buckets: int) -> list[float]:
    """At most ``buckets - 1`` cut points that deal ``key`` out evenly.

    A key that takes more than one bucket's share appears twice, see
    ``hot_keys``. An empty table has no cut points.
    """
    shares = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(F.col(key).cast("double"), shares, 20 * buckets).alias("cuts")).first()
    return list(row["cuts"] or [])


def hot_keys(bounds: Sequence[float]) -> list[float]:
    return sorted({a for a, b in zip(bounds, bounds[1:]) if a == b})


def with_bucket(df: DataFrame, key: str, bounds: Sequence[float], out: str) -> DataFrame:
    """Adds ``out``: the number of cut points at or below ``key`` (null keys: 0).

    The bucket never falls as the key rises, so a bucket-wise order is a total one.
    """
    cuts = sorted(set(bounds))
    if not cuts:
        return df.withColumn(out, F.lit(0))
    value = f"{out}__value"
    splits = [float("-inf"), *cuts, float("inf")]
    sized = df.withColumn(value, F.coalesce(F.col(key).cast("double"), F.lit(float("-inf"))))
    dealt = Bucketizer(splits=splits, inputCol=value, outputCol=out).transform(sized)
    return dealt.withColumn(out, F.col(out).cast("int")).drop(value)


def bucket_of(value: float | None, bounds: Sequence[float]) -> int:
    cuts = sorted(set(bounds))
    return 0 if value is None else bisect.bisect_right(cuts, float(value))


#: Copies that one task makes of a row.
COPIES_AT_ONCE = 1 << 16


def expanded(df: DataFrame, count: str, out: str) -> DataFrame:
    """Each row ``count`` times, numbered from 0 in ``out``. Rows with very many copies are cut into
    runs of ``COPIES_AT_ONCE`` first, which are dealt out over all tasks."""
    n, most = F.col(count), F.lit(COPIES_AT_ONCE)
    few = df.where((n > 0) & (n <= most)).withColumn(out, F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)))
    run = fresh(df, "__run")
    runs = df.where(n > most).withColumn(run, F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1, most.cast("bigint"))))
    dealt = runs.repartition(shuffle_width(df.sparkSession), F.hash(*(F.col(c) for c in runs.columns)))
    many = dealt.withColumn(out, F.explode(F.sequence(F.col(run), F.least(F.col(run) + most, n) - 1))).drop(run)
    return few.unionByName(many)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small driver-made table without a Python scan in the plan."""
    names = [part.split()[0] for part in schema.split(",")]
    kinds = [part.split()[1] for part in schema.split(",")]
    if not rows:
        return spark.range(0).select(*(F.lit(None).cast(k).alias(n) for n, k in zip(names, kinds)))
    cells = [F.struct(*(F.lit(v).cast(k).alias(n) for v, n, k in zip(r, names, kinds))) for r in rows]
    return spark.range(1).select(F.inline(F.array(*cells)))


def ascii_lower(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` clashes with it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
