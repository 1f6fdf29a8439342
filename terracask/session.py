"""Session builder with the settings the engine expects."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "terracask", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ANSI SQL, UTC and adaptive execution; ``conf`` overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    return builder.config(map=settings).getOrCreate()


def settled(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and cut from their lineage, in the session's shared folder.
    Local mode makes a folder where none is set; a cluster has to name one."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        configured = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not configured and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="terracask-"))
    return df.checkpoint()
