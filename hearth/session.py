"""Spark session defaults, the shared checkpoint folder, and written intermediate tables.

On a cluster the platform configures the session; ``get_spark`` only fills
settings that are still unset, and sizes nothing outside local mode.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that any session may lack.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
# Sizes for one machine (tests, bench).
LOCAL_DEFAULTS = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g"}


def get_spark(master: str | None = None, app: str = "hearth", **conf: str) -> SparkSession:
    """The running session, or a new one; a key that the session already has keeps its value, unless ``conf`` names it."""
    active = SparkSession.getActiveSession()
    if active is None:
        builder = SparkSession.builder.appName(app)
        sizes = {}
        if master:
            builder = builder.master(master)
            sizes = LOCAL_DEFAULTS if master.startswith("local") else {}
        given = dict(_submitted())
        for k, v in {**DEFAULTS, **sizes}.items():
            if k not in given:
                builder = builder.config(k, v)
        spark = builder.config(map=conf).getOrCreate() if conf else builder.getOrCreate()
    else:
        spark = active
        for k, v in conf.items():
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _submitted() -> list[tuple[str, str]]:
    """What spark-submit or the defaults file has set for the context to come."""
    from pyspark import SparkConf

    return SparkConf().getAll()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a folder there that all executors share; without one this
    raises. Only a local session gets a scratch folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = os.environ.get("HEARTH_SCRATCH") or tempfile.mkdtemp(prefix="hearth-ckpt-")
        d = os.path.join(base, "checkpoints")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder, for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/tables/" + name


def compiled(spark: SparkSession) -> None:
    """Let wide stages run operator by operator if their generated method is beyond what the JVM compiles (8,000 bytes).

    Such a method is interpreted, which costs a multiple. A limit that the session has set itself stays.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, "65535") == "65535":
        spark.conf.set(key, "8000")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and return the table read back: lineage is cut and the size is known."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written = path
    return table


def release(table: DataFrame) -> None:
    """Delete the files of a table that ``materialise`` returned, once all that is read from it is written."""
    path = getattr(table, "_written", None)
    if path is not None:
        context = table.sparkSession.sparkContext
        at = context._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
