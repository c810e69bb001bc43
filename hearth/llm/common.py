"""Helpers shared by the operators of this subpackage: tables, Arrow maps, written stages, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearth.session import ensure_checkpoint_dir

# Rows of one Arrow batch, and bytes of text handed to a kernel at once: texts may reach megabytes.
BATCH_ROWS = 2000
SLICE_BYTES = 4 << 20
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows (unless the session has a smaller bound already) and the bytes of an Arrow batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and return the table read back.

    Cuts the lineage: a lost executor costs its own tasks only, and the size of
    the table is known to the planner.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_texts(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType, limit: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` of a kernel on slices of a batch; the last column of ``df`` is the text, or the row's bytes as a number.

    A slice ends after ``limit`` bytes, so what a kernel holds and returns at
    once is bounded by that and the longest single text. ``None`` gives no rows.
    """
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.column(batch.num_columns - 1)
            lengths = pc.fill_null(last if pa.types.is_integer(last.type) else pc.binary_length(last), 0).to_pylist()
            at = size = 0
            for i, n in enumerate(lengths, 1):
                size += n
                if size >= limit or i == len(lengths):
                    out = fn(batch.slice(at, i - at))
                    if out is not None and out.num_rows:
                        yield out
                    at, size = i, 0

    return df.mapInArrow(run, schema)


def filter_rows(df: DataFrame, text_col: str, keep: Callable[[list[str | None]], list[bool]]) -> DataFrame:
    """The rows whose text ``keep`` accepts, all columns unchanged; each row is judged on its own, in one pass."""
    size = "bytes"
    while size in df.columns:
        size += "_"
    at = df.columns.index(text_col)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = batch.filter(pa.array(keep(batch.column(at).to_pylist()), pa.bool_()))
        return pa.RecordBatch.from_arrays(kept.columns[:-1], schema=pa.schema(list(kept.schema)[:-1]))

    return map_texts(df.select("*", F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).alias(size)), kernel, df.schema)


def arrow(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)`` (bigint): one row (node, root), root the smallest node.

    Rounds of hooking and contraction. Each node points to the smallest of its
    neighbours and itself; pointers are doubled until they reach the local
    roots; edges are then relabelled to roots, and those inside a component
    vanish. Every step is a join or a ``min`` with map-side combine, so a hub
    with millions of neighbours never meets in one task. Null endpoints and
    self loops are dropped.
    """
    edges = written(edges.where("a != b").select("a", "b").distinct(), f"{name}-edges")
    labels: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = written(both.groupBy("a").agg(F.min("b").alias("b"))
                       .select(F.col("a").alias("node"), F.least("a", "b").alias("root")), f"{name}-hook")
        while True:
            nxt = written(_relabel(hook, "root", hook).withColumnRenamed("root_new", "to")
                          .select("node", F.col("to").alias("root"), (F.col("to") != F.col("root")).alias("moved")),
                          f"{name}-jump")
            done = nxt.where("moved").isEmpty()
            hook = nxt.drop("moved")
            if done:
                break
        if labels is None:
            labels = hook
        else:
            labels = written(_relabel(labels, "root", hook).select("node", F.col("root_new").alias("root")), f"{name}-labels")
        edges = written(_relabel(_relabel(edges, "a", hook), "b", hook)
                        .select(F.col("a_new").alias("a"), F.col("b_new").alias("b"))
                        .where("a != b").distinct(), f"{name}-edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def _relabel(df: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    """Add ``<column>_new``: the root of ``column`` where ``roots(node, root)`` has one, else itself."""
    to = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return (df.join(to, F.col(column) == F.col("_node"), "left")
            .withColumn(f"{column}_new", F.coalesce("_root", column)).drop("_node", "_root"))
