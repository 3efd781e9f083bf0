"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlake.session import stage

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its values; null counts as empty."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def in_pieces(batch: pa.RecordBatch, column: int, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of at most about ``size`` bytes of a text column, and of one row at least: texts differ much in length."""
    ends = utf8(batch.column(column))[1][1:]
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, end - start)
        start = end


def kind_of(df: DataFrame, column: str) -> str:
    return df.select(column).schema[0].dataType.simpleString()


def settled(df: DataFrame, name: str) -> DataFrame:
    """``stage``, then a hint to collect garbage: Spark deletes the shuffle files of plans that nobody holds."""
    out = stage(df, name)
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stage`` wrote. Everything that reads them must have been stored by then."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for file in df.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)).getParent()
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def is_empty(df: DataFrame) -> bool:
    return not df.head(1)


def large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct())


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them. Edges run from larger ``a`` to smaller ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    down = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return down.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b; a differs from b): one row (node, root) per linked node but the roots.

    Alternates large-star and small-star steps until the edges form stars around the least
    node of each component. No step gathers a node's neighbours in one row, so a node with
    very many links only makes the joins skewed, which AQE splits. The number of edges never
    grows, so each table is written in as many files as the rows of the one before are worth.
    """
    now = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        after = stage(small_star(large_star(now)), "edges", now.count())
        if is_empty(after.exceptAll(now)) and is_empty(now.exceptAll(after)):
            return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now = after


def running_start(df: DataFrame, group: list[str], order: list[str], size: str, name: str, rows: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``size`` over the rows before, by ``order`` within ``group``.

    Rows are dealt by range of (group, order) and stored with the number of their range, so
    a group of any size is spread; sums of ranges, one row per group and range, are added up
    first, and each range then needs only its own rows. Rows that agree in group and order
    land in one range, in any order that is the same for equal inputs up to exchange of equal rows.
    ``rows``: how many rows ``df`` has, if that is known and they are narrow; see ``stage``.
    """
    ranges = df.repartitionByRange(*[F.col(c) for c in group + order]).withColumn("__range", F.spark_partition_id())
    stored = stage(ranges, "ranges", rows)
    sums = stored.groupBy(*group, "__range").agg(F.sum(size).alias("__sum"))
    before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("__start", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    starts = starts.withColumnsRenamed({c: f"__{c}" for c in group}).withColumnRenamed("__range", "__r")
    within = Window.partitionBy(*group, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    match = F.col("__range") == F.col("__r")
    for c in group:
        match = match & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return (stored.withColumn("__within", F.coalesce(F.sum(size).over(within), F.lit(0)))
            .join(starts, match, "left")
            .withColumn(name, F.col("__start") + F.col("__within"))
            .drop("__range", "__r", "__start", "__within", *[f"__{c}" for c in group]))


def blocks(length: int, size: int) -> Iterator[tuple[int, int]]:
    for start in range(0, length, size):
        yield start, min(length, start + size)
