"""Session settings and staging of intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches. On a cluster, use the session it gives you."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("churnlake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="churnlake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/churnlake/{app}/{name}-{uuid.uuid4().hex[:12]}"


#: Rows of a narrow table (numbers, no texts) that are worth a task and a file of their own.
ROWS_PER_FILE = 20_000


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a narrow table of about ``rows`` rows, in no more partitions than these are worth. Nothing is shuffled."""
    return df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))


def stage(df: DataFrame, name: str = "stage", rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and keeps column pruning and filter
    pushdown for the passes that follow (a plain checkpoint would lose both).
    ``rows``: of a narrow table, at most about how many it has, where that is known; a small one
    is then not written as a file per shuffle partition.
    """
    path = new_path(df.sparkSession, name)
    df = df if rows is None else few_tasks(df, rows)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_stages(spark: SparkSession) -> None:
    """Delete what ``stage`` wrote for this application."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/churnlake/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_table(df: DataFrame, max_rows: int = 50_000) -> DataFrame | None:
    """``df`` as a driver-built table if it has at most ``max_rows`` rows, else None.

    At most ``max_rows + 1`` rows are ever fetched, so the check itself is bounded.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, schema=df.schema)


def attach(df: DataFrame, lookup: DataFrame, on: list[str], max_rows: int = 50_000) -> DataFrame:
    """Left join on null-safe keys. ``lookup`` is unique on ``on``.

    The lookup is broadcast only if it was counted and is small; otherwise it is an
    ordinary shuffle join, whose hot keys AQE splits.
    """
    small = small_table(lookup, max_rows)
    right = F.broadcast(small) if small is not None else lookup
    renamed = right.withColumnsRenamed({c: f"__{c}" for c in on})
    match = None
    for c in on:
        one = df[c].eqNullSafe(renamed[f"__{c}"])
        match = one if match is None else match & one
    return df.join(renamed, match, "left").drop(*[f"__{c}" for c in on])
