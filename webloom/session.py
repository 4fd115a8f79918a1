"""Session settings and lineage cuts shared by every job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "webloom", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, use the one submitted."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of this machine; on a
    cluster a missing setting is an error, because executors could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="webloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    A table rather than an RDD checkpoint: it is columnar, it survives the loss of
    any executor, and its real size is known to the planner of the next step.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table written by ``cut_lineage`` that no later step reads."""
    files = df.inputFiles()
    if files:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def cut_bucketed(df: DataFrame, label: str, buckets: int, columns: list[str]) -> DataFrame:
    """Like ``cut_lineage``, in buckets by ``columns``: joins on them do not shuffle the table again."""
    path = scratch_path(df.sparkSession, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    laid = df.repartition(buckets, *columns)
    laid.write.bucketBy(buckets, *columns).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs.

    It does so once the driver's garbage collector has met their plans, which on a quiet driver may take half an hour
    (``spark.cleaner.periodicGC.interval``); jobs that write one large table after the other ask for it in between.
    """
    spark.sparkContext._jvm.System.gc()


class GrowingTable:
    """A table that an iterative job extends pass by pass in the shared folder.

    Only the new rows of a pass are written; the whole is read from the folder, so a
    pass costs its own rows and the plan stays flat.
    """

    def __init__(self, first: DataFrame, label: str):
        self._spark, self._schema = first.sparkSession, first.schema
        self._path, self._passes = scratch_path(self._spark, label), 0
        self.add(first)

    def add(self, rows: DataFrame) -> DataFrame:
        """Write the rows of one pass and return them as read back."""
        part = f"{self._path}/pass-{self._passes:05d}"
        rows.select(*self._schema.names).write.parquet(part)
        self._passes += 1
        return self._spark.read.schema(self._schema).parquet(part)

    def all(self) -> DataFrame:
        return self._spark.read.schema(self._schema).parquet(f"{self._path}/pass-*")
