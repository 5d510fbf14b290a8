"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Set the SQL options the operators rely on."""
    # A repeated JSON key keeps its last value instead of making the record unreadable.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir`` or set for the context."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="sondage-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


#: Rows that one task takes at most where tables are spread, however few row groups their files have.
SPREAD_ROWS = 50_000


def spread(table: DataFrame) -> DataFrame:
    """Deal the rows of a table read from files out to all cores ahead of costly work, and to more tasks the more
    rows there are. How many tasks a scan is cut into does not tell how many of them hold rows, since a row group
    is read by one; so the rows are counted, which Parquet answers from its footers."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(max(cores, -(-table.count() // SPREAD_ROWS)))


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint that outlives lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
