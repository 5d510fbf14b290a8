"""Writing tables, documents and run logs."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondage.sources.files import COMMITTED, VERSION, current_folder, list_folder


def write_table(df: DataFrame, folder: str, table: str, append: bool = False) -> str:
    """Write one table of a Parquet folder, replacing or extending what is there."""
    path = f"{current_folder(df.sparkSession, folder)}/{table}.parquet"
    df.write.mode("append" if append else "overwrite").parquet(path)
    return path


def append_chunks(chunks: Iterable[DataFrame], folder: str, table: str) -> int:
    """Load a bulk export chunk by chunk: the first chunk replaces the table, the others are
    appended. Returns the rows of the table."""
    path, spark = None, None
    for i, chunk in enumerate(chunks):
        path, spark = write_table(chunk, folder, table, append=i > 0), chunk.sparkSession
    return 0 if path is None else spark.read.parquet(path).count()


def replace_all(spark: SparkSession, folder: str, tables: dict[str, DataFrame], at_once: int = 4) -> None:
    """Make ``folder`` hold exactly these tables.

    They are written into a folder of their own, a few at a time, and count once an empty marker beside it
    names that folder; creating it is the one step that takes effect, and readers follow the last marker. A load that stops
    anywhere leaves the tables of before or the new ones. The load before stays for readers that have
    begun; older ones are deleted."""
    system = _system(spark, folder)
    names = list_folder(spark, folder)
    done = sorted(n.removeprefix(COMMITTED) for n in names if n.startswith(COMMITTED))
    load = f"{int(done[-1].split('-')[0]) + 1 if done else 1:010d}-{uuid.uuid4().hex}"
    beside = f"{folder}/{VERSION}{load}"
    write = inheritable_thread_target(spark)(lambda table: tables[table].write.parquet(f"{beside}/{table}.parquet"))
    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(write, tables))
    _commit(spark, system, f"{folder}/{COMMITTED}{load}")
    stale = [n for n in names if not n.startswith(("_", ".")) and n.endswith(".parquet")]
    for old in done[:-1]:
        stale += [f"{COMMITTED}{old}", f"{VERSION}{old}"]
    for name in stale:
        remove(spark, f"{folder}/{name}")


def _system(spark: SparkSession, folder: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _commit(spark: SparkSession, system, marker: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(marker)
    system.mkdirs(path.getParent())
    if not system.createNewFile(path):
        raise OSError(f"{marker} exists already")


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the engine's own making."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Part files with a header each; ``compression`` such as gzip or bzip2. Blanks at the ends of values
    and microseconds of times stay."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    # Spark's own formats end at milliseconds.
    writer = writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    (writer.option("compression", compression) if compression else writer).csv(path)


def write_json(df: DataFrame, path: str, append: bool = False) -> None:
    """One JSON document per row."""
    df.write.mode("append" if append else "overwrite").json(path)


def append_run_log(df: DataFrame, path: str) -> None:
    """Add rows to a JSON Lines log, stamped with the time of the run (UTC)."""
    write_json(df.withColumn("timestamp", F.current_timestamp()), path, append=True)

