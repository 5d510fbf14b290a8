"""Reading and listing tables: Parquet folders, CSV exports, JSON Lines, JSON documents."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondage.functions.canonical import quoted
from sondage.session import prepare


def list_folder(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any file system Spark can reach, sorted; empty when it is missing."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(path))


def table_name(file_name: str, prefix: str = "", suffix: str = "") -> str:
    """The table a file holds: its name without extension, ``prefix`` and ``suffix``."""
    stem = re.sub(r"\.[A-Za-z]+(\.(gz|bz2))?$", "", file_name)
    return stem.removeprefix(prefix).removesuffix(suffix) if prefix or suffix else stem


#: The name of a load that replaced all tables, in the folder's marker of it and in the folder that holds it.
COMMITTED, VERSION = "_committed-", "_version-"


def current_folder(spark: SparkSession, folder: str) -> str:
    """Where the tables of a folder are: in the last load that replaced them all, else in the folder itself."""
    done = [n for n in list_folder(spark, folder) if n.startswith(COMMITTED)]
    return f"{folder}/{VERSION}{max(done).removeprefix(COMMITTED)}" if done else folder


def list_tables(spark: SparkSession, folder: str) -> list[str]:
    """Tables of a folder; names that start with a dot or an underscore are the system's own."""
    names = [n for n in list_folder(spark, current_folder(spark, folder)) if not n.startswith((".", "_"))]
    return [table_name(n) for n in names if n.endswith(".parquet")]


def load_tables(spark: SparkSession, folder: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    names = names or list_tables(spark, folder)
    place = current_folder(spark, folder)
    return {n: spark.read.parquet(f"{place}/{n}.parquet") for n in names}


# Words that are often written for a missing value; a choice for ``missing``, not applied by default.
MISSING_WORDS = ("NA", "N/A", "n/a", "null", "NULL", "NaN", "nan", "None", "#N/A", "-")


def without_words(df: DataFrame, words=MISSING_WORDS) -> DataFrame:
    """Text columns in which the given words stand for NULL."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: F.when(~F.coalesce(quoted(n).isin(*words), F.lit(False)), quoted(n)) for n in names})


def read_csv(
    spark: SparkSession, path, schema: T.StructType | str | None = None, multiline: bool = True, mode: str = "PERMISSIVE"
) -> DataFrame:
    """A CSV file or folder of part files with a header row. Give a schema for large inputs: without
    one Spark reads the data once more to infer types. Empty values are NULL. Line breaks inside quotes belong to the value;
    ``multiline=False`` promises that there are none, so that large files can be split. ``mode`` is
    Spark's: ``FAILFAST`` stops at a row that does not fit the schema."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline).option("mode", mode)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def load_csv_folder(
    spark: SparkSession,
    folder: str,
    prefix: str = "",
    suffix: str = "",
    schemas: dict[str, T.StructType | str] | None = None,
    multiline: bool = True,
) -> dict[str, DataFrame]:
    """One table per ``*.csv`` entry (a file, or a folder of part files) directly in ``folder``."""
    files = [n for n in list_folder(spark, folder) if n.endswith(".csv")]
    if not files:
        raise FileNotFoundError(f"no CSV files in {folder}")
    schemas = schemas or {}
    tables = {}
    for name in files:
        table = table_name(name, prefix, suffix)
        tables[table] = read_csv(spark, f"{folder}/{name}", schemas.get(table), multiline)
    return tables


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Raw lines of text files as ``value``."""
    return spark.read.text(path)


def read_json_document(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Documents written by ``write_json``, or files that hold one JSON document each."""
    return spark.read.json(path, schema=schema)


def parse_objects(lines: DataFrame, column: str = "value", into: str = "record") -> DataFrame:
    """Add the parsed record of each line; blank lines, malformed JSON and lines that hold no
    object are dropped (``rejected_lines`` counts them). Of a repeated key the last value counts."""
    prepare(lines.sparkSession)
    text = F.btrim(quoted(column), F.lit(" \t\r\n\f\v"))
    # JSON text that starts with a brace and can be read is an object. The record goes through a
    # generator, because a filter on it would otherwise parse every line a second time.
    parsed = lines.filter(text.startswith("{")).select("*", F.explode(F.array(F.try_parse_json(text))).alias(into))
    return parsed.filter(F.col(into).isNotNull())


def rejected_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(reason, lines)`` of the lines that ``parse_objects`` drops: ``blank``, ``malformed`` JSON (or too
    large for a VARIANT), and JSON that is ``not an object``."""
    prepare(lines.sparkSession)
    text = F.btrim(quoted(column), F.lit(" \t\r\n\f\v"))
    parsed = lines.select(text.alias("text")).select("text", F.explode(F.array(F.try_parse_json("text"))).alias("parsed"))
    reason = (
        F.when(F.coalesce(F.col("text"), F.lit("")) == "", "blank")
        .when(F.col("parsed").isNull(), "malformed")
        .when(~F.col("text").startswith("{"), "not an object")
    )
    return parsed.select(reason.alias("reason")).filter("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("lines"))
