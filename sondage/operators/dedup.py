"""Duplicate rows and first-wins deduplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sondage.functions.canonical import quoted, row_digest


def duplicate_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table, duplicate_rows)``: rows beyond the first of their kind, NULL equal to NULL.
    Rows travel as a 16-byte digest, and repeated rows are merged before the shuffle."""
    parts = []
    for table, df in tables.items():
        digest = row_digest([(quoted(f.name), f.dataType) for f in df.schema.fields])
        kinds = df.select(*digest).toDF("first", "second").groupBy("first", "second").agg(F.count("*").alias("rows"))
        extra = kinds.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("duplicate_rows"))
        parts.append(extra.select(F.lit(table).alias("table"), "duplicate_rows"))
    return reduce(DataFrame.unionAll, parts)


def first_per_key(df: DataFrame, key: Column, order: Column) -> DataFrame:
    """The first row of every key by ``order``, which must differ between rows; rows without a key
    are all kept. Each task drops all but its own first row of a key before the shuffle, and rows
    without a key are spread by their order value."""
    spread = F.when(key.isNull(), order)
    place = F.row_number().over(Window.partitionBy(key, spread).orderBy(order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")
