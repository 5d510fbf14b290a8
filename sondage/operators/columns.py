"""Per-column facts read in plain scans: row counts, nulls, text lengths, smallest values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondage.functions.canonical import clean, is_string, quoted, sql_as_text, sql_clean, sql_name, sql_text


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table, row_count)``, exact; Parquet answers from its footers."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(t).alias("table"), "row_count") for t, df in tables.items()]
    return reduce(DataFrame.unionAll, parts)


def column_facts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table, column, ordinal, dtype, row_count, non_null, chars)``: one aggregate per table,
    in which every task sends a single row."""
    return reduce(DataFrame.unionAll, [_facts_of(t, df) for t, df in tables.items()])


def _facts_of(table: str, df: DataFrame) -> DataFrame:
    aggregates, entries = ["count(*) AS row_count"], []
    for i, field in enumerate(df.schema.fields):
        value = sql_clean(sql_name(field.name), field.dataType)
        aggregates.append(f"count({value}) AS present{i}")
        chars = "CAST(NULL AS BIGINT)"
        if is_string(field.dataType):
            aggregates.append(f"sum(CAST(char_length({value}) AS BIGINT)) AS chars{i}")
            chars = f"chars{i}"
        dtype = field.dataType.simpleString()
        entries.append(
            f"named_struct('column', {sql_text(field.name)}, 'ordinal', {i + 1}, 'dtype', {sql_text(dtype)}, "
            f"'row_count', row_count, 'non_null', present{i}, 'chars', {chars})"
        )
    wide = df.selectExpr(*aggregates)
    return wide.selectExpr(f"{sql_text(table)} AS `table`", f"inline(array({', '.join(entries)}))")


def null_stats(facts: DataFrame) -> DataFrame:
    """``(table, column, null_count, null_pct)``; the share is 0 for an empty table."""
    nulls = F.col("row_count") - F.col("non_null")
    return facts.select(
        "table",
        "column",
        nulls.alias("null_count"),
        F.when(F.col("row_count") > 0, F.round(nulls / F.col("row_count") * 100, 2)).otherwise(0.0).alias("null_pct"),
    )


def smallest_values(table: str, df: DataFrame, k: int = 3) -> DataFrame:
    """``(table, column, place, sample)``: the first ``k`` distinct values of every column of
    single values, in value order.

    Step i takes the minimum above the value found in step i - 1. A step is one aggregate over a
    scan, so no distinct values are shuffled, however many there are.
    """
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    fields = [f for f in df.schema.fields if not isinstance(f.dataType, nested)]
    wide = df.selectExpr(*[f"{sql_clean(sql_name(f.name), f.dataType)} AS c{i}" for i, f in enumerate(fields)])
    source, rows = None, "{wide}"
    for place in range(1, k + 1):
        minima = ", ".join(
            f"min(c{i}) AS v{i}" if source is None else f"min(CASE WHEN c{i} > last.v{i} THEN c{i} END) AS v{i}"
            for i in range(len(fields))
        )
        # One row: this step's minima and, nested in it, those of the steps before.
        carried = "" if source is None else ", any_value(last) AS earlier"
        source = f"SELECT {minima}{carried} FROM {rows}"
        rows = f"(SELECT *, (SELECT struct(*) FROM ({source})) AS last FROM {{wide}})"
    found = df.sparkSession.sql(source, wide=wide)
    entries = []
    for place in range(1, k + 1):
        depth = "earlier." * (k - place)
        for i, f in enumerate(fields):
            sample = sql_as_text(f"{depth}v{i}", f.dataType)
            entries.append(f"named_struct('column', {sql_text(f.name)}, 'place', {place}, 'sample', {sample})")
    listed = found.selectExpr(f"{sql_text(table)} AS `table`", f"inline(array({', '.join(entries)}))")
    return listed.filter("sample IS NOT NULL")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-null values of one column."""
    value = clean(quoted(column), df.schema[column].dataType)
    return df.select(value.alias(column)).filter(quoted(column).isNotNull()).distinct()
