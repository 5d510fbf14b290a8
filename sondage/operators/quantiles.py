"""Exact quantiles by radix selection, without sketches and without gathering a column in one place.

A quantile with linear interpolation needs the values at two neighbouring ranks. One pass over all numeric
columns of all tables counts values by an order-preserving code: the logarithm's steps, mirrored for negative
values. A running total finds the codes that hold the wanted ranks, together with the least and
greatest value of each. While these differ, another pass cuts the span between them into equal steps and
counts the values inside it. A step divides the span by as many buckets as there are, so doubles
are told apart after at most four such passes, whatever their distribution; most columns need one.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sondage.functions.canonical import is_numeric, sql_number, sql_text

QUARTILES = (0.25, 0.75)
#: Buckets of a pass; a task sends at most so many rows for a column (twice as many in the first pass).
BUCKETS = 1 << 16
# Natural logarithms of the least and the greatest positive double, with some room.
LEAST_LOG, GREATEST_LOG = -745.2, 709.8


@dataclass(frozen=True)
class Target:
    """A wanted rank of a column, counted from the least of the values from ``low`` to ``high`` that hold it."""

    entry: int
    probability: float
    weight: float
    present: int
    upper: bool
    rank: int
    low: float
    high: float

    @property
    def span(self) -> tuple[int, float, float]:
        return self.entry, self.low, self.high


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def exact_quantiles(tables: dict[str, DataFrame], probabilities=QUARTILES, buckets: int = BUCKETS) -> DataFrame | None:
    """``(table, column, probability, value, present)`` for all numeric columns that have values, of which
    ``present`` is the number. NULL and NaN are no values. None when there is no value at all."""
    entries = [(t, c) for t, df in tables.items() for c in numeric_columns(df)]
    if not entries:
        return None
    targets, found = _first_pass(tables, entries, probabilities, buckets), {}
    while targets:
        for target in targets:
            if target.low == target.high:
                found[target.entry, target.probability, target.upper] = target
        targets = [t for t in targets if t.low != t.high]
        targets = _narrowed(tables, entries, targets, buckets) if targets else []
    rows = []
    for (entry, probability, upper), low in found.items():
        if not upper:
            high = found[entry, probability, True].low
            # Between two equal infinities there is no difference to take.
            value = low.low if low.low == high else low.low + (high - low.low) * low.weight
            rows.append((*entries[entry], probability, value, low.present))
    spark = next(iter(tables.values())).sparkSession
    return _table(spark, rows, "table string, column string, probability double, value double, present bigint") if rows else None


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of the driver's, a few rows per column, as one statement."""
    names, kinds = zip(*(part.split(" ") for part in schema.split(", ")), strict=True)
    listed = ", ".join("(" + ", ".join(sql_text(str(v)) for v in row) + ")" for row in rows)
    typed = ", ".join(f"CAST(`{n}` AS {k}) AS `{n}`" for n, k in zip(names, kinds, strict=True))
    return spark.sql(f"SELECT {typed} FROM VALUES {listed} AS t({', '.join(f'`{n}`' for n in names)})")


def _cells(df: DataFrame, cells: list[tuple[str, str, str]]) -> DataFrame:
    """``(span, code, value)``: a row for each of the given triples of expressions that has a span."""
    named = [(f"s{i}", f"c{i}", f"v{i}") for i in range(len(cells))]
    wide = df.selectExpr(*[f"{sql} AS {name}" for cell, names in zip(cells, named, strict=True) for sql, name in zip(cell, names, strict=True)])
    listed = ", ".join(f"({', '.join(names)})" for names in named)
    return df.sparkSession.sql(f"SELECT span, code, value FROM {{wide}} UNPIVOT ((span, code, value) FOR cell IN ({listed})) WHERE span IS NOT NULL", wide=wide)


def _counted(parts: list[DataFrame]) -> DataFrame:
    """``(span, below, n, low, high)`` of each code; ``below`` counts the values of the span before it."""
    by_code = reduce(DataFrame.unionAll, parts).groupBy("span", "code").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    before = Window.partitionBy("span").orderBy("code").rowsBetween(Window.unboundedPreceding, -1)
    return by_code.select("span", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("below"), "n", "low", "high")


def _first_pass(tables: dict[str, DataFrame], entries: list[tuple[str, str]], probabilities, buckets: int) -> list[Target]:
    number = {entry: i for i, entry in enumerate(entries)}
    scale = (buckets - 1) / (GREATEST_LOG - LEAST_LOG)
    parts = []
    for table, df in tables.items():
        cells = []
        for column in numeric_columns(df):
            value = sql_number(column, df.schema[column].dataType)
            # Zero has a code of its own, and so has infinity.
            step = f"1 + LEAST(FLOOR((LN(ABS({value})) - {LEAST_LOG}D) * {scale!r}D), {buckets})"
            code = f"CASE WHEN {value} = 0 THEN 0 WHEN ABS({value}) = DOUBLE('Infinity') THEN SIGN({value}) * {buckets + 2} ELSE SIGN({value}) * ({step}) END"
            cells.append((f"IF({value} IS NULL, NULL, {number[table, column]})", f"CAST({code} AS BIGINT)", value))
        if cells:
            parts.append(_cells(df, cells))
    counted = _counted(parts)
    present = counted.withColumn("present", F.sum("n").over(Window.partitionBy("span")))
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    place = (F.col("present") - 1) * F.col("probability")
    ranks = F.array(F.struct(F.lit(False).alias("upper"), F.floor(place).alias("rank")), F.struct(F.lit(True).alias("upper"), F.least(F.floor(place) + 1, F.col("present") - 1).alias("rank")))
    each = present.select("*", wanted).select("*", place.alias("place"), F.explode(ranks).alias("r"))
    hit = (F.col("r.rank") >= F.col("below")) & (F.col("r.rank") < F.col("below") + F.col("n"))
    # Two rows for each numeric column and probability.
    rows = each.filter(hit).select("span", "probability", (F.col("place") - F.floor("place")).alias("weight"), "present", "r.upper", (F.col("r.rank") - F.col("below")).alias("rank"), "low", "high")
    return [Target(*row) for row in rows.collect()]


def _narrowed(tables: dict[str, DataFrame], entries: list[tuple[str, str]], targets: list[Target], buckets: int) -> list[Target]:
    """The targets with the values around them, among the codes into which their spans are cut."""
    spans = {span: i for i, span in enumerate(dict.fromkeys(t.span for t in targets))}
    parts = []
    for table in dict.fromkeys(entries[entry][0] for entry, _, _ in spans):
        cells, df = [], tables[table]
        for (entry, low, high), i in spans.items():
            if entries[entry][0] == table:
                value = sql_number(entries[entry][1], df.schema[entries[entry][1]].dataType)
                first, last = (f"CAST({sql_text(repr(x))} AS DOUBLE)" for x in (low, high))
                code = f"CAST(LEAST(FLOOR(({value} - {first}) / ({last} - {first}) * {buckets}), {buckets - 1}) AS BIGINT)"
                inside = f"{value} >= {first} AND {value} <= {last}"
                cells.append((f"IF({inside}, {i}, NULL)", f"IF({inside}, {code}, NULL)", f"IF({inside}, {value}, NULL)"))
        parts.append(_cells(df, cells))
    spark = next(iter(tables.values())).sparkSession
    wanted = _table(spark, sorted({(spans[t.span], t.rank) for t in targets}), "span int, rank bigint")
    hit = (F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("n"))
    # One row for each wanted rank, a few per column.
    rows = _counted(parts).join(F.broadcast(wanted), "span").filter(hit).collect()
    at = {(row["span"], row["rank"]): row for row in rows}
    return [
        replace(t, rank=t.rank - row["below"], low=row["low"], high=row["high"])
        for t in targets for row in [at[spans[t.span], t.rank]]
    ]


def iqr_bounds(quartiles: DataFrame) -> DataFrame:
    """``(table, column, q1, q3, present, iqr)``."""
    return (
        quartiles.groupBy("table", "column")
        .agg(
            F.max(F.when(F.col("probability") == 0.25, F.col("value"))).alias("q1"),
            F.max(F.when(F.col("probability") == 0.75, F.col("value"))).alias("q3"),
            F.max("present").alias("present"),
        )
        .withColumn("iqr", F.col("q3") - F.col("q1"))
    )


def outlier_counts(tables: dict[str, DataFrame], bounds: DataFrame) -> DataFrame:
    """``(table, column, outlier_count)`` for every numeric column: values strictly outside
    ``q1 - 1.5 iqr .. q3 + 1.5 iqr``; 0 unless more than 4 values exist and the IQR is positive. One scan a
    table, in which every task sends a single row."""
    # One row per numeric column of the database.
    fences = {
        (r["table"], r["column"]): (r["low"], r["high"])
        for r in bounds.filter("present > 4 AND iqr > 0").selectExpr("`table`", "`column`", "q1 - 1.5 * iqr AS low", "q3 + 1.5 * iqr AS high").collect()
    }
    parts = []
    for table, df in tables.items():
        names = numeric_columns(df)
        if not names:
            continue
        counts, rows = [], []
        for i, column in enumerate(names):
            value = sql_number(column, df.schema[column].dataType)
            low, high = (f"CAST({sql_text(repr(x))} AS DOUBLE)" for x in fences.get((table, column), (0.0, 0.0)))
            counts.append(f"count_if({value} < {low} OR {value} > {high}) AS o{i}" if (table, column) in fences else f"CAST(0 AS BIGINT) AS o{i}")
            rows.append(f"named_struct('table', {sql_text(table)}, 'column', {sql_text(column)}, 'outlier_count', o{i})")
        parts.append(df.selectExpr("count(*) AS every", *counts).selectExpr(f"inline(array({', '.join(rows)}))"))
    return reduce(DataFrame.unionAll, parts)
