"""Primary keys, foreign keys and identifier-like columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sondage.operators.occurrence import Slot, slot_overlaps

# Fixed values.
IDENTIFIER_HINTS = ("id", "code", "key", "ref")
FK_OVERLAP_THRESHOLD = 0.9
IDENTIFIER_CARDINALITY_THRESHOLD = 0.9
MIN_ROWS_FOR_CARDINALITY_SIGNAL = 100


def looks_like_identifier(name: Column) -> Column:
    return F.lower(name).rlike("|".join(IDENTIFIER_HINTS))


def pk_candidates(facts: DataFrame, distincts: DataFrame) -> DataFrame:
    """``(table, column, ordinal, row_count)`` of columns that are unique and never null."""
    joined = facts.join(distincts.filter("column IS NOT NULL"), ["table", "column"])
    unique = joined.filter("row_count > 0 AND non_null = row_count AND distinct_count = row_count")
    return unique.select("table", "column", "ordinal", "row_count")


def fk_candidates(
    sigs: DataFrame,
    slots: list[Slot],
    distincts: DataFrame,
    keys: DataFrame,
    pii_columns: DataFrame | None = None,
    threshold: float = FK_OVERLAP_THRESHOLD,
) -> DataFrame:
    """``(child_table, child_column, parent_table, parent_column, value_overlap_pct)``.

    A child is an identifier-named column without personal data, a parent a primary key candidate
    of another table; the edge stands when enough of the child's distinct values are parent keys.
    """
    columns = [s for s in slots if s.column is not None]
    hinted = [s for s in columns if any(h in s.column.lower() for h in IDENTIFIER_HINTS)]
    # Keys, sizes and risky columns have one row per column at most.
    confirmed = {(r["table"], r["column"]) for r in keys.select("table", "column").collect()}
    shared = slot_overlaps(sigs, slots, hinted, [s for s in columns if (s.table, s.column) in confirmed] or columns)
    sizes = distincts.selectExpr("`table` AS child_table", "column AS child_column", "distinct_count AS child_values")
    parents = keys.selectExpr("`table` AS parent_table", "column AS parent_column")
    edges = shared.join(F.broadcast(parents), ["parent_table", "parent_column"], "left_semi")
    if pii_columns is not None:
        risky = pii_columns.selectExpr("`table` AS child_table", "column AS child_column")
        edges = edges.join(F.broadcast(risky), ["child_table", "child_column"], "left_anti")
    share = F.col("shared") / F.col("child_values")
    return (
        edges.join(F.broadcast(sizes), ["child_table", "child_column"])
        .filter(share >= threshold)
        .select(
            "child_table",
            "child_column",
            "parent_table",
            "parent_column",
            F.round(share * 100, 1).alias("value_overlap_pct"),
        )
    )


def known_key_columns(edges: DataFrame) -> DataFrame:
    """Names on either side of a foreign key edge."""
    sides = edges.select(F.explode(F.array("child_column", "parent_column")).alias("column"))
    return sides.distinct()


def cardinality_ratio(facts: DataFrame, distincts: DataFrame) -> DataFrame:
    """``(column, ratio)``: the highest share of distinct values of any column of that name, among
    tables large enough for the share to mean something."""
    joined = facts.filter(F.col("row_count") >= MIN_ROWS_FOR_CARDINALITY_SIGNAL).join(
        distincts.filter("column IS NOT NULL"), ["table", "column"]
    )
    return joined.groupBy("column").agg(F.max(F.col("distinct_count") / F.col("row_count")).alias("ratio"))


def star_candidates(edges: DataFrame, counts: DataFrame) -> DataFrame:
    """``(table, row_count, dimensions, place)``: tables ranked as fact tables, by the number of
    other tables they refer to, then by size, then by name."""
    referring = edges.groupBy(F.col("child_table").alias("table")).agg(F.count_distinct("parent_table").alias("dimensions"))
    ranked = referring.join(counts, "table")
    # One row per table of the database.
    order = Window.orderBy(F.desc("dimensions"), F.desc("row_count"), "table")
    return ranked.select("table", "row_count", "dimensions", F.row_number().over(order).alias("place"))


def breakdown_columns(facts: DataFrame, distincts: DataFrame, ratios: DataFrame, max_values: int = 50) -> DataFrame:
    """``(table, column, distinct_count)`` of columns whose values read well as chart labels: not
    named like an identifier, more than one value but a modest number, not almost all distinct."""
    joined = facts.join(distincts.filter("column IS NOT NULL"), ["table", "column"]).join(ratios, "column", "left")
    modest = F.col("distinct_count").between(2, max_values)
    readable = ~looks_like_identifier(F.col("column"))
    repeated = F.coalesce(F.col("ratio"), F.lit(0.0)) < IDENTIFIER_CARDINALITY_THRESHOLD
    return joined.filter(readable & modest & repeated).select("table", "column", "distinct_count")
