"""Nested records to relational tables, following a flattening plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondage.functions.variants import entries, is_nested, is_object, items, member
from sondage.operators.dedup import first_per_key
from sondage.plans.flattening import ChildTable, FlatteningPlan
from sondage.session import scratch_path
from sondage.sources.files import load_tables
from sondage.sources.sinks import remove, replace_all


def main_rows(records: DataFrame, plan: FlatteningPlan, keep: list[str] = (), record: str = "record") -> DataFrame:
    """One row per record: the primary key, then the other scalar fields, all as text. An absent
    field is NULL, a nested value in a scalar's place is JSON text."""
    return records.select(*keep, *[member(record, f, "string").alias(f) for f in plan.main_columns()])


def main_table(records: DataFrame, plan: FlatteningPlan, order: str, record: str = "record") -> DataFrame:
    """``main_rows`` without repeated keys: the first record of a key by ``order`` stays, and so do
    all records without a key."""
    rows = main_rows(records, plan, [F.col(order).alias("_order")], record)
    return first_per_key(rows, F.col(f"`{plan.primary_key}`"), F.col("_order")).drop("_order")


def _member_items(child: ChildTable, record: str) -> Column:
    """Items of a list field that become rows: objects only, or all but nested items."""
    listed = items(member(record, child.source_field))
    if child.kind == "objects":
        return F.filter(listed, is_object)
    return F.filter(listed, lambda item: ~F.coalesce(is_nested(item), F.lit(False)))


def child_rows(records: DataFrame, plan: FlatteningPlan, child: ChildTable, record: str = "record") -> DataFrame:
    """The rows of a child table, led by the key of their record. Rows are made where the record
    is; nothing is moved. ``keyvalue`` tables carry the value as text and, where it is a number,
    as a number too."""
    key = member(record, plan.primary_key, "string").alias(plan.primary_key)
    if child.kind == "keyvalue":
        pairs = records.select(key, F.explode(entries(member(record, child.source_field))).alias("key", "_value"))
        text = F.expr("try_variant_get(_value, '$', 'string')")
        return pairs.select(f"`{plan.primary_key}`", "key", text.alias("value"), text.try_cast("double").alias("value_num"))
    exploded = records.select(key, F.explode(_member_items(child, record)).alias("_item"))
    if child.kind == "values":
        return exploded.select(f"`{plan.primary_key}`", F.expr("try_variant_get(_item, '$', 'string')").alias("value"))
    return exploded.select(
        f"`{plan.primary_key}`",
        *[member("_item", f, "string").alias(f) for f in child.columns(plan.primary_key)[1:]],
    )


def shred(records: DataFrame, plan: FlatteningPlan, order: str, record: str = "record") -> dict[str, DataFrame]:
    """All tables of the plan."""
    tables = {plan.name: main_table(records, plan, order, record)}
    for child in plan.children:
        tables[child.name] = child_rows(records, plan, child, record)
    return tables


def table_row_counts(records: DataFrame, plan: FlatteningPlan, record: str = "record") -> DataFrame:
    """``(table, rows_seen, rows_loaded)`` without building the tables. The two differ for the main
    table only, where repeated keys are seen but not loaded."""
    key = member(record, plan.primary_key, "string")
    sizes = [F.count("*").alias("main")]
    entries_ = [F.struct(F.lit(plan.name).alias("table"), F.col("main").alias("rows_seen"))]
    for i, child in enumerate(plan.children):
        if child.kind == "keyvalue":
            rows = F.size(entries(member(record, child.source_field)))
        else:
            rows = F.size(_member_items(child, record))
        sizes.append(F.coalesce(F.sum(F.greatest(rows, F.lit(0)).cast("bigint")), F.lit(0)).alias(f"child{i}"))
        entries_.append(F.struct(F.lit(child.name).alias("table"), F.col(f"child{i}").alias("rows_seen")))
    seen = records.agg(*sizes).select(F.inline(F.array(*entries_)))
    per_key = records.select(key.alias("key")).groupBy("key").agg(F.count("*").alias("rows"))
    kept = F.sum(F.when(F.col("key").isNull(), F.col("rows")).otherwise(1))
    loaded = per_key.agg(F.coalesce(kept, F.lit(0)).alias("rows_loaded")).scalar()
    return seen.withColumn("rows_loaded", F.when(F.col("table") == plan.name, loaded).otherwise(F.col("rows_seen")))


def parsed_records(records: DataFrame, order: str, record: str = "record") -> tuple[DataFrame, str]:
    """The records in their parsed form, stored so that they are parsed once however many tables and loads are
    made from them, and the folder they lie in."""
    path = scratch_path(records.sparkSession, "parsed")
    records.select(order, record).write.parquet(path)
    return records.sparkSession.read.parquet(path), path


def load_records(
    records: DataFrame, plan: FlatteningPlan, folder: str, order: str, record: str = "record", parsed: bool = False
) -> DataFrame:
    """Replace the tables in ``folder`` by those of the plan, and count what was loaded. The records
    are parsed once: their parsed form is stored, every table is made from it, and it is deleted. Records that
    are read from a stored form of ``parsed_records`` are not stored again."""
    spark, path = records.sparkSession, None
    if not parsed:
        records, path = parsed_records(records, order, record)
    tables = shred(records, plan, order, record)
    replace_all(spark, folder, tables)
    if path is not None:
        remove(spark, path)
    written = load_tables(spark, folder, list(tables))
    counts = [df.agg(F.count("*").alias("rows_loaded")).select(F.lit(t).alias("table"), "rows_loaded") for t, df in written.items()]
    return reduce(DataFrame.unionAll, counts)
