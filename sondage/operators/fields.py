"""What fields do irregular records hold? Presence, types and inner keys over all records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from sondage.functions.variants import entries, items, member, with_type_name
from sondage.operators.keys import looks_like_identifier
from sondage.session import durable

# Fixed values.
MIN_FIELD_PRESENT_PCT = 5.0


def record_fields(records: DataFrame, keep: list[str] = (), record: str = "record") -> DataFrame:
    """``(*keep, pos, field, value)``: one row per field of each record, and one with NULL field
    for an empty record. ``pos`` is 0 or NULL exactly once per record."""
    shown = ", ".join([*keep, "f.pos", "f.field", "f.value"])
    return records.sparkSession.sql(
        f"SELECT {shown} FROM {{records}}, LATERAL variant_explode_outer({record}) AS f(pos, field, value)",
        records=records.select(*keep, record),
    )


def field_types(records: DataFrame, keep: list[str], record: str = "record") -> DataFrame:
    """``(*keep, field, type)`` for every field of every record."""
    found = record_fields(records, keep, record).filter("field IS NOT NULL")
    return with_type_name(found, "value", "type").select(*keep, "field", "type")


def field_type_counts(records: DataFrame, by: list[str] = (), record: str = "record") -> DataFrame:
    """``(*by, field, type, rows, starts)``; the ``starts`` add up to the number of records. Fields
    and types are merged inside each task, so the shuffle holds one row per kind of field."""
    start = F.col("pos").isNull() | (F.col("pos") == 0)
    typed = with_type_name(record_fields(records, list(by), record), "value", "type")
    return typed.groupBy(*by, "field", "type").agg(F.count("*").alias("rows"), F.count_if(start).alias("starts"))


def catalog_of(counts: DataFrame, by: list[str] = (), min_present_pct: float = 0.0) -> DataFrame:
    """``(*by, field, present_pct, types)`` of the fields present in enough records; all of them by default."""
    by = list(by)
    fields = (
        counts.filter("field IS NOT NULL")
        .groupBy(*by, "field")
        # At most a few type names per field.
        .agg(F.sum("rows").alias("present"), F.array_sort(F.collect_set("type")).alias("types"))
    )
    totals = counts.groupBy(*by).agg(F.greatest(F.sum("starts"), F.lit(1)).alias("total"))
    if by:
        joined = fields.join(totals, by)
        total = F.col("total")
    else:
        joined, total = fields, totals.scalar()
    share = F.col("present") / total * 100
    return joined.withColumn("share", share).filter(F.col("share") >= min_present_pct).select(
        *by, "field", F.round("share", 1).alias("present_pct"), "types"
    )


def field_catalog(records: DataFrame, min_present_pct: float = MIN_FIELD_PRESENT_PCT, record: str = "record") -> DataFrame:
    """``(field, present_pct, types)`` over all records, without fields below ``min_present_pct``. The
    records are parsed once; the counts, a row per field and type, are kept for the totals."""
    return catalog_of(durable(field_type_counts(records, record=record)), (), min_present_pct)


def _start(records: DataFrame, order: Column | None) -> Column:
    """What the place of a record is told by. Whole numbers are scaled so that places in a list fit between
    them (``_spot``): the least number is kept in a hash table, where a struct would have all rows sorted."""
    start = order if order is not None else F.lit(0)
    if not isinstance(records.select(start).schema[0].dataType, IntegralType):
        return start
    return F.coalesce(start.cast("decimal(20,0)"), F.lit(-(1 << 63)).cast("decimal(20,0)")) * F.lit(1 << 31).cast("decimal(10,0)")


def _spot(rows: DataFrame, line: str, item_no: Column) -> Column:
    """Orders records, and items within them; ``line`` is a ``_start``."""
    if isinstance(rows.schema[line].dataType, DecimalType):
        return F.col(line) + item_no.cast("decimal(10,0)")
    return F.struct(F.col(line).alias("line"), item_no.alias("item_no"))


def survey(records: DataFrame, shard: Column | None = None, shards: int = 1, order: Column | None = None, record: str = "record") -> DataFrame:
    """All that a plan is made of, from one parse of the records: ``(kind, field, name, rows, starts, most, seen)``.

    Of ``kind`` ``type`` there is a row per field and type ``name``, of ``inner`` one per field and key ``name``
    of objects in its list, of ``value`` one per scalar field whose name hints at an identifier. ``rows`` and
    ``starts`` count by shard, 0 to ``shards`` - 1; the ``starts`` of all types add up to the records. ``most`` is
    how often the most frequent value of a ``value`` field occurs, ``seen`` the first record (by ``order``) and
    place in the list of an inner key. Each task sends a row per kind and, for the hinted fields, per value."""
    at = F.pmod(shard, F.lit(shards)).cast("int") if shard is not None else F.lit(0)
    marked = records.withColumns({"_shard": at, "_line": _start(records, order)})
    typed = with_type_name(record_fields(marked, ["_shard", "_line"], record), "value", "type")

    none = F.lit(None).cast("string")
    # No record has a place of its own in a list.
    spot = _spot(typed, "_line", F.lit(-1))

    def fact(kind: str, name: Column, value: Column, seen: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), name.alias("name"), value.alias("value"), seen.alias("seen"))

    def inner(item: Column, place: Column) -> Column:
        keys = F.coalesce(F.map_keys(entries(item)), F.array().cast("array<string>"))
        return F.transform(keys, lambda key: fact("inner", key, none, _spot(typed, "_line", place)))

    listed = F.flatten(F.transform(items(F.col("value")), inner))
    hinted = looks_like_identifier(F.col("field")) & F.col("type").isin("bool", "float", "int", "str")
    text = F.col("value").try_cast("string")
    facts = [
        F.array(fact("type", F.col("type"), none, spot)),
        F.when(hinted, F.array(fact("value", none, text, spot))),
        F.when(F.col("type").startswith("list["), listed),
    ]
    found = F.array_compact(F.flatten(F.array_compact(F.array(*facts))))
    started = (F.col("pos").isNull() | (F.col("pos") == 0)) & (F.col("fact.kind") == "type")
    every = typed.select("_shard", "field", "pos", F.explode(found).alias("fact"))

    def by_shard(test: Column, name: str) -> list[Column]:
        return [F.count_if(test & (F.col("_shard") == i)).alias(f"{name}_{i}") for i in range(shards)]

    merged = every.groupBy("fact.kind", "field", "fact.name", "fact.value").agg(
        *by_shard(F.lit(True), "rows"), *by_shard(started, "starts"), F.count("*").alias("all"), F.min("fact.seen").alias("seen")
    )
    return merged.groupBy("kind", "field", "name").agg(
        *(F.array(*(F.sum(f"{c}_{i}") for i in range(shards))).alias(c) for c in ("rows", "starts")),
        F.max("all").alias("most"), F.min("seen").alias("seen"),
    )


def surveyed_types(found: DataFrame, by: str | None = None) -> DataFrame:
    """``(*by, field, type, rows, starts)`` of a survey, over all its shards or for each."""
    each = found.filter("kind = 'type'").select("field", F.col("name").alias("type"), F.posexplode(F.arrays_zip("rows", "starts")).alias("shard", "n"))
    keys = ([F.col("shard").alias(by)] if by else []) + ["field", "type"]
    return each.groupBy(*keys).agg(F.sum("n.rows").alias("rows"), F.sum("n.starts").alias("starts")).filter("rows > 0")


def surveyed_keys(found: DataFrame) -> DataFrame:
    """``(field)``: hinted fields of a survey with distinct values in all records."""
    total = found.filter("kind = 'type'").agg(F.sum(F.aggregate("starts", F.lit(0).cast("bigint"), lambda a, b: a + b))).scalar()
    rows = F.aggregate("rows", F.lit(0).cast("bigint"), lambda a, b: a + b)
    return found.filter("kind = 'value' AND most = 1").filter(rows == total).select("field")


def surveyed_inner(found: DataFrame, ordered: bool) -> DataFrame:
    """``(source_field, inner_field, place)`` of a survey, as ``object_fields`` gives them."""
    uses = F.aggregate("rows", F.lit(0).cast("bigint"), lambda a, b: a + b)
    first = [F.col("seen"), F.col("name")] if ordered else [F.desc(uses), F.col("name")]
    place = F.row_number().over(Window.partitionBy("field").orderBy(*first))
    return found.filter("kind = 'inner'").select(F.col("field").alias("source_field"), F.col("name").alias("inner_field"), place.alias("place"))


def object_fields(
    records: DataFrame, source_field: str | list[str], order: Column | None = None, limit: int | None = None, record: str = "record"
) -> DataFrame:
    """``(source_field, inner_field, place)``: keys of the objects in one or more list fields, over all
    records, found in one pass. They come in first-seen order by ``order`` of the record and place in
    the list (keys of one object by name), or most frequent first when no order is given. All keys are
    given unless there is a ``limit``."""
    start = _start(records, order)
    names = [source_field] if isinstance(source_field, str) else list(source_field)
    lists = [F.struct(F.lit(n).alias("source_field"), items(member(record, n)).alias("listed")) for n in names]
    found = (
        records.select(start.alias("line"), F.inline(F.array(*lists)))
        .select("line", "source_field", F.posexplode("listed").alias("item_no", "item"))
        .select("line", "source_field", "item_no", F.explode(F.map_keys(entries(F.col("item")))).alias("inner_field"))
    )
    seen = F.min(_spot(found, "line", F.col("item_no"))).alias("seen")
    found = found.groupBy("source_field", "inner_field").agg(seen, F.count("*").alias("uses"))
    first = [F.col("seen"), F.col("inner_field")] if order is not None else [F.desc("uses"), F.col("inner_field")]
    place = F.row_number().over(Window.partitionBy("source_field").orderBy(*first))
    placed = found.withColumn("place", place)
    kept = placed if limit is None else placed.filter(F.col("place") <= limit)
    return kept.select("source_field", "inner_field", "place")
