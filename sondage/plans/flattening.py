"""How nested records become tables: the plan, the rules that propose it, and consensus."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sondage.functions.variants import member
from sondage.operators import fields
from sondage.operators.fields import catalog_of, field_type_counts
from sondage.operators.keys import looks_like_identifier
from sondage.session import durable

KINDS = ("objects", "values", "keyvalue")
SCALARS = ("bool", "float", "int", "null", "str")
# Fixed value: proposals that are merged into one plan.
CONSENSUS_RUNS = 3


@dataclass(frozen=True)
class ChildTable:
    name: str
    source_field: str
    kind: str
    fields: tuple[str, ...] = ()

    def columns(self, key: str) -> list[str]:
        """The foreign key first, then what the kind of the field calls for."""
        if self.kind == "values":
            return [key, "value"]
        if self.kind == "keyvalue":
            return [key, "key", "value", "value_num"]
        return [key, *_unique(self.fields, key)]


@dataclass(frozen=True)
class FlatteningPlan:
    name: str
    primary_key: str
    fields: tuple[str, ...]
    children: tuple[ChildTable, ...] = ()

    def main_columns(self) -> list[str]:
        return [self.primary_key, *_unique(self.fields, self.primary_key)]


def _unique(names, exclude: str) -> list[str]:
    return [n for n in dict.fromkeys(names) if n and n != exclude]


def table_kinds(catalog: DataFrame, by: list[str] = ()) -> DataFrame:
    """``(*by, source_field, kind)``: where each field of a catalog belongs. Scalars go to the main
    table (``main``), lists that start with objects become ``objects``, other lists ``values`` and
    objects ``keyvalue``. A field that was seen both as a scalar and as a list or object gets a row for
    either; of lists and objects it takes the richest."""

    def some(test):
        return F.exists("types", test)

    child = (
        F.when(some(lambda t: t == "list[object]"), "objects")
        .when(some(lambda t: t.startswith("list[")), "values")
        .when(some(lambda t: t == "object"), "keyvalue")
    )
    main = F.when(child.isNull() | some(lambda t: t.isin(*SCALARS) & (t != "null")), "main")
    kinds = F.array_compact(F.array(main, child))
    return catalog.select(*by, F.col("field").alias("source_field"), F.explode(kinds).alias("kind"))


def key_candidates(records: DataFrame, names: list[str], record: str = "record") -> DataFrame:
    """``(field, is_key)``: whether a field is present in all records with distinct values. All
    candidate fields are checked in one pass."""
    cells = [F.struct(F.lit(n).alias("field"), member(record, n, "string").alias("value")) for n in names]
    values = records.select(F.inline(F.array(*cells))).groupBy("field", "value").agg(F.count("*").alias("rows"))
    most = F.max(F.when(F.col("value").isNull(), F.lit(2)).otherwise(F.col("rows")))
    return values.groupBy("field").agg((most == 1).alias("is_key"))


def choose_key(records: DataFrame, found: DataFrame, record: str = "record") -> str:
    """The first identifier-named scalar field (by name) that is a key, which the survey tells; failing that,
    any scalar field that is one, which takes a second look at the records."""
    hinted = fields.surveyed_keys(found).orderBy("field").first()
    if hinted is not None:
        return hinted["field"]
    scalars = F.forall("types", lambda t: t.isin(*SCALARS))
    always = catalog_of(fields.surveyed_types(found)).filter(scalars & (F.col("present_pct") >= 100))
    names = [r["field"] for r in always.filter(~looks_like_identifier(F.col("field"))).orderBy("field").collect()]
    if names:
        first = key_candidates(records, names, record).filter("is_key").orderBy("field").first()
        if first is not None:
            return first["field"]
    raise ValueError("no field is present in all records with distinct values")


def propose(records: DataFrame, name: str, order=None, record: str = "record") -> FlatteningPlan:
    """A plan by rule from one pass over the records. Only field names reach the driver."""
    found = durable(fields.survey(records, order=order, record=record))
    kinds = table_kinds(catalog_of(fields.surveyed_types(found)))
    return _plan_from(kinds, name, choose_key(records, found, record), found, order)


def proposals_by_shard(records: DataFrame, shard, runs: int = CONSENSUS_RUNS, record: str = "record") -> DataFrame:
    """``(proposal, source_field, kind)``: one rule-based proposal per shard of the records, all
    from one pass. ``shard`` numbers the shards from 0."""
    sharded = records.withColumn("proposal", F.pmod(shard, F.lit(runs)).cast("int"))
    counts = field_type_counts(sharded, ["proposal"], record)
    return table_kinds(catalog_of(counts, ["proposal"]), ["proposal"])


def consensus(proposals: DataFrame) -> DataFrame:
    """``(source_field, kind)``: the union of all proposals. Main fields of any proposal are main fields;
    of a field's child tables the one of the first proposal that has one stays."""
    place = F.row_number().over(Window.partitionBy("source_field", F.col("kind") == "main").orderBy("proposal"))
    return proposals.withColumn("place", place).filter("place = 1").select("source_field", "kind")


def propose_by_consensus(records: DataFrame, name: str, shard, order=None, runs: int = CONSENSUS_RUNS, record: str = "record") -> FlatteningPlan:
    """The plan on which proposals by shard agree; they, the key and the inner keys come from the same pass."""
    found = durable(fields.survey(records, shard, runs, order, record))
    catalog = catalog_of(fields.surveyed_types(found, "proposal"), ["proposal"])
    kinds = consensus(table_kinds(catalog, ["proposal"]))
    return _plan_from(kinds, name, choose_key(records, found, record), found, order)


def _plan_from(kinds: DataFrame, name: str, key: str, found: DataFrame, order) -> FlatteningPlan:
    # One row per field and place, then one per inner field.
    rows = kinds.orderBy("source_field").collect()
    main = tuple(r["source_field"] for r in rows if r["kind"] == "main" and r["source_field"] != key)
    inner: dict[str, list[str]] = {r["source_field"]: [] for r in rows if r["kind"] == "objects"}
    if inner:
        for i in fields.surveyed_inner(found, order is not None).orderBy("source_field", "place").collect():
            if i["source_field"] in inner:
                inner[i["source_field"]].append(i["inner_field"])
    children = tuple(
        ChildTable(f"{name}_{r['source_field']}", r["source_field"], r["kind"], tuple(inner.get(r["source_field"], ())))
        for r in rows if r["kind"] != "main"
    )
    return FlatteningPlan(name, key, main, children)


def plan_rows(spark, plan: FlatteningPlan) -> DataFrame:
    """``(table, source_field, kind)``, one row per field that the plan uses."""
    rows = [(plan.name, plan.primary_key, "key")]
    rows += [(plan.name, f, "main") for f in plan.main_columns()[1:]]
    rows += [(c.name, c.source_field, c.kind) for c in plan.children]
    entries = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, ("table", "source_field", "kind"))]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*entries)))
