"""Which columns does each distinct value occur in?

One shuffle of the distinct values of a whole database answers every question about distinct
counts, duplicate rows and shared keys. Each value is reduced to a bit set of the columns that
hold it; counting equal bit sets leaves a small table (a *signature* table) from which distinct
counts and the overlap of any two columns are sums. No join of values and no list per value is
needed, and a value that fills a third of the rows is merged before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, DoubleType, FloatType, IntegralType, TimestampNTZType, TimestampType

from sondage.functions.canonical import quoted, row_digest, value_key

BITS_PER_WORD = 62
#: Types whose ``value_key`` has no text.
TEXTLESS = (IntegralType, BooleanType, DoubleType, FloatType, DateType, TimestampType, TimestampNTZType)
ROW_FIRST, ROW_SECOND = "_row_first", "_row_second"


@dataclass(frozen=True)
class Slot:
    """One bit: a column of a table, or the whole row of it when ``column`` is None. Slots are
    numbered from 0 without gaps."""

    index: int
    table: str
    column: str | None

    @property
    def word(self) -> str:
        return f"word{self.index // BITS_PER_WORD}"

    @property
    def bit(self) -> int:
        return 1 << (self.index % BITS_PER_WORD)

    @property
    def present(self) -> str:
        return f"({self.word} & {self.bit}L) <> 0"


def assign_slots(tables: dict[str, DataFrame], columns: bool = True, rows: bool = True) -> list[Slot]:
    names = []
    for table, df in tables.items():
        if columns:
            names += [(table, c) for c in df.columns]
        if rows:
            names.append((table, None))
    return [Slot(i, table, column) for i, (table, column) in enumerate(names)]


def _word_names(slots: list[Slot]) -> list[str]:
    return sorted({s.word for s in slots}, key=lambda w: int(w[4:]))


KEY = ("family", "whole", "frac", "text")


def _table_values(df: DataFrame, slots: list[Slot], words: list[str], key_names: tuple[str, ...] = KEY) -> DataFrame:
    """Every (slot, value) pair of columns of one table, expanded inside the scan stage."""
    types = {f.name: f.dataType for f in df.schema.fields}
    projected, entries = [], []
    for slot in slots:
        cells = {name: cell for name, cell in zip(KEY, value_key(slot.column, types[slot.column]), strict=True) if name in key_names}
        cells |= {w: f"{slot.bit if w == slot.word else 0}L" for w in words}
        names = [f"s{slot.index}_{name}" for name in cells]
        projected += [f"{cell} AS {name}" for cell, name in zip(cells.values(), names)]
        entries.append("(" + ", ".join(names) + ")")
    wide = df.selectExpr(*projected)
    output = ", ".join([*key_names, *words])
    return wide.sparkSession.sql(
        f"SELECT {output} FROM {{wide}} UNPIVOT INCLUDE NULLS "
        f"(({output}) FOR slot IN ({', '.join(entries)})) WHERE family IS NOT NULL",
        wide=wide,
    )


def _table_rows(df: DataFrame, slot: Slot, words: list[str]) -> DataFrame:
    """The digest of every row of one table; rows meet nothing but rows of their own table."""
    bits = [F.lit(slot.bit if w == slot.word else 0).cast("bigint").alias(w) for w in words]
    return df.select(*bits, *[d.alias(n) for d, n in zip(row_digest([(quoted(f.name), f.dataType) for f in df.schema.fields]), (ROW_FIRST, ROW_SECOND), strict=True)])


def signatures(tables: dict[str, DataFrame], slots: list[Slot]) -> DataFrame:
    """``(word0, word1, ..., values)``: how many distinct values occur in exactly those slots."""
    words = _word_names(slots)
    types = {(t, f.name): f.dataType for t, df in tables.items() for f in df.schema.fields}
    # Numbers and times are told by two numbers and can meet no text: without one in their key they are merged in
    # quick hash tables. Decimals may be told by their digits and yet meet whole numbers; then all stay together.
    apart = not any(isinstance(types.get((s.table, s.column)), DecimalType) for s in slots)
    kinds: dict[tuple[str, ...], list[Slot]] = {KEY: [], KEY[:3]: []}
    for slot in slots:
        if slot.column is None:
            continue
        kind = types.get((slot.table, slot.column))
        kinds[KEY[:3] if apart and isinstance(kind, TEXTLESS) else KEY].append(slot)
    found = []
    for names, own in kinds.items():
        parts = []
        for table, df in tables.items():
            mine = [s for s in own if s.table == table]
            if mine:
                parts.append(_table_values(df, mine, words, names))
        if parts:
            merged = reduce(DataFrame.unionAll, parts).groupBy(*names).agg(*[F.bit_or(w).alias(w) for w in words])
            found.append(merged.groupBy(*words).agg(F.count("*").alias("values")))
    whole = [_table_rows(tables[s.table], s, words) for s in slots if s.column is None]
    if whole:
        found.append(reduce(DataFrame.unionAll, whole).distinct().groupBy(*words).agg(F.count("*").alias("values")))
    return reduce(DataFrame.unionAll, found).groupBy(*words).agg(F.sum("values").alias("values"))


def _present_slots(slots: list[Slot]) -> Column:
    return F.expr("ARRAY_COMPACT(ARRAY(" + ", ".join(f"IF({s.present}, {s.index}, NULL)" for s in slots) + "))")


def _named(df: DataFrame, slots: list[Slot], index: str, table: str, column: str) -> DataFrame:
    """Replace a slot index by its table and column name."""

    def text(value: str | None) -> Column:
        return F.lit(value).cast("string")

    tables = F.array(*[text(s.table) for s in slots])
    columns = F.array(*[text(s.column) for s in slots])
    place = F.col(index) + 1
    return df.withColumns({table: F.element_at(tables, place), column: F.element_at(columns, place)})


def slot_distincts(sigs: DataFrame, slots: list[Slot]) -> DataFrame:
    """``(table, column, distinct_count)``; ``column`` is NULL for whole rows.

    Slots that hold no value at all are reported with a count of 0.
    """
    counts = (
        sigs.select(F.explode(_present_slots(slots)).alias("slot"), "values")
        .groupBy("slot")
        .agg(F.sum("values").alias("distinct_count"))
    )
    every = sigs.sparkSession.range(len(slots)).select(F.col("id").cast("int").alias("slot"))
    joined = every.join(counts, "slot", "left").fillna(0, ["distinct_count"])
    return _named(joined, slots, "slot", "table", "column").select("table", "column", "distinct_count")


def slot_overlaps(sigs: DataFrame, slots: list[Slot], children: list[Slot], parents: list[Slot]) -> DataFrame:
    """``(child_table, child_column, parent_table, parent_column, shared)`` for column pairs of
    different tables that share at least one value. Pairs are formed per signature, not per
    value, so their number depends on how many signatures there are; few columns should be parents."""
    pairs = (
        sigs.select(_present_slots(children).alias("kids"), _present_slots(parents).alias("olds"), "values")
        .select(F.explode("kids").alias("child"), "olds", "values")
        .select("child", F.explode("olds").alias("parent"), "values")
        .groupBy("child", "parent")
        .agg(F.sum("values").alias("shared"))
    )
    named = _named(pairs, slots, "child", "child_table", "child_column")
    named = _named(named, slots, "parent", "parent_table", "parent_column")
    return named.filter("child_table <> parent_table").select(
        "child_table", "child_column", "parent_table", "parent_column", "shared"
    )
