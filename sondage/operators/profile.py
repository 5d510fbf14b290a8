"""The profile of a whole database, assembled from few passes over its tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.functions.canonical import quoted
from sondage.functions.text import DEFAULT_ENTITIES, redact
from sondage.operators import columns, keys, occurrence, quantiles, text_scan
from sondage.session import durable, prepare


@dataclass
class DatabaseProfile:
    """Everything known about a set of tables.

    The facts of all columns come from one scan per table, all distinct counts, duplicate rows and
    key overlaps from one shuffle of the distinct values. Both results hold a row per column (or
    per combination of columns) and are checkpointed, so that what follows never returns to the
    tables for them.
    """

    tables: dict[str, DataFrame]
    pii_sample: int | None = None
    entities: tuple[str, ...] = DEFAULT_ENTITIES
    slots: list = field(init=False)

    def __post_init__(self):
        prepare(next(iter(self.tables.values())).sparkSession)
        self.slots = occurrence.assign_slots(self.tables)

    def _together(self, *names: str) -> None:
        """Compute independent parts at the same time, so that the cluster works on one while
        another waits for its last tasks."""
        spark = next(iter(self.tables.values())).sparkSession
        with ThreadPoolExecutor(len(names)) as pool:
            parts = [pool.submit(inheritable_thread_target(spark)(getattr), self, name) for name in names]
        for part in parts:
            part.result()

    @cached_property
    def facts(self) -> DataFrame:
        return durable(columns.column_facts(self.tables))

    @cached_property
    def signatures(self) -> DataFrame:
        return durable(occurrence.signatures(self.tables, self.slots))

    @cached_property
    def all_distincts(self) -> DataFrame:
        return durable(occurrence.slot_distincts(self.signatures, self.slots))

    @cached_property
    def distincts(self) -> DataFrame:
        return self.all_distincts.filter("column IS NOT NULL")

    @cached_property
    def row_counts(self) -> DataFrame:
        return self.facts.groupBy("table").agg(F.max("row_count").alias("row_count"))

    @cached_property
    def duplicates(self) -> DataFrame:
        """``(table, duplicate_rows)``."""
        kinds = self.all_distincts.filter("column IS NULL").select("table", "distinct_count")
        return self.row_counts.join(kinds, "table").select(
            "table", (F.col("row_count") - F.col("distinct_count")).alias("duplicate_rows")
        )

    @cached_property
    def quartiles(self) -> DataFrame | None:
        return quantiles.exact_quantiles(self.tables)

    @cached_property
    def iqr_bounds(self) -> DataFrame | None:
        return None if self.quartiles is None else durable(quantiles.iqr_bounds(self.quartiles))

    @cached_property
    def outliers(self) -> DataFrame | None:
        """None when no table holds a numeric value."""
        if self.iqr_bounds is None:
            return None
        return quantiles.outlier_counts(self.tables, self.iqr_bounds)

    @cached_property
    def pk_candidates(self) -> DataFrame:
        self._together("facts", "signatures")
        return keys.pk_candidates(self.facts, self.distincts)

    @cached_property
    def free_text(self) -> DataFrame:
        self._together("facts", "signatures")
        return durable(text_scan.free_text_flags(self.facts, self.distincts))

    @cached_property
    def _text_columns(self) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
        """Names of the free-text and of the categorical text columns of each table."""
        free: dict[str, list[str]] = {t: [] for t in self.tables}
        other: dict[str, list[str]] = {t: [] for t in self.tables}
        for row in self.free_text.select("table", "column", "is_free_text").collect():
            (free if row["is_free_text"] else other)[row["table"]].append(row["column"])
        return free, other

    @cached_property
    def pii(self) -> DataFrame | None:
        """``(table, column, entity, hits, scanned, pct)`` of the free-text columns."""
        parts = []
        for table, names in self._text_columns[0].items():
            df = self.tables[table]
            if not names:
                continue
            if self.pii_sample is None:
                scans = [text_scan.scan_pii(df, names, self.entities)]
            else:
                # Rows are drawn by all that they hold, so that copies of one text are drawn one by one.
                key = F.to_json(F.struct(*map(quoted, df.columns)))
                scans = [text_scan.scan_pii_sample(df, c, key, self.pii_sample, self.entities) for c in names]
            parts += [s.select(F.lit(table).alias("table"), "*") for s in scans]
        return durable(reduce(DataFrame.unionAll, parts)) if parts else None

    @cached_property
    def casing(self) -> DataFrame | None:
        """``(table, column, normal_form, form, rows)`` of the categorical text columns."""
        found = text_scan.casing_variants_of(self.tables, self._text_columns[1])
        return None if found is None else durable(found)

    @cached_property
    def samples(self) -> DataFrame:
        """``(table, column, place, sample)``; samples of free text are redacted."""
        parts = [columns.smallest_values(t, df) for t, df in self.tables.items()]
        found = reduce(DataFrame.unionAll, parts)
        flags = self.free_text.filter("is_free_text").select("table", "column", F.lit(True).alias("hide"))
        shown = F.when(F.coalesce("hide", F.lit(False)), redact(F.col("sample"))).otherwise(F.col("sample"))
        return durable(
            found.join(F.broadcast(flags), ["table", "column"], "left").select(
                "table", "column", "place", shown.alias("sample")
            )
        )

    @cached_property
    def fk_candidates(self) -> DataFrame:
        risky = None if self.pii is None else self.pii.select("table", "column").distinct()
        return durable(
            keys.fk_candidates(self.signatures, self.slots, self.distincts, self.pk_candidates, risky)
        )

    @cached_property
    def known_keys(self) -> DataFrame:
        return keys.known_key_columns(self.fk_candidates)

    @cached_property
    def cardinality_ratio(self) -> DataFrame:
        return keys.cardinality_ratio(self.facts, self.distincts)

    @cached_property
    def table_profile(self) -> DataFrame:
        """``(table, row_count, sampled, sample_size, duplicate_rows, pk_candidates)``. Statistics
        are exact, so ``sampled`` is always false."""
        named = self.pk_candidates.groupBy("table").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "column"))), lambda k: k["column"]).alias(
                "pk_candidates"
            )
        )
        return (
            self.row_counts.join(self.duplicates, "table")
            .join(named, "table", "left")
            .select(
                "table",
                "row_count",
                F.lit(False).alias("sampled"),
                F.lit(None).cast("bigint").alias("sample_size"),
                "duplicate_rows",
                F.coalesce("pk_candidates", F.array().cast("array<string>")).alias("pk_candidates"),
            )
        )

    @cached_property
    def column_profile(self) -> DataFrame:
        """One row per column. Lists in it are short by nature: at most three samples and one entry
        per PII entity; the spelling variants themselves are in ``casing``."""
        key = ["table", "column"]
        _ = self._text_columns
        self._together("iqr_bounds", "pii", "casing", "samples")
        profile = (
            self.facts.join(columns.null_stats(self.facts), key)
            .join(self.distincts, key, "left")
            .join(self.free_text.select(*key, "is_free_text"), key, "left")
            .join(
                self.samples.groupBy(*key).agg(
                    F.transform(F.array_sort(F.collect_list(F.struct("place", "sample"))), lambda s: s["sample"]).alias(
                        "sample_values"
                    )
                ),
                key,
                "left",
            )
        )
        if self.outliers is not None:
            profile = profile.join(self.outliers, key, "left")
        else:
            profile = profile.withColumn("outlier_count", F.lit(0).cast("bigint"))
        if self.pii is not None:
            entry = F.struct(F.col("hits").alias("count"), "pct")
            entities = self.pii.groupBy(*key).agg(
                F.struct(
                    F.max("scanned").alias("sample_size"),
                    F.map_from_entries(F.array_sort(F.collect_list(F.struct("entity", entry.alias("found"))))).alias("entities"),
                ).alias("free_text_pii")
            )
            profile = profile.join(entities, key, "left")
        else:
            empty = "struct<sample_size: bigint, entities: map<string, struct<count: bigint, pct: double>>>"
            profile = profile.withColumn("free_text_pii", F.lit(None).cast(empty))
        if self.casing is not None:
            groups = self.casing.groupBy(*key).agg(F.count_distinct("normal_form").alias("casing_issues"))
            profile = profile.join(groups, key, "left")
        else:
            profile = profile.withColumn("casing_issues", F.lit(0).cast("bigint"))
        return profile.select(
            *key,
            "ordinal",
            "dtype",
            "row_count",
            "null_count",
            "null_pct",
            F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"),
            F.coalesce("outlier_count", F.lit(0)).alias("outlier_count"),
            F.coalesce("sample_values", F.array().cast("array<string>")).alias("sample_values"),
            F.coalesce("is_free_text", F.lit(False)).alias("is_free_text"),
            "free_text_pii",
            F.coalesce("casing_issues", F.lit(0)).alias("casing_issues"),
        )
