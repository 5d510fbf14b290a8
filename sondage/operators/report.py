"""Roll-ups for the report: checks per table, findings, costs, and the report document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.operators import keys
from sondage.operators.profile import DatabaseProfile

# Price of a million tokens in USD, and EUR per USD.
INPUT_PRICE_PER_1M_USD = 0.15
OUTPUT_PRICE_PER_1M_USD = 0.60
USD_TO_EUR = 0.86


def quality_rollup(table_profile: DataFrame, column_profile: DataFrame) -> DataFrame:
    """One row per table: what was checked and what was found."""
    missing = F.col("null_pct") > 0
    # The first of the columns with the highest share.
    worst = F.max_by(F.when(missing, F.col("column")), F.when(missing, F.struct("null_pct", -F.col("ordinal"))))

    def names(test):
        listed = F.array_sort(F.collect_list(F.when(test, F.struct("ordinal", "column"))))
        return F.array_join(F.transform(listed, lambda s: s["column"]), ", ")

    checks = column_profile.groupBy("table").agg(
        F.count("*").alias("columns_checked"),
        F.count_if(missing).alias("columns_with_nulls"),
        worst.alias("worst_null_column"),
        F.sum("outlier_count").alias("outliers"),
        names(F.col("free_text_pii").isNotNull()).alias("pii_columns"),
        names(F.col("casing_issues") > 0).alias("casing_columns"),
    )
    return table_profile.join(checks, "table").select(
        "table",
        "row_count",
        F.when(F.col("sampled"), F.format_string("%d-row sample", "sample_size")).otherwise("full table").alias("basis"),
        "columns_checked",
        "duplicate_rows",
        "columns_with_nulls",
        F.coalesce("worst_null_column", F.lit("none")).alias("worst_null_column"),
        "outliers",
        F.array_join("pk_candidates", ", ").alias("primary_keys"),
        "pii_columns",
        "casing_columns",
    )


def quality_findings(table_profile: DataFrame, column_profile: DataFrame) -> DataFrame:
    """``(priority, table, column, finding)``: a line per problem. Personal data and inconsistent
    spelling come first, then missing values, duplicate rows and outliers."""
    where = F.concat_ws(".", "table", "column")

    def lines(df: DataFrame, priority: int, test, text) -> DataFrame:
        return df.filter(test).select(F.lit(priority).alias("priority"), "table", "column", text.alias("finding"))

    def said(template: str, *values):
        return F.format_string(template, where, *values)

    pii = column_profile.filter("free_text_pii IS NOT NULL").select(
        "table", "column", F.explode("free_text_pii.entities").alias("entity", "found")
    )
    whole = table_profile.withColumn("column", F.lit(None).cast("string"))
    return (
        lines(pii, 1, F.lit(True), said("%s: possible personal data (%s in %d values)", "entity", F.col("found.count")))
        .unionAll(
            lines(
                column_profile, 2, F.col("casing_issues") > 0,
                said("%s: inconsistent casing or spacing (%d values)", "casing_issues"),
            )
        )
        .unionAll(lines(column_profile, 3, F.col("null_count") > 0, said("%s: %d values missing", "null_count")))
        .unionAll(lines(whole, 4, F.col("duplicate_rows") > 0, said("%s: %d duplicate rows", "duplicate_rows")))
        .unionAll(lines(column_profile, 5, F.col("outlier_count") > 0, said("%s: %d outliers", "outlier_count")))
    )


def call_costs(calls: DataFrame) -> DataFrame:
    """Add ``cost_usd`` to calls with ``prompt_tokens`` and ``completion_tokens``."""
    usd = F.col("prompt_tokens") / 1_000_000 * INPUT_PRICE_PER_1M_USD
    return calls.withColumn("cost_usd", usd + F.col("completion_tokens") / 1_000_000 * OUTPUT_PRICE_PER_1M_USD)


def usage_cost(calls: DataFrame, by: list[str]) -> DataFrame:
    """Calls, tokens and their price per group. Prices are taken of the token sums, so that the
    result does not depend on the order of the rows. The calls themselves, which a run may have any
    number of, are in ``call_costs``."""
    sums = calls.groupBy(*by).agg(
        F.count("*").alias("calls"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
    )
    priced = call_costs(sums)
    return priced.select(
        *by,
        "calls",
        "prompt_tokens",
        "completion_tokens",
        (F.col("prompt_tokens") + F.col("completion_tokens")).alias("total_tokens"),
        F.round("cost_usd", 6).alias("cost_usd"),
        F.round(F.col("cost_usd") * USD_TO_EUR, 6).alias("cost_eur"),
    )


def usage_by_call(calls: DataFrame, by: list[str]) -> DataFrame:
    """Each call with its tokens and price, and the calls, tokens and price of its run beside them."""
    run = usage_cost(calls, by).select(*by, *[F.col(c).alias(f"run_{c}") for c in ("calls", "total_tokens", "cost_usd", "cost_eur")])
    priced = call_costs(calls).withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens"))
    return priced.withColumn("cost_usd", F.round("cost_usd", 6)).join(run, by)


def report_document(profile: DatabaseProfile, kpis: DataFrame, calls: DataFrame | None = None) -> DataFrame:
    """The report as one nested row, ready for ``write_json``. Its lists hold one entry per table,
    key edge, possible fact table, breakdown column, finding or KPI. ``cost`` sums up ``calls`` (with
    ``prompt_tokens`` and ``completion_tokens``), and is all zeros without any."""

    def column(df: DataFrame, name: str, *order: str):
        """All rows as one list, in the given order."""
        listed = F.collect_list(F.struct(F.struct(*order).alias("order"), F.struct(*df.columns).alias("entry")))
        # Compared by the order alone, since entries may hold maps.
        placed = F.array_sort(listed, lambda a, b: F.when(a["order"] < b["order"], -1).when(a["order"] > b["order"], 1).otherwise(0))
        return df.agg(F.transform(placed, lambda e: e["entry"])).scalar().alias(name)

    tables, columns = profile.table_profile, profile.column_profile
    edges = profile.fk_candidates
    breakdowns = keys.breakdown_columns(profile.facts, profile.distincts, profile.cardinality_ratio)
    findings = quality_findings(tables, columns)
    if calls is None:
        calls = kpis.sparkSession.range(0).selectExpr("id AS prompt_tokens", "id AS completion_tokens")
    cost = usage_cost(calls, []).na.fill(0)
    return kpis.sparkSession.range(1).select(
        F.current_timestamp().alias("generated_at"),
        cost.select(F.struct(*cost.columns)).scalar().alias("cost"),
        column(tables, "tables", "table"),
        column(edges, "fk_candidates", *edges.columns),
        column(keys.star_candidates(edges, profile.row_counts), "star_candidates", "place"),
        column(breakdowns, "breakdown_columns", "table", "column"),
        column(findings, "quality_findings", "priority", "table", "column", "finding"),
        column(kpis, "kpis", "name"),
    )
