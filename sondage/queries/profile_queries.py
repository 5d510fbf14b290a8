"""Queries over the profile of the untidy tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.functions.canonical import is_string
from sondage.operators import columns, dedup, keys, occurrence, quantiles, report, sampling, text_scan
from sondage.operators.profile import DatabaseProfile
from sondage.queries import profile_sql as sql
from sondage.queries.inputs import TABLES, run, table, tables, untidy
from sondage.session import durable

RENAMED = {"table": "table_name", "column": "column_name"}


def named(df: DataFrame) -> DataFrame:
    """``table`` and ``column`` are reserved words of SQL."""
    return df.withColumnsRenamed({k: v for k, v in RENAMED.items() if k in df.columns})


def _profile(spark, folder) -> DatabaseProfile:
    return DatabaseProfile(untidy(spark, folder))


def _distincts(data):
    slots = occurrence.assign_slots(data, rows=False)
    return occurrence.slot_distincts(occurrence.signatures(data, slots), slots)


def table_row_counts(spark, folder):
    return named(columns.row_counts(tables(spark, folder)))


def null_stats(spark, folder):
    return named(columns.null_stats(columns.column_facts(untidy(spark, folder))))


def distinct_stats(spark, folder):
    return named(_distincts(untidy(spark, folder)))


def duplicate_rows(spark, folder):
    return named(dedup.duplicate_rows(untidy(spark, folder)))


def iqr_bounds(spark, folder):
    bounds = _profile(spark, folder).iqr_bounds
    return named(bounds.select("table", "column", *[F.round(c, 6).alias(c) for c in ("q1", "q3", "iqr")]))


def iqr_bounds_narrowed(spark, folder):
    """Quartiles found in steps of eight: the many passes that columns of any distribution may need."""
    quartiles = quantiles.exact_quantiles({"lineitem": table(spark, folder, "lineitem")}, buckets=8)
    return named(quantiles.iqr_bounds(quartiles).select("table", "column", *[F.round(c, 6).alias(c) for c in ("q1", "q3", "iqr")]))


# Amounts beyond 2^53 and beyond 64 bits that differ in their last digits alone.
AMOUNTS = """SELECT CAST(l_extendedprice AS DECIMAL(30,2)) + CAST('9007199254740993' AS DECIMAL(30,2)) AS fine,
    CAST(l_orderkey AS DECIMAL(20,0)) + CAST('9223372036854775808' AS DECIMAL(20,0)) AS large,
    CAST(l_quantity AS DECIMAL(10,1)) AS small FROM lineitem"""


def distinct_stats_decimals(spark, folder):
    return named(_distincts({"amounts": run(spark, folder, AMOUNTS, "lineitem")}))


def iqr_outliers(spark, folder):
    return named(_profile(spark, folder).outliers)


def sample_values(spark, folder):
    return named(_profile(spark, folder).samples)


def pk_candidates(spark, folder):
    data = untidy(spark, folder)
    return named(keys.pk_candidates(columns.column_facts(data), _distincts(data)))


def distinct_values(spark, folder):
    return columns.distinct_values(table(spark, folder, "lineitem"), "l_partkey")


def identifier_columns(spark, folder):
    data = untidy(spark, folder)
    hinted = {t: [c for c in df.columns if any(h in c.lower() for h in keys.IDENTIFIER_HINTS)] for t, df in data.items()}
    facts = columns.column_facts({t: data[t].select(*names) for t, names in hinted.items() if names})
    return named(facts.filter(keys.looks_like_identifier(F.col("column"))).select("table", "column", "non_null"))


def fk_candidates(spark, folder):
    return _profile(spark, folder).fk_candidates


def known_key_columns(spark, folder):
    return named(_profile(spark, folder).known_keys)


def cardinality_ratio(spark, folder):
    data = untidy(spark, folder)
    ratios = keys.cardinality_ratio(columns.column_facts(data), _distincts(data))
    return named(ratios.withColumn("ratio", F.round("ratio", 6)))


def star_candidates(spark, folder):
    profile = _profile(spark, folder)
    return named(keys.star_candidates(profile.fk_candidates, profile.row_counts))


def breakdown_columns(spark, folder):
    data = untidy(spark, folder)
    facts, distincts = durable(columns.column_facts(data)), durable(_distincts(data))
    return named(keys.breakdown_columns(facts, distincts, keys.cardinality_ratio(facts, distincts)))


def free_text_columns(spark, folder):
    data = {t: df.select(*[f.name for f in df.schema if is_string(f.dataType)]) for t, df in untidy(spark, folder).items()}
    data = {t: df for t, df in data.items() if df.columns}
    flags = text_scan.free_text_flags(columns.column_facts(data), _distincts(data))
    return named(flags.withColumns({c: F.round(c, 4) for c in ("avg_length", "distinct_ratio")}))


def table_profile(spark, folder):
    profile = _profile(spark, folder).table_profile.drop("sample_size")
    return named(profile.withColumn("pk_candidates", F.array_join("pk_candidates", ", ")))


def _flat_columns(profile: DataFrame) -> DataFrame:
    def hits(entity):
        found = F.try_element_at("free_text_pii.entities", F.lit(entity))
        return F.coalesce(found["count"], F.lit(0))

    return named(
        profile.withColumns(
            {
                "sample_values": F.array_join("sample_values", " | "),
                "emails": hits("EMAIL_ADDRESS"),
                "phones": hits("PHONE_NUMBER"),
            }
        ).drop("free_text_pii")
    )


def column_profile(spark, folder):
    return _flat_columns(_profile(spark, folder).column_profile)


def orders_profile(spark, folder):
    return _flat_columns(DatabaseProfile(tables(spark, folder, ["orders"])).column_profile)


def quality_rollup(spark, folder):
    profile = _profile(spark, folder)
    return named(report.quality_rollup(profile.table_profile, profile.column_profile))


def quality_findings(spark, folder):
    profile = _profile(spark, folder)
    return report.quality_findings(profile.table_profile, profile.column_profile).select("priority", "finding")


# Rows above which the systematic sample of the registered query starts to skip.
SAMPLE_ROWS = 1_000


def systematic_sample(spark, folder):
    orders = table(spark, folder, "orders")
    sample = sampling.systematic_sample(orders, orders.count(), SAMPLE_ROWS)
    return sample.select("position", "o_orderkey", "o_custkey", "o_totalprice")


QUERIES = {
    f.__name__: f
    for f in (
        table_row_counts, null_stats, distinct_stats, duplicate_rows, iqr_bounds, iqr_bounds_narrowed, iqr_outliers, distinct_stats_decimals, sample_values,
        pk_candidates, distinct_values, identifier_columns, fk_candidates, known_key_columns, cardinality_ratio,
        star_candidates, breakdown_columns, free_text_columns, table_profile, column_profile, quality_rollup,
        quality_findings, systematic_sample,
    )
}

_PLAIN_COUNTS = sql.union(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)

ORACLES = {
    "table_row_counts": _PLAIN_COUNTS,
    "null_stats": sql.with_parts(
        [sql.FACTS],
        "SELECT t AS table_name, c AS column_name, n - present AS null_count, "
        "CASE WHEN n > 0 THEN round((n - present) / n * 100, 2) ELSE 0.0 END AS null_pct FROM facts",
    ),
    "distinct_stats": sql.with_parts(
        [sql.FACTS, sql.VALS],
        "SELECT t AS table_name, c AS column_name, coalesce(d, 0) AS distinct_count "
        "FROM facts LEFT JOIN sizes USING (t, c)",
    ),
    "duplicate_rows": sql.with_parts([sql.DUPLICATES], "SELECT t AS table_name, duplicate_rows FROM dups"),
    "iqr_bounds": sql.with_parts(
        [sql.BOUNDS],
        "SELECT t AS table_name, c AS column_name, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr "
        "FROM bounds WHERE present > 0",
    ),
    "iqr_bounds_narrowed": sql.with_parts(
        [sql.BOUNDS],
        "SELECT t AS table_name, c AS column_name, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr "
        "FROM bounds WHERE present > 0 AND t = 'lineitem'",
    ),
    "distinct_stats_decimals": "SELECT 'amounts' AS table_name, unnest(['fine', 'large', 'small']) AS column_name, "
    f"unnest([count(DISTINCT fine), count(DISTINCT large), count(DISTINCT small)]) AS distinct_count FROM ({AMOUNTS}) AS a",
    "iqr_outliers": sql.with_parts(
        [sql.BOUNDS, sql.OUTLIERS], "SELECT t AS table_name, c AS column_name, outlier_count FROM outliers"
    ),
    "sample_values": sql.with_parts(
        [sql.FACTS, sql.VALS, sql.FREE_TEXT, sql.SAMPLES],
        "SELECT t AS table_name, c AS column_name, CAST(place AS INTEGER) AS place, v AS sample FROM samples",
    ),
    "pk_candidates": sql.with_parts(
        [sql.FACTS, sql.VALS, sql.PKS],
        "SELECT t AS table_name, c AS column_name, ordinal, n AS row_count FROM pks",
    ),
    "distinct_values": "SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL",
    "identifier_columns": sql.with_parts(
        [sql.FACTS],
        "SELECT t AS table_name, c AS column_name, present AS non_null FROM facts "
        "WHERE regexp_matches(lower(c), 'id|code|key|ref')",
    ),
    "fk_candidates": sql.with_parts(
        sql.KEY_PARTS,
        "SELECT ct AS child_table, cc AS child_column, pt AS parent_table, pc AS parent_column, "
        "round(overlap * 100, 1) AS value_overlap_pct FROM fks",
    ),
    "known_key_columns": sql.with_parts(
        sql.KEY_PARTS, "SELECT cc AS column_name FROM fks UNION SELECT pc AS column_name FROM fks"
    ),
    "cardinality_ratio": sql.with_parts(
        [sql.FACTS, sql.VALS, sql.RATIOS], "SELECT c AS column_name, round(ratio, 6) AS ratio FROM ratios"
    ),
    "star_candidates": sql.with_parts(
        [*sql.KEY_PARTS, sql.ROWS],
        "SELECT t AS table_name, n AS row_count, dimensions, "
        "CAST(row_number() OVER (ORDER BY dimensions DESC, n DESC, t) AS INTEGER) AS place FROM "
        "(SELECT ct AS t, count(DISTINCT pt) AS dimensions FROM fks GROUP BY ct) AS e JOIN row_counts USING (t)",
    ),
    "breakdown_columns": sql.with_parts(
        [sql.FACTS, sql.VALS, sql.RATIOS],
        "SELECT f.t AS table_name, f.c AS column_name, s.d AS distinct_count FROM facts f "
        "JOIN sizes s ON s.t = f.t AND s.c = f.c LEFT JOIN ratios r ON r.c = f.c "
        "WHERE NOT regexp_matches(lower(f.c), 'id|code|key|ref') AND s.d BETWEEN 2 AND 50 AND coalesce(r.ratio, 0) < 0.9",
    ),
    "free_text_columns": sql.with_parts(
        [sql.FACTS, sql.VALS, sql.FREE_TEXT],
        "SELECT t AS table_name, c AS column_name, round(avg_length, 4) AS avg_length, "
        "round(distinct_ratio, 4) AS distinct_ratio, is_free_text FROM free_text",
    ),
    "table_profile": sql.with_parts(
        sql.TABLE_PARTS,
        "SELECT t AS table_name, n AS row_count, false AS sampled, duplicate_rows, pk_candidates FROM table_profile",
    ),
    "column_profile": sql.with_parts(
        sql.COLUMN_PARTS,
        "SELECT t AS table_name, c AS column_name, ordinal, dtype, n AS row_count, null_count, null_pct, distinct_count, "
        "outlier_count, sample_values, is_free_text, CAST(emails AS BIGINT) AS emails, CAST(phones AS BIGINT) AS phones, "
        "casing_issues FROM column_profile",
    ),
    "quality_rollup": sql.with_parts(
        [*sql.TABLE_PARTS, *sql.COLUMN_PARTS],
        """SELECT p.t AS table_name, p.n AS row_count, 'full table' AS basis, count(*) AS columns_checked,
            p.duplicate_rows, count(*) FILTER (WHERE null_pct > 0) AS columns_with_nulls,
            coalesce((SELECT c FROM column_profile w WHERE w.t = p.t AND w.null_pct > 0
                      ORDER BY null_pct DESC, ordinal LIMIT 1), 'none') AS worst_null_column,
            CAST(sum(outlier_count) AS BIGINT) AS outliers, p.pk_candidates AS primary_keys,
            coalesce(string_agg(c, ', ' ORDER BY ordinal) FILTER (WHERE emails + phones > 0), '') AS pii_columns,
            coalesce(string_agg(c, ', ' ORDER BY ordinal) FILTER (WHERE casing_issues > 0), '') AS casing_columns
        FROM table_profile p JOIN column_profile k ON k.t = p.t
        GROUP BY p.t, p.n, p.duplicate_rows, p.pk_candidates""",
    ),
    "quality_findings": sql.with_parts(
        [*sql.TABLE_PARTS, *sql.COLUMN_PARTS],
        sql.FINDINGS,
    ),
    "systematic_sample": f"""SELECT position, o_orderkey, o_custkey, o_totalprice FROM (
            SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders) AS numbered,
            (SELECT CASE WHEN count(*) > {SAMPLE_ROWS} THEN greatest(count(*) // {SAMPLE_ROWS}, 1) ELSE 1 END AS stride
             FROM orders) AS s
        WHERE position % stride = 0""",
}
