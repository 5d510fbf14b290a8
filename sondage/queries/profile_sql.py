"""SQL for the profile of the untidy tables, written out column by column."""

from __future__ import annotations

from sondage.functions.text import EMAIL, PHONE
from sondage.queries.inputs import COLUMNS, TABLES, untidy_sql

NUMBERS = ("int", "bigint", "double")


def each_column(kinds=None):
    for name in TABLES:
        for place, (column, kind) in enumerate(COLUMNS[name].items(), start=1):
            if kinds is None or kind in kinds:
                yield name, column, kind, place


def present(column: str, kind: str) -> str:
    """The value, NULL where it is missing or NaN."""
    return f"CASE WHEN isnan({column}) THEN NULL ELSE {column} END" if kind == "double" else column


def _text(column: str, kind: str) -> str:
    if kind == "double":
        value = present(column, kind)
        return f"CASE WHEN {value} = round({value}) THEN CAST(CAST({value} AS BIGINT) AS VARCHAR) ELSE CAST({value} AS VARCHAR) END"
    return f"CAST({column} AS VARCHAR)"


def _family(kind: str) -> str:
    return "num" if kind in NUMBERS else "str" if kind == "string" else kind


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


ROWS = "row_counts AS (" + union(
    f"SELECT '{t}' AS t, count(*) AS n FROM {untidy_sql(t)} AS x" for t in TABLES
) + ")"

# Distinct values of every column, as text within a family of comparable types.
VALS = "vals AS MATERIALIZED (" + union(
    f"SELECT DISTINCT '{t}' AS t, '{c}' AS c, '{_family(k)}' AS f, {_text(c, k)} AS v FROM {untidy_sql(t)} AS x "
    f"WHERE {present(c, k)} IS NOT NULL"
    for t, c, k, _ in each_column()
) + "), sizes AS MATERIALIZED (SELECT t, c, count(*) AS d FROM vals GROUP BY t, c)"

FACTS = "facts AS MATERIALIZED (" + union(
    f"SELECT '{t}' AS t, '{c}' AS c, {p} AS ordinal, '{k}' AS dtype, count(*) AS n, "
    f"count({present(c, k)}) AS present, "
    + (f"sum(length({c}))" if k == "string" else "CAST(NULL AS BIGINT)")
    + f" AS chars FROM {untidy_sql(t)} AS x"
    for t, c, k, p in each_column()
) + ")"

DUPLICATES = "dups AS MATERIALIZED (" + union(
    f"SELECT '{t}' AS t, (SELECT count(*) FROM {untidy_sql(t)} AS x) - "
    f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {untidy_sql(t)} AS y) AS z) AS duplicate_rows"
    for t in TABLES
) + ")"

PKS = "pks AS MATERIALIZED (SELECT t, c, ordinal, n FROM facts JOIN sizes USING (t, c) WHERE n > 0 AND present = n AND d = n)"

BOUNDS = "bounds AS MATERIALIZED (" + union(
    f"SELECT '{t}' AS t, '{c}' AS c, quantile_cont(CAST({present(c, k)} AS DOUBLE), 0.25) AS q1, "
    f"quantile_cont(CAST({present(c, k)} AS DOUBLE), 0.75) AS q3, count({present(c, k)}) AS present "
    f"FROM {untidy_sql(t)} AS x"
    for t, c, k, _ in each_column(NUMBERS)
) + ")"

OUTLIERS = "outliers AS MATERIALIZED (" + union(
    f"SELECT '{t}' AS t, '{c}' AS c, (SELECT count(*) FROM {untidy_sql(t)} AS x, "
    f"(SELECT * FROM bounds WHERE t = '{t}' AND c = '{c}') AS b WHERE b.present > 4 AND b.q3 > b.q1 AND "
    f"({present(c, k)} < b.q1 - 1.5 * (b.q3 - b.q1) OR {present(c, k)} > b.q3 + 1.5 * (b.q3 - b.q1))) AS outlier_count"
    for t, c, k, _ in each_column(NUMBERS)
) + ")"


def masked(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '{EMAIL}', '<EMAIL_ADDRESS>', 'g'), '{PHONE}', '<PHONE_NUMBER>', 'g')"


FREE_TEXT = (
    "free_text AS MATERIALIZED (SELECT t, c, CAST(chars AS DOUBLE) / present AS avg_length, CAST(d AS DOUBLE) / present AS distinct_ratio, "
    "CAST(chars AS DOUBLE) / present >= 40 AND CAST(d AS DOUBLE) / present >= 0.5 AS is_free_text "
    "FROM facts JOIN sizes USING (t, c) WHERE dtype = 'string' AND present > 0)"
)

SAMPLES = "raw_samples AS MATERIALIZED (" + union(
    f"SELECT * FROM (SELECT '{t}' AS t, '{c}' AS c, row_number() OVER (ORDER BY v) AS place, CAST(v AS VARCHAR) AS v "
    f"FROM (SELECT DISTINCT {present(c, k)} AS v FROM {untidy_sql(t)} AS x) AS y WHERE v IS NOT NULL) AS z WHERE place <= 3"
    for t, c, k, _ in each_column()
    if k != "array<float>"
) + f"""), samples AS (SELECT r.t, r.c, r.place,
    CASE WHEN coalesce(f.is_free_text, false) THEN {masked('r.v')} ELSE r.v END AS v
    FROM raw_samples r LEFT JOIN free_text f ON r.t = f.t AND r.c = f.c)"""

PII = "pii_all AS MATERIALIZED (" + union(
    f"SELECT '{t}' AS t, '{c}' AS c, '{entity}' AS entity, "
    f"count(*) FILTER (WHERE regexp_matches({c}, '{pattern}')) AS hits, count({c}) AS scanned FROM {untidy_sql(t)} AS x"
    for t, c, k, _ in each_column(("string",))
    for entity, pattern in (("EMAIL_ADDRESS", EMAIL), ("PHONE_NUMBER", PHONE))
) + "), pii AS (SELECT p.* FROM pii_all p JOIN free_text f ON p.t = f.t AND p.c = f.c AND f.is_free_text WHERE hits > 0)"

NORMAL = r"trim(regexp_replace(lower(v), '\s+', ' ', 'g'))"
CASING = "casing AS MATERIALIZED (SELECT t, c, norm, form, n FROM (SELECT *, count(*) OVER (PARTITION BY t, c, norm) AS forms FROM (" + union(
    f"SELECT '{t}' AS t, '{c}' AS c, {NORMAL} AS norm, v AS form, count(*) AS n FROM "
    f"(SELECT {c} AS v FROM {untidy_sql(t)} AS x) AS y WHERE v IS NOT NULL GROUP BY 3, 4"
    for t, c, k, _ in each_column(("string",))
) + """) AS z WHERE norm <> '') AS w WHERE forms > 1 AND NOT EXISTS
    (SELECT 1 FROM free_text f WHERE f.t = w.t AND f.c = w.c AND f.is_free_text))"""

FKS = """children AS (SELECT v.* FROM vals v LEFT JOIN (SELECT DISTINCT t, c FROM pii) p ON v.t = p.t AND v.c = p.c
        WHERE regexp_matches(lower(v.c), 'id|code|key|ref') AND p.t IS NULL),
    parents AS (SELECT v.* FROM vals v JOIN pks k ON v.t = k.t AND v.c = k.c),
    edges AS (SELECT a.t AS ct, a.c AS cc, b.t AS pt, b.c AS pc, count(*) AS shared
        FROM children a JOIN parents b ON a.f = b.f AND a.v = b.v AND a.t <> b.t GROUP BY a.t, a.c, b.t, b.c),
    fks AS (SELECT ct, cc, pt, pc, CAST(shared AS DOUBLE) / d AS overlap FROM edges
        JOIN sizes ON sizes.t = ct AND sizes.c = cc WHERE CAST(shared AS DOUBLE) / d >= 0.9)"""

RATIOS = """ratios AS MATERIALIZED (SELECT c, max(CAST(d AS DOUBLE) / n) AS ratio FROM facts JOIN sizes USING (t, c)
    WHERE n >= 100 GROUP BY c)"""

TABLE_PROFILE = """table_profile AS MATERIALIZED (SELECT r.t, r.n, d.duplicate_rows,
        coalesce((SELECT string_agg(c, ', ' ORDER BY ordinal) FROM pks WHERE pks.t = r.t), '') AS pk_candidates
    FROM row_counts r JOIN dups d ON d.t = r.t)"""

COLUMN_PROFILE = """column_profile AS MATERIALIZED (SELECT f.t, f.c, f.ordinal, f.dtype, f.n, f.n - f.present AS null_count,
        CASE WHEN f.n > 0 THEN round((f.n - f.present) / f.n * 100, 2) ELSE 0.0 END AS null_pct,
        coalesce(s.d, 0) AS distinct_count, coalesce(o.outlier_count, 0) AS outlier_count,
        coalesce((SELECT string_agg(v, ' | ' ORDER BY place) FROM samples p WHERE p.t = f.t AND p.c = f.c), '') AS sample_values,
        coalesce(ft.is_free_text, false) AS is_free_text,
        coalesce((SELECT sum(hits) FROM pii WHERE pii.t = f.t AND pii.c = f.c AND entity = 'EMAIL_ADDRESS'), 0) AS emails,
        coalesce((SELECT sum(hits) FROM pii WHERE pii.t = f.t AND pii.c = f.c AND entity = 'PHONE_NUMBER'), 0) AS phones,
        (SELECT count(DISTINCT norm) FROM casing k WHERE k.t = f.t AND k.c = f.c) AS casing_issues
    FROM facts f LEFT JOIN sizes s ON s.t = f.t AND s.c = f.c
        LEFT JOIN outliers o ON o.t = f.t AND o.c = f.c
        LEFT JOIN free_text ft ON ft.t = f.t AND ft.c = f.c)"""

FINDINGS = """SELECT 1 AS priority, t || '.' || c || ': possible personal data (' || entity || ' in ' || hits || ' values)' AS finding
        FROM pii
    UNION ALL SELECT 2, t || '.' || c || ': inconsistent casing or spacing (' || casing_issues || ' values)'
        FROM column_profile WHERE casing_issues > 0
    UNION ALL SELECT 3, t || '.' || c || ': ' || null_count || ' values missing' FROM column_profile WHERE null_count > 0
    UNION ALL SELECT 4, t || ': ' || duplicate_rows || ' duplicate rows' FROM table_profile WHERE duplicate_rows > 0
    UNION ALL SELECT 5, t || '.' || c || ': ' || outlier_count || ' outliers' FROM column_profile WHERE outlier_count > 0"""

KEY_PARTS = (FACTS, VALS, PKS, FREE_TEXT, PII, FKS)
COLUMN_PARTS = (FACTS, VALS, BOUNDS, OUTLIERS, FREE_TEXT, SAMPLES, PII, CASING, COLUMN_PROFILE)
TABLE_PARTS = (ROWS, DUPLICATES, FACTS, VALS, PKS, TABLE_PROFILE)


def with_parts(parts, select: str) -> str:
    return "WITH " + ",\n".join(dict.fromkeys(parts)) + "\n" + select
