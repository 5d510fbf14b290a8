"""Queries over text columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.functions.text import CARD, EMAIL, IBAN, PHONE, WORD, card_numbers, iban_codes, redact
from sondage.operators import text_scan
from sondage.queries.inputs import run, run_over, table, untidy, untidy_sql
from sondage.queries.profile_queries import named
from sondage.queries.profile_sql import NORMAL, masked, union
from sondage.session import spread

TEXTS = {"documents": ["text", "source"], "pages": ["url", "html"], "conversations": ["text"], "benchmark": ["text"]}
CATEGORIES = {"customer": ["c_name", "c_mktsegment"], "part": ["p_name", "p_brand", "p_type"], "events": ["event_type"]}

# Card-like and account-like numbers made of customer keys: about a tenth and a hundredth of them
# pass the checks.
NUMBERS = """SELECT 'customer' AS source, c_custkey AS id, concat('paid with 4000 0', lpad(CAST(c_custkey % 1000 AS STRING), 3, '0'), '-',
        lpad(CAST(c_custkey AS STRING), 7, '0'), CAST(c_custkey % 10 AS STRING), ' from DE',
        lpad(CAST(c_custkey % 97 + 2 AS STRING), 2, '0'), '37040044', lpad(CAST(c_custkey AS STRING), 10, '0'), '.') AS text
    FROM customer
    UNION ALL SELECT 'documents' AS source, doc_id AS id, text FROM documents"""


def pii_scan_full(spark, folder):
    scans = [
        text_scan.scan_pii(table(spark, folder, t), columns).select(F.lit(t).alias("table"), "*")
        for t, columns in TEXTS.items()
    ]
    return named(reduce(DataFrame.unionAll, scans))


def pii_scan_sample(spark, folder):
    return named(text_scan.scan_pii_sample(table(spark, folder, "documents"), "text", F.col("doc_id")))


def redact_text(spark, folder):
    return table(spark, folder, "documents").select("doc_id", redact(F.col("text")).alias("redacted"))


def casing_variants(spark, folder):
    return named(text_scan.casing_variants_of(untidy(spark, folder, list(CATEGORIES)), CATEGORIES))


def pii_cards_iban(spark, folder):
    texts = run(spark, folder, NUMBERS, "customer", "documents")
    return texts.select(
        "source",
        "id",
        F.size(card_numbers(F.col("text"))).cast("bigint").alias("cards"),
        F.size(iban_codes(F.col("text"))).cast("bigint").alias("ibans"),
    )


# Names of people and places as the tables list them; most have several words (``Customer#000000001`` has two).
NAMES = """SELECT c_name AS name, 'PERSON' AS entity FROM customer
    UNION ALL SELECT s_name AS name, 'PERSON' AS entity FROM supplier
    UNION ALL SELECT concat('Port of ', n_name) AS name, 'LOCATION' AS entity FROM nation
    UNION ALL SELECT r_name AS name, 'LOCATION' AS entity FROM region"""
# Notes in which names are written in other cases and with other marks, or only in part.
NOTES = """SELECT o_orderkey AS id, CASE o_orderstatus
        WHEN 'F' THEN concat('Delivered to customer ', lpad(CAST(o_custkey AS STRING), 9, '0'), '; port-of nation_', CAST(o_custkey % 30 AS STRING))
        WHEN 'O' THEN concat('For CUSTOMER, number ', CAST(o_custkey AS STRING), ', port of call unknown')
        ELSE concat('By supplier: ', lpad(CAST(o_orderkey % 200 AS STRING), 9, '0'), ' via Asia, ', o_orderpriority) END AS note
    FROM orders"""


def pii_names(spark, folder):
    names = run(spark, folder, NAMES, "customer", "supplier", "nation", "region")
    orders = spread(table(spark, folder, "orders"))
    texts = {"orders": (run_over({"orders": orders}, NOTES), ["note"]), **{t: (table(spark, folder, t), columns) for t, columns in TEXTS.items()}}
    scans = [text_scan.scan_name_list(df, columns, names).select(F.lit(t).alias("table"), "*") for t, (df, columns) in texts.items()]
    return named(reduce(DataFrame.unionAll, scans))


QUERIES = {f.__name__: f for f in (pii_scan_full, pii_scan_sample, redact_text, casing_variants, pii_cards_iban, pii_names)}

ENTITY_PATTERNS = (("EMAIL_ADDRESS", EMAIL), ("PHONE_NUMBER", PHONE))


def _hits(source: str, column: str, lead: str = "") -> str:
    counts = union(
        f"SELECT {lead}'{column}' AS column_name, '{entity}' AS entity, "
        f"count(*) FILTER (WHERE regexp_matches({column}, '{pattern}')) AS hits, count({column}) AS scanned FROM {source} AS x"
        for entity, pattern in ENTITY_PATTERNS
    )
    return f"SELECT *, round(hits / scanned * 100, 1) AS pct FROM ({counts}) AS c WHERE hits > 0"


ORACLES = {
    "pii_scan_full": union(_hits(t, c, f"'{t}' AS table_name, ") for t, columns in TEXTS.items() for c in columns),
    "pii_scan_sample": _hits("(SELECT text FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)) LIMIT 200)", "text"),
    "redact_text": f"SELECT doc_id, {masked('text')} AS redacted FROM documents",
    "casing_variants": "SELECT table_name, column_name, normal_form, form, rows FROM (SELECT *, count(*) OVER "
    "(PARTITION BY table_name, column_name, normal_form) AS forms FROM ("
    + union(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, {NORMAL} AS normal_form, v AS form, count(*) AS rows "
        f"FROM (SELECT {c} AS v FROM {untidy_sql(t)} AS x) AS y WHERE v IS NOT NULL GROUP BY v"
        for t, columns in CATEGORIES.items()
        for c in columns
    )
    + ") AS a WHERE normal_form <> '') AS b WHERE forms > 1",
    "pii_names": f"""WITH listed AS MATERIALIZED (SELECT DISTINCT array_to_string(regexp_extract_all(lower(name), '{WORD}'), ' ') AS phrase, entity FROM ({NAMES}) AS l),
        texts AS (SELECT 'orders' AS t, 'note' AS c, note AS v FROM ({NOTES.replace("STRING", "VARCHAR")}) AS n
            UNION ALL {union(f"SELECT '{t}' AS t, '{c}' AS c, {c} AS v FROM {t}" for t, columns in TEXTS.items() for c in columns)}),
        spoken AS MATERIALIZED (SELECT row_number() OVER () AS r, t, c, v, regexp_extract_all(lower(v), '{WORD}') AS w FROM texts),
        runs AS (SELECT DISTINCT r, t, c, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))],
            [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])) AS phrase FROM spoken),
        hits AS (SELECT t, c, entity, count(DISTINCT r) AS hits FROM runs JOIN listed USING (phrase) GROUP BY t, c, entity)
        SELECT t AS table_name, c AS column_name, entity, hits, scanned, round(hits / scanned * 100, 1) AS pct
        FROM hits JOIN (SELECT t, c, count(v) AS scanned FROM spoken GROUP BY t, c) AS s USING (t, c)""",
    "pii_cards_iban": f"""WITH texts AS ({NUMBERS.replace("STRING", "VARCHAR")}),
    cards AS (SELECT source, id, regexp_replace(m, '[^0-9]', '', 'g') AS d FROM
        (SELECT source, id, unnest(regexp_extract_all(text, '{CARD}')) AS m FROM texts) AS a),
    valid_cards AS (SELECT source, id, count(*) AS n FROM cards WHERE list_sum([
        CASE WHEN (length(d) - i) % 2 = 0 THEN CAST(substr(d, i, 1) AS INTEGER)
             WHEN CAST(substr(d, i, 1) AS INTEGER) > 4 THEN CAST(substr(d, i, 1) AS INTEGER) * 2 - 9
             ELSE CAST(substr(d, i, 1) AS INTEGER) * 2 END FOR i IN range(1, length(d) + 1)]) % 10 = 0 GROUP BY source, id),
    codes AS (SELECT source, id, substr(m, 5) || substr(m, 1, 4) AS d FROM
        (SELECT source, id, unnest(regexp_extract_all(text, '{IBAN}')) AS m FROM texts) AS a),
    valid_codes AS (SELECT source, id, count(*) AS n FROM codes WHERE list_reduce(
        [CAST(0 AS BIGINT)] || [CAST(ascii(substr(d, i, 1)) AS BIGINT) FOR i IN range(1, length(d) + 1)],
        lambda acc, x: CASE WHEN x >= 65 THEN (acc * 100 + x - 55) % 97 ELSE (acc * 10 + x - 48) % 97 END) = 1 GROUP BY source, id)
    SELECT t.source, t.id, coalesce(c.n, 0) AS cards, coalesce(k.n, 0) AS ibans FROM texts t
        LEFT JOIN valid_cards c ON c.source = t.source AND c.id = t.id
        LEFT JOIN valid_codes k ON k.source = t.source AND k.id = t.id""",
}
