"""KPI queries: the shapes of business questions asked of a loaded database."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.operators import kpi, report
from sondage.operators.profile import DatabaseProfile
from sondage.queries import profile_sql as sql
from sondage.queries.inputs import run, table, tables, untidy
from sondage.session import scratch_path
from sondage.sources import files, sinks

# Answered alike by Spark and the checking database; breakdowns break ties by their label.
SHARED = {
    "kpi_total_revenue": (
        ("lineitem",), "SELECT round(sum(l_extendedprice + l_tax), 2) AS total_revenue FROM lineitem"
    ),
    "kpi_avg_order_value": (
        ("lineitem",),
        "SELECT round(sum(l_extendedprice) / count(DISTINCT l_orderkey), 4) AS average_order_value FROM lineitem",
    ),
    "kpi_share_rate": (
        ("orders",),
        "SELECT round(CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100, 6) AS finished_rate "
        "FROM orders",
    ),
    "kpi_count_by_category": (
        ("orders",),
        "SELECT priority, count(*) AS order_count FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority "
        "END AS priority FROM orders) AS o GROUP BY priority ORDER BY order_count DESC, priority LIMIT 10",
    ),
    "kpi_orders_by_priority": (
        ("lineitem", "orders"),
        "SELECT o.o_orderpriority, count(DISTINCT o.o_orderkey) AS order_count FROM lineitem l "
        "JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderpriority "
        "ORDER BY order_count DESC, o.o_orderpriority LIMIT 10",
    ),
    "kpi_revenue_by_nation": (
        ("lineitem", "supplier", "nation"),
        "SELECT n.n_name, round(sum(l.l_extendedprice + l.l_tax), 2) AS revenue FROM lineitem l "
        "JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey "
        "GROUP BY n.n_name ORDER BY revenue DESC, n.n_name LIMIT 10",
    ),
    "kpi_row_cap": (
        ("orders",),
        "SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY o_custkey "
        f"ORDER BY spent DESC, o_custkey LIMIT {kpi.MAX_ROWS_PER_KPI}",
    ),
}

QUOTED = (
    "SELECT round(avg(CASE WHEN {q}Paid in full?{q} = 'Yes' THEN CAST(1 AS DOUBLE) ELSE 0 END) * 100, 6) AS paid_rate, "
    "count({q}Day of order{q}) AS orders FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END "
    "AS {q}Paid in full?{q}, o_orderdate AS {q}Day of order{q} FROM orders) AS paid_orders"
)


def _shared(spark, folder, name: str) -> DataFrame:
    names, sql = SHARED[name]
    return run(spark, folder, sql, *names)


def kpi_quoted_columns(spark, folder):
    return run(spark, folder, QUOTED.format(q="`"), "orders")


def kpi_fanout_avg(spark, folder):
    orders = table(spark, folder, "orders").withColumnRenamed("o_custkey", "customer")
    events = table(spark, folder, "events").withColumnRenamed("user_id", "customer")
    found = kpi.fanout_average(orders, events, "customer", "event_type", F.col("o_totalprice"))
    return found.withColumn("average", F.round("average", 4)).orderBy(F.desc("average"), "event_type").limit(10)


# Values with and without units, and words in place of numbers.
CAST_TEXT = """SELECT event_type, CASE event_id % 10 WHEN 0 THEN 'n/a' WHEN 1 THEN concat(CAST(value AS STRING), ' g')
    ELSE CAST(value AS STRING) END AS amount FROM events"""


def kpi_avg_cast(spark, folder):
    amounts = run(spark, folder, CAST_TEXT, "events")
    number = F.col("amount").try_cast("double")
    return amounts.groupBy("event_type").agg(
        F.round(F.avg(number), 6).alias("average"),
        F.round(F.avg(kpi.numeric_prefix(F.col("amount"))), 6).alias("lenient_average"),
    )


BATCH_TABLES = ("orders", "customer", "nation")
BATCH = [
    kpi.Kpi("orders", "SELECT count(*) AS orders FROM orders"),
    kpi.Kpi("orders by status", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10;"),
    kpi.Kpi("customers by segment", "SELECT segment, count(*) AS n FROM customer GROUP BY segment"),
    kpi.Kpi("never repaired", "SELECT nothing_like_it FROM orders"),
    kpi.Kpi("no query"),
    kpi.Kpi("big spenders", "SELECT c_name, sum(o_totalprice) AS spent FROM orders JOIN customer ON o_custkey = c_custkey "
            "GROUP BY c_name ORDER BY spent DESC"),
    kpi.Kpi("by customer", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC LIMIT 10"),
    kpi.Kpi("by day", "SELECT o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey < 0"),
]


def _repair(sql: str, error: str, columns: dict[str, list[str]]) -> str:
    """A stand-in for whoever repairs queries: knows one wrong name."""
    return sql.replace("segment", "c_mktsegment") if "c_mktsegment" not in sql else sql


def kpi_batch(spark, folder):
    results = kpi.run_kpis(spark, tables(spark, folder, BATCH_TABLES), BATCH, repair=_repair)
    frame = kpi.results_frame(spark, results)
    return frame.select("name", "status", "attempts", F.size("rows").cast("bigint").alias("row_count"), "display")


REPORT_TABLES = ("orders", "customer", "nation")
REPORT = [
    kpi.Kpi("orders", "SELECT count(*) AS orders FROM orders"),
    kpi.Kpi("customers by home", "SELECT n_name AS home, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"),
    kpi.Kpi("mean price by status", "SELECT o_orderstatus, avg(o_totalprice) AS mean FROM orders GROUP BY o_orderstatus ORDER BY 1"),
    kpi.Kpi("first days", "SELECT CAST(date_trunc('day', o_orderdate) AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1"),
    kpi.Kpi("by customer", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey"),
    kpi.Kpi("a command", "DROP TABLE IF EXISTS orders"),
]
REPORT_ROWS = 30


def _report(spark, folder):
    """Run, guard and translate, as a report does."""
    results = kpi.run_kpis(spark, tables(spark, folder, REPORT_TABLES), REPORT, max_rows=REPORT_ROWS)
    lookup = run(spark, folder, LOOKUP, "nation")
    return kpi.results_frame(spark, kpi.translate_results(results, lookup, "code", "english", F.col("entry")))


def kpi_report(spark, folder):
    """Every cell of every result as text."""
    frame = _report(spark, folder).select("name", "status", "display", "truncated", F.explode_outer("rows").alias("row"))
    return frame.select("name", "status", "display", "truncated", F.explode_outer("row").alias("field", "shown"))


def kpi_status_counts(spark, folder):
    return kpi.status_counts(_report(spark, folder))


def kpi_guard(spark, folder):
    """The same queries with the labels checked against the profile of their tables."""
    data = tables(spark, folder, BATCH_TABLES)
    guard = kpi.LabelGuard.from_profile(DatabaseProfile(data))
    results = kpi.run_kpis(spark, data, BATCH, guard)
    frame = kpi.results_frame(spark, results)
    reason = F.when(F.col("status") == "skipped", F.regexp_extract("error", r"\((.*)\)", 1))
    return frame.select("name", "status", F.size("rows").cast("bigint").alias("row_count"), reason.alias("reason"))


# Codes with names; one name is empty, one code has an older name too.
LOOKUP = """SELECT n_name AS code, CASE WHEN n_nationkey = 7 THEN '' ELSE concat('Country ', CAST(n_nationkey AS STRING)) END AS english,
        2 AS entry FROM nation
    UNION ALL SELECT n_name AS code, concat('Former ', CAST(n_nationkey AS STRING)) AS english, 1 AS entry FROM nation"""
CODED = "SELECT c.c_custkey, c.c_mktsegment, n.n_name AS home FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"


def translate_values(spark, folder):
    coded = run(spark, folder, CODED, "customer", "nation")
    return kpi.translate_values(coded, run(spark, folder, LOOKUP, "nation"), "code", "english", F.col("entry"))


CALLS = """SELECT conv_id AS run, CASE WHEN role = 'user' THEN CAST(floor(length(text) / 4.0) AS BIGINT) ELSE 0 END AS prompt_tokens,
    CASE WHEN role = 'user' THEN 0 ELSE CAST(floor(length(text) / 4.0) AS BIGINT) END AS completion_tokens FROM conversations"""


def usage_cost_rollup(spark, folder):
    return report.usage_cost(run(spark, folder, CALLS, "conversations"), ["run"])


CALLS_IN_ORDER = CALLS.replace("AS run,", "AS run, turn AS call,")


def usage_by_call(spark, folder):
    """Costs by call and run, added to a run log in two loads and read back."""
    found = report.usage_by_call(run(spark, folder, CALLS_IN_ORDER, "conversations"), ["run"])
    path = scratch_path(spark, "usage")
    for half in (0, 1):
        sinks.append_run_log(found.filter(F.col("run") % 2 == half), path)
    return files.read_json_document(spark, path, found.schema)


def report_document(spark, folder):
    """The report over the untidy tables, its KPIs and the costs of its calls, written as a JSON document, read back
    and laid out line by line."""
    document = report.report_document(DatabaseProfile(untidy(spark, folder)), _report(spark, folder), run(spark, folder, CALLS, "conversations"))
    path = scratch_path(spark, "report")
    sinks.write_json(document, path)
    back = files.read_json_document(spark, path, document.schema)
    lines = {
        "table": ("tables", lambda e: F.format_string("%s: %d rows, %d duplicates, keys %s", e["table"], e["row_count"], e["duplicate_rows"], F.array_join(e["pk_candidates"], ", "))),
        "key": ("fk_candidates", lambda e: F.format_string("%s.%s in %s.%s", e["child_table"], e["child_column"], e["parent_table"], e["parent_column"])),
        "fact table": ("star_candidates", lambda e: F.format_string("%d %s", e["place"], e["table"])),
        "breakdown": ("breakdown_columns", lambda e: F.format_string("%s.%s by %d", e["table"], e["column"], e["distinct_count"])),
        "finding": ("quality_findings", lambda e: F.format_string("%d %s", e["priority"], e["finding"])),
        "kpi": ("kpis", lambda e: F.format_string("%s: %s", e["name"], e["status"])),
    }
    listed = [F.transform(column, lambda e: F.struct(F.lit(part).alias("part"), line(e).alias("line"))) for part, (column, line) in lines.items()]  # noqa: B023
    tokens = F.format_string("%d calls, %d tokens", "cost.calls", "cost.total_tokens")
    cost = F.array(F.struct(F.lit("cost").alias("part"), tokens.alias("line")))
    return back.select(F.inline(F.concat(*listed, cost)))


QUERIES = {name: partial(_shared, name=name) for name in SHARED} | {
    f.__name__: f
    for f in (kpi_quoted_columns, kpi_fanout_avg, kpi_avg_cast, kpi_batch, kpi_report, kpi_status_counts, kpi_guard, translate_values, usage_cost_rollup, usage_by_call, report_document)
}


def _plain(sql: str) -> str:
    return sql.replace("AS STRING", "AS VARCHAR")


ORACLES = {name: sql for name, (_, sql) in SHARED.items()} | {
    "kpi_quoted_columns": QUOTED.format(q='"'),
    "kpi_fanout_avg": """SELECT e.event_type, round(avg(o.o_totalprice), 4) AS average FROM orders o
        JOIN events e ON e.user_id = o.o_custkey GROUP BY e.event_type ORDER BY average DESC, e.event_type LIMIT 10""",
    "kpi_avg_cast": f"""SELECT event_type, round(avg(TRY_CAST(amount AS DOUBLE)), 6) AS average,
        round(avg(coalesce(TRY_CAST(replace(amount, ' g', '') AS DOUBLE), 0)), 6) AS lenient_average
        FROM ({_plain(CAST_TEXT)}) AS a GROUP BY event_type""",
    "kpi_batch": """SELECT * FROM (VALUES
        ('orders', 'ok', 1, 1::BIGINT, 'single value'),
        ('orders by status', 'ok', 1, (SELECT count(DISTINCT o_orderstatus) FROM orders), 'chart'),
        ('customers by segment', 'ok', 2, (SELECT count(DISTINCT c_mktsegment) FROM customer), 'chart'),
        ('never repaired', 'failed', 5, 0, 'failed'),
        ('no query', 'failed', 0, 0, 'failed'),
        ('big spenders', 'ok', 1, (SELECT least(count(DISTINCT o_custkey), 50) FROM orders), 'chart'),
        ('by customer', 'skipped', 1, 0, 'skipped'),
        ('by day', 'ok', 1, 0, 'empty')) AS t(name, status, attempts, row_count, display)""",
    "kpi_report": _plain(f"""WITH homes AS (SELECT coalesce(h.english, n_name) AS home, count(*) AS n FROM customer
            JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT code, arg_max(english, entry) AS english FROM ({LOOKUP}) AS l
                WHERE english <> '' GROUP BY code) AS h ON h.code = n_name GROUP BY 1),
        means AS (SELECT o_orderstatus AS status, round(avg(o_totalprice), 2) AS mean FROM orders GROUP BY 1),
        days AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1 LIMIT {REPORT_ROWS}),
        many AS (SELECT count(DISTINCT CAST(o_orderdate AS DATE)) > {REPORT_ROWS} AS cut FROM orders)
        SELECT 'orders' AS name, 'ok' AS status, 'single value' AS display, false AS truncated, 'orders' AS field,
            CAST(count(*) AS VARCHAR) AS shown FROM orders
        UNION ALL SELECT 'customers by home', 'ok', 'chart', false, unnest(['home', 'n']), unnest([home, CAST(n AS VARCHAR)]) FROM homes
        UNION ALL SELECT 'mean price by status', 'ok', 'chart', false, unnest(['o_orderstatus', 'mean']),
            unnest([status, CAST(mean AS VARCHAR)]) FROM means
        UNION ALL SELECT 'first days', 'ok', 'chart', cut, unnest(['day', 'n']), unnest([CAST(day AS VARCHAR), CAST(n AS VARCHAR)])
            FROM days, many
        UNION ALL SELECT 'by customer', 'skipped', 'skipped', count(DISTINCT o_custkey) > {REPORT_ROWS}, NULL, NULL FROM orders
        UNION ALL SELECT 'a command', 'failed', 'failed', false, NULL, NULL"""),
    "kpi_status_counts": """SELECT * FROM (VALUES ('ok', 4::BIGINT), ('skipped', 1), ('failed', 1)) AS t(status, kpis)
        WHERE EXISTS (SELECT 1 FROM orders)""",
    "kpi_guard": """SELECT * FROM (VALUES
        ('orders', 'ok', 1::BIGINT, NULL),
        ('orders by status', 'ok', (SELECT count(DISTINCT o_orderstatus) FROM orders), NULL),
        ('customers by segment', 'failed', 0, NULL),
        ('never repaired', 'failed', 0, NULL),
        ('no query', 'failed', 0, NULL),
        ('big spenders', 'skipped', 0,
            (SELECT 'distinct in ' || CAST(round(count(DISTINCT c_name) / count(*) * 100) AS INTEGER) || '% of its rows' FROM customer)),
        ('by customer', 'skipped', 0, 'its name marks it as an identifier'),
        ('by day', 'ok', 0, NULL)) AS t(name, status, row_count, reason)""",
    "report_document": sql.with_parts(
        [*sql.TABLE_PARTS, *sql.COLUMN_PARTS, *sql.KEY_PARTS, sql.RATIOS],
        f"""SELECT 'table' AS part, t || ': ' || n || ' rows, ' || duplicate_rows || ' duplicates, keys ' || pk_candidates AS line FROM table_profile
        UNION ALL SELECT 'key', ct || '.' || cc || ' in ' || pt || '.' || pc FROM fks
        UNION ALL SELECT 'fact table', row_number() OVER (ORDER BY dimensions DESC, n DESC, t) || ' ' || t FROM
            (SELECT ct AS t, count(DISTINCT pt) AS dimensions FROM fks GROUP BY ct) AS e JOIN row_counts USING (t)
        UNION ALL SELECT 'breakdown', f.t || '.' || f.c || ' by ' || s.d FROM facts f JOIN sizes s ON s.t = f.t AND s.c = f.c
            LEFT JOIN ratios r ON r.c = f.c
            WHERE NOT regexp_matches(lower(f.c), 'id|code|key|ref') AND s.d BETWEEN 2 AND 50 AND coalesce(r.ratio, 0) < 0.9
        UNION ALL SELECT 'finding', priority || ' ' || finding FROM ({sql.FINDINGS}) AS q
        UNION ALL SELECT 'kpi', unnest(['orders: ok', 'customers by home: ok', 'mean price by status: ok', 'first days: ok',
            'by customer: skipped', 'a command: failed'])
        UNION ALL SELECT 'cost', count(*) || ' calls, ' || CAST(sum(prompt_tokens + completion_tokens) AS BIGINT) || ' tokens' FROM ({CALLS}) AS c""",
    ),
    "translate_values": _plain(f"""SELECT c.c_custkey, coalesce(s.english, c.c_mktsegment) AS c_mktsegment,
        coalesce(h.english, c.home) AS home FROM ({CODED}) AS c
        LEFT JOIN (SELECT code, arg_max(english, entry) AS english FROM ({LOOKUP}) AS a WHERE english <> '' GROUP BY code) AS s
            ON s.code = c.c_mktsegment
        LEFT JOIN (SELECT code, arg_max(english, entry) AS english FROM ({LOOKUP}) AS b WHERE english <> '' GROUP BY code) AS h
            ON h.code = c.home"""),
    "usage_by_call": f"""WITH calls AS ({CALLS_IN_ORDER}), runs AS (SELECT run, count(*) AS run_calls,
            CAST(sum(prompt_tokens + completion_tokens) AS BIGINT) AS run_total_tokens,
            round(sum(prompt_tokens) / 1e6 * 0.15 + sum(completion_tokens) / 1e6 * 0.60, 6) AS run_cost_usd,
            round((sum(prompt_tokens) / 1e6 * 0.15 + sum(completion_tokens) / 1e6 * 0.60) * 0.86, 6) AS run_cost_eur FROM calls GROUP BY run)
        SELECT run, call, prompt_tokens, completion_tokens, round(prompt_tokens / 1e6 * 0.15 + completion_tokens / 1e6 * 0.60, 6) AS cost_usd,
            prompt_tokens + completion_tokens AS total_tokens, run_calls, run_total_tokens, run_cost_usd, run_cost_eur
        FROM calls JOIN runs USING (run)""",
    "usage_cost_rollup": f"""SELECT run, count(*) AS calls, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
        CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens,
        CAST(sum(prompt_tokens + completion_tokens) AS BIGINT) AS total_tokens,
        round(sum(prompt_tokens) / 1e6 * 0.15 + sum(completion_tokens) / 1e6 * 0.60, 6) AS cost_usd,
        round((sum(prompt_tokens) / 1e6 * 0.15 + sum(completion_tokens) / 1e6 * 0.60) * 0.86, 6) AS cost_eur
        FROM ({CALLS}) AS c GROUP BY run""",
}
