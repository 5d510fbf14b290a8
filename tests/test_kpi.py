import pytest
from pyspark.sql import functions as F

from sondage.operators import kpi, report
from sondage.operators.profile import DatabaseProfile
from sondage.sources import files, sinks


@pytest.fixture(scope="module")
def tables(spark):
    sales = spark.range(200).select(
        F.col("id").alias("sale_id"), (F.col("id") % 4).alias("shop"), F.concat(F.lit("sku"), "id").alias("sku"),
        F.when(F.col("id") % 2 == 0, "pt_a").otherwise("pt_b").alias("category"), (F.col("id") / 3).alias("price"),
    )
    return {"sales": sales}


def run(spark, tables, sql, **options):
    return kpi.run_kpis(spark, tables, [kpi.Kpi("k", sql)], **options)[0]


def test_rows_are_capped(spark, tables):
    result = run(spark, tables, "SELECT price FROM sales")
    assert result.status == "ok" and len(result.rows) == kpi.MAX_ROWS_PER_KPI and result.display == "chart"


def test_errors_stay_with_their_query(spark, tables):
    batch = [kpi.Kpi("bad", "SELECT nope FROM sales"), kpi.Kpi("run time", "SELECT raise_error('stop') FROM sales"), kpi.Kpi("good", "SELECT count(*) AS n FROM sales"), kpi.Kpi()]
    results = kpi.run_kpis(spark, tables, batch)
    assert [r.status for r in results] == ["failed", "failed", "ok", "failed"]
    assert [r.attempts for r in results] == [1, 1, 1, 0] and "nope" in results[0].error and "stop" in results[1].error
    assert results[2].rows == ((200,),) and results[2].display == "single value"
    assert results[3].kpi.name == "Unnamed KPI"


def test_repair_gets_error_and_columns(spark, tables):
    seen = []

    def repair(sql, error, columns):
        seen.append((sql, columns["sales"]))
        return sql.replace("nope", "nada") if len(seen) == 1 else "SELECT max(price) AS p FROM sales"

    result = run(spark, tables, "SELECT nope FROM sales", repair=repair)
    assert result.status == "ok" and result.attempts == 3 and len(result.attempt_errors) == 2
    assert seen[0][1] == ["sale_id", "shop", "sku", "category", "price"] and "nada" in seen[1][0]


def test_repair_gives_up(spark, tables):
    result = run(spark, tables, "SELECT nope FROM sales", repair=lambda sql, error, columns: sql)
    assert result.status == "failed" and result.attempts == 5 and len(result.attempt_errors) == 5


def test_guard(spark, tables):
    guard = kpi.LabelGuard(frozenset({"shop"}), {"sku": 0.95, "category": 0.1})
    reasons = {
        "sale_id": "its name marks it as an identifier", "shop": "another table refers to it as a key",
        "sku": "distinct in 95% of its rows", "category": None,
    }
    for column, reason in reasons.items():
        result = run(spark, tables, f"SELECT {column}, count(*) AS n FROM sales GROUP BY 1", guard=guard)
        assert result.status == ("skipped" if reason else "ok")
        if reason:
            assert f"'{column}'" in result.error and f"({reason})" in result.error and result.rows == () and result.attempts == 1
    # One row is never withheld, nor is an alias.
    assert run(spark, tables, "SELECT max(sale_id) AS sale_id FROM sales", guard=guard).status == "ok"
    assert run(spark, tables, "SELECT sku AS label, 1 AS n FROM sales", guard=guard).status == "ok"


def test_guard_from_profile(tables):
    guard = kpi.LabelGuard.from_profile(DatabaseProfile(tables))
    assert guard.ratios["sku"] == 1.0 and guard.objection("category") is None


def test_translation(spark, tables):
    lookup = spark.createDataFrame([("pt_a", "Older", 1), ("pt_a", "Apples", 2), ("pt_b", "", 1), (None, "x", 1)], "code string, english string, n int")
    results = kpi.run_kpis(spark, tables, [kpi.Kpi("k", "SELECT category, count(*) AS n FROM sales GROUP BY 1 ORDER BY 1")])
    translated = kpi.translate_results(results, lookup, "code", "english", F.col("n"))
    assert translated[0].rows == (("Apples", 100), ("pt_b", 100))
    assert kpi.translate_results(results, None, "code", "english") == results
    whole = kpi.translate_values(tables["sales"], lookup, "code", "english", F.col("n"))
    assert whole.columns == tables["sales"].columns
    assert {tuple(r) for r in whole.groupBy("category").count().collect()} == {("Apples", 100), ("pt_b", 100)}


def test_results_frame(spark, tables):
    results = kpi.run_kpis(spark, tables, [kpi.Kpi("k", "SELECT category, avg(price) AS p, max(NULL) AS x FROM sales GROUP BY 1 ORDER BY 1")])
    row = kpi.results_frame(spark, results).first()
    assert row["columns"] == ["category", "p", "x"] and row["rows"][0] == {"category": "pt_a", "p": "33.0", "x": None}
    assert kpi.status_counts(kpi.results_frame(spark, results)).first()["kpis"] == 1


def test_fanout_average_equals_the_join(spark):
    left = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0), (3, None), (4, 9.0)], "k int, v double")
    right = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, "b"), (5, "c"), (3, "d")], "k int, label string")
    joined = left.join(right, "k").groupBy("label").agg(F.avg("v").alias("average"))
    found = kpi.fanout_average(left, right, "k", "label", F.col("v"))
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in joined.collect()}


@pytest.mark.parametrize("text, number", [("12.5 g", 12.5), ("abc", 0.0), (" -3e2x", -300.0), (".5", 0.5), ("", 0.0), (None, None), ("7", 7.0)])
def test_numeric_prefix(spark, text, number):
    assert spark.createDataFrame([(text,)], "t string").select(kpi.numeric_prefix(F.col("t"))).first()[0] == number


def test_usage_cost(spark):
    calls = spark.createDataFrame([("r", 5000, 800), ("r", 505, 44)], "run string, prompt_tokens bigint, completion_tokens bigint")
    row = report.usage_cost(calls, ["run"]).first()
    assert tuple(row) == ("r", 2, 5505, 844, 6349, 0.001332, 0.001146)


def test_report_document(spark, tables, tmp_path):
    profile = DatabaseProfile(tables)
    results = kpi.results_frame(spark, kpi.run_kpis(spark, tables, [kpi.Kpi("k", "SELECT count(*) AS n FROM sales")]))
    sinks.write_json(report.report_document(profile, results), str(tmp_path / "report"))
    back = files.read_json_document(spark, str(tmp_path / "report")).first()
    assert back["tables"][0]["row_count"] == 200 and back["kpis"][0]["status"] == "ok" and back["generated_at"]


def test_quality_rollup(spark):
    df = spark.createDataFrame([(1, None, "A"), (2, None, "a"), (2, 1.0, "a"), (2, 1.0, "a")], "n int, x double, s string")
    profile = DatabaseProfile({"t": df})
    row = report.quality_rollup(profile.table_profile, profile.column_profile).first()
    assert row["basis"] == "full table" and row["worst_null_column"] == "x" and row["casing_columns"] == "s"
    assert row["duplicate_rows"] == 1 and row["primary_keys"] == "" and row["columns_checked"] == 3
    lines = [r["finding"] for r in report.quality_findings(profile.table_profile, profile.column_profile).orderBy("priority").collect()]
    assert lines == ["t.s: inconsistent casing or spacing (1 values)", "t.x: 2 values missing", "t: 1 duplicate rows"]
