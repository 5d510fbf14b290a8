"""Nothing is lost on the way in: shapes, keys, line breaks, digits; nothing is left behind."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sondage.functions.variants import member
from sondage.operators import fields, kpi, occurrence, shred
from sondage.plans import flattening
from sondage.sources import files, sinks
from sondage.streaming.chunked_load import load_in_chunks


def records(spark, *texts):
    lines = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "line bigint, value string")
    return files.parse_objects(lines)


def test_wide_decimals_are_told_apart(spark):
    values = [Decimal(v) for v in ("9007199254740993.01", "9007199254740993.02", "92233720368547758080.00", "92233720368547758081.00")]
    data = {"t": spark.createDataFrame([(v,) for v in values], "d decimal(30,2)")}
    slots = occurrence.assign_slots(data, rows=False)
    found = occurrence.slot_distincts(occurrence.signatures(data, slots), slots).first()
    assert found["distinct_count"] == 4


def test_decimals_meet_equal_numbers_of_other_types(spark):
    data = {
        "a": spark.sql("SELECT CAST(v AS DECIMAL(10,2)) AS v FROM VALUES (1.50), (2.00), (0.10) AS t(v)"),
        "b": spark.sql("SELECT CAST(v AS DOUBLE) AS v FROM VALUES (1.5), (2), (0.1) AS t(v)"),
        "c": spark.sql("SELECT CAST(v AS DECIMAL(20,5)) AS v FROM VALUES (1.5), (2), (0.1) AS t(v)"),
    }
    slots = occurrence.assign_slots(data, rows=False)
    signatures = occurrence.signatures(data, slots)
    shared = occurrence.slot_overlaps(signatures, slots, slots, slots).collect()
    assert len(shared) == 6 and {r["shared"] for r in shared} == {3}


def test_repeated_keys_need_no_preparation(spark):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    found = records(spark, '{"a":1,"a":2}').select(member("record", "a", "int").alias("a")).collect()
    assert [r["a"] for r in found] == [2]


def test_rejected_lines_are_counted(spark):
    lines = spark.createDataFrame([(t,) for t in ("{}", "", " ", None, "{x", "[1]", "null", '{"a":1}')], "value string")
    assert {r["reason"]: r["lines"] for r in files.rejected_lines(lines).collect()} == {"blank": 3, "malformed": 1, "not an object": 2}


def test_mixed_fields_go_to_main_and_child(spark):
    wide = ",".join(f'"k{i}":{i}' for i in range(30))
    data = records(spark, '{"id":1,"x":"text"}', '{"id":2,"x":[{"a":1}]}', f'{{"id":3,"y":[{{{wide}}}]}}')
    plan = flattening.propose(data, "t", F.col("line"))
    assert plan.fields == ("x",) and {c.source_field: c.kind for c in plan.children} == {"x": "objects", "y": "objects"}
    assert len(plan.children[1].fields) == 30
    tables = shred.shred(data, plan, "line")
    assert [r["x"] for r in tables["t"].orderBy("id").collect()] == ["text", '[{"a":1}]', None]
    assert tables["t_x"].count() == 1
    assert fields.object_fields(data, "y", F.col("line"), limit=7).count() == 7


def test_consensus_keeps_main_fields_and_child_tables(spark):
    rows = [(0, "x", "main"), (1, "x", "objects"), (2, "x", "values"), (2, "y", "main")]
    proposals = spark.createDataFrame(rows, "proposal int, source_field string, kind string")
    assert {tuple(r) for r in flattening.consensus(proposals).collect()} == {("x", "main"), ("x", "objects"), ("y", "main")}


def test_quoted_line_breaks_stay_in_their_values(spark, tmp_path):
    rows = [(1, 'a\nb "c", d'), (2, "\n"), (3, None), (4, " blank ")]
    sinks.write_csv(spark.createDataFrame(rows, "id int, text string").coalesce(1), f"{tmp_path}/in")
    assert load_in_chunks(spark, f"{tmp_path}/in", "id int, text string", f"{tmp_path}/out", f"{tmp_path}/state") == 4
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == rows
    assert sorted(map(tuple, files.read_csv(spark, f"{tmp_path}/in", "id int, text string").collect())) == rows


def test_broken_rows_stop_a_chunked_load(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,text\n1,a\nx,b\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        load_in_chunks(spark, f"{tmp_path}/in", "id int, text string", f"{tmp_path}/out", f"{tmp_path}/state")


def test_words_for_missing_values(spark):
    found = files.without_words(spark.createDataFrame([("N/A", 1), ("x", 2), (None, 3)], "a string, b int")).collect()
    assert [r["a"] for r in found] == [None, "x", None]


def test_a_failed_load_leaves_the_old_tables(spark, tmp_path):
    folder = f"{tmp_path}/db"
    sinks.replace_all(spark, folder, {"old": spark.range(3)})
    broken = spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        sinks.replace_all(spark, folder, {"new": broken})
    assert {t: df.count() for t, df in files.load_tables(spark, folder).items()} == {"old": 3}
    sinks.replace_all(spark, folder, {"new": spark.range(2)})
    assert files.list_tables(spark, folder) == ["new"]


def test_a_load_counts_from_its_marker_on(spark, tmp_path, monkeypatch):
    folder, held = f"{tmp_path}/db", lambda: {t: df.count() for t, df in files.load_tables(spark, folder).items()}
    sinks.write_table(spark.range(7), folder, "plain")
    assert held() == {"plain": 7}
    sinks.replace_all(spark, folder, {"a": spark.range(1), "b": spark.range(2)})
    assert held() == {"a": 1, "b": 2}
    with monkeypatch.context() as broken:
        broken.setattr(sinks, "_commit", lambda *_: (_ for _ in ()).throw(OSError("no marker")))
        with pytest.raises(OSError, match="no marker"):
            sinks.replace_all(spark, folder, {"c": spark.range(3)})
    assert held() == {"a": 1, "b": 2}
    reading = files.load_tables(spark, folder)["b"]
    with monkeypatch.context() as broken:
        broken.setattr(sinks, "remove", lambda *_: (_ for _ in ()).throw(OSError("not deleted")))
        sinks.replace_all(spark, folder, {"c": spark.range(3)})
        with pytest.raises(OSError, match="not deleted"):
            sinks.replace_all(spark, folder, {"d": spark.range(4)})
    assert held() == {"d": 4} and reading.count() == 2
    sinks.write_table(spark.range(2), folder, "d", append=True)
    assert held() == {"d": 6}
    sinks.replace_all(spark, folder, {"e": spark.range(5)})
    assert held() == {"e": 5}
    names = files.list_folder(spark, folder)
    assert len([n for n in names if n.startswith(files.COMMITTED)]) == 2 and "plain.parquet" not in names


def test_a_marker_is_made_once(spark, tmp_path):
    system = sinks._system(spark, str(tmp_path))
    sinks._commit(spark, system, f"{tmp_path}/new/_committed-1")
    with pytest.raises(OSError, match="exists"):
        sinks._commit(spark, system, f"{tmp_path}/new/_committed-1")


def test_microseconds_survive_csv(spark, tmp_path):
    given = spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ'2024-01-01 00:00:07.179575' AS ts, TIMESTAMP'1969-12-31 23:59:59.000001' AS at")
    sinks.write_csv(given, f"{tmp_path}/t.csv")
    assert files.read_csv(spark, f"{tmp_path}/t.csv", given.schema).collect() == given.collect()


@pytest.mark.parametrize("sql", [
    "FROM orders INSERT INTO x SELECT * INSERT INTO y SELECT *", "WITH a AS (SELECT 1) INSERT INTO x SELECT * FROM a", "INSERT INTO x SELECT 1",
    "FROM orders INSERT OVERWRITE TABLE x SELECT * INSERT INTO y SELECT *", "CREATE TABLE x AS SELECT 1", "DROP TABLE x",
    "MERGE INTO x USING y ON x.a = y.a WHEN MATCHED THEN DELETE", "UPDATE x SET a = 1", "DELETE FROM x", "CACHE TABLE x", "SET a = b",
])
def test_statements_that_write_are_refused(spark, sql):
    with pytest.raises(ValueError, match="only queries"):
        kpi._refuse_commands(spark, sql)


@pytest.mark.parametrize("sql", ["SELECT 1", "WITH a AS (SELECT 1 AS x) SELECT * FROM a WHERE x IN (SELECT x FROM a)", "SELECT 1 UNION ALL (SELECT 2)", "FROM orders SELECT *", "VALUES (1)"])
def test_queries_are_let_through(spark, sql):
    kpi._refuse_commands(spark, sql)


def test_kpis_refuse_commands_and_leave_no_views(spark):
    spark.range(7).createOrReplaceTempView("mine")
    data = {"mine": spark.range(3), "other": spark.range(2)}
    kpis = [kpi.Kpi(str(i), s) for i, s in enumerate((
        "SELECT count(*) AS n FROM mine", "DROP VIEW mine", "INSERT INTO other VALUES (1)", "WITH a AS (SELECT 1) SELECT * FROM a",
        "CREATE TEMP VIEW v AS SELECT 1", "SELECT id FROM mine",
    ))]
    results = kpi.run_kpis(spark, data, kpis, max_rows=2)
    assert [r.status for r in results] == ["ok", "failed", "failed", "ok", "failed", "skipped"]
    assert results[0].rows == ((3,),) and [r.truncated for r in results] == [False] * 5 + [True]
    assert spark.table("mine").count() == 7 and not spark.catalog.tableExists("other")
    spark.catalog.dropTempView("mine")
