"""Work is cut into tasks by rows, however the files are cut."""

import pyspark.sql.functions as F

from sondage import session
from sondage.functions import variants
from sondage.operators import fields, shred
from sondage.queries import io_queries, json_queries


def test_a_single_row_group_of_many_splits_is_spread_over_tasks_by_its_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "SPREAD_ROWS", 1_000, raising=False)
    path = str(tmp_path / "table.parquet")
    spark.range(20_000, numPartitions=1).withColumn("text", F.sha2(F.col("id").cast("string"), 256)).write.parquet(path)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        sizes = session.spread(spark.read.parquet(path)).groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert sum(r["count"] for r in sizes) == 20_000
    assert max(r["count"] for r in sizes) <= 1_500


def test_a_table_is_exported_in_files_of_bounded_rows(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "SPREAD_ROWS", 1_000, raising=False)
    spark.range(9_000, numPartitions=1).selectExpr("id AS n_nationkey", "concat('a', id) AS n_name", "id AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    taken = []
    monkeypatch.setattr(io_queries.sinks, "write_csv", lambda df, path, *rest: taken.append(df) or df.write.option("header", True).csv(path))
    io_queries.QUERIES["csv_roundtrip_nation"](spark, str(tmp_path))
    assert taken[0].rdd.getNumPartitions() >= 9


def test_first_places_of_inner_keys_are_kept_in_hash_tables(spark):
    rows = [(5, '{"id":1,"l":[3,{"b":1},{"a":1,"b":2}]}'), (-2, '{"id":2,"l":[{"z":1},{"c":1},{"y":[1]}]}'), (9, '{"id":3,"l":[{"0":1}]}'), (4, '{"id":4,"l":{"no":1}}')]
    for kind in ("bigint", "string"):
        records = spark.createDataFrame(rows, "line bigint, value string").selectExpr(f"CAST(line AS {kind}) AS line", "parse_json(value) AS record")
        found = fields.survey(records, order=F.col("line"))
        assert ("SortAggregate" in found._jdf.queryExecution().toString()) == (kind == "string")
        first = {"bigint": ["z", "c", "y", "b", "a", "0"], "string": ["z", "c", "y", "b", "a", "0"]}[kind]
        inner = fields.surveyed_inner(found, True).orderBy("place").collect()
        assert [(r["source_field"], r["inner_field"]) for r in inner] == [("l", k) for k in first]
        listed = fields.object_fields(records, "l", F.col("line")).orderBy("place").collect()
        assert [r["inner_field"] for r in listed] == first


def test_two_loads_of_the_same_records_parse_them_once(spark, tmp_path, monkeypatch):
    spark.sql(
        "SELECT id AS o_orderkey, id % 5 AS o_custkey, 'O' AS o_orderstatus, 1.5D AS o_totalprice, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS o_orderdate,"
        " '1-URGENT' AS o_orderpriority FROM range(300)"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    labels = []
    for module in (shred, json_queries):
        real = module.scratch_path
        monkeypatch.setattr(module, "scratch_path", lambda spark, label, real=real: labels.append(label) or real(spark, label))
    loaded = {r[0]: r[1] for r in json_queries.replace_all_load(spark, str(tmp_path)).collect()}
    assert labels.count("parsed") == 1
    counted = {r[0]: r[2] for r in json_queries.flatten_row_counts(spark, str(tmp_path)).collect()}
    assert loaded == counted


def test_the_shape_of_a_value_is_read_once_to_tell_whether_it_is_nested(spark):
    rows = spark.sql("SELECT n, parse_json(v) AS v FROM VALUES (0, '1'), (1, '{}'), (2, '[1]'), (3, '\"ARRAY<\"'), (4, 'null'), (5, '{\"a\":[]}'), (6, NULL) AS t(n, v)")
    found = rows.select("n", variants.is_nested(F.col("v")).alias("nested"))
    assert {r.n: r.nested for r in found.collect()} == {0: False, 1: True, 2: True, 3: False, 4: False, 5: True, 6: None}
    assert found._jdf.queryExecution().analyzed().toString().count("schema_of_variant") == 1
