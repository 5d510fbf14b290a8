import json

import pytest
from pyspark.sql import functions as F

from sondage.operators import fields, sampling, shred
from sondage.plans import flattening
from sondage.plans.flattening import ChildTable, FlatteningPlan
from sondage.sources import files

RECORD = {
    "a": 1, "b": [1, "x", None], "c": {"z": 1, "y": 2.5}, "d": [{"q": 1}, 3], "e": True, "f": None, "g": 1.5, "h": "s",
    "it's": 4, "dot.k": [], "n": [[1], {"a": 1}], "big": 123456789012345678901, "l": [3, {"q": 1}],
}


@pytest.fixture(scope="module")
def records(spark):
    lines = [
        (1, "  " + json.dumps(RECORD)), (2, "{bad"), (3, "[1,2]"), (4, ""), (5, "null"), (6, "3"), (7, "{}"),
        (8, '{"a":8,"a":9,"d":[3,{"q":1,"r":{"t":1}}],"h":{"in":[1]}}'), (9, '{"a":9,"h":"later"}'), (10, '{"h":null}'),
    ]
    return files.parse_objects(spark.createDataFrame(lines, "line bigint, value string"))


def test_only_objects_are_records(records):
    assert [r["line"] for r in records.orderBy("line").select("line").collect()] == [1, 7, 8, 9, 10]


def test_type_names(records):
    found = {r["field"]: r["type"] for r in fields.field_types(records.filter("line = 1"), ["line"]).collect()}
    assert found == {
        "a": "int", "b": "list[int|null|str]", "c": "object", "d": "list[object]", "e": "bool", "f": "null", "g": "float",
        "h": "str", "it's": "int", "dot.k": "list[empty]", "n": "list[dict|list]", "big": "int", "l": "list[dict|int]",
    }


def test_catalog(records):
    found = {r["field"]: (r["present_pct"], r["types"]) for r in fields.field_catalog(records, 25.0).collect()}
    assert found == {
        "a": (60.0, ["int"]), "h": (80.0, ["null", "object", "str"]), "d": (40.0, ["list[dict|int]", "list[object]"])
    }


def test_catalog_cuts_on_the_unrounded_share(spark):
    lines = spark.range(1000).select(
        F.concat(F.lit('{"id":'), "id", F.when(F.col("id") < 50, ',"at":1').otherwise(""),
                 F.when(F.col("id") < 49, ',"below":1').otherwise(""), F.lit("}")).alias("value")
    )
    found = {r["field"] for r in fields.field_catalog(files.parse_objects(lines)).collect()}
    assert found == {"id", "at"}


def test_catalog_of_nothing(spark):
    empty = files.parse_objects(spark.createDataFrame([("",)], "value string"))
    assert fields.field_catalog(empty).count() == 0


def test_inner_fields_in_first_seen_order(spark):
    lines = [(1, '{"x":[3]}'), (2, '{"x":[{"m":1},{"b":1,"a":1}]}'), (3, '{"x":[{"c":1}],"y":{}}'), (4, '{"x":"text"}')]
    data = files.parse_objects(spark.createDataFrame(lines, "line bigint, value string"))
    found = fields.object_fields(data, "x", F.col("line")).orderBy("place").collect()
    assert [r["inner_field"] for r in found] == ["m", "a", "b", "c"]
    assert fields.object_fields(data, "x", F.col("line"), limit=2).count() == 2


def test_shredding(records):
    plan = FlatteningPlan(
        "m", "a", ("h", "e", "a", "h", "it's", "missing"),
        (ChildTable("m_d", "d", "objects", ("q", "r")), ChildTable("m_b", "b", "values"), ChildTable("m_c", "c", "keyvalue"),
         ChildTable("m_n", "n", "values"), ChildTable("m_h", "h", "values")),
    )
    tables = shred.shred(records, plan, "line")
    assert tables["m"].columns == ["a", "h", "e", "it's", "missing"]

    def rows(name):
        return sorted((tuple(r) for r in tables[name].collect()), key=repr)

    # The second record with key 9 is ignored; both records without a key stay.
    assert rows("m") == sorted(
        [("1", "s", "true", "4", None), ("9", '{"in":[1]}', None, None, None), (None,) * 5, (None,) * 5], key=repr
    )
    assert rows("m_d") == [("1", "1", None), ("9", "1", '{"t":1}')]
    assert rows("m_b") == sorted([("1", "1"), ("1", "x"), ("1", None)], key=repr)
    assert rows("m_c") == [("1", "y", "2.5", 2.5), ("1", "z", "1", 1.0)]
    assert rows("m_n") == [] and rows("m_h") == []
    counts = {r["table"]: (r["rows_seen"], r["rows_loaded"]) for r in shred.table_row_counts(records, plan).collect()}
    assert counts == {"m": (5, 4), "m_d": (2, 2), "m_b": (3, 3), "m_c": (2, 2), "m_n": (0, 0), "m_h": (0, 0)}


def test_load_replaces_everything(records, spark, tmp_path):
    target = str(tmp_path / "db")
    one = FlatteningPlan("old", "a", ("h",), (ChildTable("old_b", "b", "values"),))
    two = FlatteningPlan("new", "a", ("h",))
    shred.load_records(records, one, target, "line").collect()
    assert files.list_tables(spark, target) == ["old", "old_b"]
    found = shred.load_records(records, two, target, "line").collect()
    assert files.list_tables(spark, target) == ["new"] and [tuple(r) for r in found] == [("new", 4)]


def test_proposed_plan(spark):
    lines = [
        json.dumps({"name": f"n{i % 3}", "my_code": f"k{i}", "zip_code": i % 2, "serial": i, "parts": [{"x": 1}, 2], "tags": ["t"], "props": {"p": i}})
        for i in range(10)
    ]
    data = files.parse_objects(spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "line bigint, value string"))
    plan = flattening.propose(data, "thing", F.col("line"))
    assert plan.primary_key == "my_code" and plan.fields == ("name", "serial", "zip_code")
    assert {(c.source_field, c.kind, c.fields) for c in plan.children} == {
        ("parts", "objects", ("x",)), ("tags", "values", ()), ("props", "keyvalue", ())
    }
    assert flattening.plan_rows(spark, plan).count() == 7


def test_survey_says_what_separate_passes_say(spark, records):
    found = fields.survey(records, F.col("line"), 3, F.col("line"))
    assert found._jdf.queryExecution().executedPlan().toString().count("parseJson") == 1
    found = found.cache()
    counts = fields.field_type_counts(records)
    assert sorted(map(str, fields.surveyed_types(found).collect())) == sorted(map(str, counts.filter("rows > 0").collect()))
    sharded = fields.field_type_counts(records.withColumn("p", (F.col("line") % 3).cast("int")), ["p"])
    assert sorted(map(str, fields.surveyed_types(found, "p").collect())) == sorted(map(str, sharded.collect()))
    lists = ["b", "d", "dot.k", "l", "n"]
    for order in (F.col("line"), None):
        inner = fields.surveyed_inner(fields.survey(records, order=order), order is not None)
        expected = fields.object_fields(records, lists, order)
        assert sorted(map(tuple, inner.collect())) == sorted(map(tuple, expected.collect()))
    found.unpersist()


def test_keys_of_a_survey(spark):
    def plan(rows):
        return flattening.propose(files.parse_objects(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")), "t").primary_key

    assert plan([{"b_id": 1, "a_id": "1", "n": 1}, {"b_id": "1", "a_id": "2", "n": 2}]) == "a_id"
    assert plan([{"id": 1, "a_id": None, "n": 1}, {"id": 2, "a_id": 2, "n": 2}]) == "id"
    # A hinted field that is missing once, null once or repeated is no key; one without a hint may be.
    assert plan([{"id": 1, "n": 1}, {"n": 2}]) == plan([{"id": 1, "n": 1}, {"id": None, "n": 2}]) == plan([{"id": 1, "n": 1}, {"id": 1, "n": 2}]) == "n"
    with pytest.raises(ValueError):
        plan([{"id": 1}, {}])


def test_no_key_is_an_error(spark):
    data = files.parse_objects(spark.createDataFrame([('{"id":1}',), ('{"id":1}',)], "value string"))
    with pytest.raises(ValueError):
        flattening.propose(data, "thing")


def test_consensus_takes_the_first_proposal(spark):
    proposals = spark.createDataFrame(
        [(0, "a", "main"), (1, "a", "objects"), (2, "b", "values"), (1, "c", "keyvalue"), (2, "c", "main")],
        "proposal int, source_field string, kind string",
    )
    found = {tuple(r) for r in flattening.consensus(proposals).collect()}
    assert found == {("a", "main"), ("a", "objects"), ("b", "values"), ("c", "keyvalue"), ("c", "main")}


def test_consensus_plan_over_shards(spark):
    lines = [json.dumps({"id": i, **({"rare": [1]} if i % 30 == 0 else {})}) for i in range(300)]
    data = files.parse_objects(spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "line bigint, value string"))
    assert [c.source_field for c in flattening.propose(data, "t").children] == ["rare"]
    plan = flattening.propose_by_consensus(data, "t", F.col("line"))
    assert [c.source_field for c in plan.children] == ["rare"]


def test_head_lines_count_raw_lines(spark, tmp_path):
    for number in range(3):
        (tmp_path / f"part-{number}.txt").write_text("\n".join(f"{number}-{i}" if i % 2 else "" for i in range(100)) + "\n")
    found = sampling.head_lines(files.read_lines(spark, str(tmp_path)), 150).orderBy("line_no").collect()
    expected = [f"{n}-{i}" if i % 2 else "" for n in range(3) for i in range(100)][:150]
    assert [r["value"] for r in found] == expected and [r["line_no"] for r in found] == list(range(150))


def test_head_lines_with_options_of_the_reader(spark, tmp_path):
    for number in range(3):
        (tmp_path / f"part-{number}.txt").write_text(";".join(f"{number}-{i}" for i in range(10)))
    lines = spark.read.text(str(tmp_path), lineSep=";")
    found = sampling.head_lines(lines, 15, lineSep=";").orderBy("line_no").collect()
    assert [r["value"] for r in found] == [f"{n}-{i}" for n in range(3) for i in range(10)][:15]
    assert sampling.head_lines(lines, 0, lineSep=";").count() == 0


def test_positions_refuse_files_that_have_changed(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("a\nb\n")
    numbered = sampling.with_line_position(files.read_lines(spark, str(tmp_path)), "line_no")
    (tmp_path / "lines.txt").write_text("a\nb\nc\n")
    with pytest.raises(Exception, match="changed while rows were numbered"):
        numbered.collect()


def test_line_positions_across_splits(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("\n".join(str(i) for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        lines = files.read_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 3
        wrong = sampling.with_line_position(lines, "line_no").filter("CAST(value AS BIGINT) <> line_no").count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert wrong == 0


@pytest.mark.parametrize(
    "rows, sample", [(17_456_743, 100_327), (1_000_163, 100_017), (228_100, 114_050), (1_798_569, 105_799), (112_650, 112_650)]
)
def test_sample_sizes_of_saved_profiles(rows, sample):
    stride = sampling.stride_for(rows)
    assert -(-rows // stride) == sample


def test_small_tables_are_not_sampled():
    assert sampling.stride_for(100_000) is None and sampling.stride_for(100_001) == 1


def test_systematic_sample(spark, tmp_path):
    spark.range(1000).repartition(4).write.parquet(str(tmp_path / "t.parquet"))
    df = spark.read.parquet(str(tmp_path / "t.parquet"))
    found = sampling.systematic_sample(df, 1000, 100).orderBy("position").collect()
    assert [r["position"] for r in found] == list(range(0, 1000, 10)) and len({r["id"] for r in found}) == 100
    assert sampling.systematic_sample(df, 1000, 1000).count() == 1000
