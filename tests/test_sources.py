import gzip

import pytest

from sondage.sources import files, sinks
from sondage.streaming.chunked_load import load_in_chunks


@pytest.mark.parametrize(
    "name, table", [("export_orders_dataset.csv", "orders"), ("items.csv", "items"), ("my_export_x.csv.gz", "my_export_x"), ("a.b.csv", "a.b")]
)
def test_table_names(name, table):
    assert files.table_name(name, "export_", "_dataset") == table


def test_csv_folder(spark, tmp_path):
    (tmp_path / "export_codes_dataset.csv").write_bytes("﻿code,english\r\npt_a,\"Apples, \"\"red\"\"\"\r\npt_b,Pears\r\n".encode())
    (tmp_path / "zips.csv").write_text("zip,n\n00123,1\n04567,\n")
    (tmp_path / "notes.txt").write_text("ignored")
    (tmp_path / "inner").mkdir()
    (tmp_path / "inner" / "deep.csv").write_text("a\n1\n")
    found = files.load_csv_folder(spark, str(tmp_path), "export_", "_dataset", {"zips": "zip string, n int"})
    assert list(found) == ["codes", "zips"]
    assert found["codes"].columns == ["code", "english"]
    assert [tuple(r) for r in found["codes"].collect()] == [("pt_a", 'Apples, "red"'), ("pt_b", "Pears")]
    assert [tuple(r) for r in found["zips"].collect()] == [("00123", 1), ("04567", None)]


def test_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,note\n1,"two\nlines"\n')
    assert files.read_csv(spark, str(tmp_path / "t.csv"), multiline=True).first()["note"] == "two\nlines"


def test_empty_folder_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.load_csv_folder(spark, str(tmp_path))
    assert files.list_tables(spark, str(tmp_path / "missing")) == []


def test_append_chunks_replaces_first(spark, tmp_path):
    target = str(tmp_path)
    assert sinks.append_chunks([spark.range(5), spark.range(3)], target, "t") == 8
    assert sinks.append_chunks([spark.range(2), spark.range(2)], target, "t") == 4
    assert sinks.append_chunks([], target, "t") == 0


def test_run_log_grows(spark, tmp_path):
    path = str(tmp_path / "log")
    for run in ("one", "two"):
        sinks.append_run_log(spark.createDataFrame([(run, 3)], "run string, calls int"), path)
    back = files.read_json_document(spark, path)
    assert sorted(r["run"] for r in back.collect()) == ["one", "two"] and "timestamp" in back.columns


def test_chunked_load_goes_on_where_it_stopped(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    for i in range(5):
        (tmp_path / "in" / f"{i}.csv").write_text("id,name\n" + "".join(f"{i * 10 + j},x\n" for j in range(10)))
    assert load_in_chunks(spark, source, "id bigint, name string", target, state, 2) == 50
    with gzip.open(tmp_path / "in" / "more.csv.gz", "wt") as more:
        more.write("id,name\n50,y\n")
    assert load_in_chunks(spark, source, "id bigint, name string", target, state, 2) == 51
    assert load_in_chunks(spark, source, "id bigint, name string", target, state, 2) == 51
    assert spark.read.parquet(target).select("id").distinct().count() == 51
