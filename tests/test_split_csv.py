"""CSV files that are cut at any place, against Python's reader."""

import csv
import io
import random

import pytest
from pyspark.errors import PySparkException

from sondage.sources.split_csv import quotes_before, raw_lines, read_csv_split, records

SCHEMA = "id int, note string, `last one` string"


@pytest.fixture
def tiny_splits(spark):
    """Sets how many bytes of a file one task reads."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def set_size(size: int) -> None:
        for name, value in zip(names, (size, 0), strict=True):
            spark.conf.set(name, str(value))

    yield set_size
    for name, value in before.items():
        spark.conf.set(name, value)


def rows_of(seed: int, count: int) -> list[tuple]:
    generator, parts = random.Random(seed), ["a", "word", ",", '"', '""', "\n", "\n\n", "é", "日本", " ", "x" * 30, "1", "\t"]

    def text():
        return "".join(generator.choice(parts) for _ in range(generator.randint(1, 12))).strip() or None

    rows = [(i, text(), text()) for i in range(count)]
    rows[count // 2] = (count // 2, "long\n" * 40 + '"end"', "tail")
    return rows


def written(rows, ending: str, last_ending: bool = True, header=("id", "note", "last one")) -> bytes:
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=ending)
    writer.writerows([header, *rows] if header else rows)
    text = out.getvalue()
    return (text if last_ending else text.removesuffix(ending)).encode()


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_rows_are_those_of_the_file_wherever_it_is_cut(spark, tmp_path, tiny_splits, size):
    expected = []
    for number, (ending, last, header) in enumerate([("\n", True, ("id", "note", "last one")), ("\r\n", True, ("id", "a\nnote", "last,\n\none")), ("\n", False, ("id", "note", "last one"))]):
        rows = rows_of(number, 8 if size < 64 else 60)
        (tmp_path / f"{number}.csv").write_bytes(written(rows, ending, last, header))
        expected += rows
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "header.csv").write_bytes(b"id,note,last one\n")
    tiny_splits(size)
    found = read_csv_split(spark, str(tmp_path), SCHEMA)
    assert found.columns == ["id", "note", "last one"]
    if size == 64:
        assert raw_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_without_header_and_with_blank_lines(spark, tmp_path, tiny_splits):
    (tmp_path / "a.csv").write_text('1,"x\ny",z\n\n   \n2,,"q ""r"""\n')
    for size in (3, 1000):
        tiny_splits(size)
        found = read_csv_split(spark, str(tmp_path), SCHEMA, header=False)
        assert sorted(map(tuple, found.collect())) == [(1, "x\ny", "z"), (2, None, 'q "r"')]


def test_a_value_that_is_never_closed_and_rows_that_do_not_fit(spark, tmp_path, tiny_splits):
    (tmp_path / "a.csv").write_text('id,note,last one\n1,x,y\n2,"open\nand on')
    tiny_splits(6)
    assert sorted(r.record for r in records(spark, str(tmp_path)).collect()) == ["1,x,y", '2,"open\nand on']
    (tmp_path / "a.csv").write_text("id,note,last one\nno number,x,y\n")
    assert read_csv_split(spark, str(tmp_path), SCHEMA).first()["id"] is None
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv_split(spark, str(tmp_path), SCHEMA, mode="FAILFAST").collect()


def test_splits_that_changed_between_scans_are_an_error(spark, tmp_path, tiny_splits):
    (tmp_path / "a.csv").write_bytes(written(rows_of(9, 80), "\n"))
    tiny_splits(200)
    found = records(spark, str(tmp_path))
    tiny_splits(150)
    with pytest.raises(PySparkException, match="another way"):
        records(spark, str(tmp_path)).unionByName(found).count()


def test_parity_of_each_split(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h\n"a\nb"\n')
    (starts, odd), = quotes_before(raw_lines(spark, str(tmp_path))).values()
    assert starts.tolist() == [0] and odd.tolist() == [0]
