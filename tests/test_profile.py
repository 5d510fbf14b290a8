"""Profiles of small tables, checked by hand or against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sondage.operators import columns, dedup, keys, occurrence, quantiles
from sondage.operators.profile import DatabaseProfile


def rows(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture(scope="module")
def shop(spark):
    orders = spark.createDataFrame(
        [(i, i % 10, float(i), "open" if i % 2 else " Open ") for i in range(100)] + [(100, None, 5000.0, None)],
        "order_id bigint, customer_id int, amount double, status string",
    )
    customers = spark.createDataFrame(
        [(float(i), f"name {i}", "x" * 50 + str(i)) for i in range(12)], "customer_code double, name string, about string"
    )
    empty = spark.createDataFrame([], "ref string, size double")
    return {"orders": orders, "customers": customers, "empty": empty}


@pytest.fixture(scope="module")
def profile(shop):
    return DatabaseProfile(shop)


def test_nulls_and_nan_are_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (math.nan, None), (None, "b"), (-0.0, "b"), (0.0, "b")], "x double, s string")
    facts = columns.column_facts({"t": df})
    assert rows(columns.null_stats(facts)) == {("t", "x", 2, 40.0), ("t", "s", 1, 20.0)}
    slots = occurrence.assign_slots({"t": df})
    found = occurrence.slot_distincts(occurrence.signatures({"t": df}, slots), slots)
    # -0.0 equals 0.0, and so do the rows (NaN, NULL)-free duplicates of them.
    assert rows(found) == {("t", "x", 2), ("t", "s", 2), ("t", None, 4)}


def test_null_pct_as_in_saved_profiles(spark):
    facts = spark.createDataFrame([("t", "c", 100_327, 100_327 - 78_309)], "table string, column string, row_count bigint, non_null bigint")
    assert columns.null_stats(facts).first()["null_pct"] == 78.05


def test_empty_table(profile):
    found = {r["column"]: r for r in profile.column_profile.filter("table = 'empty'").collect()}
    assert found["size"]["null_pct"] == 0.0 and found["size"]["distinct_count"] == 0
    assert found["size"]["outlier_count"] == 0 and found["size"]["sample_values"] == []
    summary = profile.table_profile.filter("table = 'empty'").first()
    assert summary["row_count"] == 0 and summary["duplicate_rows"] == 0 and summary["pk_candidates"] == []


def test_table_profile(profile):
    found = {r["table"]: r for r in profile.table_profile.collect()}
    assert found["orders"]["pk_candidates"] == ["order_id", "amount"]
    assert found["customers"]["pk_candidates"] == ["customer_code", "name", "about"]


def test_column_profile(profile):
    found = {(r["table"], r["column"]): r for r in profile.column_profile.collect()}
    amount = found["orders", "amount"]
    assert amount["outlier_count"] == 1 and amount["sample_values"] == ["0.0", "1.0", "2.0"]
    status = found["orders", "status"]
    assert status["null_count"] == 1 and status["distinct_count"] == 2 and status["casing_issues"] == 1
    assert not status["is_free_text"] and found["customers", "about"]["is_free_text"]
    assert rows(profile.casing.select("normal_form", "form", "rows")) == {("open", "open", 50), ("open", " Open ", 50)}


def test_foreign_keys_cross_number_types(profile):
    # customer_id is an int, customer_code a double: 1 meets 1.0.
    assert ("orders", "customer_id", "customers", "customer_code", 100.0) in rows(profile.fk_candidates)
    names = {r["column"] for r in profile.known_keys.collect()}
    assert {"customer_id", "customer_code"} <= names


def test_numbers_never_meet_text(spark):
    a = spark.createDataFrame([("1",), ("2",)], "a_id string")
    b = spark.createDataFrame([(1,), (2,)], "b_id bigint")
    assert DatabaseProfile({"a": a, "b": b}).fk_candidates.count() == 0


def test_foreign_keys_both_ways_and_to_two_parents(spark):
    a = spark.range(20).toDF("a_id")
    b = spark.range(20).select(F.col("id").alias("b_id"), (F.col("id") + 0).alias("b_code"))
    found = rows(DatabaseProfile({"a": a, "b": b}).fk_candidates)
    assert ("a", "a_id", "b", "b_id", 100.0) in found and ("a", "a_id", "b", "b_code", 100.0) in found
    assert ("b", "b_id", "a", "a_id", 100.0) in found


def test_overlap_threshold(spark):
    parent = spark.range(100).toDF("key")
    at, below = spark.range(10, 110).toDF("at_ref"), spark.range(11, 111).toDF("below_ref")
    found = rows(DatabaseProfile({"p": parent, "at": at, "below": below}).fk_candidates)
    assert ("at", "at_ref", "p", "key", 90.0) in found
    assert not any(edge[1] == "below_ref" and edge[2] == "p" for edge in found)


def test_many_columns_need_several_words(spark):
    df = spark.range(5).select(*[(F.col("id") * (i + 1)).alias(f"c{i}") for i in range(150)])
    slots = occurrence.assign_slots({"w": df})
    found = occurrence.slot_distincts(occurrence.signatures({"w": df}, slots), slots).collect()
    assert len(found) == 151 and {r["distinct_count"] for r in found} == {5}


def test_distincts_of_mixed_types(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (9007199254740993L, 1.5D, true, DATE'2024-01-01', array(1, 2), X'0A', CAST(1.10 AS DECIMAL(10,2))),
        (9007199254740992L, 1.5D, false, DATE'2024-01-02', array(1, 2), X'0B', CAST(1.10 AS DECIMAL(10,2))),
        (9007199254740993L, 2.0D, true, NULL, NULL, X'0A', CAST(2.00 AS DECIMAL(10,2)))
        AS t(big, dbl, flag, day, list, bin, dec)"""
    )
    slots = occurrence.assign_slots({"t": df}, rows=False)
    found = {r["column"]: r["distinct_count"] for r in occurrence.slot_distincts(occurrence.signatures({"t": df}, slots), slots).collect()}
    assert found == {"big": 2, "dbl": 2, "flag": 2, "day": 2, "list": 1, "bin": 2, "dec": 2}


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "`Timely response?` int, `a.b``c` string")
    profile = DatabaseProfile({"t": df})
    found = {r["column"]: r["distinct_count"] for r in profile.column_profile.collect()}
    assert found == {"Timely response?": 2, "a.b`c": 1}
    assert profile.duplicates.first()["duplicate_rows"] == 1


def test_duplicates_count_beyond_the_first(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (None, "1"), (1, ""), (1, "")], "a int, b string")
    assert dedup.duplicate_rows({"t": df}).first()["duplicate_rows"] == 3
    assert DatabaseProfile({"t": df}).duplicates.first()["duplicate_rows"] == 3


@pytest.mark.parametrize("buckets", [1 << 16, 32])
def test_quantiles_equal_numpy(spark, buckets):
    random.seed(7)
    data = {
        "even": [float(i) for i in range(2000)],
        "skewed": [random.paretovariate(1.0) for _ in range(2000)],
        # A third of all values are one value.
        "hot": [5.0 if i % 3 == 0 else random.uniform(-10, 10) for i in range(2000)],
        "few": [float(i % 3) for i in range(2000)],
        "holes": [None if i % 2 else float(i) for i in range(2000)],
        "none": [None] * 2000,
        # Neighbouring doubles, the least and greatest ones, both zeros.
        "close": [1.0 + (i % 500) * 2.0**-52 for i in range(2000)],
        "wide": [random.choice([-1.0, 1.0]) * 2.0 ** random.uniform(-1070, 1020) for _ in range(2000)],
        "edges": [random.choice([5e-324, -5e-324, 0.0, -0.0, 1.7e308, -1.7e308, float("nan")]) for _ in range(2000)],
    }
    names = list(data)
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{n} double" for n in names)).repartition(4)
    found = quantiles.exact_quantiles({"t": df}, buckets=buckets).collect()
    got = {(r["column"], r["probability"]): r["value"] for r in found}
    present = {n: [v for v in data[n] if v is not None and v == v] for n in names}
    assert {r["column"]: r["present"] for r in found} == {n: len(v) for n, v in present.items() if v}
    assert set(got) == {(n, p) for n in names if n != "none" for p in (0.25, 0.75)}
    for (name, p), value in got.items():
        ordered = sorted(present[name])
        place = (len(ordered) - 1) * p
        low, high = ordered[int(place)], ordered[min(int(place) + 1, len(ordered) - 1)]
        assert value == low + (high - low) * (place - int(place)), (name, p)
        assert value == pytest.approx(np.quantile(present[name], p), rel=1e-12), (name, p)


def test_quantiles_of_tiny_columns(spark):
    for values in ([3.0], [1.0, 2.0], [1.0, 2.0, 10.0], [1.0, 2.0, 3.0, 4.0, 50.0, 60.0]):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        found = quantiles.exact_quantiles({"t": df}).collect()
        for r in found:
            assert r["value"] == pytest.approx(np.quantile(values, r["probability"]))


def test_quantiles_beside_infinite_values(spark):
    values = [float("-inf")] * 30 + [float(i) for i in range(40)] + [float("inf")] * 30
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = quantiles.exact_quantiles({"t": df}, (0.1, 0.4, 0.5, 0.6, 0.9), buckets=4).collect()
    assert {r["probability"]: round(r["value"], 9) for r in found} == {0.1: float("-inf"), 0.4: 9.6, 0.5: 19.5, 0.6: 29.4, 0.9: float("inf")}
    assert quantiles.exact_quantiles({"t": df.limit(0)}) is None
    assert quantiles.exact_quantiles({"t": df.selectExpr("CAST(x AS STRING) AS x")}) is None


def test_outlier_gates(spark):
    # Four values are too few; equal quartiles give no fence; fences themselves are inside.
    df = spark.createDataFrame([(1.0, 1.0, 1.0)] * 3 + [(1000.0, 1.0, 2.0), (None, 1.0, 3.0), (None, 99.0, 3.0), (None, 1.0, 6.0), (None, 1.0, 6.1)], "four double, flat double, edge double")
    profile = DatabaseProfile({"t": df})
    found = {r["column"]: r["outlier_count"] for r in profile.outliers.collect()}
    values = [1.0, 1.0, 1.0, 2.0, 3.0, 3.0, 6.0, 6.1]
    q1, q3 = np.quantile(values, [0.25, 0.75])
    expected = sum(v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1) for v in values)
    assert found == {"four": 0, "flat": 0, "edge": expected}


def test_samples_are_the_smallest_values(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("b", 2), ("c", 2), ("d", None)], "s string, n int")
    found = rows(columns.smallest_values("t", df))
    assert found == {("t", "s", 1, "a"), ("t", "s", 2, "b"), ("t", "s", 3, "c"), ("t", "n", 1, "2")}


def test_free_text_samples_are_redacted(spark):
    text = "please write to me at somebody@example.org or call +49 170 1234567 now"
    df = spark.createDataFrame([(f"{i:03d} {text}",) for i in range(5)], "note string")
    profile = DatabaseProfile({"t": df})
    column = profile.column_profile.first()
    assert column["sample_values"][0] == "000 please write to me at <EMAIL_ADDRESS> or call <PHONE_NUMBER> now"
    pii = column["free_text_pii"]
    assert pii["sample_size"] == 5 and pii["entities"]["EMAIL_ADDRESS"]["pct"] == 100.0


def test_cardinality_ignores_small_tables(spark):
    facts = spark.createDataFrame([("big", "name", 200), ("small", "name", 71)], "table string, column string, row_count bigint")
    distincts = spark.createDataFrame([("big", "name", 50), ("small", "name", 71)], "table string, column string, distinct_count bigint")
    assert rows(keys.cardinality_ratio(facts, distincts)) == {("name", 0.25)}


def test_identifier_names(spark):
    names = spark.createDataFrame([("width",), ("Order_ID",), ("zipcode",), ("price",), ("turkey",), ("xref",)], "n string")
    found = {r["n"] for r in names.filter(keys.looks_like_identifier(F.col("n"))).collect()}
    assert found == {"width", "Order_ID", "zipcode", "turkey", "xref"}


def test_star_candidates(spark):
    edges = spark.createDataFrame(
        [("fact", "a_id", "a", "id"), ("fact", "b_id", "b", "id"), ("a", "id", "b", "id"), ("c", "id", "b", "id")],
        "child_table string, child_column string, parent_table string, parent_column string",
    )
    counts = spark.createDataFrame([("fact", 10), ("a", 5), ("b", 5), ("c", 7)], "table string, row_count bigint")
    found = [r["table"] for r in keys.star_candidates(edges, counts).orderBy("place").collect()]
    assert found == ["fact", "c", "a"]


def test_hot_values_do_not_change_counts(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("ref"))
    parent = spark.range(3000).toDF("id")
    profile = DatabaseProfile({"c": df, "p": parent})
    assert ("c", "ref", "p", "id", 100.0) in rows(profile.fk_candidates)
    assert profile.distincts.filter("column = 'ref'").first()["distinct_count"] == 2001
