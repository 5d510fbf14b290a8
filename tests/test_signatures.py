"""Distinct values are merged under keys no wider than their types need."""

import datetime
from decimal import Decimal

from sondage.operators import occurrence


def sizes(tables):
    slots = occurrence.assign_slots(tables)
    signatures = occurrence.signatures(tables, slots)
    found = {(r["table"], r["column"]): r["distinct_count"] for r in occurrence.slot_distincts(signatures, slots).collect()}
    overlaps = occurrence.slot_overlaps(signatures, slots, slots, slots).collect()
    return found, {(r["child_column"], r["parent_column"]): r["shared"] for r in overlaps if r["child_table"] == "a" and r["child_column"] and r["parent_column"]}, signatures


def test_numbers_travel_without_text_and_rows_as_digests(spark):
    day = datetime.datetime(2024, 1, 1)
    a = spark.createDataFrame([(1, 1.0, "1", day), (2, 2.5, "x", None), (2, 2.5, "x", None), (3, float("nan"), None, day)], "i bigint, d double, s string, t timestamp_ntz")
    b = spark.createDataFrame([(1, "x", 2.5), (7, "y", 3.0)], "j int, u string, e double")
    found, shared, signatures = sizes({"a": a, "b": b})
    assert found == {("a", "i"): 3, ("a", "d"): 2, ("a", "s"): 2, ("a", "t"): 1, ("a", None): 3, ("b", "j"): 2, ("b", "u"): 2, ("b", "e"): 2, ("b", None): 2}
    assert shared == {("i", "j"): 1, ("i", "e"): 1, ("d", "j"): 1, ("d", "e"): 1, ("s", "u"): 1}
    plan = signatures._jdf.queryExecution().optimizedPlan().toString()
    assert "hex(" not in plan.lower()
    assert any("Aggregate [family" in line and "text" not in line for line in plan.split("\n"))


def test_decimals_still_meet_whole_numbers(spark):
    a = spark.createDataFrame([(Decimal("1.00"),), (Decimal("2.50"),), (Decimal("9007199254740993.01"),)], "m decimal(30,2)")
    b = spark.createDataFrame([(1, 2.5), (9, 9.0)], "j int, e double")
    found, shared, _ = sizes({"a": a, "b": b})
    assert found[("a", "m")] == 3 and shared == {("m", "j"): 1, ("m", "e"): 1}
