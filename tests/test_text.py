import random

import pytest
from pyspark.sql import functions as F

from sondage.functions import text
from sondage.operators import text_scan


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value, found",
    [
        ("mail zoë.müller+x@exämple-host.co.uk now", True),
        ("a@b.c", True),
        ("no at sign.com", False),
        ("broken@host", False),
        ("@host.org", False),
        ("", False),
    ],
)
def test_email(spark, value, found):
    assert one(spark, text.has_email, value) is found


@pytest.mark.parametrize(
    "value, found",
    [("call 12345678", False), ("call 123456789", True), ("+49 170 12 34", True), ("1.2.3.4.5", True), ("12 34", False), ("٠١٢٣٤٥٦٧٨", True)],
)
def test_phone(spark, value, found):
    assert one(spark, text.has_phone, value) is found


def test_redaction_masks_email_first(spark):
    given = "a.123456789@example.org and 030-1234567 and b@c.de."
    assert one(spark, text.redact, given) == "<EMAIL_ADDRESS> and <PHONE_NUMBER> and <EMAIL_ADDRESS>"
    assert one(spark, text.redact, "nothing here") == "nothing here"
    assert one(spark, text.redact, None) is None


@pytest.mark.parametrize(
    "value, valid",
    [
        ("4111 1111 1111 1111", True),
        ("4111-1111-1111-1112", False),
        ("378282246310005", True),
        ("411111111111", False),
        ("6011000990139424", True),
    ],
)
def test_luhn(spark, value, valid):
    assert one(spark, text.luhn_valid, value) is valid
    assert (one(spark, lambda c: F.size(text.card_numbers(F.concat(F.lit("no "), c, F.lit(".")))), value) == 1) is valid


@pytest.mark.parametrize(
    "value, valid",
    [
        ("DE89370400440532013000", True),
        ("GB82WEST12345698765432", True),
        ("DE88370400440532013000", False),
        ("GB82TEST12345698765432", False),
    ],
)
def test_iban(spark, value, valid):
    assert one(spark, text.iban_valid, value) is valid


@pytest.mark.parametrize("value, expected", [("  A  b\tC\n", "a b c"), ("   ", ""), (" É  x", "é x")])
def test_normal_form(spark, value, expected):
    assert one(spark, text.normal_form, value) == expected


def test_casing_variants(spark):
    df = spark.createDataFrame(
        [("Active", "x"), ("active", "x"), (" ACTIVE", "X y"), ("active", "x  Y"), ("Closed", None), ("", "  "), ("  ", "z")],
        "status string, other string",
    )
    found = {tuple(r) for r in text_scan.casing_variants("t", df, ["status", "other"]).collect()}
    assert found == {
        ("t", "status", "active", "Active", 1),
        ("t", "status", "active", "active", 2),
        ("t", "status", "active", " ACTIVE", 1),
        ("t", "other", "x y", "X y", 1),
        ("t", "other", "x y", "x  Y", 1),
    }


def test_pii_share_of_a_sample(spark):
    df = spark.range(200).select(
        "id", F.when(F.col("id") < 112, F.concat(F.lit("write to me@example.org "), "id")).otherwise("nothing").alias("note")
    )
    found = text_scan.scan_pii_sample(df, "note", F.col("id")).collect()
    assert [tuple(r) for r in found] == [("note", "EMAIL_ADDRESS", 112, 200, 56.0)]


def test_samples_repeat(spark):
    df = spark.range(1000).repartition(5)
    first = {r["id"] for r in text_scan.hash_sample(df, F.col("id"), 50).collect()}
    assert first == {r["id"] for r in text_scan.hash_sample(df.repartition(3), F.col("id"), 50).collect()} and len(first) == 50


def test_pii_of_all_entities(spark):
    df = spark.createDataFrame(
        [("card 4111 1111 1111 1111",), ("account DE89370400440532013000",), ("me@example.org",), (None,)], "note string"
    )
    found = {r["entity"]: r["hits"] for r in text_scan.scan_pii(df, ["note"], tuple(text.DETECTORS)).collect()}
    # Card and account digits also read as phone numbers, as they do by the pattern itself.
    assert found == {"CREDIT_CARD": 1, "IBAN_CODE": 1, "EMAIL_ADDRESS": 1, "PHONE_NUMBER": 2}


def test_listed_names(spark):
    df = spark.createDataFrame([(1, "Anna met Paul."), (2, "paul again, PAUL"), (3, "nobody"), (4, None)], "id int, note string")
    names = spark.createDataFrame([("Paul",), ("Maria",)], "name string")
    found = text_scan.scan_names(df, "note", "id", names, "PERSON").first()
    assert tuple(found) == ("note", "PERSON", 2, 3, 66.7)


def plain_mentions(values, names):
    """(row, entity, phrase) by looking for every name at every word."""
    import re

    split = lambda x: re.findall(r"[^\W]+", x.lower())
    out = set()
    for row, value in enumerate(values):
        spoken = split(value or "")
        for name, entity in names:
            own = split(name or "")
            if own and any(spoken[i : i + len(own)] == own for i in range(len(spoken))):
                out.add((row, entity, " ".join(own)))
    return out


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_names_of_several_words_match_looking_everywhere(spark, monkeypatch, broadcast):
    monkeypatch.setattr(text_scan, "BROADCAST_NAMES", broadcast)
    generator = random.Random(3)
    vocabulary = ["new", "york", "New", "YORK", "de", "la", "cruz", "é", "ann", "lee", "the", "of", "x1", "_y"]
    spell = lambda n: generator.choice([" ", "-", ", ", "  "]).join(generator.choice(vocabulary) for _ in range(n))
    values = [None, "", "...", "new", *(spell(generator.randint(1, 14)) for _ in range(150)), "new york " * 300]
    names = [(spell(generator.randint(1, 4)), generator.choice(["PERSON", "LOCATION"])) for _ in range(25)]
    names += [("New York", "LOCATION"), ("new-york", "PERSON"), (None, "PERSON"), ("?!", "PERSON"), ("New York", "LOCATION"), ("of the new York lee ann", "PERSON")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, note string").coalesce(1)
    listed = spark.createDataFrame(names, "name string, entity string")
    # One partition, so rows are numbered one by one.
    found = {tuple(r) for r in text_scan.name_mentions(df, "note", listed).collect()}
    expected = plain_mentions(values, names)
    assert found == expected and len(expected) > 50
    hits = {(r["entity"], r["hits"], r["scanned"]) for r in text_scan.scan_name_list(df, ["note"], listed).collect()}
    assert hits == {(e, len({row for row, own, _ in expected if own == e}), len(values) - 1) for e in ("PERSON", "LOCATION")}


def test_no_names_or_no_texts(spark):
    df = spark.createDataFrame([("a b",)], "note string")
    names = spark.createDataFrame([("a", "PERSON")], "name string, entity string")
    assert text_scan.scan_name_list(df, ["note"], names.limit(0)).count() == 0
    assert text_scan.scan_name_list(df.limit(0), ["note"], names).count() == 0
