"""Listed names beyond a broadcast: only those that very many texts mention are dealt out."""

from sondage.operators import text_scan


def test_frequent_and_rare_names_are_found_by_the_join(spark, monkeypatch):
    monkeypatch.setattr(text_scan, "BROADCAST_NAMES", 0)
    monkeypatch.setattr(text_scan, "HOT_TEXTS", 20)
    monkeypatch.setattr(text_scan, "SALTS", 3)
    texts = [(f"To Ann Lee, room {i}" + (" by way of Port Bo" if i % 50 == 0 else ""),) for i in range(200)] + [(None,), ("ann, lee, x",)]
    names = spark.createDataFrame([("ann lee", "PERSON"), ("Ann Lee", "TEAM"), ("port bo", "LOCATION"), *((f"nobody{i}", "PERSON") for i in range(40))], "name string, entity string")
    df = spark.createDataFrame(texts, "note string")
    found = {(r["entity"], r["hits"], r["scanned"]) for r in text_scan.scan_name_list(df, ["note"], names).collect()}
    assert found == {("PERSON", 201, 201), ("TEAM", 201, 201), ("LOCATION", 4, 201)}
    mentions = text_scan.name_mentions(df, "note", names)
    assert mentions.count() == mentions.distinct().count() == 201 * 2 + 4
    # No name but a frequent one is sent more than once.
    assert not any("sequence(0, 2" in line for line in mentions._jdf.queryExecution().optimizedPlan().toString().split("\n"))
