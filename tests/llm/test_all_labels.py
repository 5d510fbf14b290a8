"""The toxicity network learns from every labelled text of its folds."""

import random
import re
import zlib

from sondage.llm import toxicity
from sondage.llm.tables import prepare
from tests.llm import cases


def test_long_texts_and_every_shard_are_learned_from(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(toxicity, "SHARD", 150, raising=False)
    generator, texts, labels = random.Random(5), [], []
    for i in range(900):
        # Toxic texts are all longer than 3,000 words or rare among the short ones.
        toxic = i % 9 == 0
        words = cases.words(generator, 3_100 if i % 18 == 0 else 30).split()
        if toxic:
            words.insert(generator.randrange(len(words)), "grunzig" if i % 18 == 0 else "pathetic")
        texts.append(" ".join(words))
        labels.append(int(toxic))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    known = spark.createDataFrame(list(enumerate(labels)), "doc_id bigint, toxic int")
    rows = {r.doc_id: r for r in toxicity.judge(docs, known).collect()}
    held = [i for i in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(rows[i].held_out for i in held)
    long_ones = [rows[i].predicted for i in held if i % 18 == 0]
    assert sum(long_ones) / len(long_ones) > 0.9
    assert sum(rows[i].predicted == labels[i] for i in held) / len(held) > 0.93
    again = {r.doc_id: r.score for r in toxicity.judge(docs.repartition(5), known.repartition(2)).collect()}
    assert again == {i: r.score for i, r in rows.items()}


def test_codes_of_labelled_texts_alone_are_moved_once(spark, monkeypatch):
    """Also where ids are too many for the filter, and where the labels are too many to be broadcast."""
    prepare(spark)
    docs = spark.range(3_000).selectExpr("id AS doc_id", "concat('a', id, ' b') AS text").unionByName(spark.sql("SELECT 9L AS doc_id, CAST(NULL AS STRING) AS text"))
    known = spark.range(300).selectExpr("CAST(id * 7 AS INT) AS doc_id", "CAST(id % 2 AS INT) AS toxic")
    expected = {7 * i: i % 2 for i in range(300) if zlib.crc32(str(7 * i).encode()) % 3 != 1}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, passed in ((1 << 26, 1_000), (1 << 15, 1_000)):
            monkeypatch.setattr(toxicity, "FILTER", most)
            held = toxicity.labelled(docs, known)
            assert {r.doc_id: r.toxic for r in held.collect()} == expected
            bits = toxicity.marked(known.where("doc_id IS NOT NULL"), 300)
            assert len(expected) <= toxicity.coded(docs, bits).count() < passed
        plan = held._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = re.findall(r"\) Exchange[^\n]*\nInput \[\d+\]: \[(.*?)\]", plan)
    assert moved and not any("text" in m for m in moved)
    # The plan shows the exchange as it was planned and as it was run.
    assert len({m for m in moved if "codes" in m}) == 1
