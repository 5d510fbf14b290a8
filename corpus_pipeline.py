"""A corpus made ready for training, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame that is written as Parquet and read again
as the next stage's ``docs``. All but the last keep the columns of ``documents``, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondage.llm import bpe, decontaminate, minhash, quality, suffix
from sondage.llm.queries import TOKENIZER
from sondage.llm.tables import prepare, stored, table, unused

#: Repeated passages of so many words are cut, however few bytes they have.
PASSAGE = 51


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. All of them go through it."""
    prepare(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "score")
    return quality.score(docs, model, out=score).where(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near duplicates, texts whose five-word shingles have a
    similarity of 0.8 or more. Different texts under one id are documents of their own; of rows that repeat id
    and text the first stays, and every row whose id is null."""
    prepare(spark)
    names = [unused(docs, name) for name in ("key", "text_hi", "text_lo")]
    kept = minhash.groups(docs, at=minhash.AT_80).where("first AND key IS NOT NULL").select("key", "text_hi", "text_lo").distinct().toDF(*names)
    named, unnamed = docs.where("doc_id IS NOT NULL"), docs.where("doc_id IS NULL")
    values = [F.col("doc_id").cast("bigint"), *minhash.text_name()]
    named = named.select("*", *(value.alias(name) for value, name in zip(values, names, strict=True)))
    return named.join(kept, names, "left_semi").dropDuplicates(names).select(*docs.columns).unionByName(unnamed)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with passages of over 50 words and passages of 400 bytes that stand in more than one
    place cut out of their texts; ``n_chars`` is counted anew where a text changes. A text may end up empty;
    its row stays."""
    prepare(spark)
    before = unused(docs, "before")
    cut = suffix.without_repeats(docs.withColumn(before, F.col("text")), words=PASSAGE)
    if "n_chars" in docs.columns:
        changed = ~F.col("text").eqNullSafe(F.col(before))
        cut = cut.withColumn("n_chars", F.when(changed, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and digests of the ids and the decoded text of every document."""
    prepare(spark)
    return bpe.round_trip(docs, TOKENIZER)


STAGES = [
    ("quality classifier", keep_quality), ("MinHash near-dedup", keep_one_of_each), ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", keep_clean), ("BPE encoding and decoding", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored below the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned scores and token ids are beyond SQL; the tests compare each stage with a brute-force version.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
