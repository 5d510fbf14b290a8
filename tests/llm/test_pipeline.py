import hashlib
import os
import random
import re
from collections import Counter

import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from sondage.llm import quality, suffix
from sondage.llm.tables import table
from tests.llm import cases

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


def test_every_stage_on_its_own_input(spark, tmp_path):
    docs, columns = table(spark, FOLDER, "documents"), table(spark, FOLDER, "documents").columns
    inputs = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        inputs.append({r.doc_id: r for r in docs.collect()})
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        assert number == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    last = docs.collect()
    texts = [{i: r.text for i, r in rows.items()} for rows in inputs]

    judged = quality.judge(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")).where("predicted = 1").collect()
    assert set(texts[1]) == {r.doc_id for r in judged}
    assert set(texts[2]) == {i for i, (_, root) in cases.near_duplicate_groups(texts[1], 80).items() if i == root}
    assert texts[3] == dict(zip(texts[2], without_repeated(texts[2].values()), strict=True))
    assert all(r.n_chars == (len(r.text) if texts[2][i] != r.text else inputs[2][i].n_chars) for i, r in inputs[3].items())
    items = {r.item_id: r.text for r in table(spark, FOLDER, "benchmark").collect()}
    assert set(texts[4]) == set(texts[3]) - {d for d, _ in cases.contaminations(texts[3], items)}
    assert len(texts[0]) > len(texts[1]) > len(texts[2]) == len(texts[3]) >= len(texts[4]) > 0

    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    assert {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in last} == {
        i: (len(library.encode(t, add_special_tokens=False).ids), hashlib.sha256(t.encode()).hexdigest()) for i, t in texts[4].items()
    }
    whole = __spark_entry__.queries()["pipeline"](spark, FOLDER)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, last))


def test_stages_keep_extra_columns_repeated_rows_and_nulls(spark, tmp_path):
    rows = [(1, "a b c d e f", 11, "x"), (1, "a b c d e f", 11, "x"), (None, None, None, "y"), (2, None, 0, None), (3, "", 0, "z"), (4, "A b c  d e f", 12, "w")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, `row` string")
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "n_chars", "row"]
    assert sorted(map(str, docs.collect())) == sorted(map(str, [r for i, r in enumerate(spark.createDataFrame(rows, docs.schema).collect()) if i not in (1, 5)]))
    assert corpus_pipeline.tokenize(spark, docs, FOLDER).count() == 4
    empty = docs.limit(0)
    assert all(stage(spark, empty, FOLDER).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_stages_keep_different_texts_of_one_id_and_columns_of_any_name(spark):
    generator = random.Random(7)
    texts = [cases.words(generator, 40) for _ in range(3)]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (2, f"{texts[0]} x"), (3, texts[2]), (3, "")]
    extra = ["key", "text_hi", "text_lo", "row", "kept", "score", "before", "node", "__row"]
    docs = spark.createDataFrame([(*r, *extra) for r in rows], f"doc_id bigint, text string, {', '.join(f'{c} string' for c in extra)}")
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", *extra]
    left = docs.collect()
    assert sorted((r.doc_id, r.text) for r in left) == sorted([rows[0], rows[1], rows[4], rows[5]])
    assert all(list(r[2:]) == extra for r in left)


def test_near_copies_from_a_similarity_of_four_fifths_on_are_dropped(spark):
    base = [f"w{i}" for i in range(104)]
    # A changed word takes five of 100 shingles out: similarities of 95 / 105, 90 / 110, 85 / 115.
    copies = [" ".join("new" if i in at else w for i, w in enumerate(base)) for at in ([], [50], [20, 80], [20, 50, 80])]
    for first, second, kept in ((0, 1, [1]), (0, 2, [1]), (0, 3, [1, 2])):
        docs = cases.documents(spark, [copies[first], copies[second]], first=1)
        assert sorted(r.doc_id for r in corpus_pipeline.keep_one_of_each(spark, docs, FOLDER).collect()) == kept


def test_near_duplicate_stage_matches_comparing_all_pairs_at_four_fifths(spark):
    texts = dict(enumerate([*cases.near_copies(3, 8, 8), *cases.near_copies(4, 3, 30)]))
    sets, groups = {i: set(cases.shingles(cases.fold(t))) for i, t in texts.items()}, cases.Groups(texts)
    for a in texts:
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                groups.join(a, b)
    kept = {i for i in texts if groups.root(i) == i}
    assert kept < {i for i, (_, root) in cases.near_duplicate_groups(texts).items() if i == root}
    assert {r.doc_id for r in corpus_pipeline.keep_one_of_each(spark, cases.documents(spark, texts.values()), FOLDER).collect()} == kept


def without_repeated(texts, passage=51, length=400):
    """What is left of texts without repeated strings of so many bytes and repeated runs of so many words."""
    given = [(t or "").encode() for t in texts]
    gone = [bytearray(len(b)) for b in given]
    edges = [[(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0d]+", b)] for b in given]
    words = [[b[i:j] for i, j in e] for b, e in zip(given, edges, strict=True)]
    seen = Counter(tuple(w[s : s + passage]) for w in words for s in range(len(w) - passage + 1))
    for w, e, g in zip(words, edges, gone, strict=True):
        for s in range(len(w) - passage + 1):
            if seen[tuple(w[s : s + passage])] > 1:
                start, stop = e[s][0], e[s + passage - 1][1]
                g[start:stop] = b"\1" * (stop - start)
    for g, (_, spans) in zip(gone, cases.covered(texts, length), strict=True):
        for start, stop in spans:
            g[start:stop] = b"\1" * (stop - start)
    return [bytes(x for x, y in zip(b, g, strict=True) if not y).decode("utf-8", "ignore") for b, g in zip(given, gone, strict=True)]


def test_a_repeated_passage_of_51_words_is_cut_however_short(spark):
    generator = random.Random(11)
    long, few = ([cases.words(generator, 1)[:5] for _ in range(n)] for n in (51, 50))
    assert len(" ".join(long).encode()) < 330
    around = [cases.words(generator, 12) for _ in range(9)]
    texts = [
        f"{around[0]} {' '.join(long)} {around[1]}", f"{around[2]}\n{'  '.join(long)} {around[3]}", " ".join(long),
        f"{around[4]} {' '.join(few)} {around[5]}", f"{around[6]} {' '.join(few)} {around[7]}", f"{'a ' * 60}{around[8]}",
    ]
    rows = corpus_pipeline.cut_repeats(spark, cases.documents(spark, texts).repartition(3), FOLDER).collect()
    assert {r.doc_id: r.text for r in rows} == dict(enumerate([
        f"{around[0]}  {around[1]}", f"{around[2]}\n {around[3]}", "", texts[3], texts[4], f" {around[8]}",
    ]))
    assert all(r.n_chars == len(r.text) for r in rows)


@pytest.mark.parametrize("seen", [500_000, 3])
def test_repeated_words_match_looking_at_every_place(spark, monkeypatch, seen):
    monkeypatch.setattr(suffix, "SEEN", seen)
    generator = random.Random(12)
    passages = [cases.words(generator, n).split() for n in (50, 51, 52, 90, 300)]
    texts = [*cases.awkward(), "la " * 80, "one " * 20, cases.words(generator, 70), "y" * 500, "y" * 500]
    for _ in range(40):
        passage = generator.choice(passages)
        start = generator.randrange(len(passage) // 3)
        texts.append(f"{cases.words(generator, generator.randint(0, 30))} {generator.choice([' ', chr(10)]).join(passage[start:] if generator.random() < 0.5 else passage)} {cases.words(generator, generator.randint(0, 30))}")
    texts += [texts[-1], texts[-1]]
    expected = without_repeated(texts)
    assert sum(map(len, expected)) < sum(len(b.decode("utf-8", "ignore")) for b, _ in cases.covered(texts))
    docs = cases.documents(spark, texts).withColumn("doc_id", F.when(F.col("doc_id") < len(texts) - 2, F.col("doc_id"))).repartition(3)
    rows = corpus_pipeline.cut_repeats(spark, docs, FOLDER).collect()
    assert sorted(((-1 if r.doc_id is None else r.doc_id), r.text or "") for r in rows) == sorted((i if i < len(texts) - 2 else -1, t) for i, t in enumerate(expected))


def test_repeated_words_of_a_table_without_long_texts(spark):
    docs = cases.documents(spark, ["a b", None, ""])
    assert {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, docs, FOLDER).collect()} == {0: "a b", 1: None, 2: ""}


def test_contaminated_rows_go_by_row_and_not_by_id(spark):
    item = table(spark, FOLDER, "benchmark").where("text IS NOT NULL").orderBy(F.desc(F.length("text"))).first().text
    rows = [(None, f"x {item}"), (None, "plain words"), (1, item), (1, "a clean text of the same id"), (2, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = corpus_pipeline.keep_clean(spark, docs, FOLDER)
    assert left.columns == docs.columns and sorted(map(str, map(tuple, left.collect()))) == sorted(map(str, [rows[i] for i in (1, 3, 4, 5)]))
