"""The language model's contexts are words, its customers sit one by one, and no result depends on the layout."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from sondage.llm import language_model
from sondage.llm.tables import prepare
from tests.llm import cases


@pytest.fixture(scope="module")
def session(spark):
    prepare(spark)
    return spark


def held_out(i: int) -> bool:
    return zlib.crc32(str(i).encode()) % language_model.FOLDS == language_model.HELD_OUT


def test_words_are_predicted_from_the_very_word_before(session):
    # All of one class, by their ending; the text of wrong followers has the same words and classes as the other.
    before, after = ["walking", "talking", "singing", "ringing"], ["north", "south", "river", "stone"]
    assert len({language_model.word_number(w.encode()) % language_model.CONTEXTS for w in before}) == 1
    generator, unseen = random.Random(5), [i for i in range(1000) if held_out(i)][:2]
    texts = {i: " ".join(f"{before[k]} {after[k]}" for k in generator.choices(range(4), k=20)) for i in range(60) if not held_out(i)}
    order = [*range(4)] * 5
    texts |= {unseen[0]: " ".join(f"{before[k]} {after[k]}" for k in order), unseen[1]: " ".join(f"{before[k]} {after[(k + 1) % 4]}" for k in order)}
    found = {r.doc_id: r for r in language_model.scores(session.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    right, wrong = (found[i] for i in unseen)
    assert right.held_out and wrong.held_out and right.base_score == pytest.approx(wrong.base_score)
    assert right.score > wrong.score + 20 and right.score > right.base_score + 20


@pytest.mark.parametrize("more", [0.0, 0.4])
def test_customers_sit_one_by_one_however_many_there_are(more):
    names = np.arange(12, dtype=np.uint64)
    count, fresh = np.array([0, 1, 2, 63, 64, 65, 66, 300, 1000, 5000, 20_000, 20_000]), np.array([1, 1, 0.5, 2, 2, 2, 30, 0.1, 9, 200, 0.01, 3000.0])
    found = language_model.seat(count, fresh, 0.7, (names, 3), more)
    for name, n, weight, tables in zip(names, count, fresh, found, strict=True):
        u = language_model.uniform(language_model.named(name, 3), np.arange(max(n, 1)))
        plain = min(n, 1)
        for sitting in range(1, n):
            opens = weight + more * plain
            plain += u[sitting] * (opens + sitting - 0.7 * plain) < opens
        assert tables == plain, (name, n)


def test_language_scores_do_not_depend_on_how_the_work_is_dealt_out(session, monkeypatch):
    generator = random.Random(3)
    names = [cases.words(generator, 1) + end for end in ("ing", "cion", "") for _ in range(40)]
    texts = [" ".join(generator.choices(names, [1 / (k + 1) for k in range(len(names))], k=generator.randint(1, 80))) for _ in range(200)]
    docs = cases.documents(session, [*texts, *cases.awkward(), texts[0]])

    def rows(table):
        return sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in language_model.scores(table).collect())

    expected = rows(docs.coalesce(1))
    for share, tokens in ((1 / 60, 900), (2.0, 2000)):
        monkeypatch.setattr(language_model, "HOT_SHARE", share)
        monkeypatch.setattr(language_model, "SHARD_TOKENS", tokens)
        assert rows(docs.repartition(3)) == expected
