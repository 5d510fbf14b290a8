import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from sondage.llm import embeddings, language_model, quality, toxicity, urls
from sondage.llm.components import components
from sondage.llm.tables import prepare
from tests.llm import cases


@pytest.fixture(scope="module")
def session(spark):
    prepare(spark)
    return spark


def test_components_of_paths_stars_and_loops(session):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (300, 200), (200, 300), (300, 250)]
    found = {r.node: r.component for r in components(session.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, **{i: 200 for i in (200, 250, 300)}}
    assert components(session.createDataFrame([], "a bigint, b bigint")).count() == 0


def vector_rows(size: int) -> list[tuple]:
    generator, rows = np.random.default_rng(3), []
    for group in range(12):
        base = generator.normal(size=size)
        for _ in range(9):
            rows.append((len(rows), (base + generator.normal(size=size) * generator.choice([0, 0.05, 0.12, 0.15, 0.3])).tolist(), group % 2))
    rows += [(len(rows) + i, v, label) for i, (v, label) in enumerate([
        (None, 0), ([0.0] * size, 0), ([float("nan")] + [1.0] * (size - 1), 0), ([None] + [1.0] * (size - 1), 0), ([1e200] * size, 0),
        ([1e-200] * size, 0), (rows[0][1], None), (rows[0][1], None), ([1.0] * (size // 2), 0), ([], 0), ([float("inf")] * size, 0),
    ])]
    return rows


@pytest.mark.parametrize(("size", "tile"), [(64, 2048), (13, 2048), (64, 8)])
def test_vectors_match_comparing_all_pairs(session, monkeypatch, size, tile):
    monkeypatch.setattr(embeddings, "TILE", tile)
    rows = vector_rows(size)
    given = session.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    links, groups = Counter(), cases.Groups([r[0] for r in rows])

    def unit(vector):
        if not vector or any(x is None or not np.isfinite(x) for x in vector) or not any(vector):
            return None
        scaled = np.array(vector) / max(map(abs, vector))
        return scaled / np.linalg.norm(scaled)

    units = {i: unit(v) for i, v, _ in rows}
    for k, (j, _, b) in enumerate(rows):
        for i, _, a in rows[:k]:
            if a is not None and a == b and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.98:
                links.update((i, j))
                groups.join(i, j)
    found = embeddings.near_duplicates(given).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == {i: (links[i], groups.root(i)) for i, _, _ in rows}
    assert all(r.kept == (r.vec_id == r.component_id) for r in found) and sum(links.values()) > 100


@pytest.mark.parametrize(("size", "dims", "reach"), [(1, 8, 0.1), (300, 8, 0.3), (500, 2, 0.05), (400, 3, 5.0)])
def test_pairs_within_reach_match_comparing_all(monkeypatch, size, dims, reach):
    monkeypatch.setattr(embeddings, "SLICE", 1000)
    points = np.random.default_rng(5).normal(size=(size, dims)) / 8
    points[size // 2 : size // 2 + 30] = points[0]
    found = np.concatenate([np.stack(p) for p in embeddings.close(points, reach)], axis=1)
    gaps = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    expected = np.stack(np.nonzero(np.triu(gaps <= reach * reach, 1)))
    assert sorted(zip(*found.tolist(), strict=True)) == list(zip(*expected.tolist(), strict=True))
    assert (np.sort(embeddings.decoded(embeddings.encoded(found, size), size)) == np.sort(found)).all()


def test_unrelated_vectors_are_hardly_compared(monkeypatch):
    points, pairs = np.random.default_rng(6).normal(size=(2000, 8)) / 8, []
    einsum = np.einsum
    monkeypatch.setattr(embeddings.np, "einsum", lambda spec, a, b: pairs.append(len(a)) or einsum(spec, a, b))
    list(embeddings.close(points, 0.0708))
    assert sum(pairs) < 2000 * 1999 / 2 / 50


def test_vectors_of_null_keys_and_nothing(session):
    rows = [(None, [1.0, 2.0], 1), (5, [1.0, 2.0], 1), (5, [1.0, 2.0], 1)]
    given = session.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    found = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(given).collect())
    assert found == [(0, 2, None, True), (5, 2, 5, True), (5, 2, 5, True)]
    assert embeddings.near_duplicates(given.limit(0)).count() == 0


def labelled(session, seed: int, bad):
    """Plain texts and spoilt ones, two thirds of them with labels."""
    generator, rows, labels = random.Random(seed), [], []
    for i in range(700):
        text, spoilt = cases.words(generator, generator.randint(20, 120)), generator.random() < 0.2
        rows.append(bad(generator, text) if spoilt else text)
        labels.append((i, spoilt))
    return cases.documents(session, [*rows, *cases.awkward()]), labels


def held_out(folds: int, rest: int, i: int) -> bool:
    return zlib.crc32(str(i).encode()) % folds == rest


def test_quality_is_learned_from_positives_alone(session, monkeypatch):
    docs, spoilt = labelled(session, 11, lambda g, t: " ".join(w.upper() + "!!" for w in t.split()) if g.random() < 0.5 else " ".join([t.split()[0]] * 40))
    labels = session.createDataFrame([(i, int(not s)) for i, s in spoilt if i % 3], "doc_id bigint, quality int")
    judged = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert len(judged) == 700 + len(cases.awkward()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in judged.values())
    assert all(r.held_out == held_out(5, 0, i) for i, r in judged.items())
    assert sum(judged[i].predicted == (not s) for i, s in spoilt if judged[i].held_out or not i % 3) / sum(judged[i].held_out or not i % 3 for i, _ in spoilt) > 0.95
    # Labels of the held-out fold change nothing.
    turned = session.createDataFrame([(i, int(s) if held_out(5, 0, i) else int(not s)) for i, s in spoilt if i % 3], "doc_id bigint, quality int")
    assert {r.doc_id: r.score for r in quality.judge(docs, turned).collect()} == {i: r.score for i, r in judged.items()}


def test_quality_without_labels_or_documents(session):
    docs = cases.documents(session, cases.awkward())
    none = session.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in quality.judge(docs, none).collect()} == {0.5}
    assert quality.judge(docs.limit(0), none).count() == 0


def test_toxicity_generalises_to_held_out_texts(session):
    stems = ["loser", "pathet", "grunzig"]

    def insult(generator, text):
        parts = text.split()
        parts.insert(generator.randrange(len(parts)), generator.choice(stems) + generator.choice(["", "ic", "en", "s"]))
        return " ".join(parts)

    docs, toxic = labelled(session, 12, insult)
    labels = session.createDataFrame([(i, int(s)) for i, s in toxic], "doc_id bigint, toxic int")
    judged = {r.doc_id: r for r in toxicity.judge(docs, labels).collect()}
    assert len(judged) == 700 + len(cases.awkward()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in judged.values())
    assert all(r.held_out == held_out(3, 1, i) for i, r in judged.items())
    unseen = [(judged[i].predicted, s) for i, s in toxic if judged[i].held_out]
    assert sum(p == s for p, s in unseen) / len(unseen) > 0.93
    none = session.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.judge(docs, none).collect()} == {0.0}
    assert toxicity.judge(docs.limit(0), labels).count() == 0


def test_language_model_counts_base_and_better_scores(session):
    generator = random.Random(13)
    lexicons = [[cases.words(generator, 1) + end for _ in range(60)] for end in ("ing", "cion")]
    texts = [" ".join(generator.choice(lexicons[i % 2]) for _ in range(generator.randint(5, 60))) for i in range(300)]
    texts += [*cases.awkward(), texts[0]]
    docs = cases.documents(session, texts).repartition(3)
    counts, tokens = Counter(), [cases.fold(t) + [None] for t in texts]
    for i, own in enumerate(tokens):
        if not held_out(5, 1, i):
            counts.update(own)
    total, distinct = sum(counts.values()), len(counts)
    rows = {r.doc_id: r for r in language_model.scores(docs).collect()}
    for i, own in enumerate(tokens):
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out(5, 1, i), len(own), sum(counts[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(sum(np.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own))
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.1 * sum(r.n_tokens for r in held)
    again = {r.doc_id: r.score for r in language_model.scores(docs.coalesce(1)).collect()}
    assert again == pytest.approx({i: r.score for i, r in rows.items()})
    assert language_model.scores(docs.limit(0)).count() == 0


def test_binomial_draws_have_the_mean_and_variance_of_tries():
    generator = np.random.default_rng(1)
    for n, p in [(1, 0.3), (20, 0.05), (50, 0.97), (400, 0.5), (5000, 0.2)]:
        u, v = generator.random((2, 40_000))
        drawn = language_model.binomial(np.full(40_000, n), np.full(40_000, p), u, v)
        assert abs(drawn.mean() - n * p) < 0.02 * max(n * p, 1) and abs(drawn.var() / (n * p * (1 - p)) - 1) < 0.05
        assert drawn.min() >= 0 and drawn.max() <= n


def test_tables_are_as_many_as_when_customers_sit_one_by_one():
    generator, discount = random.Random(4), 0.6
    for count, fresh in [(2, 0.5), (40, 3.0), (900, 0.2), (900, 40.0)]:
        rows = []
        for _ in range(400):
            tables = 0
            for sitting in range(count):
                tables += not sitting or generator.random() < fresh / (fresh + sitting - discount * tables)
            rows.append(tables)
        names = np.arange(4000, dtype=np.uint64)
        found = language_model.seat(np.full(4000, count), np.full(4000, fresh), discount, (names, 3))
        assert abs(found.mean() / np.mean(rows) - 1) < 0.06 and found.max() <= count


class Restaurants:
    """Customers of every context at tables of their own, moved one at a time; the plain form of the model."""

    def __init__(self, tokens: list[tuple[int, bytes]], seed: int):
        self.random, self.tokens = random.Random(seed), tokens
        pairs = Counter(tokens)
        served = Counter(word for _, word in pairs)
        self.words = len(served)
        ones = [sum(n == k for n in counts.values()) for counts in (pairs, served) for k in (1, 2)]
        share = lambda one, two: min(max(one / (one + 2 * two) if one else 0.5, 0.05), 0.95)
        self.discounts = share(*ones[:2]), share(*ones[2:])
        self.tables, self.parent = {}, {}
        self.sizes = [Counter(), Counter()]  # customers, tables of each context; None is the parent
        for token in tokens:
            self.sit(*token)

    def top(self, word) -> float:
        own, (c, t) = self.parent.get(word, []), (self.sizes[0][None], self.sizes[1][None])
        return (sum(own) - self.discounts[1] * len(own) + (1 + self.discounts[1] * t) / (self.words + 1)) / (1 + c)

    def chance(self, context, word) -> float:
        own = self.tables.get((context, word), [])
        rest = (1 + self.discounts[0] * self.sizes[1][context]) * self.top(word)
        return (sum(own) - self.discounts[0] * len(own) + rest) / (1 + self.sizes[0][context])

    def join(self, rows: list, where, discount: float, above: float) -> bool:
        weights = [n - discount for n in rows] + [(1 + discount * self.sizes[1][where]) * above]
        at = self.random.choices(range(len(weights)), weights)[0]
        self.sizes[0][where] += 1
        if at < len(rows):
            rows[at] += 1
            return False
        rows.append(1)
        self.sizes[1][where] += 1
        return True

    def leave(self, rows: list, where) -> bool:
        at = self.random.choices(range(len(rows)), rows)[0]
        rows[at] -= 1
        self.sizes[0][where] -= 1
        if rows[at]:
            return False
        del rows[at]
        self.sizes[1][where] -= 1
        return True

    def sit(self, context, word) -> None:
        if self.join(self.tables.setdefault((context, word), []), context, self.discounts[0], self.top(word)):
            self.join(self.parent.setdefault(word, []), None, self.discounts[1], 1 / (self.words + 1))

    def sweep(self) -> None:
        for context, word in self.tokens:
            if self.leave(self.tables[context, word], context):
                self.leave(self.parent[word], None)
            self.sit(context, word)


def test_language_model_scores_are_near_an_exact_sampler(session):
    generator = random.Random(8)
    names = [f"word{i}" for i in range(60)] + list("abcdef")
    texts = {i: " ".join(generator.choices(names, [1 / (k + 1) for k in range(len(names))], k=40)) for i in range(120)}
    docs = session.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r.doc_id: r for r in language_model.scores(docs).collect()}

    def tokens(text):
        words = [*text.encode().split(), b"\n"]
        numbers = [0, *(language_model.word_number(w) % language_model.CONTEXTS for w in words)]
        return list(zip(numbers, words, strict=False))

    learned = [t for i, text in texts.items() if zlib.crc32(str(i).encode()) % 5 != 1 for t in tokens(text)]
    model, chances = Restaurants(learned, 1), Counter()
    every = {t for text in texts.values() for t in tokens(text)}
    for turn in range(16):
        model.sweep()
        if turn >= 4:
            for token in every:
                chances[token] += model.chance(*token) / 12
    for held in (True, False):
        rows = [i for i in texts if found[i].held_out == held]
        own = sum(found[i].score for i in rows)
        exact = sum(np.log10(chances[t]) for i in rows for t in tokens(texts[i]))
        assert abs(own - exact) / (41 * len(rows)) < 0.01, (held, own, exact)


def test_language_model_tokens_are_those_of_plain_words():
    generator = random.Random(12)
    marks = b" \t\n\r\x0b\x0c\x00\x1c\x85\xa0\xc3\xa9AZazbcdef"
    odd = [bytes(generator.choice(marks) for _ in range(generator.randint(0, 30))) for _ in range(500)]
    for texts in ([(t or "").encode() for t in cases.awkward()], odd, [b""], [b" ", b"a"]):
        found = language_model.Tokens.of(texts)
        numbers, contexts = [], []
        for text in texts:
            own = [language_model.word_number(w) for w in text.lower().split()]
            numbers += [*own, language_model.END]
            contexts += [language_model.END, *(n % language_model.CONTEXTS for n in own)]
        assert found.numbers[found.place].tolist() == numbers
        assert found.context.tolist() == contexts
        assert found.sizes.tolist() == [len(t.split()) + 1 for t in texts]
        # Each distinct word is hashed once.
        assert len(found.numbers) == len({w for t in texts for w in t.lower().split()}) + 1


def test_language_model_predictions_sum_to_one():
    totals = language_model.Totals(np.array([30, 10]), np.array([4, 3]), 5, 6, 0.5, 0.4)
    tables, seated = np.array([2, 2, 3]), np.array([2, 1, 2])
    parent = np.r_[totals.parent(tables, seated), totals.parent(np.zeros(1), np.zeros(1))]
    assert totals.parent(np.array([2, 2, 3]), np.array([2, 1, 2])).sum() < 1 < parent.sum() + 7 * parent[-1]


def test_repeated_rows_share_language_scores(session):
    docs = session.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "a b"), (None, "a")], "doc_id bigint, text string")
    rows = [(r.n_known, r.train_tokens, round(r.base_score, 9)) for r in language_model.scores(docs).collect() if r.doc_id == 1]
    assert len(rows) == 2 and len(set(rows)) == 1


URLS = [
    None, "", "no scheme", "http://", "http://a.example.com/en/x", "HTTP://WWW.Example.COM/en/", "https://www.example.com/de/", "x://example.com",
    "http://net/es/1", "http://sub.net/fr/?q=/es/", "http://anet/es/", "http://example.com?/en/", "http://b.com/en/#x", "a://b://c.net/fr/x", "http://example.com/en",
    "http://x.net:80/es/", "http://net./es/", "http://com/",
]


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_urls_match_trying_every_rule(session):
    from sondage.llm.queries import URL_RULES

    rules = [*URL_RULES, ("org", "/a", "block"), ("x.org", "/", "allow"), ("org", "", "allow")]
    given = [*URLS, "http://x.org/ab", "http://y.org/ab", "http://y.org", "http://x.org/ab"]
    pages = session.createDataFrame([(i, u, "html", "old") for i, u in enumerate(given)], "page_id bigint, url string, html string, host string")
    rows = urls.judge(pages, urls.rule_table(session, tuple(rules))).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows} == {i: plain_verdict(u, rules) for i, u in enumerate(given)}
    twice = urls.judge(pages.unionAll(pages), urls.rule_table(session, tuple(rules)))
    assert twice.count() == 2 * len(given)
    assert urls.judge(pages.limit(0), urls.rule_table(session, tuple(rules))).count() == 0
    assert {r.verdict for r in urls.judge(pages, urls.rule_table(session, tuple(rules)).limit(0)).collect()} == {"allow"}


@pytest.mark.parametrize(("operator", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_rows_without_an_id_are_judged_and_not_held_out(session, operator, label):
    docs = session.createDataFrame([(None, "some words"), (1, None), (2, "")], "doc_id bigint, text string")
    labels = session.createDataFrame([], f"doc_id bigint, {label} int")
    rows = operator.judge(docs, labels).collect()
    assert len(rows) == 3 and all(isinstance(r.held_out, bool) and 0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]


def test_language_model_packets_are_small_and_numbers_come_back():
    for values in (np.empty(0, np.int64), np.array([7, 1 << 60, 3], np.uint64), np.array([True, False]), np.arange(70_000, dtype=np.uint16), np.array([0.5, -3.25])):
        back = language_model.unpacked(language_model.packed(values), values.dtype)
        assert back.dtype == values.dtype and back.tolist() == values.tolist()
        if values.dtype.kind == "u":
            assert np.cumsum(language_model.steps(values), dtype=values.dtype).tolist() == values.tolist()
    generator = random.Random(11)
    texts = [cases.words(generator, 60).encode() for _ in range(2_000)]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array([i % 5 > 0 for i in range(len(texts))]), pa.array(texts)], names=["row", "learn", "t"])
    out = pa.Table.from_batches(language_model.deal(SimpleNamespace(value=np.empty(0, np.uint64)), 3)(iter([batch])))
    tokens = sum(len(language_model.unpacked(c, np.uint16)) for c in out["contexts"].to_pylist())
    assert tokens == 61 * len(texts) and sum(len(b) for c in ("counts", "contexts", "texts") for b in out[c].to_pylist()) < 4 * tokens
