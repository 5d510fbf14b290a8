"""Resampling, pieces by rank and the divergence audit against plain Python."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from sondage.llm import divergence, piece_model, resample
from sondage.llm.tables import prepare
from tests.llm import cases

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def session(spark):
    prepare(spark)
    return spark


def long_texts(seed: int = 21) -> list[str]:
    generator = random.Random(seed)
    return [cases.words(generator, 4000), "x" * 40_000, " ".join(["same"] * 5000), "É, è-é ü b2b  B2B " * 30]


# ---- resampling -------------------------------------------------------------------------------


def grams_of(text, longest):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UPPER))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain_resample(rows, target, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    place = lambda gram: zlib.crc32(gram.encode()) % buckets
    both = [Counter(place(g) for t in texts for g in grams_of(t, longest)[1]) for texts in ([t for _, t in rows], target)]
    s, t = both
    total_s, total_t = sum(s.values()), sum(t.values())
    out = []
    for key, text in rows:
        words, grams = grams_of(text, longest)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in map(place, grams)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words) >= least])
    order = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(order[: len(order) * percent // 100], 1):
        row[4] = rank
    return sorted(map(str, (tuple(r[:5]) for r in out)))


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling_matches_plain_counts(session, longest):
    texts = [*cases.awkward(), *long_texts(), *cases.near_copies(5, 4, 6), *(cases.words(random.Random(i), 5 + i) for i in range(60))]
    target = [None, "", cases.near_copies(5, 1, 1)[0], "É, b2b"]
    docs = cases.documents(session, texts).withColumn("score", F.lit("own")).withColumn("rank", F.lit("own")).repartition(3)
    aims = session.createDataFrame(list(enumerate(target)), "item_id bigint, text string")
    found = resample.resample(docs, aims, longest=longest, buckets=997, percent=30)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(str, map(tuple, found.collect()))) == plain_resample(list(enumerate(texts)), target, longest, 997, percent=30)


def test_resampling_of_ties_null_keys_repeated_rows_and_nothing(session):
    generator = random.Random(6)
    texts = [cases.words(generator, 30) for _ in range(6)]
    rows = [(5, texts[0]), (5, texts[0]), (5, texts[0]), (None, texts[1]), (None, texts[1]), (7, None), (8, "few"), *((20 + i, t) for i, t in enumerate(texts))]
    docs = session.createDataFrame(rows, "doc_id bigint, text string")
    aims = session.createDataFrame([(1, texts[2])], "item_id bigint, text string")
    for percent in (100, 50, 0):
        found = resample.resample(docs, aims, percent=percent).collect()
        assert sorted(map(str, map(tuple, found))) == plain_resample(rows, [texts[2]], percent=percent)
    assert len(resample.resample(docs, aims.limit(0)).collect()) == len(rows)
    assert resample.resample(docs.limit(0), aims).count() == 0


def test_grams_of_one_hash_are_told_apart_by_their_bytes(monkeypatch):
    monkeypatch.setattr(resample.xxhash, "xxh64_intdigest", lambda gram: len(gram))
    grams = [w.encode() for w in cases.words(random.Random(7), 400).split()] * 3 + [b"", b"a"]
    table, expected = resample.Interned(grams, 101), Counter(grams)
    assert len(table.used) == len(expected)
    for gram, slot in zip(grams, table.slot, strict=True):
        assert grams[table.owner[slot]] == gram and table.count[slot] == expected[gram] and table.bucket[slot] == zlib.crc32(gram) % 101
    assert table.per_bucket(101).sum() == len(grams)
    assert len(resample.Interned([], 101).used) == 0


def test_parts_of_a_text_have_all_its_grams_once():
    text = (cases.words(random.Random(8), 300) + " " + "y" * 500 + " tail").encode()
    whole = Counter(g for batch, _, _ in resample.batches_of([text, b"", text], 3) for g in batch)
    given, resample.stretches.__defaults__ = resample.stretches.__defaults__, (64,)
    try:
        parts = list(resample.batches_of([text, b"", text], 3))
    finally:
        resample.stretches.__defaults__ = given
    assert Counter(g for batch, _, _ in parts for g in batch) == whole
    assert sum(w for _, _, w in parts).tolist() == [302, 0, 302]


# ---- pieces -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_the_serialised_model_is_a_model_of_the_library():
    model = sentencepiece.SentencePieceProcessor(model_proto=piece_model.serialise(piece_model.read_ranks(RANKS)))
    assert model.get_piece_size() == 50_257 and model.unk_id() == 50_256
    assert [model.get_score(i) for i in (0, 1, 40_000)] == [0, -1, -40_000]


def test_pieces_agree_with_the_rank_library_on_random_text(library):
    own, generator = piece_model.PieceCodec(piece_model.serialise(piece_model.read_ranks(RANKS)), public_tokenizers.PATTERN), random.Random(9)
    parts = [" ", "  ", "\n", "\t", "a", "the", "ing", "12", "3", ".", "!", "é", "ñ", "日本", "'s", "\x1c", "\x85", "　", "<|endoftext|>", " the", "aaaa", "🙂", "و", "\x00", "▁", "Ġ", "<\x01unknown\x01>"]
    texts = ["".join(generator.choice(parts) for _ in range(generator.randint(0, 40))) for _ in range(1500)]
    for text in [*texts, "ab" * 20_000, "é" * 3000, *(t for t in cases.awkward() if t)]:
        ids = library.encode_ordinary(text)
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids, text
        assert own.decode(own.encode(text)) == text.encode()


def test_every_token_of_the_vocabulary_stands_for_itself(library):
    own = piece_model.PieceCodec(piece_model.serialise(piece_model.read_ranks(RANKS)), public_tokenizers.PATTERN)
    for token in own.bytes_of:
        try:
            text = token.decode()
        except UnicodeDecodeError:
            continue
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_a_whole_token_that_no_merges_lead_to_and_few_remembered_words(monkeypatch):
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"de": 257}
    own = piece_model.PieceCodec(piece_model.serialise(ranks), r"\w+|\W+")
    monkeypatch.setattr(piece_model, "REMEMBERED", 3)
    monkeypatch.setattr(piece_model, "LONGEST", 4)
    monkeypatch.setattr(piece_model, "STRETCH", 8)
    plain = tiktoken.Encoding("own", pat_str=r"\w+|\W+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abc", "abcd", "abc abc de dede abcde", "x" * 40, "a b c d e f g h " * 5):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == plain.encode_ordinary(text)
    assert len(own.ids) <= 3 + 8 and all(len(t) <= 4 for t in own.ids)


def test_vocabularies_with_gaps_or_without_some_byte_are_refused():
    every = {bytes([b]): b for b in range(256)}
    for ranks in (every | {b"ab": 300}, {t: i - 1 for t, i in every.items() if i}):
        with pytest.raises(ValueError, match="ranks"):
            piece_model.serialise(ranks)


def test_round_trip_of_whole_tables(session, library):
    texts = [*cases.awkward(), *long_texts(), "twice", "twice"]
    docs = cases.documents(session, texts).withColumn("decoded", F.lit(1)).withColumn("token_ids", F.lit(2))
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    rows = {r.doc_id or 0: r for r in piece_model.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert (rows[i].n_tokens, rows[i].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert rows[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert piece_model.round_trip(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    model = piece_model.serialise(piece_model.read_ranks(RANKS))
    encoded = piece_model.encode(docs, model, public_tokenizers.PATTERN)
    both = piece_model.decode(encoded, model, public_tokenizers.PATTERN)
    assert sorted(both.columns) == sorted(docs.columns) and both.where("decoded <> CAST(coalesce(text, '') AS BINARY)").count() == 0


# ---- divergence -------------------------------------------------------------------------------


def plain_audit(rows, least=10, places=10):
    rows = [((lang or ""), (source or ""), re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(UPPER))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        kept = sorted(t for t, n in Counter(t for r in own for t in set(r[2])).items() if n >= least)
        counts = {s: Counter(t for r in own if r[1] == s for t in r[2]) for s in {r[1] for r in own}}

        def shares(found, kept=kept):
            total = sum(found[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1_000_000_000 * (found[t] + 2) // total for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(sum(counts.values(), Counter()))
        far = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            others = sorted(((-sum(far(p[s][t], p[o][t]) for t in kept), o.encode()) for o in counts if o != s))
            terms = sorted((-far(p[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t])[:places]
            for part, listed in (("pair", others), ("term", terms)):
                out += [(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(listed, 1)]
    return sorted(out)


def audit_rows() -> list[tuple]:
    generator, rows = random.Random(10), []
    vocabulary = [cases.words(generator, 1) for _ in range(40)] + ["naïve", "日本", "ＡＢ", "Zed"]
    marks = ["", ",", ".", "!", "-x", "1", " y", "'s"]
    for i in range(260):
        words = [generator.choice(vocabulary[: 5 + i % 40]) + generator.choice(marks) for _ in range(generator.randint(0, 25))]
        text = generator.choice([" ", "\n", "  ", "\x0b"]).join(w.upper() if generator.random() < 0.2 else w for w in words)
        rows.append((generator.choice(["en", "de", "en", None]), generator.choice(["s1", "s1", "s2", "é", None, ""]), text))
    # A term in ten documents of a language, each time in another chunk; one in nine; a language of its own.
    rows += [("xx", f"s{i % 3}", f"edge{i}edge {i}almost" if i < 9 else f"edge{i}") for i in range(10)]
    rows += [("xx", "s0", "repeat repeat, repeat.")] * 10
    rows += [("yy", "s1", None), ("yy", "s2", ""), ("yy", "s3", "1 2 3"), ("zz", "alone", "a b"), ("en", "empty", None), (None, None, None), ("en", "s1", "x" * 3000)]
    return rows


@pytest.mark.parametrize("few", [False, True])
def test_audit_matches_plain_counts(session, monkeypatch, few):
    for name, value in (("COUNTED", 5), ("MERGED", 2)) if few else ():
        monkeypatch.setattr(divergence, name, value)
    rows = audit_rows()
    docs = session.createDataFrame([(*r, "own", 1) for r in rows], "lang string, source string, text string, term string, n int").repartition(5)
    found = divergence.audit(docs)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == plain_audit(rows)
    assert sorted(map(tuple, divergence.audit(docs, least=3, places=2).collect())) == plain_audit(rows, 3, 2)


def test_audit_of_nothing_and_of_one_source(session):
    docs = session.createDataFrame([("en", "s", "a b")] * 12, "lang string, source string, text string")
    assert divergence.audit(docs.limit(0)).count() == 0
    # Its only source has the shares of its language.
    assert divergence.audit(docs).count() == 0


def test_counts_are_merged_by_chunk_and_language_in_any_order():
    documents = [("en", 1, "x y x"), ("en", 2, "y"), ("de", 1, "x"), ("en", 1, "x z"), ("en", 2, "x")]

    def counted(numbers):
        out = divergence.Counted()
        for number in numbers:
            lang, source, text = documents[number]
            out.add(number, lang, source, Counter(text.encode().split()))
        return out.merged(3)

    def shown(batch):
        return sorted((r["lang"], r["chunk"], r["docs"], sorted(np.frombuffer(r["ids"], "<i8")), np.frombuffer(r["own"], "<i8").tolist()) for r in batch.to_pylist())

    expected = [("de", b"x", 1, [2], [1, 1]), ("en", b"x", 3, [], [1, 3, 2, 1]), ("en", b"y", 2, [0, 1], [1, 1, 2, 1]), ("en", b"z", 1, [3], [1, 1])]
    assert shown(counted(range(5))) == expected
    for parts in ([[0], [1], [2], [3], [4]], [[4, 2], [0, 1, 3]]):
        table = pa.Table.from_batches([counted(p) for p in parts])
        assert shown(divergence.merge(table.sort_by("chunk"), 3)) == expected


def test_chunks_of_a_long_text_are_those_of_its_parts():
    text = "\n".join(["One  two", "x" * 90, "three\tone", "é è"] * 40).encode()
    assert divergence.chunks_of(text, 37) == divergence.chunks_of(text) == Counter(text.lower().split())


def test_numbers_of_rows_are_read_as_they_lie():
    rows = [np.arange(k, dtype=np.int64).tobytes() for k in (2, 0, 3, 1)]
    column = pa.array(rows, pa.binary())
    for part, numbers in ((column, [0, 1, 0, 1, 2, 0]), (column.slice(1, 2), [0, 1, 2]), (column.slice(1, 1), []), (column.slice(4), [])):
        values, sizes = divergence.unpacked(part)
        assert values.tolist() == numbers
        assert sizes.tolist() == [len(r.as_py()) for r in part]
    values, _ = divergence.unpacked(column.slice(2))
    assert np.shares_memory(values, np.frombuffer(column.cast(pa.large_binary()).buffers()[2], np.int64))


def test_chunks_that_share_a_hash_may_come_in_several_rows(session, monkeypatch):
    real = divergence.F.xxhash64
    monkeypatch.setattr(divergence, "MERGED", 2)
    monkeypatch.setattr(divergence.F, "xxhash64", lambda *c: divergence.F.lit(7).cast("bigint") if isinstance(c[0], str) else real(*c))
    rows = audit_rows()
    docs = session.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    assert sorted(map(tuple, divergence.audit(docs).collect())) == plain_audit(rows)
