import glob
import hashlib
import json
import random
import threading
import weakref
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from sondage.llm import bpe, decontaminate, minhash, suffix, tables, token_files
from sondage.llm.tables import finished, prepare, stored, tiles
from sondage.session import scratch_path
from tests.llm import cases

TOKENIZER = path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def session(spark):
    prepare(spark)
    return spark


def test_codec_agrees_with_the_library_on_random_text():
    own, library, generator = bpe.codec(bpe.definition(TOKENIZER)), Tokenizer.from_file(TOKENIZER), random.Random(2)
    parts = [" ", "  ", "\n", "\t", "a", "the", "ing", "12", "3", ".", "!", "é", "ñ", "日", "'s", "'ll", "\x1c", "\x85", "\u3000", "<|endoftext|>", " the", "aaaa", "🙂"]
    texts = ["", *("".join(generator.choice(parts) for _ in range(generator.randint(1, 40))) for _ in range(1500))]
    for text in [*texts, "ab" * 5000, *(t for t in cases.awkward() if t)]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids, text
        assert own.decode(own.encode(text)) == library.decode(ids, skip_special_tokens=False)


def test_encode_and_decode_whole_tables(session):
    texts = [*cases.awkward(), cases.words(random.Random(3), 30_000), "twice", "twice"]
    library = Tokenizer.from_file(TOKENIZER)
    docs = cases.documents(session, texts)
    rows = {r.doc_id: r for r in bpe.round_trip(docs, TOKENIZER).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert (rows[i].n_tokens, rows[i].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert rows[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    both = bpe.decode(bpe.encode(docs, TOKENIZER), TOKENIZER)
    assert set(docs.columns) < set(both.columns) and both.where("decoded <> coalesce(text, '')").count() == 0
    assert bpe.round_trip(docs.limit(0), TOKENIZER).count() == 0


def test_round_trip_takes_one_worker_a_task_and_encodes_words_once_whatever_mark_follows(session):
    docs = cases.documents(session, [*cases.awkward(), "one two"])
    plan = bpe.round_trip(docs, TOKENIZER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan
    one, two = bpe.encode_and_decode(docs, TOKENIZER), bpe.decode(bpe.encode(docs, TOKENIZER), TOKENIZER).select("doc_id", "token_ids", "decoded")
    assert one.schema["doc_id"] == docs.schema["doc_id"] and one.exceptAll(two).count() == two.exceptAll(one).count() == 0
    own, encoded = bpe.Codec(bpe.definition(TOKENIZER)), []
    inner = own.encode_piece
    own.encode_piece = lambda piece: encoded.append(piece) or inner(piece)
    own.encode("see unhousely unhousely, unhousely. unhousely")
    assert encoded.count(" unhousely") == 1
    ids = [own.encode(t) for t in ("", "é", "a b", "")]
    assert own.decode_all(ids) == ["", "é", "a b", ""] and own.decode_all([]) == [] and own.decode(b"") == ""
    with pytest.raises((KeyError, IndexError)):
        own.decode(np.array([1 << 20], "<u4").tobytes())


def test_minhash_groups_match_comparing_all_pairs(session):
    texts = [*cases.awkward(), *cases.near_copies(), *cases.near_copies(2, 2, 30), "one", "a b c d e", "A B c d e"]
    expected = cases.near_duplicate_groups(dict(enumerate(texts)))
    rows = minhash.near_duplicates(cases.documents(session, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows) and len(rows) == len(texts)


def test_tasks_give_memory_back_when_their_own_tables_are_gone(monkeypatch):
    held, gone = weakref.WeakSet(), []
    monkeypatch.setattr(tables, "give_back", lambda: gone.append(len(held)))

    class Numbers(dict):
        __hash__ = object.__hash__

    @tables.tidy
    def task(batches):
        numbers = Numbers()
        held.add(numbers)
        for _ in tables.pieces(batches, "t"):
            yield len(held)

    batch = pa.record_batch([pa.array([b"one"])], names=["t"])
    assert list(task(iter([batch]))) == [1] and gone == [1, 0]
    for run in (suffix.cut_blocks, suffix.compare_blocks, minhash.links_across(minhash.AT_85)):
        gone.clear()
        assert list(run(iter([]))) == [] and gone and gone[-1] == 0


def test_minhash_of_null_keys_repeated_rows_and_nothing(session):
    text = cases.words(random.Random(4), 50)
    docs = session.createDataFrame([(None, text), (3, text), (3, text), (1, text)], "doc_id bigint, text string")
    rows = sorted((r.doc_id or 0, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert rows == [(0, None, True), (1, 1, True), (3, 1, False), (3, 1, False)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_minhash_of_different_texts_under_one_key_whatever_their_order(session):
    generator = random.Random(6)
    first, second = cases.words(generator, 60), cases.words(generator, 60)
    near = f"{second} more"
    for given in ([(1, first), (1, second), (2, near)], [(2, near), (1, second), (1, first)], [(1, second), (1, first), (2, near)]):
        docs = session.createDataFrame(given, "doc_id bigint, text string").coalesce(1)
        rows = minhash.near_duplicates(docs).collect()
        assert sorted((r.doc_id, r.component_id, r.kept) for r in rows) == [(1, 1, True), (1, 1, True), (2, 1, False)]
        kept = sorted((r.key, r.first) for r in minhash.groups(docs).collect())
        assert kept == [(1, True), (1, True), (2, False)]


def test_stored_tables_of_threads_and_of_failed_operators(session):
    def held(label):
        return set(glob.glob(f"{urlparse(scratch_path(session, label)).path.rsplit('/', 1)[0]}/*"))

    @finished
    def slow(table, label, fails=False):
        inner = stored(table, f"{label}-inner")
        meeting.wait()
        if fails:
            raise ArithmeticError
        return inner.selectExpr("id + 1 AS id")

    meeting, before = threading.Barrier(3), held("before")
    with ThreadPoolExecutor(3) as pool:
        runs = [pool.submit(slow, session.range(5), f"thread{i}", i == 2) for i in range(3)]
        assert [sorted(r.id for r in run.result().collect()) for run in runs[:2]] == [[1, 2, 3, 4, 5]] * 2
        with pytest.raises(ArithmeticError):
            runs[2].result()
    left = held("after") - before
    assert len([p for p in left if "slow" in p]) == 2 and not [p for p in left if "inner" in p]


def test_tiles_bring_every_pair_together_once(session):
    rows = session.range(50).selectExpr("id % 2 AS g", "id")
    dealt = [r.asDict() for r in tiles(rows, ["g"], "id", 7).collect()]
    met = []
    for tile in {(r["g"], r["tile_i"], r["tile_j"]) for r in dealt}:
        own = [r for r in dealt if (r["g"], r["tile_i"], r["tile_j"]) == tile]
        left, right = [r["id"] for r in own if r["side"] == 0], [r["id"] for r in own if r["side"] == 1]
        met += [(min(a, b), max(a, b)) for a in left for b in right] if tile[1] < tile[2] else [(a, b) for a in left for b in left if a < b]
    assert sorted(met) == sorted((a, b) for a in range(50) for b in range(a + 1, 50) if a % 2 == b % 2)


def repeats() -> list[str | None]:
    generator = random.Random(5)
    passage = cases.words(generator, 110)
    texts = [
        f"{cases.words(generator, generator.randint(5, 60))} {passage[generator.randint(0, 50) : len(passage) - generator.randint(0, 200)]}"
        f"{generator.choice('. ')}{cases.words(generator, generator.randint(5, 60))}" for _ in range(30)
    ]
    long = cases.words(generator, 400)
    texts += [long[: i * 37 + 700] + cases.words(generator, 30) + long[i * 37 + 700 :] for i in range(6)]
    return [*texts, *cases.awkward(), "ab" * 900, "ab" * 300 + texts[0], "y" * 400, "z" * 401, "q" * 399, texts[3], texts[3]]


@pytest.mark.parametrize("crowd", [4096, 5])
def test_repeated_passages_match_looking_at_every_place(session, monkeypatch, crowd):
    monkeypatch.setattr(suffix, "CROWD", crowd)
    texts = repeats()
    docs = cases.documents(session, texts).repartition(3)
    rows = {r.doc_id: r for r in suffix.digests(docs).collect()}
    for i, (kept, spans) in enumerate(cases.covered(texts)):
        gone = sum(b - a for a, b in spans)
        assert (rows[i].n_bytes, rows[i].n_removed, rows[i].n_spans) == (len(kept) + gone, gone, len(spans)), i
        assert rows[i].kept_sha256 == hashlib.sha256(kept).hexdigest()
    cut = {r.doc_id: r.text for r in suffix.without_repeats(docs).collect()}
    assert cut == {i: None if t is None else kept.decode("utf-8", "ignore") for i, (t, (kept, _)) in enumerate(zip(texts, cases.covered(texts), strict=True))}


def test_repeated_passages_of_repeated_rows_and_nothing(session):
    text = cases.words(random.Random(6), 120)
    docs = session.createDataFrame([(1, text), (1, text), (None, text), (None, None)], "doc_id bigint, text string")
    assert sorted(r.n_removed for r in suffix.digests(docs).collect()) == [0, *[len(text.encode())] * 3]
    assert suffix.digests(docs.limit(0)).count() == 0


def test_multikey_quicksort_orders_by_all_tokens():
    generator = np.random.default_rng(1)
    first, second = generator.integers(0, 50, 300_000).astype(np.uint64), generator.integers(0, 2**64, 300_000, dtype=np.uint64)
    order = suffix.multikey([first, second])
    assert (order == np.lexsort([second, first])).all()


def test_contamination_matches_comparing_all_windows(session):
    generator = random.Random(7)
    items = {i: cases.words(generator, n) for i, n in enumerate([3, 14, 25, 25, 40])} | {5: None, 6: " ", 7: "la la la la la la la la"}
    texts: list[str | None] = list(cases.awkward())
    for i in range(1, 5):
        for edits in range(4):
            copy = items[i].split()
            for _ in range(edits):
                copy[generator.randrange(len(copy))] = "new"
            texts += [f"{cases.words(generator, 20)} {' '.join(copy).upper()} {cases.words(generator, 9)}", " ".join(copy), " ".join(copy[2:])]
    texts += [items[0], f"x {items[0]}", "la " * 30, f"{items[1]} {items[2]} {items[1]}", texts[-1]]
    docs = cases.documents(session, texts)
    table = session.createDataFrame(list(items.items()), "item_id bigint, text string")
    rows = decontaminate.contaminated(docs, table).collect()
    expected = cases.contaminations(dict(enumerate(texts)), items)
    assert {(r.doc_id, r.item_id): r.similarity for r in rows} == pytest.approx(expected)
    assert len(rows) == len(expected)
    clean = {r.doc_id for r in decontaminate.clean(docs, table).collect()}
    assert clean == set(range(len(texts))) - {d for d, _ in expected}
    assert decontaminate.contaminated(docs.limit(0), table).count() == decontaminate.contaminated(docs, table.limit(0)).count() == 0


@pytest.mark.parametrize("block_ids", [16, 1 << 16])
def test_token_counts_from_flat_files(session, block_ids, monkeypatch):
    monkeypatch.setattr(token_files, "FAN", 4)
    monkeypatch.setattr(token_files, "LEVELS", 6)
    library = Tokenizer.from_file(TOKENIZER)
    library.encode_special_tokens = True
    texts = [*cases.awkward(), cases.words(random.Random(8), 400), "", "", "a"]
    flat = token_files.write_flat(cases.documents(session, texts), TOKENIZER, end=50256, block_ids=block_ids)
    rows = token_files.token_counts(flat, 50256).selectExpr("names[position] AS doc_id", "n_tokens").collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert len(rows) == len(texts) and token_files.token_counts(flat.limit(0), 50256).count() == 0


def test_ids_beyond_sixteen_bits_keep_all_their_bits(session, tmp_path):
    held = json.loads(bpe.definition(TOKENIZER))
    # The same vocabulary, its last word piece under an id that only 32 bits hold.
    last = max(held["model"]["vocab"], key=held["model"]["vocab"].get)
    moved = {**held["model"]["vocab"], last: 70_000}
    wide = tmp_path / "wide.json"
    wide.write_text(json.dumps({**held, "model": {**held["model"], "vocab": moved}, "added_tokens": []}), "utf-8")
    assert token_files.width_of(bpe.definition(TOKENIZER)) == 2 == token_files.width_of(bpe.definition(TOKENIZER), 65_535)
    assert token_files.width_of(wide.read_text("utf-8")) == 4 == token_files.width_of(bpe.definition(TOKENIZER), 65_536)
    # 65,793 has the low bits of 257: cut to 16 bits, that id would look like an end.
    texts = ["one two three", None, "", "again " * 40, last]
    docs = session.createDataFrame([*enumerate(texts), (None, "one"), (0, texts[0])], "doc_id bigint, text string")
    narrow, broad = (sorted((r.doc_id or -1, r.n_tokens) for r in token_files.document_counts(docs, TOKENIZER, end).collect()) for end in (50_256, 65_793))
    assert narrow == broad and len(narrow) == len(texts) + 2
    assert [n for i, n in narrow if i in (1, 2)] == [0, 0]


def test_token_counts_of_raw_files(session, tmp_path):
    ids = np.array([1, 2, 9, 9, 3, 4, 5, 6, 7, 8, 9, 1], "<u2")
    (tmp_path / "a.bin").write_bytes(ids.tobytes())
    (tmp_path / "empty.bin").write_bytes(b"")
    counts = token_files.token_counts(token_files.read_flat(session, str(tmp_path), 6), 9).orderBy("block", "position")
    assert [r.n_tokens for r in counts.collect()] == [2, 0, 6]
