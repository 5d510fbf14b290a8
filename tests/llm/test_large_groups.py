"""Large groups: rows that operators send on grow with the rows of a group, not with its pairs."""

import random

import pyarrow as pa

from sondage.llm import minhash
from sondage.llm.tables import prepare
from tests.llm import cases


def batch_of(sets):
    """One tile: every set a component of its own, met in band 0."""
    n = len(sets)
    columns = {
        "band": [0] * n, "bucket": [7] * n, "tile_i": [0] * n, "tile_j": [0] * n, "side": [0] * n, "node": list(range(n)), "component": list(range(n)),
        "signature": [minhash.signature(s).tobytes() for s in sets], "members": [s.tobytes() for s in sets],
    }
    return pa.RecordBatch.from_pydict(columns)


def test_a_tile_sends_fewer_links_than_rows_and_confirms_them_on_full_sets():
    numbers, words = minhash.word_numbers(), [b"w%d" % i for i in range(300)]
    near = [minhash.shingles([*words[:-1], b"end%d" % i], numbers) for i in range(30)]
    far = [minhash.shingles([b"x%d" % (300 * i + j) for j in range(300)], numbers) for i in range(3)]
    sent = [tuple(r.values()) for b in minhash.links_across(minhash.AT_85)([batch_of(near + far)]) for r in b.to_pylist()]
    assert len(sent) == 29 and {x for link in sent for x in link} == set(range(30))
    assert minhash.enough_shared(near[0], near[1], 85) and not minhash.enough_shared(near[0], far[0], 85)


def test_near_copies_that_are_no_links_are_no_rows(spark, monkeypatch):
    prepare(spark)
    generator, texts = random.Random(3), []
    base = cases.words(generator, 200).split()
    for i in range(150):
        # Links with the base are rare; two copies share some 0.7 of their shingles.
        own = list(base)
        for at in generator.sample(range(5, 195), 4 + i % 3):
            own[at] = f"q{i}x{at}"
        texts.append(" ".join(own))
    seen, confirmed = [], minhash.confirmed

    def counted(pairs, *rest):
        seen.append(pairs.count())
        return confirmed(pairs, *rest)

    monkeypatch.setattr(minhash, "confirmed", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, at=minhash.AT_80).collect()}
    numbers = minhash.word_numbers()
    sets = [minhash.shingles(minhash.fold(t.encode()), numbers) for t in texts]
    least = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if minhash.enough_shared(sets[a], sets[b], 80):
                old, new = max(least[a], least[b]), min(least[a], least[b])
                least = [new if x == old else x for x in least]
    assert found == dict(enumerate(least))
    # Stars alone: a node meets the least nodes of its buckets.
    assert len(seen) == 1
