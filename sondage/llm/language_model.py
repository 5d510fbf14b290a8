"""A hierarchical Pitman-Yor language model, sampled by Gibbs sweeps over word shards.

The context of a word is the word before it, and every context has a restaurant whose customers are the
words seen after it. Its tables are customers of the restaurant of its class: short words are classes of
their own, longer ones go by their ending, all hashed to CONTEXTS numbers. The tables of classes are
customers of the one parent restaurant, whose own tables are served by a uniform base. Where a class has one
context only, the two are one restaurant. How strongly contexts hold to their class is what makes the words
learned from likeliest, each being left out in turn.

Texts are read once, by chunks. A chunk's pairs of context and word are counted where it is read, and only
distinct pairs are dealt to shards, by the hash of the word, so the seating of a word in all contexts and
classes, and at the parent, is drawn in one place. Words that make up more than about a thousandth of all
tokens would make hot shards; they are dealt by their hash and the class before them, and their few seatings
at the parent are drawn on the driver. What shards need of each other are table totals, which each sweep
takes from the one before: those of classes and of the parent are short and sent to all; those of contexts
are as many as there are words, and are added up by buckets of contexts, each shard getting its own back.
In the end each chunk gets the scores of its pairs back, in the order it sent them.

Random numbers come from hashes of word, context, sweep and customer, so results do not depend on the layout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.llm.minhash import by_group
from sondage.llm.tables import finished, give_back, mix, pieces, row_key, stored, stored_by, tidy, utf8
from sondage.llm.texts import fold_of

FOLDS, HELD_OUT = 5, 1
#: Classes of the word before; 0 is the start of a text. A power of two, whose exponent is CLASS_BITS.
CONTEXTS, CLASS_BITS = 512, np.uint64(9)
SHORT, ENDING = 4, 3
#: Shares of a sample of the texts above which a word is dealt out by class, and how many at most.
HOT_SHARE, HOT_WORDS, SAMPLED = 1 / 2048, 1024, 16
SHARD_TOKENS = 2_000_000
#: Texts of about so many bytes make a chunk.
CHUNK_BYTES = 8 << 20
BURN_IN, SAMPLES = 2, 2
#: Customers that are drawn in one step: one until so many sit, from there on a SHARE-th of their number.
SINGLY, SHARE = 64, 32
#: Binomial draws of a greater variance are drawn as rounded normal numbers.
NORMAL_FROM = 100
STRENGTH = 1.0
#: Strengths that the restaurants of contexts may have.
STRENGTHS = np.array([1.0, 4, 16, 64, 256, 1024, 4096])
END = 0


def word_number(word: bytes) -> int:
    """A 64-bit number whose last bits are the word's class as a context; never END."""
    form = word if len(word) <= SHORT else b"-" + word[-ENDING:]
    context = 1 + xxhash.xxh64_intdigest(form) % (CONTEXTS - 1)
    return xxhash.xxh64_intdigest(word) // CONTEXTS * CONTEXTS + context


def word_numbers(words: pa.Array) -> np.ndarray:
    """The ``word_number`` of each of many words; forms are few beside words, and hashed once."""
    ending = pa.compute.binary_join_element_wise(pa.scalar(b"-", words.type), pa.compute.binary_slice(words, -ENDING), pa.scalar(b"", words.type))
    form = pa.compute.if_else(pa.compute.less_equal(pa.compute.binary_length(words), SHORT), words, ending).dictionary_encode()
    context = np.array([1 + xxhash.xxh64_intdigest(f) % (CONTEXTS - 1) for f in form.dictionary.to_pylist()], np.uint64)
    numbers = np.fromiter(map(xxhash.xxh64_intdigest, words.to_pylist()), np.uint64, len(words))
    return numbers // np.uint64(CONTEXTS) * np.uint64(CONTEXTS) + context[form.indices.to_numpy()]


@dataclass(frozen=True)
class Tokens:
    """All tokens of some texts, the end of each text included: the number of each distinct word, END being the
    last, for each token the place of its word there, and the number of tokens of each text."""

    numbers: np.ndarray
    place: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def of(texts: list[bytes]) -> Tokens:
        """Words are those of ``fold``: A-Z in lower case, parted by the ASCII white space."""
        split = pa.compute.ascii_split_whitespace(pa.compute.ascii_lower(pa.array(texts, pa.large_binary()).view(pa.large_string())))
        words = split.flatten().view(pa.large_binary())
        # White space at either end of a text leaves an empty word.
        filled = pa.compute.binary_length(words).to_numpy() > 0
        sizes = np.diff(np.r_[0, np.cumsum(filled)][split.offsets.to_numpy()]) + 1
        coded = words.filter(pa.array(filled)).dictionary_encode()
        numbers = np.r_[word_numbers(coded.dictionary), np.uint64(END)]
        ends = np.cumsum(sizes) - 1
        is_word = np.ones(sizes.sum(), bool)
        is_word[ends] = False
        place = np.full(len(is_word), len(numbers) - 1, np.int32)
        place[is_word] = coded.indices.to_numpy()
        return Tokens(numbers, place, sizes)

    @staticmethod
    def together(parts: list[Tokens]) -> Tokens:
        numbers, at = np.unique(np.concatenate([p.numbers[:-1] for p in parts]), return_inverse=True)
        ranks = np.split(at.astype(np.int32), np.cumsum([len(p.numbers) - 1 for p in parts])[:-1])
        place = [np.r_[rank, np.int32(len(numbers))][p.place] for rank, p in zip(ranks, parts, strict=True)]
        return Tokens(np.r_[numbers, np.uint64(END)], np.concatenate(place), np.concatenate([p.sizes for p in parts]))

    @property
    def before(self) -> np.ndarray:
        """For each token the place of the word before it. Before a text's first is the end of another text."""
        return np.r_[np.int32(len(self.numbers) - 1), self.place[:-1]]

    @property
    def context(self) -> np.ndarray:
        """For each token the class of the word before it."""
        return (self.numbers % np.uint64(CONTEXTS)).astype(np.uint16)[self.before]


def hot_words(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Numbers, sorted, of words that are frequent in a sample of the texts, and the number of all tokens
    as estimated from it. Only how the work is dealt out depends on them, no result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for _, texts in pieces(batches, "t"):
            found = Tokens.of(texts)
            held.append((found.numbers, np.bincount(found.place, minlength=len(found.numbers)), len(found.place)))
        if held:
            total = sum(h[2] for h in held)
            numbers, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([h[1] for h in held])).astype(np.int64)
            often = counts >= total * HOT_SHARE / 4
            yield pa.record_batch([pa.array(np.r_[numbers[often].view(np.int64), -1]), pa.array(np.r_[counts[often], 0]), pa.array(np.r_[np.zeros(often.sum(), np.int64), total])], names=["w", "n", "total"])

    part = docs.where(F.pmod(F.col("row"), F.lit(SAMPLED)) == 0).select("row", "t")
    seen = part.mapInArrow(run, "w bigint, n bigint, total bigint").groupBy("w").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    seen = stored(seen, "frequent")
    total = seen.agg(F.sum("total")).first()[0] or 0
    most = seen.where((F.col("n") > 0) & (F.col("n") >= total * HOT_SHARE)).orderBy(F.desc("n"), "w").limit(HOT_WORDS).collect()
    return np.sort(np.array([r.w for r in most], np.int64).view(np.uint64)), total * SAMPLED


def lookup(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a sorted table, and which values are in it."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def packed(values: np.ndarray) -> bytes:
    """Numbers as they travel and are stored: byte planes under a code by frequency, since most are small and their
    upper bytes alike. Eight bytes of length come first."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return values.nbytes.to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def steps(values: np.ndarray) -> np.ndarray:
    """Differences of unsigned numbers, from 0 on and modulo their size; small if they ascend. ``np.cumsum`` undoes it."""
    return np.diff(values, prepend=values.dtype.type(0))


def turned(numbers: np.ndarray) -> np.ndarray:
    """Word numbers with the class in front, so that contexts in order are in order of their classes."""
    return (numbers << (np.uint64(64) - CLASS_BITS)) | (numbers >> CLASS_BITS)


def class_of(befores: np.ndarray) -> np.ndarray:
    return (befores >> (np.uint64(64) - CLASS_BITS)).astype(np.int64)


def runs(values: np.ndarray) -> np.ndarray:
    """Places at which runs of equal neighbours begin."""
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, np.int64)


def shard_of(numbers: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of numbers that are spread evenly."""
    return np.minimum((numbers >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32), np.uint64(shards - 1)).astype(np.int32)


def texts_row(chunk: int, shards: int) -> int:
    """The number below 0 under which the texts of a chunk are kept beside the shards."""
    return -1 - chunk % 65_521 % shards


def bucket_order(befores: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of contexts bucket by bucket, and where each bucket begins there."""
    bucket = shard_of(befores << CLASS_BITS, buckets)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def by_bucket(values: np.ndarray, befores: np.ndarray, buckets: int) -> list[bytes]:
    order, cuts = bucket_order(befores, buckets)
    return [packed(values[order[start:stop]]) for start, stop in zip(cuts, cuts[1:], strict=False)]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, Tokens]]:
    """Pieces put together until their texts have CHUNK_BYTES."""
    parts, found, size = [], [], 0
    for part, texts in pieces(batches, "t"):
        parts.append(part.drop_columns(["t"]))
        found.append(Tokens.of(texts))
        size += sum(map(len, texts))
        if size >= CHUNK_BYTES:
            yield pa.Table.from_batches(parts), Tokens.together(found)
            parts, found, size = [], [], 0
    if parts:
        yield pa.Table.from_batches(parts), Tokens.together(found)


#: A row of shard 0 and up is a packet: for each word its number of pairs, for each pair the place of its context
#: among ``befores`` and its count. Rows below have the texts of a chunk: for each token the place of its pair among all
#: those of the chunk's packets, in two parts, of which ``contexts`` has the lower 16 bits.
PACKET = (
    "shard int, chunk bigint, words binary, pairs binary, befores binary, places binary, counts binary, "
    "contexts binary, texts binary, rows binary, named binary, learn binary"
)


def batch_of(schema: str, rows: list[dict]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary()), "array<bigint>": pa.list_(pa.int64())}
    columns = [c.split() for c in schema.split(", ")]
    return pa.record_batch([pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in columns], names=[name for name, _ in columns])


def deal(shared, shards: int):
    """Pairs of context and word, counted by chunk and packed by shard, and the texts as places of pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, task = shared.value, TaskContext.get()
        chunk = (task.partitionId() if task else 0) << 32
        empty = packed(np.empty(0, np.uint16))
        for part, found in chunks(batches):
            ids, learn = part.column(0).combine_chunks(), part.column(1).to_numpy().astype(bool)
            by_number, by_class = np.argsort(found.numbers), np.argsort(turned(found.numbers))
            size = len(by_number)
            ranks = np.empty((2, size), np.int64)
            ranks[0, by_number] = ranks[1, by_class] = np.arange(size)
            pair, place, taught = told_apart(ranks[0][found.place] * size + ranks[1][found.before], np.repeat(learn, found.sizes))
            word, before = np.divmod(pair, size)
            numbers, befores = found.numbers[by_number], turned(found.numbers)[by_class]
            # Ranges of numbers are shards, but for hot words, which go by the class before them.
            often = lookup(numbers, hot)[1][word]
            shard = shard_of(numbers[word], shards)
            shard[often] = shard_of(mix(numbers[word[often]] + class_of(befores[before[often]]).astype(np.uint64) + np.uint64(1)), shards)
            order = np.argsort(shard, kind="stable")
            moved = np.empty(len(order), np.uint32)
            moved[order] = np.arange(len(order))
            place, shard, word, before, taught = moved[place], shard[order], word[order], before[order], taught[order]
            starts, out, sizes = runs(shard), [], []
            for start, stop in zip(starts, [*starts[1:], len(shard)], strict=True):
                first = runs(word[start:stop])
                sizes.append(np.diff(first, append=stop - start).astype(np.uint32))
                own, at = np.unique(before[start:stop], return_inverse=True)
                out.append({
                    "shard": int(shard[start]), "chunk": chunk, "words": packed(steps(numbers[word[start:stop][first]])), "pairs": packed(sizes[-1]),
                    "befores": packed(steps(befores[own])), "places": packed(at.astype(np.uint32)), "counts": packed(taught[start:stop].astype(np.uint32)),
                    "contexts": empty, "texts": empty,
                })
            out.append({
                "shard": texts_row(chunk, shards), "chunk": chunk, "pairs": packed(np.concatenate(sizes)), "places": packed((place >> 16).astype(np.uint16)), "counts": empty,
                "contexts": packed(place.astype(np.uint16)), "texts": packed(found.sizes.astype(np.uint32)),
                "rows": packed(ids.fill_null(0).to_numpy().astype(np.int64)), "named": packed(ids.is_valid().to_numpy(zero_copy_only=False)), "learn": packed(learn),
            })
            for row in out:
                yield batch_of(PACKET, [row])
            chunk += 1

    return tidy(run)


def told_apart(keys: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, sorted, the place of each key among them, and how often each is to be learned from."""
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, place, np.bincount(place[learn], minlength=len(distinct))


#: Pairs in order of word, class and context; ``asked`` has the place of each pair of the packets, ``asks`` how many
#: are each packet's, ``chunks`` whose it is. Rows of texts come as they are.
SHARD = (
    "shard int, words binary, pairs binary, befores binary, places binary, counts binary, asked binary, asks binary, chunks binary, "
    "chunk bigint, contexts binary, texts binary, rows binary, named binary, learn binary"
)


@tidy
def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each shard: its words, its contexts, their pairs with counts, and who asked for them."""
    for (shard,), frame in by_group(batches, ["shard"]):
        if shard < 0:
            for row in frame.to_dict("records"):
                yield batch_of(SHARD, [row])
            continue
        read = lambda c, kind: [unpacked(b, kind) for b in frame[c]]  # noqa: B023, E731
        ascending = lambda c: [np.cumsum(x, dtype=np.uint64) for x in read(c, np.uint64)]  # noqa: B023, E731
        given, own = ascending("words"), ascending("befores")
        words, befores = np.unique(np.concatenate(given)), np.unique(np.concatenate(own))
        # Contexts are in order of their classes, so keys are in order of word, class and context.
        keys = np.concatenate([
            np.repeat(np.searchsorted(words, w), n) * len(befores) + np.searchsorted(befores, b)[at]
            for w, n, b, at in zip(given, read("pairs", np.uint32), own, read("places", np.uint32), strict=True)
        ])
        counts = read("counts", np.uint32)
        key, asked = np.unique(keys, return_inverse=True)
        word, before = np.divmod(key, len(befores))
        arrays = {
            "words": steps(words), "pairs": np.bincount(word, minlength=len(words)).astype(np.uint32), "befores": steps(befores), "places": before.astype(np.uint32),
            "counts": np.bincount(asked, np.concatenate(counts), minlength=len(key)).astype(np.int64), "asked": steps(asked.astype(np.uint32)),
            "asks": np.array([len(c) for c in counts], np.uint32), "chunks": frame["chunk"].to_numpy(np.int64),
        }
        yield batch_of(SHARD, [{"shard": shard, **{name: packed(x) for name, x in arrays.items()}}])


@dataclass(frozen=True)
class Shard:
    """Pairs of a shard by word, context and count; dishes are its words in their classes."""

    names: np.ndarray
    befores: np.ndarray
    word: np.ndarray
    before: np.ndarray
    count: np.ndarray
    dish: np.ndarray
    dish_word: np.ndarray
    dish_class: np.ndarray

    @staticmethod
    def of(row: dict) -> Shard:
        names, befores = (np.cumsum(unpacked(row[c], np.uint64), dtype=np.uint64) for c in ("words", "befores"))
        word, before = np.repeat(np.arange(len(names)), unpacked(row["pairs"], np.uint32)), unpacked(row["places"], np.uint32)
        classes = class_of(befores)[before]
        key = word * CONTEXTS + classes
        first = runs(key)
        dish = np.repeat(np.arange(len(first)), np.diff(first, append=len(key)))
        return Shard(names, befores, word, before, unpacked(row["counts"], np.int64), dish, word[first], classes[first])

    @property
    def classes(self) -> np.ndarray:
        """The class of each pair's context."""
        return self.dish_class[self.dish]

    def sums(self, tables: np.ndarray, of_dishes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Customers of each dish in its class, and of each word at the parent."""
        return np.bincount(self.dish, tables, len(self.dish_word)).astype(np.int64), np.bincount(self.dish_word, of_dishes, len(self.names)).astype(np.int64)


@dataclass(frozen=True)
class Totals:
    """What all shards share: customers and tables of each class, tables at the parent, discounts, the strength
    of contexts, customers and tables of the hot words at the parent, and which classes have one context only."""

    customers: np.ndarray
    tables: np.ndarray
    parent_tables: int
    words: int
    discount: float
    parent_discount: float
    word_discount: float = 0.5
    word_strength: float = STRENGTH
    hot_served: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    hot_top: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    single: np.ndarray = field(default_factory=lambda: np.zeros(CONTEXTS, bool))

    def base(self) -> float:
        return 1 / (self.words + 1)

    def parent(self, served: np.ndarray, seated: np.ndarray) -> np.ndarray:
        """The parent's probability of words with so many customers (class tables) at so many tables."""
        rest = (STRENGTH + self.parent_discount * self.parent_tables) * self.base()
        return (np.maximum(served - self.parent_discount * seated, 0) + rest) / (STRENGTH + self.tables.sum())

    def chance(self, count, tables, context, above) -> np.ndarray:
        rest = (STRENGTH + self.discount * self.tables[context]) * above
        return (np.maximum(count - self.discount * tables, 0) + rest) / (STRENGTH + self.customers[context])


def named(*keys) -> np.ndarray:
    """One 64-bit number for each tuple of keys."""
    out = np.zeros(1, np.uint64)
    for key in keys:
        out = mix(np.asarray(key, np.uint64) + mix(out + np.uint64(0x9E3779B97F4A7C15)))
    return out


def uniform(*keys) -> np.ndarray:
    return (named(*keys) >> np.uint64(11)).astype(np.float64) / (1 << 53)


def binomial(n: np.ndarray, p: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Numbers of successes in ``n`` tries of probability ``p``, from two uniform numbers each: by inversion, or
    as a rounded normal number where the variance is large."""
    rare = np.minimum(p, 1 - p)
    out = np.rint(n * rare + np.sqrt(n * rare * (1 - rare)) * np.sqrt(-2 * np.log1p(-u)) * np.cos(2 * np.pi * v)).clip(0, n)
    few = np.flatnonzero(n * rare * (1 - rare) <= NORMAL_FROM)
    out[few] = 0
    odds, chance = rare[few] / (1 - rare[few]), np.exp(n[few] * np.log1p(-rare[few]))
    left = u[few] - chance
    on = np.flatnonzero((left >= 0) & (n[few] > 0))
    while len(on):
        at = few[on]
        chance[on] *= (n[at] - out[at]) / (out[at] + 1) * odds[on]
        out[at] += 1
        left[on] -= chance[on]
        on = on[(left[on] >= 0) & (out[at] < n[at])]
    return np.where(p > 0.5, n - out, out).astype(np.int64)


def seat(count: np.ndarray, fresh: np.ndarray, discount: float, keys: tuple, more: np.ndarray | float = 0.0) -> np.ndarray:
    """Tables after all customers of a dish have sat down again one after the other: the next one opens a
    table with weight ``fresh``, and ``more`` for each table of the dish, and joins one with weight
    (customers - discount * tables). Every customer has a number of their own that decides. Where many sit
    already, some are seated in one step: who opens a table when the fewest possible are open is counted for those
    that follow, until nothing changes; the odds grow with the tables, so that is where one by one ends too."""
    tables = np.minimum(count, 1).astype(np.int64)
    seated = tables.copy()
    own, fresh, more = (np.broadcast_to(x, count.shape) for x in (named(*keys), fresh, more))
    active = np.flatnonzero(count > seated)
    while len(active):
        n, t = seated[active], tables[active]
        group = np.minimum(np.where(n < SINGLY, 1, n // SHARE), count[active] - n)
        begin = np.cumsum(group) - group
        at = np.repeat(np.arange(len(active)), group)
        sitting = n[at] + np.arange(len(at)) - begin[at]
        dish = active[at]
        u, first, added = uniform(own[dish], sitting), fresh[dish], more[dish]
        open_now = t[at]
        while True:
            weight = first + added * open_now
            opens = u * (weight + sitting - discount * open_now) < weight
            earlier = np.cumsum(opens) - opens
            follow = t[at] + earlier - earlier[begin][at]
            if np.array_equal(follow, open_now):
                break
            open_now = follow
        tables[active] += np.add.reduceat(opens, begin, dtype=np.int64)
        seated[active] += group
        active = active[count[active] > seated[active]]
    return tables


STATE = (
    "shard int, tables binary, dish_tables binary, parent_tables binary, by_context array<binary>, "
    "by_class array<bigint>, class_tables array<bigint>, parent_total bigint, hot_served array<bigint>"
)


def state_row(shard: int, own: Shard, tables: np.ndarray, dish_tables: np.ndarray, parent_tables: np.ndarray, hot: np.ndarray, buckets: int) -> dict:
    """A seating, and what totals need of it."""
    _, served = own.sums(tables, dish_tables)
    return {
        "shard": shard, "tables": packed(tables), "dish_tables": packed(dish_tables), "parent_tables": packed(parent_tables),
        "by_context": by_bucket(np.bincount(own.before, tables, len(own.befores)).astype(np.uint32), own.befores, buckets),
        "by_class": np.bincount(own.dish_class[own.dish], tables, CONTEXTS).astype(np.int64), "class_tables": np.bincount(own.dish_class, dish_tables, CONTEXTS).astype(np.int64),
        "parent_total": int(parent_tables.sum()), "hot_served": of_hot(own.names, served, hot),
    }


def of_hot(names: np.ndarray, values: np.ndarray, hot: np.ndarray) -> np.ndarray:
    at, there = lookup(names, hot)
    return np.bincount(at[there], values[there], len(hot)).astype(np.int64)


CONSTANTS = "shard int, customers array<binary>, contexts array<binary>, hot_count array<bigint>, learned bigint"


def constants(shared, buckets: int):
    """What no sweep changes: contexts and their customers, counts of hot words, the number of tokens learned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = Shard.of(row)
                order, cuts = bucket_order(own.befores, buckets)
                yield batch_of(CONSTANTS, [{
                    "shard": row["shard"], "customers": by_bucket(np.bincount(own.before, own.count, len(own.befores)).astype(np.int64), own.befores, buckets),
                    "contexts": [packed(steps(own.befores[order[a:b]])) for a, b in zip(cuts, cuts[1:], strict=False)],
                    "hot_count": of_hot(own.names, np.bincount(own.word, own.count, len(own.names)), shared.value), "learned": int(own.count.sum()),
                }])

    return tidy(run)


FIRST = f"{STATE}, ones array<bigint>"


def first_seating(shared, buckets: int):
    """One table for each word and context, one in each class and one at the parent; and how many dishes of each
    level have one customer, and two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, single = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                own = Shard.of(row)
                alone = single[own.classes]
                tables = np.where(alone, own.count, np.minimum(own.count, 1))
                in_class, _ = own.sums(tables, np.zeros(len(own.dish_word)))
                of_dishes = np.minimum(in_class, 1)
                _, served = own.sums(tables, of_dishes)
                rare = ~lookup(own.names, hot)[1]
                seating = state_row(row["shard"], own, tables, of_dishes, np.where(rare, np.minimum(served, 1), 0), hot, buckets)
                yield batch_of(FIRST, [{**seating, "ones": [int((x == k).sum()) for x in (own.count[~alone], in_class, served[rare]) for k in (1, 2)]}])

    return tidy(run)


#: What a shard's tasks read of it, and the totals of its contexts by bucket.
PAIRS = ("shard", "words", "pairs", "befores", "places", "counts")


def in_order(parts: list[dict], befores: np.ndarray, kind: type) -> np.ndarray:
    """Totals by bucket as one array by context."""
    order, _ = bucket_order(befores, len(parts))
    out = np.empty(len(befores), np.int64)
    out[order] = np.concatenate([unpacked(p["total"], kind) for p in parts])
    return out


def at_parent(own: Shard, totals: Totals, state: tuple, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """Customers of each dish in its class, and customers and tables of each word at the parent; those of hot words are
    of all shards."""
    tables, mid, top = state
    in_class, served = own.sums(tables, mid)
    at, often = lookup(own.names, hot)
    top = top.copy()
    served[often], top[often] = totals.hot_served[at[often]], totals.hot_top[at[often]]
    return in_class, served, top


def in_classes(own: Shard, totals: Totals, state: tuple, hot: np.ndarray, some: np.ndarray, lost: np.ndarray) -> np.ndarray:
    """The class's probability of the words of some pairs, were so many of the pair's tables not there."""
    mid, (in_class, served, top) = state[1], at_parent(own, totals, state, hot)
    dish, word = own.dish[some], own.word[some]
    left = in_class[dish] - lost
    left_mid = np.minimum(mid[dish], left)
    others = served[word] - mid[dish] + left_mid
    parent = totals.parent(others, np.minimum(top[word], others))
    classes = own.dish_class[dish]
    rest = (STRENGTH + totals.discount * (totals.tables[classes] - mid[dish] + left_mid)) * parent
    return (np.maximum(left - totals.discount * left_mid, 0) + rest) / (STRENGTH + totals.customers[classes] - lost)


def likelihoods(shared):
    """The likelihood (log10) of the words learned from under each strength of the contexts, each left out in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, hot = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                own = Shard.of(row)
                state = tuple(unpacked(row[c], np.int64) for c in ("tables", "dish_tables", "parent_tables"))
                some = np.flatnonzero((own.count > 0) & ~totals.single[own.classes])
                count, before = own.count[some], own.before[some]
                once = (count == 1).astype(np.int64)
                above = in_classes(own, totals, state, hot, some, once)
                tables, customers = (in_order(row[c], own.befores, kind)[before] for c, kind in (("around", np.uint32), ("customers", np.int64)))
                rest = np.maximum(count - 1 - totals.word_discount, 0)
                chances = ((rest + (s + totals.word_discount * (tables - once)) * above) / (s + customers - 1) for s in STRENGTHS)
                yield pa.record_batch([pa.array([[float((count * np.log10(c)).sum()) for c in chances]], pa.list_(pa.float64()))], names=["likelihoods"])

    return tidy(run)


def sweep(shared, turn: int, buckets: int):
    """One Gibbs sweep: the customers of each word leave their tables and sit down again, in the contexts,
    then in the classes, then at the parent. Tables that they leave are gone from the restaurants above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, hot = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                own = Shard.of(row)
                state = old, mid, _ = tuple(unpacked(row[c], np.int64) for c in ("tables", "dish_tables", "parent_tables"))
                # Who sits alone in a context has one table there, whatever is drawn.
                some = np.flatnonzero((own.count > 1) & ~totals.single[own.classes])
                above = in_classes(own, totals, state, hot, some, old[some])
                tables = in_order(row["around"], own.befores, np.uint32)[own.before[some]] - old[some]
                keys = own.names[own.word[some]], own.befores[own.before[some]], turn
                new = old.copy()
                new[some] = seat(own.count[some], (totals.word_strength + totals.word_discount * tables) * above, totals.word_discount, keys, totals.word_discount * above)

                in_class, _ = own.sums(new, mid)
                _, served, top = at_parent(own, totals, state, hot)
                others = served[own.dish_word] - mid
                above = totals.parent(others, np.minimum(top[own.dish_word], others))
                fresh = (STRENGTH + totals.discount * (totals.tables[own.dish_class] - mid)) * above
                new_mid = seat(in_class, fresh, totals.discount, (own.names[own.dish_word], own.dish_class, turn, 1), totals.discount * above)

                _, served = own.sums(new, new_mid)
                new_top = seat_at_parent(np.where(lookup(own.names, hot)[1], 0, served), top, totals, own.names, turn)
                yield batch_of(STATE, [state_row(row["shard"], own, new, new_mid, new_top, hot, buckets)])

    return tidy(run)


def seat_at_parent(served: np.ndarray, seated: np.ndarray, totals: Totals, names: np.ndarray, turn: int) -> np.ndarray:
    rest = (STRENGTH + totals.parent_discount * (totals.parent_tables - seated)) * totals.base()
    return seat(served, rest, totals.parent_discount, (names, CONTEXTS, turn), totals.parent_discount * totals.base())


def by_position(table: DataFrame, column: str, size: int, kind: type = np.int64) -> np.ndarray:
    """Sums of an array column, place by place; the arrays are short."""
    rows = table.select(F.posexplode(column).alias("p", "n")).groupBy("p").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size, kind)
    for row in rows:
        out[row.p] = row.n
    return out


def buckets_of(table: DataFrame, *columns: str) -> DataFrame:
    """Array columns of the shards, bucket by bucket."""
    parts = table.select("shard", F.posexplode(F.arrays_zip(*columns)).alias("bucket", "part"))
    return parts.select("shard", "bucket", *(f"part.{c}" for c in columns))


def grouped(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "shard")


BUCKET = "shard int, bucket int, total binary"


@tidy
def same_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each bucket the place of every shard's contexts among all of its contexts, as a row of shard -1 that also
    tells how many contexts of each class have customers; and for each shard the customers of its own."""
    for (bucket,), frame in by_group(batches, ["bucket"]):
        given = np.concatenate([np.cumsum(unpacked(b, np.uint64), dtype=np.uint64) for b in frame["contexts"]])
        befores, place = np.unique(given, return_inverse=True)
        counts = [unpacked(b, np.int64) for b in frame["customers"]]
        total = np.bincount(place, np.concatenate(counts), len(befores)).astype(np.int64)
        members = np.bincount(class_of(befores[total > 0]), minlength=CONTEXTS)
        schema = f"{BUCKET}, members array<bigint>"
        yield batch_of(schema, [{"shard": -1, "bucket": bucket, "total": packed(steps(place.astype(np.uint32))), "members": members}])
        cuts = np.cumsum([0, *map(len, counts)])
        for shard, start, stop in zip(frame["shard"], cuts, cuts[1:], strict=False):
            yield batch_of(schema, [{"shard": int(shard), "bucket": bucket, "total": packed(total[place[start:stop]])}])


@tidy
def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums over all shards for each context of a bucket, sent to every shard that has it."""
    for (bucket,), frame in by_group(batches, ["bucket"]):
        place = np.cumsum(unpacked(frame["total"].iloc[0], np.uint32), dtype=np.uint32)
        given = [unpacked(b, np.uint32) for b in frame["total"].iloc[1:]]
        every = np.bincount(place, np.concatenate(given))[place].astype(np.uint32)
        cuts = np.cumsum([0, *map(len, given)])
        for shard, start, stop in zip(frame["shard"].iloc[1:], cuts, cuts[1:], strict=False):
            yield batch_of(BUCKET, [{"shard": int(shard), "bucket": bucket, "total": packed(every[start:stop])}])


def by_shard(back: DataFrame, name: str) -> DataFrame:
    return back.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("bucket", "total"))).alias(name))


def tables_around(index: DataFrame, state: DataFrame, buckets: int) -> DataFrame:
    """For each shard the tables of its contexts, by bucket."""
    parts = buckets_of(state, "by_context").withColumnRenamed("by_context", "total")
    back = grouped(parts.unionByName(index), buckets).mapInArrow(added_up, BUCKET)
    return stored(by_shard(back, "around"), "around")


@dataclass(frozen=True)
class Model:
    """Seatings after each sweep past the burn-in with their totals, customers of contexts, counts of hot words
    and the number of training tokens."""

    states: list[DataFrame]
    totals: list[Totals]
    customers: DataFrame
    hot_count: np.ndarray
    learned: int


def sample(shards: DataFrame, hot: np.ndarray, buckets: int, samples: int = SAMPLES, burn_in: int = BURN_IN) -> Model:
    context = shards.sparkSession.sparkContext
    pairs = shards.select(*PAIRS)
    fixed = stored(pairs.mapInArrow(constants(context.broadcast(hot), buckets), CONSTANTS), "constants")
    known = grouped(buckets_of(fixed, "contexts", "customers"), buckets).mapInArrow(same_contexts, f"{BUCKET}, members array<bigint>")
    known = stored(known, "contexts")
    index = known.where("shard < 0")
    single, index = by_position(index, "members", CONTEXTS) == 1, index.drop("members")
    customers = stored(by_shard(known.where("shard >= 0"), "customers"), "customers")
    hot_count, learned = by_position(fixed, "hot_count", len(hot)), fixed.agg(F.sum("learned")).first()[0] or 0

    state = stored(pairs.mapInArrow(first_seating(context.broadcast((hot, single)), buckets), FIRST), "seating")
    served = by_position(state, "hot_served", len(hot))
    ones = by_position(state, "ones", 6) + np.array([0, 0, 0, 0, (served == 1).sum(), (served == 2).sum()])

    def discount(one: int, two: int) -> float:
        return float(np.clip(one / (one + 2 * two) if one else 0.5, 0.05, 0.95))

    word_discount, class_discount, parent_discount = (discount(*ones[i : i + 2]) for i in (0, 2, 4))
    words = (state.agg(F.sum("parent_total")).first()[0] or 0) + int((hot_count > 0).sum())

    def totals(of: DataFrame, hot_served: np.ndarray, hot_top: np.ndarray, strength: float) -> Totals:
        top = (of.agg(F.sum("parent_total")).first()[0] or 0) + int(hot_top.sum())
        by_class = (by_position(of, c, CONTEXTS) for c in ("by_class", "class_tables"))
        return Totals(*by_class, top, words, class_discount, parent_discount, word_discount, strength, hot_served, hot_top, single)

    def seated(of: DataFrame, around: DataFrame) -> DataFrame:
        return of.select("shard", "tables", "dish_tables", "parent_tables").join(around, "shard")

    now, around = totals(state, served, np.minimum(served, 1), STRENGTH), tables_around(index, state, buckets)
    joined = pairs.join(seated(state, around), "shard").join(customers, "shard")
    likely = joined.mapInArrow(likelihoods(context.broadcast((now, hot))), "likelihoods array<double>")
    likely = by_position(likely, "likelihoods", len(STRENGTHS), float)
    now = replace(now, word_strength=float(STRENGTHS[np.argmax(likely)]))
    states, every = [], []
    for turn in range(burn_in + samples):
        joined = pairs.join(seated(state, around), "shard")
        state = stored(joined.mapInArrow(sweep(context.broadcast((now, hot)), turn, buckets), STATE), "seating")
        served = by_position(state, "hot_served", len(hot))
        hot_top = seat_at_parent(served, now.hot_top, now, hot, turn)
        now, around = totals(state, served, hot_top, now.word_strength), tables_around(index, state, buckets)
        if turn >= burn_in:
            states.append(seated(state, around))
            every.append(now)
    return Model(states, every, customers, hot_count, learned)


def log_chances(own: Shard, totals: list[Totals], states: list[tuple], customers: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """log10 of the averaged predictive probability of each pair of a shard."""
    every = np.zeros(len(own.count))
    for total, (old, mid, top, around) in zip(totals, states, strict=True):
        in_class, served, top = at_parent(own, total, (old, mid, top), hot)
        in_dishes = total.chance(in_class, mid, own.dish_class, total.parent(served, top)[own.dish_word])[own.dish]
        rest = (total.word_strength + total.word_discount * around[own.before]) * in_dishes
        in_contexts = (np.maximum(own.count - total.word_discount * old, 0) + rest) / (total.word_strength + customers[own.before])
        every += np.where(total.single[own.classes], in_dishes, in_contexts)
    return np.log10(every / len(totals))


def base_scores(count: np.ndarray, tokens_learned: int, words: int) -> np.ndarray:
    return np.log10((count + 0.5) / (tokens_learned + 0.5 * (words + 1)))


REPLY = "shard int, chunk bigint, packet int, words binary, own binary"


def replies(shared, shards: int):
    """For each packet the count of its words and the scores of its pairs, in its own order, to where its texts are.
    Scores travel as 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, hot, hot_count = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                own = Shard.of(row)
                states = [
                    (*(unpacked(row[f"{c}_{i}"], np.int64) for c in ("tables", "dish_tables", "parent_tables")), in_order(row[f"around_{i}"], own.befores, np.uint32))
                    for i in range(len(totals))
                ]
                chance = log_chances(own, totals, states, in_order(row["customers"], own.befores, np.int64), hot).astype(np.float32)
                count = np.bincount(own.word, own.count, len(own.names)).astype(np.int64)
                at, often = lookup(own.names, hot)
                count[often] = hot_count[at[often]]
                asked = np.cumsum(unpacked(row["asked"], np.uint32), dtype=np.uint32)
                cuts = np.r_[0, np.cumsum(unpacked(row["asks"], np.uint32).astype(np.int64))]
                for chunk, start, stop in zip(unpacked(row["chunks"], np.int64).tolist(), cuts, cuts[1:], strict=False):
                    mine = asked[start:stop]
                    words = own.word[mine]
                    answer = {"words": packed(count[words[runs(words)]]), "own": packed(chance[mine])}
                    yield batch_of(REPLY, [{"shard": texts_row(chunk, shards), "chunk": chunk, "packet": row["shard"], **answer}])

    return tidy(run)


RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def by_text(learned: int, words: int):
    """The sums of each text of some chunks, given the answers to their packets."""

    def one(row: dict, answers: list[dict]) -> pa.RecordBatch:
        count = np.concatenate([unpacked(a["words"], np.int64) for a in answers])
        own = np.concatenate([unpacked(a["own"], np.float32) for a in answers])
        place = (unpacked(row["places"], np.uint16).astype(np.uint32) << 16) | unpacked(row["contexts"], np.uint16)
        word = np.repeat(np.arange(len(count), dtype=np.uint32), unpacked(row["pairs"], np.uint32))[place]
        sizes = unpacked(row["texts"], np.uint32).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        known, base = (np.add.reduceat(x[word], begin) for x in ((count > 0).astype(np.int64), base_scores(count, learned, words)))
        score = np.add.reduceat(own[place], begin, dtype=np.float64)
        ids = pa.array(unpacked(row["rows"], np.int64), mask=~unpacked(row["named"], bool))
        arrays = [ids, pa.array(~unpacked(row["learn"], bool)), *map(pa.array, (sizes, known, np.full(len(sizes), learned), base, score))]
        return pa.record_batch(arrays, names=[c.split()[0] for c in RESULT.split(", ")])

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by([("chunk", "ascending"), ("packet", "ascending")])
        out = [one(row, answers.filter(pa.compute.equal(answers["chunk"], row["chunk"])).to_pylist()) for row in texts.to_pylist()]
        give_back()
        return pa.Table.from_batches(out)

    return run


@finished
def scores(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for each row of ``docs``.

    The model learns from the rows outside the held-out fold and scores all of them; texts are read whole,
    null texts have only their end. Unseen words get the base's share each. Repeated rows count as often
    as they stand there when they are learned from, and get equal scores. Without training rows every
    word is unseen. An empty table gives no rows."""
    held = F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    rows = docs.select(row_key().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), (~held).alias("learn"), utf8().alias("t"))
    context = docs.sparkSession.sparkContext
    hot, size = hot_words(rows)
    shards = max(1, -(-size // SHARD_TOKENS))
    # Buckets grow with the root of the shards: packets stay large, and a bucket's contexts few.
    buckets = 4 * math.isqrt(shards) + 1
    dealt = rows.select("doc_id", "learn", "t").mapInArrow(deal(context.broadcast(hot), shards), PACKET)
    # Texts go with the shards, as rows below 0, so that they are cut into chunks once.
    gathered = dealt.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(gather, SHARD)
    table = stored_by(gathered, "shards", "shard", shards)
    own = table.where("shard >= 0")
    model = sample(own, hot, buckets)

    joined = own.select(*PAIRS, "asked", "asks", "chunks").join(model.customers, "shard")
    for i, state in enumerate(model.states):
        joined = joined.join(state.select("shard", *(F.col(c).alias(f"{c}_{i}") for c in ("tables", "dish_tables", "parent_tables", "around"))), "shard")
    answers = joined.mapInArrow(replies(context.broadcast((model.totals, hot, model.hot_count)), shards), REPLY)
    texts = table.where("shard < 0").select("shard", "chunk", "contexts", "places", "pairs", "texts", "rows", "named", "learn")
    answers = answers.repartition(shards, "shard")
    return texts.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(by_text(model.learned, model.totals[0].words), RESULT)
