"""Near-duplicate texts by min-max hashing of their word shingles.

Each random order of the shingles gives two values of a signature, its least and its greatest shingle,
so half as many hashes are computed as values are kept. Bands of the signature bring similar texts
together; every link is confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from sondage.llm.components import components
from sondage.llm.tables import Memo, finished, fold, give_back, mix, pieces, stored, tidy, tiles, utf8

WORDS = 5
#: 128 orders, two values each.
ORDERS = 128
#: Rows of one part of a tile, and shingles that count as one row.
TILE, TILE_SHINGLES = 1024, 512

_generator = np.random.default_rng(20)
FACTORS = _generator.integers(1, 1 << 31, ORDERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


@dataclass(frozen=True)
class Similarity:
    """Links have 100 * intersection >= percent * union. Two texts that met in a band are compared on their
    sets if a share of ``likely`` of their values agrees at least."""

    percent: int
    likely: float
    #: The places of each band's values in a signature.
    bands: np.ndarray


def similarity(percent: int, likely: float, bands: int, rows: int) -> Similarity:
    return Similarity(percent, likely, np.stack([_generator.permutation(2 * ORDERS)[:rows] for _ in range(bands)]))


#: A link of just the percentage shares no band with probability (1 - 0.85^8)^40 or (1 - 0.8^7)^50, both below
#: 1e-5, at most; ``likely`` is four standard deviations below it.
AT_85 = similarity(85, 0.76, bands=40, rows=8)
AT_80 = similarity(80, 0.70, bands=50, rows=7)


def word_numbers() -> Memo:
    return Memo(xxhash.xxh64_intdigest, 300_000)


def shingles(words: list[bytes], numbers: Memo, width: int = WORDS) -> np.ndarray:
    """Sorted 64-bit numbers of the distinct shingles of a text; a text of fewer words is one shingle,
    one without words has none."""
    if not words:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    rolled = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        rolled = mix(rolled + values[i : i + len(rolled)] + np.uint64(i + 1))
    return np.unique(rolled)


def signature(members: np.ndarray) -> np.ndarray:
    """Least and greatest value under each order, 16 bits of each."""
    least, greatest = np.full(ORDERS, np.uint32(2**32 - 1)), np.zeros(ORDERS, np.uint32)
    members = (members >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(members), 512):
        scrambled = members[start : start + 512, None] * FACTORS
        scrambled ^= scrambled >> np.uint32(15)
        scrambled *= np.uint32(0x9E3779B1)
        np.minimum(least, scrambled.min(axis=0), out=least)
        np.maximum(greatest, scrambled.max(axis=0), out=greatest)
    both = np.concatenate([least, greatest])
    return ((both * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.uint16)


def text_name(text: str = "text") -> list[Column]:
    """``text_hi`` and ``text_lo``, 128 bits that name a text; null counts as empty."""
    return [F.xxhash64(utf8(text)).alias("text_hi"), F.xxhash64(F.lit("second"), utf8(text)).alias("text_lo")]


SUMMARY = "key bigint, text_hi bigint, text_lo bigint, n_shingles bigint, set_hi bigint, set_lo bigint, bands array<bigint>, signature binary"


def summarise(docs: DataFrame, key: str = "doc_id", text: str = "text", at: Similarity = AT_85) -> DataFrame:
    """One row per text: its name, size of its shingle set, a 128-bit name of the set, band keys, signature."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = word_numbers()
        for part, texts in pieces(batches, "t"):
            rows = []
            for document in texts:
                members = shingles(fold(document), numbers)
                values = signature(members)
                names = [int(mix(members ^ np.uint64(salt)).sum(dtype=np.uint64).astype(np.int64)) for salt in (0, 0x9E3779B97F4A7C15)]
                bands = [xxhash.xxh64_intdigest(values[b].tobytes()) - (1 << 63) for b in at.bands]
                rows.append((len(members), *names, bands, values.tobytes()))
            columns = list(zip(*rows, strict=True))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            yield pa.record_batch([*part.columns[:3], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["key", "text_hi", "text_lo", "n_shingles", "set_hi", "set_lo", "bands", "signature"])

    return docs.select(F.col(key).cast("bigint").alias("key"), *text_name(text), utf8(text).alias("t")).mapInArrow(run, SUMMARY)


def enough_shared(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two shingle sets are similar enough; sets of too different sizes are not looked into."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    shared = np.count_nonzero(both[1:] == both[:-1])
    return bool(100 * shared >= percent * (len(both) - shared))


def linked(percent: int) -> Callable:
    """Whether two texts' full shingle sets are similar enough."""

    @F.pandas_udf(BooleanType())
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        numbers = word_numbers()
        for left, right in parts:
            out = []
            for a, b in zip(left, right, strict=True):
                out.append(enough_shared(shingles(fold(a), numbers), shingles(fold(b), numbers), percent))
            yield pd.Series(out)
        numbers.clear()
        give_back()

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, at: Similarity) -> DataFrame:
    """Those of the pairs ``(a, b)`` whose texts are linked."""
    right = pairs.join(texts.select(F.col("node").alias("b"), F.col("t").alias("text_b")), "b")
    both = right.join(texts.select(F.col("node").alias("a"), F.col("t").alias("text_a")), "a")
    return both.where(linked(at.percent)("text_a", "text_b")).select("a", "b")


def members_of(texts: DataFrame) -> DataFrame:
    """``(node, members)``: the shingle set of each text, its sorted 64-bit numbers one after another."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = word_numbers()
        for part, documents in pieces(batches, "t"):
            sets = [shingles(fold(document), numbers).tobytes() for document in documents]
            yield pa.record_batch([part.column(0), pa.array(sets, pa.binary())], names=["node", "members"])

    return texts.select("node", "t").mapInArrow(run, "node bigint, members binary")


def links_across(similar: Similarity) -> Callable:
    """Links between different components in one tile, no more than are needed to join what the tile joins.
    Pairs whose signatures agree enough are compared on their full sets in the first band that they share, unless
    links of the tile have joined them already; so a tile sends fewer rows than it has, however many pairs it
    compares. Rows come sorted by tile; a tile has about twice TILE rows at most, fewer if sets are large."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (band, *_), frame in by_group(batches, ["band", "bucket", "tile_i", "tile_j"]):
            left, right = frame[frame.side == 0], frame[frame.side == 1]
            diagonal = frame.tile_i.iat[0] == frame.tile_j.iat[0]
            right = left if diagonal else right
            if left.empty or right.empty:
                continue
            values = np.frombuffer(b"".join(right.signature), np.uint16).reshape(len(right), -1)
            nodes, parts = right.node.to_numpy(), right.component.to_numpy().copy()
            starts = left.component.to_numpy().copy()
            sets = [np.frombuffer(m, np.uint64) for m in right.members]
            found = []
            for i, (node, own, set_) in enumerate(zip(left.node, left.signature, left.members, strict=True)):
                wanted = (parts != starts[i]) & ((nodes > node) if diagonal else True)
                if not wanted.any():
                    continue
                at = np.flatnonzero(wanted)
                equal = values[at] == np.frombuffer(own, np.uint16)
                enough = equal.mean(axis=1) >= similar.likely
                at, equal = at[enough], equal[enough]
                mine = np.frombuffer(set_, np.uint64)
                for j in at[~equal[:, similar.bands[:band]].all(axis=2).any(axis=1)]:
                    if parts[j] != starts[i] and enough_shared(mine, sets[j], similar.percent):
                        found.append((min(node, nodes[j]), max(node, nodes[j])))
                        gone = parts[j]
                        parts[parts == gone], starts[starts == gone] = starts[i], starts[i]
            if found:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    return run


def by_group(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Frames of the rows that are equal in ``names``, from batches in which these rows are neighbours."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        frame = batch.to_pandas()
        if frame.empty:
            continue
        new = (frame[names] != frame[names].shift()).any(axis=1).to_numpy()
        starts = [*np.flatnonzero(new), len(frame)]
        for start, stop in zip(starts, starts[1:], strict=False):
            part = frame.iloc[start:stop]
            if held and tuple(held[-1][names].iloc[-1]) != tuple(part[names].iloc[0]):
                yield tuple(held[0][names].iloc[0]), pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield tuple(held[0][names].iloc[0]), pd.concat(held)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", at: Similarity = AT_85) -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` for each row of ``docs``.

    Words are parted by ASCII white space, A-Z in lower case; the set of a text has its distinct five-word
    shingles, or all its words as one shingle if they are fewer. Texts with a shared-to-all ratio of at
    least ``at.percent`` are linked; ``component_id`` is the least key a text reaches over links, ``kept``
    marks the rows of that key. Null, empty and blank texts have no shingles and form components of their own.
    Texts are read whole. Equal sets are one node from the start, so copies cost nothing further.
    Repeated rows give repeated rows, and a key on several texts joins them only where links do. Null
    keys stay alone, with a null component, and are kept."""
    return groups(docs, key, text, at).select(F.col("key").alias(key), "n_shingles", "component_id", "kept")


@finished
def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", at: Similarity = AT_85) -> DataFrame:
    """What ``near_duplicates`` says, with ``text_hi`` and ``text_lo`` that tell the texts of one key apart
    (``text_name``), and ``first``: of the rows of a group those of its least key and, under that key, of one
    text. Rows without shingles or key are first."""
    every = stored(summarise(docs, key, text, at), "summaries")
    named = every.where("n_shingles > 0 AND key IS NOT NULL")
    sets, row = ["set_hi", "set_lo"], ["key", "text_hi", "text_lo"]
    # Nodes are sets, numbered in the order of their least rows: so the hub of a bucket is its least document,
    # and buckets of one group share few hubs. The numbers are settled by being stored.
    least = F.min(F.struct(*row)).alias("row")
    numbers = named.groupBy(*sets).agg(least).orderBy("row").withColumn("node", F.monotonically_increasing_id())
    alike = named.groupBy(*sets).agg(*(F.first(c).alias(c) for c in ("n_shingles", "bands", "signature")))
    nodes = stored(alike.join(numbers, sets), "nodes")
    occupied = nodes.select("node", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    shared = occupied.groupBy("band", "bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
    shared = shared.where("hub < last").select("band", "bucket", "hub")
    met = stored(occupied.join(shared, ["band", "bucket"]), "met")

    # The text of a node is that of its row, whatever other texts have the same key.
    needed = nodes.join(met.select("node").distinct(), "node", "left_semi").select("node", "row.*")
    texts = docs.select(F.col(key).cast("bigint").alias("key"), *text_name(text), utf8(text).alias("t"))
    texts = stored(texts.join(needed, row).dropDuplicates(row).select("node", "t"), "texts")

    # First everything against the least node of its bucket.
    sizes = nodes.select(F.col("node").alias("hub"), F.col("n_shingles").alias("hub_size"))
    stars = met.where("hub < node").select("hub", "node", "n_shingles").distinct().join(sizes, "hub")
    stars = stars.where(f"100 * least(n_shingles, hub_size) >= {at.percent} * greatest(n_shingles, hub_size)")
    links = stored(confirmed(stars.select(F.col("hub").alias("a"), F.col("node").alias("b")), texts, at), "stars")
    joined = stored(components(links), "joined")

    # Then, in buckets that still hold several components, across those. Pairs stay inside their tile, where the
    # sets are: in a group whose members are similar, but few of them enough, there are as many as its square.
    placed = met.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("band", "bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rest = placed.join(mixed.select("band", "bucket"), ["band", "bucket"]).select("band", "bucket", "node", "component")
    rest = stored(rest.join(nodes.select("node", "n_shingles", "signature"), "node"), "rest")
    sets_of = stored(members_of(texts.join(rest.select("node").distinct(), "node", "left_semi")), "members")
    rest = tiles(rest, ["band", "bucket"], "node", TILE, weight=F.greatest(F.lit(1), F.col("n_shingles") / TILE_SHINGLES)).join(sets_of, "node")
    tile = ["band", "bucket", "tile_i", "tile_j"]
    rest = rest.select(*tile, "side", "node", "component", "signature", "members").repartition(*tile).sortWithinPartitions(*tile)
    links = links.unionByName(rest.mapInArrow(links_across(at), "a bigint, b bigint"))

    rows = nodes.select("node", "row")
    found = stored(components(links).join(rows, "node"), "found")
    least = found.groupBy("component").agg(F.min("row").alias("least"))
    found = found.join(least, "component").select("node", "least")
    placed = nodes.select("node", *sets, "row").join(found, "node", "left").select(*sets, F.coalesce("least", "row").alias("least"))
    result = every.join(placed, sets, "left")
    grouped = (F.col("n_shingles") > 0) & F.col("key").isNotNull()
    result = result.withColumn("component_id", F.when(grouped, F.col("least.key")).otherwise(F.col("key")))
    return result.select(
        *row, "n_shingles", "component_id", F.coalesce(F.col("key") == F.col("component_id"), F.lit(True)).alias("kept"),
        (~grouped | F.struct(*row).eqNullSafe(F.col("least"))).alias("first"),
    )
