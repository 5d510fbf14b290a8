"""How the words of each source differ from those of its language and of the language's other sources.

Texts are factorised into chunks between white space: a task counts each document's chunks and merges
them, every chunk that occurs anywhere is cut into terms once, and the terms are joined back to the counts. What
the audit needs of a term are its occurrences, which are sums, and whether enough documents have it. Most
terms are settled by a single chunk that many documents have, or by too few documents over all of
a term's chunks; documents are told apart only for the terms in between.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sondage.llm.tables import BATCH_BYTES, finished, pieces, stored, utf8

# A term is a run of letters A-Z and of whatever is beyond ASCII; here its bytes, folded.
TERM = re.compile(rb"[a-z\x80-\xff]+")
#: Parameters: documents of its language that a term needs, and places of the list of terms.
LEAST_DOCUMENTS, PLACES = 10, 10
UNIT, PRIOR = 1_000_000_000, 2
#: A task merges the chunk counts of its documents until it has so many of them, or so many distinct chunks.
COUNTED, DISTINCT = 2_000_000, 400_000
#: Rows that are merged at once after the shuffle.
MERGED = 100_000
BLANKS = b" \t\n\r\x0b\x0c"

#: Numbers are written one behind the other as 64-bit integers: those of documents in ``ids``; in ``own`` each
#: source's hash and its occurrences.
COUNTS = "lang string, chunk binary, docs bigint, ids binary, own binary"
TERMS = "lang string, term string, docs bigint, ids array<bigint>, sources array<bigint>, counts array<bigint>"


def chunks_of(text: bytes, limit: int = BATCH_BYTES) -> Counter:
    """Chunks of a text with A-Z in lower case, parted by the ASCII white space. A long text is cut in
    lower-case parts at white space, so that only the chunks of one part are held beside the counts."""
    if len(text) <= limit:
        return Counter(text.lower().split())
    out, at = Counter(), 0
    while at < len(text):
        stop = at + limit
        while stop < len(text) and text[stop] not in BLANKS:
            stop += 1
        out.update(text[at:stop].lower().split())
        at = stop
    return out


@dataclass
class Rows:
    """Rows ``(chunk, lang, docs)`` with the numbers of ``sizes[0]`` documents and ``sizes[1]`` sources each;
    chunks and languages are numbered by the caller."""

    chunk: np.ndarray
    lang: np.ndarray
    docs: np.ndarray
    sizes: tuple[np.ndarray, np.ndarray]
    ids: np.ndarray
    source: np.ndarray
    n: np.ndarray

    def merged(self, least: int) -> Rows:
        """A row for each chunk and language, in this order, with a number for each source. Documents are
        named while they are fewer than ``least``, so merging what was merged before changes nothing."""
        order = in_order(self.chunk, self.lang)
        chunk, lang = self.chunk[order], self.lang[order]
        first = starts(chunk, lang)
        row = np.empty(len(order), np.int64)
        row[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(order)))
        docs = np.add.reduceat(self.docs[order], first) if len(first) else self.docs
        of_id = np.repeat(row, self.sizes[0])
        few = docs[of_id] < least
        of_id, ids = of_id[few], self.ids[few]
        of_own = np.repeat(row, self.sizes[1])
        by_source = in_order(of_own, ranks(self.source))
        of_own, source = of_own[by_source], self.source[by_source]
        own = starts(of_own, source)
        n = np.add.reduceat(self.n[by_source], own) if len(own) else self.n
        sizes = np.bincount(of_id, minlength=len(first)), np.bincount(of_own[own], minlength=len(first))
        return Rows(chunk[first], lang[first], docs, sizes, ids[np.argsort(of_id, kind="stable")], source[own], n)

    def sent(self, chunks: pa.Array, langs: pa.Array) -> pa.RecordBatch:
        own = np.stack([self.source, self.n], axis=1)
        arrays = [langs.take(pa.array(self.lang)), chunks.take(pa.array(self.chunk)), pa.array(self.docs), packed(self.ids, self.sizes[0]), packed(own, self.sizes[1])]
        return pa.record_batch(arrays, names=["lang", "chunk", "docs", "ids", "own"])


def in_order(major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """Places of rows by two small numbers, as one number: it is sorted much faster than one after the other."""
    return np.argsort(major.astype(np.int64) * (int(minor.max(initial=0)) + 1) + minor)


def ranks(values: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in the order of the values, which repeat often; so they are told apart by hashing."""
    coded = pa.array(values).dictionary_encode()
    order = np.argsort(coded.dictionary.to_numpy())
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place[coded.indices.to_numpy()]


def starts(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def packed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Rows of numbers (or of tuples of them) as binaries."""
    offsets = np.append(0, np.cumsum(sizes) * values[:1].nbytes).astype(np.int32) if len(values) else np.zeros(len(sizes) + 1, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows, as they lie there, and how many bytes each row has."""
    column = column.cast(pa.large_binary())
    _, offsets, values = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or ends[0] == ends[-1]:
        return np.empty(0, np.int64), np.diff(ends)
    return np.frombuffer(values, np.int64, (ends[-1] - ends[0]) // 8, ends[0]), np.diff(ends)


class Counted:
    """Chunk counts of documents, as numbers in flat arrays until they are merged."""

    def __init__(self):
        self.chunks, self.langs = defaultdict(), defaultdict()
        for names in (self.chunks, self.langs):
            names.default_factory = names.__len__
        self.chunk, self.n = array("i"), array("q")
        self.docs: list[tuple[int, int, int, int]] = []

    def add(self, number: int, lang: str, source: int, chunks: Counter) -> None:
        self.chunk.extend(map(self.chunks.__getitem__, chunks))
        self.n.extend(chunks.values())
        self.docs.append((number, self.langs[lang], source, len(chunks)))

    def merged(self, least: int) -> pa.RecordBatch:
        number, lang, source, sizes = np.array(self.docs, np.int64).T
        number, lang, source = (np.repeat(x, sizes) for x in (number, lang, source))
        each = np.ones(len(number), np.int64)
        rows = Rows(np.frombuffer(self.chunk, np.int32), lang, each, (each, each), number, source, np.frombuffer(self.n, np.int64))
        return rows.merged(least).sent(pa.array(list(self.chunks), pa.binary()), pa.array(list(self.langs), pa.string()))


def chunk_counts(docs: DataFrame, lang: str, source: str, text: str, least: int) -> DataFrame:
    """``(lang, chunk, docs, ids, own)``, merged within a task as far as memory goes: documents with the
    chunk, their numbers if they are fewer than ``least``, and occurrences by source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, counted = TaskContext.get().partitionId() << 40, Counted()
        for part, texts in pieces(batches, "t"):
            for own_lang, own_source, document in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts, strict=True):
                number += 1
                if found := chunks_of(document):
                    counted.add(number, own_lang, own_source, found)
                if len(counted.chunk) >= COUNTED or len(counted.chunks) >= DISTINCT:
                    yield counted.merged(least)
                    counted = Counted()
        if counted.docs:
            yield counted.merged(least)

    given = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), source_key(source).alias("source"), utf8(text).alias("t"))
    return given.mapInArrow(run, COUNTS)


def source_key(source: str) -> Column:
    """64 bits stand for a source while chunks are counted; sources are few beside rows."""
    return F.xxhash64(F.coalesce(F.col(source).cast("string"), F.lit("")))


def merge(table: pa.Table, least: int) -> pa.RecordBatch:
    """Rows of sorted chunks, merged."""
    columns = {name: table.column(name).combine_chunks() for name in table.column_names}
    chunk, lang = columns["chunk"].dictionary_encode(), columns["lang"].dictionary_encode()
    ids, id_bytes = unpacked(columns["ids"])
    own, own_bytes = unpacked(columns["own"])
    codes = (x.indices.to_numpy(zero_copy_only=False) for x in (chunk, lang))
    rows = Rows(*codes, columns["docs"].to_numpy(), (id_bytes // 8, own_bytes // 16), ids, own[::2], own[1::2])
    return rows.merged(least).sent(chunk.dictionary, lang.dictionary)


def terms_of(rows: pa.RecordBatch) -> pa.RecordBatch:
    """A row for each term of each row; chunks follow each other, and each is cut into terms once."""
    chunk = rows.column(1).dictionary_encode()
    found = [TERM.findall(c) for c in chunk.dictionary.to_pylist()]
    sizes = np.array([len(f) for f in found], np.int64)
    before, codes = np.cumsum(sizes) - sizes, chunk.indices.to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(codes)), sizes[codes])
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes[codes]) - sizes[codes], sizes[codes])
    terms = pa.array([t.decode("utf-8", "replace") for f in found for t in f], pa.string()).take(pa.array(before[codes[row]] + place))
    ids, id_bytes = unpacked(rows.column(3).take(pa.array(row)))
    own, own_bytes = unpacked(rows.column(4).take(pa.array(row)))
    arrays = [rows.column(0).take(pa.array(row)), terms, rows.column(2).take(pa.array(row)), lists(ids, id_bytes // 8), lists(own[::2], own_bytes // 16), lists(own[1::2], own_bytes // 16)]
    return pa.record_batch(arrays, names=["lang", "term", "docs", "ids", "sources", "counts"])


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(values))


def terms_by_chunk(counted: DataFrame, least: int) -> DataFrame:
    """``(lang, term, docs, ids, sources, counts)``: the counts of every chunk joined with its terms.

    Chunks are sorted by their hash within their partition, so all counts of a chunk follow each other: they are
    merged, the chunk is cut into terms, and these take the counts up. Counts of a chunk that goes on are merged as
    they come, so memory does not grow with its rows. Where two chunks share a hash, one may come in several rows;
    that changes nothing, since each names its documents unless it has enough of them, and terms are added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < MERGED:
                continue
            rows = merge(pa.Table.from_batches(held), least)
            # The last chunk may go on in the next batch.
            last = starts(rows.column(1).dictionary_encode().indices.to_numpy(zero_copy_only=False))[-1]
            yield terms_of(rows.slice(0, last))
            held = [rows.slice(last)]
        if held:
            yield terms_of(merge(pa.Table.from_batches(held), least))

    return counted.repartition("chunk").sortWithinPartitions(F.xxhash64("chunk")).mapInArrow(run, TERMS)


def term_counts(counted: DataFrame, least: int) -> DataFrame:
    """``(lang, source, term, n)`` for the terms that at least ``least`` documents of the language have;
    ``source`` is the source's key."""
    found = stored(terms_by_chunk(counted, least), "terms")
    bounds = found.groupBy("lang", "term").agg(F.max("docs").alias("fewest"), F.sum("docs").alias("most")).where(F.col("most") >= least)
    bounds = stored(bounds, "bounds")
    open_terms = bounds.where(F.col("fewest") < least).select("lang", "term")
    told_apart = found.join(open_terms, ["lang", "term"], "left_semi").select("lang", "term", F.explode("ids").alias("id")).distinct()
    enough = told_apart.groupBy("lang", "term").agg(F.count("*").alias("docs")).where(F.col("docs") >= least)
    kept = bounds.where(F.col("fewest") >= least).select("lang", "term").unionByName(enough.select("lang", "term"))
    held = found.select("lang", "term", "sources", "counts").join(kept, ["lang", "term"])
    each = held.select("lang", "term", F.inline(F.arrays_zip("sources", "counts")))
    return each.groupBy("lang", F.col("sources").alias("source"), "term").agg(F.sum("counts").alias("n"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """A smoothed share in parts of UNIT, rounded down, plus one; whole numbers throughout."""
    above = (n + PRIOR).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", above, (total + PRIOR * terms).cast("decimal(20,0)")) + 1


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def pair_values(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for every two sources of a language: the sum over all its terms.

    Terms that neither source has all differ alike, and a term that one of them lacks is met by the share
    of absent terms. So the sum is taken over the terms of each side, by their shares, and put right
    for the terms that both have, of which alone pairs are made."""
    alone = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
    own = groups.select("lang", "source", "terms", "held", F.col("absent").alias("p0"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("held").alias("item_held"), F.col("absent").alias("q0"))
    pairs = own.join(other, "lang").where("source <> item")
    # Every ordered pair, its first source's terms against the share that the second gives absent terms.
    one_side = pairs.select("lang", "source", "item", "q0").join(alone, ["lang", "source"]).select(
        "lang", F.least("source", "item").alias("a"), F.greatest("source", "item").alias("b"), (F.col("m") * apart(F.col("p"), F.col("q0"))).alias("value")
    )
    neither = pairs.where("source < item").select(
        "lang", F.col("source").alias("a"), F.col("item").alias("b"), ((F.col("terms") - F.col("held") - F.col("item_held")) * F.coalesce(apart(F.col("p0"), F.col("q0")), F.lit(0))).alias("value")
    )
    left = shares.select("lang", "term", F.col("source").alias("a"), "p", F.col("absent").alias("p0"))
    right = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("q"), F.col("absent").alias("q0"))
    p, q, p0, q0 = map(F.col, ("p", "q", "p0", "q0"))
    both = left.join(right, ["lang", "term"]).where("a < b").select("lang", "a", "b", (apart(p, q) - apart(p, q0) - apart(p0, q) + apart(p0, q0)).alias("value"))
    summed = one_side.unionByName(neither).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return summed.select("lang", "value", sides.alias("side")).select("lang", "side.source", "side.item", "value")


@finished
def audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST_DOCUMENTS, places: int = PLACES,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: for each source of each language the other sources by
    distance (part ``pair``), and the terms it has in excess of the language, ``places`` of them (part ``term``).

    Null texts, languages and sources count as empty ones. Every group that occurs takes part, even
    without terms; a language without terms has distances of 0, one with a single source none. Equal
    values are ranked by item in UTF-8 order. Each row is a document, so repeated rows count as often as
    they stand; texts are read whole. An empty table gives no rows; other columns are not looked at."""
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source")))).distinct()
    keys = named.select("source", source_key("source").alias("key")).distinct()
    terms = term_counts(chunk_counts(docs, lang, source, text, least), least).withColumnRenamed("source", "key")
    terms = stored(terms.join(keys, "key").select("lang", "source", "term", "n"), "kept")
    held = terms.groupBy("lang", "source").agg(F.count("*").alias("held"), F.sum("n").alias("total"))
    whole = terms.groupBy("lang", "term").agg(F.sum("n").alias("all_n"))
    langs = whole.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all_n").alias("all_total"))
    groups = named.join(held, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    absent = F.when(F.col("terms") > 0, share(F.lit(0).cast("bigint"), F.col("total"), F.col("terms")))
    groups = stored(groups.withColumn("absent", absent), "groups")
    shares = terms.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    shares = stored(shares.select("lang", "source", "term", "p", "absent"), "shares")

    in_all = whole.join(langs, "lang").select("lang", "term", share(F.col("all_n"), F.col("all_total"), F.col("terms")).alias("q"))
    over = shares.join(in_all, ["lang", "term"]).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= places)
    far = pair_values(shares, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))
    return far.unionByName(best)
