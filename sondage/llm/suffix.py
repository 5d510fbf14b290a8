"""Repeated passages by sorting suffixes.

A passage is a string of LENGTH bytes that starts at two places or more. Suffixes enter the sort as short
rows of tokens, 64-bit digests of stretches of text, which order them as well as the bytes do when only
equality counts. Splitters sampled from the rows part them into ranges by their leading tokens; each
range is sorted by multikey quicksort, neighbours are compared, and so are the ends of adjoining ranges.

Three passes keep the number of suffixes small. The first sorts one suffix for every stretch of places
whose passages share their least GRAM: passages that repeat must share it. The second takes the places
within stretches so found, in blocks that end at marks set by the text itself: the suffix that starts a
fixed way behind each mark, with the few bytes around it that tell the block's places apart. Blocks
alike in that suffix are compared place by place. The third, only for suffixes that very many blocks
share, sorts the passages of their places one by one.

Passages of a number of words are found in the same way, with words in the place of bytes and without
blocks: words are fewer, so the places within repeated stretches are sorted one by one.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sondage.llm.tables import Memo, finished, mix, pieces, row_key, stored, tidy, unused, utf8

LENGTH, GRAM = 400, 64
#: A block of places ends at a mark; if none follows within REACH places, the place is its own block.
REACH, MARK_GRAM, MARK_SHARE = 32, 8, 10
ROWS, CHUNK = 400_000, 16_384
#: Distinct blocks that a task remembers, some 200 bytes each.
SEEN = 300_000
#: Blocks that share a suffix with more than so many others are taken place by place.
CROWD = 4_096
#: Words of the grams by which passages of words meet.
WORD_GRAM = 8

_generator = np.random.default_rng(10)
LETTERS = _generator.integers(0, 2**64, (2, 256), dtype=np.uint64)
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Roller:
    """Digests of any stretch of a text from running sums of its letters' values."""

    def __init__(self):
        self.up = self.down = np.ones((2, 1), np.uint64)

    def read(self, letters: np.ndarray, which: int = 0) -> np.ndarray:
        return self.add(LETTERS[which][letters], which)

    def add(self, values: np.ndarray, which: int = 0) -> np.ndarray:
        if len(values) >= self.up.shape[1]:
            size = 2 * len(values) + 2
            up, down = np.ones((2, size), np.uint64), np.ones((2, size), np.uint64)
            for i, base in enumerate(BASES):
                up[i, 1:], down[i, 1:] = np.uint64(base), np.uint64(pow(base, -1, 2**64))
            self.up, self.down = np.cumprod(up, axis=1), np.cumprod(down, axis=1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[which, : len(values)], out=sums[1:])
        return sums

    def digest(self, sums: np.ndarray, start, stop, which: int = 0) -> np.ndarray:
        return mix((sums[stop] - sums[start]) * self.down[which, start])

    def grams(self, sums: np.ndarray, width: int, which: int = 0) -> np.ndarray:
        return mix((sums[width:] - sums[:-width]) * self.down[which, : len(sums) - width])


def least_within(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` neighbours."""
    if width == 1 or len(values) < width:
        return values if width == 1 else values[:0]
    padded = np.full(-(-len(values) // width) * width, values.max())
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(values) - width + 1], ahead[width - 1 : len(values)])


def stretch(row: int, grams: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Token, row, start and number of places of each stretch of places that share the least of their
    ``width`` grams."""
    least = least_within(grams, width)
    starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    stops = np.r_[starts[1:], len(least)]
    tokens = least[starts]
    # A stretch in which the gram stands twice may repeat itself: it counts twice.
    twice = [np.count_nonzero(grams[a : b + width - 1] == t) > 1 for a, b, t in zip(starts, stops, tokens, strict=True)]
    times = 1 + np.array(twice, int)
    return np.repeat(tokens, times), np.full(times.sum(), row), np.repeat(starts, times), np.repeat(stops - starts, times)


def stretches(texts: list[bytes], rows: np.ndarray, roller: Roller) -> Iterator[tuple]:
    """The stretches of places whose passages share their least gram."""
    for row, document in zip(rows, texts, strict=True):
        if len(document) >= LENGTH:
            yield stretch(row, roller.grams(roller.read(np.frombuffer(document, np.uint8)), GRAM), LENGTH - GRAM + 1)


def multikey(tokens: list[np.ndarray]) -> np.ndarray:
    """Order of rows by their tokens, first token first: three-way quicksort on one token at a time, which
    goes on to the next only among equals. Short pieces are sorted outright."""
    order = np.arange(len(tokens[0]))
    todo = [(0, len(order), 0)]
    while todo:
        start, stop, depth = todo.pop()
        part = order[start:stop]
        if stop - start <= 65_536 or depth == len(tokens) - 1:
            order[start:stop] = part[np.lexsort([t[part] for t in reversed(tokens[depth:])])]
            continue
        values = tokens[depth][part]
        pivot = np.sort(values[:: len(values) // 101])[50]
        below, above = values < pivot, values > pivot
        order[start:stop] = np.concatenate([part[below], part[~(below | above)], part[above]])
        first, last = start + np.count_nonzero(below), stop - np.count_nonzero(above)
        todo += [(a, b, d) for a, b, d in ((start, first, depth), (first, last, depth + 1), (last, stop, depth)) if b - a > 1]
    return order


def _signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


KEYED = "token bigint, tail bigint, row bigint, start bigint, width int"


@tidy
def compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort one range of suffixes; give the rows that equal a neighbour (``found``) and both ends."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    whole = pa.Table.from_batches(held)
    token, tail = (whole.column(c).to_numpy().view(np.uint64) for c in ("token", "tail"))
    order = multikey([token, tail])
    token, tail = token[order], tail[order]
    same = (token[1:] == token[:-1]) & (tail[1:] == tail[:-1])
    found = np.r_[False, same] | np.r_[same, False]
    wanted = found.copy()
    wanted[[0, -1]] = True
    sorted_rows = whole.take(pa.array(order[wanted]))
    ends = np.zeros(len(order), bool)
    ends[[0, -1]] = True
    yield from sorted_rows.append_column("found", pa.array(found[wanted])).append_column("end", pa.array(ends[wanted])).combine_chunks().to_batches(20_000)


def repeated(suffixes: DataFrame, parts: int) -> DataFrame:
    """``(row, start, width)`` of the suffixes whose tokens occur more than once.

    The ranges are cut by all columns, so that equal suffixes, however many, are spread over ranges."""
    dealt = suffixes.select("token", "tail", "row", "start", "width").repartitionByRange(parts, "token", "tail", "row", "start")
    compared = stored(dealt.mapInArrow(compare_neighbours, f"{KEYED}, found boolean, end boolean"), "compared")
    # Two rows for each range: where a suffix stands alone in its range, its equals may be at the border.
    ends = compared.where("end")
    borders = ends.groupBy("token", "tail").agg(F.count("*").alias("n")).where("n > 1").select("token", "tail")
    across = ends.where("NOT found").join(F.broadcast(borders), ["token", "tail"], "left_semi") if parts <= 50_000 else ends.where("NOT found").join(borders, ["token", "tail"], "left_semi")
    return compared.where("found").unionByName(across).select("row", "start", "width")


def blocks(document: bytes, places: np.ndarray, roller: Roller) -> tuple[np.ndarray, ...] | None:
    """Marks that end a block of the wanted places, the first and last distance from a place to its mark."""
    letters = np.frombuffer(document, np.uint8)
    sums = roller.read(letters)
    marked = roller.grams(sums, MARK_GRAM) % np.uint64(MARK_SHARE) == 0
    marks = np.flatnonzero(marked)
    after = np.searchsorted(marks, places)
    mark = np.where(after < len(marks), marks[np.minimum(after, max(0, len(marks) - 1))] if len(marks) else 0, len(document) * 2)
    mark = np.where(mark - places < REACH, mark, places)
    starts = np.flatnonzero(np.r_[True, mark[1:] != mark[:-1]])
    stops = np.r_[starts[1:], len(mark)]
    at = mark[starts]
    return at, at - places[stops - 1], at - places[starts], sums


def place_ranges(ranges: np.ndarray, size: int) -> np.ndarray:
    """Places covered by rows of (start, width)."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, ranges[:, 0], 1)
    np.add.at(change, ranges[:, 0] + ranges[:, 1], -1)
    return np.flatnonzero(np.cumsum(change[:-1]) > 0)


def spans_of(starts: np.ndarray, widths: np.ndarray, longer: int) -> np.ndarray:
    """Merged (start, stop) of ranges, each made ``longer`` at its end; touching ranges become one."""
    order = np.argsort(starts, kind="stable")
    begin, end = starts[order], (starts + widths + longer)[order]
    reach = np.maximum.accumulate(end)
    first = np.flatnonzero(np.r_[True, begin[1:] > reach[:-1]])
    return np.stack([begin[first], reach[np.r_[first[1:] - 1, len(reach) - 1]]], axis=1)


BLOCK = "token bigint, row bigint, mark bigint, near int, far int, around binary"


@tidy
def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block rows of the texts' candidate places: the digest of the LENGTH - REACH + 1 bytes from the mark
    on, and those of the REACH - 1 bytes on either side that passages of the block reach.

    Of equal blocks in one task only the first is sent on. The places of all of them repeat, and are given
    at once, as rows without bytes around them; so what is very common shrinks before it is dealt out."""
    roller, stem, wide = Roller(), LENGTH - REACH + 1, REACH - 1
    seen: dict[bytes, tuple[int, int] | None] = {}
    for part, texts in pieces(batches, "t"):
        sent, known = [], []
        for row, document, ranges in zip(part.column(0).to_pylist(), texts, part.column(2).to_pylist(), strict=True):
            ranges = np.array([(r["start"], r["width"]) for r in ranges], np.int64).reshape(-1, 2)
            marks, nears, fars, sums = blocks(document, place_ranges(ranges, len(document)), roller)
            tokens = _signed(roller.digest(sums, marks, marks + stem))
            if len(seen) > SEEN:
                seen.clear()
            run: list[int] | None = None
            for token, mark, near, far in zip(tokens.tolist(), marks.tolist(), nears.tolist(), fars.tolist(), strict=True):
                around = document[max(0, mark - far) : mark].rjust(wide, b"\0") + document[mark + stem : mark + LENGTH - near].ljust(wide, b"\0")
                # Keys are digests, which take less memory than the bytes and numbers themselves.
                key = xxhash.xxh3_128_digest(struct.pack("<qii", token, near, far) + around)
                if key not in seen:
                    seen[key] = (row, mark)
                    sent.append((token, row, mark, near, far, around))
                    continue
                if seen[key]:
                    first, there = seen[key]
                    known.append((0, first, there, near, far, None))
                    seen[key] = None
                # Neighbouring blocks of a text become one range.
                if run and run[2] == mark - far - 1:
                    run[2], run[4] = mark - near, run[4] + far - near + 1
                else:
                    run = [0, row, mark - near, 0, far - near, None]
                    known.append(run)
        if sent or known:
            columns = list(zip(*sent, *known, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["token", "row", "mark", "near", "far", "around"])


def around_digests(around: np.ndarray, which: int) -> Iterator[np.ndarray]:
    """For each distance from place to mark, the digest of the bytes around the stem that belong to the
    place's passage: as many before it as the distance, and the rest behind it."""
    values = mix(LETTERS[which][around] + np.arange(around.shape[1], dtype=np.uint64) * np.uint64(BASES[which]))
    before, behind = values[:, : REACH - 1], values[:, REACH - 1 :]
    zero = np.zeros((len(around), 1), np.uint64)
    left = np.concatenate([zero, np.cumsum(before[:, ::-1], axis=1, dtype=np.uint64)], axis=1)
    right = np.concatenate([zero, np.cumsum(behind, axis=1, dtype=np.uint64)], axis=1)
    for distance in range(REACH):
        yield mix(left[:, distance] + right[:, REACH - 1 - distance] * np.uint64(BASES[1 - which]))


def places_of(table: pa.Table) -> Iterator[tuple]:
    """(token, tail, row, start) of all places of block rows, distance by distance."""
    token = table.column("token").to_numpy().view(np.uint64)
    row, mark, near, far = (table.column(c).to_numpy() for c in ("row", "mark", "near", "far"))
    joined = b"".join(table.column("around").to_pylist())
    around = np.frombuffer(joined, np.uint8).reshape(len(token), 2 * (REACH - 1))
    for distance, (first, second) in enumerate(zip(around_digests(around, 0), around_digests(around, 1), strict=True)):
        there = (near <= distance) & (distance <= far)
        if there.any():
            salt = np.uint64(distance)
            yield mix(token[there] + salt) ^ first[there], mix(token[there] ^ second[there]), row[there], mark[there] - distance


RANGES = "row bigint, start bigint, width int"


@tidy
def compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of one range of blocks whose passages occur more than once; equal stems share a range."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    whole = pa.Table.from_batches(held)
    tokens = whole.column("token").to_numpy().view(np.uint64)
    whole, tokens = whole.take(pa.array(order := multikey([tokens]))), tokens[order]
    # Cut between stems into chunks of about CHUNK rows, so that the bytes around them stay few at a time.
    firsts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
    cuts = np.unique(np.r_[firsts[np.searchsorted(firsts, np.arange(0, len(tokens), CHUNK), side="right") - 1], len(tokens)])
    for begin, stop in zip(cuts, cuts[1:], strict=False):
        rows, starts = [], []
        for token, tail, row, start in places_of(whole.slice(begin, stop - begin)):
            order = multikey([token, tail])
            token, tail = token[order], tail[order]
            same = (token[1:] == token[:-1]) & (tail[1:] == tail[:-1])
            found = order[np.r_[False, same] | np.r_[same, False]]
            rows.append(row[found])
            starts.append(start[found])
        row, start = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (rows, starts))
        order = np.lexsort([start, row])
        row, start = row[order], start[order]
        new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (start[1:] > start[:-1] + 1)]) if len(row) else np.empty(0, int)
        if len(new):
            last = np.r_[new[1:] - 1, len(row) - 1]
            yield pa.record_batch([pa.array(row[new]), pa.array(start[new]), pa.array((start[last] - start[new] + 1).astype(np.int32))], names=["row", "start", "width"])


@tidy
def single_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The passages of crowded blocks as suffixes of two tokens each."""
    for batch in batches:
        if batch.num_rows:
            for token, tail, row, start in places_of(pa.Table.from_batches([batch])):
                yield pa.record_batch([pa.array(_signed(token)), pa.array(_signed(tail)), pa.array(row), pa.array(start), pa.array(np.ones(len(row), np.int32))], names=["token", "tail", "row", "start", "width"])


def stretch_batch(found: list[tuple]) -> pa.RecordBatch:
    token, row, start, width = (np.concatenate(c) for c in zip(*found, strict=True))
    return pa.record_batch([pa.array(_signed(token)), pa.array(np.zeros(len(row), np.int64)), pa.array(row), pa.array(start), pa.array(width.astype(np.int32))], names=["token", "tail", "row", "start", "width"])


@tidy
def stretch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    roller = Roller()
    for part, texts in pieces(batches, "t"):
        found = list(stretches(texts, part.column(0).to_numpy(), roller))
        if found:
            yield stretch_batch(found)


def parts_for(rows: int) -> int:
    return max(1, -(-rows // ROWS))


def repeated_places(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Texts that may hold repeated passages, and the ``(row, start, width)`` ranges of places where one
    starts. Rows are named by ``row_key``. Of equal texts one stands for all: every passage of a text that
    has a copy repeats, which needs no search."""
    named = docs.select(row_key(key, text).alias("row"), utf8(text).alias("t"))
    long = named.select("row", F.md5("t").alias("name"), F.octet_length("t").alias("size")).where(F.col("size") >= LENGTH)
    copies = long.groupBy("name", "size").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    chosen = stored(copies, "copies")
    suffixes = stored(named.mapInArrow(stretch_rows, KEYED), "stretches")
    apart = suffixes.join(chosen.select(F.col("first").alias("row")), "row", "left_semi")
    ranges = repeated(apart, parts_for(suffixes.count()))
    copied = chosen.where("n > 1").select("name", "size")
    same = long.join(copied, ["name", "size"]).select("row", F.lit(0).cast("bigint").alias("start"), (F.col("size") - LENGTH + 1).alias("width"))
    ranges = ranges.groupBy("row").agg(F.collect_set(F.struct("start", "width")).alias("ranges"))
    texts = stored(named.join(ranges, "row").select("row", "t", "ranges").dropDuplicates(["row"]), "texts")

    given = stored(texts.mapInArrow(cut_blocks, BLOCK), "blocks")
    rows = given.where("around IS NOT NULL")
    known = given.where("around IS NULL").select("row", (F.col("mark") - F.col("far")).alias("start"), (F.col("far") - F.col("near") + 1).cast("int").alias("width"))
    crowded = rows.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("token")
    crowded = stored(crowded, "crowded")
    parts, busy = parts_for(rows.count()), not crowded.isEmpty()
    quiet = rows.join(crowded, "token", "left_anti") if busy else rows
    found = quiet.repartitionByRange(parts, "token").mapInArrow(compare_blocks, RANGES)
    if busy:
        loud = stored(rows.join(crowded, "token", "left_semi").mapInArrow(single_places, KEYED), "places")
        found = found.unionByName(repeated(loud, parts_for(loud.count())))
    return named, stored(found.unionByName(known).unionByName(same), "repeated")


def word_values(document: bytes, memo: Memo) -> np.ndarray:
    words = document.split()
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def word_memo() -> Memo:
    return Memo(xxhash.xxh64_intdigest, 300_000)


def word_stretch_rows(words: int):
    """Stretches of places, counted in words, whose passages of so many words share their least gram."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, memo, gram = Roller(), word_memo(), min(WORD_GRAM, words)
        for part, texts in pieces(batches, "t"):
            values = [word_values(t, memo) for t in texts]
            found = [
                stretch(row, roller.grams(roller.add(v), gram), words - gram + 1)
                for row, v in zip(part.column(0).to_numpy(), values, strict=True) if len(v) >= words
            ]
            if found:
                yield stretch_batch(found)

    return run


def word_edges(document: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word and the byte behind it."""
    letters = np.frombuffer(document, np.uint8)
    inside = ~((letters == 32) | ((letters >= 9) & (letters <= 13)))
    change = np.flatnonzero(np.diff(np.r_[False, inside, False].astype(np.int8)))
    return change[::2], change[1::2]


def word_passages(words: int):
    """The passages of so many words that start at the texts' candidate places, as suffixes of two tokens
    with the bytes that they take up. Of equal ones in one task only the first is sent on; all of them
    repeat, and are given at once as ``known`` ranges of bytes."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, memo = Roller(), word_memo()
        seen: dict[tuple, tuple[int, int, int] | None] = {}
        for part, texts in pieces(batches, "t"):
            out = []
            for row, document, ranges in zip(part.column(0).to_pylist(), texts, part.column(2).to_pylist(), strict=True):
                values, (starts, stops) = word_values(document, memo), word_edges(document)
                places = place_ranges(np.array([(r["start"], r["width"]) for r in ranges], np.int64).reshape(-1, 2), len(values))
                token = _signed(roller.digest(roller.add(values), places, places + words))
                tail = _signed(roller.digest(roller.add(mix(values + np.uint64(1)), 1), places, places + words, 1))
                if len(seen) > SEEN:
                    seen.clear()
                ranged: list | None = None
                last = -2
                for place, *key, start, stop in zip(places.tolist(), token.tolist(), tail.tolist(), starts[places].tolist(), stops[places + words - 1].tolist(), strict=True):
                    name = tuple(key)
                    if name not in seen:
                        seen[name] = (row, start, stop - start)
                        out.append([*name, row, start, stop - start, False])
                        continue
                    if seen[name]:
                        out.append([0, 0, *seen[name], True])
                        seen[name] = None
                    # Neighbouring passages of a text become one range.
                    if ranged and last == place - 1:
                        ranged[4] = stop - ranged[3]
                    else:
                        ranged = [0, 0, row, start, stop - start, True]
                        out.append(ranged)
                    last = place
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["token", "tail", "row", "start", "width", "known"])

    return run


def repeated_words(named: DataFrame, words: int) -> DataFrame:
    """``(row, start, width)`` of the bytes of passages of so many words that start at two places or more,
    whatever white space stands between the words. Copies of a row repeat each other."""
    suffixes = stored(named.mapInArrow(word_stretch_rows(words), KEYED), "word-stretches")
    ranges = repeated(suffixes, parts_for(suffixes.count())).groupBy("row").agg(F.collect_set(F.struct("start", "width")).alias("ranges"))
    texts = named.join(ranges, "row").select("row", "t", "ranges")
    given = stored(texts.mapInArrow(word_passages(words), f"{KEYED}, known boolean"), "word-passages")
    rows = given.where("NOT known")
    found = repeated(rows, parts_for(rows.count()))
    return stored(found.unionByName(given.where("known").select("row", "start", "width")), "repeated-words")


SPANS = "row bigint, spans array<struct<start: bigint, stop: bigint>>, kept binary"


@tidy
def take_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in pieces(batches, "t"):
        every, kept = [], []
        for document, ranges in zip(texts, part.column(2).to_pylist(), strict=True):
            pairs = np.array([(r["start"], r["width"]) for r in ranges or ()], np.int64).reshape(-1, 2)
            spans = spans_of(pairs[:, 0], pairs[:, 1], 0) if len(pairs) else pairs
            edges = [0, *spans.ravel().tolist(), len(document)]
            kept.append(b"".join(document[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            every.append([{"start": a, "stop": b} for a, b in spans.tolist()])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.record_batch([part.column(0), pa.array(every, kind), pa.array(kept, pa.binary())], names=["row", "spans", "kept"])


@finished
def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int | None = None) -> DataFrame:
    """``(row, spans, kept)`` for each distinct row of ``docs`` that repeated passages may touch: the merged
    byte ranges to remove and the bytes that stay. ``row`` is ``row_key(key, text)``.

    Texts are UTF-8 bytes, null counts as empty; a byte goes if a string of 400 bytes covers it that also
    starts elsewhere, in the same text or another, as the texts came in. Repeated rows repeat each other.
    An empty table gives no rows; texts under 400 bytes are never touched.

    With ``words``, bytes also go if a passage of so many words covers them whose words, as they are
    written, also start elsewhere; white space around it stays. This holds for texts of any length."""
    texts, found = repeated_places(docs, key, text)
    found = found.select("row", "start", (F.col("width") + (LENGTH - 1)).cast("int").alias("width"))
    if words:
        found = found.unionByName(repeated_words(texts, words))
    ranges = found.groupBy("row").agg(F.collect_set(F.struct("start", "width")).alias("ranges"))
    return texts.join(ranges, "row").select("row", "t", "ranges").dropDuplicates(["row"]).mapInArrow(take_out, SPANS)


@F.pandas_udf(StringType())
def whole_letters(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Bytes as text, without those of letters that a cut has split."""
    for part in parts:
        yield part.map(lambda b: None if b is None else b.decode("utf-8", "ignore"))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int | None = None) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; all rows and other columns stay as they are. Bytes
    of a letter that a cut has split are dropped, so the text stays UTF-8. Null texts stay null."""
    row, kept = unused(docs, "row"), unused(docs, "kept")
    spans = repeated_spans(docs, key, text, words).select(F.col("row").alias(row), whole_letters("kept").alias(kept))
    cut = docs.withColumn(row, row_key(key, text)).join(spans, row, "left")
    return cut.withColumn(text, F.coalesce(kept, text)).select(*docs.columns)


def digests(docs: DataFrame) -> DataFrame:
    """Bytes, removed bytes and runs, and a digest of the rest, for each row of ``documents``."""
    document = utf8("text")
    given = docs.select(
        row_key().alias("row"), "doc_id", F.octet_length(document).cast("bigint").alias("n_bytes"), F.sha2(document, 256).alias("whole")
    )
    spans = repeated_spans(docs.select("doc_id", "text")).select(
        "row", F.size("spans").cast("bigint").alias("runs"), F.sha2("kept", 256).alias("rest"),
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)").alias("gone"),
    )
    return given.join(spans, "row", "left").select(
        "doc_id", "n_bytes", F.coalesce("gone", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("runs", F.lit(0).cast("bigint")).alias("n_spans"), F.coalesce("rest", "whole").alias("kept_sha256"),
    )
