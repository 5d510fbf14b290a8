"""Resampling of a corpus towards a target distribution by importance.

N-grams of words are hashed to buckets; a bucket's gain says how much likelier its n-grams are in the
target than in the corpus. A document's weight is the mean gain of its n-grams, and weights perturbed by
Gumbel noise draw documents without replacement in proportion to their importance. Tasks go through
texts in batches: the n-grams of a batch are interned in an open-addressed NumPy table, so that what is
known of an n-gram (bucket, count, gain) is worked out once a batch and reaches its occurrences by slot.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sondage.llm.tables import BATCH_BYTES, finished, pieces, stored, utf8

#: Parameters of the draw.
LONGEST, BUCKETS, LEAST_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024
#: Bytes that make up words, A-Z in lower case, and blanks for all others.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
EMPTY = -1


class Interned:
    """N-grams of a batch in an open-addressed table with linear probing.

    ``slot`` names each occurrence's slot; ``owner`` is the place of the first occurrence that took a
    slot. Keys are 64-bit hashes; an occurrence stays in a slot only if its bytes equal the owner's, else
    it probes on, so n-grams of one hash are kept apart."""

    def __init__(self, grams: list[bytes], buckets: int):
        size = 1 << max(4, (2 * len(grams) - 1).bit_length())
        keys = np.fromiter(map(xxhash.xxh64_intdigest, grams), np.uint64, len(grams))
        text = np.empty(len(grams), object)
        text[:] = grams
        self.owner = np.full(size, EMPTY, np.int64)
        self.slot = (keys & np.uint64(size - 1)).astype(np.int64)
        waiting = np.arange(len(grams))
        while len(waiting):
            at = self.slot[waiting]
            free = self.owner[at] == EMPTY
            # Of those that come to a free slot, one takes it, and the others are compared with it.
            self.owner[at[free]] = waiting[free]
            owner = self.owner[at]
            same = keys[owner] == keys[waiting]
            same[same] = text[owner[same]] == text[waiting[same]]
            waiting = waiting[~same]
            self.slot[waiting] = (self.slot[waiting] + 1) & (size - 1)
        self.used = np.flatnonzero(self.owner != EMPTY)
        self.bucket = np.full(size, EMPTY, np.int32)
        self.bucket[self.used] = np.fromiter((zlib.crc32(grams[i]) % buckets for i in self.owner[self.used]), np.int32, len(self.used))
        self.count = np.bincount(self.slot, minlength=size)

    def per_bucket(self, buckets: int) -> np.ndarray:
        return np.bincount(self.bucket[self.used], self.count[self.used], buckets).astype(np.int64)


def stretches(text: bytes, limit: int = BATCH_BYTES) -> Iterator[bytes]:
    """A text in parts of about ``limit`` bytes, cut at blanks; a word is never cut, however long."""
    at = 0
    while at < len(text):
        stop = text.find(b" ", at + limit)
        stop = len(text) if stop < 0 else stop
        yield text[at:stop]
        at = stop


def batches_of(texts: list[bytes], longest: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """N-grams of up to ``longest`` words as ``(grams, document, words)``: the place of each one's text,
    and how many words each text has in this batch. Long texts are spread over several batches."""
    grams, owners, words, size = [], [], np.zeros(len(texts), np.int64), 0
    for place, text in enumerate(texts):
        before: list[bytes] = []
        for part in stretches(text.translate(FOLDED)):
            own = part.split()
            words[place] += len(own)
            # N-grams that begin in the part before and end in this one.
            run, new = before + own, 0
            for n in range(1, longest + 1):
                first = max(0, len(before) - n + 1)
                several = own if n == 1 else list(map(b" ".join, zip(*(run[first + i :] for i in range(n)), strict=False)))
                grams += several
                new += len(several)
            owners.append((place, new))
            before = run[len(run) - longest + 1 :] if longest > 1 else []
            size += len(part)
            if size >= BATCH_BYTES:
                yield grams, spread(owners), words
                grams, owners, words, size = [], [], np.zeros(len(texts), np.int64), 0
    yield grams, spread(owners), words


def spread(owners: list[tuple[int, int]]) -> np.ndarray:
    if not owners:
        return np.zeros(0, np.int64)
    places, sizes = np.array(owners).T
    return np.repeat(places, sizes)


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: n-grams of all texts in each bucket that has any; a task sends one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, texts in pieces(batches, "t"):
            for grams, _, _ in batches_of(texts, longest):
                total += Interned(grams, buckets).per_bucket(buckets)
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    own = docs.select(utf8(text).alias("t")).mapInArrow(run, "bucket bigint, n bigint")
    return own.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain, a thousand times the logarithm of the ratio of smoothed shares, rounded down.
    The driver gets one number a bucket, whatever the size of the texts."""
    s, t = ({row.bucket: float(row.n) for row in side.collect()} for side in (corpus, target))
    of_s, of_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    ratios = ((t.get(b, 0.0) + 1) * of_s / ((s.get(b, 0.0) + 1) * of_t) for b in range(buckets))
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", longest: int = LONGEST) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` of each row; ``weight`` is the mean gain of its n-grams
    rounded down, 0 without any."""
    shared, buckets = docs.sparkSession.sparkContext.broadcast(gain), len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches, "t"):
            words, features, sums = (np.zeros(len(texts), np.int64) for _ in range(3))
            for grams, place, own in batches_of(texts, longest):
                table = Interned(grams, buckets)
                by_slot = np.zeros(len(table.owner), np.int64)
                by_slot[table.used] = shared.value[table.bucket[table.used]]
                words += own
                features += np.bincount(place, minlength=len(texts))
                np.add.at(sums, place, by_slot[table.slot])
            mean = sums // np.maximum(features, 1)
            yield pa.record_batch([part.column(0), pa.array(words), pa.array(features), pa.array(mean)], names=["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), utf8(text).alias("t")).mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def ranked(scored: DataFrame, drawn: int) -> DataFrame:
    """Add ``rank``: 1, 2, ... to the ``drawn`` rows of greatest ``score`` among those that are
    ``eligible``, ties to the smaller doc_id; null to all others.

    Scores are whole numbers within some tens of thousands, so rows before each score are running sums over a table
    of that many rows, and only rows from the least drawn score on are put in order, score by score."""
    eligible = scored.where("eligible")
    per_score = eligible.groupBy("score").agg(F.count("*").alias("own"))
    up_to = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    before = per_score.select("score", F.coalesce(F.sum("own").over(up_to), F.lit(0)).alias("before")).where(F.col("before") < drawn)
    within = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last())
    top = eligible.join(F.broadcast(before), "score").withColumn("rank", F.col("before") + F.row_number().over(within)).drop("before")
    top = top.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = eligible.join(F.broadcast(before), "score", "left_anti").unionByName(scored.where("NOT eligible"))
    return top.unionByName(rest.withColumn("rank", F.lit(None).cast("bigint")))


@finished
def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    longest: int = LONGEST, buckets: int = BUCKETS, least: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of each row of ``docs``: drawn rows are those with a rank.

    Null and empty texts have no words, weight 0 and a score, but are not drawn, nor are texts of fewer
    than ``least`` words. A null key is last among ties and its noise is that of an empty id. Rows that
    repeat a key share their noise; rows that are alike get ranks next to each other. Texts are read whole,
    whatever their length. An empty target leaves gains to the corpus alone; an empty table gives no
    rows. Other columns of either table are not looked at."""
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets), buckets)
    weighed = weights(docs, gain, key, text, longest)
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10)
    gumbel = F.floor(-1000 * F.log(-F.log((noise.cast("double") + 0.5) / 4294967296)))
    scored = weighed.select("doc_id", "n_features", "weight", (F.col("weight") + gumbel).alias("score"), (F.col("n_words") >= least).alias("eligible"))
    scored = stored(scored, "scored")
    drawn = scored.where("eligible").count() * percent // 100
    return ranked(scored, drawn).select("doc_id", "n_features", "weight", "score", "rank")
