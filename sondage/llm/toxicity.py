"""Toxicity scores from a small convolutional network over hashed words, trained in numpy.

A word's embedding is the sum of those of its hash and of the hashes of its opening letters, so that
unseen endings of known stems are recognised. Filters of several widths slide over the whole text, the greatest
answer of each is kept, and a logistic layer weighs them. Since each filter answers at one place only,
the gradient touches a few words per text.

All labelled texts of the training folds are learned from, whole, in shards of some SHARD rows: in each pass
every task goes once over its shard from the common parameters, and the parameters of all shards are averaged,
a part of them in each task. The driver holds one set of parameters, and counts of binned answers.

Scores are calibrated by language. The language is guessed from common short words of the text itself;
on the training texts of each language a threshold on the raw probability is chosen, and scores are moved
so that it lies at CUT for all of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondage.llm.tables import Memo
from sondage.llm.texts import fold_of
from sondage.session import durable

#: Rows of a shard, and floats of the parameters that are averaged in one group.
SHARD, PART = 10_000, 1 << 16
#: Passes over all labelled texts: the more texts, the fewer, from the first number down to the second.
PASSES, TEXTS_PASSED = (12, 2), 66_000
#: Places of the filter of labelled ids: for each id, and at most (8 MB). Spark's bitmaps hold BITMAP of them.
SPARSE, FILTER, BITMAP = 16, 1 << 26, 1 << 15
FOLDS, HELD_OUT = 3, 1
BUCKETS, STEMS, DIMS, WIDTHS, FILTERS = 1 << 14, (4, 5), 12, (1, 2, 3), 8
PARTS = 1 + len(STEMS)
BATCH, RATE = 64, 0.01
CUT = 0.7

# Common short words by which a text's language is guessed.
COMMON = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "with", "for", "was"),
    "de": ("der", "die", "das", "und", "in", "den", "von", "zu", "mit", "ist"),
    "fr": ("le", "la", "les", "de", "des", "et", "une", "que", "dans", "est"),
    "es": ("el", "la", "los", "de", "las", "y", "una", "que", "del", "con"),
}
LANGUAGES = (*COMMON, "other")
MARKS = " .,;:!?\"'()[]*#$%&|-"


def word_code(word: str) -> int:
    """In one number: buckets of the word and its stems, 16 bits each, and above them a bit for each
    language it is common in."""
    plain = word.strip(MARKS).lower()
    hints = sum(1 << i for i, words in enumerate(COMMON.values()) if plain in words)
    parts = (plain, *(plain[:n] if len(plain) > n else f"{plain}${n}" for n in STEMS))
    return sum(zlib.crc32(p.encode()) % BUCKETS << 16 * i for i, p in enumerate(parts)) | hints << 16 * len(parts)


def numbers_of(text: str, memo: Memo) -> np.ndarray:
    words = text.split()
    return np.fromiter(map(memo.__getitem__, words), np.int64, len(words))


def codes_of(codes: np.ndarray) -> np.ndarray:
    """A row for each word's number: a place in the embedding for itself and each stem, then its languages."""
    places = [(codes >> 16 * i & 0xFFFF) + BUCKETS * i for i in range(PARTS)]
    return np.stack([*places, codes >> 16 * PARTS], axis=1).astype(np.int32)


def language_of(codes: np.ndarray) -> int:
    """The language with the most common words; the last of LANGUAGES if there are none."""
    hits = [np.count_nonzero(codes[:, -1] >> i & 1) for i in range(len(COMMON))]
    return int(np.argmax(hits)) if any(hits) else len(COMMON)


@dataclass
class Network:
    embedding: np.ndarray
    kernels: list[np.ndarray]  # of each width: (width, DIMS, FILTERS)
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    moves: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES)))

    def answers(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The greatest answer of each filter over the whole text, and where it starts."""
        rows = sum(self.embedding[codes[:, i]] for i in range(PARTS))
        padded = np.concatenate([rows, np.zeros((max(WIDTHS) - 1, DIMS), rows.dtype)])
        out, places = [], []
        for kernel in self.kernels:
            width = len(kernel)
            answer = sum(padded[i : i + len(rows)] @ kernel[i] for i in range(width))
            at = answer.argmax(axis=0)
            out.append(answer[at, np.arange(FILTERS)])
            places.append(at)
        return np.maximum(np.concatenate(out) + self.bias, 0), np.concatenate(places)

    def logit(self, codes: np.ndarray) -> float:
        pooled = self.answers(codes)[0] if len(codes) else np.maximum(self.bias, 0)
        return float(pooled @ self.weights + self.offset)

    def score(self, codes: np.ndarray) -> float:
        moved = self.logit(codes) + self.moves[language_of(codes)]
        return 1 / (1 + np.exp(-np.clip(moved, -30, 30)))


@dataclass
class Learner:
    """A network and, for Adagrad, the sums of its squared gradients."""

    net: Network
    seen: Network

    @staticmethod
    def start() -> Learner:
        generator = np.random.default_rng(4)
        count = FILTERS * len(WIDTHS)
        net = Network(
            generator.normal(0, 0.01, (PARTS * BUCKETS, DIMS)).astype(np.float32),
            [generator.normal(0, 0.4, (w, DIMS, FILTERS)).astype(np.float32) for w in WIDTHS],
            np.zeros(count, np.float32), generator.normal(0, 0.3, count).astype(np.float32), 0.0,
        )
        full = [np.full_like(k, 1e-3) for k in net.kernels]
        return Learner(net, Network(np.full_like(net.embedding, 1e-3), full, np.full_like(net.bias, 1e-3), np.full_like(net.bias, 1e-3), 1e-3))

    def flat(self) -> np.ndarray:
        parts = [p for n in (self.net, self.seen) for p in (n.embedding, *n.kernels, n.bias, n.weights, [n.offset])]
        return np.concatenate([np.ravel(p) for p in parts]).astype(np.float32)

    @staticmethod
    def of(flat: np.ndarray) -> Learner:
        count, at, nets = FILTERS * len(WIDTHS), 0, []
        shapes = [(PARTS * BUCKETS, DIMS), *((w, DIMS, FILTERS) for w in WIDTHS), (count,), (count,), (1,)]
        for _ in range(2):
            parts = []
            for shape in shapes:
                size = int(np.prod(shape))
                parts.append(flat[at : at + size].reshape(shape).copy())
                at += size
            nets.append(Network(parts[0], parts[1:-3], parts[-3], parts[-2], float(parts[-1][0])))
        return Learner(*nets)

    def step(self, texts: list[np.ndarray], labels: list[int], share: float) -> None:
        """One step of Adagrad on a batch, with both classes in balance; ``share`` is that of label 1 in all texts."""
        net, count = self.net, FILTERS * len(WIDTHS)
        g_bias, g_weights, g_offset = np.zeros(count), np.zeros(count), 0.0
        g_kernels = [np.zeros_like(k) for k in net.kernels]
        words, slopes = [], []
        for codes, label in zip(texts, labels, strict=True):
            pooled, places = net.answers(codes)
            chance = 1 / (1 + np.exp(-np.clip(pooled @ net.weights + net.offset, -30, 30)))
            slope = (0.5 / share if label else 0.5 / (1 - share)) * (chance - label) / len(texts)
            g_weights += slope * pooled
            g_offset += slope
            inner = slope * net.weights * (pooled > 0)
            g_bias += inner
            for k, kernel in enumerate(net.kernels):
                own, at = inner[k * FILTERS : (k + 1) * FILTERS], places[k * FILTERS : (k + 1) * FILTERS]
                for i in range(len(kernel)):
                    there = at + i < len(codes)
                    which = codes[np.minimum(at + i, len(codes) - 1), :PARTS]
                    rows = net.embedding[which].sum(axis=1) * there[:, None]
                    g_kernels[k][i] += (rows * own[:, None]).T
                    back = (kernel[i] * own).T * there[:, None]
                    words += list(which.T)
                    slopes += [back] * PARTS
        at, inverse = np.unique(np.concatenate(words), return_inverse=True)
        g_embedding = np.zeros((len(at), DIMS), np.float32)
        np.add.at(g_embedding, inverse, np.concatenate(slopes).astype(np.float32))
        step_size, seen = RATE * 5, self.seen
        seen.embedding[at] += g_embedding**2
        net.embedding[at] -= step_size * g_embedding / np.sqrt(seen.embedding[at])
        for kernel, past, g in zip(net.kernels, seen.kernels, g_kernels, strict=True):
            past += g**2
            kernel -= step_size * g / np.sqrt(past)
        for name, g in (("bias", g_bias), ("weights", g_weights), ("offset", g_offset)):
            setattr(seen, name, getattr(seen, name) + g**2)
            setattr(net, name, getattr(net, name) - step_size * g / np.sqrt(getattr(seen, name)))


def passed(spark, held: DataFrame, flat: np.ndarray, share: float) -> np.ndarray:
    """The parameters after one pass over all texts: the mean of those of the shards, by their rows."""
    shared = spark.sparkContext.broadcast(flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, rows, texts, labels = Learner.of(shared.value), 0, [], []
        for batch in batches:
            for codes, label in zip(batch.column(0), batch.column(1), strict=True):
                texts.append(codes_of(np.frombuffer(codes.as_py(), np.int64)))
                labels.append(label.as_py())
                rows += 1
                if len(texts) == BATCH:
                    learner.step(texts, labels, share)
                    texts, labels = [], []
        if texts:
            learner.step(texts, labels, share)
        if rows:
            own = learner.flat()
            cut = [own[at : at + PART].tobytes() for at in range(0, len(own), PART)]
            yield pa.record_batch([pa.array(range(len(cut)), pa.int32()), pa.array([rows] * len(cut), pa.int64()), pa.array(cut, pa.binary())], names=["part", "rows", "own"])

    def mean(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(own, np.float32) * np.float64(rows) for rows, own in zip(frame.rows, frame.own, strict=True))
        return pd.DataFrame({"part": frame.part.iloc[:1], "own": [(total / frame.rows.sum()).astype(np.float32).tobytes()]})

    parts = held.select("codes", "toxic").mapInArrow(run, "part int, rows bigint, own binary").groupBy("part").applyInPandas(mean, "part int, own binary")
    after = np.concatenate([np.frombuffer(r["own"], np.float32) for r in sorted(parts.collect(), key=lambda r: r["part"])])
    shared.unpersist()
    return after


def calibrated(spark, held: DataFrame, net: Network) -> np.ndarray:
    """What to add to the logits of each language so that its best threshold lies at CUT. Languages in
    which one class is missing take the threshold over all. Logits are counted in bins of a thousandth."""
    shared = spark.sparkContext.broadcast(net)

    @F.pandas_udf("struct<language: int, bin: int>")
    def answered(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            texts = [codes_of(np.frombuffer(x, np.int64)) for x in part]
            bins = [int(np.rint(1000 * np.clip(shared.value.logit(t), -1000, 1000))) for t in texts]
            yield pd.DataFrame({"language": [language_of(t) for t in texts], "bin": bins})

    counts = held.select(answered("codes").alias("at"), "toxic").groupBy("at.language", "at.bin").agg(F.sum("toxic").alias("ones"), F.count("*").alias("all"))
    found = counts.toPandas().sort_values(["language", "bin"])
    common = threshold(found.groupby("bin", as_index=False)[["ones", "all"]].sum())
    out = []
    for i in range(len(LANGUAGES)):
        own = found[found.language == i]
        both = 0 < own.ones.sum() < own["all"].sum()
        out.append(np.log(CUT / (1 - CUT)) - (threshold(own) if both else common))
    return np.array(out)


def threshold(counts: pd.DataFrame) -> float:
    """Between the classes where the balanced error is least, amid the widest gap there."""
    z, y, n = counts.bin.to_numpy() / 1000, counts.ones.to_numpy(float), counts["all"].to_numpy(float)
    if len(z) < 2 or not 0 < y.sum() < n.sum():
        return float(z[0]) if len(z) and 0 < y.sum() < n.sum() else 0.0
    missed, wrong = np.cumsum(y) / y.sum(), 1 - np.cumsum(n - y) / (n - y).sum()
    error = (missed + wrong)[:-1]
    best = np.flatnonzero(error <= error.min() + 1e-12)
    gaps = z[best + 1] - z[best]
    at = best[np.argmax(gaps)]
    return float((z[at] + z[at + 1]) / 2)


def place_of(key: str, places: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(places))


def marked(known: DataFrame, rows: int) -> np.ndarray:
    """A bit for each place of a filter, set where an id of ``known`` falls: SPARSE places for each of its rows, at
    most FILTER of them. Beyond that more ids pass, and the join drops them."""
    places = min(FILTER, max(BITMAP, 1 << (SPARSE * rows - 1).bit_length()))
    # Spark counts the places of its bitmaps from 1 on, and the bitmaps too.
    at = place_of("doc_id", places) + 1
    found = known.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros(places // 8, np.uint8)
    for row in found.collect():
        out[(row.part - 1) * BITMAP // 8 :][: BITMAP // 8] = np.frombuffer(row.bits, np.uint8)
    return out


def coded(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """``(doc_id, codes)`` of the texts whose ids pass the filter and that hold a word. Codes are made where
    the texts are read, so texts themselves are not moved, nor anything of those without a label."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(word_code, 200_000)
        for batch in batches:
            at = batch.column(0).to_numpy()
            held = batch.filter(pa.array((shared.value[at >> 3] >> (at & 7) & 1).astype(bool)))
            codes = [numbers_of(x or "", memo).tobytes() or None for x in held.column(2).to_pylist()]
            yield pa.record_batch([held.column(1), pa.array(codes, pa.binary())], names=["doc_id", "codes"])

    given = docs.where("doc_id IS NOT NULL").where(fold_of("doc_id", FOLDS) != HELD_OUT)
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, codes binary"
    return given.select(place_of("doc_id", 8 * len(bits)).alias("place"), "doc_id", "text").mapInArrow(run, kinds).where("codes IS NOT NULL")


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, toxic, codes)`` of all labelled texts of the training folds that hold a word. Each partition is
    a shard, dealt by id as the join needs it, so that codes are moved once."""
    known = labels.where(F.col("toxic").isin(0, 1) & (fold_of("doc_id", FOLDS) != HELD_OUT)).select("doc_id", "toxic")
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = known.count()
    shards = max(1, -(-rows // SHARD))
    # Merged, so that neither side is broadcast and the shards stay what they are.
    dealt = coded(docs, marked(known, rows)).repartition(shards, "doc_id").join(known.repartition(shards, "doc_id").hint("merge"), "doc_id")
    # Where a session deals keys to more partitions, some are put together.
    return dealt.select("doc_id", "toxic", "codes").sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "codes").coalesce(shards)


def train(docs: DataFrame, labels: DataFrame) -> Network | None:
    """Fit on all labelled texts of the training folds that hold a word, however long; None if one of the classes
    is missing. Texts are coded once and kept as shards, dealt by the hash of their id, so results repeat."""
    spark = docs.sparkSession
    held = durable(labelled(docs, labels))
    texts, ones = held.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < ones < texts:
        return None
    flat = Learner.start().flat()
    for _ in range(int(np.clip(np.ceil(TEXTS_PASSED / texts), PASSES[1], PASSES[0]))):
        flat = passed(spark, held, flat, float(np.clip(ones / texts, 0.02, 0.98)))
    net = Learner.of(flat).net
    net.moves = calibrated(spark, held, net)
    return net


def score(docs: DataFrame, network: Network | None, text: str = "text", out: str = "score") -> DataFrame:
    """Add ``out``, from 0 to 1; higher is likelier toxic, CUT is the threshold in every language. Null
    texts count as empty; without a network every score is 0. A column of that name is replaced."""
    if network is None:
        return docs.withColumn(out, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo, net = Memo(word_code, 200_000), shared.value
        for part in parts:
            yield pd.Series([net.score(codes_of(numbers_of(x or "", memo))) for x in part], dtype=float)

    return docs.withColumn(out, scored(F.col(text)))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``docs``; every text is read whole, and no
    column but the text enters a score. Null texts count as empty. Repeated rows get equal scores; a row
    without an id is not held out, and no label is its own. An empty table gives no rows."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id", F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )
