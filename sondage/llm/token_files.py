"""Token counts of documents in flat token files that have no index.

A token file is one long row of unsigned 16-bit or 32-bit ids in which documents are told apart by an
end-of-document id alone. It is read in blocks of equal size that know nothing of each other. Each block
is searched for the separator by a vectorised scan; a prefix scan over the blocks' summaries then adds
what a document has in earlier blocks to where it ends.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sondage.llm.bpe import codec, definition
from sondage.llm.tables import finished, pieces, stored, utf8

#: Ids in a block, and blocks (or groups of them) that one step of the prefix scan reads together.
BLOCK_IDS, FAN = 1 << 16, 1 << 10
LEVELS = 3

def width_of(vocabulary: str, end: int | None = None) -> int:
    """Bytes of an id: 2 if all ids of a vocabulary file's contents, and the end, are below 65,536, else 4."""
    held = json.loads(vocabulary)
    ids = [*held["model"]["vocab"].values(), *(token["id"] for token in held.get("added_tokens") or []), end or 0]
    return 2 if max(ids) < 1 << 16 else 4


FLAT = "file bigint, block bigint, ids binary, names array<bigint>"


def write_flat(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end: int | None = None, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Lay the token ids of all texts end to end, each closed by the end id, one file per task, cut into
    blocks ``(file, block, ids)``. ``names`` lists the keys of the documents that end in a block, in
    order; it holds no positions. Special tokens in a text are written as ordinary text, so that the end
    id stands at ends only. Null and empty texts have no ids but the end; texts are read whole. Ids have 16
    bits if the vocabulary allows that (``width_of``), else 32."""
    vocabulary = definition(path)
    width = width_of(vocabulary, end)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, file = codec(shared.value), TaskContext.get().partitionId()
        closing = np.array([max(own.bytes_of) if end is None else end], f"<u{width}").tobytes()
        size, block, held, pending = width * block_ids, 0, bytearray(), []

        def cut(block: int) -> pa.RecordBatch:
            names = [name for name, stop in pending if stop <= size]
            arrays = [pa.array([file]), pa.array([block]), pa.array([bytes(held[:size])]), pa.array([names], pa.list_(pa.int64()))]
            return pa.record_batch(arrays, names=["file", "block", "ids", "names"])

        for part, texts in pieces(batches, "t"):
            for name, document in zip(part.column(0).to_pylist(), texts, strict=True):
                held += np.frombuffer(own.encode(document.decode(), False), "<u4").astype(f"<u{width}").tobytes() + closing
                pending.append((name, len(held)))
                while len(held) >= size:
                    yield cut(block)
                    del held[:size]
                    pending, block = [(n, stop - size) for n, stop in pending if stop > size], block + 1
        if held:
            yield cut(block)
        own.forget()

    return docs.select(F.col(key).cast("bigint"), utf8(text).alias("t")).mapInArrow(run, FLAT)


def read_flat(spark: SparkSession, path: str, block_bytes: int = 2 * BLOCK_IDS) -> DataFrame:
    """Raw token files as blocks ``(file, block, ids)``; a file is read by one task, of 2 GB at most."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                view = memoryview(content.as_buffer())
                for block, start in enumerate(range(0, len(view), block_bytes)):
                    yield pa.record_batch([pa.array([name]), pa.array([block]), pa.array([bytes(view[start : start + block_bytes])])], names=["file", "block", "ids"])

    return files.mapInArrow(run, "file string, block bigint, ids binary")


def scan(blocks: DataFrame, end: int, width: int = 2) -> DataFrame:
    """Add to each block: ``inner``, the ids of each document that ends in it, those of the first as far as
    they stand in this block; ``tail``, the ids behind the last end."""
    dtype = f"<u{width}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inner, tails = [], []
            for ids in batch.column(batch.schema.get_field_index("ids")).to_pylist():
                values = np.frombuffer(ids, dtype)
                ends = np.flatnonzero(values == end)
                inner.append(np.diff(ends, prepend=-1) - 1)
                tails.append(len(values) - (ends[-1] + 1 if len(ends) else 0))
            rest = batch.drop_columns(["ids"])
            yield rest.append_column("inner", pa.array(inner, pa.list_(pa.int64()))).append_column("tail", pa.array(tails, pa.int64()))

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema if f.name != "ids"]
    return blocks.mapInArrow(run, ", ".join([*kinds, "inner array<bigint>", "tail bigint"]))


def carried(summaries: DataFrame) -> DataFrame:
    """``(file, block, carry)``: how many ids of an unfinished document stand before each block.

    Summaries (the tail, and whether a document ends) are combined over groups of FAN blocks, then over
    groups of such groups, so no window holds more than FAN rows, however long a file is."""
    level, levels = summaries.select("file", F.col("block").alias("n"), "tail", "ended"), []
    for _ in range(LEVELS):
        own = level.withColumn("up", F.floor(F.col("n") / FAN))
        before = Window.partitionBy("file", "up").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
        own = own.withColumn("sum", F.coalesce(F.sum("tail").over(before), F.lit(0)))
        ended = F.when(F.col("ended"), F.struct("n", "sum"))
        own = own.withColumn("last", F.max(ended).over(before))
        levels.append(own.select("file", "n", "up", F.col("last").isNull().alias("through"), (F.col("sum") - F.coalesce("last.sum", F.lit(0))).alias("inside")))
        grouped = own.groupBy("file", F.col("up").alias("n")).agg(F.sum("tail").alias("total"), F.max(ended).alias("last"))
        level = grouped.select("file", "n", (F.col("total") - F.coalesce("last.sum", F.lit(0))).alias("tail"), F.col("last").isNotNull().alias("ended"))
    carry = levels[-1].select("file", "n", F.col("inside").alias("carry"))
    for own in reversed(levels[:-1]):
        above = carry.select("file", F.col("n").alias("up"), F.col("carry").alias("above"))
        from_above = F.when(F.col("through"), F.col("above")).otherwise(F.lit(0))
        carry = own.join(above, ["file", "up"]).select("file", "n", (F.col("inside") + from_above).alias("carry"))
    return carry.select("file", F.col("n").alias("block"), "carry")


def token_counts(blocks: DataFrame, end: int, width: int = 2) -> DataFrame:
    """``(file, block, position, n_tokens)`` of each document, in the block where it ends, without the end
    id, plus ``names`` of the block if the files have them. Ids behind the last end of a file belong to
    no document. Blocks of a file are numbered from 0; empty files and tables give no rows."""
    found = stored(scan(blocks, end, width), "scanned")
    summaries = found.select("file", "block", "tail", (F.size("inner") > 0).alias("ended"))
    whole = found.where(F.size("inner") > 0).join(carried(summaries), ["file", "block"])
    extra = [c for c in ("names",) if c in found.columns]
    each = whole.select("file", "block", "carry", *extra, F.posexplode("inner").alias("position", "ids"))
    first = F.when(F.col("position") == 0, F.col("carry")).otherwise(F.lit(0))
    return each.select("file", "block", "position", *extra, (F.col("ids") + first).alias("n_tokens"))


@finished
def document_counts(docs: DataFrame, path: str, end: int) -> DataFrame:
    """Write all documents to flat token files and count each one's tokens from these alone: ``(doc_id,
    n_tokens)`` for each row, null and empty texts with 0, null and repeated ids as often as they stand
    there. Texts of any length are laid out whole; an empty table gives no rows."""
    flat = stored(write_flat(docs, path, end=end), "flat")
    counts = token_counts(flat, end, width_of(definition(path), end))
    return counts.select(F.get("names", "position").alias("doc_id"), "n_tokens")
