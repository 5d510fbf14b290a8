"""CSV files with line breaks inside quotes, read in as many tasks as they have splits.

Whether a line break ends a record depends on the quotes before it: it does where their number is even.
Quotes are counted per split of the text reader; a running parity over the splits of a file then tells
each of them whether it begins inside a value. With that, every split finds its records by itself, and the pieces
of those that cross a border, at most two a split, are put together. Doubled quotes inside
a value count as two, so they change nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECES = "file string, start bigint, opens boolean, header boolean, text string"


def raw_lines(spark: SparkSession, path) -> DataFrame:
    """``(file, start, value)``: lines with the file and the split they stand in. Carriage returns stay."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def quotes_before(lines: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each file its splits in order, and whether the quotes before each are odd in number. The driver
    gets one row a split, as many as it has listed to plan the scan."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes")).collect()
    splits = defaultdict(list)
    for row in counted:
        splits[row.file].append((row.start, row.quotes))
    found = {}
    for file, own in splits.items():
        starts, quotes = np.array(sorted(own), np.int64).T
        found[file] = starts, (np.cumsum(quotes) - quotes) % 2
    return found


class Split:
    """The lines of one split, cut into records as they come."""

    def __init__(self, file: str, start: int, odd: bool, header: bool):
        self.file, self.start, self.odd = file, start, odd
        # Lines ahead of the first end belong to a record of an earlier split if the quotes before are odd.
        self.inherited, self.header, self.pending = odd, header and start == 0, []

    def take(self, values: pa.Array) -> tuple[pa.Array, list[tuple]]:
        """Records that begin and end here, and the piece that ends an inherited one."""
        parity = (int(self.odd) + np.cumsum(pc.count_substring(values, '"').to_numpy(zero_copy_only=False))) & 1
        ends = np.flatnonzero(parity == 0)
        if not len(ends):
            self.pending += values.to_pylist()
            self.odd = self.odd if not len(values) else bool(parity[-1])
            return values.slice(0, 0), []
        begins, several, pieces = np.append(0, ends[:-1] + 1), [], []
        skipped = 0
        if self.pending or self.inherited or self.header:
            text = "\n".join([*self.pending, *values.slice(0, ends[0] + 1).to_pylist()])
            if self.inherited:
                pieces.append((self.file, self.start, False, False, text))
            elif not self.header:
                several.append(text)
            self.inherited, self.header, skipped = False, False, 1
        alone = (begins == ends) & (np.arange(len(ends)) >= skipped)
        for begin, end in zip(begins[skipped:], ends[skipped:], strict=True):
            if begin < end:
                several.append("\n".join(values.slice(begin, end - begin + 1).to_pylist()))
        self.pending, self.odd = values.slice(ends[-1] + 1).to_pylist(), bool(parity[-1])
        return pa.concat_arrays([values.take(pa.array(ends[alone])), pa.array(several, values.type)]), pieces

    def rest(self) -> list[tuple]:
        """The piece that goes on in the next split: it opens a record unless that one was inherited."""
        return [(self.file, self.start, not self.inherited, self.header, "\n".join(self.pending))] if self.pending else []


def cut(batches: Iterator[pa.RecordBatch], odd: dict, header: bool) -> Iterator[tuple[pa.Array, list[tuple]]]:
    current = None
    for batch in batches:
        file, start, value = batch.columns
        codes, starts = file.dictionary_encode().indices.to_numpy(zero_copy_only=False), start.to_numpy()
        borders = np.flatnonzero((np.diff(codes, prepend=-1) != 0) | (np.diff(starts, prepend=-1) != 0))
        for begin, end in zip(borders, np.append(borders[1:], batch.num_rows), strict=True):
            place = file[int(begin)].as_py(), int(starts[begin])
            if current is None or (current.file, current.start) != place:
                if current is not None:
                    yield value.slice(0, 0), current.rest()
                known, odds = odd[place[0]]
                at = int(np.searchsorted(known, place[1]))
                if at == len(known) or known[at] != place[1]:
                    raise ValueError(f"{place[0]} was split in another way when its quotes were counted")
                current = Split(*place, bool(odds[at]), header)
            yield current.take(value.slice(begin, end - begin))
    if current is not None:
        yield pa.array([], pa.string()), current.rest()


def records(spark: SparkSession, path, header: bool = True) -> DataFrame:
    """``record``: the text of every record of the files, without the header records. Records may have any
    number of lines and cross any number of splits; blank ones are left out."""
    lines = raw_lines(spark, path)
    odd = spark.sparkContext.broadcast(quotes_before(lines))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, _ in cut(batches, odd.value, header):
            if len(found):
                yield pa.record_batch([found], names=["record"])

    def crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, pieces in cut(batches, odd.value, header):
            if pieces:
                yield pa.record_batch([pa.array(c) for c in zip(*pieces, strict=True)], names=["file", "start", "opens", "header", "text"])

    pieces = lines.mapInArrow(crossing, PIECES)
    # A split's closing piece stands before the one it opens.
    in_order = Window.partitionBy("file").orderBy("start", "opens").rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.withColumn("number", F.count_if("opens").over(in_order))
    parts = F.array_sort(F.collect_list(F.struct("start", "text")))
    joined = numbered.groupBy("file", "number").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("record"), F.bool_or("header").alias("header"))
    both = lines.mapInArrow(whole, "record string").unionByName(joined.where("NOT header").select("record"))
    return both.select(F.regexp_replace("record", "\r$", "").alias("record")).where(F.trim("record") != "")


def read_csv_split(spark: SparkSession, path, schema: T.StructType | str, header: bool = True, mode: str = "PERMISSIVE") -> DataFrame:
    """CSV files of any size with line breaks inside quotes, as columns of ``schema``.

    Values that hold quotes, separators or line breaks stand in quotes, quotes inside them are doubled; a
    quote elsewhere would be taken for an opening one. Empty values are NULL. Lines end in a line feed,
    with or without a carriage return before it. ``mode`` is Spark's. Compressed files that cannot be
    split are read by one task each, as always. The text is scanned three times: to count quotes, for whole
    records, and for the pieces of those that cross a border."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {"escape": '"', "multiLine": "true", "mode": mode}
    return records(spark, path, header).select(F.from_csv("record", kind.toDDL(), options).alias("row")).select("row.*")
