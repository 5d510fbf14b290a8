"""Row positions and what is selected by them: systematic samples and the first lines of a file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sondage.session import durable

# Fixed value: tables above this many rows are sampled.
SAMPLE_ROW_THRESHOLD = 100_000

# Offsets of more files than this are joined without a broadcast.
MAX_BROADCAST_ROWS = 200_000


def with_file_position(df: DataFrame, position: str) -> DataFrame:
    """Number the rows of a Parquet table from 0 in stored order (file name, then place in the
    file). Only the row counts of the files are gathered; no row is moved."""
    marked = df.withColumn("_file", F.col("_metadata.file_path")).withColumn("_place", F.col("_metadata.row_index"))
    return _add_offsets(marked, marked.groupBy("_file"), ["_file"], F.col("_place"), position)


def with_line_position(lines: DataFrame, position: str) -> DataFrame:
    """Number the lines of text files from 0 by file name and place in the file.

    Lines of one input split are read in order by one task, so the running id gives their place in
    the split; the splits' line counts give where each split starts.
    """
    marked = lines.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    return _add_offsets(marked, marked.groupBy("_file", "_start"), ["_file", "_start"], F.col("_id"), position)


def _add_offsets(marked: DataFrame, grouped, keys: list[str], place, position: str) -> DataFrame:
    # One row per file or split, which the scan has listed already.
    sizes = grouped.agg(F.count("*").alias("_rows"), F.min(place).alias("_first"))
    before = F.sum("_rows").over(Window.orderBy(*keys)) - F.col("_rows")
    offsets = durable(sizes.select(*keys, "_rows", "_first", (before - F.col("_first")).alias("_offset")))
    if offsets.count() <= MAX_BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    joined = marked.join(offsets, keys, "left")
    # Positions hold only if both scans were split alike and nothing was written between them.
    known = (place >= F.col("_first")) & (place < F.col("_first") + F.col("_rows"))
    placed = F.when(known, place + F.col("_offset")).otherwise(F.raise_error(F.lit("the files were split otherwise or changed while rows were numbered")))
    return joined.withColumn(position, placed).drop("_file", "_start", "_id", "_place", "_rows", "_first", "_offset")


def stride_for(rows: int, threshold: int = SAMPLE_ROW_THRESHOLD) -> int | None:
    """Every how many rows one is kept; None when the table is small enough to keep whole."""
    return max(rows // threshold, 1) if rows > threshold else None


def systematic_sample(df: DataFrame, rows: int, threshold: int = SAMPLE_ROW_THRESHOLD) -> DataFrame:
    """Evenly spaced rows of a Parquet table, in stored order, with their ``position``."""
    stride = stride_for(rows, threshold)
    numbered = with_file_position(df, "position")
    return numbered if stride is None else numbered.filter(F.col("position") % stride == 0)


def head_lines(lines: DataFrame, count: int, **options: str) -> DataFrame:
    """The first ``count`` raw lines, blank and unreadable ones included, with their ``line_no``. Files are taken
    in name order, twice as many each time, until they hold enough lines; each is counted once, the others are
    never read. ``options`` are those that ``lines`` was read with, such as ``lineSep``, which it does not tell."""
    names, reader = sorted(lines.inputFiles()), lines.sparkSession.read.options(**options)
    held, taken, step = 0, 0, 1
    while taken < len(names) and held < count:
        held += reader.text(names[taken : taken + step]).count()
        taken, step = taken + step, step * 2
    head = reader.text(names[: max(taken, 1)]) if names else lines
    return with_line_position(head, "line_no").filter(F.col("line_no") < count)
