"""Helpers shared by the operators: stored intermediate tables, words, dealing large groups out."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from contextvars import ContextVar
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sondage.session import scratch_path
from sondage.sources.sinks import remove

#: Texts are handed to numpy in pieces of about so many bytes, whatever the number of rows.
BATCH_BYTES = 4 << 20
#: Large groups are dealt over so many keys before they are cut into tiles.
SALTS = 32


def prepare(spark: SparkSession) -> None:
    """Send this package to the workers, once a session, so that they need no copy of their own, and have
    Arrow batches follow the size of the rows, since texts may be long."""
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if getattr(context, "sondage_shipped", None) is None:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='sondage-')}/sondage", "zip", package.parent, package.name)
        context.addPyFile(archive)
        context.sondage_shipped = archive


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    paths = _paths.get()
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, label: str, key: str, parts: int) -> DataFrame:
    """``stored``, with rows of an equal ``key`` in one of so many buckets, those of ``repartition(parts, key)``:
    joins by the key read them where they are. The catalog knows the table only until it has been looked up."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    name = f"spark_catalog.default.{path.rsplit('/', 1)[-1].replace('-', '_')}"
    df.write.format("parquet").bucketBy(parts, key).option("path", path).saveAsTable(name)
    paths = _paths.get()
    if paths is not None:
        paths.append(path)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


#: Paths stored by the innermost operator that is running; each thread has its own.
_paths: ContextVar[list[str] | None] = ContextVar("paths", default=None)


def finished(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator whose result is stored, and whose intermediate tables are deleted once it is, or once it
    has failed."""

    @wraps(operator)
    def run(table: DataFrame, *args, **options) -> DataFrame:
        inner: list[str] = []
        try:
            outer = _paths.set(inner)
            try:
                result = operator(table, *args, **options)
            finally:
                _paths.reset(outer)
            return stored(result, operator.__name__)
        finally:
            for old in inner:
                remove(table.sparkSession, old)

    return run


def utf8(text: str = "text") -> Column:
    """A text's bytes; null counts as empty."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df`` is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used. (The optimizer would put the
    whole expression in the place of each use, inside lambdas too.)"""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def row_key(key: str = "doc_id", text: str = "text") -> Column:
    """Tells rows apart by key and text. Repeated rows share it, and share every result too."""
    return F.xxhash64(F.col(key), F.col(text))


def fold(document: bytes) -> list[bytes]:
    """Words of a text: A-Z in lower case, parted by the ASCII white space."""
    return document.lower().split()


def give_back() -> None:
    """Return what a task has freed to the system: workers wait for further tasks beside each other, and
    the allocators would keep it. Where the C library cannot do that, its part stays."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        return


def tidy(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A task's function that gives its memory back when its own tables are gone, which it holds to its end."""

    @wraps(run)
    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return whole


def pieces(batches: Iterable[pa.RecordBatch], text: str, limit: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut record batches so that the texts of each piece stay near ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.cumsum(pa.compute.binary_length(column).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
            part = batch.slice(start, stop - start)
            yield part, part.column(part.schema.get_field_index(text)).to_pylist()
            start = stop
    give_back()


class Memo(dict):
    """A table of computed values that forgets everything once it is full, so memory stays bounded."""

    def __init__(self, compute: Callable, limit: int = 300_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, one to one."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def tiles(rows: DataFrame, group: list[str], member: str, size: int, weight: Column | None = None) -> DataFrame:
    """Deal each group out to square tiles so that any two members meet in exactly one tile and no tile
    has more than about twice ``size`` rows. Adds ``tile_i``, ``tile_j`` and ``side``: 0 for rows of the
    part tile_i, 1 for those of tile_j; on the diagonal all are 0. A group of up to ``size`` rows is one
    tile; a larger one of k parts has its rows in k tiles each. With a ``weight`` a row counts as so many."""
    # Only groups of several parts are looked up, each under SALTS keys, so that no group meets in one task.
    parts = rows.groupBy(*group).agg(F.ceil((F.count("*") if weight is None else F.sum(weight)) / size).cast("int").alias("tile_parts")).where("tile_parts > 1")
    parts = parts.withColumn("tile_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("tile_salt", F.pmod(F.xxhash64(F.col(member), F.lit("salt")), F.lit(SALTS)).cast("int"))
    dealt = salted.join(parts, [*group, "tile_salt"], "left").drop("tile_salt").withColumn("tile_parts", F.coalesce("tile_parts", F.lit(1)))
    part = F.pmod(F.xxhash64(F.col(member), F.lit("part")), F.col("tile_parts")).cast("int")
    dealt = dealt.withColumn("tile_part", part)
    dealt = dealt.withColumn("tile_other", F.explode(F.sequence(F.lit(0), F.col("tile_parts") - 1)))
    return (
        dealt.withColumn("tile_i", F.least("tile_part", "tile_other"))
        .withColumn("tile_j", F.greatest("tile_part", "tile_other"))
        .withColumn("side", (F.col("tile_part") != F.col("tile_i")).cast("int"))
        .drop("tile_parts", "tile_part", "tile_other")
    )
