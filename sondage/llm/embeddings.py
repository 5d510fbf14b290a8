"""Near-duplicate vectors by a pigeonhole join over subspaces.

Vectors are scaled to length one, so that a cosine of at least C is a squared distance of at most
2 - 2C. They are turned by a fixed random rotation and split into blocks of a few coordinates. Of two
vectors that close, at least one block is within its share of the squared distance (the shares are in
proportion to the blocks' dimensions). So each block is range-joined on its own, on its coordinates alone:
a coarse grid over some of them deals the work out, with more coordinates the more vectors there are, and
inside a task a fine grid over all of them, walked coordinate by coordinate, brings together what can be
within reach. What is within reach goes on as one packet for each task's tile, which meets the given vectors
of its members alone; pairs are verified on these in double precision, and counted in the first block in
which they are within reach, and only there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from sondage.llm.components import components
from sondage.llm.minhash import by_group
from sondage.llm.tables import finished, mix, prepare, stored, tiles

COSINE = 0.98
BLOCK_DIMS = 8
#: Coordinates of the coarse grid; one more for each CELL_SHARE times as many vectors of one label.
LEAST_GRID, MOST_GRID, CELL_SHARE = 2, 6, 2.5
#: Cells are so many times as wide as a block's reach.
CELL = 4
#: Rounding of the rotated coordinates, far above that of doubles.
SLACK = 1e-9
#: Coordinates travel as whole multiples of 1 / SCALE.
SCALE = 32000
TILE = 1024


@lru_cache(maxsize=4)
def rotation(size: int) -> np.ndarray:
    """A random rotation, the same in every run."""
    q, r = np.linalg.qr(np.random.default_rng(7).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def reaches(size: int, cosine: float) -> list[tuple[slice, float]]:
    """The coordinates of each block and its share of the squared distance."""
    cuts = list(range(0, size, BLOCK_DIMS)) + [size]
    return [(slice(a, b), (2 - 2 * cosine) * (b - a) / size + SLACK) for a, b in zip(cuts, cuts[1:], strict=False)]


@F.pandas_udf(StructType([StructField("size", IntegerType()), StructField("vector", BinaryType())]))
def packed(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """How many numbers the vector has, and these as floats, or as doubles if floats cannot hold them; null if
    it is null, zero, empty or not finite throughout."""
    for part in parts:
        sizes, out = [], []
        for vector in part:
            values = None if vector is None else np.asarray([np.nan if x is None else x for x in vector], np.float64)
            fine = values is not None and len(values) and np.isfinite(values).all() and values.any()
            if fine:
                with np.errstate(over="ignore", under="ignore"):
                    short = values.astype(np.float32)
                out.append((short if (short == values).all() else values).tobytes())
            else:
                out.append(None)
            sizes.append(len(values) if fine else 0)
        yield pd.DataFrame({"size": pd.array(sizes, "int32"), "vector": pd.Series(out, dtype=object)})


def numbers(vectors: pd.Series, size: int) -> np.ndarray:
    """Packed vectors of ``size`` numbers as rows of doubles."""
    rows = [np.frombuffer(v, np.float32 if len(v) == 4 * size else np.float64) for v in vectors]
    return np.array(rows, np.float64).reshape(len(rows), size)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that neither huge nor tiny numbers overflow."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


CELLS = "size int, block int, cell bigint, guest boolean, id binary, place binary"
#: What deals the work out; a cell's number comes from label and grid by a hash. Should two cells share one,
#: vectors meet that have nothing to do with each other, and verification parts them.
GROUP = ["size", "block", "cell"]
PACKET = [*GROUP, "tile_i", "tile_j"]


def cells_of(cosine: float, dims: int):
    """Each vector in its own cell of every block's coarse grid and, as a guest, in the later cells within reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for size, rows in frame.groupby("size"):
                turned = unit(numbers(rows.vector, int(size))) @ rotation(int(size))
                seed = rows.seed.to_numpy().view(np.uint64)
                for block, (where, reach) in enumerate(reaches(int(size), cosine)):
                    radius = np.sqrt(reach)
                    width = CELL * radius
                    grid = turned[:, where][:, :dims]
                    home = np.floor(grid / width).astype(np.int64)
                    low, high = np.floor((grid - radius) / width).astype(np.int64), np.floor((grid + radius) / width).astype(np.int64)
                    own, at, cell = number(home), [np.arange(len(rows))], [home]
                    corners = np.stack(np.meshgrid(*[[0, 1]] * grid.shape[1], indexing="ij"), -1).reshape(-1, grid.shape[1])
                    for corner in corners:
                        other = np.where(corner, high, low)
                        fresh = (number(other) > own) & ((low != high) | (corner == 0)).all(axis=1)
                        at.append(np.flatnonzero(fresh))
                        cell.append(other[fresh])
                    guest = np.repeat([False, True], [len(rows), sum(map(len, at[1:]))])
                    at, cell = np.concatenate(at), number(np.concatenate(cell)).view(np.uint64)
                    places = np.rint(turned[:, where] * SCALE).astype(np.int16)
                    part = rows.iloc[at]
                    yield pa.record_batch([
                        pa.array(np.full(len(at), size, np.int32)), pa.array(np.full(len(at), block, np.int32)), pa.array(mix(mix(cell) + seed[at]).view(np.int64)), pa.array(guest),
                        pa.array(part.id, pa.binary()), pa.array([places[i].tobytes() for i in at.tolist()], pa.binary()),
                    ], names=["size", "block", "cell", "guest", "id", "place"])

    return run


def number(cells: np.ndarray) -> np.ndarray:
    """One number for a cell, in the order of its coordinates as far as they fit; below 2 ** 60."""
    bits = 60 // cells.shape[1]
    out = np.zeros(len(cells), np.int64)
    for column in cells.T:
        out = (out << bits) + np.clip(column + (1 << bits - 1), 0, (1 << bits) - 1)
    return out


def close(points: np.ndarray, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs i < j of points whose distance is at most ``reach``, each once, a slice at a time.

    The points' fine cells, a reach wide, form a tree with a level for each coordinate. Pairs of nodes that
    are at most one cell apart are followed from level to level, so points are only compared if their cells
    touch in every coordinate."""
    grid = np.floor(points / reach).astype(np.int64)
    grid -= grid.min(axis=0) - 1
    order = np.lexsort(grid.T[::-1])
    points, grid = points[order], grid[order]
    base = int(grid.max()) + 2
    # Nodes of a level are runs of the sorted points; each knows its parent and its cell in its coordinate.
    starts, a, b = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
    new = np.zeros(len(points), bool)
    new[0] = True
    for column in grid.T:
        new[1:] |= column[1:] != column[:-1]
        below = np.flatnonzero(new)
        parent = np.searchsorted(starts, below, side="right") - 1
        code = parent * base + column[below]
        first = np.searchsorted(parent, np.arange(len(starts) + 1))
        pair, child = spread(first[a], first[a + 1])
        left = np.searchsorted(code, b[pair] * base + column[below[child]] - 1)
        right = np.searchsorted(code, b[pair] * base + column[below[child]] + 1, side="right")
        at, other = spread(left, right)
        a, b = child[at], other
        # Pairs of a node with another are followed in one order only.
        a, b, starts = a[a <= b], b[a <= b], below
    stops = np.r_[starts[1:], len(points)]
    # Each point of one node meets those of the other, in slices of bounded size.
    pair, left = spread(starts[a], stops[a])
    sizes = (stops - starts)[b[pair]]
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE)) + 1
    for pairs, points_of in zip(np.split(pair, cuts), np.split(left, cuts), strict=True):
        at, j = spread(starts[b[pairs]], stops[b[pairs]])
        i = points_of[at]
        i, j = i[i < j], j[i < j]
        gap = points[i] - points[j]
        near = np.einsum("ij,ij->i", gap, gap) <= reach * reach
        i, j = order[i[near]], order[j[near]]
        yield np.minimum(i, j), np.maximum(i, j)


#: Points are compared so many pairs at a time.
SLICE = 1 << 18


def spread(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, each with the place of its range."""
    sizes = np.maximum(stops - starts, 0)
    at = np.repeat(np.arange(len(sizes)), sizes)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[at]


PACKETS = "size int, block int, cell bigint, tile_i int, tile_j int, members array<binary>, pairs binary"


def within_reach(cosine: float):
    """One packet for each tile that has pairs within the block's reach: their members, and the pairs as places
    of these, or as bits of the whole square if that is shorter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows in by_group(batches, PACKET):
            size, block, _, tile_i, tile_j = name
            where, most = reaches(int(size), cosine)[int(block)]
            dims = where.stop - where.start
            guest, side, ids = (rows[c].to_numpy() for c in ("guest", "side", "id"))
            points = np.frombuffer(b"".join(rows.place), np.int16).reshape(len(rows), dims) / SCALE
            found = []
            # Each coordinate is off by half a unit at most, in both points.
            for i, j in close(points, np.sqrt(most) + np.sqrt(dims) / SCALE + SLACK):
                # Two guests meet in a cell of their own, rows of one part in the tile on the diagonal.
                meet = ~(guest[i] & guest[j]) & ((side[i] != side[j]) | (tile_i == tile_j))
                found.append(np.stack([i[meet], j[meet]]))
            pairs = np.concatenate(found, axis=1)
            if pairs.shape[1]:
                members, places = np.unique(pairs, return_inverse=True)
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32())
                yield pa.record_batch([
                    *(pa.array([int(n)], kind) for n, kind in zip(name, kinds, strict=True)),
                    pa.array([ids[members].tolist()], pa.list_(pa.binary())), pa.array([encoded(places.reshape(2, -1), len(members))], pa.binary()),
                ], names=[*PACKET, "members", "pairs"])

    return run


def encoded(pairs: np.ndarray, size: int) -> bytes:
    if pairs.shape[1] * 32 <= size * size:
        return b"p" + pairs.astype(np.uint16).tobytes()
    square = np.zeros(size * size, bool)
    square[pairs[0] * size + pairs[1]] = True
    return b"s" + np.packbits(square).tobytes()


def decoded(pairs: bytes, size: int) -> np.ndarray:
    if pairs[:1] == b"p":
        return np.frombuffer(pairs, np.uint16, offset=1).reshape(2, -1).astype(np.int64)
    return np.stack(np.divmod(np.flatnonzero(np.unpackbits(np.frombuffer(pairs, np.uint8, offset=1), count=size * size)), size))


def links_within(cosine: float):
    """Links of each packet: counts for both ends, and a spanning forest of them as pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows in by_group(batches, PACKET):
            # The first row, of place -1, holds the pairs; members follow by place.
            pairs, members = decoded(rows.pairs.iat[0], len(rows) - 1), rows.iloc[1:]
            ids, copies = members.id.to_numpy(), members.copies.to_numpy().astype(np.int64)
            size, block = int(name[0]), int(name[1])
            vectors = unit(numbers(members.vector, size))
            turned = vectors @ rotation(size)
            labels = pd.factorize(members.label)[0]
            counts, parent, joined = np.zeros(len(ids), np.int64), {}, []
            for start in range(0, pairs.shape[1], 100_000):
                x, y = pairs[:, start : start + 100_000]
                alike = (labels[x] == labels[y]) & (np.einsum("ij,ij->i", vectors[x], vectors[y]) >= cosine)
                x, y = x[alike], y[alike]
                # Counted here if this is the first block within reach.
                fresh = np.ones(len(x), bool)
                for k, (where, most) in enumerate(reaches(size, cosine)[: block + 1]):
                    gap = turned[x][:, where] - turned[y][:, where]
                    within = (gap * gap).sum(axis=1) <= most
                    fresh &= within if k == block else ~within
                x, y = x[fresh], y[fresh]
                np.add.at(counts, x, copies[y])
                np.add.at(counts, y, copies[x])
                joined += forest(x, y, parent)
            linked = np.flatnonzero(counts)
            ends = np.array(joined, np.int64).reshape(-1, 2).T
            if len(linked):
                n = np.r_[counts[linked], np.zeros(ends.shape[1], np.int64)]
                yield pa.record_batch([
                    pa.array([*ids[linked], *ids[ends[0]]], pa.binary()), pa.array(n), pa.array([*[None] * len(linked), *ids[ends[1]]], pa.binary()),
                ], names=["id", "n", "other"])

    return run


def forest(x: np.ndarray, y: np.ndarray, parent: dict[int, int]) -> list[tuple[int, int]]:
    """Those of the links that join parts not joined before."""

    def root(v: int) -> int:
        while (up := parent.get(v, v)) != v:
            parent[v] = parent.get(up, up)
            v = up
        return v

    out = []
    for v, w in zip(x.tolist(), y.tolist(), strict=True):
        a, b = root(v), root(w)
        if a != b:
            parent[a] = b
            out.append((v, w))
    return out


@finished
def near_duplicates(vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(key, n_links, component_id, kept)`` for each row of ``vectors``.

    Rows are linked if their labels are equal and not null and their cosine in double precision is at least
    ``cosine``. Null, empty and zero vectors, those with null or non-finite numbers, and vectors of
    different lengths link with nothing. ``n_links`` counts the other linked rows, ``component_id`` is the
    least key reachable, ``kept`` marks the rows that have it. Equal vectors of one label are compared as
    one, with their number. Rows with a null key have a null component, are kept, and count as links."""
    prepare(vectors.sparkSession)
    given = vectors.select(F.col(key).cast("bigint").alias("key"), F.col(label).cast("string").alias("label"), packed(F.col(vector)).alias("packed"))
    given = given.select("key", "label", "packed.size", "packed.vector")
    # A name for each class that does not depend on the keys, which may be null or repeated.
    digest = F.sha2(F.concat(F.sha2(F.col("label").cast("binary"), 256), F.col("size").cast("string"), F.lit(":"), F.hex("vector")), 256)
    named = given.withColumn("id", F.when(F.col("vector").isNotNull() & F.col("label").isNotNull(), F.unhex(F.substring(digest, 1, 32))))
    classes = stored(named.where("id IS NOT NULL").groupBy("id").agg(
        F.count("*").alias("copies"), F.min("key").alias("least"), F.first("label").alias("label"), F.first("size").alias("size"), F.first("vector").alias("vector")
    ), "classes")
    every = stored(named.select("key", "id"), "rows")
    # The coarse grid follows the largest label, so that its cells' numbers of vectors do not grow with it.
    most = classes.groupBy("label", "size").count().agg(F.max("count")).first()[0] or 1
    dims = int(np.clip(np.ceil(np.log(max(most / TILE, 1)) / np.log(CELL_SHARE)), LEAST_GRID, MOST_GRID))
    cells = classes.select("id", "size", "vector", F.xxhash64("label").alias("seed")).mapInArrow(cells_of(cosine, dims), CELLS)
    dealt = tiles(cells, GROUP, "id", TILE)
    met = dealt.repartition(*PACKET).sortWithinPartitions(*PACKET).mapInArrow(within_reach(cosine), PACKETS)
    packets = stored(met, "packets")
    members = packets.select(*PACKET, F.posexplode("members").alias("place", "id"))
    members = members.join(classes.select("id", "label", "copies", "vector"), "id")
    heads = packets.select(*PACKET, F.lit(-1).alias("place"), "pairs")
    rows = heads.unionByName(members, allowMissingColumns=True).repartition(*PACKET).sortWithinPartitions(*PACKET, "place")
    found = stored(rows.mapInArrow(links_within(cosine), "id binary, n bigint, other binary"), "links")
    counts = found.where("other IS NULL").groupBy("id").agg(F.sum("n").alias("n"))
    reached = components(found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "id")
    roots = classes.select("id", "copies", "least").join(reached, "id", "left").withColumn("root", F.coalesce("component", "id"))
    smallest = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    known = roots.join(smallest, "root").join(counts, "id", "left").select(
        "id", "component_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")
    )
    result = every.join(known, "id", "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("component_id", "key"))
    return result.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"),
    )
