"""Texts that hold a benchmark item, found by SimHash over item-sized windows.

DataFrame operations only. A window has as many words as the item; it is contaminated if the multisets of
five-word shingles of window and item have a weighted similarity (sum of lesser counts over sum of
greater counts) of at least 0.8. A window that shares no shingle with an item has similarity 0, so
fingerprints are made only for windows around shared shingles, all of them at every offset. Fingerprints
of 64 bits are compared through a multi-index: four blocks of 16 bits, each looked up within a distance
of 5, which finds every pair within 23 bits. What is found is verified on the shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sondage.llm.tables import finished, let, row_key, stored, unused

WORDS = 5
#: 5 * shared >= 4 * all is a similarity of 0.8.
SHARED, ALL = 5, 4
#: At a similarity of 0.8 about 9.7 of 64 bits differ, with a deviation of 2.9; 23 is 4.6 deviations up.
BITS, BLOCKS, RADIUS = 64, 4, 23
BLOCK_BITS = BITS // BLOCKS
#: Counters of four bits share one number, 15 bits each.
LANES, LANE_BITS = 4, 15
#: Tables of items' shingles up to so many rows are broadcast (16 bytes a row).
BROADCAST_ROWS = 1_000_000
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: str) -> Column:
    """Words in lower case (A-Z), parted by ASCII white space; none for null and blank texts."""
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), A_TO_Z, A_TO_Z.lower())
    return F.filter(F.split(plain, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingles_of(words: Column, width: int) -> Column:
    """Hashes of the shingles, in order; none if the words are fewer than ``width``."""
    def hashed(w: Column) -> Column:
        number = F.size(w) - (width - 1)
        each = F.transform(F.sequence(F.lit(1), number), lambda i: F.xxhash64(F.slice(w, i, width)))
        return F.when(number >= 1, each).otherwise(F.array().cast("array<bigint>"))

    return let(words, hashed)


def counted(shingles: str) -> Column:
    """A multiset as a set: each shingle is hashed with the number of times it has come before."""
    return let(
        F.array_sort(F.col(shingles)),
        lambda ordered: F.transform(ordered, lambda x, i: F.xxhash64(x, i - F.array_position(ordered, x))),
    )


def item_table(items: DataFrame, key: str, text: str) -> DataFrame:
    """Items with words: ``item, n_words, width, shingles``."""
    split = items.select(F.col(key).alias("item"), words_of(text).alias("words")).where(F.size("words") > 0)
    wide = split.withColumn("n_words", F.size("words")).withColumn("width", F.least(F.lit(WORDS), F.col("n_words")))
    either = F.when(F.col("width") == WORDS, shingles_of(F.col("words"), WORDS)).otherwise(F.array(F.xxhash64("words")))
    return wide.select("item", "n_words", "width", either.alias("shingles"))


def places(docs: DataFrame, items: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """Tiles of texts that share a shingle with an item: ``row, n_words, tile, segment``. A tile has the
    windows that start at its n_words places; the segment has their shingles."""
    hashed = docs.select(row_key(key, text).alias("row"), shingles_of(words_of(text), width).alias("hashes"))
    wanted = items.where(F.col("width") == width).select("n_words", F.explode("shingles").alias("shingle")).distinct()
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    met = hashed.select("row", "hashes", F.posexplode("hashes").alias("place", "shingle")).join(wanted, "shingle")
    # Of windows with room for the shingle, the first starts so far ahead of it.
    ahead = F.greatest(F.col("place") - (F.col("n_words") - width), F.lit(0))
    first, last = F.floor(ahead / F.col("n_words")), F.floor(F.col("place") / F.col("n_words"))
    tiled = met.select("row", "hashes", "n_words", F.explode(F.sequence(first, last)).alias("tile"))
    start = F.col("tile") * F.col("n_words")
    segment = F.slice("hashes", (start + 1).cast("int"), F.col("n_words") * 2 - width)
    whole = tiled.select("row", "n_words", "tile", F.lit(width).alias("width"), segment.alias("segment"))
    return whole.where("size(segment) > 0").dropDuplicates(["row", "n_words", "tile"])


def lanes(shingle: Column) -> list[Column]:
    """The 64 bits of a hash as counters, four to a number."""
    def bit(i: int) -> Column:
        return F.shiftleft(F.shiftrightunsigned(shingle, i).bitwiseAND(F.lit(1)).cast("bigint"), (i % LANES) * LANE_BITS)

    return [sum((bit(i) for i in range(g + 1, g + LANES)), bit(g)) for g in range(0, BITS, LANES)]


def fingerprint(counts: list[Column], size: Column) -> Column:
    """Bits that more than half of the shingles have."""
    mask, out = (1 << LANE_BITS) - 1, F.lit(0).cast("bigint")
    for i in range(BITS):
        count = F.shiftrightunsigned(counts[i // LANES], (i % LANES) * LANE_BITS).bitwiseAND(F.lit(mask))
        out = out.bitwiseOR(F.when(count * 2 > size, F.shiftleft(F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")))
    return out


def windows(tiles: DataFrame) -> DataFrame:
    """``row, n_words, content, print, shingles`` for each window of the tiles; a text with fewer words
    than the item is one window."""
    each = tiles.select("row", "n_words", "tile", "width", F.posexplode("segment").alias("at", "shingle"))
    before = Window.partitionBy("row", "n_words", "tile").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum(lane).over(before).alias(f"sum{i}") for i, lane in enumerate(lanes(F.col("shingle")))]
    names = [f"sum{i}" for i in range(len(sums))]
    running = each.select("row", "n_words", "tile", "width", "at", *sums)
    # A window's counters are the running sums at its end less those before its start.
    together = running.groupBy("row", "n_words", "tile", "width").agg(
        F.array_sort(F.collect_list(F.struct("at", *names))).alias("running")
    )
    joined = together.join(tiles, ["row", "n_words", "tile", "width"])
    size = F.col("n_words") - F.col("width") + 1
    last = F.size("segment") - size
    started = joined.select("*", F.explode(F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).alias("start"))
    started = started.where((last >= 0) | (F.col("tile") == 0)).withColumn("held", F.least(size, F.size("segment")))
    end, before = F.element_at("running", F.col("start") + F.col("held")), F.get("running", F.col("start") - 1)
    counts = [end[n] - F.coalesce(before[n], F.lit(0)) for n in names]
    shaped = started.select(
        "row", "n_words", F.slice("segment", F.col("start") + 1, F.col("held")).alias("shingles"),
        fingerprint(counts, F.col("held")).alias("print"), (F.col("tile") * F.col("n_words") + F.col("start")).alias("start"),
    )
    return shaped.withColumn("content", F.xxhash64("shingles"))


def prints_of(items: DataFrame) -> DataFrame:
    each = items.select("item", "n_words", F.explode("shingles").alias("shingle"))
    sums = each.groupBy("item", "n_words").agg(F.count("*").alias("size"), *(F.sum(l).alias(f"s{i}") for i, l in enumerate(lanes(F.col("shingle")))))
    counts = [F.col(f"s{i}") for i in range(BITS // LANES)]
    return sums.select("item", "n_words", fingerprint(counts, F.col("size")).alias("item_print"))


def block(number: str, i) -> Column:
    return F.shiftrightunsigned(F.col(number), i * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")


def neighbours(radius: int = RADIUS) -> Column:
    """All differences of a block within the distance that one of the blocks must keep; a constant."""
    return F.filter(F.sequence(F.lit(0), F.lit((1 << BLOCK_BITS) - 1)), lambda x: F.bit_count(x) <= radius // BLOCKS)


@finished
def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(key, item_key, similarity, place)``: for each row of ``docs`` and each item that it holds, the greatest
    similarity of a window and the word at which the first such window starts.

    Items of fewer than five words are one shingle, all their words. Texts shorter than the item are one
    window. Null, empty and blank texts and items match nothing; empty tables give no rows. Texts are
    read whole; repeated rows give repeated results, repeated item keys count apart by text."""
    table = stored(item_table(items, item_key, item_text), "items")
    widths = [r.width for r in table.select("width").distinct().collect()]  # five values at most
    found = None
    for width in sorted(widths):
        part = places(docs, table, width, key, text)
        found = part if found is None else found.unionByName(part)
    if found is None:
        kinds = f"{key} {docs.schema[key].dataType.simpleString()}, {item_key} {items.schema[item_key].dataType.simpleString()}"
        return docs.sparkSession.createDataFrame([], f"{kinds}, similarity double, place bigint")
    shaped = stored(windows(stored(found, "tiles")), "windows")

    # The same passage in many texts is looked up and verified once.
    distinct = shaped.groupBy("n_words", "content").agg(F.first("print").alias("print"), F.first("shingles").alias("shingles"))
    distinct = stored(distinct, "contents")
    seen = distinct.select("n_words", "content", "print", F.explode(F.array(*(F.struct(F.lit(i).alias("block"), block("print", i).alias("value")) for i in range(BLOCKS)))).alias("b"))
    listed = prints_of(table).select("item", "n_words", "item_print", F.explode(F.array(*(F.struct(F.lit(i).alias("block"), block("item_print", i).alias("value")) for i in range(BLOCKS)))).alias("b"))
    near = listed.select("item", "n_words", "item_print", F.col("b.block").alias("block"), F.col("b.value").alias("value"), F.explode(neighbours()).alias("change"))
    near = near.select("item", "n_words", "item_print", "block", F.col("value").bitwiseXOR(F.col("change")).alias("value"))
    met = seen.select("n_words", "content", "print", "b.block", "b.value").join(near.hint("merge"), ["n_words", "block", "value"])
    # (The planner takes the neighbours to be as few as the items, hence the hint.)
    close = met.where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS).select("item", "n_words", "content").distinct()

    sets = distinct.select("n_words", "content", counted("shingles").alias("window_set"))
    item_sets = table.select("item", "n_words", counted("shingles").alias("item_set"))
    both = close.join(sets, ["n_words", "content"]).join(item_sets, ["item", "n_words"])
    shared = F.size(F.array_intersect("window_set", "item_set"))
    every = F.size("window_set") + F.size("item_set") - F.col("shared")
    verified = both.withColumn("shared", shared).withColumn("every", every).where(SHARED * F.col("shared") >= ALL * F.col("every"))
    hits = verified.groupBy("item", "n_words", "content").agg(F.max(F.col("shared") / F.col("every")).alias("similarity"))

    rows = shaped.select("row", "n_words", "content", "start").join(hits, ["n_words", "content"])
    best = rows.groupBy("row", "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best")
    )
    named = docs.select(F.col(key), row_key(key, text).alias("row")).join(best, "row")
    return named.select(F.col(key), F.col("item").alias(item_key), F.col("best.similarity").alias("similarity"), (-F.col("best.back")).alias("place"))


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold an item. Rows go by key and text: those of a null key go too, and
    a clean row stays when another of its key holds an item."""
    row = unused(docs, "__row")
    named = docs.withColumn(row, row_key(key, text))
    held = contaminated(named.select(row, text), items, row, text).select(row).distinct()
    return named.join(held, row, "left_anti").select(*docs.columns)
