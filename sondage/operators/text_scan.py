"""Checks of text columns: personal data in free text, spelling variants in categories."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondage.functions.canonical import quoted
from sondage.functions.text import DEFAULT_ENTITIES, DETECTORS, WORD, normal_form, words
from sondage.session import durable

# Fixed values.
FREE_TEXT_MIN_AVG_LENGTH = 40
FREE_TEXT_MIN_DISTINCT_RATIO = 0.5
PII_SAMPLE_SIZE = 200

#: Listed names up to so many are broadcast (some 100 bytes each); beyond, one that more than so many texts
#: mention is dealt to so many tasks.
BROADCAST_NAMES, HOT_TEXTS, SALTS = 100_000, 100_000, 16
#: The filter of opening words has at most 2 to this power 64-bit cells: 1 MB.
FILTER_CELLS = 17


def free_text_flags(facts: DataFrame, distincts: DataFrame) -> DataFrame:
    """``(table, column, avg_length, distinct_ratio, is_free_text)`` for string columns holding
    values: long on average and mostly different from each other."""
    joined = facts.filter("chars IS NOT NULL AND non_null > 0").join(
        distincts.filter("column IS NOT NULL"), ["table", "column"]
    )
    average = F.col("chars") / F.col("non_null")
    ratio = F.col("distinct_count") / F.col("non_null")
    return joined.select(
        "table",
        "column",
        average.alias("avg_length"),
        ratio.alias("distinct_ratio"),
        ((average >= FREE_TEXT_MIN_AVG_LENGTH) & (ratio >= FREE_TEXT_MIN_DISTINCT_RATIO)).alias("is_free_text"),
    )


def hash_sample(df: DataFrame, key: Column, size: int = PII_SAMPLE_SIZE) -> DataFrame:
    """A repeatable sample: the ``size`` rows with the smallest digest of ``key``. Every task keeps
    its own ``size`` smallest, so only those are merged."""
    return df.orderBy(F.md5(key.cast("string"))).limit(size)


def scan_pii(df: DataFrame, columns: list[str], entities=DEFAULT_ENTITIES) -> DataFrame:
    """``(column, entity, hits, scanned, pct)``: values of each column in which an entity occurs.
    One pass over the whole columns; entities that never occur are left out."""
    aggregates, entries = [], []
    for i, column in enumerate(columns):
        value = quoted(column)
        aggregates.append(F.count(value).alias(f"n{i}"))
        for entity in entities:
            aggregates.append(F.count_if(DETECTORS[entity](value)).alias(f"{entity}{i}"))
            entries.append(
                F.struct(
                    F.lit(column).alias("column"),
                    F.lit(entity).alias("entity"),
                    F.col(f"{entity}{i}").alias("hits"),
                    F.col(f"n{i}").alias("scanned"),
                )
            )
    found = df.agg(*aggregates).select(F.inline(F.array(*entries))).filter("hits > 0")
    return found.withColumn("pct", F.round(F.col("hits") / F.col("scanned") * 100, 1))


def scan_pii_sample(df: DataFrame, column: str, key: Column, size: int = PII_SAMPLE_SIZE, entities=DEFAULT_ENTITIES) -> DataFrame:
    """The same on a repeatable sample of the non-null values."""
    value = quoted(column)
    sample = hash_sample(df.filter(value.isNotNull()).select(value, key.alias("sample_key")), F.col("sample_key"), size)
    return scan_pii(sample, [column], entities)


def _listed(names: DataFrame) -> DataFrame:
    """``(phrase, first, size, entity)`` of a list of names: lower-case words with a blank between."""
    spelled = names.select("entity", F.regexp_extract_all(F.lower("name"), F.lit(WORD), F.lit(0)).alias("words")).filter("size(words) > 0")
    return spelled.select(F.array_join("words", " ").alias("phrase"), F.get("words", F.lit(0)).alias("first"), F.size("words").alias("size"), "entity").distinct()


def _word_filter(words: DataFrame, count: int) -> Callable[[Column], Column]:
    """A test that all given words pass, and few others: a bit for each word's hash, in a constant whose
    size is bounded however long the list is. What passes wrongly is dropped by the join behind it."""
    cells = 1 << min(max((count // 4).bit_length(), 4), FILTER_CELLS)
    h = F.xxhash64("word")
    marked = words.select(F.pmod(h, F.lit(cells)).alias("cell"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 58).cast("int")).alias("bit"))
    bits = [0] * cells
    for row in marked.groupBy("cell").agg(F.bit_or("bit").alias("bits")).collect():
        bits[row["cell"]] = row["bits"]
    constant = F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>")

    def passes(word: Column) -> Column:
        own = F.xxhash64(word)
        cell = F.get(constant, F.pmod(own, F.lit(cells)).cast("int"))
        return F.call_function("shiftrightunsigned", cell, F.shiftrightunsigned(own, 58).cast("int")).bitwiseAND(F.lit(1)) == 1

    return passes


def name_mentions(df: DataFrame, column: str, names: DataFrame) -> DataFrame:
    """``(row, entity, phrase)``: the listed names that each value of ``column`` mentions; ``row`` numbers
    the rows of ``df`` with gaps. ``names (name, entity)`` may hold names of several words, and any number of them.

    Names are found as runs of words, in any case and whatever stands between the words. A word opens a
    run only if it may open a listed name, so frequent words of the texts are gone before any join or shuffle; the
    runs, up to the longest listed name, then meet the names in an equi-join. Nulls mention nothing."""
    listed = durable(_listed(names))
    shape = listed.agg(F.count("*").alias("names"), F.array_sort(F.collect_set("size")).alias("sizes"), F.approx_count_distinct("first").alias("firsts")).first()
    if not shape["names"]:
        return df.sparkSession.createDataFrame([], "row bigint, entity string, phrase string")
    longest = shape["sizes"][-1]
    opens = _word_filter(listed.select(F.col("first").alias("word")), shape["firsts"])
    texts = df.select(F.monotonically_increasing_id().alias("row"), F.regexp_extract_all(F.lower(quoted(column)), F.lit(WORD), F.lit(0)).alias("words"))
    places = F.sequence(F.lit(1), F.size("words"))
    runs = texts.filter("size(words) > 0").select("row", F.explode(F.transform(places, lambda i: F.slice("words", i, longest))).alias("run"))
    runs = runs.filter(opens(F.get("run", F.lit(0))))
    each = F.array(*[F.when(F.size("run") >= n, F.array_join(F.slice("run", 1, n), " ")) for n in shape["sizes"]])
    spoken = runs.select("row", F.explode(each).alias("phrase")).filter("phrase IS NOT NULL").distinct()
    listed = listed.select("phrase", "entity")
    if shape["names"] <= BROADCAST_NAMES:
        return spoken.join(F.broadcast(listed), "phrase").select("row", "entity", "phrase")
    # A name that very many texts mention is dealt out to several tasks; the others, nearly all, are sent once.
    spoken = durable(spoken)
    often = spoken.groupBy("phrase").agg(F.count("*").alias("texts")).filter(F.col("texts") > HOT_TEXTS).select("phrase", F.lit(SALTS).alias("salts"))
    salted = listed.join(often, "phrase", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    salted = salted.select("phrase", "entity", "salts", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    dealt = spoken.join(often.withColumnRenamed("salts", "dealt"), "phrase", "left").withColumn("dealt", F.coalesce("dealt", F.lit(1)))
    dealt = dealt.select("row", "phrase", F.pmod("row", "dealt").cast("int").alias("salt"))
    return dealt.join(salted.drop("salts"), ["phrase", "salt"]).select("row", "entity", "phrase")


def scan_name_list(df: DataFrame, columns: list[str], names: DataFrame) -> DataFrame:
    """``(column, entity, hits, scanned, pct)``: values of each column that mention a listed name of an
    entity, such as PERSON or LOCATION; entities that never occur are left out."""
    found = []
    for column in columns:
        hits = name_mentions(df, column, names).select("row", "entity").distinct().groupBy("entity").agg(F.count("*").alias("hits"))
        scanned = df.agg(F.count(quoted(column)).alias("scanned")).scalar()
        found.append(hits.select(F.lit(column).alias("column"), "entity", "hits", scanned.alias("scanned")))
    return reduce(DataFrame.unionAll, found).withColumn("pct", F.round(F.col("hits") / F.col("scanned") * 100, 1))


def scan_names(df: DataFrame, column: str, key: str, names: DataFrame, entity: str) -> DataFrame:
    """Values that mention a listed single-word name (persons, places). ``names`` holds one column
    ``name``. Words are matched by an equi-join, so the list may be of any size."""
    listed = names.select(F.lower("name").alias("word")).distinct()
    mentions = (
        df.select(quoted(key).alias("key"), F.explode(words(F.lower(quoted(column)))).alias("word"))
        .join(listed, "word", "left_semi")
        .select("key")
        .distinct()
    )
    hits = mentions.agg(F.count("*").alias("hits"))
    scanned = df.agg(F.count(quoted(column)).alias("scanned")).select(F.struct("*")).scalar()
    share = F.when(F.col("scanned") > 0, F.round(F.col("hits") / F.col("scanned") * 100, 1)).otherwise(0.0)
    return hits.select(
        F.lit(column).alias("column"), F.lit(entity).alias("entity"), "hits", scanned["scanned"].alias("scanned")
    ).withColumn("pct", share)


def casing_variants(table: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """``(table, column, normal_form, form, rows)`` of values that appear in more than one casing
    or spacing. One scan counts the spellings, merged in each task before the shuffle, so frequent ones
    shrink; what has several is found among the counts by comparing 128-bit hashes of the spellings in
    fixed-size aggregates. No group is gathered in one task."""
    cells = [F.struct(F.lit(c).alias("column"), quoted(c).alias("form")) for c in columns]
    forms = (
        df.select(F.inline(F.array(*cells)))
        .filter("form IS NOT NULL")
        .withColumn("normal_form", normal_form(F.col("form")))
        .filter("normal_form <> ''")
        .groupBy("column", "normal_form", "form")
        .agg(F.count("*").alias("rows"))
    )
    several = (
        forms.groupBy("column", "normal_form")
        .agg(*[f(F.xxhash64(F.lit(seed), "form")).alias(f"{f.__name__}{seed}") for f in (F.min, F.max) for seed in (1, 2)])
        .filter("min1 <> max1 OR min2 <> max2")
    )
    found = forms.join(several, ["column", "normal_form"], "left_semi")
    return found.select(F.lit(table).alias("table"), "column", "normal_form", "form", "rows")


def casing_variants_of(tables: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame | None:
    parts = [casing_variants(t, tables[t], c) for t, c in columns.items() if c]
    return reduce(DataFrame.unionAll, parts) if parts else None
