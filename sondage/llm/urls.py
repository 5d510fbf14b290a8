"""Verdicts on URLs by a list of hosts and paths, with DataFrame operations only.

A listed entry holds for its host, all subdomains and every path that starts with its own. The canonical
forms a URL could be listed under are its host and the parents of it, each with the openings of its path
that are as long as a listed path. A blocked Bloom filter (one 64-bit word for each form) passes those
that may be listed; an exact hash join with the list removes the false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sondage.llm.tables import let

#: Words of the filter at most: 1 MB. A longer list makes more forms pass on to the join, no wrong verdicts.
FILTER_WORDS, PROBES = 1 << 17, 4
#: Lists up to so many entries are broadcast to the exact join (some 100 bytes each).
BROADCAST_ENTRIES = 100_000
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: str) -> Column:
    """What stands after the first ``://`` up to ``/ ? #``, A-Z in lower case; empty for null or no ``://``."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, A_TO_Z, A_TO_Z.lower())


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def parents(host: Column) -> Column:
    """The host and all its parent domains; none for an empty host."""
    def each(labels: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))

    return F.when(host != "", let(F.split(host, r"\.", -1), each)).otherwise(F.array().cast("array<string>"))


def word_index(form: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(form), F.lit(words)).cast("int")


def bits(form: Column) -> Column:
    """The bits of its word that a form sets."""
    h = F.xxhash64(form, F.lit("bits"))
    out = F.lit(0).cast("bigint")
    for i in range(PROBES):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return out


def bloom(forms: DataFrame, words: int) -> list[int]:
    """The filter's words, at most FILTER_WORDS of them."""
    filled = forms.groupBy(word_index(F.col("form"), words).alias("i")).agg(F.bit_or(bits(F.col("form"))).alias("w"))
    out = [0] * words
    for row in filled.collect():
        out[row.i] = row.w
    return out


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to ``pages``; columns of these names are replaced.

    ``rules (host, path, verdict)`` names canonical hosts and opening paths. The longest fitting rule
    wins, of equally long ones the first by name; repeated rules are one, and of contradicting ones
    ``block`` wins. Where none fits, ``rule`` is null and the verdict ``default``. Null URLs and those
    without ``://`` have an empty host and path and fit no rule. Every row gives one row."""
    named = rules.where("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path").agg(F.max("verdict").alias("listed"))
    named = named.withColumn("form", F.concat("host", "path"))
    entries = named.count()
    # Path lengths are bounded by the longest URL, so few enough to be known everywhere.
    lengths = sorted(r[0] for r in named.select(F.length("path")).distinct().collect())
    placed = pages.drop("host", "path", "rule", "verdict").withColumn("host", host_of(url)).withColumn("path", path_of(url))
    if not entries:
        return placed.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    words = min(FILTER_WORDS, entries)
    # One constant, however many words it has.
    filter_words = F.split(F.lit(",".join(map(str, bloom(named, words)))), ",").cast("array<bigint>")

    openings = F.transform(F.filter(F.lit(lengths), lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    forms = let(openings, lambda paths: F.flatten(F.transform(parents(F.col("host")), lambda h: F.transform(paths, lambda p: F.concat(h, p)))))
    possible = F.filter(forms, lambda f: F.get(filter_words, word_index(f, words)).bitwiseAND(bits(f)) == bits(f))
    numbered = placed.withColumn("__row", F.monotonically_increasing_id()).withColumn("__forms", possible)

    listed = named.select(F.col("form").alias("__form"), "listed")
    listed = F.broadcast(listed) if entries <= BROADCAST_ENTRIES else listed
    hits = numbered.withColumn("__form", F.explode_outer("__forms")).drop("__forms").join(listed, "__form", "left")
    rank = F.when(F.col("listed").isNotNull(), F.struct(F.length("__form").alias("n"), F.col("__form").alias("rule"), "listed"))
    kept = placed.columns
    best = hits.groupBy("__row").agg(*(F.first(c).alias(c) for c in kept), F.max(rank).alias("__best"))
    return best.select(*kept, F.col("__best.rule").alias("rule"), F.coalesce("__best.listed", F.lit(default)).alias("verdict"))


def rule_table(spark: SparkSession, rules: tuple[tuple[str, str, str], ...]) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")
