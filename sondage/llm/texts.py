"""Numbers that describe a text, and the bounded samples of labelled rows that classifiers learn from."""

from __future__ import annotations

import re
import zlib
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondage.llm.tables import Memo

# What a word's letters, digits and marks are written as in its shape.
LETTERS, CAPITALS, DIGITS = re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+"), re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"\d+")
REPEATED = re.compile(r"([^\w\s])\1+")
SHAPES = 256


def fold_of(key: str, folds: int) -> Column:
    """The remainder by which rows are put into folds: CRC-32 of the key as text."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds))


def shape(word: str) -> int:
    """A bucket for the form of a word: runs of small letters, capitals and digits, and its marks."""
    form = REPEATED.sub(r"\1\1", DIGITS.sub("0", LETTERS.sub("a", CAPITALS.sub("A", word))))
    return zlib.crc32(form.encode()) % SHAPES


def shapes() -> Memo:
    return Memo(shape, 300_000)


def describe(text: str, forms: Memo) -> np.ndarray:
    """How a whole text is written, as SHAPES + 8 numbers that don't depend on its topic: shares of word
    forms, and rates of distinct words, repeats and marks. An empty text gives zeros."""
    words = text.split()
    out = np.zeros(SHAPES + 8, np.float32)
    if not words:
        return out
    n = len(words)
    counts = np.bincount(np.fromiter(map(forms.__getitem__, words), np.int64, n), minlength=SHAPES)
    out[:SHAPES] = np.sqrt(counts / n)
    lines = [line for line in text.split("\n") if line]
    out[SHAPES:] = (
        len(set(words)) / n,
        np.sqrt(sum(map(eq, words, words[1:])) / n),
        np.sqrt(sum(map(eq, words, words[2:])) / n),
        np.log1p(n) / 10,
        np.log(len(text) / n) / 5,
        1 - len(set(lines)) / max(1, len(lines)),
        np.sqrt(sum(text.count(c) for c in "#$%&*|!") / len(text)),
        n / (n + 20),
    )
    return out


def sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, those of least hash: the same ones in every run."""
    return rows.orderBy(F.xxhash64(key), key).limit(most)
