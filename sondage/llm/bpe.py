"""Byte-pair encoding by dynamic programming over the prefixes of a piece of text.

For every prefix there is exactly one token that can end its encoding. The suffixes of the prefix that
are tokens come from an automaton over the vocabulary; a suffix is the last token if the last token of
what stands before it may be followed by it, that is, if no merge would ever cross the border between
the two. Back-pointers from the end then give the ids. No merge queue is run.
"""

from __future__ import annotations

import json
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from sondage.llm.tables import Memo, give_back, pieces, utf8

# Fixed value: the byte-level pre-tokenizer's pattern.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# A blank that does not open a word: such texts are not cut at blanks.
LOOSE_BLANK = re.compile(r" (?:\s|\Z)")
PLAIN_MARKS = ("", ",", ".", ";", ":", "!", "?")
NEVER = 1 << 62


def byte_letters() -> dict[str, int]:
    """The letter by which vocabulary files write each byte: printable bytes as themselves, the others
    in order from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encodes and decodes with one vocabulary file of the ``tokenizers`` library (byte-level BPE)."""

    def __init__(self, definition: str):
        parsed = json.loads(definition)
        letters = byte_letters()
        vocabulary = parsed["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items()}
        size = 1 + max([*vocabulary.values(), *self.special.values()])
        # By token: its halves, and the position of the merge that makes it; -1 where no merge does. By pair of
        # tokens, two in one number: the position of its merge.
        self.first, self.second, self.made_at = (array("i", [-1]) * size for _ in range(3))
        self.rank: dict[int, int] = {}
        for position, merge in enumerate(parsed["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            one, two, whole = vocabulary[left], vocabulary[right], vocabulary[left + right]
            self.rank.setdefault(one << 32 | two, position)
            if self.made_at[whole] < 0:
                self.first[whole], self.second[whole], self.made_at[whole] = one, two, position
        usable = bytearray(size)
        self.automaton = ahocorasick.Automaton()
        for token in sorted(self.bytes_of, key=self.made_at.__getitem__):
            halves = (self.first[token], self.second[token]) if self.made_at[token] >= 0 else None
            usable[token] = not halves or (usable[halves[0]] and usable[halves[1]] and self.crossing(*halves) == halves)
            if usable[token] and (halves or len(self.bytes_of[token]) == 1):
                written = self.bytes_of[token].decode("latin-1")
                self.automaton.add_word(written, (token, len(written)))
        self.automaton.make_automaton()
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.written = pa.array(map(self.bytes_of.get, range(size)), pa.large_binary())
        # Keys are two tokens in one number.
        self.follows = Memo(lambda pair: self.crossing(pair >> 32, pair & 0xFFFFFFFF) is None, 200_000)
        # Words without marks are held by ``word`` alone. A task has some hundred thousand distinct words.
        self.piece = Memo(self.encode_piece, 20_000)
        self.word = Memo(self.encode_word, 400_000)

    def edge(self, halves: array, token: int) -> Iterator[tuple[int, int]]:
        """From a single byte outwards: what stands at a token's edge, each with the position of the merge that
        takes it up."""
        until, out = NEVER, []
        while token >= 0:
            out.append((token, until))
            until, token = self.made_at[token], halves[token]
        return reversed(out)

    def crossing(self, first: int, second: int) -> tuple[int, int] | None:
        """The pair of neighbours that would be merged first across the border of two tokens, if any:
        both edges grow from single bytes in the order of their merges, equal merges from the left."""
        rank, left, right = self.rank, self.edge(self.second, first), self.edge(self.first, second)
        (end, end_until), (start, start_until) = next(left), next(right)
        while True:
            across = rank.get(end << 32 | start, NEVER)
            if across < end_until and across <= start_until:
                return end, start
            if end_until <= start_until:
                if end_until == NEVER:
                    return None
                end, end_until = next(left)
            else:
                start, start_until = next(right)

    def encode_piece(self, piece: str) -> bytes:
        """Ids of a piece as little-endian 32-bit integers."""
        written, follows = piece.encode().decode("latin-1"), self.follows
        last, opened = [-1] * (len(written) + 1), [0] * (len(written) + 1)
        # Matches come by their end, the longest first. Single bytes are tokens, so every shorter prefix has its last.
        for end, (token, size) in self.automaton.iter(written):
            end += 1
            if last[end] < 0:
                start = end - size
                if not start or follows[last[start] << 32 | token]:
                    last[end], opened[end] = token, start
        ids, at = [], len(written)
        while at:
            ids.append(last[at])
            at = opened[at]
        ids.reverse()
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_word(self, word: str) -> bytes:
        """Ids of a blank and what follows it up to the next blank."""
        # Latin letters with at most one mark behind them need no pattern matching.
        letters, mark = (word, "") if word.isalpha() else (word[:-1], word[-1])
        if letters.isalpha() and max(letters) < "\u0250" and mark in PLAIN_MARKS:
            return self.word[letters] + self.piece[mark] if mark else self.encode_piece(" " + letters)
        return b"".join(map(self.piece.__getitem__, PIECES.findall(" " + word)))

    def encode_plain(self, text: str) -> bytes:
        if not text:
            return b""
        if LOOSE_BLANK.search(text):
            return b"".join(map(self.piece.__getitem__, PIECES.findall(text)))
        # Every blank here opens a new piece, so words between blanks are independent of each other.
        first, *words = text.split(" ")
        head = b"".join(map(self.piece.__getitem__, PIECES.findall(first)))
        return head + b"".join(map(self.word.__getitem__, words))

    def encode(self, text: str, specials: bool = True) -> bytes:
        for content, token in self.special.items() if specials else ():
            if content in text:
                mark = np.array([token], dtype="<u4").tobytes()
                return mark.join(self.encode(part, specials) for part in text.split(content))
        return self.encode_plain(text)

    def forget(self) -> None:
        """Drop what was remembered of texts, so that an idle worker holds only the vocabulary."""
        for memo in (self.follows, self.piece, self.word):
            memo.clear()
        give_back()

    def decode(self, ids: bytes) -> str:
        return self.decode_all([ids])[0]

    def decode_all(self, texts: list[bytes]) -> list[str]:
        """The texts of many rows of ids, whose bytes are looked up together."""
        ids = np.frombuffer(b"".join(texts), "<u4")
        found = self.written.take(pa.array(ids))
        if found.null_count:
            raise KeyError(f"ids that are not in the vocabulary: {np.unique(ids[found.is_null().to_numpy(zero_copy_only=False)])[:10]}")
        ends = np.cumsum([0, *(len(t) // 4 for t in texts)])
        cuts = np.frombuffer(found.buffers()[1], np.int64)[ends].tolist() if len(ids) else [0] * len(ends)
        held = memoryview(found.buffers()[2] or b"")
        return [str(held[start:stop], "utf-8", "replace") for start, stop in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=2)
def codec(definition: str) -> Codec:
    return Codec(definition)


def definition(path: str) -> str:
    """Contents of a vocabulary file; read by the driver alone."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids", specials: bool = True) -> DataFrame:
    """Add ``ids``: the token ids of ``text`` as little-endian unsigned 32-bit integers, end to end.

    Null and empty texts give empty ids. A column of that name is replaced; all others stay. Written
    special tokens become their ids, unless ``specials`` is false: then they are ordinary text. Texts of
    any length are encoded whole; rows are independent, so ties and repeated rows need no care."""
    shared = docs.sparkSession.sparkContext.broadcast(definition(path))

    @F.pandas_udf("binary")
    def encoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(shared.value)
        for part in parts:
            yield pd.Series([own.encode(x or "", specials) for x in part], dtype=object)
        own.forget()

    return docs.withColumn(ids, encoded(F.col(text)))


def decode(encoded: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """Add ``text``, decoded from ``ids``; null ids give an empty text, ids that are not in the
    vocabulary an error, bytes that are not UTF-8 U+FFFD."""
    shared = encoded.sparkSession.sparkContext.broadcast(definition(path))

    @F.pandas_udf("string")
    def decoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(shared.value)
        for part in parts:
            yield pd.Series(own.decode_all([x or b"" for x in part]), dtype=object)
        give_back()

    return encoded.withColumn(text, decoded(F.col(ids)))


def encode_and_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``token_ids`` and ``decoded`` of every row: what ``encode`` and ``decode`` give one after the other,
    by one worker instead of two, which hold the vocabulary each."""
    shared = docs.sparkSession.sparkContext.broadcast(definition(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for part, texts in pieces(batches, "t"):
            ids = [own.encode(x.decode()) for x in texts]
            yield pa.record_batch([part.column(0), pa.array(ids, pa.binary()), pa.array(own.decode_all(ids), pa.string())], names=[key, "token_ids", "decoded"])
        own.forget()

    schema = StructType([docs.schema[key], StructField("token_ids", BinaryType()), StructField("decoded", StringType())])
    return docs.select(key, utf8(text).alias("t")).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text, and reduce both to digests."""
    return encode_and_decode(docs, path).select(
        "doc_id",
        F.expr("CAST(octet_length(token_ids) / 4 AS BIGINT)").alias("n_tokens"),
        F.sha2(F.col("token_ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
