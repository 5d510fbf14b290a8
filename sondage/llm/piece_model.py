"""Byte-level BPE by a sentencepiece model that is written down from a vocabulary file of ranks.

Every byte string of the vocabulary becomes one piece, its bytes written as one letter each and scored by
the negative rank, so that the library's merges (highest score first, equal ones from the left) are those
of the ranks. Normalisation is the identity; nothing is trained. A text is cut into pre-tokens by the
vocabulary's pattern, each of these is encoded on its own, and ids are turned back into bytes by the
inverse of the same mapping.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.llm.bpe import byte_letters
from sondage.llm.tables import utf8

# Numbers of the fields of a sentencepiece model file, and its codes for kinds of pieces and models.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
TEXT, SCORE, KIND = 1, 2, 3
MODEL_TYPE, BPE = 3, 2
NAME, DUMMY_PREFIX, REMOVE_BLANKS, ESCAPE_BLANKS = 1, 3, 4, 5
NORMAL, UNKNOWN = 1, 2

#: Pre-tokens whose ids a task remembers between two texts, none of them longer than so many letters.
REMEMBERED, LONGEST = 300_000, 64
#: Characters of a text that are looked at together.
STRETCH = 1 << 20


def number(value: int) -> bytes:
    """A variable-length integer of the protocol-buffer format."""
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes(out) + bytes([value])


def whole(field: int, value: int) -> bytes:
    return number(field << 3) + number(value)


def block(field: int, content: bytes) -> bytes:
    return number(field << 3 | 2) + number(len(content)) + content


def single(field: int, value: float) -> bytes:
    return number(field << 3 | 5) + struct.pack("<f", value)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file; read by the driver alone."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The model file: the piece at place r has rank r, and one behind them stands for what is unknown.

    Ranks are the numbers from 0 on without gaps, and every single byte has one; the library keeps scores
    as 32-bit floats, which are exact to 16,777,216."""
    ordered = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in ordered] != list(range(len(ordered))) or len(ordered) > 1 << 24 or not all(bytes([b]) in ranks for b in range(256)):
        raise ValueError("ranks must run from 0 without gaps and name all single bytes")
    letters = {b: c for c, b in byte_letters().items()}
    pieces = [
        block(PIECES, block(TEXT, "".join(map(letters.__getitem__, token)).encode()) + single(SCORE, -rank) + whole(KIND, NORMAL))
        for rank, token in enumerate(ordered)
    ]
    # A name of several bytes that no mapped text can hold.
    pieces.append(block(PIECES, block(TEXT, b"<\x01unknown\x01>") + single(SCORE, 0) + whole(KIND, UNKNOWN)))
    rules = block(NAME, b"identity") + whole(DUMMY_PREFIX, 0) + whole(REMOVE_BLANKS, 0) + whole(ESCAPE_BLANKS, 0)
    return b"".join(pieces) + block(TRAINER, whole(MODEL_TYPE, BPE)) + block(NORMALIZER, rules)


class PieceCodec:
    """Encodes and decodes with one serialised model and one pattern of pre-tokens."""

    def __init__(self, model: bytes, pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        letters = byte_letters()
        self.table = {i: c for c, i in letters.items()}
        size = self.processor.get_piece_size() - 1
        self.bytes_of = [bytes(map(letters.__getitem__, self.processor.id_to_piece(i))) for i in range(size)]
        # A pre-token that is itself in the vocabulary is that token, whether or not merges lead to it.
        self.known = {token: struct.pack("<I", i) for i, token in enumerate(self.bytes_of)}
        self.pattern = regex.compile(pattern)
        self.forget()

    def learn(self, tokens: set[str]) -> None:
        """Have ``ids`` hold those of all given pre-tokens, found in one call of the library."""
        other = []
        for token in tokens:
            ids = self.known.get(token.encode())
            if ids is None:
                other.append(token)
            else:
                self.ids[token] = ids
        mapped = [token.encode().decode("latin-1").translate(self.table) for token in other]
        for token, found in zip(other, self.processor.encode(mapped, num_threads=1), strict=True):
            self.ids[token] = struct.pack(f"<{len(found)}I", *found)

    def encode_tokens(self, tokens: list[str]) -> bytes:
        """Ids of pre-tokens. Short ones are remembered, until there are too many between two texts."""
        ids = self.ids
        if len(ids) > REMEMBERED:
            ids.clear()
        new = set(tokens).difference(ids)
        self.learn(new)
        out = b"".join(map(ids.__getitem__, tokens))
        for token in new:
            if len(token) > LONGEST:
                del ids[token]
        return out

    def forget(self) -> None:
        """Drop what was remembered of texts, so that an idle worker holds only the model."""
        self.ids: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids of a text of any length, whose pre-tokens are looked at in stretches."""
        if len(text) <= STRETCH:
            return self.encode_tokens(self.pattern.findall(text))
        out, held, size = [], [], 0
        for match in self.pattern.finditer(text):
            held.append(match[0])
            size += len(held[-1])
            if size >= STRETCH:
                out.append(self.encode_tokens(held))
                held, size = [], 0
        return b"".join([*out, self.encode_tokens(held)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=1)
def codec(model: bytes, pattern: str) -> PieceCodec:
    return PieceCodec(model, pattern)


def encode(docs: DataFrame, model: bytes, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """Add ``ids``: the token ids of ``text`` as little-endian unsigned 32-bit integers, end to end.

    ``model`` comes from ``serialise``. Null and empty texts give empty ids. A column of that name is
    replaced, all others stay. Texts are encoded whole, whatever their length; written special tokens are
    ordinary text; bytes that are not UTF-8 count as U+FFFD. Rows are independent, so ties and repeated
    rows need no care, and an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast((model, pattern))

    @F.pandas_udf("binary")
    def encoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(*shared.value)
        for part in parts:
            yield pd.Series([own.encode(x.decode("utf-8", "replace")) for x in part], dtype=object)
        own.forget()

    return docs.withColumn(ids, encoded(utf8(text)))


def decode(encoded: DataFrame, model: bytes, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Add ``out``, the bytes that ``ids`` stand for; null ids give no bytes, ids that are not in the
    vocabulary an error. A column of that name is replaced, all others stay."""
    shared = encoded.sparkSession.sparkContext.broadcast((model, pattern))

    @F.pandas_udf("binary")
    def decoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(*shared.value)
        for part in parts:
            yield pd.Series([own.decode(x or b"") for x in part], dtype=object)

    return encoded.withColumn(out, decoded(F.col(ids)))


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text, and reduce both to digests: ``doc_id, n_tokens, ids_sha256,
    decoded_sha256``, a row for each row. Null texts count as empty ones, null keys stay null, repeated
    rows give repeated results, other columns of ``docs`` are not looked at."""
    model = serialise(read_ranks(path))
    given = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    both = decode(encode(given, model, pattern), model, pattern)
    return both.select(
        "doc_id",
        F.expr("CAST(octet_length(token_ids) / 4 AS BIGINT)").alias("n_tokens"),
        F.sha2(F.col("token_ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
