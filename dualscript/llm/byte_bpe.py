"""Byte-level BPE encoding and decoding with tiktoken and a local rank file."""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 200_000  # code points after which a long text is cut at the next safe boundary

#: Places where the pattern always ends a match: before a single space between
#: visible characters, and between a letter and a digit.
_SAFE = regex.compile(r"(?<=\S)(?= \S)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@functools.lru_cache(maxsize=4)
def _encoding(raw: bytes, pattern: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, raw.splitlines())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Cut a text where no match of the pattern is cut; one piece where there is no such place."""
    start = 0
    while len(text) - start > size:
        found = _SAFE.search(text, start + size)
        if found is None or found.start() >= len(text):
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:]


def encode(encoding: tiktoken.Encoding, text: str) -> np.ndarray:
    parts = [np.asarray(encoding.encode_ordinary(p), dtype="<u4") for p in safe_pieces(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def decode(encoding: tiktoken.Encoding, ids: np.ndarray) -> bytes:
    """The raw bytes of the ids; a token may hold part of a character."""
    return encoding.decode_bytes(ids.tolist())


def bpe_digests(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256``: each whole text encoded, then decoded again.

    A null text is an empty one and has no ids; special tokens' strings are
    ordinary text; keys may be null or repeat; an empty table gives an empty result.
    """
    with open(ranks, "rb") as f:
        raw = docs.sparkSession.sparkContext.broadcast(f.read())  # the rank file, of fixed size

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        encoding, rows = _encoding(raw.value, pattern), []
        for t in texts:
            ids = encode(encoding, t or "")
            rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                         hashlib.sha256(decode(encoding, ids)).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(key).alias(key), digests(F.col(text)).alias("_d")).select(key, "_d.*")


def bpe_ids(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids``: the token ids of each whole text; null and empty texts have none."""
    with open(ranks, "rb") as f:
        raw = docs.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        encoding = _encoding(raw.value, pattern)
        return pd.Series([encode(encoding, t or "").astype(np.int32) for t in texts])

    return docs.select(F.col(key).alias(key), ids(F.col(text)).alias("ids"))


def bpe_texts(tokens: DataFrame, ranks: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, decoded``: the raw bytes of each list of ids; a null list gives null."""
    with open(ranks, "rb") as f:
        raw = tokens.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("binary")
    def decoded(lists: pd.Series) -> pd.Series:
        encoding = _encoding(raw.value, pattern)
        return pd.Series([None if x is None else decode(encoding, np.asarray(x)) for x in lists])

    return tokens.select(F.col(key).alias(key), decoded(F.col(ids)).alias("decoded"))
