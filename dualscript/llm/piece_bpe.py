"""SentencePiece encoding by vectorised merge rounds over flat numpy arrays, and decoding."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

CACHE_WORDS, CACHE_CHARS = 300_000, 64  # words a worker remembers, and their greatest length
SLICE = 1 << 18  # characters whose words are merged together; the memory bound of a round
LONG = 256  # words above this are cut at places that no piece spans

# --- fixed values: sentencepiece's mark of white space and its kinds of pieces ---
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
# --- end of fixed values ---

NEVER = np.int64(1 << 40)  # the rank of a pair that is no piece


class PieceModel:
    """The merge table of a BPE model with byte fallback and identity normalisation.

    Symbols are vocabulary ids, then characters that only occur inside pieces,
    then one symbol for all other characters.  Two symbols merge if their
    concatenation is a piece; the piece of highest score goes first and, of
    equal scores, the leftmost place.
    """

    def __init__(self, raw: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(raw)
        spec = proto.normalizer_spec
        kinds = {p.type for p in proto.pieces}
        if (proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback or spec.precompiled_charsmap
                or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not spec.escape_whitespaces
                or proto.trainer_spec.treat_whitespace_as_suffix or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError("only BPE models with byte fallback and identity normalisation are supported")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.known = len(proto.pieces)
        symbol = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.bytes = np.zeros(256, np.uint32)
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.bytes[int(p.piece[3:-1], 16)] = i
        pieces = sorted(symbol)
        for c in sorted({c for p in pieces for c in p} - symbol.keys()):
            symbol[c] = self.known + len(symbol)
        self.size = max([self.known, *symbol.values()]) + 2
        self.of_char = np.full(0x110000, self.size - 1, np.int64)
        for p, i in symbol.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        scores = {p: proto.pieces[symbol[p]].score for p in pieces}
        order = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        made = [(symbol[p[:k]] * self.size + symbol[p[k:]], order[scores[p]], symbol[p])
                for p in pieces for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol]
        made.sort()
        self.keys, ranks, self.into = (np.array(c, np.int64) for c in zip(*made))
        self.ranks = np.append(ranks, NEVER)
        self.inside = {a + b for p in pieces for a, b in pairwise(p)}  # neighbours that some piece spans
        self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces) else r"(?s).+")
        self.run = self._run(pieces, scores)

    def _run(self, pieces: list[str], scores: dict[str, float]) -> int:
        """The longest piece of marks, if a run of marks may be cut at its multiples, else 0.

        It may if runs have one score below all others, no piece holds two marks
        and something else, and a run is eaten from the left, the longest piece
        being made before any mark behind it is touched.  Then nothing disturbs
        a run but what its last mark joins.
        """
        runs = {len(p) for p in pieces if set(p) == {MARK} and len(p) > 1}
        low = {scores[MARK * k] for k in runs}
        others = [p for p in pieces if len(p) > 1 and set(p) != {MARK}]
        if len(low) != 1 or not all(scores[p] > min(low) and MARK * 2 not in p for p in others):
            return 0
        longest, eaten = max(runs), [1] * (2 * max(runs))
        while eaten[0] < longest:
            k = next((k for k, (a, b) in enumerate(pairwise(eaten)) if a + b in runs), len(eaten))
            if sum(eaten[:k + 2]) > longest:
                return 0
            eaten[k:k + 2] = [sum(eaten[k:k + 2])]
        return longest

    def cut(self, word: str) -> list[str]:
        """Parts of a long word that no merge can join."""
        parts = []
        marks = len(word) - len(word.lstrip(MARK))
        if self.run and marks > 2 * self.run:
            head = (marks - 1) // self.run * self.run
            parts, word = [MARK * self.run] * (head // self.run), word[head:]
        start = 0
        for k, (a, b) in enumerate(pairwise(word), 1):
            if a + b not in self.inside:
                parts.append(word[start:k])
                start = k
        return [*parts, word[start:]]

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The places of pairs in the merge table; its end for those that are no piece."""
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at, len(self.keys))

    def merge(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers.

        All words lie in one flat array.  A round finds each word's smallest
        pair rank and merges that pair at all its places, leftmost first where
        they overlap.  A merge that makes a pair of no greater rank is the last
        of its word in the round, as that pair comes before the places further
        right.  Words without a pair leave the arrays.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        sym, word, pos = self.of_char[chars], np.repeat(np.arange(len(words)), sizes), np.arange(len(chars))
        pair = np.full(len(sym), len(self.keys))
        inner = np.flatnonzero(word[1:] == word[:-1])
        pair[inner] = self._pairs(sym[inner], sym[inner + 1])
        done = []
        while len(sym):
            rank = self.ranks[pair]
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(sym)))
            least = np.minimum.reduceat(rank, starts)
            if (least == NEVER).any():
                out = np.repeat(least == NEVER, sizes)
                done.append((pos[out], sym[out]))
                stay = ~out
                sym, word, pos, pair, rank = sym[stay], word[stay], pos[stay], pair[stay], rank[stay]
                if not len(sym):
                    break
                least, sizes = least[least < NEVER], sizes[least < NEVER]
            here = np.arange(len(sym))
            fits = rank == np.repeat(least, sizes)
            run = here - np.maximum.accumulate(np.where(fits, -1, here)) - 1
            at = np.flatnonzero(fits & (run % 2 == 0))
            made, mine = self.into[pair[at]], rank[at]
            # the neighbours a merge meets: before it earlier merges are done, after it none is
            before, after = sym[at - 1], sym[np.minimum(at + 2, len(sym) - 1)]
            joined = np.flatnonzero(at[1:] == at[:-1] + 2) + 1
            before[joined] = made[joined - 1]
            first = (at == 0) | (word[at - 1] != word[at])
            last = (at + 2 >= len(sym)) | (word[np.minimum(at + 2, len(sym) - 1)] != word[at])
            left = np.where(first, NEVER, self.ranks[self._pairs(before, made)])
            right = np.where(last, NEVER, self.ranks[self._pairs(made, after)])
            stop = np.minimum(left, right) <= mine
            if stop.any():
                seen = np.cumsum(stop) - stop  # stops before a merge, in all words
                begins = np.flatnonzero(np.append(True, word[at][1:] != word[at][:-1]))
                own = seen - np.repeat(seen[begins], np.diff(np.append(begins, len(at))))
                at, made = at[own == 0], made[own == 0]
            sym[at] = made
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            moved = np.cumsum(stay) - 1
            sym, word, pos, pair = sym[stay], word[stay], pos[stay], pair[stay]
            at = moved[at]
            near = np.zeros(len(sym), bool)
            near[at] = near[at[at > 0] - 1] = True
            new = np.flatnonzero(near)
            end = (new + 1 >= len(sym)) | (word[np.minimum(new + 1, len(sym) - 1)] != word[new])
            pair[new] = np.where(end, len(self.keys), self._pairs(sym[new], sym[np.minimum(new + 1, len(sym) - 1)]))
        if not done:
            return [b""] * len(words)
        pos, sym = (np.concatenate(c) for c in zip(*done))
        order = np.argsort(pos)
        return self._ids(words, chars, pos[order], sym[order])

    def _ids(self, words: list[str], chars: np.ndarray, pos: np.ndarray, sym: np.ndarray) -> list[bytes]:
        """Ids of the remaining symbols per word; characters without a piece become their bytes."""
        counts = np.ones(len(sym), np.int64)
        unknown = np.flatnonzero(sym >= self.known)
        raw = [chr(chars[pos[k]]).encode() for k in unknown]
        counts[unknown] = [len(b) for b in raw]
        ends = np.cumsum(counts)
        ids = np.zeros(ends[-1], "<u4")
        ids[ends - 1] = np.where(sym < self.known, sym, 0)
        for k, b in zip(unknown, raw):
            ids[ends[k] - len(b):ends[k]] = self.bytes[list(b)]
        flat = ids.tobytes()
        last = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        upto = np.append(0, ends)[np.searchsorted(pos, last)] * 4
        return [flat[a:b] for a, b in pairwise([0, *upto.tolist()])]


class Encoder:
    """Ids of texts; short words are remembered, up to ``CACHE_WORDS`` of them."""

    def __init__(self, model: PieceModel):
        self.model, self.memory = model, {}

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        held: list[list[str]] = []
        size = 0
        for t in texts:
            # an empty text gets no mark before it
            held.append(self.model.words.findall(MARK + t.replace(" ", MARK)) if t else [])
            size += len(t or "")
            if size >= SLICE:
                yield from self._encode(held)
                held, size = [], 0
        yield from self._encode(held)

    def _encode(self, held: list[list[str]]) -> Iterator[np.ndarray]:
        if len(self.memory) > CACHE_WORDS:
            self.memory.clear()
        memory = self.memory
        new = set().union(*held).difference(memory)
        parts = {w: self.model.cut(w) if len(w) > LONG else [w] for w in new}
        wanted, size, found = [], 0, {}
        for p in {p for cut in parts.values() for p in cut}:
            wanted.append(p)
            size += len(p)
            if size >= SLICE:
                found.update(zip(wanted, self.model.merge(wanted)))
                wanted, size = [], 0
        if wanted:
            found.update(zip(wanted, self.model.merge(wanted)))
        memory.update((w, b"".join([found[p] for p in cut])) for w, cut in parts.items())
        for words in held:
            yield np.frombuffer(b"".join(map(memory.__getitem__, words)), "<u4")
        for w in new:
            if len(w) > CACHE_CHARS:
                del memory[w]


@functools.lru_cache(maxsize=1)
def _encoder(raw: bytes) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(PieceModel(raw))


def _model(df: DataFrame, path: str):
    """The model file, of fixed size, for the workers."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def piece_ids(docs: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text, as sentencepiece gives them without begin and end.

    Null and empty texts have no ids; strings of special tokens are ordinary
    text; characters without a piece become their bytes.  Other columns pass
    through; a column named ``ids`` is replaced.  An empty table gives an empty
    result.  Unbroken words are cut where no piece spans two characters; what
    remains longer than that costs a round per kind of pair, over its symbols.
    """
    raw = _model(docs, model)

    @F.pandas_udf("array<int>")
    def encoded(texts: pd.Series) -> pd.Series:
        return pd.Series([x.astype(np.int32) for x in _encoder(raw.value).encode(texts.tolist())])

    return docs.withColumn(ids, encoded(F.col(f"`{text}`")))


def piece_texts(tokens: DataFrame, model: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``tokens`` with the text of each list of ids, as sentencepiece decodes it; a null list gives null."""
    raw = _model(tokens, model)

    @F.pandas_udf("string")
    def texts(lists: pd.Series) -> pd.Series:
        library = _encoder(raw.value).model.library
        return pd.Series([None if x is None else library.decode(x.tolist()) for x in lists])

    return tokens.withColumn(decoded, texts(F.col(f"`{ids}`")))


def piece_digests(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of what ``piece_ids`` and ``piece_texts`` give.

    Ids are digested as decimals joined by commas, decoded texts in UTF-8.  A
    text is encoded once, and its ids go no further than its digests.
    """
    raw = _model(docs, model)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        encoder, rows = _encoder(raw.value), []
        for found in encoder.encode(texts.tolist()):
            ids = found.tolist()
            rows.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(encoder.model.library.decode(ids).encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(f"`{key}`").alias(key), digests(F.col(f"`{text}`")).alias("_d")).select(key, "_d.*")
