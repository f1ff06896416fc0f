"""Best-fit packing: length patterns fitted to the histogram by non-negative least squares."""

from __future__ import annotations

import functools
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dualscript.llm.common import small_table
from dualscript.sources.storage import materialise

CAPACITY = 1024
END = 2
CACHE_WORDS = 1_200_000  # words whose ids a worker remembers unless told otherwise; the memory bound
SLICE, JOINED = 1 << 23, 100  # characters whose new words are learned together; words encoded in one call
ROUNDS, SWEEPS = 6, 30  # of pattern enumeration, and of the least squares after each


# ---------------------------------------------------------------- tokens


@functools.lru_cache(maxsize=2)
def _tokenizer(spec: str) -> Tokenizer:
    return Tokenizer.from_str(spec)


class WordIds(dict):
    """Remembered ids, as little-endian bytes, of the parts of texts.

    The tokenizer cuts a text before every single space or line feed between
    visible characters, whatever stands around it, so what lies between two such
    cuts can be encoded on its own.  A key without white space stands for that
    word after a space, a key that starts with a line feed for that line start.

    A text is first cut at the strings of added tokens, which have an id of
    their own and part what stands around them.
    """

    def __init__(self, tokenizer: Tokenizer, words: int = CACHE_WORDS):
        self.tokenizer, self.words = tokenizer, words
        vocabulary = tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of each token, one per character of its name
        self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
        added = sorted(tokenizer.get_added_tokens_decoder().values(), key=lambda t: -len(t.content))
        self.added = re.compile(f"({'|'.join(re.escape(t.content) for t in added)})") if added else None
        # else the string alone does not say what the token takes
        self.plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added)

    def _encode(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.asarray(found.ids, "<u4")

    def ids(self, text: str) -> bytes:
        """The ids of a whole text."""
        return next(self.batch([text]))

    def batch(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text; words are learned for about ``SLICE`` characters of texts at once."""
        held: list[str] = []
        size = 0
        for t in texts:
            held.append(t or "")
            size += len(t or "")
            if size >= SLICE:
                yield from self._slice(held)
                held, size = [], 0
        yield from self._slice(held)

    def _slice(self, texts: list[str]) -> Iterator[bytes]:
        """Each distinct word is looked up once; Arrow puts its ids at all of its places."""
        whole = [self.added is None or not self.added.search(t) for t in texts]
        # A line feed before a text makes its first word a line start like all others.
        lines = [f"\n{t}".replace("\n", " \n")[1:] for t, w in zip(texts, whole) if w]
        split = pc.split_pattern(pa.array(lines, pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        words, index = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        new = set(words).difference(self)
        if len(self) + len(new) > self.words:  # forget the words that these texts lack
            kept = {w: self[w] for w in words if w not in new}
            self.clear()
            self.update(kept)
        # somewhere white space is not one space or line feed between words
        odd = {p for p in new if p.split() != [p.removeprefix("\n")]}
        self._learn(new - odd)
        found = [b"" if w in odd else self[w] for w in words]
        data = pa.array(found, pa.large_binary()).take(coded.indices).buffers()[2] or pa.py_buffer(b"")
        place = split.offsets.to_numpy()
        ends = np.append(0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found))[index]))[place].tolist()
        odds = np.append(0, np.cumsum(np.asarray([w in odd for w in words], bool)[index]))[place].tolist()
        k = 0
        for t, w in zip(texts, whole):
            if not w:
                yield self._with_added(t)
                continue
            yield self._cut(t) if odds[k] < odds[k + 1] else data[ends[k] + 4:ends[k + 1]].to_pybytes()
            k += 1

    def _with_added(self, text: str) -> bytes:
        if not self.plain:
            return self._encode(text).tobytes()
        cut = self.added.split(text)
        return b"".join([self._encode(p).tobytes() if k % 2 else self._cut(p) for k, p in enumerate(cut) if p])

    def _cut(self, text: str) -> bytes:
        """The ids of a text with any white space and without added tokens."""
        cut = parts_of(text)
        self._learn({p[1:] for p in cut if is_word(p)} - self.keys())
        return b"".join([self[p[1:]] if is_word(p) else self._encode(p).tobytes() for p in cut])

    def _learn(self, new: set[str]) -> None:
        """Encode words in a row; the bytes that their tokens stand for say where each word ends."""
        words = list(new)
        for at in range(0, len(words), JOINED):
            part = words[at:at + JOINED]
            spelled = [w if w[0] == "\n" else " " + w for w in part]
            ids = self._encode("".join(spelled))
            ends, upto = np.cumsum([len(w.encode()) for w in spelled]), np.cumsum(self.sizes[ids])
            if not np.isin(ends, upto).all() or upto[-1] != ends[-1]:  # a token reaches over two words
                self.update((word, self._encode(w).tobytes()) for word, w in zip(part, spelled))
                continue
            raw, start = ids.tobytes(), 0
            for word, end in zip(part, ((np.searchsorted(upto, ends) + 1) * 4).tolist()):
                self[word] = raw[start:end]
                start = end


@functools.lru_cache(maxsize=1)
def _memory(spec: str, words: int) -> WordIds:
    """One memory for all tasks of a Python worker."""
    return WordIds(_tokenizer(spec), words)


def is_word(part: str) -> bool:
    """Whether ``part`` is one space and visible characters."""
    return part[:1] == " " and part.split() == [part[1:]]


def parts_of(text: str) -> list[str]:
    """Cut any text into parts that are encoded alike alone and in place."""
    out, held = [], None
    for i, w in enumerate(text.split(" ")):
        piece = w if i == 0 else " " + w
        if held is None:
            held = piece
        elif w and held and not held[-1].isspace() and not w[0].isspace():
            # a space next to white space stays with what stands before it
            out.append(held)
            held = piece
        else:
            held += piece
    out.append(held or "")
    return out


# ---------------------------------------------------------------- patterns


@dataclass
class Bins:
    """``times`` equal sequences: the lengths in them, in order."""

    lengths: tuple[int, ...]
    times: int

    @property
    def space(self) -> int:
        return CAPACITY - sum(self.lengths)


def _price(r: np.ndarray, capacity: int) -> set[tuple[int, ...]]:
    """For each length the pair, triple and quadruple that fill a sequence and fit ``r`` best."""
    out = set()
    n = capacity
    lengths = np.arange(n + 1)
    gain = np.where((lengths > 0) & (lengths < n), r, -np.inf)
    # two[s]: best gain of a pair of sum s, and its first length
    shift = lengths[:, None] - lengths[None, :]
    pairs = gain[None, :] + np.where(shift > 0, gain[np.clip(shift, 0, n)], -np.inf)
    first = pairs.argmax(1)
    two = pairs[lengths, first]
    for a in range(1, n):
        out.add(tuple(sorted((a, n - a))))
        s = n - a
        if np.isfinite(two[s]):
            b = int(first[s])
            out.add(tuple(sorted((a, b, s - b))))
    four = two[1:n] + two[n - 1:0:-1]
    for s in np.argsort(-np.where(np.isfinite(four), four, -np.inf))[:n // 2] + 1:
        if np.isfinite(two[s]) and np.isfinite(two[n - s]):
            b, c = int(first[s]), int(first[n - s])
            out.add(tuple(sorted((b, int(s) - b, c, int(n - s) - c))))
    return out


def fit_patterns(histogram: np.ndarray) -> dict[tuple[int, ...], float]:
    """Repeat counts ``x >= 0`` of patterns that minimise ``|A x - histogram|``.

    Patterns of two to four lengths that fill a sequence are enumerated by what
    the residual still asks for; coordinate descent then fits all of them.
    """
    n = len(histogram) - 1
    r = histogram.astype(float).copy()
    r[0] = r[n] = 0
    present = set(np.flatnonzero(r > 0).tolist())
    x: dict[tuple[int, ...], float] = {}
    for _ in range(ROUNDS):
        for p in _price(r, n):
            if present.issuperset(p):
                x.setdefault(p, 0.0)
        cols = []
        for p in x:
            at, times = np.unique(p, return_counts=True)
            cols.append((p, at.tolist(), times.tolist(), float((times * times).sum())))
        rest = r.tolist()
        for _ in range(SWEEPS):
            moved = 0.0
            for p, at, times, norm in cols:
                old = x[p]
                new = old + sum(k * rest[a] for a, k in zip(at, times)) / norm
                if new < 0:
                    new = 0.0
                if new != old:
                    x[p] = new
                    d = new - old
                    moved += abs(d)
                    for a, k in zip(at, times):
                        rest[a] -= k * d
            if moved < 0.5:
                break
        r = np.array(rest)
    return {p: v for p, v in x.items() if v > 0}


def pack_residual(left: dict[int, int], bins: list[Bins], capacity: int = CAPACITY) -> list[Bins]:
    """Best fit, longest first, on counts: work follows the number of lengths, not of documents."""
    open_: dict[int, list[Bins]] = defaultdict(list)
    done = list(bins)

    def put(lengths: tuple[int, ...], times: int) -> None:
        space = capacity - sum(lengths)
        (open_[space] if space else done).append(Bins(lengths, times)) if times else None

    for length in sorted(left, reverse=True):
        m = left[length]
        for space in sorted(s for s in open_ if s >= length):
            per = space // length
            groups, open_[space] = open_[space], []
            for g in groups:
                full = min(g.times, m // per)
                put(g.lengths + (length,) * per, full)
                m -= full * per
                if m and full < g.times:  # fewer than per are left: one sequence takes them
                    put(g.lengths + (length,) * m, 1)
                    full, m = full + 1, 0
                if full < g.times:
                    open_[space].append(Bins(g.lengths, g.times - full))
        per = capacity // length
        put((length,) * per, m // per)
        put((length,) * (m % per), 1 if m % per else 0)
    return done + [b for groups in open_.values() for b in groups]


def plan(histogram: np.ndarray) -> list[Bins]:
    """Sequences that hold every length of the histogram, as groups of equal ones.

    The fitted counts are rounded to the nearest number, down, or to none, so
    that all is packed by best fit without patterns; the rest is packed as
    residual and the fewest sequences win, at any size.
    """
    capacity = len(histogram) - 1
    fitted = sorted(fit_patterns(histogram).items(), key=lambda kv: (-kv[1], kv[0]))
    plans = [_rounded(histogram, fitted, shift, capacity) for shift in (0.5, 0.0, -np.inf)]
    return min(plans, key=lambda bins: sum(b.times for b in bins))


def _rounded(histogram: np.ndarray, fitted: list, shift: float, capacity: int) -> list[Bins]:
    left = {n: int(c) for n, c in enumerate(histogram) if c and n}
    bins = [Bins((capacity,), left.pop(capacity))] if left.get(capacity) else []
    for p, v in fitted if shift >= 0 else ():
        need = {a: p.count(a) for a in p}
        times = min([int(v + shift), *(left.get(a, 0) // k for a, k in need.items())])
        if times > 0:
            bins.append(Bins(tuple(sorted(p, reverse=True)), times))
            for a, k in need.items():
                left[a] -= k * times
    return pack_residual({n: c for n, c in left.items() if c}, bins, capacity)


def places(bins: list[Bins]) -> list[tuple[int, int, int, int, int]]:
    """``length, first rank, end rank, first sequence, offset``: where each rank of a length goes."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for b in bins:
        offset = 0
        for length in b.lengths:
            rows.append((length, taken[length], taken[length] + b.times, sequence, offset))
            taken[length] += b.times
            offset += length
        sequence += b.times
    return rows


# ---------------------------------------------------------------- Spark


_PIECES = "id string, piece int, start long, length long, ids_crc32 long, part int, rank long"


def pieces_of_docs(docs: DataFrame, tokenizer: str, key: str, text: str, capacity: int, words: int = CACHE_WORDS) -> DataFrame:
    """Every document's pieces, each with its rank among its task's pieces of that length."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # of fixed size
    end = np.asarray([END], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, part, ranks = _memory(spec.value, words), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for key_, raw in zip(batch["_id"], ids.batch(batch["_text"].tolist())):
                raw += end
                n, start, piece = len(raw) // 4, 0, 0
                size = n % capacity or capacity
                while start < n:
                    row = (key_, piece, start, size, zlib.crc32(raw[4 * start:4 * (start + size)]), part, ranks[size])
                    for column, value in zip(columns, row):
                        column.append(value)
                    ranks[size] += 1
                    start, piece, size = start + size, piece + 1, capacity
            yield pd.DataFrame(dict(zip(("_id", "piece", "start", "length", "ids_crc32", "part", "rank"), columns)))

    kind = docs.schema[key].dataType.simpleString()
    schema = _PIECES.replace("id string", f"_id {kind}", 1)
    return docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).mapInPandas(cut, schema)


def pack_documents(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
                   capacity: int = CAPACITY, words: int = CACHE_WORDS) -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset``: one row per piece.

    A document's ids are those that the tokenizer gives its text, added tokens
    included, and an end id; null and empty texts have the end id alone.
    Longer documents are cut into pieces of ``capacity``, the first one shorter.
    Rows with null or repeated keys are documents of their own; an empty table
    gives an empty result.

    The driver sees the histogram of lengths, at most ``capacity`` numbers, and
    fits patterns to it.  Each piece finds its place by its rank within its
    length: its rank in its task, stored with the pieces, plus the counts of
    earlier tasks.  No length is gathered, however many documents have it.
    A worker remembers the ids of about ``words`` words: fewer of them take
    less memory and more time.
    """
    spark = docs.sparkSession
    stored = materialise(pieces_of_docs(docs, tokenizer, key, text, capacity, words), "pieces")
    by_task = stored.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in by_task.groupBy("length").agg(F.sum("n")).collect():
        histogram[length] = n
    names = ("length", "first", "end", "base", "offset")
    table = small_table(spark, places(plan(histogram)), pa.schema([(n, pa.int64()) for n in names]))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    ranked = stored.join(before, ["part", "length"]).withColumn("place", F.col("rank") + F.col("before"))
    found = ranked.join(F.broadcast(table), "length").where("place >= first and place < end")
    return found.select(
        F.col("_id").alias(key), "piece", "start", "length", "ids_crc32",
        (F.col("base") + F.col("place") - F.col("first")).alias("sequence_id"), "offset")
