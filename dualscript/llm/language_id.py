"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualscript.llm.common import pack, small_table, unpack

BUCKETS = 4096
DIM = 16
PER_LANG = 400  # labelled documents to learn from, per language, about; the bound of the sample
SNIPPET_WORDS = (3, 12)  # each of them also gives snippets of so many words, for short texts
EPOCHS = 30
CHUNK = 1 << 20  # code points held as arrays at once
UNDECIDED = "und"
MISS = 0.001  # share of rightly named documents that the rejection may cost
UNTESTED = 0.5  # the highest threshold where no document is held out to calibrate it


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def subword_counts(text: str) -> tuple[np.ndarray, bool]:
    """Counts of hashed 2- and 3-grams over words in lower case, and whether there is a letter.

    The whole text is read, in pieces of bounded size that overlap by two.
    """
    counts, any_letter, is_letter = np.zeros(BUCKETS), False, _letters()
    for start in range(0, len(text), CHUNK):
        piece = f" {text[max(0, start - 2):start + CHUNK]} ".lower()
        cp = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4")
        known = is_letter[cp]
        any_letter = any_letter or bool(known.any())
        c = np.where(known, cp, 32).astype(np.uint32)
        two = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] ^ (c[2:] * np.uint32(0xC2B2AE3D) + np.uint32(0x27D4EB2F))
        for h, used in ((two, known[:-1] | known[1:]), (three, known[1:-1])):
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            counts += np.bincount((h[used] >> np.uint32(20)).astype(np.intp), minlength=BUCKETS)
    return counts, any_letter


def _snippets(text: str, seed: int) -> Iterator[str]:
    words = text.split()
    for k, n in enumerate(SNIPPET_WORDS):
        if len(words) > n:
            at = (seed * 2654435761 + k * 40503) % (len(words) - n)
            yield " ".join(words[at:at + n])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass(frozen=True)
class LanguageModel:
    """``table`` holds each bucket's embedding times the output weights."""

    langs: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, counts: np.ndarray) -> np.ndarray:
        total = counts.sum()
        z = (counts @ self.table) / total + self.bias if total else self.bias
        return softmax(z / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not text:
            return UNDECIDED, 0.0, True
        counts, any_letter = subword_counts(text)
        if not any_letter or not self.langs:
            return UNDECIDED, 0.0, True
        p = self.scores(counts)
        best = int(p.argmax())
        return self.langs[best], float(p[best]), bool(p[best] < self.threshold)


def averages(at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An example's buckets and their shares of its counts ``n``."""
    whole = np.zeros(BUCKETS, np.float32)
    whole[at] = n
    return at, n / whole.sum()


def dense(examples: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    x = np.zeros((len(examples), BUCKETS), np.float32)
    for r, (at, share) in enumerate(examples):
        x[r, at] = share
    return x


def fit(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_langs: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings times output weights, and the bias, by stochastic gradient descent.

    ``x`` holds the buckets of each example and their shares; only a step's examples are spelled out.
    """
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    w, b = np.zeros((DIM, n_langs), np.float32), np.zeros(n_langs, np.float32)
    w += rng.normal(0, 0.1, w.shape)
    size, steps, step = 32, EPOCHS * max(1, len(y) // 32), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), size):
            rows = order[at:at + size]
            rate = 1.0 * max(0.05, 1 - step / steps)
            step += 1
            xb = dense([x[r] for r in rows])
            hidden = xb @ e
            grad = softmax(hidden @ w + b)
            grad[np.arange(len(rows)), y[rows]] -= 1
            grad /= len(rows)
            back = grad @ w.T
            w -= rate * hidden.T @ grad
            b -= rate * 0.1 * grad.sum(0)
            used = np.flatnonzero(xb.any(axis=0))
            # a bucket's share of an average is small: its rate is raised by the same order
            e[used] -= rate * 50 * xb[:, used].T @ back
    return e @ w, b


def calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The temperature of least log loss, and a threshold that costs few right answers.

    At most the share ``MISS`` of the right answers is below the threshold; with
    none to tell, the threshold is hardly better than a guess, and below 1.
    """
    def loss(t: float) -> float:
        return -np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean()

    temperature = min(np.geomspace(0.05, 20, 60), key=loss) if len(y) else 1.0
    p = softmax(z / temperature)
    right = p.max(1)[p.argmax(1) == y] if len(y) else np.zeros(0)
    threshold = np.quantile(right, MISS, method="lower") if len(right) else min(UNTESTED, 1.5 / z.shape[1])
    return float(temperature), float(threshold)


def slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << 30))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          per_lang: int = PER_LANG) -> LanguageModel:
    """Learn from about ``per_lang`` documents of each non-null language, picked by a hash.

    Only counts of hashed subwords reach the driver, at most ``BUCKETS`` numbers
    an example.  Null keys, texts and languages are not learned from.
    """
    spark = docs.sparkSession
    usable = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"), F.col(lang).alias("_lang")).where(
        "_id is not null and _lang is not null and _text is not null")
    totals = {r["_lang"]: r["count"] for r in usable.groupBy("_lang").count().collect()}
    if not totals:
        return LanguageModel((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    langs = tuple(sorted(totals))
    shares = [(lang_, int(min(1.0, per_lang / n) * (1 << 30))) for lang_, n in totals.items()]
    limits = small_table(spark, shares, pa.schema([("_lang", pa.string()), ("_limit", pa.int64())]))
    sample = usable.join(F.broadcast(limits), "_lang").where(slot(F.col("_id")) < F.col("_limit")).limit(
        2 * per_lang * len(langs))

    def examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, t, name in zip(batch["_id"], batch["_text"], batch["_lang"]):
                seed = abs(hash(int(i))) if isinstance(i, (int, np.integer)) else len(t)
                for part in (t, *_snippets(t, seed)):
                    counts, any_letter = subword_counts(part)
                    if any_letter:
                        at = np.flatnonzero(counts)
                        rows.append((str(i), name, at.astype(np.int32), counts[at].astype(np.float32)))
            yield pd.DataFrame(rows, columns=["id", "lang", "at", "n"])

    got = sample.mapInPandas(examples, "id string, lang string, at array<int>, n array<float>").toArrow()
    if not got.num_rows:
        return LanguageModel((), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    # the numbers stay in Arrow's arrays: as Python objects they are some hundred MB
    at, n = ([a.values.to_numpy() for a in got[c].combine_chunks()] for c in ("at", "n"))
    ids, names = got["id"].to_pylist(), got["lang"].to_pylist()
    order = pd.DataFrame({"key": [(i, name, len(a)) for i, name, a in zip(ids, names, at)]}).sort_values("key").index
    x = [averages(at[r], n[r]) for r in order]
    y = np.array([langs.index(names[r]) for r in order])
    # a document's snippets stay on its side
    held = np.array([sum(map(ord, ids[r])) % 4 == 0 for r in order])
    held &= len(y) >= 40
    table, bias = fit([e for e, h in zip(x, held) if not h], y[~held], len(langs))
    temperature, threshold = calibrate(dense([e for e, h in zip(x, held) if h]) @ table + bias, y[held])
    return LanguageModel(langs, table.astype(float), bias.astype(float), temperature, threshold)


def predictor(docs: DataFrame, model: LanguageModel):
    """A column function of the text: ``lang_pred, score, rejected``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(map(shared.value.predict, texts), columns=["lang_pred", "score", "rejected"])

    # else the optimiser copies the call into pushed-down filters
    return predict.asNondeterministic()


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_id, _text, _rest, lang_pred, score, rejected`` for every row of ``docs``.

    The whole text is read and nothing else.  A null text, or one without a
    letter, gets ``und``, score 0 and is rejected; keys may be null or repeat;
    an empty table gives an empty result.
    """
    packed = pack(docs, key, text)
    return packed.withColumn("_p", predictor(docs, model)("_text")).select("_id", "_text", "_rest", "_p.*")


def keep_known(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language the model does not reject, unchanged."""
    return unpack(identify(docs, model, key, text).where("not rejected"), docs, key, text)


def held_out(key: Column) -> Column:
    """Rows never to learn from: a third by CRC-32 of the key as text, and null keys."""
    return F.coalesce(F.crc32(key.cast("string")) % 3, F.lit(1)) == 1
