"""Quality rules: a decision list learned by sequential covering, emitted as Spark conditions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualscript.llm.common import WHITE, WHITE_RUN, let, pack, unpack
from dualscript.operators.staging import compute_once

# --- fixed values: the base rules ---
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT = 50  # per cent of words
# --- end of fixed values ---

SAMPLE_ROWS = 6_000  # labelled rows to learn from, about; the bound of what reaches the driver
MIN_PRECISION = 0.97  # a rule that rejects must be right this often on all labelled rows
MIN_COVER = 5  # and hold for so many of them
CUTS = 48  # thresholds tried for each statistic

#: Statistics a rule may test: ratios, so that a rule means the same at any length.
STATISTICS = ("symbol_share", "dup_line_share", "repeat_share", "mean_word", "upper_share",
              "exclaim_share", "words_per_line", "n_words")


def _words(text: Column) -> Column:
    return F.split(F.btrim(text, F.lit(WHITE)), WHITE_RUN, -1)


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows are compared by a 64-bit hash within one text.  Only texts with an
    equal pair are sorted; the sorted starts then cover up to three words each.
    """
    def keys_of(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                           lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def twice(keys: Column) -> Column:
        ordered = F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        def same(s, x, j):
            return F.coalesce(F.get(s, j)["k"] == x["k"], F.lit(False))
        starts = let(ordered, lambda s: F.array_sort(F.transform(
            F.filter(s, lambda x, j: same(s, x, j + 1) | ((j > 0) & same(s, x, F.greatest(j - 1, F.lit(0))))),
            lambda x: x["i"])))
        zero = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(starts, zero, lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")), lambda acc: acc["n"])

    keys = let(words, keys_of)
    counted = let(keys, lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), 0).otherwise(twice(k)))
    return F.when(F.size(words) < 4, 0).otherwise(counted)


def statistics(packed: DataFrame, text: str = "_text") -> DataFrame:
    """Add the base counts and the ratios; all are native and computed once.

    A null or empty text has no words and no lines with a word: every count is 0.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    bare = F.translate(raw, WHITE, "")
    full = F.filter(F.split(raw, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    counts = compute_once(packed, _w=F.when(bare == "", F.array().cast("array<string>")).otherwise(_words(raw)),
                          _lines=full)
    counts = compute_once(
        counts,
        n_words=F.size("_w").cast("long"),
        word_chars=F.char_length(bare).cast("long"),
        n_symbols=(F.char_length(raw) - F.char_length(F.translate(raw, SYMBOLS, ""))).cast("long"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        n_repeat_words=_repeat_words(F.col("_w")).cast("long"),
        _n_lines=F.size("_lines").cast("long"),
        _upper=(F.char_length(raw) - F.char_length(F.regexp_replace(raw, "\\p{Lu}+", ""))).cast("long"),
        _exclaim=(F.char_length(raw) - F.char_length(F.replace(raw, F.lit("!"), F.lit("")))).cast("long"),
    ).drop("_w", "_lines")
    def share(a, b):
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return counts.select(
        *[c for c in packed.columns], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))).alias("base_failed"),
        share("n_symbols", "word_chars").alias("symbol_share"), share("n_dup_lines", "_n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"), share("word_chars", "n_words").alias("mean_word"),
        share("_upper", "word_chars").alias("upper_share"), share("_exclaim", "word_chars").alias("exclaim_share"),
        share("n_words", "_n_lines").alias("words_per_line"),
    )


@dataclass(frozen=True)
class Test:
    name: str
    at_least: bool
    cut: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.name] >= self.cut if self.at_least else x[self.name] < self.cut

    def column(self) -> Column:
        return F.col(self.name) >= F.lit(self.cut) if self.at_least else F.col(self.name) < F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.at_least else '<'} {self.cut:g}"


def _covered(rule: list[Test], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for test in rule:
        out &= test.holds(x)
    return out


def _take(x: dict[str, np.ndarray], rows: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[rows] for k, v in x.items()}


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, cuts: dict[str, np.ndarray]) -> list[Test]:
    """Add the test of the largest information gain until the rule covers bad rows only."""
    rule: list[Test] = []
    inside = np.ones(len(bad), bool)
    while True:
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        if not n0 or not p0:
            return rule
        base, best = np.log2(p0 / (p0 + n0)), (1e-9, None)
        for name, values in cuts.items():
            for cut in values:
                for at_least in (True, False):
                    test = Test(name, at_least, float(cut))
                    hit = inside & test.holds(x)
                    p, n = (hit & bad).sum(), (hit & ~bad).sum()
                    if p and (gain := p * (np.log2(p / (p + n)) - base)) > best[0]:
                        best = (gain, test)
        if best[1] is None:
            return rule
        rule.append(best[1])
        inside &= best[1].holds(x)


def _prune(rule: list[Test], x: dict[str, np.ndarray], bad: np.ndarray) -> list[Test]:
    """Drop tests from the end while the rule is no worse on rows it was not grown on."""
    def worth(r: list[Test]) -> float:
        hit = _covered(r, x, len(bad))
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    ends = [rule[:k] for k in range(1, len(rule) + 1)]
    return max(reversed(ends), key=worth) if ends else rule


def cover(x: dict[str, np.ndarray], bad: np.ndarray, seed: int = 0) -> list[list[Test]]:
    """Rules that reject, in order: grow on two thirds, prune on a third, remove, repeat.

    A rule that is not ``MIN_PRECISION`` right on what it covers of all labelled
    rows ends the list, so clean documents stay.
    """
    rules, left = [], np.arange(len(bad))
    rng = np.random.default_rng(seed)
    while bad[left].sum() >= MIN_COVER:
        part = rng.random(len(left)) < 2 / 3
        grow, prune = left[part], left[~part]
        # between neighbouring values, so that no learned row lies on a threshold
        cuts = {}
        for k, v in x.items():
            q = np.unique(np.quantile(v[left], np.linspace(0, 1, CUTS)))
            q = np.union1d(q, np.unique(np.quantile(v[left][bad[left]], np.linspace(0, 1, CUTS // 2))))
            cuts[k] = (q[1:] + q[:-1]) / 2
        rule = _prune(_grow(_take(x, grow), bad[grow], cuts), _take(x, prune), bad[prune])
        hit = _covered(rule, x, len(bad)) if rule else np.zeros(len(bad), bool)
        fresh = hit[left]
        p, every = (bad[left] & fresh).sum(), hit.sum()
        if not rule or p < MIN_COVER or (bad & hit).sum() < MIN_PRECISION * every:
            break
        rules.append(rule)
        left = left[~fresh]
    return rules


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> list[list[Test]]:
    """Learn from about ``sample_rows`` labelled documents, picked by a hash of the key.

    The label is 0 for documents to reject; null labels and keys are left out.
    Keys and labels of the sample reach the driver, their texts do not.
    """
    spark = docs.sparkSession
    usable = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("_id"), (F.col(label) == 0).alias("_bad"))
    total = usable.count()
    if not total:
        return []
    share = min(1.0, sample_rows / total)
    slot = F.pmod(F.xxhash64("_id"), F.lit(1 << 30))
    # about sample_rows rows, and never more than twice as many
    picked = usable.where(slot < int(share * (1 << 30))).limit(2 * sample_rows).toArrow()
    if not picked.num_rows:
        return []
    sample = spark.createDataFrame(picked).groupBy("_id").agg(
        F.bool_or("_bad").alias("_bad"))
    rows = statistics(pack(docs, key, text).drop("_rest").join(F.broadcast(sample), "_id")).where(
        "not base_failed").select("_bad", *STATISTICS).limit(4 * sample_rows).toPandas()
    rows = rows.sort_values(list(rows.columns)).reset_index(drop=True)
    return cover({k: rows[k].to_numpy(float) for k in STATISTICS}, rows["_bad"].to_numpy(bool))


def verdict(rules: list[list[Test]]) -> Column:
    """The decision list as one ordered condition: the first rule that holds rejects."""
    out = None
    for rule in rules:
        held = rule[0].column()
        for test in rule[1:]:
            held = held & test.column()
        out = F.when(held, False) if out is None else out.when(held, False)
    return F.lit(True) if out is None else out.otherwise(True)


def judge(docs: DataFrame, rules: list[list[Test]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_id, _text, _rest``, the statistics, ``base_failed`` and ``kept`` for every row.

    Null and empty texts have no words and fail the base rules.  Keys are not
    used, so null and repeated keys are judged like any other row; an empty
    table gives an empty result.
    """
    return statistics(pack(docs, key, text)).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the base rules and the learned list keep, unchanged."""
    judged = compute_once(judge(docs, learn(docs, labels, key, text), key, text), _kept=F.col("kept"))
    return unpack(judged.where("_kept"), docs, key, text)
