"""Stage 5: predictions -> corpus BLEU and ROUGE."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualscript.functions import arrays as A
from dualscript.functions import text as T
from dualscript.functions.similarity import rouge_lcs
from dualscript.functions.tokenize13a import tokens_13a
from dualscript.operators import vocabulary as V
from dualscript.operators.staging import compute_once
from dualscript.sources.pair_csv import union_all

MAX_ORDER = 4  # fixed value: longest n-gram of BLEU
BLEU = ("bleu", "brevity_penalty", "length_ratio", "translation_length", "reference_length")
ROUGE = ("rouge1", "rouge2", "rougeL", "rougeLsum")

Tokenizer = Callable[[Column], Column]


def pair_up(predictions: DataFrame, references: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, pred, ref`` matched by key."""
    return predictions.select(*keys, "pred").join(references.select(*keys, "ref"), keys)


def decode_predictions(
    df: DataFrame, key: str, vocab: DataFrame, pred_ids: str = "pred_ids", label_ids: str = "label_ids"
) -> DataFrame:
    """Masked id arrays -> ``key, pred, ref`` texts."""
    filled = df.select(key, *[A.fill_mask(F.col(ids), V.PAD).alias(name) for ids, name in ((pred_ids, "pred"), (label_ids, "ref"))])
    return V.decode_lists(filled, key, {"pred": "pred", "ref": "ref"}, vocab)


@dataclass(frozen=True)
class Grams:
    """One tokenisation and the n-grams counted over it."""

    kind: str
    tokenizer: Tokenizer
    orders: int


def _gram_counts(df: DataFrame, keys: list[str], wanted: list[Grams], **per_row: Column) -> DataFrame:
    """``keys, kind, order, gram, p, r`` and ``per_row``: n-gram counts per row in prediction and reference.

    Rows are spread by key while they are still short texts, once for all
    tokenisations.  The n-grams, many times larger, are then exploded and
    counted where they are.  The partition count is fixed because adaptive
    merging would go by the size of the texts.  A row of order 0 keeps texts
    without tokens in the result, counts the rows of a key and carries the
    ``per_row`` values; other rows hold NULL there.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # before the spread: a Python function behind it would hide how rows lie
    texts = df.select(*keys, *[F.coalesce(c, F.lit("")).alias(c) for c in ("pred", "ref")], *[v.alias(f"row_{n}") for n, v in per_row.items()])
    spread = texts.repartition(parts, *keys).select(
        *keys, *[g.tokenizer(F.col(c)).alias(f"{c}_{g.kind}_1") for g in wanted for c in ("pred", "ref")], *[f"row_{n}" for n in per_row])
    entries = [(F.lit(""), F.lit(0), F.lit(True), F.array(F.lit("")))]
    for g in wanted:
        for side in ("pred", "ref"):
            first = f"{side}_{g.kind}_1"
            for n in range(2, g.orders + 1):
                shorter = F.col(f"{side}_{g.kind}_{n - 1}")
                spread = spread.withColumn(f"{side}_{g.kind}_{n}", A.longer_grams(shorter, F.col(first), n))
            entries += [(F.lit(g.kind), F.lit(n), F.lit(side == "pred"), F.col(f"{side}_{g.kind}_{n}")) for n in range(1, g.orders + 1)]
    lists = spread.select(
        *keys, *[f"row_{n}" for n in per_row],
        F.stack(F.lit(len(entries)), *[c for entry in entries for c in entry]).alias("kind", "order", "is_pred", "grams"))
    only_first = [F.when(F.col("order") == 0, F.col(f"row_{n}")).alias(f"row_{n}") for n in per_row]
    return (
        lists.select(*keys, "kind", "order", "is_pred", *only_first, F.explode("grams").alias("gram"))
        .groupBy(*keys, "kind", "order", "gram")
        .agg(F.count_if("is_pred").alias("p"), F.count_if(~F.col("is_pred")).alias("r"),
             *[F.max(f"row_{n}").alias(n) for n in per_row])
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _bleu_sums() -> list[Column]:
    """What BLEU needs of the counts of kind ``bleu``: matches and candidates per order, and the reference length."""
    def order_sum(n: int, what: Column) -> Column:
        return F.coalesce(F.sum(F.when((F.col("kind") == "bleu") & (F.col("order") == n), what)), F.lit(0))

    orders = range(1, MAX_ORDER + 1)
    return [*[order_sum(n, F.least("p", "r")).alias(f"match{n}") for n in orders],
            *[order_sum(n, F.col("p")).alias("translation_length" if n == 1 else f"all{n}") for n in orders],
            order_sum(1, F.col("r")).alias("reference_length")]


def _bleu_of(sums: DataFrame) -> DataFrame:
    """``sums`` with ``bleu`` and its parts, without smoothing."""
    candidates = ["translation_length", *[f"all{n}" for n in range(2, MAX_ORDER + 1)]]
    precisions = [
        _ratio(F.col(f"match{n}"), F.col(a)) for n, a in enumerate(candidates, start=1)
    ]
    log_mean = sum((F.log(p) for p in precisions), F.lit(0.0)) / MAX_ORDER
    geo_mean = F.when(F.least(*precisions) > 0, F.exp(log_mean)).otherwise(0.0)
    length_ratio = F.try_divide(F.col("translation_length"), F.col("reference_length"))
    penalty = F.when(F.col("length_ratio") > 1.0, 1.0).when(
        F.col("length_ratio") > 0, F.exp(1.0 - 1.0 / F.col("length_ratio"))
    ).otherwise(0.0)
    return (
        sums.withColumn("length_ratio", length_ratio)
        .withColumn("brevity_penalty", penalty)
        .withColumn("bleu", geo_mean * F.col("brevity_penalty"))
    )


def corpus_bleu(df: DataFrame, keys: list[str], tokenizer: Tokenizer = tokens_13a) -> DataFrame:
    """One row: ``bleu`` and its parts, without smoothing."""
    counts = _gram_counts(df, keys, [Grams("bleu", tokenizer, MAX_ORDER)])
    return _bleu_of(counts.agg(*_bleu_sums())).select(*BLEU)


def _f1(n: int) -> Column:
    here = (F.col("kind") == "rouge") & (F.col("order") == n)
    common = F.sum(F.when(here, F.least("p", "r")))
    both = F.sum(F.when(here, F.col("p") + F.col("r")))
    return F.coalesce(2.0 * common / both, F.lit(0.0)).alias(f"rouge{n}")


def rouge_n_rows(df: DataFrame, keys: list[str], tokenizer: Tokenizer = T.tokens) -> DataFrame:
    """``keys, rouge1, rouge2``: n-gram F1 of every row."""
    return _gram_counts(df, keys, [Grams("rouge", tokenizer, 2)]).groupBy(*keys).agg(_f1(1), _f1(2))


def rouge_n(df: DataFrame, keys: list[str], tokenizer: Tokenizer = T.tokens) -> DataFrame:
    return rouge_n_rows(df, keys, tokenizer).agg(
        F.avg("rouge1").alias("rouge1"), F.avg("rouge2").alias("rouge2")
    )


def _lcs_scores(tokenizer: Tokenizer) -> Column:
    """``rougeL, rougeLsum`` of ``pred`` and ``ref``; the latter goes line by line where a text has several."""
    def line_tokens(c: str) -> Column:
        lines = F.filter(F.split(c, "\n"), lambda line: line != "")
        return F.when(F.contains(F.col("pred"), F.lit("\n")) | F.contains(F.col("ref"), F.lit("\n")), F.transform(lines, tokenizer))

    return rouge_lcs(*[tokenizer(F.col(c)) for c in ("pred", "ref")], *[line_tokens(c) for c in ("pred", "ref")])


def rouge_l_rows(df: DataFrame, keys: list[str], tokenizer: Tokenizer = T.tokens) -> DataFrame:
    """``keys, rougeL, rougeLsum``: LCS F1 of every row, whole and by lines; no shuffle.

    ``rougeLsum`` takes, per line of the reference, the places that a longest
    common subsequence with any line of the prediction matches, and counts a
    token at most as often as either text holds it.
    """
    texts = df.select(*keys, *[F.coalesce(c, F.lit("")).alias(c) for c in ("pred", "ref")])
    return compute_once(texts, lcs=_lcs_scores(tokenizer)).select(*keys, "lcs.rougeL", "lcs.rougeLsum")


def rouge_l_mean(df: DataFrame, keys: list[str], tokenizer: Tokenizer = T.tokens) -> DataFrame:
    """Means of ``rougeL`` and ``rougeLsum``."""
    return rouge_l_rows(df, keys, tokenizer).agg(*[F.avg(c).alias(c) for c in ("rougeL", "rougeLsum")])


def merge_metrics(*metrics: DataFrame) -> DataFrame:
    """One-row metric frames side by side, as one row."""
    long = union_all([
        m.select(
            F.inline(
                F.array(*[
                    F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                    for c in m.columns
                ])
            )
        )
        for m in metrics
    ])
    names = [c for m in metrics for c in m.columns]
    return long.agg(*[F.max(F.when(F.col("metric") == c, F.col("value"))).alias(c) for c in names])


def evaluate(
    df: DataFrame, keys: list[str], tokenizer: Tokenizer = T.tokens, bleu_tokenizer: Tokenizer = tokens_13a,
) -> DataFrame:
    """All metrics of ``pred`` against ``ref`` plus the number of rows, all DOUBLE.

    One scan and one shuffle of the texts serve both tokenisations, the common
    subsequences and the row count.
    """
    texts = df.select(*keys, *[F.coalesce(c, F.lit("")).alias(c) for c in ("pred", "ref")])
    texts, lcs = compute_once(texts, _lcs=_lcs_scores(tokenizer)), F.col("_lcs")
    counts = _gram_counts(texts, keys, [Grams("bleu", bleu_tokenizer, MAX_ORDER), Grams("rouge", tokenizer, 2)],
                          rougeL=lcs["rougeL"], rougeLsum=lcs["rougeLsum"])
    sums = _bleu_sums()
    names = ["match1", "match2", "match3", "match4", "translation_length", "all2", "all3", "all4", "reference_length"]
    rows = counts.groupBy(*keys).agg(*sums, _f1(1), _f1(2), F.max("rougeL").alias("rougeL"), F.max("rougeLsum").alias("rougeLsum"),
                                     F.sum(F.when(F.col("order") == 0, F.col("p"))).alias("samples"))
    totals = rows.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names], F.avg("rouge1").alias("rouge1"), F.avg("rouge2").alias("rouge2"),
                      *[F.avg(c).alias(c) for c in ("rougeL", "rougeLsum")],
                      F.coalesce(F.sum("samples"), F.lit(0)).alias("predict_samples"))
    return _bleu_of(totals).select(*[F.col(c).cast("double").alias(c) for c in (*ROUGE, *BLEU, "predict_samples")])
