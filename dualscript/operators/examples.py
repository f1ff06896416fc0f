"""Stage 4: pairs -> training examples."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualscript.functions import arrays as A
from dualscript.functions import text as T
from dualscript.operators import vocabulary as V
from dualscript.operators.ranking import number_rows

# --- fixed values: directions, prompts and the prompt form's token limit ---
NUM_TO_TEXT, TEXT_TO_NUM = "NTT", "TTN"
PROMPTS = ("translation_num_to_txt", "translation_txt_to_num")
PROMPT_MAX_LENGTH = 240
# --- end of fixed values ---


def _sides(direction: str) -> tuple[Column, Column]:
    """(input, label); anything but NTT reads from text to numerals."""
    num, sen = F.col("num_col"), F.col("sen_col")
    return (num, sen) if direction == NUM_TO_TEXT else (sen, num)


def _rest(pairs: DataFrame) -> list[str]:
    """Other columns travel along; the source text columns are dropped."""
    return [c for c in pairs.columns if c not in ("num_col", "sen_col")]


def directed_examples(pairs: DataFrame, direction: str) -> DataFrame:
    source, target = _sides(direction)
    return pairs.select(*_rest(pairs), source.alias("input"), target.alias("label"))


def prompt_examples(pairs: DataFrame, prompt: str = PROMPTS[0]) -> DataFrame:
    """``prompt: numerals`` in, spelled-out text as label."""
    return pairs.select(
        *_rest(pairs),
        F.concat(F.lit(f"{prompt}: "), "num_col").alias("input"),
        F.col("sen_col").alias("label"),
    )


def causal_examples(
    pairs: DataFrame, direction: str, bos: str = V.SPECIALS[V.BOS], eos: str = V.SPECIALS[V.EOS]
) -> DataFrame:
    """Both sides in one text, which is its own label."""
    if direction not in (NUM_TO_TEXT, TEXT_TO_NUM):
        raise ValueError(f"unknown direction {direction!r}")
    source, target = _sides(direction)
    b, e = F.lit(bos), F.lit(eos)
    joined = F.concat(b, source, e, b, target, e)
    return pairs.select(*_rest(pairs), joined.alias("input"), joined.alias("label"))


def encoded_examples(examples: DataFrame, key: str, vocab: DataFrame) -> DataFrame:
    """``key, input_ids, labels, length``: labels end with the end-of-sequence id."""
    ids = V.encode_texts(examples, key, {"input_ids": "input", "labels": "label"}, vocab)
    return ids.withColumn("labels", V.end_ids(F.col("labels"))).withColumn(
        "length", F.size("input_ids")
    )


def encoded_prompts(
    examples: DataFrame, key: str, vocab: DataFrame, max_length: int | None = None
) -> DataFrame:
    """Both sides with an end id, which the input then loses.

    A ``max_length``, such as the prompt form's ``PROMPT_MAX_LENGTH``, cuts them; by default they stay whole.
    """
    ids = V.encode_texts(examples, key, {"input_ids": "input", "labels": "label"}, vocab)
    ended = {c: V.end_ids(F.col(c), True, max_length) for c in ("input_ids", "labels")}
    return ids.withColumns(ended).withColumn("input_ids", A.drop_last(F.col("input_ids")))


def encoded_causal(
    pairs: DataFrame, key: str, direction: str, vocab: DataFrame, closed: bool = False
) -> DataFrame:
    """``key, input_ids, labels, length``: begin, one side, end, begin, the other side, end.

    Both sides come from one lookup; the reserved ids are put between them as
    ids, so none but the unknown one ever comes from a text.  Labels equal inputs.
    """
    if direction not in (NUM_TO_TEXT, TEXT_TO_NUM):
        raise ValueError(f"unknown direction {direction!r}")
    both = directed_examples(pairs, direction)
    ids = V.encode_texts(both, key, {"first": "input", "second": "label"}, vocab, closed)
    bos, eos = (F.array(F.lit(i)) for i in (V.BOS, V.EOS))
    whole = F.concat(bos, "first", eos, bos, "second", eos)
    return ids.select(key, whole.alias("input_ids"), whole.alias("labels"), F.size(whole).alias("length"))


def map_batches(
    examples: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """A user's own row transformation, run on Arrow batches inside the tasks.

    Built-in columns cover the forms above; this is for functions that only
    exist in Python.  ``schema`` names the columns that remain.
    """
    return examples.mapInPandas(lambda batches: (fn(b) for b in batches), schema)


def length_buckets(df: DataFrame, text: str, buckets: int) -> DataFrame:
    """Add ``length`` (tokens) and ``bucket``, whose edges are exact quantiles.

    Quantiles come from the histogram of lengths, bounded by the longest text.
    """
    sized = df.withColumn("length", F.size(T.tokens(F.col(text))))
    marks = F.lit([i / buckets for i in range(1, buckets)])
    edges = (
        sized.groupBy("length").agg(F.count("*").alias("cnt"))
        .agg(F.percentile(F.col("length").cast("double"), marks, F.col("cnt")))
        .scalar()
    )
    return (
        sized.withColumn("_edges", edges)
        .withColumn("bucket", F.size(F.filter("_edges", lambda e: e < F.col("length"))))
        .drop("_edges")
    )


def grouped_by_length(bucketed: DataFrame, partitions: int) -> DataFrame:
    """Lay rows of like length side by side; the hash breaks up a hot length."""
    spread = F.xxhash64(*[c for c in bucketed.columns if c not in ("length", "bucket")])
    return bucketed.repartitionByRange(partitions, "bucket", "length", spread).sortWithinPartitions(
        "bucket", "length"
    )


def _batch_plan(histogram: dict[int, int], budget: int) -> list[tuple[int, int, int, int, int, int]]:
    """Per length: its first row's number, the open batch and the rows it takes, the next batch and its rows.

    Rows stand in order of length.  A batch takes rows as long as their number
    times the longest length stays within ``budget``; a row that is longer than
    that is a batch of its own.
    """
    plan, row, batch, held = [], 0, 0, 0  # ``held`` rows are in the open batch
    for length, count in sorted(histogram.items()):
        per = max(1, budget // max(length, 1))
        joins = min(count, max(0, per - held)) if held else 0
        rest = count - joins
        first_new = batch + 1 if held else batch
        plan.append((length, row, batch, joins, first_new, per))
        if rest:
            full, over = divmod(rest, per)
            batch = first_new + full - (0 if over else 1)
            held = over or per
        else:
            held += joins
        row += count
    return plan


def token_budget_batches(df: DataFrame, text: str, key: str, budget: int) -> DataFrame:
    """Add ``length`` (tokens), ``batch`` and ``place``: rows of like length in batches of ``budget`` padded tokens.

    Rows are numbered in order of length and ``key`` by range partitions and
    one offset per partition.  How batches cut that order follows from the
    histogram of lengths alone, which is bounded by the longest text; the key
    breaks up a hot length.
    """
    sized = df.withColumn("length", F.size(T.tokens(F.coalesce(text, F.lit("")))).cast("int"))
    numbered = number_rows(sized, [F.asc("length"), F.asc(key)], "_number")
    histogram = {r["length"]: r["count"] for r in numbered.groupBy("length").count().collect()}
    plan = df.sparkSession.createDataFrame(
        _batch_plan(histogram, budget), "length int, _row bigint, _open bigint, _joins bigint, _next bigint, _per bigint")
    at = F.col("_number") - F.col("_row")
    joins = at < F.col("_joins")
    batch = F.when(joins, F.col("_open")).otherwise(F.col("_next") + F.floor((at - F.col("_joins")) / F.col("_per")))
    return numbered.join(plan, "length").withColumn("batch", batch).select(*df.columns, "length", "batch", F.col("_number").alias("place"))


def padding_report(batches: DataFrame) -> DataFrame:
    """One row: batches, rows, tokens, padded tokens and the share of padding."""
    per = batches.groupBy("batch").agg(
        F.count("*").alias("n"), F.sum("length").alias("tokens"), (F.count("*") * F.max("length")).alias("padded"))
    total = per.agg(F.count("*").alias("batches"), *[F.coalesce(F.sum(c), F.lit(0)).alias(a) for c, a in (("n", "rows"), ("tokens", "tokens"), ("padded", "padded"))])
    share = F.when(F.col("padded") > 0, 1 - F.col("tokens") / F.col("padded")).otherwise(F.lit(0.0))
    return total.withColumn("padding_share", share)
