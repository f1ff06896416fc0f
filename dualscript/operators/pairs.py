"""Stage 2: transcript lines -> aligned (numerals, spelled-out) sentence pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dualscript.functions import text as T
from dualscript.operators.ranking import before, kth_smallest
from dualscript.operators.staging import compute_once
from dualscript.sources.storage import materialise

VALID_FRACTION = 0.1  # fixed value: share of the first pairs that validates


def sentences(lines: DataFrame, delimiter: str | None = "::") -> DataFrame:
    """Add ``sentence``: the second delimited field, or the line itself.

    Lines without the delimiter are dropped.
    """
    if delimiter is None:
        return lines.withColumn("sentence", F.col("raw"))
    return lines.where(F.contains(F.col("raw"), F.lit(delimiter))).withColumn(
        "sentence", T.field_after(F.col("raw"), delimiter)
    )


def valid_pairs(lines: DataFrame, delimiter: str | None = "::") -> DataFrame:
    """Lines that yield a pair, with ``num_col`` and ``sen_col``; one narrow stage.

    Cheap tests run first, and every string is computed once.
    """
    s = F.col("sentence")
    rest = [c for c in lines.columns if c != "raw"]
    marked = sentences(lines.where(F.contains(F.col("raw"), F.lit("("))), delimiter)
    # No step adds a digit, so a sentence without one cannot end with one.
    worth = compute_once(marked, sentence=s).where(T.has_digit(s) & ~T.has_stray_digit(s))
    plausible = compute_once(worth, brackets=T.bracket_list(s)).where(T.is_paired(F.col("brackets")))
    folded = plausible.withColumn("folded", T.fold_readings(s, F.col("brackets")))
    cut = compute_once(
        folded.select(*rest, "folded"),
        num=T.cut_brackets(F.col("folded"), "spelling"),
        sen=T.cut_brackets(F.col("folded"), "phonetic"),
    )
    # An opening bracket without partner, or a '%' that has no reading, fails.
    sound = (
        T.has_digit(F.col("num"))
        & ~F.contains(F.col("sen"), F.lit("("))
        & ~F.contains(F.col("sen"), F.lit("%"))
    )
    return cut.where(sound).select(
        *rest,
        T.drop_symbols(F.col("num")).alias("num_col"),
        T.drop_symbols(F.col("sen")).alias("sen_col"),
    )


def line_outcomes(lines: DataFrame, delimiter: str = "::") -> DataFrame:
    """Every line with the first check it fails, or ``ok``."""
    s = F.col("sentence")
    running = F.col("_folded")
    staged = (
        lines.withColumn("sentence", T.field_after(F.col("raw"), delimiter))
        .withColumn("_brackets", T.bracket_list(s))
        .withColumn("_folded", T.fold_readings(s, F.col("_brackets")))
    )
    reason = (
        F.when(s.isNull(), "no_delimiter")
        .when(T.has_stray_digit(s), "stray_digit")
        .when(F.size("_brackets") == 0, "no_bracket")
        .when(F.size("_brackets") % 2 == 1, "odd_brackets")
        .when(~T.has_digit(T.transcript_text(running, "spelling")), "no_numeral")
        .when(T.transcript_text(running, "phonetic").isNull(), "bad_phonetic")
        .otherwise("ok")
    )
    return staged.withColumn("reason", reason).drop("_brackets", "_folded")


def dedup_pairs(pairs: DataFrame, order: str = "pos") -> DataFrame:
    """One pair per ``num_col``: first position, last value."""
    return pairs.groupBy("num_col").agg(
        F.max_by("sen_col", order).alias("sen_col"), F.min(order).alias(order)
    )


def sentence_pairs(lines: DataFrame, order: str = "pos", delimiter: str | None = "::") -> DataFrame:
    return dedup_pairs(valid_pairs(lines, delimiter).select(order, "num_col", "sen_col"), order)


def head_split(pairs: DataFrame, fraction: float = VALID_FRACTION, order: str = "pos") -> DataFrame:
    """Label the first ``int(n * fraction)`` pairs ``valid`` and the rest ``train``.

    The pairs are stored once; the boundary is found by counting, so the split
    itself is a filter and moves no rows.
    """
    stored = materialise(pairs, "pairs")
    total = stored.count()
    head = int(total * fraction)
    if head == 0:
        return stored.withColumn("split", F.lit("train"))
    if head >= total:
        return stored.withColumn("split", F.lit("valid"))
    first_train = kth_smallest(stored, order, head, total)
    return stored.withColumn(
        "split", F.when(before(stored, order, first_train), "valid").otherwise("train")
    )


def hash_split(pairs: DataFrame, fraction: float = VALID_FRACTION, seed: str = "0") -> DataFrame:
    """Split by a seeded digest of ``num_col``: no order, no pass over the data."""
    return pairs.withColumn(
        "split", F.when(T.unit_hash(F.col("num_col"), seed) < fraction, "valid").otherwise("train")
    )


def split_sizes(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("split").agg(F.count("*").alias("n"))
