"""Stage 3: drop misaligned pairs, describe lengths."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dualscript.functions import text as T
from dualscript.functions.similarity import ratio_at_most_udf, ratio_udf
from dualscript.sources.pair_csv import read_pairs, write_pairs
from dualscript.sources.storage import materialise

# --- fixed values: spelled-out length bands and their similarity limits ---
BANDS = [(10, 0.1), (20, 0.2), (50, 0.4)]  # (longest length, limit)
LONG_LIMIT = 0.5  # beyond the last band
LONG_FROM = 50
# --- end of fixed values ---

KEEP, DROP, QUARANTINE = "keep", "drop", "quarantine"


def similarity_limit(length: Column) -> Column:
    out = F.lit(None).cast("double")
    for i, (longest, limit) in enumerate(BANDS):
        out = F.when(length <= longest, F.lit(limit)) if i == 0 else out.when(length <= longest, limit)
    return out.otherwise(LONG_LIMIT)


def similarity(pairs: DataFrame, autojunk: bool = True) -> DataFrame:
    """Add ``ratio``, the byte-level matching ratio of the two sides."""
    return pairs.withColumn(
        "ratio", ratio_udf(autojunk)(T.utf8(F.col("num_col")), T.utf8(F.col("sen_col")))
    )


def _native_verdict() -> Column:
    """keep / drop / quarantine where no ratio is needed, NULL otherwise."""
    num, sen = F.col("num_col"), F.col("sen_col")
    long_or_hangul = (F.length(sen) > LONG_FROM) | T.is_hangul(T.last_char(num))
    n, m = F.octet_length(num), F.octet_length(sen)
    upper_bound = 2.0 * F.least(n, m) / (n + m)
    return (
        F.when((num == "") & (sen == ""), KEEP)
        .when((num == "") | (sen == ""), QUARANTINE)
        .when((T.last_char(num) == T.last_char(sen)) | ~long_or_hangul, KEEP)
        .when(upper_bound <= similarity_limit(F.length(sen)), DROP)
    )


def native_verdicts(pairs: DataFrame) -> DataFrame:
    """Add ``verdict``; NULL marks the rows that need the ratio."""
    return pairs.withColumn("verdict", _native_verdict())


def judge_pairs(pairs: DataFrame, autojunk: bool = True) -> DataFrame:
    """Add ``verdict`` to every pair.

    A Python UDF sees every row of its operator, so decided rows pass NULLs and
    cost no comparison; the input is scanned once.
    """
    open_ = F.col("verdict").isNull()
    num, sen = F.col("num_col"), F.col("sen_col")
    low = ratio_at_most_udf(autojunk)(
        F.when(open_, T.utf8(num)), F.when(open_, T.utf8(sen)),
        F.when(open_, similarity_limit(F.length(sen))),
    )
    return (
        native_verdicts(pairs)
        .withColumn("_low", low)
        .withColumn("verdict", F.coalesce("verdict", F.when(F.col("_low"), DROP).otherwise(KEEP)))
        .drop("_low")
    )


def filter_pairs(pairs: DataFrame, autojunk: bool = True) -> DataFrame:
    """Pairs that pass; one-sided empty pairs are left out as well."""
    return judge_pairs(pairs, autojunk).where(F.col("verdict") == KEEP).drop("verdict")


def clean_csv(spark: SparkSession, paths: list[str], out: str, header: bool = True, autojunk: bool = True) -> dict[str, DataFrame]:
    """Stage 3 from files: pair CSVs in, the kept pairs as CSV at ``out``.

    Returns what the stage reports: ``rejects``, lines that are no pair;
    ``quarantine``, pairs with one empty side; ``sizes`` per verdict; and
    ``profile``, lengths before and after.  Pairs are judged once and stored.
    """
    good, bad = read_pairs(spark, paths, header)
    judged = materialise(judge_pairs(good, autojunk), "judged")
    write_pairs(judged.where(F.col("verdict") == KEEP), out)
    phases = judged.withColumn("phase", F.explode(F.when(F.col("verdict") == KEEP, F.array(F.lit("before"), F.lit("after")))
                                                  .otherwise(F.array(F.lit("before")))))
    return {
        "rejects": bad,
        "quarantine": judged.where(F.col("verdict") == QUARANTINE).drop("verdict"),
        "sizes": judged.groupBy("verdict").agg(F.count("*").alias("n")),
        "profile": length_profile(phases, {"sen": "sen_col", "num": "num_col"}, "phase"),
    }


def length_profile(df: DataFrame, columns: Mapping[str, str], *within: str) -> DataFrame:
    """Length statistics of text columns, one row per ``series`` (and group).

    ``columns`` maps series names to text columns.  Rows shrink to a histogram
    of lengths first, whose size is bounded by the longest text; every
    statistic, including the exact quantiles, comes from the histogram.
    """
    series = F.inline(
        F.array(
            *[
                F.struct(F.lit(name).alias("series"), F.length(col).alias("len"))
                for name, col in columns.items()
            ]
        )
    )
    keys = [*within, "series"]
    histogram = df.select(*within, series).where("len IS NOT NULL").groupBy(*keys, "len").agg(
        F.count("*").alias("cnt")
    )
    value, weight = F.col("len").cast("double"), F.col("cnt")
    # The group mean joins the histogram rows so that the variance is centred.
    group = Window.partitionBy(*keys)
    total = F.sum(F.col("len").cast("bigint") * weight)
    centred = histogram.withColumn("avg", total.over(group) / F.sum("cnt").over(group))
    stats = centred.groupBy(*keys).agg(
        F.sum("cnt").alias("n"),
        F.sum((value - F.col("avg")) ** 2 * weight).alias("m2"),
        F.first("avg").alias("mean"),
        F.percentile(value, F.lit([0.25, 0.5, 0.75]), weight).alias("q"),
        # Most frequent length, the smallest on a tie.
        F.max_by("len", F.struct(weight, -F.col("len"))).alias("mode"),
        F.max("len").alias("max"),
        F.min("len").alias("min"),
    )
    var_samp = F.when(F.col("n") > 1, F.col("m2") / (F.col("n") - 1))
    var_pop = F.col("m2") / F.col("n")
    return stats.select(
        *keys,
        "n",
        "mean",
        F.col("q")[1].alias("median"),
        F.col("mode").cast("bigint").alias("mode"),
        F.col("max").cast("bigint").alias("max"),
        F.col("min").cast("bigint").alias("min"),
        F.sqrt(var_samp).alias("std_samp"),
        F.sqrt(var_pop).alias("std_pop"),
        var_samp.alias("var_samp"),
        var_pop.alias("var_pop"),
        (F.col("q")[2] - F.col("q")[0]).alias("iqr"),
        (F.col("max") - F.col("min")).cast("bigint").alias("range"),
    )
