"""Pair CSV files (``num_col,sen_col``) and metric files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAIR_COLUMNS = ("num_col", "sen_col")
_OPTIONS = {"quote": '"', "escape": '"', "encoding": "UTF-8"}


def write_pairs(pairs: DataFrame, path: str) -> None:
    """Header, minimal quoting, doubled quotes, blanks kept; lines end in LF."""
    (
        pairs.select(*PAIR_COLUMNS)
        .write.mode("overwrite")
        .options(**_OPTIONS, header=True, emptyValue="",
                 ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def read_pairs(
    spark: SparkSession, paths: str | list[str], header: bool = True, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(two-field rows, rejected lines with a reason).

    Rows with fewer or more fields are rejected; blank lines are skipped.
    ``header=False`` treats the header line as data.
    """
    schema = "num_col STRING, sen_col STRING, _corrupt STRING"
    rows = (
        spark.read.schema(schema)
        .options(**_OPTIONS, header=header, multiLine=multi_line, mode="PERMISSIVE",
                 columnNameOfCorruptRecord="_corrupt", enforceSchema=True)
        .csv(paths)
    )
    # A row is only checked against the columns a query asks for, and Spark
    # refuses to read the corrupt-record column alone.  This always true test
    # asks for both columns even where only rows are counted.
    both = (F.length("num_col") + F.length("sen_col") >= 0) | F.col("num_col").isNull() | F.col("sen_col").isNull()
    good = rows.where(F.col("_corrupt").isNull() & both).select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in PAIR_COLUMNS]
    )
    bad = rows.where(F.col("_corrupt").isNotNull() & both).select(
        F.col("_corrupt").alias("line"),
        _fault(F.col("_corrupt")).alias("reason"),
    )
    return good, bad


def _fault(line: Column) -> Column:
    """Why a line is no pair, by its commas outside quotes."""
    commas = F.regexp_count(F.regexp_replace(line, '"(?:[^"]|"")*+"', ""), F.lit(","))
    return F.when(commas < 1, "too few fields").when(commas > 1, "too many fields").otherwise("malformed")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; columns missing from one side are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_splits(spark: SparkSession, files: dict[str, list[str]]) -> DataFrame:
    """All pair CSVs of every split, with a ``split`` column."""
    return union_all(
        [read_pairs(spark, paths)[0].withColumn("split", F.lit(name)) for name, paths in files.items()]
    )


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.mode("overwrite").json(path)
