"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dualscript.sources.storage import materialise, path_exists

# --- fixed values: the white space and the letters that the contracts name ---
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# --- end of fixed values ---


def pack(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_id, _text, _rest``: all other columns in one struct, so no name can clash."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (key, text)]
    rest = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("_none"))
    return docs.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_text"),
                       rest.alias("_rest"))


def unpack(packed: DataFrame, docs: DataFrame, key: str, text: str, changed: dict[str, Column] | None = None) -> DataFrame:
    """The columns of ``docs`` in their order; ``changed`` replaces some of them."""
    def value(c: str) -> Column:
        if changed and c in changed:
            return changed[c]
        return F.col("_id") if c == key else F.col("_text") if c == text else F.col("_rest")[c]

    return packed.select(*[value(c).alias(c) for c in docs.columns])


def small_table(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    """Rows that the driver made, handed over through Arrow.

    A list of rows would be read back by Python workers of their own, which
    the executors then keep beside those of the functions.
    """
    columns = list(zip(*rows)) or [()] * len(schema)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema))


def stored(df: DataFrame, label: str, *spent: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder; then ``spent`` stored tables are deleted."""
    out = materialise(df, label)
    drop(*spent)
    release_shuffles(out.sparkSession)
    return out


def release_shuffles(spark: SparkSession) -> None:
    """Ask the driver to collect its garbage: only then does Spark drop the shuffle files of the jobs that are done.

    The last job is held until another one has run, so an empty one does.
    """
    spark.range(1, numPartitions=1).collect()
    spark._jvm.System.gc()


def drop(*spent: DataFrame) -> None:
    """Delete the folders of tables that ``stored`` wrote and nothing reads any more."""
    for df in spent:
        spark = df.sparkSession
        for file in df.inputFiles()[:1]:
            folder = file.rsplit("/", 1)[0]
            if path_exists(spark, f"{folder}/_SUCCESS"):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it in lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """``node, root``: for every node of ``edges (a, b)`` the smallest node it reaches.

    Alternates the large-star and small-star steps, in which every node hands
    its neighbours to the smallest of them.  Each round is written to the
    shared folder, so lineage stays short and a lost executor costs one round.
    No step gathers a node's neighbours: both are a minimum, which Spark
    combines before the shuffle, and a join that AQE may split.
    """
    pair = F.array_sort(F.array("a", "b"))
    now = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.get(pair, F.lit(0)).alias("lo"), F.get(pair, F.lit(1)).alias("hi")).distinct(),
        f"{label}-edges",
    )

    def check(df: DataFrame):
        mark = F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))
        return df.agg(F.count("*"), F.coalesce(mark, F.lit(0))).first()

    before = check(now)
    while before[0]:
        both = now.select(F.col("lo").alias("n"), F.col("hi").alias("m")).unionByName(
            now.select(F.col("hi").alias("n"), F.col("lo").alias("m")))
        least = both.groupBy("n").agg(F.min("m").alias("m")).select("n", F.least("n", "m").alias("root"))
        # large star: every larger neighbour of n moves to the smallest of n and its neighbours
        large = both.where("m > n").join(least, "n").select(
            F.col("root").alias("lo"), F.col("m").alias("hi")).where("lo <> hi").distinct()
        large = stored(large, f"{label}-large", now)
        # small star: n and its smaller neighbours move to the smallest of these
        down = large.groupBy("hi").agg(F.min("lo").alias("root"))
        small = large.join(down, "hi").select(
            F.explode(F.array(F.struct(F.col("root").alias("lo"), F.col("hi")),
                              F.struct(F.col("root").alias("lo"), F.col("lo").alias("hi")))).alias("e")
        ).select("e.*").where("lo <> hi").distinct()
        now = stored(small, f"{label}-edges", large)
        after = check(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionByName(now.select(F.col("lo").alias("node"), F.col("lo").alias("root"))).groupBy(
        "node").agg(F.min("root").alias("root"))
