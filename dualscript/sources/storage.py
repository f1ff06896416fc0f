"""Durable intermediate tables.

Results that are read more than once are written as Parquet under the shared
folder named by ``spark.checkpoint.dir``: columnar, prunable, and still there
after an executor is lost.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if context.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="dualscript-"))
    return context.getCheckpointDir()


def fresh_name() -> str:
    return uuid.uuid4().hex


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{fresh_name()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give every core some rows of a small table.

    Only for a plain scan: asking a plan with a shuffle for its partitions runs it.

    A table of a few blocks is read by a few tasks.  Larger inputs already
    have more partitions than cores and are returned as they are, unmoved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def fingerprint(spark: SparkSession, inputs: Sequence[str], parameters: Mapping[str, object] | None = None) -> str:
    """A digest of the files below ``inputs``, their sizes and times, and of ``parameters``.

    No file is opened, and the digests of files are summed, not gathered.
    """
    marks = [repr(sorted((parameters or {}).items()))]
    for path in inputs:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        what = ("path", "modificationTime", "length")
        both = [F.coalesce(F.sum(F.xxhash64(F.lit(k), *what).cast("decimal(38,0)")), F.lit(0)) for k in range(2)]
        marks.append(repr([path, *map(str, files.agg(F.count("*"), *both).first())]))
    return hashlib.sha256("\n".join(marks).encode()).hexdigest()


def materialise_or_reuse(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], inputs: Sequence[str] = (),
    parameters: Mapping[str, object] | None = None,
) -> DataFrame:
    """The table below ``path`` that was built from these inputs and parameters; built if it is not there.

    Each fingerprint has a folder of its own, renamed into place when it is
    complete: a changed input is never answered by an old table, an unfinished
    one is never read, and of two writers the later finds the table published.
    Tables of other fingerprints are deleted once the new one is there.
    """
    mark = fingerprint(spark, inputs, parameters)
    target = f"{path}/{mark}"
    if not path_exists(spark, f"{target}/_SUCCESS"):
        aside = f"{path}/_{fresh_name()}"  # names with an underscore are not read
        build().write.parquet(aside)
        Path = spark._jvm.org.apache.hadoop.fs.Path
        files = Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        if path_exists(spark, f"{target}/_SUCCESS") or not files.rename(Path(aside), Path(target)):
            files.delete(Path(aside), True)
        for other in files.listStatus(Path(path)):
            name = other.getPath().getName()
            if re.fullmatch("[0-9a-f]{64}", name) and name != mark:
                files.delete(other.getPath(), True)
    return spark.read.parquet(target)
