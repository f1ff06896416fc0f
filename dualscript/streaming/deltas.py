"""Immutable partial results of a stream, one folder per range of batches.

A folder ``delta-<first>-<last>`` holds what batches first..last add.  It is
written aside and renamed into place, so it is there as a whole or not at all,
and never changes.  Where one range contains another, the wider one counts:
a compaction publishes the combination of several folders before they go.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from dualscript.sources.storage import fresh_name

NAME = re.compile(r"delta-(\d+)-(\d+)")
FAN = 8  # ranges of one size that are combined into one of the next

Range = tuple[int, int]
Combine = Callable[[DataFrame], DataFrame]


def _path(spark: SparkSession, text: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _folder(folder: str, span: Range) -> str:
    return f"{folder}/delta-{span[0]:010d}-{span[1]:010d}"


def ranges(spark: SparkSession, folder: str) -> list[Range]:
    """All published ranges, those that wider ones replace included."""
    path, files = _path(spark, folder)
    if not files.exists(path):
        return []
    found = [NAME.fullmatch(f.getPath().getName()) for f in files.listStatus(path)]
    return sorted((int(m[1]), int(m[2])) for m in found if m)


def live(spans: list[Range]) -> list[Range]:
    """The ranges that no other contains."""
    return [s for s in spans if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in spans)]


def publish(df: DataFrame, folder: str, span: Range) -> bool:
    """Write ``df`` as the folder of ``span``; nothing happens if that, or one that contains it, is there.

    A batch that is replayed after a failure so changes nothing.
    """
    spark = df.sparkSession
    done = ranges(spark, folder)
    if any(a <= span[0] and span[1] <= b for a, b in done):
        return False
    aside = f"{folder}/_{fresh_name()}"  # names with an underscore are not read
    df.write.parquet(aside)
    source, files = _path(spark, aside)
    target, _ = _path(spark, _folder(folder, span))
    if files.exists(target) or not files.rename(source, target):
        files.delete(source, True)
        return False
    return True


def read(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The rows of all live ranges."""
    spans = live(ranges(spark, folder))
    if not spans:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[_folder(folder, s) for s in spans])


def _tier(span: Range) -> int:
    width, tier = span[1] - span[0] + 1, 0
    while width >= FAN:
        width, tier = width // FAN, tier + 1
    return tier


def compact(spark: SparkSession, folder: str, combine: Combine, schema: StructType, settled: list[Range]) -> None:
    """Combine the last ``FAN`` ranges of one size, again and again; drop what ``settled`` ranges replaced.

    Each row is rewritten once per size, so a long stream costs a logarithmic
    share.  ``settled`` are the ranges of an earlier call: what they replace
    has not been handed to readers since.
    """
    for a, b in settled:
        for c, d in settled:
            if (a, b) != (c, d) and a <= c and d <= b:
                path, files = _path(spark, _folder(folder, (c, d)))
                files.delete(path, True)
    while True:
        spans = live(ranges(spark, folder))
        last = spans[-FAN:]
        if len(last) < FAN or len({_tier(s) for s in last}) > 1:
            return
        rows = spark.read.schema(schema).parquet(*[_folder(folder, s) for s in last])
        if not publish(combine(rows), folder, (last[0][0], last[-1][1])):
            return
