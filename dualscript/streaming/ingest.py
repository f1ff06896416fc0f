"""Incremental ingest of script files through the stage-2 operators.

Lines are streamed, not files: a large file is many tasks.  Their order is that
of file, block and row; the row number is given inside the batch, where a
block's lines still stand together.  The data has no event time, so no
watermark can bound the keyed dedup: it keeps one row per distinct ``num_col``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from dualscript.operators.pairs import valid_pairs
from dualscript.streaming import deltas

_POS = StructType([StructField("file", StringType(), False), StructField("block", LongType(), False), StructField("row", LongType(), False)])
PAIRS = StructType([StructField("pos", _POS), StructField("num_col", StringType()), StructField("sen_col", StringType())])
STATE = StructType([StructField("num_col", StringType()), StructField("first_pos", _POS), StructField("last_pos", _POS),
                    StructField("sen_col", StringType())])


def stream_trn(spark: SparkSession, root: str, folder_glob: str = "*scripts*",
               files_per_trigger: int | None = None) -> DataFrame:
    """The lines of new ``.trn`` files as a stream of ``file, block, raw``."""
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(f"{root}/{folder_glob}").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("raw"))


def numbered(batch: DataFrame) -> DataFrame:
    """``pos, raw`` of one batch.

    A file is read in one batch, and a block in one task from its start, so row
    ids rise along a block; across blocks ``file`` and ``block`` decide.
    """
    return batch.select(F.struct("file", "block", F.monotonically_increasing_id().alias("row")).alias("pos"), "raw")


def batch_pairs(batch: DataFrame, delimiter: str | None = "::") -> DataFrame:
    """Pairs of each new line, not yet deduplicated."""
    return valid_pairs(numbered(batch), delimiter).select("pos", "num_col", "sen_col")


def _each_batch(lines: DataFrame, checkpoint: str, step) -> StreamingQuery:
    return (lines.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def append_pairs(lines: DataFrame, path: str, checkpoint: str, delimiter: str | None = "::") -> StreamingQuery:
    """Append the pairs of a line stream; exactly once per input file."""
    def step(batch: DataFrame, number: int) -> None:
        deltas.publish(batch_pairs(batch, delimiter), path, (number, number))

    return _each_batch(lines, checkpoint, step)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """All pairs appended so far: ``pos, num_col, sen_col``."""
    return deltas.read(spark, path, PAIRS)


def partial_state(pairs: DataFrame) -> DataFrame:
    """Per ``num_col`` its first and last position and the value at the last."""
    return pairs.groupBy("num_col").agg(
        F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.max_by("sen_col", "pos").alias("sen_col"))


def combined_state(partials: DataFrame) -> DataFrame:
    """Partial states of several batches as one."""
    return partials.groupBy("num_col").agg(
        F.min("first_pos").alias("first_pos"), F.max("last_pos").alias("last_pos"), F.max_by("sen_col", "last_pos").alias("sen_col"))


def write_dedup(lines: DataFrame, path: str, checkpoint: str, delimiter: str | None = "::") -> StreamingQuery:
    """Keep at ``path`` the keyed dedup of everything seen, as one partial state per batch.

    A batch writes what it adds and nothing else; ``read_dedup`` combines.
    Partials are compacted now and then, in sizes that grow, so the table is
    never rewritten as a whole per batch and never missing.
    """
    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        settled = deltas.ranges(spark, path)
        deltas.publish(partial_state(batch_pairs(batch, delimiter)), path, (number, number))
        deltas.compact(spark, path, combined_state, STATE, settled)

    return _each_batch(lines, checkpoint, step)


def read_dedup(spark: SparkSession, path: str) -> DataFrame:
    """``num_col, sen_col, pos``: the last value of each key, at its first position."""
    return combined_state(deltas.read(spark, path, STATE)).select("num_col", "sen_col", F.col("first_pos").alias("pos"))
