"""Line scan of ``.trn`` files inside script folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER_GLOB = "*scripts*"


def read_trn(spark: SparkSession, root: str, folder_glob: str = FOLDER_GLOB) -> DataFrame:
    """``file, pos, raw``: every line of every file in matching folders.

    Files stay splittable.  ``pos`` orders lines by file, block and place in
    the block; row ids alone do not follow file order.
    """
    return spark.read.text(f"{root}/{folder_glob}/*").select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("pos"),
        F.col("value").alias("raw"),
    )
