"""Exact order statistics and dense numbering without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dualscript.sources.storage import materialise

SMALL = 50_000  # bracket size at which one bounded top-k job finishes the search
SAMPLE = 4_000  # positions sampled per round; far above 36, so that every round shrinks the bracket


def _literal(value, dtype) -> Column:
    if isinstance(dtype, StructType):
        return F.struct(
            *[_literal(v, f.dataType).alias(f.name) for v, f in zip(value, dtype.fields)]
        )
    return F.lit(value).cast(dtype)


def before(df: DataFrame, column: str, value) -> Column:
    """``column < value`` for a value that came out of the column, structs included."""
    return F.col(column) < _literal(value, df.schema[column].dataType)


def kth_smallest(df: DataFrame, column: str, k: int, total: int):
    """The k-th smallest (0-based) value of a unique, non-null column.

    Each round samples the current bracket, picks two values around the wanted
    rank and counts rows up to them, so no round moves rows or sorts more than
    the sample.  ``df`` is read once per round and should be materialised.
    """
    if not 0 <= k < total:
        raise IndexError(f"rank {k} outside 0..{total - 1}")
    key, dtype = F.col(column), df.schema[column].dataType
    bracket, below, inside = df.select(column), 0, total
    while inside > SMALL:
        picked = [r[0] for r in bracket.sample(min(1.0, SAMPLE / inside)).collect()]
        ordered = sorted(picked)
        centre = (k - below) / inside * len(ordered)
        margin = 3 * max(1.0, len(ordered) ** 0.5)
        low = ordered[int(centre - margin)] if centre - margin >= 0 else None
        high = ordered[int(centre + margin)] if centre + margin < len(ordered) else None
        after_low = F.lit(True) if low is None else key > _literal(low, dtype)
        upto_high = F.lit(True) if high is None else key <= _literal(high, dtype)
        n_low, n_in = bracket.agg(
            F.count_if(~after_low), F.count_if(after_low & upto_high)
        ).first()
        if not below + n_low <= k < below + n_low + n_in:
            continue  # the sample missed the rank; draw another
        bracket, below, inside = bracket.where(after_low & upto_high), below + n_low, n_in
    return bracket.orderBy(column).offset(k - below).limit(1).first()[0]


def number_rows(df: DataFrame, order: list, name: str, start: int = 0) -> DataFrame:
    """Dense row numbers in global order.

    Range partitions are sorted on their own and stored; the driver only sees
    one count per partition and hands each partition its offset.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    stored = materialise(ranged, "numbered")
    # The id holds the partition in its upper bits and the place in the lower 33.
    part, place = F.shiftright("_row", 33).cast("int"), F.col("_row").bitwiseAND(F.lit(2**33 - 1))
    sizes = dict(stored.groupBy(part.alias("part")).count().collect())
    offsets, seen = [], start
    for i in range(max(sizes, default=0) + 1):
        offsets.append(seen)
        seen += sizes.get(i, 0)
    offset = F.element_at(F.lit(offsets).cast("array<bigint>"), part + 1)
    return stored.withColumn(name, offset + place).drop("_row")
