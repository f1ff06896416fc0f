"""Equi-join lookups that stay balanced when a few keys dominate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1e-3  # a key above this share of all weight is hot; at most 1000 are
SALTS = 4096
ROW_BYTES = 100  # of a broadcast row, keys and values
TOP_KEYS, TRACKED = 1_000, 10_000  # keys of ``left`` that are named, all above the share, and that the sketch follows


def _broadcast_bytes(table: DataFrame) -> int:
    return table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def fits_broadcast(table: DataFrame) -> bool:
    """Whether the planner's size of ``table``, stored before, is within the session's broadcast threshold."""
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= _broadcast_bytes(table)


def frequent_keys(left: DataFrame, on: list[str]) -> list[int]:
    """Hashes of the most frequent keys, at most ``TOP_KEYS``, from a sketch of fixed size."""
    top = left.agg(F.call_function("approx_top_k", F.xxhash64(*on), F.lit(TOP_KEYS), F.lit(TRACKED)).alias("top"))
    return [item["item"] for item in top.first()["top"] or []]


def balanced_lookup(
    left: DataFrame, table: DataFrame, on: list[str], weight: str, spread: str | list[str],
    may_miss: bool = False,
) -> DataFrame:
    """Left join ``left`` with ``table``, which has one row per ``on`` key.

    A table within the broadcast threshold is broadcast whole, and no row of
    ``left`` moves.  The rest is about larger ones.

    ``weight`` says how often a key is expected.  Keys that hold more than
    ``HOT_SHARE`` of the weight, at most 1 / HOT_SHARE of them, are broadcast.
    All others join by shuffle, where rows already answered, and rows with a
    NULL key, are scattered by ``spread`` instead of meeting in one task.

    The weight knows nothing of keys that the table does not hold.  With
    ``may_miss`` one more pass over ``left``, without a shuffle of its rows,
    finds its most frequent keys; the broadcast answers these too, found or not.
    """
    spread = [spread] if isinstance(spread, str) else spread
    values = [c for c in table.columns if c not in on and c != weight]
    if fits_broadcast(table):
        return left.join(F.broadcast(table.select(*on, *values)), on, "left").select(*left.columns, *values)
    packed = F.struct(*values)
    total = table.agg(F.sum(weight)).scalar()
    frequent = F.xxhash64(*on).isin(frequent_keys(left, on)) if may_miss else F.lit(False)
    is_hot = F.coalesce(F.col(weight) > HOT_SHARE * total, F.lit(False)) | frequent
    hot = table.where(is_hot).select(*on, packed.alias("_hot"))
    # The table's salt is always 0, but written so that it is not folded into a
    # literal: the optimiser would then drop it from the join key.
    zero = F.pmod(F.hash(*on), F.lit(1))
    cold = table.where(~is_hot).select(*on, zero.alias("_salt"), packed.alias("_cold"))
    missing = frequent
    for c in on:
        missing = missing | F.col(c).isNull()
    salt = F.when(
        F.col("_hot").isNotNull() | missing, F.pmod(F.hash(*spread), F.lit(SALTS)) + 1
    ).otherwise(0)
    found = (
        left.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", salt)
        .join(cold, [*on, "_salt"], "left")
        .withColumn("_value", F.coalesce("_hot", "_cold"))
    )
    return found.select(*left.columns, *[F.col(f"_value.{v}").alias(v) for v in values])


def _heavier_than(table: DataFrame, weight: str) -> int:
    """The weight above which the keys of ``table`` are so few that they fit the broadcast threshold."""
    rows = max(TOP_KEYS, _broadcast_bytes(table) // ROW_BYTES)
    top = table.select(weight).orderBy(F.desc(weight)).limit(rows + 1)
    least, found = top.agg(F.min(weight), F.count("*")).first()
    return least if found > rows else -1


def grouped_lookup(
    left: DataFrame, table: DataFrame, on: list[str], weight: str, key: str, spread: list[str], lists: dict[str, Column],
    may_miss: bool = False,
) -> DataFrame:
    """``key`` and per entry of ``lists`` the sorted array of that column's values, NULL ones left out.

    The columns may use those of ``left`` and, looked up as in
    ``balanced_lookup``, those of ``table``; a key of ``left`` without any value has
    empty arrays.  ``left`` should lie by ``key``: then the rows of the heaviest keys
    that fit the broadcast threshold are answered and grouped where they are,
    and only the others, which are rare, move to the rest of the table and back.
    """
    values = [c for c in table.columns if c not in on and c != weight]

    def grouped(rows: DataFrame, only: Column | None = None) -> DataFrame:
        return rows.groupBy(key).agg(*[
            F.collect_list(c if only is None else F.when(only, c)).alias(name) for name, c in lists.items()])

    if fits_broadcast(table):
        near = grouped(left.join(F.broadcast(table.select(*on, *values)), on, "left"))
        return near.select(key, *[F.sort_array(name).alias(name) for name in lists])
    cut = _heavier_than(table, weight)
    hot = table.where(F.col(weight) > cut).select(*on, *values, F.lit(True).alias("_near"))
    probed = left.join(F.broadcast(hot), on, "left")
    answered = F.col("_near").isNotNull()
    for c in on:
        answered = answered | F.col(c).isNull()
    rest = probed.where(~answered).select(*left.columns)
    found = balanced_lookup(rest, table.where(F.col(weight) <= cut), on, weight, spread, may_miss)
    late = grouped(found).select(F.col(key), *[F.col(name).alias(f"_late_{name}") for name in lists])

    def both(name: str) -> Column:
        later = F.coalesce(F.col(f"_late_{name}"), F.slice(F.col(name), 1, 0))
        return F.sort_array(F.concat(F.col(name), later)).alias(name)

    return grouped(probed, answered).join(late, key, "left").select(key, *[both(name) for name in lists])
