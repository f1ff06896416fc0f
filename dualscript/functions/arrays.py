"""Array functions on token ids, logits and n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill_mask(ids: Column, pad_id: int, mask_id: int = -100) -> Column:
    """Replace the label mask by the padding id."""
    return F.transform(ids, lambda x: F.when(x == mask_id, F.lit(pad_id)).otherwise(x).cast("int"))


def arg_max(vector: Column) -> Column:
    """0-based index of the first maximum."""
    return (F.array_position(vector, F.array_max(vector)) - 1).cast("int")


def arg_max_rows(matrix: Column) -> Column:
    """``arg_max`` over the last axis of a nested array."""
    return F.transform(matrix, arg_max)


def append_id(ids: Column, value: int) -> Column:
    return F.array_append(ids, F.lit(value).cast("int"))


def drop_last(ids: Column) -> Column:
    return F.slice(ids, F.lit(1), F.greatest(F.size(ids) - 1, F.lit(0)))


def truncate(ids: Column, max_length: int) -> Column:
    return F.slice(ids, 1, max_length)


def longer_grams(grams: Column, items: Column, n: int) -> Column:
    """Space-joined n-grams from the (n-1)-grams; empty when there are too few items."""
    count = F.greatest(F.size(items) - (n - 1), F.lit(0))
    return F.zip_with(
        F.slice(grams, F.lit(1), count),
        F.slice(items, F.lit(n), count),
        lambda head, last: F.concat_ws(" ", head, last),
    )
