"""Keep the optimiser from computing the same expression twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns that later filters read without recomputing them.

    A filter on a projected column is pushed under the projection with the
    whole expression copied into it.  It is not pushed through an explode, and
    an explode of one struct costs next to nothing.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    wrapped = df.select(*kept, F.explode(F.array(made)).alias("_made"))
    return wrapped.select(*kept, *[F.col(f"_made.{name}").alias(name) for name in columns])
