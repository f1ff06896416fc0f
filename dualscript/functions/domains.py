"""Many names searched in paths at once."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark import Broadcast, SparkContext, cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not find the package

NAMES_AT_ONCE = 200_000  # names of one automaton; more take several
BYTES_AT_ONCE = 16 << 20  # of their text, the checked size of one broadcast


def _slices(names: Sequence[str]) -> list[list[str]]:
    """Consecutive names, each slice within both bounds unless one name alone exceeds them."""
    out: list[list[str]] = []
    size = 0
    for name in names:
        n = len(name.encode())
        if not out or len(out[-1]) >= NAMES_AT_ONCE or size + n > BYTES_AT_ONCE:
            out.append([])
            size = 0
        out[-1].append(name)
        size += n
    return out


def _automaton(names: list[str]) -> ahocorasick.Automaton:
    """Finds all names; a name's value is its place among them."""
    machine = ahocorasick.Automaton()
    for k, name in enumerate(names):
        machine.add_word(name, k)
    machine.make_automaton()
    return machine


def _least(shared: Broadcast):
    """The smallest of one slice's names in a path."""
    @F.pandas_udf("string")
    def least(paths: pd.Series) -> pd.Series:
        machine, given = shared.value

        def one(p: str | None) -> str | None:
            k = min((k for _, k in machine.iter(p)), default=None) if p is not None else None
            return None if k is None else given[k]

        return paths.map(one)

    return least


def smallest_of(path: Column, names: Sequence[str]) -> Column:
    """The smallest of ``names``, given in order, that is a substring of ``path``, or NULL.

    A path is read once by an automaton of all names instead of once per name.
    An empty name is contained in every path and, being the smallest, decides all.
    """
    if names and names[0] == "":
        return F.when(path.isNotNull(), "")
    spark = SparkContext.getOrCreate()
    found = [_least(spark.broadcast((_automaton(part), part)))(path) for part in _slices(names)]
    return reduce(lambda a, b: F.least(a, b), found) if found else F.lit(None).cast("string")
