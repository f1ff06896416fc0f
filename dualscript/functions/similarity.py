"""Arrow UDFs for the two per-row algorithms Spark has no built-in for."""

from __future__ import annotations

import sys
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_AT_ONCE = 64  # rows of an Arrow batch whose tokens are Python strings at a time
AUTOJUNK_MIN = 200  # difflib ignores frequent items only from this length on


def byte_ratio(a: bytes, b: bytes, autojunk: bool = True) -> float:
    """difflib's matching ratio of two byte strings."""
    return SequenceMatcher(None, a, b, autojunk).ratio()


def ratio_at_most(a: bytes, b: bytes, limit: float, autojunk: bool = True) -> bool:
    """``byte_ratio(a, b) <= limit``, answered by cheap bounds where they decide."""
    la, lb = len(a), len(b)
    if la + lb == 0:
        return 1.0 <= limit
    in_a = np.bincount(np.frombuffer(a, np.uint8), minlength=256)
    in_b = np.bincount(np.frombuffer(b, np.uint8), minlength=256)
    # Matched bytes cannot exceed the common multiset.
    if 2.0 * int(np.minimum(in_a, in_b).sum()) / (la + lb) <= limit:
        return True
    n = min(la, lb)
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    prefix = int(differ.argmax()) if differ.any() else n
    if autojunk and lb >= AUTOJUNK_MIN:
        # A block grows from a byte that is infrequent in b.  If none is shared,
        # only the common prefix counts, which is where the search starts.
        rare = (in_b > 0) & (in_b <= lb // 100 + 1)
        if not (rare & (in_a > 0)).any():
            return 2.0 * prefix / (la + lb) <= limit
    elif 2.0 * prefix / (la + lb) > limit:
        # The first block found is the longest, hence no shorter than the prefix.
        return False
    return byte_ratio(a, b, autojunk) <= limit


def ratio_udf(autojunk: bool = True):
    """(BINARY, BINARY) -> DOUBLE; NULL in, NULL out."""

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(
            [None if x is None or y is None else byte_ratio(bytes(x), bytes(y), autojunk)
             for x, y in zip(a, b)],
            dtype="Float64",
        )

    return ratio


def ratio_at_most_udf(autojunk: bool = True):
    """(BINARY, BINARY, DOUBLE) -> BOOLEAN; NULL in, NULL out."""

    @F.pandas_udf(BooleanType())
    def at_most(a: pd.Series, b: pd.Series, limit: pd.Series) -> pd.Series:
        return pd.Series(
            [None if x is None or y is None else ratio_at_most(bytes(x), bytes(y), t, autojunk)
             for x, y, t in zip(a, b, limit)],
            dtype="boolean",
        )

    return at_most


def lcs_length(left: list[str], right: list[str]) -> int:
    """Longest common subsequence, one machine-word operation per 64 cells.

    Bit j of ``row`` is 0 where the DP row steps up at column j.
    """
    where: dict[str, int] = {}
    for j, item in enumerate(right):
        where[item] = where.get(item, 0) | (1 << j)
    full = (1 << len(right)) - 1
    row = full
    for item in left:
        hits = row & where.get(item, 0)
        row = ((row + hits) | (row - hits)) & full
    return len(right) - row.bit_count()


def lcs_places(ref: list[str], pred: list[str]) -> set[int]:
    """Places in ``ref`` that one longest common subsequence matches.

    Of several, the one found from the ends: equal tokens match; otherwise the
    last token of ``pred`` is left out if that keeps a longer subsequence than
    leaving out the last of ``ref``.  A row of the table is one number: bit j
    is 0 where it steps up at column j.
    """
    where: dict[str, int] = {}
    for j, item in enumerate(pred):
        where[item] = where.get(item, 0) | (1 << j)
    full = (1 << len(pred)) - 1
    rows = [full]
    for item in ref:
        row = rows[-1]
        hits = row & where.get(item, 0)
        rows.append(((row + hits) | (row - hits)) & full)

    def length(i: int, j: int) -> int:
        return j - (rows[i] & ((1 << j) - 1)).bit_count()

    i, j, out = len(ref), len(pred), set()
    while i and j:
        if ref[i - 1] == pred[j - 1]:
            i, j = i - 1, j - 1
            out.add(i)
        elif length(i, j - 1) > length(i - 1, j):
            j -= 1
        else:
            i -= 1
    return out


def lcs_f1(pred: list[str], ref: list[str]) -> float:
    common = lcs_length(ref, pred) if pred and ref else 0
    return 2.0 * common / (len(pred) + len(ref)) if common else 0.0


def summary_f1(pred: list[list[str]], ref: list[list[str]]) -> float:
    """F1 of lines: per line of ``ref`` the union of places matched by any line of ``pred``, each token clipped."""
    left = [Counter(t for line in side for t in line) for side in (pred, ref)]
    total = sum(c.total() for c in left)
    hits = 0
    for line in ref:
        for k in sorted(set().union(*[lcs_places(line, other) for other in pred])):
            if all(c[line[k]] > 0 for c in left):
                for c in left:
                    c[line[k]] -= 1
                hits += 1
    return 2.0 * hits / total if hits else 0.0


@F.arrow_udf(StructType([StructField("rougeL", DoubleType()), StructField("rougeLsum", DoubleType())]))
def _rouge_lcs(pred: pa.Array, ref: pa.Array, pred_lines: pa.Array, ref_lines: pa.Array) -> pa.Array:
    rows = []
    # tokens become Python strings for a few rows at a time, however many a batch holds
    for at in range(0, len(pred), ROWS_AT_ONCE):
        for p, r, pl, rl in zip(*[x.slice(at, ROWS_AT_ONCE).to_pylist() for x in (pred, ref, pred_lines, ref_lines)]):
            whole = lcs_f1(p, r)
            rows.append((whole, whole if pl is None else summary_f1(pl, rl)))
    columns = [pa.array([row[k] for row in rows], pa.float64()) for k in range(2)]
    return pa.StructArray.from_arrays(columns, ["rougeL", "rougeLsum"])


def rouge_lcs(pred: Column, ref: Column, pred_lines: Column, ref_lines: Column) -> Column:
    """Struct ``rougeL, rougeLsum`` of token lists, and of lists of lines, NULL for texts of one line."""
    return _rouge_lcs(pred, ref, pred_lines, ref_lines)
