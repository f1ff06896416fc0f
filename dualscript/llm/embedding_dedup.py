"""Near-duplicate embeddings by PCA-ordered tiles that stop at suffix bounds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dualscript.llm.common import connected_components, stored
from dualscript.operators.lookup import balanced_lookup
from dualscript.operators.ranking import number_rows
from dualscript.sources.storage import materialise

COSINE = 0.95
TILE = 2048  # vectors of a tile
STRIP = 256  # rows of a tile compared at once
BAND = 32  # tiles of a band at most, which a task holds
PAIRS = 1 << 14  # pairs computed in full at once
LEAD = (8, 16, 32)  # dimensions after which a tile asks again whether a pair can still link
SAMPLE = 20_000  # vectors the axes are fitted to; they order the work and decide no link
SLACK = 1e-9  # rounding of partial sums; survivors are computed anew, in full


def usable(vectors: DataFrame, key: str, embedding: str) -> DataFrame:
    """``_id, _v, _ok``: whether a vector can link, that is, has a length and only finite components."""
    v = F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))
    return vectors.select(F.col(key).cast("long").alias("_id"), v.alias("_v"), ok.alias("_ok"))


def principal_axes(vectors: DataFrame) -> np.ndarray:
    """Axes of falling variance of unit vectors, from a bounded sample; a square orthogonal matrix."""
    n = vectors.count()
    slot = F.pmod(F.xxhash64("_v"), F.lit(1 << 30))
    picked = vectors.where(slot < int(min(1.0, SAMPLE / max(n, 1)) * (1 << 30))).limit(2 * SAMPLE)
    rows = picked.select("_v").toPandas()["_v"]
    x = unit(np.array(rows.tolist(), float)) if len(rows) else np.zeros((0, 0))
    if not len(rows):
        return np.zeros((0, 0))
    return np.linalg.eigh(x.T @ x)[1][:, ::-1].copy()


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square leaves the range."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows as computed for two vectors alone, in double precision."""
    return (a * b).sum(1) / np.sqrt((a * a).sum(1) * (b * b).sum(1))


@dataclass
class Tile:
    """Vectors of a tile: along the axes, and how long what follows each leading part is."""

    ids: np.ndarray
    copies: np.ndarray
    unit: np.ndarray
    along: np.ndarray
    rest: dict[int, np.ndarray]

    @classmethod
    def of(cls, ids: np.ndarray, copies: np.ndarray, x: np.ndarray, axes: np.ndarray) -> Tile:
        u = unit(x)
        along = u @ axes
        rest = {k: np.sqrt((along[:, k:] ** 2).sum(1)) for k in LEAD if k < axes.shape[0]}
        return cls(ids, copies, u, along, rest)


def linked_pairs(a: Tile, b: Tile, rows: slice) -> tuple[np.ndarray, np.ndarray]:
    """Places ``i, j`` of all pairs of some rows of ``a`` and all of ``b`` with a cosine of ``COSINE`` or more.

    Products of the leading axes are summed first.  The rest of a product is at
    most the product of the suffix norms; pairs that cannot reach the threshold
    are left, and once few are, each of the others is computed in full.
    """
    d, done = a.along.shape[1], 0
    left = a.along[rows]
    total = np.zeros((len(left), len(b.along)))
    for k in [*a.rest, d]:
        total += left[:, done:k] @ b.along[:, done:k].T
        done = k
        near = total >= COSINE - SLACK if k == d else total + a.rest[k][rows][:, None] * b.rest[k][None, :] >= COSINE - SLACK
        if np.count_nonzero(near) * d < 4 * near.size:
            break
    i, j = np.nonzero(near)
    i += rows.start
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), PAIRS):
        s = slice(at, at + PAIRS)
        keep[s] = _cosines(a.unit[i[s]], b.unit[j[s]]) >= COSINE
    return i[keep], j[keep]


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels, each the place of a root, after nodes ``i`` and ``j`` are linked."""
    while True:
        low = np.minimum(label[i], label[j])
        root = np.arange(len(label))
        np.minimum.at(root, label[i], low)
        np.minimum.at(root, label[j], low)
        new = root[label]
        if (new == label).all():
            return label
        label = new


def tile_links(a: Tile, b: Tile) -> list[tuple[int, int, int]]:
    """Per linked vector of two tiles, or of one with itself: one it is connected with, and its links, by copies.

    The tile is worked through in strips; of a strip only counts and labels
    stay, so memory follows the rows of a tile however many links it has.
    """
    same, n = a is b, len(a.ids)
    nodes = a.ids if same else np.concatenate([a.ids, b.ids])
    label, links = np.arange(len(nodes)), np.zeros(len(nodes))
    for at in range(0, n, STRIP):
        i, j = linked_pairs(a, b, slice(at, min(at + STRIP, n)))
        if same:
            i, j = i[i != j], j[i != j]
        if not len(i):
            continue
        links[:n] += np.bincount(i, weights=b.copies[j], minlength=n)
        if not same:
            links[n:] += np.bincount(j, weights=a.copies[i], minlength=len(b.ids))
        label = _joined(label, i, j if same else j + n)
    linked = np.flatnonzero(links)
    return [(int(nodes[k]), int(nodes[label[k]]), int(links[k])) for k in linked]


def _band_links(axes: np.ndarray):
    """Links of each pair of bands: all tiles of the first are held, those of the second pass by."""
    schema = pa.schema([("node", pa.int64()), ("peer", pa.int64()), ("links", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for x, y, second, blob in zip(*[batch.column(k) for k in range(4)]):
                pair, second = (x.as_py(), y.as_py()), second.as_py()
                if pair != now:
                    now, held = pair, []
                tile = Tile.of(*_unpacked(blob.as_py()), axes)
                others = held if second or now[0] != now[1] else [*held, tile]
                if not second:
                    held.append(tile)
                    if now[0] != now[1]:
                        continue
                for other in others:
                    out = tile_links(other, tile)
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)

    return run


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, d, size = (int(k) for k in np.frombuffer(blob, "<i8", 3))
    ids = np.frombuffer(blob, "<i8", n, 24)
    copies = np.frombuffer(blob, "<i8", n, 24 + 8 * n)
    return ids, copies, np.frombuffer(blob, f"<f{size}", n * d, 24 + 16 * n).reshape(n, d).astype(float)


def _packed(ids: np.ndarray, copies: np.ndarray, x: np.ndarray) -> bytes:
    """A tile in one value; components in single precision where that is all they have."""
    short = x.astype("<f4")
    kind = "<f4" if np.array_equal(short.astype(float), x) else "<f8"
    return b"".join([np.array([*x.shape, int(kind[2])], "<i8").tobytes(), ids.astype("<i8").tobytes(),
                     copies.astype("<i8").tobytes(), np.ascontiguousarray(x, kind).tobytes()])


def near_duplicates(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``key, n_links, component_id, kept`` for every row of ``vectors``.

    Rows link when the cosine of their vectors, in double precision, is
    ``COSINE`` or more; ``n_links`` counts the other rows linked directly and
    the component is the smallest key reachable.  Null, empty and zero vectors
    and those with null or non-finite components link with nothing, as do
    vectors of different lengths with each other.  A null key is never the
    smallest; equal rows count one by one; an empty table gives an empty result.

    Equal vectors are one class with a number of copies.  Classes are ordered
    along the first principal axis and cut into tiles, and some tiles in a row
    are a band.  Bands whose ranges on the leading axes lie too far apart are
    never paired; a task compares the tiles of two others.  With g bands a
    vector travels about g times in all.  What a pair of tiles needs and
    returns grows with its rows, not with its links.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, embedding).withColumn(
        "_sig", F.when(F.col("_ok"), F.sha2(F.to_json("_v").cast("binary"), 256)))
    rows = materialise(rows, "vectors")
    alone = rows.select("_id", F.when(F.col("_ok"), F.col("_sig")).alias("_sig"))
    # a vector's place among its copies is not needed: any of them stands for all
    classes = rows.where("_ok").groupBy("_sig").agg(
        F.count("*").alias("_copies"), F.min("_id").alias("_least"), F.first("_v").alias("_v"))
    found = None
    for (dim,) in classes.select(F.size("_v").alias("d")).distinct().collect() if not rows.isEmpty() else []:
        part = _linked_classes(spark, classes.where(F.size("_v") == dim))
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "_sig string, _copies long, _links long, _component long")
    found = materialise(found, "vector-classes")
    named = balanced_lookup(alone, found.withColumn("_weight", F.col("_copies")), ["_sig"], "_weight", ["_id"])
    links = F.coalesce(F.col("_links") + F.col("_copies") - 1, F.lit(0)).cast("long")
    component = F.when(F.col("_sig").isNull(), F.col("_id")).otherwise(F.col("_component"))
    return named.select(F.col("_id").alias(key), links.alias("n_links"), component.alias("component_id"),
                        F.col("_id").eqNullSafe(component).alias("kept"))


def _linked_classes(spark, classes: DataFrame) -> DataFrame:
    """``_sig, _copies, _links, _component`` of distinct vectors of one length."""
    axes = principal_axes(classes)
    shared = spark.sparkContext.broadcast(axes)  # d x d numbers

    @F.pandas_udf("array<double>")
    def lead(v: pd.Series) -> pd.Series:
        p = unit(np.array(v.tolist(), float)) @ shared.value
        return pd.Series(list(p[:, :LEAD[0]]))

    led = materialise(classes.withColumn("_lead", lead("_v")), "vector-axes")
    placed = number_rows(led.withColumn("_x", F.get("_lead", F.lit(0))), [F.asc("_x"), F.asc("_sig")], "_node")
    placed = placed.withColumn("_tile", F.floor(F.col("_node") / TILE))

    def tile(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("_node")
        return pd.DataFrame({"_tile": [batch["_tile"].iloc[0]], "_blob": [_packed(
            batch["_node"].to_numpy(), batch["_copies"].to_numpy(), np.array(batch["_v"].tolist(), float))]})

    tiles = stored(placed.select("_tile", "_node", "_copies", "_v").groupBy("_tile").applyInPandas(tile, "_tile long, _blob binary"), "tiles")
    number = tiles.count()
    wide = max(1, min(BAND, -(-number // _bands(spark.sparkContext.defaultParallelism))))
    band = F.floor(F.col("_tile") / wide)
    boxes = placed.groupBy(band.alias("_band")).agg(*[f(F.get("_lead", F.lit(k))).alias(f"{n}{k}") for k in range(min(LEAD[0], max(1, axes.shape[0])))
                                                      for f, n in ((F.min, "lo"), (F.max, "hi"))])
    pairs = stored(_band_pairs(boxes), "band-pairs")
    sides = pairs.select("x", "y", F.explode(F.when(F.col("x") == F.col("y"), F.array(F.struct(F.col("x").alias("_band"), F.lit(False).alias("second"))))
                                             .otherwise(F.array(F.struct(F.col("x").alias("_band"), F.lit(False).alias("second")),
                                                                F.struct(F.col("y").alias("_band"), F.lit(True).alias("second"))))).alias("s"))
    work = tiles.withColumn("_band", band).join(sides.select("x", "y", "s.*"), "_band")
    work = work.repartition(max(1, pairs.count()), "x", "y").sortWithinPartitions("x", "y", "second", "_tile").select("x", "y", "second", "_blob")
    links = stored(work.mapInArrow(_band_links(axes), "node long, peer long, links long"), "vector-links", tiles, pairs, led)
    counts = links.groupBy("node").agg(F.sum("links").alias("_links"))
    roots = connected_components(links.select(F.col("node").alias("a"), F.col("peer").alias("b")), "vector")
    table = placed.join(counts, F.col("_node") == F.col("node"), "left").drop("node").join(
        roots, F.col("_node") == F.col("node"), "left").select(
        "_sig", "_copies", "_least", F.coalesce("_links", F.lit(0)).alias("_links"), F.coalesce("root", "_node").alias("_root"))
    least = table.groupBy("_root").agg(F.min("_least").alias("_component"))
    return table.join(least, "_root").select("_sig", "_copies", "_links", "_component")


def _bands(cores: int) -> int:
    """So many bands that their pairs are two tasks a core, about."""
    return int(np.ceil(np.sqrt(4 * cores)))


def _band_pairs(boxes: DataFrame) -> DataFrame:
    """Pairs ``x <= y`` of bands whose boxes lie near enough for a link.

    Unit vectors with a cosine of ``COSINE`` are at most ``reach`` apart on any
    axis.  Bands follow the first axis: each meets the cells of width ``reach``
    that it touches, and bands meet in their common or neighbouring cells.
    """
    reach = float(np.sqrt(2 - 2 * COSINE)) + 1e-6
    cell = F.sequence(F.floor(F.col("lo0") / reach), F.floor(F.col("hi0") / reach))
    at = boxes.withColumn("_cell", F.explode(cell))
    near = at.withColumn("_cell", F.explode(F.array(F.col("_cell"), F.col("_cell") + 1, F.col("_cell") - 1)))
    names = [c[2:] for c in boxes.columns if c.startswith("lo")]
    gap = sum((F.greatest(F.lit(0.0), F.col(f"b.lo{k}") - F.col(f"a.hi{k}"), F.col(f"a.lo{k}") - F.col(f"b.hi{k}")) ** 2
               for k in names), F.lit(0.0))
    return at.alias("a").join(near.alias("b"), F.col("a._cell") == F.col("b._cell")).where(
        (F.col("a._band") <= F.col("b._band")) & (gap <= reach ** 2)).select(
        F.col("a._band").alias("x"), F.col("b._band").alias("y")).distinct()
