"""Near-duplicate vectors by int8 tile products with error bounds.

Equal vectors collapse to one class first. A class is coded in one byte per component, with a scale and a bound on the
length of what the coding has changed. The product of two codes is exact in whole numbers, so the cosine of two vectors
lies within a distance of it that follows from their two bounds. A tile product gives these intervals for all pairs of
two tiles; only pairs whose interval holds the threshold are computed again from the vectors themselves.

All classes of one length are compared with each other at every size, so a link depends on its two vectors alone. They
are worked off in blocks, a pair of blocks to a group; how many blocks there are decides on memory and tasks, not on
results. Nothing is put out per pair: a group returns sums of links per class and a spanning forest, so thousands of
copies of one vector stay linear. The products grow with the square of the number of classes.

A caller who would rather lose some links than wait may ask for cells. A cell holds the classes on the same sides of some
random planes, and only classes of one cell are compared. How many planes, and how many times the space is cut anew,
follows from the number of classes, such that a pair at the threshold shares a cell with a probability of at least
``recall``, and a closer pair with more.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.common import on_workers, written
from skyledger.llm.components import components

COSINE = 0.9
# Least probability that a pair at the threshold is compared, for a caller who asks for cells.
RECALL = 0.999
# Classes of a cell on average, where cells are asked for, and of a tile.
CELL, TILE = 16_384, 1_024
# Components of the vectors of a block on average at most, and blocks of more than a tile at least, so that tasks can share.
BLOCK_VALUES, LEAST_BLOCKS = 1 << 22, 8
SEED = 20240301
# What sums and products in double precision may be off by, for unit vectors.
ROUNDING = 1e-9


def cuttings(n: int, cosine: float = COSINE, recall: float = RECALL, cell: int = CELL) -> tuple[int, int]:
    """(planes, cuttings): planes until a cell holds about ``cell`` of ``n``, cuttings until the recall is reached."""
    planes = max(0, math.ceil(math.log2(max(1, n) / cell)))
    same = (1 - math.acos(cosine) / math.pi) ** planes
    return planes, 1 if planes == 0 else math.ceil(math.log(1 - recall) / math.log(1 - same))


def _directions(dim: int, planes: int, cuts: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, cuts * planes))


def _unit(vector: np.ndarray) -> np.ndarray | None:
    """The vector at length 1 in double precision; None for one without a direction."""
    vector = vector.astype(np.float64)
    if not len(vector) or not np.isfinite(vector).all():
        return None
    largest = np.abs(vector).max()
    if largest == 0:
        return None
    vector = vector / largest
    return vector / math.sqrt(float(vector @ vector))


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and bounds on the distance of scale times code from the unit vector."""
    scale = np.abs(units).max(1) / 127
    codes = np.rint(units / scale[:, None]).astype(np.int8)
    off = units - codes * scale[:, None]
    return codes, scale, np.sqrt((off * off).sum(1)) + ROUNDING


def _fingerprints(vectors: DataFrame, kind: type) -> DataFrame:
    """(vec_id, print, vector): a checksum of the values and their bytes, null for a vector without a direction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            known = lists.is_valid().to_numpy(zero_copy_only=False)
            ends = lists.offsets.to_numpy()
            values = lists.values
            gaps = values.is_null().to_numpy(zero_copy_only=False)
            values = values.to_numpy(zero_copy_only=False).astype(np.float64)
            prints, raw = [], []
            for i in range(len(lists)):
                own = slice(ends[i], ends[i + 1])
                unit = _unit(values[own]) if known[i] and not gaps[own].any() else None
                # Adding zero turns a minus zero into a plain one.
                data = None if unit is None else (values[own] + 0.0).astype(kind).tobytes()
                raw.append(data)
                prints.append(None if data is None else hashlib.blake2b(data, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.binary()), pa.array(raw, pa.binary())],
                names=["vec_id", "print", "vector"])

    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(
        run, "vec_id bigint, print binary, vector binary")


_CODED = "node struct<id:bigint,print:binary>, copies bigint, vector binary, dim int, codes binary, scale double, off double, cells array<int>"


def _coded(classes: DataFrame, planes: int, cuts: int, seed: int, kind: type) -> DataFrame:
    """Adds codes, scale, bound and the cell of each cutting to the classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors = [np.frombuffer(v, kind) for v in batch.column(2).to_pylist()]
            dims = np.array([len(v) for v in vectors], np.int32)
            codes, cells = [b""] * len(vectors), np.zeros((len(vectors), cuts), np.int32)
            scales, offs = np.zeros(len(vectors)), np.zeros(len(vectors))
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                units = np.stack([_unit(vectors[i]) for i in at])
                own, scales[at], offs[at] = quantise(units)
                if dim not in known:
                    known[dim] = _directions(dim, planes, cuts, seed)
                sides = (units @ known[dim] >= 0).reshape(len(at), cuts, planes)
                cells[at] = (sides << np.arange(planes)).sum(2)
                for k, i in enumerate(at):
                    codes[i] = own[k].tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(2), pa.array(dims), pa.array(codes, pa.binary()),
                pa.array(scales), pa.array(offs), pa.ListArray.from_arrays(
                    pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * cuts), pa.array(cells.reshape(-1)))],
                names=["node", "copies", "vector", "dim", "codes", "scale", "off", "cells"])

    return classes.select("node", "copies", "vector").mapInArrow(run, _CODED)


def _in_blocks(coded: DataFrame, block: int | None) -> DataFrame:
    """Every class once for each cutting and each pair of blocks of its cell that it takes part in."""
    if block is None:
        size = F.col("size")
        blocks = F.when(size > TILE, F.greatest(F.lit(LEAST_BLOCKS), F.ceil(size * F.col("dim") / BLOCK_VALUES))).otherwise(1)
    else:
        blocks = F.ceil(F.col("size") / block)
    placed = coded.select("*", F.posexplode("cells").alias("cut", "cell"))
    sizes = placed.groupBy("cut", "dim", "cell").agg(F.count(F.lit(1)).alias("size"))
    full = written(sizes.select("cut", "dim", "cell", blocks.cast("int").alias("blocks")).where("blocks > 1"), "cells")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return (
        placed.join(full, ["cut", "dim", "cell"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    )


class _Side:
    """The classes of one block, those of a cell of an earlier cutting or else of like scales side by side."""

    def __init__(self, rows: pa.Table, dim: int, cut: int, kind: type):
        flat = lambda name, kind: np.frombuffer(b"".join(rows[name].to_pylist()), kind).reshape(len(rows), dim)
        cells = rows["cells"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
        scale = rows["scale"].to_numpy()
        self.order = np.lexsort(cells[:, :cut].T[::-1]) if cut else np.argsort(scale, kind="stable")
        self.cells = cells[self.order, :cut]
        self.codes = flat("codes", np.int8)[self.order]
        self.scale = scale[self.order]
        self.off = rows["off"].to_numpy()[self.order]
        self.vectors = flat("vector", kind)[self.order]
        self.copies = rows["copies"].to_numpy()[self.order]

    def units(self, at: np.ndarray) -> np.ndarray:
        vectors = self.vectors[at].astype(np.float64)
        vectors /= np.abs(vectors).max(1)[:, None]
        return vectors / np.sqrt((vectors * vectors).sum(1))[:, None]


def _linked(a: _Side, b: _Side, i: slice, j: slice, same: bool, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two tiles whose cosine reaches the threshold and that no earlier cutting has compared."""
    first, last = a.cells[i], b.cells[j]
    if ((first == first[0]).all(0) & (last == first[0]).all(0)).any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Up to 1,040 components the sums of a tile product are whole numbers that single precision holds exactly.
    kind = np.float32 if a.codes.shape[1] * 127 ** 2 < 1 << 24 else np.float64
    product = a.codes[i].astype(kind) @ b.codes[j].astype(kind).T
    # The least product that any pair of these tiles may need, in a first look over all of them.
    off = a.off[i].max() + b.off[j].max() * (1 + a.off[i].max())
    least = (cosine - off - ROUNDING) / (a.scale[i].max() * b.scale[j].max())
    near = np.flatnonzero(product.reshape(-1) >= np.nextafter(kind(least), kind(-np.inf)))
    x, y = near // product.shape[1], near % product.shape[1]
    if same:
        x, y = x[(keep := x < y)], y[keep]
        near = near[keep]
    about = product.reshape(-1)[near].astype(np.float64) * a.scale[i][x] * b.scale[j][y]
    off = a.off[i][x] + b.off[j][y] * (1 + a.off[i][x]) + ROUNDING
    possible = about + off >= cosine
    for cut in range(first.shape[1]):
        possible &= first[x, cut] != last[y, cut]
    x, y, about, off = x[possible], y[possible], about[possible], off[possible]
    sure = about - off >= cosine
    open_ = np.flatnonzero(~sure)
    for at in range(0, len(open_), 1 << 16):
        part = open_[at:at + (1 << 16)]
        sure[part] = (a.units(x[part] + i.start) * b.units(y[part] + j.start)).sum(1) >= cosine
    return x[sure] + i.start, y[sure] + j.start


class _Forest:
    """Components of the rows of a group, as a label per row: the smallest row that it is linked with."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, x: np.ndarray, y: np.ndarray) -> None:
        label = self.label
        while len(x):
            u, v = label[x], label[y]
            apart = u != v
            if not apart.any():
                return
            x, y, u, v = x[apart], y[apart], u[apart], v[apart]
            np.minimum.at(label, np.maximum(u, v), np.minimum(u, v))
            while not np.array_equal(label, label[label]):
                label[:] = label[label]


_FOUND = T.StructType([
    T.StructField("node", T.StructType([T.StructField("id", T.LongType()), T.StructField("print", T.BinaryType())])),
    T.StructField("root", T.StructType([T.StructField("id", T.LongType()), T.StructField("print", T.BinaryType())])),
    T.StructField("links", T.LongType()),
])


def _compare(cosine: float, kind: type):
    def run(rows: pa.Table) -> pa.Table:
        cut, dim = rows["cut"][0].as_py(), rows["dim"][0].as_py()
        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        own = rows["own"].to_numpy()
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        a = _Side(rows.take(pa.array(left)), dim, cut, kind)
        b = a if low == high else _Side(rows.take(pa.array(right)), dim, cut, kind)
        places = left[a.order] if low == high else np.concatenate([left[a.order], right[b.order]])
        shift = 0 if low == high else len(left)
        links = np.zeros(len(places), np.int64)
        forest = _Forest(len(places))
        for i in range(0, len(a.order), TILE):
            for j in range(i if low == high else 0, len(b.order), TILE):
                x, y = _linked(
                    a, b, slice(i, min(i + TILE, len(a.order))), slice(j, min(j + TILE, len(b.order))),
                    low == high and i == j, cosine)
                if len(x):
                    np.add.at(links, x, b.copies[y])
                    np.add.at(links, y + shift, a.copies[x])
                    forest.link(x, y + shift)
        found = np.flatnonzero((links > 0) | (forest.label != np.arange(len(places))))
        nodes = rows["node"].combine_chunks()
        return pa.table({
            "node": nodes.take(pa.array(places[found])),
            "root": nodes.take(pa.array(places[forest.label[found]])), "links": pa.array(links[found])})

    return run


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, cell: int | None = None,
    block: int | None = None, seed: int = SEED,
) -> DataFrame:
    """(vec_id, n_links, component_id) for every row of ``vectors`` (vec_id, embedding).

    ``n_links`` counts the other rows at a cosine of ``cosine`` or more, ``component_id`` is the smallest id reachable.
    Only a caller who gives ``cell`` has the search narrowed to cells of about so many classes, with ``recall`` at the
    threshold; else all pairs are compared. ``block`` is the number of classes in a block. Vectors that are null, empty or zero, or hold null or non-finite components, have no links
    and are alone; so are rows with a null id, whose component is null. Vectors of different lengths are not compared.
    Rows that share an id each count with the vector of their own; equal rows link with each other. An empty table
    gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    on_workers(spark)
    single = vectors.schema["embedding"].dataType.elementType == T.FloatType()
    kind = np.float32 if single else np.float64
    rows = written(_fingerprints(vectors, kind), "vectors")
    usable = F.col("print").isNotNull() & F.col("vec_id").isNotNull()
    classes = written(
        rows.where(usable).groupBy("print").agg(
            F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")).select(
            F.struct("id", "print").alias("node"), "copies", "vector"), "classes")
    planes, cuts = (0, 1) if cell is None else cuttings(classes.count(), cosine, recall, cell)
    coded = written(_coded(classes, planes, cuts, seed, kind), "coded")
    found = written(_in_blocks(coded, block).groupBy("cut", "dim", "cell", "low", "high").applyInArrow(
        _compare(cosine, kind), _FOUND), "links")
    linked = components(found.where("node <> root").select(F.col("root").alias("u"), F.col("node").alias("v")))
    per_class = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        classes.select("node", "copies").join(per_class, "node", "left").join(linked, "node", "left")
        .select(
            F.col("node.print").alias("print"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component.id", "node.id").alias("component_id")))
    own = rows.select("vec_id", F.when(usable, F.col("print")).alias("print"))
    return own.join(named, "print", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))


def drop_near_duplicates(vectors: DataFrame, **bounds: float) -> DataFrame:
    """The rows of ``vectors`` whose id names their component, equal ones once; rows with a null id stay."""
    alone = vectors.where("vec_id IS NULL")
    kept = near_duplicates(vectors, **bounds).where("vec_id = component_id").select("vec_id").distinct()
    return vectors.join(kept, "vec_id", "left_semi").dropDuplicates(["vec_id", "embedding"]).unionByName(alone)
