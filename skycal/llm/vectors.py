"""Near-duplicate vectors by an exact metric range join: pivots partition the vectors, the triangle
inequality decides which of them are copied across a boundary, and cells join independently."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skycal.llm.shared import Store, components

BLOCK = 2048           # vectors of a cell that one task compares with as many others
PER_PIVOT = 4096       # vectors for each pivot
MAX_PIVOTS = 512       # all tasks are sent the pivots, so their number is bounded
SLACK = 1e-6           # added to the radius, so that rounding loses no pair


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), width)


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)      # no square overflows or vanishes
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _united(a: np.ndarray, b: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """roots after a[i] and b[i] were united: every index points at the smallest of its set."""
    while len(a):
        x, y = roots[a], roots[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(roots, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := roots[roots], roots):
            roots = up
    return roots


def _pivots(points: DataFrame) -> dict[int, np.ndarray]:
    """Unit pivots by vector length: the points that a hash orders first, MAX_PIVOTS at most."""
    k = min(MAX_PIVOTS, max(1, math.ceil(points.count() / PER_PIVOT)))
    rows = points.orderBy(F.xxhash64("node"), "node").limit(k).select("v").collect()
    by_width: dict[int, list] = {}
    for r in rows:
        by_width.setdefault(len(r.v), []).append(r.v)
    return {w: _unit(np.array(v, dtype=np.float64)) for w, v in by_width.items()}


def _assigned(points: DataFrame, pivots: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """Each point once in the cell of its nearest pivot (home) and once in every cell that may hold one of its
    links: a link's home p is no farther from it than h is, so it lies beyond the bisector of h and p."""
    radius = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK

    def run(batches):
        for batch in batches:
            widths = np.asarray(batch.column("width"))
            for w in np.unique(widths):
                part = batch.filter(pa.array(widths == w))
                p = pivots.get(int(w))
                if p is None:
                    p = np.eye(1, int(w))
                x = _unit(_matrix(part.column("v"), int(w)))
                square = np.maximum(0, 2 - 2 * x @ p.T)
                home = square.argmin(axis=1)
                between = np.sqrt(np.maximum(0, 2 - 2 * p @ p.T))[home]
                reach = (square - square[np.arange(len(x)), home][:, None]) <= 2 * between * radius + SLACK
                reach[np.arange(len(x)), home] = True
                row, cell = np.nonzero(reach)
                out = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(cell.astype(np.int32)), pa.array(cell == home[row])],
                    names=[*out.schema.names, "cell", "home"])

    kind = points.schema["v"].dataType.simpleString()
    return points.mapInArrow(run, f"node bigint, label string, v {kind}, n bigint, width int, cell int, home boolean")


def _compared(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        home = np.asarray(group.column("role")) == 1
        nodes, n = np.asarray(group.column("node")), np.asarray(group.column("n"))
        w = group.column("width")[0].as_py()
        x = _unit(_matrix(group.column("v").chunk(0), w))
        hx, mx, hn, mn = x[home], x[~home], nodes[home], nodes[~home]
        close = (hx @ mx.T >= threshold) & (hn[:, None] != mn[None, :])
        counts = close.astype(np.float64) @ n[~home].astype(np.float64)
        ids, place = np.unique(np.concatenate([hn, mn]), return_inverse=True)
        i, j = np.nonzero(close)
        roots = _united(place[i], place[len(hn) + j], np.arange(len(ids)))
        apart = roots != np.arange(len(ids))
        return pa.table({
            "a": np.concatenate([hn, ids[apart]]),
            "b": pa.array([None] * len(hn), pa.int64()).take(pa.array(np.arange(len(hn)))) if not apart.any()
            else pa.array(np.concatenate([np.zeros(len(hn), np.int64), ids[roots[apart]]]),
                          mask=np.concatenate([np.ones(len(hn), bool), np.zeros(apart.sum(), bool)])),
            "links": np.concatenate([counts, np.zeros(apart.sum())]).astype(np.int64)})
    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", block: int = BLOCK) -> DataFrame:
    """One row per vector: id, n_links (other vectors of the same label at cosine >= threshold), component (the
    smallest id reachable by links), kept (it is that id).

    Equal vectors of a label collapse first and count as often as they occur. Vectors that are null, empty or
    zero, hold a null or a non-finite component, or have no label link with nothing; so do vectors of different
    lengths. Repeated rows are vectors of their own; a row without an id links but names no component. An empty
    table gives an empty one; further columns are ignored. No cell is gathered: home vectors meet the others of
    their cell in blocks."""
    store = Store(vectors.sparkSession, "vectors")
    v = F.col(vector_col)
    fine = F.coalesce(~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
                      & F.exists(v, lambda x: x != 0), F.lit(False)) & F.col(label_col).isNotNull()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), v.alias("v"), fine.alias("fine"))
    points = store.put(
        rows.where("fine").groupBy("label", "v").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .withColumn("node", F.monotonically_increasing_id()), "points")
    keyed = points.select("node", "label", "v", "n", F.size("v").alias("width"))
    cells = store.put(_assigned(keyed, _pivots(points), threshold), "cells")
    key = ["label", "width", "cell"]
    sizes = cells.groupBy(*key).agg(
        F.ceil(F.sum(F.col("home").cast("int")) / block).cast("int").alias("homes"),
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("members")).where("homes > 0")
    sized = cells.join(sizes, key).withColumn("h", F.xxhash64("node"))
    own = lambda k: F.pmod("h", F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    left = sized.where("home").select(*key, "node", "n", "v", own("homes").alias("hb"), every("members").alias("mb"), F.lit(1).alias("role"))
    right = sized.select(*key, "node", "n", "v", every("homes").alias("hb"), own("members").alias("mb"), F.lit(0).alias("role"))
    found = store.put(
        left.unionByName(right).groupBy(*key, "hb", "mb").applyInArrow(_compared(threshold), "a bigint, b bigint, links bigint"), "found")
    store.drop("cells")
    counts = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    parts = components(found.where("b is not null").select("a", "b"), store)
    named = (points.join(parts, "node", "left").withColumn("root", F.coalesce("component", "node")).drop("component"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component"))
    told = named.join(lowest, "root").join(counts.withColumnRenamed("a", "node"), "node", "left").select(
        "label", "v", "component", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    linked = rows.where("fine").join(told, ["label", "v"]).select("id", "n_links", "component")
    alone = rows.where("NOT fine").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"))
    return linked.union(alone).select(
        F.col("id").alias(id_col), "n_links", "component", F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))
