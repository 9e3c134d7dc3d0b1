"""Embedding near-duplicates by int8 tile products with quantisation error bounds (operator 10).

Vectors with equal labels are compared. Vectors that are equal are one item with a count from here on. Items of a
label are dealt into blocks of bounded size, and a tile, two blocks of one label, is a task's work: all
products of the blocks' int8 codes, by one matrix product (exact in float32 as long as a product stays below 2^24).

For a unit vector x with codes q, scale s and error e = x - s q, the product of two vectors differs from the
product of their codes by ``s q.f + e.(t r) + e.f`` in obvious notation, so by at most ``|sq| |f| + |e| |tr| + |e| |f|``
(Cauchy-Schwarz). The norms are computed in double precision and enlarged by ``SLACK``, which covers rounding. Pairs whose
product of codes plus this bound reaches the threshold are computed again in double precision from the full vectors;
no other pair can reach it. A tile returns counts and, for each component inside it, a star of links, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.components import components
from panelscope.llm.stash import stash

SLACK = 1e-9
BLOCK_ROWS = 1024


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and upper bounds of |s q| and |x - s q|, of unit vectors (rows, double)."""
    top = np.abs(vectors).max(axis=1)
    scales = np.where(top > 0, top, 1.0) / 127.0
    codes = np.rint(vectors / scales[:, None]).astype(np.int8)
    back = codes.astype(np.float64) * scales[:, None]
    return codes, scales, np.linalg.norm(back, axis=1) * (1 + SLACK) + SLACK, np.linalg.norm(vectors - back, axis=1) * (1 + SLACK) + SLACK


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def possible(a: tuple, b: tuple, threshold: float) -> np.ndarray:
    """Pairs of rows of ``a`` and ``b`` (as :func:`quantise` returns them) whose product may reach the threshold."""
    qa, sa, na, ea = a
    qb, sb, nb, eb = b
    products = np.zeros((len(qa), len(qb)))
    step = (1 << 24) // (127 * 127)  # so many terms are exact in float32
    for k in range(0, qa.shape[1], step):
        products += qa[:, k:k + step].astype(np.float32) @ qb[:, k:k + step].astype(np.float32).T
    bound = na[:, None] * eb[None, :] + ea[:, None] * (nb + eb)[None, :]
    return products * (sa[:, None] * sb[None, :]) + bound + SLACK >= threshold


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs of rows (unit vectors, double) whose cosine reaches the threshold."""
    out = possible(quantise(a), quantise(b), threshold)
    i, j = np.nonzero(out)
    for k in range(0, len(i), 1 << 16):
        x, y = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
        out[x, y] = np.einsum("ij,ij->i", a[x], b[y]) >= threshold
    return out


def _stars(matrix: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A link to the least item of its component, for each item that the matrix links to another."""
    items, where = np.unique(np.concatenate([left, right]), return_inverse=True)
    low = np.arange(len(items))
    i, j = np.nonzero(matrix)
    a, b = where[i], where[len(left) + j]
    while True:
        before = low.copy()
        np.minimum.at(low, a, low[b])
        np.minimum.at(low, b, low[a])
        low = low[low]
        if np.array_equal(before, low):
            break
    moved = np.flatnonzero(low != np.arange(len(items)))
    return items[moved], items[low[moved]]


def _usable(vectors: DataFrame) -> DataFrame:
    """(_row .. label, item key, bytes): a null key for vectors that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for x in batch.column(2):
                values = x.as_py()
                v = None
                if values and all(y is not None for y in values):
                    v = np.array(values, np.float64)
                    v = v if np.isfinite(v).all() and np.any(v) and np.isfinite(np.linalg.norm(v)) and np.linalg.norm(v) > 0 else None
                packed.append(None if v is None else v.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["vec_id", "label", "vector"])

    return vectors.mapInArrow(run, "vec_id long, label string, vector binary")


def near_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = 0.98) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors are linked if their labels are equal and not null and their cosine in double precision is at least
    ``threshold``. n_links counts the other vectors linked directly, component_id is the smallest id that links reach.

    Edge cases: null, empty and zero vectors, vectors with null or non-finite components, and vectors of a null label link with
    nothing, and vectors of different lengths not with each other; equal vectors of a label are linked; a null id takes part,
    and its component is the smallest id of the others (null if there is none); repeated ids are a row each; no rows give no
    rows; other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v"))
    ready = _usable(rows)
    item = F.when(F.col("label").isNotNull() & F.col("vector").isNotNull(),
                  F.concat(F.unhex(F.md5(F.concat_ws(":", F.lit("label"), "label"))), F.unhex(F.md5("vector"))))
    ready = stash(ready.withColumn("item", item))
    items = ready.where("item is not null").groupBy("item").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("n"))
    items = stash(items.withColumn("size", F.length("vector")))
    parts = items.groupBy("label", "size").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS)).cast("int").alias("parts"))
    dealt = items.join(parts, ["label", "size"]).withColumn("part", F.pmod(F.xxhash64("item"), F.col("parts")).cast("int"))
    meets = dealt.select("item", "vector", "n", "label", "size", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    tiles = meets.select("label", "size", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"),
                         (F.col("part") <= F.col("other")).alias("first"), "item", "vector", "n")

    def run(table: pa.Table) -> pa.Table:
        n = table.column("n").to_numpy()
        ids = np.array(table.column("item").to_pylist(), object)
        units = unit(np.frombuffer(b"".join(table.column("vector").to_pylist()), "<f8").reshape(len(ids), -1))
        first = np.array(table.column("first").to_pylist(), bool)
        left = np.flatnonzero(first)
        same = table.column("a")[0].as_py() == table.column("b")[0].as_py()
        right = left if same else np.flatnonzero(~first)
        hit = linked(units[left], units[right], threshold)
        if same:
            np.fill_diagonal(hit, False)
        links = np.zeros(len(ids), np.int64)
        links[left] += hit @ n[right]
        if not same:
            links[right] += hit.T @ n[left]
        u, v = _stars(hit, left, right)
        root = np.arange(len(ids))
        root[u] = v
        some = np.flatnonzero(links)
        return pa.table({"u": pa.array(ids[some].tolist(), pa.binary()), "v": pa.array(ids[root[some]].tolist(), pa.binary()), "links": pa.array(links[some], pa.int64())})

    found = stash(tiles.groupBy("label", "size", "a", "b").applyInArrow(run, "u binary, v binary, links long"))
    counts = found.groupBy("u").agg(F.sum("links").alias("links"))
    roots = components(found.select("u", "v"))
    per_item = (items.select("item", "n").join(counts.withColumnRenamed("u", "item"), "item", "left")
                .join(roots.withColumnRenamed("id", "item"), "item", "left")
                .select("item", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "item").alias("root")))
    placed = ready.select("vec_id", "item").join(per_item, "item", "left")
    least = placed.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("least"))
    out = placed.join(least, "root", "left").withColumn("component_id", F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("least")))
    return out.select(F.col("vec_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                      F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
