"""Exact top-k search by a vector-approximation file.

Components become whole numbers, floor(64 x); the score of two vectors is their inner product.
Vectors are dealt by hash into blocks; a block keeps the exact numbers and, in another column,
their cells: every dimension of the block cut into 2^``BITS`` equal parts. A first scan reads cells
only. They bound every score from both sides, and the k-th highest lower bound of any block bounds
the k-th result of the query; it also keeps the best upper bound of every query in every block. Only
blocks where some query's best bound reaches its k-th result are met by that block of queries again:
the second scan takes the vectors whose upper bound reaches it, reads their exact numbers in order of
the bound, and stops as soon as the k-th score is above the next bound. What blocks find is
merged into the k best.

Queries are a stated set of rows; they meet every block, a block of queries at a time, by an
equi-join on the block's number. Only vectors of the same dimension meet. Null vectors and those
with null or non-finite components take no part; a vec_id that is null neither. The k best are
ranked by score, then smaller vec_id; rows that share the query's vec_id are left out, other
repeated rows count each. A query row that is repeated is asked once; of several vectors under one
query's id the results are ranked together. Numbers are whole whatever their size: products below 2^53
are summed as doubles, larger ones as integers of any length. A score that is returned must fit 64
bits, and 64 x must be a finite double; otherwise the query fails.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtlake.llm.common import pick, stored

SCALE, BITS = 64, 5
#: Numbers in a block, and vectors in a block of queries.
BLOCK_CELLS, QUERY_ROWS = 1 << 18, 512
READ_AT_ONCE = 64
#: Doubles hold every whole number below this.
EXACT = float(1 << 53)


def _vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, dim, vector) of the rows that take part."""
    rows = pick(embeddings, "vec_id", "embedding").select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite).withColumn(
        "dim", F.size("vector"))


def _numbers(table: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
    ids = table.column("vec_id").to_numpy()
    dim = int(table.column("dim")[0].as_py())
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        whole = np.floor(SCALE * flat.reshape(len(ids), dim))
    if not np.isfinite(whole).all():
        raise OverflowError(f"{SCALE} x leaves the doubles")
    return ids, whole, dim


def _packed(whole: np.ndarray) -> dict[str, pa.Array]:
    """The numbers as bytes, four a number where that holds them."""
    kind = "i4" if np.abs(whole).max(initial=0) < (1 << 31) else "f8"
    return {"kind": pa.array([kind]), "numbers": pa.array([whole.astype(kind).tobytes()], pa.binary())}


def _unpacked(numbers: bytes, kind: str, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(numbers, kind).reshape(rows, dim).astype(np.float64)


def _products(rows: np.ndarray, wanted: np.ndarray, small: bool) -> np.ndarray:
    """Exact inner products as 64-bit integers."""
    if small:
        return (rows @ wanted).astype(np.int64)
    ints = [int(x) for x in wanted]
    exact = [sum(int(a) * b for a, b in zip(row, ints)) for row in rows]
    if any(abs(x) >= 1 << 63 for x in exact):
        raise OverflowError("a score leaves 64 bits")
    return np.array(exact, np.int64)


def _index_block(key: tuple, table: pa.Table) -> pa.Table:
    ids, whole, dim = _numbers(table)
    order = np.argsort(ids, kind="stable")
    ids, whole = ids[order], whole[order]
    low = whole.min(axis=0)
    step = np.maximum(1, np.ceil(whole.max(axis=0) / (1 << BITS) - low / (1 << BITS) + 1 / (1 << BITS)))
    cells = ((whole - low) // step).astype(np.uint8)
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "block": pa.array([key[1].as_py()], pa.int64()),
        "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
        "cells": pa.array([cells.tobytes()], pa.binary()),
        "grid": pa.array([np.concatenate([low, step]).astype(np.float64).tobytes()], pa.binary()),
        **_packed(whole),
    })


def _query_block(key: tuple, table: pa.Table) -> pa.Table:
    ids, whole, dim = _numbers(table)
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "part": pa.array([key[1].as_py()], pa.int64()),
        "queries": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
        **{{"kind": "asked_kind", "numbers": "wanted"}[k]: v for k, v in _packed(whole).items()},
    })


class _Pair:
    """A block of queries before a block of the index; bounds of all scores from the cells."""

    def __init__(self, row: dict):
        dim = row["dim"]
        self.queries = np.frombuffer(row["queries"], np.int64)
        self.wanted = _unpacked(row["wanted"], row["asked_kind"], len(self.queries), dim)
        self.ids = np.frombuffer(row["ids"], np.int64)
        cells = np.frombuffer(row["cells"], np.uint8).reshape(len(self.ids), dim)
        low, step = np.frombuffer(row["grid"], np.float64).reshape(2, dim)
        least = low + cells * step
        most = least + (step - 1)
        up, down = np.maximum(self.wanted, 0), np.minimum(self.wanted, 0)
        # Whole numbers below 2^53 are exact; beyond it bounds are widened by the rounding.
        self.size = dim * float(np.abs(self.wanted).max(initial=0)) * float(
            max(np.abs(least).max(initial=0), np.abs(most).max(initial=0)))
        slack = 0.0 if self.size < EXACT else self.size * 1e-12
        self.lower = up @ least.T + down @ most.T - slack
        self.upper = up @ most.T + down @ least.T + slack
        own = self.queries[:, None] == self.ids[None, :]
        self.lower[own] = -np.inf
        self.upper[own] = -np.inf

    def kth_lower(self, k: int) -> np.ndarray:
        if self.lower.shape[1] < k:
            return np.full(len(self.queries), -np.inf)
        return np.partition(self.lower, -k, axis=1)[:, -k]

    def best(self, exact: np.ndarray, k: int, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, ids, scores) of what may be among the k best, reading in order of the bound."""
        small = self.size < EXACT
        for q in range(len(self.queries)):
            near = np.flatnonzero(self.upper[q] >= max(least[q], -1e300))
            near = near[np.argsort(-self.upper[q][near], kind="stable")]
            ids, scores, kth = [], [], None
            for at in range(0, len(near), READ_AT_ONCE):
                if kth is not None and self.upper[q][near[at]] < kth:
                    break
                some = near[at : at + READ_AT_ONCE]
                scores.append(_products(exact[some], self.wanted[q], small))
                ids.append(self.ids[some])
                found = np.concatenate(scores)
                if len(found) >= k:
                    kth = np.partition(found, -k)[-k]
            if scores:
                ids, scores = np.concatenate(ids), np.concatenate(scores)
                keep = np.flatnonzero((scores >= least[q]) if kth is None else (scores >= kth))
                keep = keep[np.lexsort((ids[keep], -scores[keep]))][:k]
                yield q, ids[keep], scores[keep]


def top_k(embeddings: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows for each vec_id divisible by ``every``."""
    vectors = _vectors(embeddings)
    rows = F.greatest(F.lit(1), F.least(F.lit(1 << 13), F.lit(BLOCK_CELLS) / F.greatest("dim", F.lit(1))))
    counts = vectors.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("vec_id") % every == 0).cast("long")).alias("asked"),
    ).select("dim", F.ceil(F.col("n") / F.floor(rows)).cast("long").alias("blocks"),
             F.greatest(F.lit(1), F.ceil(F.col("asked") / QUERY_ROWS)).cast("long").alias("parts"))
    counts = stored(counts, "va-counts")
    dealt = vectors.join(counts, "dim")
    index = stored(dealt.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), "blocks")).select(
        "dim", "block", "vec_id", "vector").groupBy("dim", "block").applyInArrow(
        _index_block, "dim int, block long, ids binary, cells binary, grid binary, kind string, numbers binary"),
        "va-index")
    asked = dealt.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "vector"])
    asked = stored(asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts")).select(
        "dim", "part", "vec_id", "vector").groupBy("dim", "part").applyInArrow(
        _query_block, "dim int, part long, queries binary, asked_kind string, wanted binary"), "va-queries")
    met = asked.join(counts, "dim").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks", "parts")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pair = _Pair(row)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["dim"]], pa.int32()), pa.array([row["part"]], pa.int64()),
                    pa.array([row["block"]], pa.int64()), pa.array([pair.kth_lower(k).tolist()], pa.list_(pa.float64())),
                    pa.array([pair.upper.max(axis=1, initial=-np.inf).tolist()], pa.list_(pa.float64()))],
                    ["dim", "part", "block", "least", "most"])

    keys = ["dim", "block"]
    scanned = stored(met.join(index.drop("kind", "numbers"), keys).mapInArrow(
        bound, "dim int, part long, block long, least array<double>, most array<double>"), "va-bounds")
    # The best k-th lower bound of each query over all blocks: as many rows as queries.
    least = scanned.select("dim", "part", F.posexplode("least").alias("place", "least")).groupBy(
        "dim", "part", "place").agg(F.max("least").alias("least"))
    least = least.groupBy("dim", "part").agg(F.sort_array(F.collect_list(F.struct("place", "least"))).alias("least"))
    least = stored(least.select("dim", "part", F.col("least.least").alias("least")), "va-least")
    # Only blocks with a candidate are met again: what the first scan tells is enough to see which.
    hopeful = scanned.drop("least").join(least, ["dim", "part"]).where(F.exists(
        F.zip_with("most", "least", lambda m, b: m >= b), lambda x: x)).drop("most")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pair = _Pair(row)
                exact = _unpacked(row["numbers"], row["kind"], len(pair.ids), row["dim"])
                found = list(pair.best(exact, k, np.array(row["least"])))
                if found:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate([np.full(len(i), pair.queries[q]) for q, i, _ in found])),
                        pa.array(np.concatenate([i for _, i, _ in found])),
                        pa.array(np.concatenate([s for _, _, s in found]))], ["query_id", "vec_id", "score"])

    near = hopeful.join(asked, ["dim", "part"]).join(index, keys).mapInArrow(
        search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
