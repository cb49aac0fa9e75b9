"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import posixpath
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


#: Bytes of a batch that Spark hands to Python, texts and index blocks included.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Batches for Python of at most BATCH_BYTES, or what the session allows if that is less.

    The default of 64 MB is held several times over, in the JVM and in the worker.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).lower().removesuffix("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns, by exact name first: extra columns may differ by case alone.

    Operators start here; their Python stages get bounded batches.
    """
    bounded_batches(df.sparkSession)
    columns = df.columns
    at = []
    for name in names:
        exact = [i for i, c in enumerate(columns) if c == name]
        loose = [i for i, c in enumerate(columns) if c.lower() == name.lower()]
        if not exact + loose:
            raise ValueError(f"no column {name} in {columns}")
        at.append((exact + loose)[0])
    places = df.toDF(*[f"_c{i}" for i in range(len(columns))])
    return places.select(*[F.col(f"_c{i}").alias(n) for i, n in zip(at, names)])


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the table does not use, whatever its case."""
    used = {c.lower() for c in df.columns}
    while base.lower() in used:
        base = f"_{base}"
    return base


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join in which null keys match; the keys are those of the left side."""
    other = {c: free_name(left, f"join_{c}") for c in on}
    renamed = right.select(*[F.col(c).alias(other.get(c, c)) for c in right.columns])
    same = [F.col(c).eqNullSafe(F.col(other[c])) for c in on]
    return left.join(renamed, same, how).drop(*other.values())


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder among those that all executors share."""
    return posixpath.join(shared_dir(spark), f"llm-{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: the lineage ends there."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def trim_memory() -> None:
    """Give back what a worker process keeps of tasks it has done, of this operator or others.

    Workers serve one operator after the other; freed memory stays theirs unless they are told.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(doc_id.cast("string")) % F.lit(folds)


def hashed_sample(df: DataFrame, key: Column, size: int, *ties: str) -> DataFrame:
    """At most ``size`` rows, those with the least hash; about that many are ordered, not all."""
    total = df.count()
    if total > size:
        spare = min(1.0, 1.2 * size / total + 100 / total)
        df = df.where(F.pmod(key, F.lit(1 << 40)) < F.lit(int(spare * (1 << 40))))
    return df.orderBy(F.pmod(key, F.lit(1 << 40)), *ties).limit(size)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int
) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``limit`` bytes of text; a longer text is a piece alone."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        sizes = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(sizes[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def words_of(texts: Sequence[str | bytes | None]) -> tuple[list, np.ndarray, np.ndarray]:
    """Distinct words, every word as a number into them, and the number of words per text."""
    import pandas as pd

    split = [t.split() if t else () for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    flat = np.empty(int(counts.sum()), dtype=object)
    at = 0
    for words in split:
        flat[at : at + len(words)] = words
        at += len(words)
    codes, unique = pd.factorize(flat)
    return list(unique), codes, counts


def offsets_of(counts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit numbers that scatters them."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


# ── Connected components ──


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the least node reachable from every node that has an edge.

    ``edges`` has columns a and b. Alternating large-star and small-star steps: every step
    hooks the neighbours of a node to the least one, as a join with a per-node minimum that is
    combined in each task first, so a star around a hot node is split by the skew join instead
    of gathered. The forest is checkpointed after each round; it ends when no edge moves.
    """
    shared_dir(edges.sparkSession)
    links = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct().checkpoint()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first())

    before = mark(links)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = links.union(links.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = hooked.union(down.select("u", F.col("m").alias("v")))
        links = links.where("u <> v").distinct().checkpoint()
        after = mark(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = links.groupBy("u").agg(F.min("v").alias("component"))
    stars = roots.select(F.col("u").alias("node"), "component")
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
