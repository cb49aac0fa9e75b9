"""Shards by a Feistel permutation of global row numbers; DataFrame functions only.

Rows are numbered 0 to N - 1 in the order of (doc_id, bytes of text, checksum, hash of the row).
A number is written as two digits in base ``side``, the least whole number whose square holds N,
and ``ROUNDS`` rounds add a keyed function of one digit to the other: a permutation of side^2
numbers. Results of N or more walk on along their cycle until they are below N, which makes it a
permutation of 0 to N - 1. At most side^2 - N < 2 sqrt(N) + 1 numbers lie outside, so few rows
walk, and no walk is longer than that; the rounds are whole-stage code, walks are not.

A permuted number p puts its row into shard p mod shards, slot p div shards: shard sizes are at
most one apart, slots have no gap, and both follow from row number, N and seed alone (``locate``).

The numbers depend on the rows and not on files or partitions. Null texts have no bytes, null ids
come first. Rows that are equal in all columns are interchangeable; maps take no part in that
comparison. An empty table has no rows in its shards. Other columns, whatever their names, travel
inside one struct column; there a name that repeats an earlier one but for case gets an underscore.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.llm.common import mix64, pick
from courtlake.llm.ranking import ranked

SHARDS, SEED, ROUNDS = 40, 20_240_601, 6
OVERHEAD = 16
#: The keyed function is a cubic polynomial modulo this prime.
PRIME = (1 << 31) - 1
ROWS_PER_FILE = 200_000
SHORT_WALK = 8


def round_keys(seed: int) -> list[tuple[int, int, int]]:
    """Three numbers below PRIME for every round, the first of them not 0."""
    drawn = mix64(np.arange(3 * ROUNDS, dtype=np.uint64) + np.uint64(seed % (1 << 63)))
    numbers = [int(x) % (PRIME - 1) + 1 for x in drawn]
    return [tuple(numbers[i : i + 3]) for i in range(0, 3 * ROUNDS, 3)]


def side_of(total: int) -> int:
    return math.isqrt(total - 1) + 1 if total else 1


def _digits(number: Column, side: int) -> tuple[Column, Column]:
    return F.call_function("div", number, F.lit(side).cast("long")), number % side


def _turned(left: Column, right: Column, line: Column, shift: Column | int, side: int) -> Column:
    # Below 2^62 throughout, as digits and keys are below 2^31.
    mixed = (line * line % PRIME) * ((right + shift) % PRIME) % PRIME
    return (left + mixed) % side


def _permuted(number: Column, side: int, keys: list[tuple[int, int, int]]) -> Column:
    """The permutation inside one expression, for the few numbers that walk."""
    left, right = _digits(number, side)
    rounds = F.array(*[F.struct(*[F.lit(x).cast("long").alias(n) for x, n in zip(k, "abc")]) for k in keys])

    def one(s: Column, k: Column) -> Column:
        line = (s["right"] * k["a"] + k["b"]) % PRIME
        return F.struct(s["right"].alias("left"), _turned(s["left"], s["right"], line, k["c"], side).alias("right"))

    return F.aggregate(rounds, F.struct(left.alias("left"), right.alias("right")), one,
                       lambda s: s["left"] * F.lit(side).cast("long") + s["right"])


def permute(rows: DataFrame, number: str, total: int, seed: int = SEED, out: str = "permuted") -> DataFrame:
    """``rows`` with ``out``: the permutation of 0 to ``total`` - 1 at ``number``."""
    side, keys = side_of(total), round_keys(seed)
    outside = side * side - total
    left, right = _digits(F.col(number).cast("long"), side)
    found = rows.withColumns({"_left": left, "_right": right})
    # A projection per round: one expression would repeat each round in the next one, three times over.
    for a, b, c in keys:
        found = found.withColumn("_line", (F.col("_right") * F.lit(a) + F.lit(b)) % PRIME).withColumns({
            "_left": F.col("_right"),
            "_right": _turned(F.col("_left"), F.col("_right"), F.col("_line"), F.lit(c), side)})
    found = found.withColumn(out, F.col("_left") * F.lit(side).cast("long") + F.col("_right")).drop("_left", "_right", "_line")
    if not outside:
        return found

    def walk(start: Column, steps: Column) -> Column:
        onward = lambda at: F.when(at < total, at).otherwise(_permuted(at, side, keys))
        return F.aggregate(F.sequence(F.lit(1).cast("long"), steps), start, lambda at, _: onward(at))

    for steps in sorted({min(SHORT_WALK, outside), outside}):
        # A number outside is at least ``total``, which is no less than ``outside`` steps: the bound
        # is a column only so that the plan holds no literal of that many numbers.
        limit = F.least(F.lit(steps).cast("long"), F.col(out))
        found = found.withColumn(out, F.when(F.col(out) < total, F.col(out)).otherwise(walk(F.col(out), limit)))
    return found


def locate(number: int, total: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """Shard and slot of one row number, without any table."""
    side, keys = side_of(total), round_keys(seed)
    while True:
        left, right = divmod(number, side)
        for a, b, c in keys:
            line = (right * a + b) % PRIME
            left, right = right, (left + (line * line % PRIME) * ((right + c) % PRIME) % PRIME) % side
        number = left * side + right
        if number < total:
            return number % shards, number // shards


def place(documents: DataFrame, shards: int = SHARDS, seed: int = SEED, whole: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard, slot of every row; ``whole`` adds the row itself.

    Without ``whole`` no text leaves its task: about 30 bytes a row are sorted.
    """
    plain = [f"c{i}" for i in range(len(documents.columns))]
    hashed = [c for c, kind in zip(plain, documents.dtypes) if "map<" not in kind[1]]
    pick(documents, "doc_id", "text")  # raises without them
    at = {n: f"c{_position(documents, n)}" for n in ("doc_id", "text")}
    body = F.coalesce(F.col(at["text"]), F.lit(""))
    measured = documents.toDF(*plain).select(
        F.col(at["doc_id"]).alias("doc_id"), (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(*hashed).alias("row_hash"),
        *([F.struct(*[F.col(c).alias(n) for c, n in zip(plain, _distinct(documents.columns))]).alias("row")]
          if whole else []))
    numbered = ranked(measured, ["doc_id", "size", "text_crc32", "row_hash"])
    # One number: how many rows there are.
    total = numbered.agg(F.max("total")).first()[0] or 0
    found = permute(numbered.withColumnRenamed("index", "row_number"), "row_number", total, seed)
    return found.select(
        "doc_id", "size", "text_crc32", "row_number",
        (F.col("permuted") % shards).cast("int").alias("shard"),
        F.call_function("div", F.col("permuted"), F.lit(shards).cast("long")).alias("slot"),
        *(["row"] if whole else []))


def _position(documents: DataFrame, name: str) -> int:
    columns = documents.columns
    return columns.index(name) if name in columns else [c.lower() for c in columns].index(name)


def _distinct(names: list[str]) -> list[str]:
    """Names that a file can hold: one that an earlier name equals but for case gets underscores."""
    out: list[str] = []
    for name in names:
        while name.lower() in {n.lower() for n in out}:
            name += "_"
        out.append(name)
    return out


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Files of (slot, row) in a folder per shard, slots in order; a shard is split over files."""
    found = place(documents, shards, seed, whole=True).select("shard", "slot", "row")
    part = F.call_function("div", F.col("slot"), F.lit(ROWS_PER_FILE).cast("long"))
    found.withColumn("part", part).repartition("shard", "part").sortWithinPartitions(
        "shard", "slot").drop("part").write.partitionBy("shard").parquet(path)


def read_shard(spark: SparkSession, path: str, shard: int) -> DataFrame:
    """The rows of one shard as they were, with their slots; only its folder is read."""
    return spark.read.parquet(path).where(F.col("shard") == shard).select("slot", "row")


def shard_digest(documents: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``place`` with the law it keeps: numbers of rows at most one apart."""
    return place(documents, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number")
