"""Rows of a batch that a table does not hold yet, each key once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlake.operators.pruning import within_span
from courtlake.session import shared_dir

#: Repeated keys that are sent to every task, at most, so that the other rows need not be shuffled.
SENT_KEYS = 1_000_000


def least_per_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key: the least of the remaining columns stands.

    An aggregate, so that copies of a key shrink to one row per task before the shuffle,
    and the choice does not depend on the order in which rows arrive.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    reduced = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_rest"))
    return reduced.select(*key, "_rest.*").select(df.columns)


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys with more than one row; reads the key columns only."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.where("_rows > 1").select(*key)


def one_row_per_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Reduce a batch to one row per key, aggregating whole rows only where keys repeat.

    A first job counts keys; a batch without a repeated key is returned as it is. Otherwise
    the rows of repeated keys are reduced and the others pass. Up to ``SENT_KEYS`` of the keys are
    broadcast; of more, a bitmap of their hashes, which a few other rows pass too: alone with
    their key, these are reduced to themselves.
    """
    shared_dir(df.sparkSession)
    repeated = repeated_keys(df, key).checkpoint()
    number = repeated.count()
    if not number:
        return df
    if number > SENT_KEYS:
        known = marked(df, repeated, key, number)
        once = known.where("NOT _hit").drop("_hit")
        return once.unionByName(least_per_key(known.where("_hit").drop("_hit"), key))
    named = F.broadcast(repeated.toDF(*[f"_{c}" for c in key]))
    once = df.join(named, _same(key), "left_anti")
    return once.unionByName(least_per_key(df.join(named, _same(key), "left_semi"), key))


def marked(df: DataFrame, keys: DataFrame, on: Sequence[str], number: int) -> DataFrame:
    """``df`` with ``_hit``: true for rows with one of the keys, and for one in sixteen others at most.

    A bit per hash, sixteen bits per key, in bitmaps of 32,768 bits: two bytes a key are
    broadcast, and no row of ``df`` is shuffled.
    """
    place = F.pmod(F.xxhash64(*on), F.lit(16 * number)) + 1
    bit = F.bitmap_bit_position(place)
    maps = keys.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    joined = df.join(F.broadcast(maps), F.bitmap_bucket_number(place) == F.col("_bucket"), "left")
    hit = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    return joined.withColumn("_hit", hit).drop("_bucket", "_bits")


def new_rows(
    df: DataFrame,
    existing: DataFrame,
    match_on: Sequence[str],
    lead_keys: DataFrame | None = None,
) -> DataFrame:
    """Rows whose ``match_on`` key is absent from ``existing``; NULL equals NULL.

    ``lead_keys``, one column that covers the batch's values of the first key column, bounds
    what is read of ``existing``: its least and greatest value reach the Parquet scan, so a
    daily batch does not shuffle the keys of all seasons. The first key column is then one
    whose NULLs the builder has left out; a NULL there counts as absent.
    """
    held = existing.select(*match_on)
    if lead_keys is not None:
        held = within_span(held, match_on[0], lead_keys)
    return df.join(held.toDF(*[f"_{c}" for c in match_on]), _same(match_on), "left_anti")


def absent_keys(
    df: DataFrame,
    existing: DataFrame,
    match_on: Sequence[str],
    lead_keys: DataFrame | None = None,
) -> DataFrame:
    """Distinct ``match_on`` keys of the batch that ``existing`` does not hold, checkpointed.

    Both sides' keys meet in one aggregation, in which NULL equals NULL; no other column is
    shuffled. ``lead_keys`` as in :func:`new_rows`.
    """
    shared_dir(df.sparkSession)
    held = existing.select(*match_on)
    if lead_keys is not None:
        held = within_span(held, match_on[0], lead_keys)
    sides = df.select(*match_on, F.lit(True).alias("_new")).unionByName(held.withColumn("_new", F.lit(False)))
    met = sides.groupBy(*match_on).agg(F.min("_new").alias("_new"))
    return met.where("_new").select(*match_on).checkpoint()


def rows_of(df: DataFrame, keys: DataFrame, on: Sequence[str], number: int) -> DataFrame:
    """Rows with one of ``number`` keys; up to ``SENT_KEYS`` keys are broadcast."""
    named = keys.toDF(*[f"_{c}" for c in on])
    return df.join(F.broadcast(named) if number <= SENT_KEYS else named, _same(on), "left_semi")


def _same(key: Sequence[str]) -> Column:
    """Equal keys, the other side's columns named with a leading underscore."""
    return reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
