"""Checks of what the published tables promise but nothing enforces."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlake.functions.league import game_date
from courtlake.schemas import STAR

Star = Mapping[str, DataFrame]


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def pk_violations(star: Star) -> DataFrame:
    """Keys that occur more than once, with their number of rows, for every table."""

    def check(name: str) -> DataFrame:
        key = STAR[name].key
        repeated = star[name].groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in key]
        return repeated.where("rows > 1").select(
            F.lit(name).alias("tbl"), F.concat_ws("|", *parts).alias("key"), "rows"
        )

    return _stack([check(name) for name in STAR])


def fk_orphans(star: Star) -> DataFrame:
    """Referenced keys that do not exist, with the number of rows that use them.

    Each table is scanned once for all its references, and each referenced key once for all that
    refer to it: used and known keys are stacked and meet in one aggregation. Rows are counted
    per key and task first, so a key used by very many rows is one row when it is shuffled, and
    a key gathers at most one entry per reference.
    """

    def used(name: str) -> DataFrame:
        keys = [
            F.struct(F.lit(column).alias("column"), F.lit(".".join(parent)).alias("parent"),
                     F.col(column).cast("string").alias("key"))
            for column, parent in STAR[name].references.items()
        ]
        rows = star[name].select(F.inline(F.array(*keys))).where("key IS NOT NULL")
        return rows.groupBy("column", "parent", "key").agg(F.count(F.lit(1)).alias("rows")).select(
            "parent", "key", F.struct(F.lit(name).alias("tbl"), "column", "rows").alias("use"))

    referring = [name for name, table in STAR.items() if table.references]
    parents = dict.fromkeys(parent for name in referring for parent in STAR[name].references.values())
    use = "struct<tbl:string,column:string,rows:bigint>"
    known = [
        star[table].select(F.lit(f"{table}.{key}").alias("parent"), F.col(key).cast("string").alias("key")).distinct()
        .withColumn("use", F.lit(None).cast(use))
        for table, key in parents
    ]
    met = _stack([used(name) for name in referring] + known).groupBy("parent", "key").agg(
        F.max(F.col("use").isNull()).alias("known"), F.collect_list("use").alias("uses"))
    return met.where("NOT known").select("key", F.inline("uses")).select("tbl", "column", "key", "rows")


def _per_column(star: Star, checks: dict[str, dict[str, Column]], value: str) -> DataFrame:
    """One pass per table; one result row per checked column."""

    def check(name: str) -> DataFrame:
        counted = star[name].agg(*[F.count_if(bad).alias(c) for c, bad in checks[name].items()])
        entries = [
            F.struct(F.lit(c).alias("column"), F.col(c).alias(value)) for c in checks[name]
        ]
        return counted.select(F.lit(name).alias("tbl"), F.inline(F.array(*entries)))

    return _stack([check(name) for name in checks if checks[name]])


def null_violations(star: Star) -> DataFrame:
    """Rows with NULL in a key or a required column."""
    checks = {
        name: {c: F.col(c).isNull() for c in (*table.key, *table.not_null)}
        for name, table in STAR.items()
    }
    return _per_column(star, checks, "null_rows")


def unkeyed_rows(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Raw rows that the dimension builders leave out, having no key."""
    games = raw["games"].agg(
        F.count_if(F.col("TEAM_ID").isNull()).alias("TEAM_ID"),
        F.count_if(game_date(F.col("GAME_DATE")).isNull()).alias("GAME_DATE"),
    )
    players = raw["player_stats"].agg(F.count_if(F.col("PLAYER_ID").isNull()).alias("PLAYER_ID"))

    def entries(name: str, counted: DataFrame) -> DataFrame:
        found = [F.struct(F.lit(c).alias("column"), F.col(c).alias("rows")) for c in counted.columns]
        return counted.select(F.lit(name).alias("tbl"), F.inline(F.array(*found)))

    return _stack([entries("games", games), entries("player_stats", players)])


def length_violations(star: Star) -> DataFrame:
    """Rows whose text is longer than the column's declared length."""
    checks = {
        name: {c: F.length(c) > size for c, size in table.max_length.items()}
        for name, table in STAR.items()
    }
    return _per_column(star, checks, "long_rows")
