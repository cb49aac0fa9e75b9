"""Building and loading the star schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.operators.delta import new_rows
from courtlake.operators.star_tables import BUILDERS
from courtlake.plans import rollup
from courtlake.schemas import CHUNK, RAW, STAR
from courtlake.sources import landing
from courtlake.sources.warehouse import Warehouse


def build_table(table: str, raw: dict[str, DataFrame]) -> DataFrame:
    source, build = BUILDERS[table]
    return build(raw[source])


def _chunk(table: str, raw: dict[str, DataFrame]) -> list[Column]:
    """The landing partition of box scores, where the raw table has it."""
    source, _ = BUILDERS[table]
    box = STAR[table].match_on[0] == "game_id" and "date" not in STAR[table].schema.names
    return [F.col("date").alias(CHUNK)] if box and "date" in raw[source].columns else []


def batch(table: str, raw: dict[str, DataFrame]) -> DataFrame:
    """The built table, box scores with the landing partition they come from.

    :meth:`~courtlake.sources.warehouse.Warehouse.append` learns seasons from it and drops it.
    """
    source, build = BUILDERS[table]
    return build(raw[source], *_chunk(table, raw))


def lead_keys(table: str, raw: dict[str, DataFrame]) -> DataFrame | None:
    """The game ids a fact table's batch can hold, read from the raw column alone; those of box
    scores with their landing partition.

    Dimensions are small; all their keys are compared.
    """
    source, _ = BUILDERS[table]
    return raw[source].select("GAME_ID", *_chunk(table, raw)) if STAR[table].match_on[0] == "game_id" else None


def scan_raw(spark: SparkSession, root: str, day: dt.date | None = None) -> dict[str, DataFrame]:
    """The landed tables, or only the partition ``date = day`` of each."""
    tables = {name: landing.scan(spark, root, name) for name in RAW}
    if day is None:
        return tables
    return {name: df.where(F.col("date") == F.lit(day)) for name, df in tables.items()}


def load_star(
    raw: dict[str, DataFrame], warehouse: Warehouse, tables: Sequence[str] = tuple(BUILDERS)
) -> dict[str, int]:
    """Append what is new to each table, dimensions first; returns rows added per table.

    Box scores follow the games, whose seasons they take their folders from. Tables of one
    wave do not depend on each other: their jobs are submitted together, so that one table's
    last tasks do not leave the cluster idle.
    """

    def append(table: str) -> int:
        return warehouse.append_new(table, batch(table, raw), lead_keys(table, raw))

    added: dict[str, int] = {}
    with ThreadPoolExecutor(len(BUILDERS)) as pool:
        for wave in (("dim_team", "dim_player", "dim_date", "fact_game"),
                     ("fact_game_team_stats", "fact_game_player_stats")):
            some = [t for t in wave if t in tables]
            added |= zip(some, pool.map(append, some))
    return added


def load_day(
    spark: SparkSession, landing_root: str, warehouse: Warehouse, day: dt.date,
    tables: Sequence[str] = tuple(BUILDERS),
) -> dict[str, int]:
    """The daily job: one landed partition, not a rescan of all of them.

    Where daily sums are kept, those of the dates in the batch are brought up to date. Rows
    landed without a date lie in a folder of their own, which no day reads.
    """
    raw = scan_raw(spark, landing_root, day)
    added = load_star(raw, warehouse, tables)
    if any(warehouse.exists(t) for t in rollup.ROLLUPS):
        rollup.refresh(warehouse, rollup.touched_dates(raw, warehouse))
    return added


def day_delta(
    spark: SparkSession, landing_root: str, existing: DataFrame, table: str, day: dt.date
) -> DataFrame:
    """Rows the daily job would append to one table."""
    source, _ = BUILDERS[table]
    landed = landing.scan(spark, landing_root, source)
    raw = {source: landed.where(F.col("date") == F.lit(day))}
    built = build_table(table, raw)
    return new_rows(built, existing, STAR[table].match_on, lead_keys(table, raw))
