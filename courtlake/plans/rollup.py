"""Daily sums and counts per team and per player, kept beside the star and corrected by retraction.

Season questions need sums and counts over a season's games. The two tables here hold them per
day: whole numbers, and shares as decimals, so that adding and taking away is exact and does not
depend on order. Their rows are additive: a reader sums whatever rows a key has. A
day that changes is therefore not rewritten: what the table holds of it is appended once more with the
opposite sign, and the new sums after it. Days that did not change add nothing, so a refresh may be
repeated, and one that was cut off is completed by the next.

Games without a date belong to no season and are left out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtlake.functions.league import game_date, game_score_tenths, season_start
from courtlake.operators import delta
from courtlake.plans.season import (
    LOG_STATS, PCT_STATS, PLAYER_DAYS, ROSTER_MEANS, TEAM_DAYS, Star, season_folders,
)
from courtlake.schemas import SEASON_FOLDER, Table, struct
from courtlake.session import shared_dir
from courtlake.sources.warehouse import TABLES, Warehouse

#: Shares are summed as decimals of this form.
SHARE = "decimal(18,15)"
PLAYER_STATS = [*dict.fromkeys([*ROSTER_MEANS.values()])]


def _spec(keys: str, stats: list[str]) -> Table:
    sums = [f"sum_{c} {'decimal(38,15)' if c in PCT_STATS else 'long'}, n_{c} long" for c in stats]
    schema = T.StructType()
    for part in (*keys.split(", "), "games long", *", ".join(sums).split(", ")):
        name, kind = part.split(" ")
        schema.add(name, kind)
    names = tuple(k.split()[0] for k in keys.split(", "))
    return Table(schema, key=names, match_on=names, sort_by=names, partition_by=(SEASON_FOLDER,))


ROLLUPS: dict[str, Table] = {
    TEAM_DAYS: _spec("team_id long, date date", LOG_STATS),
    PLAYER_DAYS: _spec("team_id long, player_id long, date date", [*PLAYER_STATS, "tenths"]),
}
TABLES.update(ROLLUPS)

SOURCE = {TEAM_DAYS: "fact_game_team_stats", PLAYER_DAYS: "fact_game_player_stats"}


def _sums(table: str) -> list[Column]:
    out = [F.count(F.lit(1)).alias("games")]
    for name in [f.name[4:] for f in ROLLUPS[table].schema if f.name.startswith("sum_")]:
        value = game_score_tenths() if name == "tenths" else F.col(name)
        known = value.cast(SHARE) if name in PCT_STATS else value
        out += [F.coalesce(F.sum(known), F.lit(0)).cast(ROLLUPS[table].schema[f"sum_{name}"].dataType).alias(f"sum_{name}"),
                F.count(value).alias(f"n_{name}")]
    return out


def computed(star: Star, table: str, dates: DataFrame | None = None) -> DataFrame:
    """The sums of every day, or of ``dates`` (one column), from the box scores.

    With dates, their games are listed first, and box scores of other games are left out where
    they are read: by the list itself, or by a bitmap of it if it is long.
    """
    games, stats = star["fact_game"].where("date IS NOT NULL"), star[SOURCE[table]]
    if dates is not None:
        wanted = dates.select("date").withColumn(SEASON_FOLDER, season_start(F.col("date")))
        # Days and their seasons are few. Facts dealt out by season would be one task's.
        games = games.join(F.broadcast(wanted), ["date", SEASON_FOLDER], "left_semi")
        stats = stats.join(F.broadcast(season_folders(dates)), SEASON_FOLDER, "left_semi")
        shared_dir(stats.sparkSession)
        games = games.select("game_id", "date").checkpoint()
        if (number := games.count()) <= delta.SENT_KEYS:
            games = F.broadcast(games)
        else:
            stats = delta.marked(stats, games, ["game_id"], number).where("_hit").drop("_hit")
    played = stats.drop(SEASON_FOLDER).join(games.select("game_id", "date"), "game_id")
    return played.groupBy(*ROLLUPS[table].key).agg(*_sums(table))


def build_rollups(warehouse: Warehouse, tables: Sequence[str] = tuple(ROLLUPS)) -> None:
    """Write the daily sums, or some of them, of a warehouse that does not have them yet."""
    star = {t: warehouse.stored(t) for t in ("fact_game", *SOURCE.values()) if warehouse.exists(t)}
    for table, source in SOURCE.items():
        if table in tables and source in star and not warehouse.exists(table):
            warehouse.append(table, computed(star, table))


def held(days: DataFrame, table: str) -> DataFrame:
    """What the additive rows of a table come to, keys without games left out."""
    values = [c for c in ROLLUPS[table].schema.names if c not in ROLLUPS[table].key]
    kinds = {c: ROLLUPS[table].schema[c].dataType for c in values}
    summed = days.groupBy(*ROLLUPS[table].key).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in values])
    return summed.where(" OR ".join(f"{c} <> 0" for c in values))


def _signed(name: str) -> Column:
    # A product would round a wide decimal; the opposite of one is exact.
    return F.when(F.col("x.sign") < 0, -F.col(f"x.v.{name}")).otherwise(F.col(f"x.v.{name}"))


def refresh(warehouse: Warehouse, dates: DataFrame) -> dict[str, int]:
    """Take out what the rollups hold of ``dates`` and add their present sums; rows appended.

    Only the folders of these dates are read, of the facts as of the rollups.
    """
    shared_dir(warehouse.spark)
    dates = dates.select("date").where("date IS NOT NULL").distinct().checkpoint()
    star = {t: warehouse.stored(t) for t in ("fact_game", *SOURCE.values()) if warehouse.exists(t)}
    added = {}
    for table, source in SOURCE.items():
        if source not in star or not warehouse.exists(table):
            continue
        key = list(ROLLUPS[table].key)
        values = [c for c in ROLLUPS[table].schema.names if c not in key]
        wanted = dates.withColumn(SEASON_FOLDER, season_start(F.col("date")))
        old = held(warehouse.stored(table).join(wanted, ["date", SEASON_FOLDER], "left_semi"), table)
        both = old.select(*key, F.struct(*values).alias("old")).join(
            computed(star, table, dates).select(*key, F.struct(*values).alias("new")), key, "full")
        signed = both.where(~F.col("old").eqNullSafe(F.col("new"))).select(*key, F.explode(F.array(
            F.struct(F.lit(-1).alias("sign"), F.col("old").alias("v")),
            F.struct(F.lit(1).alias("sign"), F.col("new").alias("v")))).alias("x")).where("x.v IS NOT NULL")
        kinds = {c: ROLLUPS[table].schema[c].dataType for c in values}
        # Computed before the append, whose own table it reads.
        rows = signed.select(*key, *[_signed(c).cast(kinds[c]).alias(c) for c in values]).checkpoint()
        added[table] = 0 if rows.isEmpty() else warehouse.append(table, rows)
    return added


def touched_dates(raw: Mapping[str, DataFrame], warehouse: Warehouse) -> DataFrame:
    """The dates of every game that a batch mentions, in whichever raw table."""
    listed = raw["games"].select(game_date(F.col("GAME_DATE")).alias("date"))
    ids = reduce(DataFrame.union, [raw[t].select(F.col("GAME_ID").alias("game_id")) for t in raw if t != "games"])
    known = warehouse.stored("fact_game").select("game_id", "date").join(ids.distinct(), "game_id", "left_semi")
    return listed.union(known.select("date")).distinct()
