"""Raw tables to dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlake import fixed_values as V
from courtlake.functions.league import game_date, season_label, season_type
from courtlake.schemas import STAR


def _conform(df: DataFrame, table: str, keep: tuple[Column, ...] = (), **columns: Column | str) -> DataFrame:
    """Select a table's columns in order, by name; columns not given are typed NULLs. Those of ``keep`` follow."""
    wanted = []
    for f in STAR[table].schema:
        source = columns.get(f.name, F.lit(None))
        column = F.col(source) if isinstance(source, str) else source
        wanted.append(column.try_cast(f.dataType).alias(f.name))
    return df.select(*wanted, *keep)


def build_dim_team(games: DataFrame) -> DataFrame:
    """One row per (id, abbreviation, name): a renamed team keeps both rows.

    Rows without an id have no key and are left out; ``quality.unkeyed_rows`` counts them.
    """
    known = games.where(F.col("TEAM_ID").isNotNull())
    teams = known.select("TEAM_ID", "TEAM_ABBREVIATION", "TEAM_NAME").distinct()
    return _conform(
        teams, "dim_team",
        team_id="TEAM_ID", abbreviation="TEAM_ABBREVIATION", name="TEAM_NAME",
    )


def build_dim_player(player_stats: DataFrame) -> DataFrame:
    """One row per (id, name, position) seen."""
    named = player_stats.where("PLAYER_ID IS NOT NULL AND PLAYER_NAME IS NOT NULL")
    players = named.select("PLAYER_ID", "PLAYER_NAME", "START_POSITION").distinct()
    return _conform(
        players, "dim_player",
        player_id="PLAYER_ID", name="PLAYER_NAME", position="START_POSITION",
    )


def build_dim_date(games: DataFrame) -> DataFrame:
    """One row per (date, season, season type) seen; what is no date has no key."""
    sid = F.col("SEASON_ID")
    # Distinct on the two raw columns first: the text work then runs once per pair.
    pairs = games.select("GAME_DATE", sid.cast("string").alias("SEASON_ID")).distinct()
    return _conform(
        pairs, "dim_date",
        date=game_date(F.col("GAME_DATE")), season=season_label(sid), season_type=season_type(sid),
    ).where("date IS NOT NULL").distinct()


def build_fact_game(games: DataFrame) -> DataFrame:
    """Home and away rows of a game side by side; games with one side are left out.

    One aggregation instead of a self-join: a single shuffle with one partial row per game
    and task, and a game landed twice still gives one row. Should a game carry differing
    rows for a side, the greatest (date, team, points) stands.
    """
    side = F.when(F.contains("MATCHUP", F.lit(V.HOME_MARK)), "home").when(
        F.contains("MATCHUP", F.lit(V.AWAY_MARK)), "away"
    )
    rows = games.where("GAME_ID IS NOT NULL AND PTS IS NOT NULL").select(
        "GAME_ID",
        side.alias("side"),
        F.struct(
            game_date(F.col("GAME_DATE")).alias("date"),
            F.col("TEAM_ID").alias("team_id"),
            F.col("PTS").alias("pts"),
        ).alias("entry"),
    )
    paired = (
        rows.where("side IS NOT NULL")
        .groupBy("GAME_ID")
        .agg(
            F.max(F.when(F.col("side") == "home", F.col("entry"))).alias("home"),
            F.max(F.when(F.col("side") == "away", F.col("entry"))).alias("away"),
        )
        .where("home IS NOT NULL AND away IS NOT NULL")
    )
    return _conform(
        paired, "fact_game",
        game_id="GAME_ID", date="home.date",
        home_team_id="home.team_id", away_team_id="away.team_id",
        home_score="home.pts", away_score="away.pts",
    )


def _box_columns(df: DataFrame, table: str) -> dict[str, str]:
    """Star column -> raw column: same name in upper case, except turnovers."""
    names = {f.name: f.name.upper() for f in STAR[table].schema}
    names["tov"] = "TO"
    return {star: raw for star, raw in names.items() if raw in df.columns}


def build_fact_game_team_stats(team_stats: DataFrame, *keep: Column) -> DataFrame:
    table = "fact_game_team_stats"
    known = team_stats.where("GAME_ID IS NOT NULL AND TEAM_ID IS NOT NULL")
    return _conform(known, table, keep, **_box_columns(team_stats, table))


def build_fact_game_player_stats(player_stats: DataFrame, *keep: Column) -> DataFrame:
    table = "fact_game_player_stats"
    known = player_stats.where(
        "PLAYER_ID IS NOT NULL AND GAME_ID IS NOT NULL AND TEAM_ID IS NOT NULL"
    )
    return _conform(known, table, keep, **_box_columns(player_stats, table))


# Star table -> (raw table it comes from, builder), in load order: dimensions first.
BUILDERS = {
    "dim_team": ("games", build_dim_team),
    "dim_player": ("player_stats", build_dim_player),
    "dim_date": ("games", build_dim_date),
    "fact_game": ("games", build_fact_game),
    "fact_game_team_stats": ("team_stats", build_fact_game_team_stats),
    "fact_game_player_stats": ("player_stats", build_fact_game_player_stats),
}
