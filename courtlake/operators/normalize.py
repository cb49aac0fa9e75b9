"""Box-score feeds of either version to one shape, and repair of drifting column types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtlake import fixed_values as V
from courtlake.functions.league import full_name, ratio, uses_new_feed
from courtlake.schemas import TEAM_V3_TO_V2

ID_COLUMNS = ("PLAYER_ID", "TEAM_ID")
TEAM_KEY = ("gameId", "teamId", "teamTricode", "teamName")


def _cast_present(df: DataFrame, target: dict[str, str]) -> DataFrame:
    """Cast the columns that exist and differ; text that is no number becomes NULL."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    todo = {c: F.col(c).try_cast(t) for c, t in target.items() if c in have and have[c] != t}
    return df.withColumns(todo) if todo else df


def cast_ids(df: DataFrame) -> DataFrame:
    return _cast_present(df, {c: "bigint" for c in ID_COLUMNS})


def cast_stats(df: DataFrame) -> DataFrame:
    return _cast_present(df, {c: "double" for c in V.STATS})


def normalize_dtypes(df: DataFrame) -> DataFrame:
    """Minutes as text and plus/minus as double, where present."""
    return _cast_present(df, {"MIN": "string", "PLUS_MINUS": "double"})


def normalize_player_v3(df: DataFrame) -> DataFrame:
    """Newer player feed to the older feed's names and types."""
    named = df.withColumnsRenamed(V.PLAYER_V3_TO_V2).withColumn(
        "PLAYER_NAME", full_name(F.col("firstName"), F.col("familyName"))
    )
    return cast_stats(cast_ids(named))


def lineup_rollup(df: DataFrame) -> DataFrame:
    """Starters and bench to one row per team and game; all-missing statistics sum to 0.

    A plain hash aggregate: partial sums leave each task, however many rows a team has.
    """
    stats = [c for c, old in TEAM_V3_TO_V2.items() if old in V.STATS]
    known = F.lit(True)
    for c in TEAM_KEY:
        known = known & F.col(c).isNotNull()
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in stats]
    return df.where(known).groupBy(*TEAM_KEY).agg(*sums)


def shooting_ratios(df: DataFrame) -> DataFrame:
    """Shooting percentages from made and attempted, NULL without attempts."""
    return df.withColumns({p: ratio(F.col(m), F.col(a)) for p, (m, a) in V.SHOOTING.items()})


def normalize_team_v3(df: DataFrame) -> DataFrame:
    """Newer team feed (two rows per team) to the older feed's shape."""
    named = lineup_rollup(df).withColumnsRenamed(TEAM_V3_TO_V2)
    full = shooting_ratios(named).withColumn("PLUS_MINUS", F.lit(None).cast("double"))
    return cast_stats(cast_ids(full))


def route_by_season(df: DataFrame, game_id: str = "GAME_ID") -> tuple[DataFrame, DataFrame]:
    """Split rows into (older feed, newer feed) by the season year in the game id."""
    newer = uses_new_feed(F.col(game_id))
    return df.where(~newer), df.where(newer)


def union_box_scores(*frames: DataFrame) -> DataFrame:
    """Stack box scores by column name; columns a feed lacks are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def ingest_box_scores(
    older: DataFrame, newer: DataFrame, *, team: bool = False
) -> DataFrame:
    """Each game from the feed that publishes its season, in one shape and one set of types."""
    keep_older, _ = route_by_season(older, "GAME_ID")
    _, keep_newer = route_by_season(newer, "gameId")
    converted = normalize_team_v3(keep_newer) if team else normalize_player_v3(keep_newer)
    return normalize_dtypes(union_box_scores(repair(keep_older), repair(converted)))


# What every landed file should hold: statistics as double, ids as bigint, minutes as text.
REPAIRED = {
    "MIN": "string",
    "PLUS_MINUS": "double",
    **{c: "double" for c in V.STATS},
    **{c: "bigint" for c in ID_COLUMNS},
}


def repair(df: DataFrame) -> DataFrame:
    """Bring drifting columns to their one type."""
    return _cast_present(df, REPAIRED)


def type_changes(schema: T.StructType) -> dict[str, tuple[str, str]]:
    """Columns :func:`repair` would change, as name -> (type found, type wanted)."""
    return {
        f.name: (f.dataType.simpleString(), REPAIRED[f.name])
        for f in schema
        if f.name in REPAIRED and f.dataType.simpleString() != REPAIRED[f.name]
    }
