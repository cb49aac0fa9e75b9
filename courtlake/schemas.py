"""Explicit schemas of every table, and the keys the published tables promise."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from courtlake.fixed_values import PLAYER_V3_TO_V2, SHOOTING, STATS


def struct(columns: str) -> T.StructType:
    """A schema from ``name type`` pairs; unlike Spark's own DDL reader it needs no session."""
    out = T.StructType()
    for column in columns.split(", "):
        out.add(*column.split())
    return out


_STATS_DOUBLE = ", ".join(f"{c} double" for c in STATS)
_PCTS_DOUBLE = ", ".join(f"{c} double" for c in SHOOTING)

RAW_GAMES = struct(
    "GAME_ID string, SEASON_ID string, GAME_DATE string, TEAM_ID long, "
    "TEAM_ABBREVIATION string, TEAM_NAME string, MATCHUP string, PTS double"
)
RAW_PLAYER_STATS = struct(
    "GAME_ID string, TEAM_ID long, PLAYER_ID long, PLAYER_NAME string, "
    f"START_POSITION string, MIN string, {_STATS_DOUBLE}, {_PCTS_DOUBLE}, PLUS_MINUS double"
)
RAW_TEAM_STATS = struct(
    "GAME_ID string, TEAM_ID long, TEAM_ABBREVIATION string, TEAM_NAME string, "
    f"{_STATS_DOUBLE}, {_PCTS_DOUBLE}, PLUS_MINUS double"
)
RAW = {
    "games": RAW_GAMES,
    "player_stats": RAW_PLAYER_STATS,
    "team_stats": RAW_TEAM_STATS,
}

# The team feed renames a subset of the player feed; percentages are recomputed.
TEAM_V3_TO_V2 = {
    new: old
    for new, old in PLAYER_V3_TO_V2.items()
    if old in STATS or old in ("GAME_ID", "TEAM_ID", "TEAM_ABBREVIATION", "TEAM_NAME")
}

_SIDE = struct("teamTricode string, score integer")
_GAME = (
    T.StructType()
    .add("gameId", "string")
    .add("homeTeam", _SIDE)
    .add("awayTeam", _SIDE)
    .add("period", "integer")
    .add("gameClock", "string")
    .add("gameStatus", "integer")
    .add("gameStatusText", "string")
)
SCOREBOARD = T.StructType().add("scoreboard", T.StructType().add("games", T.ArrayType(_GAME)))
LIVE_EVENT = struct(
    "game_id string, h_team string, a_team string, h_points integer, a_points integer, "
    "quarter integer, clock string, game_status string"
)
LIVE_DATA = T.StructType(LIVE_EVENT.fields + struct("processed_time timestamp_ntz").fields)
# As stored: a folder per day, then one per stream and micro-batch, which that batch alone owns.
LIVE_STORED = T.StructType(
    LIVE_DATA.fields + struct("day date, stream string, batch_id long").fields
)
# Streams of a single append are named so, with an id.
APPEND_STREAM = "append-"
MESSAGE = struct("value string, timestamp timestamp_ntz")
QUARANTINE = T.StructType(MESSAGE.fields + struct("stream string, batch_id long").fields)

# Counted statistics are BIGINT: the warehouse's INTEGER has no 32-bit limit.
_COUNTS = "fgm long, fga long, fg_pct double, fg3m long, fg3a long, fg3_pct double, " \
    "ftm long, fta long, ft_pct double, oreb long, dreb long, reb long, " \
    "ast long, stl long, blk long, tov long, pf long"


@dataclass(frozen=True)
class Table:
    """A published table: schema, promised key and references, and file layout.

    ``match_on`` decides which incoming rows are new; ``unique_on`` additionally reduces
    the incoming batch to one row per key, where the builder does not. ``sort_by`` orders rows inside each file so
    that filters on these columns skip Parquet pages without a shuffle at write time.
    """

    schema: T.StructType
    key: tuple[str, ...]
    match_on: tuple[str, ...]
    unique_on: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def stored(self) -> T.StructType:
        """The schema with the folder columns, which questions may use and nothing publishes."""
        return T.StructType(self.schema.fields + [
            f for f in FOLDERS.fields if f.name in self.partition_by and f.name not in self.schema.names
        ])


# Facts lie in a folder per season; rows whose game is not known yet in the folder of none.
SEASON_FOLDER, NO_SEASON = "season_start", -1
FOLDERS = struct(f"{SEASON_FOLDER} integer")
# Of a batch's rows, beside the published columns: the landing partition they were read from.
CHUNK = "_chunk"

STAR: dict[str, Table] = {
    "dim_team": Table(
        struct(
            "team_id long, abbreviation string, name string, city string, "
            "conference string, division string"
        ),
        key=("team_id",),
        match_on=("team_id",),
        not_null=("abbreviation", "name"),
        max_length={
            "abbreviation": 5, "name": 100, "city": 100, "conference": 10, "division": 20,
        },
    ),
    "dim_player": Table(
        struct("player_id long, name string, position string, height string, weight integer"),
        key=("player_id",),
        match_on=("player_id",),
        not_null=("name",),
        max_length={"name": 100, "position": 5, "height": 10},
    ),
    "dim_date": Table(
        struct("date date, season string, season_type string"),
        key=("date",),
        # A date may belong to several kinds of season; a kind seen later is new.
        match_on=("date", "season", "season_type"),
        max_length={"season": 10, "season_type": 20},
    ),
    "fact_game": Table(
        struct(
            "game_id string, date date, home_team_id long, away_team_id long, "
            "home_score long, away_score long"
        ),
        key=("game_id",),
        match_on=("game_id",),
        sort_by=("date", "game_id"),
        partition_by=(SEASON_FOLDER,),
        max_length={"game_id": 20},
        references={
            "date": ("dim_date", "date"),
            "home_team_id": ("dim_team", "team_id"),
            "away_team_id": ("dim_team", "team_id"),
        },
    ),
    "fact_game_team_stats": Table(
        struct(f"game_id string, team_id long, {_COUNTS}, pts long, plus_minus long"),
        key=("game_id", "team_id"),
        match_on=("game_id", "team_id"),
        unique_on=("game_id", "team_id"),
        sort_by=("team_id", "game_id"),
        partition_by=(SEASON_FOLDER,),
        max_length={"game_id": 20},
        references={"game_id": ("fact_game", "game_id"), "team_id": ("dim_team", "team_id")},
    ),
    "fact_game_player_stats": Table(
        struct(
            "game_id string, player_id long, team_id long, min string, pts long, "
            f"{_COUNTS}, plus_minus long"
        ),
        key=("game_id", "player_id"),
        match_on=("game_id", "player_id"),
        unique_on=("game_id", "player_id"),
        sort_by=("team_id", "game_id"),
        partition_by=(SEASON_FOLDER,),
        max_length={"game_id": 20, "min": 10},
        references={
            "game_id": ("fact_game", "game_id"),
            "player_id": ("dim_player", "player_id"),
            "team_id": ("dim_team", "team_id"),
        },
    ),
}
LIVE_TABLE = Table(
    LIVE_STORED, key=(), match_on=(), sort_by=("game_id", "processed_time"),
    partition_by=("day", "stream", "batch_id"),
    max_length={"game_id": 20, "h_team": 5, "a_team": 5, "clock": 10, "game_status": 50},
)
