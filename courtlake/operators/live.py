"""Live score messages: parsing, flattening, latest state, labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtlake import fixed_values as V
from courtlake.functions import display
from courtlake.functions.league import in_progress
from courtlake.schemas import LIVE_DATA, LIVE_EVENT, LIVE_TABLE, SCOREBOARD


def now() -> Column:
    """Processing time without zone: one constant per query or micro-batch."""
    return F.current_timestamp().cast("timestamp_ntz")


def to_messages(rows: DataFrame, *keep: str) -> DataFrame:
    """LIVE_DATA rows as messages: JSON text in ``value``, the time and ``keep`` beside it."""
    body = F.to_json(F.struct(*LIVE_EVENT.names)).alias("value")
    return rows.select(body, F.col("processed_time").alias("timestamp"), *keep)


# ── Messages to rows (batch and stream alike) ────────────────────────────────────


def parse_live_json(messages: DataFrame, processed_time: Column | None = None) -> DataFrame:
    """JSON text in ``value`` to LIVE_DATA rows.

    Text that is no JSON gives a row of NULLs, a field of the wrong type a NULL.
    """
    event = F.from_json(F.col("value").cast("string"), LIVE_EVENT).alias("data")
    stamp = (now() if processed_time is None else processed_time).alias("processed_time")
    return messages.select(event, stamp).select("data.*", "processed_time")


def readable(messages: DataFrame) -> DataFrame:
    """``messages`` with ``readable``: whether the text is a JSON object of the expected types with a game id."""
    schema = T.StructType(LIVE_EVENT.fields + [T.StructField("_corrupt", T.StringType())])
    event = F.from_json(F.col("value").cast("string"), schema, {"columnNameOfCorruptRecord": "_corrupt"})
    return messages.withColumn("_event", event).withColumn("readable", F.coalesce(
        F.col("_event._corrupt").isNull() & F.col("_event.game_id").isNotNull(), F.lit(False))).drop("_event")


def flatten_scoreboard(
    documents: DataFrame,
    processed_time: Column | None = None,
    *,
    defaults: bool = False,
) -> DataFrame:
    """Scoreboard documents in ``value`` to one LIVE_DATA row per game.

    Plain: values as they are, status as text. With ``defaults``: missing scores, period,
    clock and status become 0 or empty, and the status is the numeric code (0 is empty).
    """
    board = F.from_json(F.col("value").cast("string"), SCOREBOARD)
    stamp = (now() if processed_time is None else processed_time).alias("processed_time")
    games = documents.select(F.explode(board["scoreboard"]["games"]).alias("g"), stamp)

    def number(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(0)) if defaults else F.col(path)

    def text(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit("")) if defaults else F.col(path)

    if defaults:
        code = F.col("g.gameStatus")
        status = F.when(F.coalesce(code, F.lit(0)) == 0, "").otherwise(code.cast("string"))
    else:
        status = F.col("g.gameStatusText")
    return games.select(
        F.col("g.gameId").alias("game_id"),
        F.col("g.homeTeam.teamTricode").alias("h_team"),
        F.col("g.awayTeam.teamTricode").alias("a_team"),
        number("g.homeTeam.score").alias("h_points"),
        number("g.awayTeam.score").alias("a_points"),
        number("g.period").alias("quarter"),
        text("g.gameClock").alias("clock"),
        status.alias("game_status"),
        "processed_time",
    )


# ── The stored table ─────────────────────────────────────────────────────────────


def write_live(rows: DataFrame, path: str, stream: str, batch_id: int) -> None:
    """Store LIVE_DATA rows as what ``stream`` wrote in ``batch_id``; a repeat replaces itself.

    Only folders of this stream and batch are replaced, so writers into one table do not meet,
    and no row leaves no folder. A batch replayed by Spark carries the time of its first run,
    so it falls into the same days.
    """
    placed = rows.select(
        *LIVE_DATA.names, F.to_date("processed_time").alias("day"),
        F.lit(stream).alias("stream"), F.lit(batch_id).cast("long").alias("batch_id"),
    )
    folders = LIVE_TABLE.partition_by
    placed.sortWithinPartitions(*folders, *LIVE_TABLE.sort_by).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


# ── Questions about LIVE_DATA ────────────────────────────────────────────────────

STATE = [c for c in LIVE_DATA.names if c not in ("game_id", "processed_time")]


def latest_per_game(live: DataFrame) -> DataFrame:
    """The last snapshot of each game; snapshots of one instant by greatest content.

    An aggregate rather than a window: a game with very many snapshots leaves one row per
    task, and no task sorts or holds all of them.
    """
    last = F.max(F.struct("processed_time", *STATE)).alias("last")
    return live.groupBy("game_id").agg(last).select(
        "game_id", *[f"last.{c}" for c in STATE], "last.processed_time"
    )


def state_changes(live: DataFrame, bucket: str = "hour") -> DataFrame:
    """Snapshots whose state differs from the game's snapshot before: a state that comes back counts.

    Snapshots are ordered by time, those of one instant by content. Each is compared inside its
    game and ``bucket`` of time; only the first one of a bucket needs the last state of the
    game's bucket before, and those are one row per game and bucket. So a game with very many
    snapshots is spread over tasks.
    """
    state = F.struct(*STATE)
    rows = live.withColumns({"_bucket": F.date_trunc(bucket, "processed_time"), "_state": state})
    inside = Window.partitionBy("game_id", "_bucket").orderBy("processed_time", "_state")
    placed = rows.withColumns({"_before": F.lag("_state").over(inside), "_place": F.row_number().over(inside)})
    last = rows.groupBy("game_id", "_bucket").agg(F.max(F.struct("processed_time", "_state")).alias("last"))
    across = Window.partitionBy("game_id").orderBy("_bucket")
    entry = last.select("game_id", "_bucket", F.lag("last").over(across)["_state"].alias("_entry"))
    same = ["game_id", "_bucket"]
    joined = placed.alias("p").join(entry.alias("e"), [F.col(f"p.{c}").eqNullSafe(F.col(f"e.{c}")) for c in same])
    before = F.when(F.col("p._place") == 1, F.col("e._entry")).otherwise(F.col("p._before"))
    first = (F.col("p._place") == 1) & F.col("e._entry").isNull()
    changed = joined.where(first | ~F.col("p._state").eqNullSafe(before))
    return changed.select(*[F.col(f"p.{c}") for c in live.columns])


AsOf = dt.datetime | DataFrame | None


def since(live: DataFrame, asof: AsOf = None, hours: int = V.LIVE_HOURS) -> DataFrame:
    """Snapshots of the last hours before ``asof``: a time, one row with a time, or now.

    The bound is one value, constant or scalar subquery, so that it reaches the scan; of the
    stored table only the folders of its days are read.
    """

    def floor(end: Column) -> Column:
        return end.cast("timestamp_ntz") - F.expr(f"INTERVAL {int(hours)} HOURS")

    if isinstance(asof, DataFrame):
        bound = asof.toDF("asof").select(floor(F.col("asof"))).scalar()
    else:
        bound = floor(now() if asof is None else F.lit(asof))
    if "day" in live.columns:
        live = live.where(F.col("day") >= F.to_date(bound))
    return live.where(F.col("processed_time") >= bound)


def live_latest(live: DataFrame, asof: AsOf = None) -> DataFrame:
    return latest_per_game(since(live, asof))


def live_games(live: DataFrame, asof: AsOf = None) -> DataFrame:
    """Games in progress, by their last snapshot."""
    return live_latest(live, asof).where(in_progress(F.col("game_status")))


def live_cards(games: DataFrame) -> DataFrame:
    """What a score card shows: points, leader, quarter label, clock; nothing is NULL."""
    home = F.coalesce("h_points", F.lit(0))
    away = F.coalesce("a_points", F.lit(0))
    return games.select(
        "game_id", "h_team", "a_team",
        home.alias("h_points"),
        away.alias("a_points"),
        (home > away).alias("h_winning"),
        (away > home).alias("a_winning"),
        display.quarter_label(F.col("quarter")).alias("quarter_label"),
        F.coalesce("clock", F.lit("")).alias("clock"),
    )


def game_labels(games: DataFrame) -> DataFrame:
    """Selector label to game id; of games with the same label the greatest id stands."""
    label = display.matchup_label(F.col("h_team"), F.col("a_team")).alias("label")
    return games.groupBy(label).agg(F.max("game_id").alias("game_id"))


def score_history(live: DataFrame, game_id: str) -> DataFrame:
    """Score progression of one game in time order."""
    own = live.where(F.col("game_id") == game_id)
    columns = ["processed_time", "h_points", "a_points", "h_team", "a_team", "quarter", "clock"]
    return own.select(columns).orderBy(columns)


# ── Live games and the star schema ───────────────────────────────────────────────


def game_sides(games: DataFrame) -> DataFrame:
    """Two rows per live game: side and team code."""
    sides = F.array(
        F.struct(F.lit("home").alias("side"), F.col("h_team").alias("code")),
        F.struct(F.lit("away").alias("side"), F.col("a_team").alias("code")),
    )
    return games.select("game_id", F.inline(sides))


def team_lookup(sides: DataFrame, dim_team: DataFrame) -> DataFrame:
    """Team id and name by code, ignoring case; an unknown code stands for its own name.

    Of several teams with one code, the first by name is meant.
    """
    teams = dim_team.where("abbreviation IS NOT NULL").groupBy(
        F.upper("abbreviation").alias("key")
    ).agg(F.min(F.struct("name", "team_id")).alias("t"))
    found = sides.withColumn("key", F.upper("code")).join(teams, "key", "left")
    return found.select(
        *sides.columns, F.col("t.team_id").alias("team_id"),
        F.coalesce("t.name", "code").alias("name"),
    )
