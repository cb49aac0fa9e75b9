"""League-shaped tables derived from the generic test tables (see FIXTURES.md).

Ten teams and fifty players play one game per order; each line item is a performance.
Everything is a lazy DataFrame over whole tables.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from courtlake import fixed_values as V
from courtlake.functions.league import ratio
from courtlake.operators.live import to_messages
from courtlake.schemas import RAW, TEAM_V3_TO_V2
from courtlake.sources.landing import chunk_days, chunk_plan

TEAMS = 10
PLAYERS = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(sf_dir, f"{name}.parquet"))


def _ten_digits(number: str) -> Column:
    # Longer numbers keep all their digits: a plain lpad would cut them off.
    return F.expr(f"lpad({number}, greatest(10, length({number})), '0')")


def _team_code(team: Column) -> Column:
    return F.concat(F.lit("T"), F.lpad(team.cast("string"), 2, "0"))


# ── Box scores ───────────────────────────────────────────────────────────────────


def _line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the performances are made of: few columns, to be shuffled instead of theirs."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("game_key"),
        (F.col("l_suppkey") % TEAMS).alias("TEAM_ID"),
        (F.col("l_partkey") % PLAYERS).alias("PLAYER_ID"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.col("l_linenumber").cast("bigint").alias("n"),
        F.col("l_quantity").cast("bigint").alias("q"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("d"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("x"),
    )


def _performances(items: DataFrame, *keep: str) -> DataFrame:
    """Line items as performances, statistics as whole numbers; columns of ``keep`` stay."""
    q, d, x, n = (F.col(c) for c in "qdxn")
    made, threes, free = F.greatest(q - d, F.lit(0)), F.least(d, x), x - x % 3
    return items.select(
        "game_key", *keep,
        _ten_digits("game_key").alias("GAME_ID"),
        "TEAM_ID",
        "PLAYER_ID",
        F.concat(F.lit("Player "), F.col("PLAYER_ID").cast("string")).alias("PLAYER_NAME"),
        F.when(F.col("flag") == "A", "G").when(F.col("flag") == "N", "F").otherwise("")
        .alias("START_POSITION"),
        *([F.when(F.col("status") == "F", "Starters").otherwise("Bench").alias("LINEUP")] if "status" in items.columns else []),
        F.concat(q.cast("string"), F.lit(":00")).alias("MIN"),
        made.alias("FGM"), q.alias("FGA"),
        threes.alias("FG3M"), d.alias("FG3A"),
        free.alias("FTM"), x.alias("FTA"),
        (n % 3).alias("OREB"), n.alias("DREB"), (n % 3 + n).alias("REB"),
        x.alias("AST"), (d % 3).alias("STL"), (x % 3).alias("BLK"),
        (d % 4).alias("TO"), (x % 6).alias("PF"),
        (made * 2 + threes + free).alias("PTS"),
        (q - 25).alias("PLUS_MINUS"),
    )


def player_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One performance per line item, statistics as whole numbers."""
    return _performances(_line_items(spark, sf_dir))


def _with_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({p: ratio(F.col(m), F.col(a)) for p, (m, a) in V.SHOOTING.items()})


def _totals(lines: DataFrame, *key: str) -> DataFrame:
    return lines.groupBy(*key).agg(*[F.sum(c).alias(c) for c in (*V.STATS, "PLUS_MINUS")])


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("game_key"),
        F.to_date("o_orderdate").alias("day"),
        F.concat(
            F.substring("o_orderpriority", 1, 1), F.year("o_orderdate").cast("string")
        ).alias("SEASON_ID"),
    )


def span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last day of play, as one row."""
    return order_days(spark, sf_dir).agg(F.min("day").alias("start"), F.max("day").alias("end"))


def _dated(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Add the day of play, the season id and the landing partition of each game."""
    days = chunk_days(chunk_plan(span(spark, sf_dir)))
    return rows.join(order_days(spark, sf_dir), "game_key").join(days, "day")


def team_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the ten teams: a key between 0 and 9 per row, so ten rows at any scale."""
    named = table(spark, sf_dir, "supplier").where(
        (F.col("s_suppkey") >= 0) & (F.col("s_suppkey") < TEAMS)
    )
    return named.groupBy(F.col("s_suppkey").alias("TEAM_ID")).agg(
        F.min("s_name").alias("TEAM_NAME")
    )


def _named(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    named = rows.join(F.broadcast(team_codes(spark, sf_dir)), "TEAM_ID")
    return named.withColumn("TEAM_ABBREVIATION", _team_code(F.col("TEAM_ID")))


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two lowest team ids of each order play; the lower one is at home.

    Points are summed per team and game first, so a window sees at most ten rows per game.
    The partitioning by game serves the sums, the window and the join with the orders.
    """
    scored = player_lines(spark, sf_dir).select("game_key", "TEAM_ID", "PTS").repartition("game_key")
    points = scored.groupBy("game_key", "TEAM_ID").agg(F.sum("PTS").alias("PTS"))
    by_game = Window.partitionBy("game_key").orderBy("TEAM_ID")
    ranked = points.select(
        "*",
        F.row_number().over(by_game).alias("slot"),
        F.lag("TEAM_ID").over(by_game).alias("lower"),
        F.lead("TEAM_ID").over(by_game).alias("upper"),
    ).where("slot <= 2")
    dated = _named(spark, sf_dir, _dated(spark, sf_dir, ranked))
    home = F.col("slot") == 1
    opponent = F.when(home, F.coalesce("upper", "TEAM_ID")).otherwise(F.col("lower"))
    mark = F.when(home, V.HOME_MARK).otherwise(V.AWAY_MARK)
    columns = {
        "GAME_ID": _ten_digits("game_key"),
        "GAME_DATE": F.date_format("day", "yyyy-MM-dd"),
        "MATCHUP": F.concat(F.col("TEAM_ABBREVIATION"), mark, _team_code(opponent)),
    }
    return _raw(dated.withColumns(columns), "games")


def team_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums per team and game. Line items are gathered by game as they are: a game has about as
    many teams as lines, so sums of each task would be as many rows, and wider ones."""
    lines = _performances(_line_items(spark, sf_dir).repartition("game_key"))
    totals = _totals(lines, "game_key", "TEAM_ID").drop("REB", "AST", "BLK")
    dated = _dated(spark, sf_dir, totals).drop("day", "SEASON_ID").hint("rebalance", "date")
    # Sums that follow from others, as the statistics themselves do, are not gathered.
    dated = dated.withColumns({
        "REB": F.col("OREB") + F.col("DREB"), "AST": F.col("FTA"), "BLK": F.col("FTA") - F.col("FTM")})
    # Gathered by date (GATHERED) before the columns that follow from others.
    with_id = _named(spark, sf_dir, dated).withColumn("GAME_ID", _ten_digits("game_key"))
    return _raw(_with_ratios(with_id), "team_stats")


def player_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Performances, gathered by their landing partition (:data:`GATHERED`) while they are narrow."""
    dated = _dated(spark, sf_dir, _line_items(spark, sf_dir)).drop("day", "SEASON_ID", "status").hint("rebalance", "date")
    return _raw(_with_ratios(_performances(dated, "date")), "player_stats")


def _raw(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in RAW[name]], "date")


RAW_SOURCES = {"games": games, "player_stats": player_stats, "team_stats": team_stats}
#: Sources whose rows come gathered by date, so that landing need not shuffle them again.
GATHERED = {"player_stats", "team_stats"}


# ── Both feed versions ───────────────────────────────────────────────────────────

# Game ids of this part carry the year of play where the feeds put it (characters 4-5), so
# years 95-99 count as "25 or later" and go to the newer feed.


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _line_items(spark, sf_dir).join(order_days(spark, sf_dir).select("game_key", "day"), "game_key")
    lines = _performances(items, "day")
    year = F.lpad((F.year("day") % 100).cast("string"), 2, "0")
    coded = F.concat(F.lit(V.LEAGUE + "2"), year, _ten_digits("game_key"))
    return _with_ratios(lines.withColumn("GAME_ID", coded))


def player_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feed_lines(spark, sf_dir)
    return lines.select(*[F.col(f.name).cast(f.dataType) for f in RAW["player_stats"]])


def player_v3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same performances in the newer feed's names; statistics as whole numbers."""
    lines = feed_lines(spark, sf_dir)
    have = {new: old for new, old in V.PLAYER_V3_TO_V2.items() if old in lines.columns}
    return lines.select(
        *[F.col(old).alias(new) for new, old in have.items()],
        F.lit("Player").alias("firstName"),
        F.col("PLAYER_ID").cast("string").alias("familyName"),
    )


def team_v2(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Team totals in the older feed's names."""
    named = _with_ratios(_named(spark, sf_dir, _totals(lines, "GAME_ID", "TEAM_ID")))
    return named.select(*[F.col(f.name).cast(f.dataType) for f in RAW["team_stats"]])


def lineups_v3(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Two rows per team and game (starters, bench) in the newer team feed's names."""
    totals = _totals(lines, "GAME_ID", "TEAM_ID", "LINEUP")
    named = _named(spark, sf_dir, totals)
    return named.select(
        *[F.col(old).alias(new) for new, old in TEAM_V3_TO_V2.items()],
        F.col("LINEUP").alias("startersBench"),
    )


# ── Live scores ──────────────────────────────────────────────────────────────────


def _event_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    status = F.create_map(*[
        F.lit(part) for pair in {
            "view": "2", "click": "Q3 5:32", "purchase": "OT 1:00", "signup": "Halftime",
            "error": "Final",
        }.items() for part in pair
    ])
    user = F.col("user_id")
    return events.select(
        "event_id",
        _ten_digits("user_id").alias("game_id"),
        _team_code(user % TEAMS).alias("h_team"),
        _team_code((user + 1) % TEAMS).alias("a_team"),
        F.floor("value").cast("int").alias("h_points"),
        k.alias("a_points"),
        (k % 4 + 1).alias("quarter"),
        F.lit("05:12").alias("clock"),
        status[F.col("event_type")].alias("game_status"),
        F.col("ts").cast("timestamp_ntz").alias("processed_time"),
    )


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_columns(spark, sf_dir).drop("event_id")


def live_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON message per event; every fifth, whatever its status, is text that is no JSON."""
    body = F.when(F.col("event_id") % 5 == 0, "{not json").otherwise(F.col("value"))
    return to_messages(_event_columns(spark, sf_dir), "event_id").select(
        body.alias("value"), "timestamp"
    )


GAMES_PER_DOCUMENT = 8


def scoreboards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoreboard documents of at most eight games: consecutive event ids share one."""
    rows = _event_columns(spark, sf_dir)
    points = F.col("h_points")
    game = F.struct(
        F.col("game_id").alias("gameId"),
        F.struct(F.col("h_team").alias("teamTricode"),
                 F.when(points > 0, points).alias("score")).alias("homeTeam"),
        F.struct(F.col("a_team").alias("teamTricode"),
                 F.col("a_points").alias("score")).alias("awayTeam"),
        F.when(F.col("quarter") > 1, F.col("quarter")).alias("period"),
        F.when(F.col("a_points") % 2 == 0, F.col("clock")).alias("gameClock"),
        (F.col("a_points") % 4).alias("gameStatus"),
        F.col("game_status").alias("gameStatusText"),
    )
    per_document = rows.groupBy(
        F.floor(F.col("event_id") / GAMES_PER_DOCUMENT).alias("document")
    ).agg(F.collect_list(game).alias("games"), F.min("processed_time").alias("timestamp"))
    board = F.struct(F.struct("games").alias("scoreboard"))
    return per_document.select(F.to_json(board).alias("value"), "timestamp")
