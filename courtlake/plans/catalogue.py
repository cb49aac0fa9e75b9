"""Every query by name, over one set of test tables: ``(session, folder) -> DataFrame``.

Questions read the stored star schema of the folder's :class:`~courtlake.workspace.Workspace`;
builders and normalisers read the given tables directly.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtlake import fixed_values as V
from courtlake import fixtures
from courtlake.operators import live, normalize, quality
from courtlake.operators.delta import new_rows
from courtlake.plans import matchup, report, rollup
from courtlake.plans import season as S
from courtlake.plans.star import build_table, day_delta, lead_keys, load_day, load_star
from courtlake.schemas import APPEND_STREAM, LIVE_DATA, MESSAGE, STAR
from courtlake.sources import landing, live_store
from courtlake.sources.warehouse import Warehouse, list_tables
from courtlake.streaming import live_stream as streams
from courtlake.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]

TEAM, PAIR, SEASON = 3, (0, 1), "1997-98"
LIVE_GAME = "0000000003"
FILES_PER_BATCH = 1000

RECORD_SQL = """
    SELECT count_if((fg.home_team_id = :team_id AND fg.home_score > fg.away_score)
                 OR (fg.away_team_id = :team_id AND fg.away_score > fg.home_score)) AS WINS,
           count(*) AS GAMES,
           avg(if(fg.home_team_id = :team_id, fg.home_score, fg.away_score)) AS AVG_PTS_FOR,
           avg(if(fg.home_team_id = :team_id, fg.away_score, fg.home_score)) AS AVG_PTS_AGAINST
    FROM fact_game fg JOIN dim_date dd USING (date)
    WHERE :team_id IN (fg.home_team_id, fg.away_team_id)
      AND dd.season = :season AND dd.season_type = 'Regular Season'
"""


def portable(df: DataFrame) -> DataFrame:
    """Columns that compare equal across engines: times as text, fractions to six places."""

    def column(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DoubleType):
            c = F.round(F.round(c, 12), 6)  # float noise first, so that ties are ties
        return c.alias(field.name)

    return df.select([column(f) for f in df.schema])


# ── Raw tables and normalisation ─────────────────────────────────────────────────


def _scan(name: str) -> Query:
    return lambda spark, sf: Workspace.of(spark, sf).raw(name)


def _find_games(spark: SparkSession, sf: str) -> DataFrame:
    games = Workspace.of(spark, sf).raw("games")
    found = landing.find_games(
        games, dt.date(1997, 3, 1), dt.date(1997, 10, 31), months=V.CHUNK_MONTHS)
    return found.select("GAME_ID", "GAME_DATE", "TEAM_ID", "MATCHUP")


def _find_games_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The same games, landed in chunks of a year with one day in a folder of its own."""
    root = Workspace.of(spark, sf).yearly_root()
    found = landing.find_games(
        landing.scan(spark, root, "games"), dt.date(1997, 3, 1), dt.date(1997, 10, 31),
        index=landing.chunk_index(spark, root, "games"))
    return found.select("GAME_ID", "GAME_DATE", "TEAM_ID", "MATCHUP")


def _repair_in_place(spark: SparkSession, sf: str) -> DataFrame:
    """Two repairs around a chunk that lands again, with whole numbers as at first and points
    raised by one; every tenth game has no chunk date. Read as plain files afterwards."""
    space = Workspace.of(spark, sf)
    root, staging = space.new_path("repair"), space.new_path("staging")
    whole = {c: F.col(c).cast("bigint") for c in (*V.STATS, "PLUS_MINUS")}
    rows = space.raw("team_stats").withColumn(
        "date", F.when(~F.col("GAME_ID").endswith("7"), F.col("date")))
    early = F.coalesce(F.col("date") < F.lit(dt.date(1998, 1, 1)), F.lit(False))
    landing.land(rows.where(early), root, "team_stats")
    landing.land(rows.where(~early).withColumns(whole), root, "team_stats")
    landing.repair_in_place(spark, root, "team_stats", staging)
    chunk = landing.chunk_plan(fixtures.span(spark, sf)).where(
        F.col("chunk_start") <= F.lit(dt.date(1997, 3, 1))).agg(F.max("chunk_start")).first()[0]
    again = rows.where(F.col("date") == F.lit(chunk)).withColumns(whole)
    landing.land(again.withColumn("PTS", F.col("PTS") + 1), root, "team_stats")
    landing.repair_in_place(spark, root, "team_stats", staging)
    return landing.scan(spark, root, "team_stats").select("GAME_ID", "TEAM_ID", "PTS", "FG_PCT", "date")


def _repair_types(spark: SparkSession, sf: str) -> DataFrame:
    return landing.scan_repaired(spark, Workspace.of(spark, sf).drifting_root(), "team_stats")


def _normalize_player(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.normalize_player_v3(fixtures.player_v3(spark, sf))


def _normalize_team(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.normalize_team_v3(fixtures.lineups_v3(spark, sf, fixtures.player_lines(spark, sf)))


def _lineup_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.lineup_rollup(
        fixtures.lineups_v3(spark, sf, fixtures.player_lines(spark, sf))
    )


def _shooting_ratios(spark: SparkSession, sf: str) -> DataFrame:
    totals = _lineup_rollup(spark, sf).withColumnsRenamed(normalize.TEAM_V3_TO_V2)
    ratios = normalize.shooting_ratios(totals)
    return ratios.select("GAME_ID", "TEAM_ID", *normalize.V.SHOOTING)


def _route(spark: SparkSession, sf: str) -> DataFrame:
    older, newer = normalize.route_by_season(fixtures.player_v2(spark, sf))
    marked = [d.withColumn("feed", F.lit(n)) for d, n in ((older, "v2"), (newer, "v3"))]
    return normalize.union_box_scores(*marked).select("GAME_ID", "TEAM_ID", "PLAYER_ID", "feed")


def _union(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.ingest_box_scores(
        fixtures.player_v2(spark, sf), fixtures.player_v3(spark, sf)
    )


def _union_teams(spark: SparkSession, sf: str) -> DataFrame:
    lines = fixtures.feed_lines(spark, sf)
    return normalize.ingest_box_scores(
        fixtures.team_v2(spark, sf, lines), fixtures.lineups_v3(spark, sf, lines), team=True
    )


# ── Star schema ──────────────────────────────────────────────────────────────────


def _build(table: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        space = Workspace.of(spark, sf)
        return build_table(table, _LazyRaw(space))

    return query


class _LazyRaw(dict):
    def __init__(self, space: Workspace):
        self._space = space

    def __missing__(self, name: str) -> DataFrame:
        return self._space.raw(name)


def _append_new(spark: SparkSession, sf: str) -> DataFrame:
    """What a full reload adds to a table that holds the games before 1998."""
    space = Workspace.of(spark, sf)
    held = space.star["fact_game"].where(F.col("date") < F.lit(dt.date(1998, 1, 1)))
    raw = _LazyRaw(space)
    built = build_table("fact_game", raw)
    return new_rows(built, held, STAR["fact_game"].match_on, lead_keys("fact_game", raw))


def _incremental_day(spark: SparkSession, sf: str) -> DataFrame:
    """What the daily job adds for the last landed partition, half of which is held already."""
    space = Workspace.of(spark, sf)
    chunks = landing.chunk_plan(fixtures.span(spark, sf))
    day = chunks.agg(F.max("chunk_start")).first()[0]
    even = F.substring("game_id", -1, 1).cast("int") % 2 == 0
    held = space.star["fact_game"].where((F.col("date") < F.lit(day)) | even)
    return day_delta(spark, space.landing_root("games"), held, "fact_game", day)


def _rollup_after_relanding(spark: SparkSession, sf: str) -> DataFrame:
    """Daily team sums kept while half of the last chunk's games come late, by the daily job."""
    space = Workspace.of(spark, sf)
    store = Warehouse(spark, space.new_path("rollup"))
    day = landing.chunk_plan(fixtures.span(spark, sf)).agg(F.max("chunk_start")).first()[0]
    early = (F.col("date") < F.lit(day)) | (F.substring("GAME_ID", -1, 1).cast("int") % 2 == 0)
    facts = ("fact_game", "fact_game_team_stats")
    load_star({n: space.raw(n).where(early) for n in ("games", "team_stats")}, store, facts)
    rollup.build_rollups(store)
    for name in ("games", "team_stats", "player_stats"):
        space.raw(name)
    load_day(spark, space.landing_root("games"), store, day, facts)
    kept = rollup.held(store.read("team_days"), "team_days")
    return kept.select("team_id", "date", "games", "sum_pts", "n_pts",
                       F.col("sum_fg_pct").cast("double").alias("sum_fg_pct"), "n_fg_pct")


def _player_days(star: S.Star) -> DataFrame:
    kept = rollup.held(star["player_days"], "player_days")
    return kept.select("team_id", "player_id", "date", "games", "sum_reb", "sum_tenths", "n_tenths",
                       F.col("sum_ft_pct").cast("double").alias("sum_ft_pct"), "n_ft_pct")


def _load_star(spark: SparkSession, sf: str) -> DataFrame:
    """Load an empty warehouse twice: rows added per table, then none."""
    space = Workspace.of(spark, sf)
    store = Warehouse(spark, space.new_path("load"))
    first = load_star(_LazyRaw(space), store)
    second = load_star(_LazyRaw(space), store)
    stored = [
        store.read(t).agg(F.count(F.lit(1)).alias("stored")).select(
            F.lit(t).alias("tbl"),
            F.lit(first[t]).cast("bigint").alias("first_load"),
            F.lit(second[t]).cast("bigint").alias("second_load"),
            "stored",
        )
        for t in first
    ]
    return normalize.union_box_scores(*stored)


# ── Backfill plan ────────────────────────────────────────────────────────────────


def _chunk_plan(spark: SparkSession, sf: str) -> DataFrame:
    return landing.chunk_plan(fixtures.span(spark, sf))


def _pending(spark: SparkSession, sf: str) -> DataFrame:
    landed = Workspace.of(spark, sf).raw("games").where("GAME_DATE < '1999-01-01'")
    return landing.pending_chunks(_chunk_plan(spark, sf), landed)


def _chunk_games(spark: SparkSession, sf: str) -> DataFrame:
    return landing.chunk_game_counts(Workspace.of(spark, sf).raw("games"))


# ── Season questions ─────────────────────────────────────────────────────────────


def _star(question: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf: question(Workspace.of(spark, sf).star, *args)


def _record_sql(spark: SparkSession, sf: str) -> DataFrame:
    store = Workspace.of(spark, sf).warehouse("fact_game", "dim_date")
    store.register_views("fact_game", "dim_date")
    return store.query(RECORD_SQL, {"team_id": TEAM, "season": SEASON})


def _sample(table: str) -> Query:
    return _star(lambda star: report.first_rows(star[table].select(STAR[table].schema.names)))


def _sample_found(star: S.Star) -> DataFrame:
    """Rows of a look at a table, without an order, that the table does hold."""
    name = "fact_game_player_stats"
    games = star[name].select(STAR[name].schema.names)
    some = report.sample(games).select("game_id", "player_id").distinct()
    return games.join(some, ["game_id", "player_id"], "left_semi").agg(F.count(F.lit(1)).alias("found"))


def _sample_live(spark: SparkSession, sf: str) -> DataFrame:
    return report.first_rows(Workspace.of(spark, sf).live().select(LIVE_DATA.names))


# ── Live scores ──────────────────────────────────────────────────────────────────


def _live(question: Callable[..., DataFrame]) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = Workspace.of(spark, sf).live()
        return question(rows, rows.agg(F.max("processed_time")))

    return query


def _parse(spark: SparkSession, sf: str) -> DataFrame:
    return live.parse_live_json(fixtures.live_messages(spark, sf), F.col("timestamp"))


def _stamped(spark: SparkSession, sf: str) -> DataFrame:
    """Messages stamped by the clock: one time for all of a query's rows, that of the run."""
    rows = live.parse_live_json(fixtures.live_messages(spark, sf))
    fresh = F.abs(F.unix_timestamp(F.col("processed_time").cast("timestamp")) - F.unix_timestamp()) < 600
    return rows.groupBy("game_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min(fresh).alias("fresh"))


def _state_changes(spark: SparkSession, sf: str) -> DataFrame:
    return live.state_changes(Workspace.of(spark, sf).live()).select(LIVE_DATA.names)


def _flatten(defaults: bool) -> Query:
    return lambda spark, sf: live.flatten_scoreboard(
        fixtures.scoreboards(spark, sf), F.col("timestamp"), defaults=defaults
    )


def _playing(spark: SparkSession, sf: str) -> DataFrame:
    return _live(live.live_games)(spark, sf)


def _cards(spark: SparkSession, sf: str) -> DataFrame:
    return live.live_cards(_playing(spark, sf))


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return live.game_labels(_playing(spark, sf))


def _history(spark: SparkSession, sf: str) -> DataFrame:
    return live.score_history(Workspace.of(spark, sf).live(), LIVE_GAME)


def _lookup(spark: SparkSession, sf: str) -> DataFrame:
    teams = Workspace.of(spark, sf).star["dim_team"]
    return live.team_lookup(live.game_sides(_playing(spark, sf)), teams)


def _matchup(spark: SparkSession, sf: str) -> DataFrame:
    return matchup.live_matchup(_playing(spark, sf), Workspace.of(spark, sf).star, SEASON)


def _side_by_side(question: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf: question(_playing(spark, sf), Workspace.of(spark, sf).star, SEASON)


def _live_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return matchup.live_head_to_head(_playing(spark, sf), Workspace.of(spark, sf).star, SEASON)


# ── Streams: run until the landed messages are used up, then read what was written ──


def _stream(kind: str, start: Callable[..., streams.StreamingQuery]) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        space = Workspace.of(spark, sf)
        source = streams.file_messages(spark, space.messages_path(kind), FILES_PER_BATCH)
        out, checkpoint = space.new_path("stream"), space.new_path("checkpoint")
        start(source, out, checkpoint).awaitTermination()
        return streams.read_batches(spark, out)

    return query


def _append(source: DataFrame, out: str, checkpoint: str) -> streams.StreamingQuery:
    return streams.live_stream(source, out, checkpoint, streams.CATCH_UP, F.col("timestamp"))


def _board(source: DataFrame, out: str, checkpoint: str) -> streams.StreamingQuery:
    return streams.scoreboard_stream(source, out, checkpoint, streams.CATCH_UP, F.col("timestamp"))


def _latest(source: DataFrame, out: str, checkpoint: str) -> streams.StreamingQuery:
    rows = live.parse_live_json(source, F.col("timestamp")).where("game_id IS NOT NULL")
    return streams.append_batches(
        streams.latest_state(rows), out, checkpoint, streams.CATCH_UP, "update"
    )


def _changed(source: DataFrame, out: str, checkpoint: str) -> streams.StreamingQuery:
    # The delay spans all messages, so each state of a game is kept once.
    rows = live.parse_live_json(source, F.col("timestamp"))
    kept = streams.changed_only(rows, "3650 days")
    return streams.append_batches(kept, out, checkpoint, streams.CATCH_UP)


def _stream_append(spark: SparkSession, sf: str) -> DataFrame:
    return _stream("live", _append)(spark, sf).select(LIVE_DATA.names)


def _stream_scoreboard(spark: SparkSession, sf: str) -> DataFrame:
    return _stream("board", _board)(spark, sf).select(LIVE_DATA.names)


def _two_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Both kinds of stream into one table: messages in two halves, the second by a resumed
    stream, a resumed stream without news, documents, and messages again by a new stream."""
    space = Workspace.of(spark, sf)
    topic, out = space.new_path("topic"), space.new_path("stream")
    first, again, board = (space.new_path("checkpoint") for _ in range(3))
    messages = spark.read.schema(MESSAGE).parquet(space.messages_path("live"))
    for half in (0, 1):
        part = messages.where(F.pmod(F.hash("value", "timestamp"), F.lit(2)) == half)
        part.write.mode("append").parquet(topic)
        source = streams.file_messages(spark, topic, files_per_batch=1)
        _append(source, out, first).awaitTermination()
    _append(streams.file_messages(spark, topic), out, first).awaitTermination()
    documents = streams.file_messages(spark, space.messages_path("board"), FILES_PER_BATCH)
    _board(documents, out, board).awaitTermination()
    _append(streams.file_messages(spark, topic), out, again).awaitTermination()
    return streams.read_batches(spark, out).select(LIVE_DATA.names)


def _stream_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of state from messages that come in two batches, the earlier half first."""
    space = Workspace.of(spark, sf)
    topic, out, checkpoint = (space.new_path(n) for n in ("topic", "stream", "checkpoint"))
    messages = spark.read.schema(MESSAGE).parquet(space.messages_path("live"))
    middle = messages.agg(F.expr("percentile_approx(timestamp, 0.5)")).first()[0]
    for early in (True, False):
        messages.where((F.col("timestamp") < F.lit(middle)) == early).write.mode("append").parquet(topic)
        streams.changes_stream(
            streams.file_messages(spark, topic, FILES_PER_BATCH), out, checkpoint, streams.CATCH_UP,
            F.col("timestamp")).awaitTermination()
    return streams.read_batches(spark, out).select(LIVE_DATA.names)


def _compacted(spark: SparkSession, sf: str) -> DataFrame:
    """LIVE_DATA after two compactions around a replayed batch, an append and a clean-up."""
    space = Workspace.of(spark, sf)
    topic, out, checkpoint = (space.new_path(n) for n in ("topic", "stream", "checkpoint"))
    messages = spark.read.schema(MESSAGE).parquet(space.messages_path("live"))
    for part in range(3):
        some = messages.where(F.pmod(F.hash("value", "timestamp"), F.lit(3)) == part)
        some.write.mode("append").parquet(topic)
        # A part is one micro-batch, of whatever number of files its tasks wrote.
        _append(streams.file_messages(spark, topic, FILES_PER_BATCH), out, checkpoint).awaitTermination()
    live_store.compact(spark, out)
    first = live_store.batches(spark, out).where("batch_id = 0")
    owner = first.select("stream").first()[0]
    live.write_live(first.select(LIVE_DATA.names).checkpoint(), out, owner, 0)
    live.write_live(fixtures.live(spark, sf), out, f"{APPEND_STREAM}{uuid.uuid4().hex}", 0)
    live_store.compact(spark, out)
    live_store.vacuum(spark, out)
    return live_store.read(spark, out).select(LIVE_DATA.names)


def _quarantined(spark: SparkSession, sf: str) -> DataFrame:
    """Readable and unreadable messages of a stream, by where it put them."""
    space = Workspace.of(spark, sf)
    out, bad, checkpoint = (space.new_path(n) for n in ("stream", "quarantine", "checkpoint"))
    source = streams.file_messages(spark, space.messages_path("live"), FILES_PER_BATCH)
    streams.quarantining_stream(
        source, out, bad, checkpoint, streams.CATCH_UP, F.col("timestamp")).awaitTermination()
    good = streams.read_batches(spark, out).groupBy("game_id").agg(F.count(F.lit(1)).alias("rows"))
    kept = streams.read_quarantine(spark, bad).groupBy(F.col("value").alias("game_id")).agg(
        F.count(F.lit(1)).alias("rows"))
    return good.withColumn("kept_in", F.lit("live_data")).unionByName(kept.withColumn("kept_in", F.lit("quarantine")))


def _catalog_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of every table as declared in the catalog, live rows of two appends included."""
    space = Workspace.of(spark, sf)
    database = space.database
    store = space.warehouse()
    rows = fixtures.live(spark, sf)
    early = F.col("quarter") <= 2
    if not store.exists("live_data"):
        store.append("live_data", rows.where(early))
        store.append("live_data", rows.where(~F.coalesce(early, F.lit(False))))
    store.create_tables(database)
    declared = list_tables(spark, database=database).where("NOT isTemporary")
    names = [r.tableName for r in declared.collect() if r.tableName not in rollup.ROLLUPS]
    return normalize.union_box_scores(*[
        store.query(f"SELECT '{n}' AS tbl, count(*) AS row_count FROM `{database}`.`{n}`")
        for n in names
    ])


def _stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    return streams.latest_written(_stream("live", _latest)(spark, sf))


def _stream_changed(spark: SparkSession, sf: str) -> DataFrame:
    return _stream("live", _changed)(spark, sf).select("game_id", *live.STATE)


QUERIES: dict[str, Query] = {
    "scan_games": _scan("games"),
    "scan_player_stats": _scan("player_stats"),
    "scan_team_stats": _scan("team_stats"),
    "find_games": _find_games,
    "find_games_indexed": _find_games_indexed,
    "repair_types": _repair_types,
    "repair_in_place": _repair_in_place,
    "normalize_player_v3": _normalize_player,
    "normalize_team_v3": _normalize_team,
    "lineup_rollup": _lineup_rollup,
    "shooting_ratios": _shooting_ratios,
    "route_by_season": _route,
    "union_box_scores": _union,
    "union_team_box_scores": _union_teams,
    **{table: _build(table) for table in STAR},
    "append_new_rows": _append_new,
    "incremental_day": _incremental_day,
    "load_star": _load_star,
    "rollup_after_relanding": _rollup_after_relanding,
    "rollup_player_days": _star(_player_days),
    "chunk_plan": _chunk_plan,
    "chunk_plan_pending": _pending,
    "chunk_game_counts": _chunk_games,
    "team_record": _star(S.team_record, TEAM, SEASON),
    "team_record_sql": _record_sql,
    "team_record_all": _star(S.team_record_all),
    "team_summary": _star(S.team_summary, TEAM, SEASON),
    "game_log": _star(S.game_log, TEAM, SEASON),
    "points_trend": _star(S.points_trend, TEAM, SEASON),
    "season_averages": _star(S.season_averages, TEAM, SEASON),
    "season_averages_all": _star(S.season_averages_all),
    "season_averages_display": _star(S.season_averages_display, TEAM, SEASON),
    "avg_fg_pct": _star(S.avg_fg_pct, TEAM, SEASON),
    "roster_stats": _star(S.roster_stats, TEAM, SEASON),
    "roster_game_score": _star(S.roster_game_score, TEAM, SEASON),
    "roster_all": _star(S.roster_all),
    "roster_display": _star(S.roster_display, TEAM, SEASON),
    "roster_table": _star(S.roster_table, TEAM, SEASON),
    "player_collapse": _star(S.player_collapse),
    "head_to_head": _star(S.head_to_head, *PAIR, SEASON),
    "head_to_head_display": _star(S.head_to_head_display, *PAIR, SEASON),
    "recent_games": _star(S.recent_games, TEAM),
    "teams": _star(S.teams),
    "seasons": _star(S.seasons),
    "table_counts": _star(report.table_counts),
    "catalog_counts": _catalog_counts,
    "season_type_counts": _star(report.season_type_counts),
    "home_away_counts": _star(report.home_away_counts, TEAM),
    "team_by_name": _star(S.team_by_name, "Supplier#000000003"),
    "team_by_abbr": _star(report.team_by_abbr, "T03"),
    "table_samples": _sample("fact_game"),
    **{f"sample_{table}": _sample(table) for table in STAR},
    "sample_live_data": _sample_live,
    "sample_found": _star(_sample_found),
    "pk_violations": _star(quality.pk_violations),
    "fk_orphans": _star(quality.fk_orphans),
    "unkeyed_rows": lambda spark, sf: quality.unkeyed_rows(_LazyRaw(Workspace.of(spark, sf))),
    "null_violations": _star(quality.null_violations),
    "length_violations": _star(quality.length_violations),
    "parse_live_json": _parse,
    "live_stamped": _stamped,
    "state_changes": _state_changes,
    "flatten_scoreboard": _flatten(defaults=False),
    "flatten_scoreboard_defaults": _flatten(defaults=True),
    "live_latest": _live(live.live_latest),
    "live_games": _playing,
    "live_cards": _cards,
    "live_labels": _labels,
    "score_history": _history,
    "live_team_lookup": _lookup,
    "live_matchup": _matchup,
    "live_trend": _side_by_side(matchup.live_trend),
    "live_season_averages": _side_by_side(matchup.live_season_averages),
    "live_roster": _side_by_side(matchup.live_roster),
    "live_head_to_head": _live_pairs,
    "stream_append": _stream_append,
    "stream_scoreboard": _stream_scoreboard,
    "stream_two_sources": _two_sources,
    "stream_latest_state": _stream_latest,
    "stream_changed_only": _stream_changed,
    "stream_state_changes": _stream_changes,
    "stream_quarantine": _quarantined,
    "live_compacted": _compacted,
}


def registered() -> dict[str, Query]:
    """The queries with portable result columns."""

    def wrap(query: Query) -> Query:
        return lambda spark, sf: portable(query(spark, sf))

    return {name: wrap(query) for name, query in QUERIES.items()}
