import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from courtlake.operators import live as L
from courtlake.plans import matchup
from courtlake.schemas import LIVE_DATA, MESSAGE

T0 = dt.datetime(2024, 1, 1, 12)


def messages(spark, *values):
    return spark.createDataFrame([(v, T0) for v in values], MESSAGE)


def snapshots(spark, *entries):
    """(game, minutes, home points, status)"""
    full = [(g, "AAA", "BBB", p, 5, 1, "05:00", s, T0 + dt.timedelta(minutes=m))
            for g, m, p, s in entries]
    return spark.createDataFrame(full, LIVE_DATA)


EVENT = {"game_id": "g", "h_team": "A", "a_team": "B", "h_points": 3, "a_points": 4,
         "quarter": 1, "clock": "05:00", "game_status": "Q1"}


def test_parse(spark):
    bad_type = {**EVENT, "h_points": "3", "extra": 1}
    missing = {"game_id": "h"}
    df = L.parse_live_json(
        messages(spark, json.dumps(EVENT), json.dumps(bad_type), json.dumps(missing), "{oops", None),
        F.col("timestamp"),
    )
    assert df.schema.names == LIVE_DATA.names
    assert dict(df.dtypes)["processed_time"] == "timestamp_ntz"
    got = [tuple(r)[:5] for r in df.collect()]
    assert got == [("g", "A", "B", 3, 4), ("g", "A", "B", None, 4), ("h",) + (None,) * 4,
                   (None,) * 5, (None,) * 5]


def test_parse_stamps_now_and_reads_binary(spark):
    body = messages(spark, json.dumps(EVENT)).withColumn("value", F.col("value").cast("binary"))
    row = L.parse_live_json(body).first()
    assert row.game_id == "g"
    assert abs(dt.datetime.now(dt.UTC).replace(tzinfo=None) - row.processed_time) < dt.timedelta(minutes=5)


def document(*games):
    return json.dumps({"scoreboard": {"games": list(games)}})


FULL = {"gameId": "g", "homeTeam": {"teamTricode": "A", "score": 3},
        "awayTeam": {"teamTricode": "B", "score": 4}, "period": 2, "gameClock": "1:00",
        "gameStatus": 2, "gameStatusText": "Q2 1:00"}
EMPTY = {"gameId": "h", "homeTeam": {"teamTricode": "C", "score": None},
         "awayTeam": {"teamTricode": "D"}, "period": None, "gameStatus": 0}


def test_flatten_plain_and_with_defaults(spark, rows):
    docs = messages(spark, document(FULL, EMPTY), document(), "{oops")
    stamp = F.col("timestamp")
    plain = rows(L.flatten_scoreboard(docs, stamp).drop("processed_time"))
    assert plain == [("g", "A", "B", 3, 4, 2, "1:00", "Q2 1:00"),
                     ("h", "C", "D", None, None, None, None, None)]
    filled = rows(L.flatten_scoreboard(docs, stamp, defaults=True).drop("processed_time"))
    assert filled == [("g", "A", "B", 3, 4, 2, "1:00", "2"), ("h", "C", "D", 0, 0, 0, "", "")]


def test_latest_in_progress(spark, rows):
    df = snapshots(
        spark,
        ("a", 0, 1, "Q1"), ("a", 5, 2, "Q2 3:00"), ("a", 5, 3, "Q2 2:00"),  # one instant, two rows
        ("b", 1, 1, "2"), ("b", 9, 1, "Final"),                             # over
        ("c", -600, 1, "Q1"),                                               # too old
        ("d", 2, 0, " 2 "), ("e", 3, 1, "Halftime"), ("f", 3, 1, None),
    )
    asof = T0 + dt.timedelta(minutes=10)
    assert rows(L.live_latest(df, asof), "game_id", "h_points") == [
        ("a", 3), ("b", 1), ("d", 0), ("e", 1), ("f", 1),
    ]
    assert rows(L.live_games(df, asof), "game_id", "h_points") == [("a", 3), ("d", 0)]
    newest = df.agg(F.max("processed_time"))
    assert rows(L.live_games(df, newest), "game_id") == [("a",), ("d",)]
    assert L.live_games(df).count() == 0


def test_six_hours_are_inclusive(spark, rows):
    df = snapshots(spark, ("a", 0, 1, "Q1"), ("b", -1, 1, "Q1"))
    assert rows(L.since(df, T0 + dt.timedelta(hours=6)), "game_id") == [("a",)]


def test_time_bound_reaches_the_scan(spark, tmp_path, plan):
    snapshots(spark, ("a", 0, 1, "Q1")).write.parquet(str(tmp_path / "live"))
    df = spark.read.schema(LIVE_DATA).parquet(str(tmp_path / "live"))
    text = plan(L.live_latest(df, T0))
    assert "GreaterThanOrEqual(processed_time" in text and "Window" not in text


def test_cards_labels_history(spark, rows):
    df = snapshots(spark, ("a", 0, 9, "2"), ("b", 1, 5, "2"), ("c", 2, None, "2"))
    cards = {r.game_id: r for r in L.live_cards(df).collect()}
    assert (cards["a"].h_winning, cards["a"].a_winning) == (True, False)
    assert (cards["b"].h_winning, cards["b"].a_winning) == (False, False)
    assert (cards["c"].h_points, cards["c"].a_winning, cards["c"].quarter_label) == (0, True, "Q1")
    assert rows(L.game_labels(df)) == [("AAA vs BBB", "c")]
    history = L.score_history(snapshots(spark, ("a", 5, 2, "2"), ("a", 1, 1, "2"), ("b", 0, 0, "2")), "a")
    assert [r.h_points for r in history.collect()] == [1, 2]
    assert L.score_history(df, "a' OR '1'='1").count() == 0


@pytest.fixture
def star(spark):
    ddl = "team_id bigint, abbreviation string, name string"
    teams = [(1, "aaa", "Zebras"), (2, "AAA", "Apes"), (3, None, "None")]
    games = [(f"g{i:02d}", dt.date(2020, 1, 1 + i), 2, 4, 10 + i, 12) for i in range(14)]
    games.append(("x", dt.date(2020, 1, 1), 4, 2, 1, 0))
    return {
        "dim_team": spark.createDataFrame([*teams, (4, "BBB", "Bees")], ddl),
        "dim_date": spark.createDataFrame(
            [(dt.date(2020, 1, 1 + i), "2019-20", "Regular Season") for i in range(20)],
            "date date, season string, season_type string"),
        "fact_game": spark.createDataFrame(
            games, "game_id string, date date, home_team_id bigint, away_team_id bigint, "
                   "home_score bigint, away_score bigint"),
        "fact_game_team_stats": spark.createDataFrame(
            [("g01", 2, 0.5), ("g02", 2, 0.25), ("g02", 4, None)],
            "game_id string, team_id bigint, fg_pct double"),
    }


def test_lookup_and_matchup(spark, star, rows):
    games = snapshots(spark, ("a", 0, 1, "2")).withColumn("a_team", F.lit("zzz"))
    found = L.team_lookup(L.game_sides(games), star["dim_team"])
    assert rows(found) == [("a", "away", "zzz", None, "zzz"), ("a", "home", "AAA", 2, "Apes")]
    both = {r.side: r for r in matchup.live_matchup(games, star, "2019-20").collect()}
    assert (both["home"].wins, both["home"].losses) == (11, 4)
    assert both["home"].avg_fg_pct == 0.375
    assert (both["away"].wins, both["away"].avg_pts_for, both["away"].avg_fg_pct) == (0, 0.0, 0.0)


def test_live_head_to_head_keeps_latest_ten_per_pair(spark, star, plan):
    games = snapshots(spark, ("a", 0, 1, "2"), ("b", 0, 1, "2"))
    df = matchup.live_head_to_head(games, star, "2019-20")
    got = [r for r in df.orderBy("live_game_id", "rank").collect()]
    assert [r.game_id for r in got if r.live_game_id == "b"] == [f"g{i:02d}" for i in range(13, 3, -1)]
    assert len(got) == 20 and {r.home_team for r in got} == {"AAA"}
    assert "WindowGroupLimit" in plan(df)
