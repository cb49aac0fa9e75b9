import datetime as dt

import pytest

from courtlake.operators import star_tables as B
from courtlake.schemas import RAW, STAR

D = dt.date


@pytest.fixture
def games(spark):
    return spark.createDataFrame(
        [
            ("g1", "22019", "2019-11-01", 1, "A", "Aces", "A vs. B", 100.0),
            ("g1", "22019", "2019-11-01", 2, "B", "Bees", "B @ A", 90.0),
            # landed twice
            ("g1", "22019", "2019-11-01", 1, "A", "Aces", "A vs. B", 100.0),
            ("g1", "22019", "2019-11-01", 2, "B", "Bees", "B @ A", 90.0),
            # home row only; no points yet; no game id; renamed team; other season types
            ("g2", "22019", "2019-11-02", 1, "A", "Aces", "A vs. B", 80.0),
            ("g3", "22019", "2019-11-03", 1, "A", "Aces", "A vs. B", None),
            ("g3", "22019", "2019-11-03", 2, "B", "Bees", "B @ A", 70.0),
            (None, "22019", "2019-11-03", 2, "B", "Bees", "B @ A", 70.0),
            ("g4", "42019", "2020-05-01", 2, "B", "Bumblebees", "B vs. A", 88.0),
            ("g4", "42019", "2020-05-01", 1, "A", "Aces", "A @ B", 99.0),
            ("g5", "32019", "2019-11-01", 3, "C", "Cats", "C vs. A", 1.0),
            ("g6", "22019", "bad date", 3, "C", "Cats", "C vs. A", 1.0),
        ],
        RAW["games"],
    )


def test_fact_game(games, rows):
    out = B.build_fact_game(games)
    assert out.schema.simpleString() == STAR["fact_game"].schema.simpleString()
    assert rows(out) == [
        ("g1", D(2019, 11, 1), 1, 2, 100, 90),
        ("g4", D(2020, 5, 1), 2, 1, 88, 99),
    ]


def test_dim_team_keeps_both_names(games, rows):
    out = B.build_dim_team(games)
    assert rows(out, "team_id", "name") == [
        (1, "Aces"), (2, "Bees"), (2, "Bumblebees"), (3, "Cats"),
    ]
    assert out.first().city is None


def test_dim_date(games, rows):
    assert rows(B.build_dim_date(games)) == sorted([
        (D(2019, 11, 1), "2019-20", "Regular Season"), (D(2019, 11, 1), "2019-20", None),
        (D(2019, 11, 2), "2019-20", "Regular Season"),
        (D(2019, 11, 3), "2019-20", "Regular Season"),
        (D(2020, 5, 1), "2019-20", "Playoffs"),
    ], key=repr)


def test_dim_player_one_row_per_position(spark, rows):
    df = spark.createDataFrame(
        [(1, "Ann", "G"), (1, "Ann", ""), (1, "Ann", None), (1, "Ann", "G"), (None, "Bo", "F"),
         (2, None, "F")],
        "PLAYER_ID bigint, PLAYER_NAME string, START_POSITION string",
    )
    assert rows(B.build_dim_player(df), "player_id", "position") == [(1, ""), (1, "G"), (1, None)]


def test_box_facts_follow_their_schema(spark):
    base = "GAME_ID string, TEAM_ID bigint, PLAYER_ID bigint, MIN string, `TO` double, " \
        "PTS double, FG_PCT double, PLUS_MINUS string"
    df = spark.createDataFrame(
        [("g", 1, 7, "10:00", 3.0, 12.0, 0.5, "4"), ("g", 1, 8, None, None, None, None, "bad"),
         (None, 1, 9, "", 0.0, 0.0, 0.0, "0"), ("g", None, 9, "", 0.0, 0.0, 0.0, "0")],
        base,
    )
    players = B.build_fact_game_player_stats(df)
    assert players.columns == STAR["fact_game_player_stats"].schema.names
    got = {r.player_id: (r.tov, r.pts, r.fg_pct, r.plus_minus, r.min) for r in players.collect()}
    assert got == {7: (3, 12, 0.5, 4, "10:00"), 8: (None, None, None, None, None)}
    teams = B.build_fact_game_team_stats(df)
    assert teams.columns == STAR["fact_game_team_stats"].schema.names
    assert teams.count() == 2


def test_fact_game_needs_one_shuffle(games, plan):
    text = plan(B.build_fact_game(games))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
