from pyspark.sql import types as T

from courtlake import fixed_values as V
from courtlake.operators import normalize as N
from courtlake.schemas import TEAM_V3_TO_V2

STATS_V3 = [new for new, old in TEAM_V3_TO_V2.items() if old in V.STATS]


def lineups(spark, entries):
    """(game, team, code, name, value or None): every statistic holds the value."""
    schema = "gameId string, teamId bigint, teamTricode string, teamName string, " + \
        ", ".join(f"{c} bigint" for c in STATS_V3)
    return spark.createDataFrame([(*e[:4], *[e[4]] * len(STATS_V3)) for e in entries], schema)


def test_rollup_sums_lineups_and_drops_unknown_teams(spark, rows):
    df = lineups(spark, [
        ("g", 1, "A", "Aces", 3), ("g", 1, "A", "Aces", 4),
        ("g", 2, "B", "Bees", None), ("g", 2, "B", "Bees", None),
        ("g", 3, None, "Cats", 9), (None, 4, "D", "Dogs", 9),
    ])
    got = rows(N.lineup_rollup(df), "teamId", "points", "assists")
    assert got == [(1, 7, 7), (2, 0, 0)]


def test_team_feed_takes_older_shape(spark):
    out = N.normalize_team_v3(lineups(spark, [("g", 1, "A", "Aces", 0), ("g", 1, "A", "Aces", 0)]))
    row = out.first()
    assert row.FG_PCT is None and row.FT_PCT is None and row.PLUS_MINUS is None
    types = dict(out.dtypes)
    assert types["TEAM_ID"] == "bigint" and all(types[c] == "double" for c in V.STATS)


def test_player_feed_takes_older_shape(spark):
    df = spark.createDataFrame(
        [("0022500001", 7.0, 3.0, "Ann", None, "G", "12:30", 10, 4)],
        "gameId string, teamId double, personId double, firstName string, familyName string, "
        "position string, minutes string, points bigint, plusMinusPoints bigint",
    )
    out = N.normalize_player_v3(df)
    row = out.first()
    assert (row.GAME_ID, row.TEAM_ID, row.PLAYER_ID, row.PLAYER_NAME) == ("0022500001", 7, 3, "Ann")
    assert (row.START_POSITION, row.MIN, row.PTS) == ("G", "12:30", 10.0)
    assert dict(out.dtypes)["PLAYER_ID"] == "bigint"


def test_union_keeps_rows_and_fills_missing_columns(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, "y")], "k int, b string")
    assert rows(N.union_box_scores(a, b)) == [(1, "x", None), (2, None, "y")]


def test_ingest_takes_each_game_from_its_feed(spark, rows):
    older = spark.createDataFrame(
        [("0022400001", 1, 5), ("0022500001", 1, 6)], "GAME_ID string, TEAM_ID bigint, PTS bigint"
    )
    newer = spark.createDataFrame(
        [("0022400001", 1, "A", "B", 7), ("0022500001", 1, "A", "B", 8)],
        "gameId string, teamId bigint, firstName string, familyName string, points bigint",
    )
    out = N.ingest_box_scores(older, newer)
    assert rows(out, "GAME_ID", "PTS") == [("0022400001", 5.0), ("0022500001", 8.0)]


def test_repair_changes_only_what_differs(spark):
    df = spark.createDataFrame(
        [("g", 1.0, 5, 2, None, "05:00")],
        "GAME_ID string, PLAYER_ID double, PTS bigint, PLUS_MINUS int, COMMENT string, MIN string",
    )
    assert N.type_changes(df.schema) == {
        "PLAYER_ID": ("double", "bigint"), "PTS": ("bigint", "double"),
        "PLUS_MINUS": ("int", "double"),
    }
    out = N.repair(df)
    assert N.type_changes(out.schema) == {}
    assert out.first().asDict() == {
        "GAME_ID": "g", "PLAYER_ID": 1, "PTS": 5.0, "PLUS_MINUS": 2.0, "COMMENT": None,
        "MIN": "05:00",
    }


def test_dtypes_only_where_present(spark):
    df = spark.createDataFrame([(None, 3)], T.StructType().add("MIN", "string").add("X", "integer"))
    out = N.normalize_dtypes(df)
    assert out.first().MIN is None and out.columns == ["MIN", "X"]
