import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from courtlake.functions import display, league


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_season_label_and_type(spark):
    ids = ["22019", "21999", "21998", "42023", "12099", "32020", "52020", "x", None]
    assert column(spark, ids, "string", league.season_label) == [
        "2019-20", "1999-00", "1998-99", "2023-24", "2099-00", "2020-21", "2020-21", None, None,
    ]
    assert column(spark, ids, "string", league.season_type) == [
        "Regular Season", "Regular Season", "Regular Season", "Playoffs", "Pre-Season",
        None, None, None, None,
    ]


def test_dates(spark):
    texts = ["2024-02-29", "2023-02-29", "nonsense", None]
    got = column(spark, texts, "string", lambda c: league.us_date(league.game_date(c)))
    assert got == ["02/29/2024", None, None, None]


def test_routing_by_season_year(spark):
    ids = ["0022500001", "0022400001", "0029900001", "0020000001", "abc", None]
    assert column(spark, ids, "string", league.uses_new_feed) == [
        True, False, True, False, False, False,
    ]


def test_in_progress(spark):
    statuses = ["2", " 2 ", "Q3 5:32", " Q1", "OT", "OT2 1:00", "Q5", "Halftime", "End Q1",
                "Final", "3", "", None]
    assert column(spark, statuses, "string", league.in_progress) == [
        True, True, True, True, True, True, False, False, False, False, False, False, False,
    ]


def test_full_name(spark):
    df = spark.createDataFrame(
        [("A", "B"), (None, "B"), ("A", None), (None, None), ("\tA ", " B\n"), ("\u00a0A", "B\u3000")],
        "f string, l string",
    )
    got = [r[0] for r in df.select(league.full_name(F.col("f"), F.col("l"))).collect()]
    assert got == ["A B", "B", "A", "", "A   B", "A B"]


def test_ratio_without_attempts(spark):
    df = spark.createDataFrame([(1, 2), (0, 0), (None, 3)], "m int, a int")
    got = [r[0] for r in df.select(league.ratio(F.col("m"), F.col("a"))).collect()]
    assert got == [0.5, None, None]


def test_one_decimal_rounds_like_python(spark):
    rng = random.Random(7)
    values = [112.25, 112.75, 0.15, 0.25, 2.35, 2.45, 0.05, 0.35, -0.04, -2.25, 0.0, 99.95, 1e7]
    values += [rng.randint(0, 4000) / 20 for _ in range(500)]
    values += [rng.randint(0, 99999) / rng.randint(1, 500) for _ in range(500)]
    got = column(spark, values, "double", display.one_decimal)
    assert got == [f"{v:.1f}" for v in values]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(0, 1e6), min_size=1, max_size=200))
def test_one_decimal_any_value(spark, values):
    got = column(spark, values, "double", display.one_decimal)
    assert got == [f"{v:.1f}" for v in values]


def test_display_texts(spark):
    assert column(spark, [0.5, 0.7125, 1.0, None], "double", display.percent) == [
        "50.0%", "71.2%", "100.0%", None,
    ]
    assert column(spark, ["x", None], "string", display.or_missing) == ["x", "—"]
    assert column(spark, [3, 0, None], "int", display.quarter_label) == ["Q3", "", ""]
