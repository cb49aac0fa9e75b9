import calendar
import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from courtlake.schemas import RAW
from courtlake.sources import landing

D = dt.date


def games(spark, entries):
    """(game id, day, partition)"""
    full = [(g, "22019", day, 1, "A", "Aces", "A vs. B", 1.0, D.fromisoformat(part))
            for g, day, part in entries]
    return spark.createDataFrame(full, RAW["games"].simpleString()[7:-1] + ", date date")


def step(day, months):
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return D(year, month + 1, min(day.day, last))


def chunks(start, end, months):
    out, cursor = [], start
    while cursor <= end:
        last = min(step(cursor, months) - dt.timedelta(days=1), end)
        out.append((cursor, last))
        cursor = last + dt.timedelta(days=1)
    return out


def test_landing_replaces_only_its_partitions(spark, tmp_path, rows):
    root = str(tmp_path)
    landing.land(games(spark, [("g1", "2020-01-05", "2020-01-01"),
                               ("g2", "2020-07-05", "2020-07-01")]), root, "games")
    landing.land(games(spark, [("g3", "2020-07-06", "2020-07-01")]), root, "games")
    got = rows(landing.scan(spark, root, "games"), "GAME_ID", "date")
    assert got == [("g1", D(2020, 1, 1)), ("g3", D(2020, 7, 1))]


def test_game_finder_prunes_partitions(spark, tmp_path, rows, plan):
    root = str(tmp_path)
    landing.land(games(spark, [
        ("001", "2019-12-31", "2019-07-01"), ("002", "2020-01-01", "2020-01-01"),
        ("003", "2020-06-30", "2020-01-01"), ("104", "2020-03-01", "2020-01-01"),
        ("005", "2020-07-01", "2020-07-01"), ("006", "2021-07-01", "2021-07-01"),
    ]), root, "games")
    df = landing.scan(spark, root, "games")
    found = landing.find_games(df, D(2019, 12, 31), D(2020, 7, 1))
    assert rows(found, "GAME_ID") == [("001",), ("002",), ("003",), ("005",)]
    text = plan(landing.find_games(df, D(2020, 1, 1), D(2020, 6, 30), months=6))
    assert "PartitionFilters: [isnotnull(date" in text and "2019-07-01" in text
    assert "PushedFilters: [IsNotNull(GAME_DATE)" in text


@pytest.mark.parametrize("start,end,months", [
    (D(2019, 10, 1), D(2021, 3, 14), 6), (D(2020, 1, 31), D(2021, 1, 31), 1),
    (D(2020, 1, 30), D(2020, 12, 30), 3), (D(2020, 2, 29), D(2024, 2, 29), 12),
    (D(2020, 5, 5), D(2020, 5, 5), 1), (D(2020, 5, 5), D(2020, 5, 4), 1),
    (D(2020, 1, 31), D(2020, 3, 28), 1),
])
def test_chunk_plan(spark, start, end, months):
    check_plan(spark, start, end, months)


@settings(max_examples=15, deadline=None)
@given(st.dates(D(1995, 1, 1), D(2030, 1, 1)), st.integers(0, 900), st.integers(1, 13))
def test_chunk_plan_any_span(spark, start, days, months):
    check_plan(spark, start, start + dt.timedelta(days=days), months)


def check_plan(spark, start, end, months):
    bounds = spark.createDataFrame([(start, end)], "start date, end date")
    plan = landing.chunk_plan(bounds, months).orderBy("chunk_start").collect()
    want = chunks(start, end, months)
    assert [(r.chunk_start, r.chunk_end) for r in plan] == want
    assert [r.date_from for r in plan] == [a.strftime("%m/%d/%Y") for a, _ in want]


def test_pending_chunks_and_days(spark, rows):
    bounds = spark.createDataFrame([(D(2020, 1, 1), D(2020, 3, 10))], "start date, end date")
    plan = landing.chunk_plan(bounds, 1)
    landed = games(spark, [("g", "2020-02-03", "2020-02-01"), ("h", "2020-02-04", "2020-02-01")])
    assert rows(landing.pending_chunks(plan, landed), "chunk_start") == [
        (D(2020, 1, 1),), (D(2020, 3, 1),),
    ]
    days = landing.chunk_days(plan)
    assert days.count() == 31 + 29 + 10
    assert days.where(F.col("day") == "2020-02-29").first().date == D(2020, 2, 1)


def test_chunk_game_counts(spark, rows):
    df = games(spark, [("g", "2020-01-01", "2020-01-01"), ("g", "2020-01-01", "2020-01-01"),
                       ("h", "2020-01-02", "2020-01-01"), ("i", "2020-07-02", "2020-07-01")])
    assert rows(landing.chunk_game_counts(df)) == [(D(2020, 1, 1), 2), (D(2020, 7, 1), 1)]


@pytest.fixture
def drifting(spark, tmp_path):
    """Points as DOUBLE, then BIGINT; one folder holds both; comment in two cases."""
    def write(folder, ddl, value, comment):
        df = spark.createDataFrame([("g" + folder[-5:], 1, value, comment, "05:00")], ddl)
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/raw/team_stats/date={folder}")

    old = "GAME_ID string, TEAM_ID bigint, PTS double, COMMENT string, MIN string"
    new = "GAME_ID string, TEAM_ID bigint, PTS bigint, comment string, MIN string"
    for month in range(1, 8):
        write(f"2020-{month:02d}-01", old, 1.5, "old")
    write("2020-07-01", new, 2, "new")
    for month in range(8, 13):
        write(f"2020-{month:02d}-01", new, 3, "new")
    return f"{tmp_path}/raw"


def test_schema_groups_and_repaired_scan(spark, drifting):
    groups = landing.schema_groups(spark, f"{drifting}/team_stats")
    assert len(groups) == 2
    changes = [g.changes for g in groups]
    assert sorted(len(c) for c in changes) == [0, 1]
    df = landing.scan_repaired(spark, drifting, "team_stats")
    assert df.count() == 13 and dict(df.dtypes)["PTS"] == "double"
    assert df.agg(F.sum("PTS")).first()[0] == 7 * 1.5 + 2 + 5 * 3
    assert dict(df.dtypes)["MIN"] == "string"
    assert df.where("date = '2020-07-01'").count() == 2


def test_game_finder_reads_chunks_of_any_length(spark, tmp_path, rows):
    root = str(tmp_path)
    landing.land(games(spark, [
        ("001", "2019-10-05", "2019-01-01"), ("002", "2019-10-06", "2019-10-06"),
        ("003", "2019-11-01", "2019-10-01"),
    ]), root, "games")
    found = landing.find_games(landing.scan(spark, root, "games"), D(2019, 10, 1), D(2019, 10, 31))
    assert rows(found, "GAME_ID") == [("001",), ("002",)]


def test_a_second_repair_leaves_newer_data(spark, drifting, tmp_path):
    staging = f"{tmp_path}/staging"
    assert landing.repair_in_place(spark, drifting, "team_stats", staging) == 6
    path = f"{drifting}/team_stats"
    before = spark.read.parquet(path)
    dates = sorted({r.date for r in before.select("date").collect()})
    corrected = before.where(F.col("date") == dates[1]).withColumn("PTS", F.lit(99.0))
    drifted = before.where(F.col("date") == dates[-1]).withColumn("PTS", F.lit(7).cast("bigint"))
    batches = [spark.createDataFrame(x.collect(), x.schema) for x in (corrected, drifted)]
    for batch in batches:
        landing.land(batch, drifting, "team_stats")
    landing.repair_in_place(spark, drifting, "team_stats", staging)
    after = spark.read.option("mergeSchema", True).parquet(path)
    assert {r.PTS for r in after.where(F.col("date") == dates[1]).collect()} == {99.0}
    assert after.count() == 13


def test_repair_in_place_touches_only_what_differs(spark, drifting, tmp_path):
    before = spark.read.schema("_ int").parquet(f"{drifting}/team_stats/date=2020-01-01").inputFiles()
    assert landing.repair_in_place(spark, drifting, "team_stats", f"{tmp_path}/staging") == 6
    after = spark.read.schema("_ int").parquet(f"{drifting}/team_stats/date=2020-01-01").inputFiles()
    assert before == after
    df = spark.read.option("mergeSchema", True).parquet(f"{drifting}/team_stats")
    assert df.count() == 13 and dict(df.dtypes)["PTS"] == "double"
    assert landing.repair_in_place(spark, drifting, "team_stats", f"{tmp_path}/staging2") == 0
