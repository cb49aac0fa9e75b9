"""Replacing landed dates: a stop at any point loses nothing, and the next writer finishes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_landing import D, drifting, games  # noqa: F401

from courtlake.sources import landing, publish


class Stop(Exception):
    pass


def state(spark, root):
    df = landing.scan_repaired(spark, root, "team_stats")
    return sorted((str(r.date), r.GAME_ID, r.PTS) for r in df.collect())


@pytest.mark.parametrize("write", [1, 2])
def test_repair_stopped_between_its_writes(spark, drifting, tmp_path, monkeypatch, write):  # noqa: F811
    """Stopped before the pointer nothing has changed; after it readers see the repaired rows."""
    before = state(spark, drifting)
    calls = []
    real = publish.write_dates

    def stopping(df, path):
        calls.append(path)
        if len(calls) == write:
            raise Stop
        real(df, path)

    monkeypatch.setattr(publish, "write_dates", stopping)
    with pytest.raises(Stop):
        landing.repair_in_place(spark, drifting, "team_stats", f"{tmp_path}/staging")
    monkeypatch.setattr(publish, "write_dates", real)
    assert (publish.pending(spark, drifting, "team_stats") is not None) == (write == 2)
    assert state(spark, drifting) == before
    landing.repair_in_place(spark, drifting, "team_stats", f"{tmp_path}/staging")
    assert publish.pending(spark, drifting, "team_stats") is None
    assert state(spark, drifting) == before
    assert len(landing.schema_groups(spark, f"{drifting}/team_stats")) == 1


def test_half_copied_generation_is_finished_before_a_landing(spark, drifting, tmp_path, monkeypatch):  # noqa: F811
    """The copy stops after one date; a landing of another date comes next and stays."""
    real = publish.write_dates

    def half(df, path):
        if "staging" not in path:
            real(df.where("date = '2020-08-01'"), path)
            raise Stop
        real(df, path)

    before = state(spark, drifting)
    monkeypatch.setattr(publish, "write_dates", half)
    with pytest.raises(Stop):
        landing.repair_in_place(spark, drifting, "team_stats", f"{tmp_path}/staging")
    monkeypatch.setattr(publish, "write_dates", real)
    assert state(spark, drifting) == before
    new = landing.scan_repaired(spark, drifting, "team_stats").where("date = '2020-09-01'").withColumn("PTS", F.lit(50.0))
    landing.land(spark.createDataFrame(new.collect(), new.schema), drifting, "team_stats")
    after = state(spark, drifting)
    assert [r[2] for r in after if r[0] == "2020-09-01"] == [50.0]
    assert [r for r in after if r[0] != "2020-09-01"] == [r for r in before if r[0] != "2020-09-01"]


def test_folder_without_a_date_is_repaired(spark, drifting, tmp_path):  # noqa: F811
    row = spark.createDataFrame([("null", 1, 8, "x", "1:00")],
                                "GAME_ID string, TEAM_ID bigint, PTS bigint, comment string, MIN string")
    row.write.parquet(f"{drifting}/team_stats/date=__HIVE_DEFAULT_PARTITION__")
    before = state(spark, drifting)
    assert landing.repair_in_place(spark, drifting, "team_stats", f"{tmp_path}/staging") == 7
    assert state(spark, drifting) == before and ("None", "null", 8.0) in before
    assert len(landing.schema_groups(spark, f"{drifting}/team_stats")) == 1


@pytest.mark.parametrize("months", [3, 6, 12])
def test_finder_opens_only_chunks_with_such_days(spark, tmp_path, rows, months):
    root = str(tmp_path)
    bounds = spark.createDataFrame([(D(2018, 1, 1), D(2020, 12, 31))], "start date, end date")
    days = [D(2018, 1, 1) + dt.timedelta(days=7 * i) for i in range(150)]
    of = {r.day: r.date for r in landing.chunk_days(landing.chunk_plan(bounds, months)).collect()}
    played = [(f"00{i}", str(d), str(of[d])) for i, d in enumerate(days)]
    # A daily folder inside a chunk, and games that were landed without a chunk's date.
    played += [("00daily", "2019-05-09", "2019-05-09")]
    landing.land(games(spark, played), root, "games")
    none = games(spark, [("00none", "2019-05-10", "2019-05-09")]).withColumn("date", F.lit(None).cast("date"))
    landing.land(none, root, "games")
    index, scan = landing.chunk_index(spark, root, "games"), landing.scan(spark, root, "games")
    found = landing.find_games(scan, D(2019, 5, 1), D(2019, 6, 20), index=index)
    want = [(i,) for i, d, _ in played if "2019-05-01" <= d <= "2019-06-20"] + [("00none",)]
    assert rows(found, "GAME_ID") == sorted(want)
    opened = {r.date for r in landing.without_chunks(scan, index, D(2019, 5, 1), D(2019, 6, 20)).select("date").collect()}
    overlap = {of[d] for d in of if D(2019, 5, 1) <= d <= D(2019, 6, 20) and d in days}
    assert opened == overlap | {D(2019, 5, 9), None}
    text = found._jdf.queryExecution().simpleString()
    assert "date" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_landing_again_replaces_the_chunk_in_the_index(spark, tmp_path, rows):
    root = str(tmp_path)
    landing.land(games(spark, [("001", "2019-01-05", "2019-01-01"), ("002", "2019-07-05", "2019-07-01")]), root, "games")
    landing.land(games(spark, [("003", "2019-03-09", "2019-01-01")]), root, "games")
    index = landing.chunk_index(spark, root, "games")
    assert rows(index) == [("2019-03-09", "2019-03-09", 1, D(2019, 1, 1)), ("2019-07-05", "2019-07-05", 1, D(2019, 7, 1))]
    found = landing.find_games(landing.scan(spark, root, "games"), D(2019, 1, 1), D(2019, 2, 1), index=index)
    assert found.isEmpty()
