"""Facts stored by season: what is read, and daily sums that follow the facts."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from courtlake.plans import rollup, star
from courtlake.plans import season as S
from courtlake.schemas import NO_SEASON, RAW, SEASON_FOLDER, STAR
from courtlake.sources import landing
from courtlake.sources.warehouse import Warehouse

D = dt.date
YEARS = range(2015, 2020)


def raw_tables(spark, games):
    """Raw rows of (game, day, season id, {team: points}); players 1 and 2 of a team share its points."""
    g, t, p = [], [], []
    for game, day, sid, teams in games:
        for (team, pts), mark in zip(teams.items(), (" vs. ", " @ ")):
            base = {"GAME_ID": game, "TEAM_ID": team, "TEAM_NAME": f"Team {team}", "TEAM_ABBREVIATION": f"T{team}",
                    "PTS": float(pts)}
            g.append({**base, "SEASON_ID": sid, "GAME_DATE": day, "MATCHUP": f"A{mark}B"})
            t.append({**base, "FG_PCT": 1 / 3 if pts % 2 else None, "REB": 3.0})
            p += [{**base, "PLAYER_ID": team * 10 + k, "PLAYER_NAME": f"P{team}{k}", "PTS": float(pts) / 2, "FGM": 2.0,
                   "FGA": 4.0, "FTA": 1.0, "FTM": 1.0, "OREB": 0.0, "DREB": 1.0, "STL": 0.0, "AST": 1.0, "BLK": 0.0,
                   "PF": 0.0, "TO": 1.0, "FG_PCT": 0.5} for k in (1, 2)]
    made = {"games": g, "team_stats": t, "player_stats": p}
    return {n: spark.createDataFrame([tuple(r.get(c) for c in RAW[n].names) for r in made[n]], RAW[n]) for n in RAW}


def season_games(year, start=0, count=24):
    return [(f"00{year}{i:04d}", str(D(year, 11, 1) + dt.timedelta(days=i // 2)), f"2{year}",
             {1 + i % 3: 80 + i, 4: 90 - i % 7}) for i in range(start, start + count)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    store = Warehouse(spark, str(tmp_path_factory.mktemp("folders") / "star"))
    raw = raw_tables(spark, [g for year in YEARS for g in season_games(year)])
    star.load_star(raw, store)
    rollup.build_rollups(store)
    return store, raw


def tables(store, rollups=True):
    return {t: store.stored(t) for t in (*STAR, *(rollup.ROLLUPS if rollups else ()))}


def plain(store):
    return {t: store.read(t) for t in STAR}


def test_folders_follow_the_games(stored, rows):
    store, _ = stored
    for table in ("fact_game", "fact_game_team_stats", "fact_game_player_stats"):
        assert SEASON_FOLDER not in store.read(table).columns
        assert rows(store.stored(table).select(SEASON_FOLDER).distinct()) == [(y,) for y in YEARS]


QUESTIONS = {
    "team_record": lambda s: S.team_record(s, 1, "2017-18"),
    "team_record_all": lambda s: S.team_record_all(s, "2017-18"),
    "game_log": lambda s: S.game_log(s, 4, "2017-18"),
    "season_averages": lambda s: S.season_averages(s, 4, "2017-18"),
    "roster_game_score": lambda s: S.roster_game_score(s, 4, "2017-18"),
    "head_to_head": lambda s: S.head_to_head(s, 1, 4, "2017-18"),
    "season_averages_all": lambda s: S.season_averages_all(s, "2017-18"),
    "roster_all": lambda s: S.roster_all(s, "2017-18"),
}


def rounded(found):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in found), key=repr)


@pytest.mark.parametrize("name", QUESTIONS)
def test_same_answers_with_and_without_folders(stored, name, plan):
    store, _ = stored
    ask = QUESTIONS[name]
    want = rounded(ask(plain(store)).collect())
    assert want and rounded(ask(tables(store, rollups=False)).collect()) == want
    assert rounded(ask(tables(store)).collect()) == want
    assert "dynamicpruning" in plan(ask(tables(store)))


def test_a_season_of_a_team_is_read_in_four_jobs(spark, stored, plan):
    store, _ = stored
    group = "game-log"
    spark.sparkContext.setJobGroup(group, group)
    try:
        S._team_games(tables(store), 4, "2017-18").write.format("noop").mode("overwrite").save()
    finally:
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    text = plan(S.game_log(tables(store), 4, "2017-18"))
    assert len(re.findall(r"FileScan parquet [^\n]*/fact_game[,\]]", text)) == 1, text
    assert text.count("dynamicpruning") >= 2
    assert jobs <= 4, jobs


def test_rows_before_their_game_are_still_found(spark, stored, tmp_path, rows):
    store = Warehouse(spark, str(tmp_path / "star"))
    raw = raw_tables(spark, season_games(2017))
    store.append_new("fact_game_team_stats", star.build_table("fact_game_team_stats", raw))
    assert rows(store.stored("fact_game_team_stats").select(SEASON_FOLDER).distinct()) == [(NO_SEASON,)]
    star.load_star(raw, store)
    whole = stored[0]
    assert S.game_log(tables(store, False), 4, "2017-18").collect() == S.game_log(tables(whole), 4, "2017-18").collect()


def sums(store, table):
    return sorted(map(tuple, rollup.held(store.read(table), table).collect()), key=repr)


def recomputed(store, table):
    facts = {t: store.stored(t) for t in STAR if store.exists(t)}
    return sorted(map(tuple, rollup.computed(facts, table).collect()), key=repr)


def test_rollup_follows_the_daily_job(spark, tmp_path):
    root, store = str(tmp_path / "raw"), Warehouse(spark, str(tmp_path / "star"))

    def land(games, day):
        for name, df in raw_tables(spark, games).items():
            landing.land(df.withColumn("date", F.lit(day)), root, name)

    land(season_games(2017), D(2017, 10, 1))
    star.load_day(spark, root, store, D(2017, 10, 1))
    rollup.build_rollups(store)
    before = sums(store, "team_days")
    # A later landing has more games of days that are known, and games of new days.
    land(season_games(2017, 20, 10) + [("0099", "2017-11-03", "22017", {1: 70, 4: 71})], D(2017, 11, 11))
    assert star.load_day(spark, root, store, D(2017, 11, 11))["fact_game"] == 7
    for table in rollup.ROLLUPS:
        assert sums(store, table) == recomputed(store, table)
    assert sums(store, "team_days") != before
    size = store.read("team_days").count()
    star.load_day(spark, root, store, D(2017, 11, 11))
    assert store.read("team_days").count() == size
    assert rounded(S.season_averages_all(tables(store), "2017-18").collect()) == rounded(
        S.season_averages_all(plain(store), "2017-18").collect())


def test_rollup_takes_out_what_the_facts_lost(spark, stored, tmp_path):
    """A corrected table without some rows: a refresh of their days retracts them."""
    store, _ = stored
    mine = Warehouse(spark, str(tmp_path / "star"))
    mine.append("fact_game", store.read("fact_game"))
    mine.append("fact_game_team_stats", store.read("fact_game_team_stats"))
    rollup.build_rollups(mine)
    lost = Warehouse(spark, str(tmp_path / "corrected"))
    games = store.read("fact_game")
    lost.append("fact_game", games)
    lost.append("fact_game_team_stats", store.read("fact_game_team_stats").where("game_id NOT LIKE '%0003' AND team_id <> 2"))
    lost.append("team_days", mine.read("team_days"))
    assert sums(lost, "team_days") != recomputed(lost, "team_days")
    assert rollup.refresh(lost, games.select("date"))["team_days"] > 0
    assert sums(lost, "team_days") == recomputed(lost, "team_days")
    assert rollup.refresh(lost, games.select("date"))["team_days"] == 0
    assert {r.team_id for r in S.season_averages_all(
        {**plain(lost_dims(lost, store)), "team_days": lost.stored("team_days")}, "2017-18").collect()} == {1, 3, 4}


def lost_dims(lost, store):
    for table in STAR:
        if not lost.exists(table):
            lost.append(table, store.read(table))
    return lost
