import datetime as dt
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from courtlake.operators import quality
from courtlake.plans import report
from courtlake.plans import season as S
from courtlake.schemas import STAR

D = dt.date


def frame(spark, table, entries):
    ddl = STAR[table].schema.simpleString()[7:-1]
    names = STAR[table].schema.names
    return spark.createDataFrame([tuple(e.get(n) for n in names) for e in entries], ddl)


@pytest.fixture(scope="module")
def league(spark):
    """A random season of four teams, as Python rows and as star tables."""
    rng = random.Random(3)
    dates = [D(2019, 11, 1) + dt.timedelta(days=i) for i in range(40)]
    kinds = {d: ("2019-20", rng.choice(["Regular Season"] * 3 + ["Playoffs"])) for d in dates}
    days = [{"date": d, "season": s, "season_type": k} for d, (s, k) in kinds.items()]
    # One date serves two season types and one a season without a type.
    days += [{"date": dates[0], "season": "2019-20", "season_type": "Pre-Season"},
             {"date": dates[1], "season": "2019-20", "season_type": None}]
    teams = [{"team_id": i, "abbreviation": "ABCD"[i], "name": f"Team {i}"} for i in range(4)]
    teams.append({"team_id": 1, "abbreviation": "BB", "name": "Old 1"})
    players = [{"player_id": 10 * t + k, "name": f"P{t}{k}", "position": pos}
               for t in range(4) for k in range(3) for pos in ("", "G", None)]
    games, team_stats, player_stats = [], [], []
    for i in range(120):
        h, a = rng.sample(range(4), 2)
        g = {"game_id": f"{i:05d}", "date": rng.choice(dates), "home_team_id": h,
             "away_team_id": a, "home_score": rng.randint(80, 90),
             "away_score": rng.randint(80, 90)}
        games.append(g)
        for t in (h, a):
            stat = lambda: {c: rng.randint(0, 20) for c in S.LOG_STATS if c not in S.PCT_STATS}
            pct = lambda: {c: rng.choice([None, 0.25, 0.5, 0.7125]) for c in S.PCT_STATS}
            team_stats.append({"game_id": g["game_id"], "team_id": t, **stat(), **pct()})
            for k in range(3):
                if rng.random() < 0.6:
                    line = {"game_id": g["game_id"], "team_id": t, "player_id": 10 * t + k,
                            **stat(), **pct()}
                    if rng.random() < 0.1:
                        line["pts"] = None
                    player_stats.append(line)
    data = {"dim_team": teams, "dim_player": players, "dim_date": days, "fact_game": games,
            "fact_game_team_stats": team_stats, "fact_game_player_stats": player_stats}
    star = {name: frame(spark, name, entries).cache() for name, entries in data.items()}
    regular = {d["date"] for d in days if d["season_type"] == "Regular Season"}
    data["in_season"] = {g["game_id"] for g in games if g["date"] in regular}
    return data, star


def mean(values):
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


@pytest.mark.parametrize("team", range(4))
def test_team_record(league, team):
    data, star = league
    played = [g for g in data["fact_game"]
              if g["game_id"] in data["in_season"] and team in (g["home_team_id"], g["away_team_id"])]
    pairs = [(g["home_score"], g["away_score"]) if g["home_team_id"] == team
             else (g["away_score"], g["home_score"]) for g in played]
    wins = sum(own > other for own, other in pairs)
    row = S.team_record(star, team, "2019-20").first()
    assert (row.wins, row.games, row.losses) == (wins, len(pairs), len(pairs) - wins)
    assert row.avg_pts_for == pytest.approx(mean([p for p, _ in pairs]))
    assert row.avg_pts_against == pytest.approx(mean([p for _, p in pairs]))
    every = S.team_record_all(star).where(F.col("team_id") == team).drop("team_id", "season")
    assert every.select(S.team_record(star, team, "2019-20").columns).first() == row


def test_record_of_nobody(league):
    _, star = league
    row = S.team_record(star, 99, "2019-20").first()
    assert (row.wins, row.games, row.losses, row.avg_pts_for) == (0, 0, 0, None)
    shown = S.team_summary(star, 99, "2019-20").first()
    assert tuple(shown) == ("0–0", "0.0", "0.0", "0.0%")


def test_game_log_and_averages(league, rows):
    data, star = league
    days = {g["game_id"]: g["date"] for g in data["fact_game"]}
    own = [t for t in data["fact_game_team_stats"]
           if t["team_id"] == 2 and t["game_id"] in data["in_season"]]
    own.sort(key=lambda t: (days[t["game_id"]], t["game_id"]))
    log = S.game_log(star, 2, "2019-20").collect()
    assert [(r.date, r.pts, r.fg_pct) for r in log] == [
        (days[t["game_id"]], t["pts"], t["fg_pct"]) for t in own
    ]
    assert len(log[0]) == 19
    trend = S.points_trend(star, 2, "2019-20").collect()
    assert [tuple(r) for r in trend] == [(r.date, r.pts) for r in log]
    averages = S.season_averages(star, 2, "2019-20").first()
    shown = S.season_averages_display(star, 2, "2019-20").first()
    for c in S.LOG_STATS:
        want = mean([t[c] for t in own])
        assert averages[c] == pytest.approx(want)
        if c not in S.PCT_STATS:
            assert shown[c] == f"{want:.1f}"
    share = S.avg_fg_pct(star, 2, "2019-20").first()[0]
    assert share == pytest.approx(mean([t["fg_pct"] for t in own]))


def test_rosters(league):
    data, star = league
    lines = defaultdict(list)
    for p in data["fact_game_player_stats"]:
        if p["team_id"] == 1 and p["game_id"] in data["in_season"]:
            lines[p["player_id"]].append(p)
    score = lambda p: None if p["pts"] is None else (
        p["pts"] + 0.4 * p["fgm"] - 0.7 * p["fga"] - 0.4 * (p["fta"] - p["ftm"]) + 0.7 * p["oreb"]
        + 0.3 * p["dreb"] + p["stl"] + 0.7 * p["ast"] + 0.7 * p["blk"] - 0.4 * p["pf"] - p["tov"])
    want = {f"P1{pid - 10}": (len(own), mean([p["pts"] for p in own]),
                              mean([p["ft_pct"] for p in own]), mean([score(p) for p in own]))
            for pid, own in lines.items() if len(own) >= 5}
    got = S.roster_game_score(star, 1, "2019-20").collect()
    assert {r.name for r in got} == set(want) and len(got) > 1
    for r in got:
        games, ppg, ft, gs = want[r.name]
        assert r.games == games and r.position == "G"
        assert r.ppg == pytest.approx(ppg) and r.ft_pct == pytest.approx(ft)
        assert r.game_score == pytest.approx(gs, abs=0.0051)
    assert [r.game_score for r in got] == sorted((r.game_score for r in got), reverse=True)
    by_points = [r.ppg for r in S.roster_stats(star, 1, "2019-20").collect()]
    assert by_points == sorted(by_points, reverse=True)
    shown = S.roster_table(star, 1, "2019-20")
    assert shown.columns == ["Player", "Pos", "GP", "PPG", "RPG", "APG", "SPG", "BPG", "FG%",
                             "3P%", "FT%"]
    every = S.roster_all(star).where("team_id = 1")
    assert every.count() == len(got)


def test_head_to_head_counts_a_renamed_team_once(league):
    data, star = league
    want = sorted(
        ((g["date"], g["game_id"]) for g in data["fact_game"]
         if g["game_id"] in data["in_season"] and {g["home_team_id"], g["away_team_id"]} == {1, 2}),
        reverse=True,
    )[:10]
    got = S.head_to_head(star, 2, 1, "2019-20").collect()
    assert [(r.date, r.game_id) for r in got] == want
    assert {r.home_team for r in got} | {r.away_team for r in got} == {"BB", "C"}
    shown = S.head_to_head_display(star, 1, 2, "2019-20")
    assert shown.columns == ["Date", "Home", "Away", "Home Pts", "Away Pts"]


def test_lists_and_report(league, rows):
    data, star = league
    assert [r.name for r in S.teams(star).collect()] == ["Old 1"] + [f"Team {i}" for i in range(4)]
    assert S.team_by_name(star, "Team 2").first().team_id == 2
    assert rows(S.seasons(star)) == [("2019-20",)]
    parts = report.warehouse_report(star, 1, "B")
    counts = dict(rows(parts["table_counts"]))
    assert counts == {name: len(data[name]) for name in STAR}
    assert parts["sample_fact_game"].count() == 5 and len(parts) == 11
    row = parts["home_away_counts"].first()
    assert row.home_games == sum(g["home_team_id"] == 1 for g in data["fact_game"])
    assert sum(r.dates for r in parts["season_type_counts"].collect()) == len(data["dim_date"])


def test_quality_checks(spark, rows):
    star = {name: frame(spark, name, []) for name in STAR}
    star["dim_team"] = frame(spark, "dim_team", [
        {"team_id": 1, "abbreviation": "TOOLONG", "name": "A"}, {"team_id": 1, "abbreviation": "B"},
        {"abbreviation": "C", "name": "C"},
    ])
    star["fact_game"] = frame(spark, "fact_game", [
        {"game_id": "g", "home_team_id": 1, "away_team_id": 9},
        {"game_id": "h", "home_team_id": 9, "away_team_id": None},
    ])
    assert rows(quality.pk_violations(star)) == [("dim_team", "1", 2)]
    assert rows(quality.fk_orphans(star)) == [
        ("fact_game", "away_team_id", "9", 1), ("fact_game", "home_team_id", "9", 1),
    ]
    nulls = {(r.tbl, r.column): r.null_rows for r in quality.null_violations(star).collect()}
    assert {k: v for k, v in nulls.items() if v} == {("dim_team", "team_id"): 1, ("dim_team", "name"): 1}
    long = quality.length_violations(star).where("long_rows > 0")
    assert rows(long) == [("dim_team", "abbreviation", 1)]


def test_one_scan_per_table_for_all_references(spark, tmp_path, plan):
    star = {}
    for name in STAR:
        frame(spark, name, []).write.parquet(f"{tmp_path}/{name}")
        star[name] = spark.read.parquet(f"{tmp_path}/{name}")
    scans = re.findall(r"Relation \[[^\]]*\] parquet|LogicalRelation", quality.fk_orphans(star)._jdf.queryExecution()
                       .optimizedPlan().toString())
    referring = sum(bool(t.references) for t in STAR.values())
    referred = len({p for t in STAR.values() for p in t.references.values()})
    assert len(scans) == referring + referred


def test_plans_without_broadcast_hints(spark, league, plan):
    """Beyond the broadcast threshold, joins fall back to sort-merge by themselves."""
    _, star = league
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (S.roster_game_score(star, 1, "2019-20"), S.head_to_head(star, 1, 2, "2019-20")):
            text = plan(df)
            assert "SortMergeJoin" in text
            assert "Broadcast" not in text and "CartesianProduct" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_latest_games_are_a_top_k(league, plan):
    _, star = league
    assert "TakeOrderedAndProject" in plan(S.head_to_head(star, 1, 2, "2019-20"))
