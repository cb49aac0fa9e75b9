"""Independent SQL for the registered queries, over the same test tables.

Each text is made of the common table expressions it needs and one final SELECT. Dates and
times are returned as text and fractions rounded to six places, as the registered queries do.
"""

from __future__ import annotations

import re

TEAM, PAIR, SEASON = 3, (0, 1), "1997-98"

_STATS = ["FGM", "FGA", "FG3M", "FG3A", "FTM", "FTA", "OREB", "DREB", "REB",
          "AST", "STL", "BLK", '"TO"', "PF", "PTS"]
_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _STATS)
_RATIOS = ", ".join(
    f"CAST({m} AS DOUBLE) / nullif({a}, 0) AS {p}"
    for p, m, a in [("FG_PCT", "FGM", "FGA"), ("FG3_PCT", "FG3M", "FG3A"), ("FT_PCT", "FTM", "FTA")]
)
_LOG = ["pts", "fgm", "fga", "fg_pct", "fg3m", "fg3a", "fg3_pct", "ftm", "fta", "ft_pct",
        "oreb", "dreb", "reb", "ast", "stl", "blk", "tov", "pf"]
_PCT = ["fg_pct", "fg3_pct", "ft_pct"]
_MEANS = {"ppg": "pts", "rpg": "reb", "apg": "ast", "spg": "stl", "bpg": "blk",
          "fg_pct": "fg_pct", "fg3_pct": "fg3_pct", "ft_pct": "ft_pct"}

CTES = {
    # ── fixtures ──
    "lines0": """
        SELECT l_orderkey AS game_key, l_suppkey % 10 AS TEAM_ID, l_partkey % 50 AS PLAYER_ID,
               lpad(CAST(l_orderkey AS VARCHAR),
                    CAST(greatest(10, length(CAST(l_orderkey AS VARCHAR))) AS INTEGER), '0') AS GAME_ID,
               CASE l_returnflag WHEN 'A' THEN 'G' WHEN 'N' THEN 'F' ELSE '' END AS START_POSITION,
               CASE l_linestatus WHEN 'F' THEN 'Starters' ELSE 'Bench' END AS LINEUP,
               CAST(l_linenumber AS BIGINT) AS n, CAST(l_quantity AS BIGINT) AS q,
               CAST(round(l_discount * 100) AS BIGINT) AS d, CAST(round(l_tax * 100) AS BIGINT) AS x
        FROM lineitem""",
    "lines": """
        SELECT game_key, GAME_ID, TEAM_ID, PLAYER_ID, 'Player ' || PLAYER_ID AS PLAYER_NAME,
               START_POSITION, LINEUP, q || ':00' AS "MIN",
               greatest(q - d, 0) AS FGM, q AS FGA, least(d, x) AS FG3M, d AS FG3A,
               x - x % 3 AS FTM, x AS FTA, n % 3 AS OREB, n AS DREB, n % 3 + n AS REB,
               x AS AST, d % 3 AS STL, x % 3 AS BLK, d % 4 AS "TO", x % 6 AS PF,
               2 * greatest(q - d, 0) + least(d, x) + x - x % 3 AS PTS, q - 25 AS PLUS_MINUS
        FROM lines0""",
    "od": """
        SELECT o_orderkey AS game_key, CAST(o_orderdate AS DATE) AS day,
               o_orderpriority[1] || year(o_orderdate) AS SEASON_ID
        FROM orders""",
    "chunk0": """
        SELECT CAST(unnest(generate_series(CAST(min(day) AS TIMESTAMP), CAST(max(day) AS TIMESTAMP),
                                           INTERVAL 6 MONTH)) AS DATE) AS s, max(day) AS e
        FROM od""",
    "chunks": """
        SELECT s AS chunk_start,
               least(CAST(s + INTERVAL 6 MONTH AS DATE) - 1, e) AS chunk_end FROM chunk0""",
    "dated": """
        SELECT od.*, chunks.chunk_start AS date FROM od
        JOIN chunks ON od.day BETWEEN chunk_start AND chunk_end""",
    "team_totals": f"""
        SELECT game_key, GAME_ID, TEAM_ID, {_SUMS},
               CAST(sum(PLUS_MINUS) AS BIGINT) AS PLUS_MINUS
        FROM lines GROUP BY game_key, GAME_ID, TEAM_ID""",
    "slots": """
        SELECT game_key, GAME_ID, TEAM_ID, PTS,
               row_number() OVER (PARTITION BY game_key ORDER BY TEAM_ID) AS slot,
               min(TEAM_ID) OVER (PARTITION BY game_key) AS first_team,
               lead(TEAM_ID) OVER (PARTITION BY game_key ORDER BY TEAM_ID) AS next_team
        FROM team_totals""",
    "games": """
        SELECT GAME_ID, SEASON_ID, strftime(day, '%Y-%m-%d') AS GAME_DATE, TEAM_ID,
               'T' || lpad(CAST(TEAM_ID AS VARCHAR), 2, '0') AS TEAM_ABBREVIATION,
               s_name AS TEAM_NAME,
               'T' || lpad(CAST(TEAM_ID AS VARCHAR), 2, '0')
                 || CASE slot WHEN 1 THEN ' vs. T' ELSE ' @ T' END
                 || lpad(CAST(CASE slot WHEN 1 THEN coalesce(next_team, TEAM_ID)
                              ELSE first_team END AS VARCHAR), 2, '0') AS MATCHUP,
               CAST(PTS AS DOUBLE) AS PTS, day, date
        FROM slots JOIN dated USING (game_key) JOIN supplier ON s_suppkey = TEAM_ID
        WHERE slot <= 2""",
    "player_raw": f"""
        SELECT lines.*, {_RATIOS}, date FROM lines JOIN dated USING (game_key)""",
    "team_raw": f"""
        SELECT team_totals.*, 'T' || lpad(CAST(TEAM_ID AS VARCHAR), 2, '0') AS TEAM_ABBREVIATION,
               s_name AS TEAM_NAME, {_RATIOS}, date
        FROM team_totals JOIN dated USING (game_key) JOIN supplier ON s_suppkey = TEAM_ID""",
    "feed": f"""
        SELECT '002' || lpad(CAST(year(day) % 100 AS VARCHAR), 2, '0') || GAME_ID AS GAME_ID,
               lines.* EXCLUDE (GAME_ID), {_RATIOS}
        FROM lines JOIN od USING (game_key)""",
    "lineup_totals": f"""
        SELECT GAME_ID, TEAM_ID, 'T' || lpad(CAST(TEAM_ID AS VARCHAR), 2, '0') AS TEAM_ABBREVIATION,
               s_name AS TEAM_NAME, {_SUMS}
        FROM lines JOIN supplier ON s_suppkey = TEAM_ID GROUP BY ALL""",
    "feed_totals": f"""
        SELECT GAME_ID, TEAM_ID, 'T' || lpad(CAST(TEAM_ID AS VARCHAR), 2, '0') AS TEAM_ABBREVIATION,
               s_name AS TEAM_NAME, {_SUMS}, CAST(sum(PLUS_MINUS) AS BIGINT) AS PLUS_MINUS
        FROM feed JOIN supplier ON s_suppkey = TEAM_ID GROUP BY ALL""",
    # ── star ──
    "dim_team": """
        SELECT DISTINCT TEAM_ID AS team_id, TEAM_ABBREVIATION AS abbreviation, TEAM_NAME AS name,
               CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS conference,
               CAST(NULL AS VARCHAR) AS division
        FROM games""",
    "dim_player": """
        SELECT DISTINCT PLAYER_ID AS player_id, PLAYER_NAME AS name, START_POSITION AS position,
               CAST(NULL AS VARCHAR) AS height, CAST(NULL AS INTEGER) AS weight
        FROM player_raw""",
    "dim_date": """
        SELECT DISTINCT day AS date,
               SEASON_ID[2:5] || '-'
                 || lpad(CAST((CAST(SEASON_ID[2:5] AS INTEGER) + 1) % 100 AS VARCHAR), 2, '0') AS season,
               CASE SEASON_ID[1] WHEN '1' THEN 'Pre-Season' WHEN '2' THEN 'Regular Season'
                                 WHEN '4' THEN 'Playoffs' END AS season_type
        FROM games""",
    "fact_game": """
        SELECT h.GAME_ID AS game_id, h.day AS date, h.TEAM_ID AS home_team_id,
               a.TEAM_ID AS away_team_id, CAST(h.PTS AS BIGINT) AS home_score,
               CAST(a.PTS AS BIGINT) AS away_score
        FROM games h JOIN games a ON h.GAME_ID = a.GAME_ID
        WHERE contains(h.MATCHUP, ' vs. ') AND contains(a.MATCHUP, ' @ ')""",
    "team_stats": """
        SELECT GAME_ID AS game_id, TEAM_ID AS team_id, FGM AS fgm, FGA AS fga, FG_PCT AS fg_pct,
               FG3M AS fg3m, FG3A AS fg3a, FG3_PCT AS fg3_pct, FTM AS ftm, FTA AS fta,
               FT_PCT AS ft_pct, OREB AS oreb, DREB AS dreb, REB AS reb, AST AS ast, STL AS stl,
               BLK AS blk, "TO" AS tov, PF AS pf, PTS AS pts, PLUS_MINUS AS plus_minus
        FROM team_raw""",
    "player_rows": """
        SELECT GAME_ID AS game_id, PLAYER_ID AS player_id, TEAM_ID AS team_id, "MIN" AS min,
               PTS AS pts, FGM AS fgm, FGA AS fga, FG_PCT AS fg_pct, FG3M AS fg3m, FG3A AS fg3a,
               FG3_PCT AS fg3_pct, FTM AS ftm, FTA AS fta, FT_PCT AS ft_pct, OREB AS oreb,
               DREB AS dreb, REB AS reb, AST AS ast, STL AS stl, BLK AS blk, "TO" AS tov,
               PF AS pf, PLUS_MINUS AS plus_minus
        FROM player_raw""",
    "player_stats": f"""
        SELECT * FROM player_rows QUALIFY row_number() OVER (
            PARTITION BY game_id, player_id
            ORDER BY {", ".join(f"{c} NULLS FIRST" for c in ["team_id", "min", *_LOG, "plus_minus"])}
        ) = 1""",
    "regular": """
        SELECT * FROM dim_date WHERE season_type = 'Regular Season'""",
    "names": """
        SELECT team_id, max(abbreviation) AS abbreviation FROM dim_team GROUP BY team_id""",
    "players": """
        SELECT player_id, max(name) AS name, max(position) AS position
        FROM dim_player GROUP BY player_id""",
    "sides": """
        SELECT game_id, date, home_team_id AS team_id, home_score AS pf, away_score AS pa FROM fact_game
        UNION ALL
        SELECT game_id, date, away_team_id, away_score, home_score FROM fact_game""",
    "records": """
        SELECT team_id, season, CAST(count_if(pf > pa) AS BIGINT) AS wins, count(*) AS games,
               avg(pf) AS avg_pts_for, avg(pa) AS avg_pts_against,
               count(*) - CAST(count_if(pf > pa) AS BIGINT) AS losses
        FROM sides JOIN regular USING (date) GROUP BY team_id, season""",
    "team_log": """
        SELECT t.*, g.date, r.season FROM team_stats t
        JOIN fact_game g USING (game_id) JOIN regular r ON g.date = r.date""",
    "player_log": """
        SELECT p.*, r.season,
               10*pts + 4*fgm - 7*fga - 4*(fta - ftm) + 7*oreb + 3*dreb + 10*stl + 7*ast + 7*blk
                 - 4*pf - 10*tov AS tenths
        FROM player_stats p
        JOIN fact_game g USING (game_id) JOIN regular r ON g.date = r.date""",
    "rosters": f"""
        SELECT l.team_id, l.season, l.player_id, p.name, p.position, count(l.game_id) AS games,
               {", ".join(f"avg(l.{s}) AS {n}" for n, s in _MEANS.items())},
               sign(sum(tenths)) * ((20 * abs(sum(tenths)) + count(tenths)) // (2 * count(tenths)))
                 / 100.0 AS game_score
        FROM player_log l JOIN players p ON l.player_id = p.player_id
        GROUP BY l.team_id, l.season, l.player_id, p.name, p.position
        HAVING count(l.game_id) >= 5""",
    # ── live ──
    "ev": """
        SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events""",
    "live0": """
        SELECT event_id,
               lpad(CAST(user_id AS VARCHAR),
                    CAST(greatest(10, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0') AS game_id,
               'T' || lpad(CAST(user_id % 10 AS VARCHAR), 2, '0') AS h_team,
               'T' || lpad(CAST((user_id + 1) % 10 AS VARCHAR), 2, '0') AS a_team,
               CAST(floor(value) AS INTEGER) AS h_points, k AS a_points, k % 4 + 1 AS quarter,
               '05:12' AS clock,
               CASE event_type WHEN 'view' THEN '2' WHEN 'click' THEN 'Q3 5:32'
                    WHEN 'purchase' THEN 'OT 1:00' WHEN 'signup' THEN 'Halftime'
                    WHEN 'error' THEN 'Final' END AS game_status,
               ts AS processed_time
        FROM ev""",
    "live": "SELECT * EXCLUDE (event_id) FROM live0",
    "recent": """
        SELECT * FROM live WHERE processed_time >= (SELECT max(processed_time) FROM live) - INTERVAL 6 HOUR""",
    "latest": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY processed_time DESC, h_team DESC,
                a_team DESC, h_points DESC, a_points DESC, quarter DESC, clock DESC,
                game_status DESC) AS rn
            FROM recent) WHERE rn = 1""",
    "playing": """
        SELECT * FROM latest
        WHERE trim(game_status) = '2' OR regexp_matches(trim(game_status), '^(Q[1-4]|OT)')""",
    "codes": """
        SELECT game_id, 'home' AS side, h_team AS code FROM playing
        UNION ALL SELECT game_id, 'away', a_team FROM playing""",
    "lookup": """
        SELECT c.game_id, c.side, c.code, t.team_id, coalesce(t.name, c.code) AS name
        FROM codes c LEFT JOIN (
            SELECT * FROM (SELECT upper(abbreviation) AS key, name, team_id,
                row_number() OVER (PARTITION BY upper(abbreviation) ORDER BY name, team_id) AS rn
            FROM dim_team) WHERE rn = 1) t ON upper(c.code) = t.key""",
    "parsed": """
        SELECT CASE WHEN event_id % 5 = 0 THEN NULL ELSE game_id END AS game_id,
               CASE WHEN event_id % 5 = 0 THEN NULL ELSE h_team END AS h_team,
               CASE WHEN event_id % 5 = 0 THEN NULL ELSE a_team END AS a_team,
               CASE WHEN event_id % 5 = 0 THEN NULL ELSE h_points END AS h_points,
               CASE WHEN event_id % 5 = 0 THEN NULL ELSE a_points END AS a_points,
               CASE WHEN event_id % 5 = 0 THEN NULL ELSE quarter END AS quarter,
               CASE WHEN event_id % 5 = 0 THEN NULL ELSE clock END AS clock,
               CASE WHEN event_id % 5 = 0 THEN NULL ELSE game_status END AS game_status,
               processed_time
        FROM live0""",
    "board": """
        SELECT game_id, h_team, a_team, CASE WHEN h_points > 0 THEN h_points END AS h_points,
               a_points, CASE WHEN quarter > 1 THEN quarter END AS quarter,
               CASE WHEN a_points % 2 = 0 THEN clock END AS clock, game_status, a_points % 4 AS code,
               min(processed_time) OVER (PARTITION BY event_id // 8) AS processed_time
        FROM live0""",
    "board_defaults": """
        SELECT game_id, h_team, a_team, coalesce(h_points, 0) AS h_points,
               coalesce(a_points, 0) AS a_points, coalesce(quarter, 0) AS quarter,
               coalesce(clock, '') AS clock,
               CASE code WHEN 0 THEN '' ELSE CAST(code AS VARCHAR) END AS game_status,
               processed_time
        FROM board""",
}


def _used(text: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{n}\b", re.sub(r"'[^']*'", "", text))]


def _with(select: str) -> str:
    """Prefix a SELECT with the table expressions it reaches, in order of definition."""
    needed: set[str] = set()
    queue = [select]
    while queue:
        for name in _used(queue.pop()):
            if name not in needed:
                needed.add(name)
                queue.append(CTES[name])
    if not needed:
        return select
    parts = [f"{n} AS ({CTES[n]})" for n in CTES if n in needed]
    return f"WITH {', '.join(parts)} {select}"


def _day(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {name or column}"


def _time(column: str = "processed_time") -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {column}"


def _six(x: str) -> str:
    """Six places in exact decimal arithmetic, so that ties round alike in both engines."""
    return f"CAST(round(CAST({x} AS DECIMAL(38, 12)), 6) AS DOUBLE)"


def _r(columns) -> str:
    return ", ".join(f"{_six(c)} AS {c}" for c in columns)


_RAW_DOUBLES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _STATS)
_RAW_PCT = _r(["FG_PCT", "FG3_PCT", "FT_PCT"])
_LIVE = f"game_id, h_team, a_team, h_points, a_points, quarter, clock, game_status, {_time()}"
_COUNTED = [c for c in _LOG if c not in _PCT]
_OWN = f"team_id = {TEAM} AND season = '{SEASON}'"
_BOX = "fgm, fga, fg3m, fg3a, ftm, fta, oreb, dreb, reb, ast, stl, blk, tov, pf, pts, plus_minus"
_PAIR = f"((home_team_id = {PAIR[0]} AND away_team_id = {PAIR[1]}) " \
        f"OR (home_team_id = {PAIR[1]} AND away_team_id = {PAIR[0]}))"


def _one(x: str) -> str:
    return f"printf('%.1f', {x})"


def _pct(x: str) -> str:
    return f"printf('%.1f', round({x}, 12) * 100) || '%'"


_ROSTER = f"name, position, games, {_r(_MEANS)}"
_KEYS = {
    "dim_team": ["team_id"], "dim_player": ["player_id"], "dim_date": ["date"],
    "fact_game": ["game_id"], "fact_game_team_stats": ["game_id", "team_id"],
    "fact_game_player_stats": ["game_id", "player_id"],
}
_FROM = {n: n for n in _KEYS} | {
    "fact_game_team_stats": "team_stats", "fact_game_player_stats": "player_stats",
}
_REFERENCES = [
    ("fact_game", "date", "dim_date", "date"),
    ("fact_game", "home_team_id", "dim_team", "team_id"),
    ("fact_game", "away_team_id", "dim_team", "team_id"),
    ("fact_game_team_stats", "game_id", "fact_game", "game_id"),
    ("fact_game_team_stats", "team_id", "dim_team", "team_id"),
    ("fact_game_player_stats", "game_id", "fact_game", "game_id"),
    ("fact_game_player_stats", "player_id", "dim_player", "player_id"),
    ("fact_game_player_stats", "team_id", "dim_team", "team_id"),
]
_NOT_NULL = {n: list(k) for n, k in _KEYS.items()}
_NOT_NULL["dim_team"] += ["abbreviation", "name"]
_NOT_NULL["dim_player"] += ["name"]
_LENGTHS = {
    "dim_team": {"abbreviation": 5, "name": 100, "city": 100, "conference": 10, "division": 20},
    "dim_player": {"name": 100, "position": 5, "height": 10},
    "dim_date": {"season": 10, "season_type": 20},
    "fact_game": {"game_id": 20}, "fact_game_team_stats": {"game_id": 20},
    "fact_game_player_stats": {"game_id": 20, "min": 10},
}


def _text(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), 'NULL')"


_V3_PLAYER = f"""GAME_ID, TEAM_ID, PLAYER_ID, START_POSITION, "MIN", {_RAW_DOUBLES}, {_RAW_PCT},
    PLUS_MINUS, 'Player' AS "firstName", CAST(PLAYER_ID AS VARCHAR) AS "familyName", PLAYER_NAME"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # ── raw tables and normalisation ──
    q["scan_games"] = f"""SELECT GAME_ID, SEASON_ID, GAME_DATE, TEAM_ID, TEAM_ABBREVIATION,
        TEAM_NAME, MATCHUP, PTS, {_day('date')} FROM games"""
    q["scan_player_stats"] = f"""SELECT GAME_ID, TEAM_ID, PLAYER_ID, PLAYER_NAME, START_POSITION,
        "MIN", {_RAW_DOUBLES}, {_RAW_PCT}, CAST(PLUS_MINUS AS DOUBLE) AS PLUS_MINUS, {_day('date')}
        FROM player_raw"""
    q["scan_team_stats"] = f"""SELECT GAME_ID, TEAM_ID, TEAM_ABBREVIATION, TEAM_NAME,
        {_RAW_DOUBLES}, {_RAW_PCT}, CAST(PLUS_MINUS AS DOUBLE) AS PLUS_MINUS, {_day('date')}
        FROM team_raw"""
    q["repair_types"] = q["scan_team_stats"]
    q["find_games"] = """SELECT GAME_ID, GAME_DATE, TEAM_ID, MATCHUP FROM games
        WHERE day BETWEEN DATE '1997-03-01' AND DATE '1997-10-31' AND GAME_ID LIKE '00%'"""
    q["find_games_indexed"] = q["find_games"]
    q["repair_in_place"] = f"""SELECT GAME_ID, TEAM_ID, CAST(PTS + CASE WHEN GAME_ID NOT LIKE '%7'
            AND date = (SELECT max(chunk_start) FROM chunks WHERE chunk_start <= DATE '1997-03-01')
            THEN 1 ELSE 0 END AS DOUBLE) AS PTS, {_r(["FG_PCT"])},
        CASE WHEN GAME_ID NOT LIKE '%7' THEN strftime(date, '%Y-%m-%d') END AS date
        FROM team_raw"""
    q["normalize_player_v3"] = f"SELECT {_V3_PLAYER} FROM feed"
    q["lineup_rollup"] = """SELECT GAME_ID AS "gameId", TEAM_ID AS "teamId",
        TEAM_ABBREVIATION AS "teamTricode", TEAM_NAME AS "teamName",
        FGM AS "fieldGoalsMade", FGA AS "fieldGoalsAttempted", FG3M AS "threePointersMade",
        FG3A AS "threePointersAttempted", FTM AS "freeThrowsMade", FTA AS "freeThrowsAttempted",
        OREB AS "reboundsOffensive", DREB AS "reboundsDefensive", REB AS "reboundsTotal",
        AST AS "assists", STL AS "steals", BLK AS "blocks", "TO" AS "turnovers",
        PF AS "foulsPersonal", PTS AS "points" FROM lineup_totals"""
    q["shooting_ratios"] = f"SELECT GAME_ID, TEAM_ID, {_RATIOS} FROM lineup_totals"
    q["shooting_ratios"] = f"SELECT GAME_ID, TEAM_ID, {_RAW_PCT} FROM ({q['shooting_ratios']})"
    q["normalize_team_v3"] = f"""SELECT GAME_ID, TEAM_ID, TEAM_ABBREVIATION, TEAM_NAME,
        {_RAW_DOUBLES}, {_RAW_PCT}, CAST(NULL AS DOUBLE) AS PLUS_MINUS
        FROM (SELECT *, {_RATIOS} FROM lineup_totals)"""
    q["route_by_season"] = """SELECT GAME_ID, TEAM_ID, PLAYER_ID,
        CASE WHEN CAST(GAME_ID[4:5] AS INTEGER) >= 25 THEN 'v3' ELSE 'v2' END AS feed FROM feed"""
    q["union_box_scores"] = f"""SELECT GAME_ID, TEAM_ID, PLAYER_ID, PLAYER_NAME, START_POSITION,
        "MIN", {_RAW_DOUBLES}, {_RAW_PCT}, CAST(PLUS_MINUS AS DOUBLE) AS PLUS_MINUS,
        CASE WHEN CAST(GAME_ID[4:5] AS INTEGER) >= 25 THEN 'Player' END AS "firstName",
        CASE WHEN CAST(GAME_ID[4:5] AS INTEGER) >= 25 THEN CAST(PLAYER_ID AS VARCHAR) END
            AS "familyName" FROM feed"""

    q["union_team_box_scores"] = f"""SELECT GAME_ID, TEAM_ID, TEAM_ABBREVIATION, TEAM_NAME,
        {_RAW_DOUBLES}, {_RAW_PCT},
        CASE WHEN CAST(GAME_ID[4:5] AS INTEGER) < 25 THEN CAST(PLUS_MINUS AS DOUBLE) END AS PLUS_MINUS
        FROM (SELECT *, {_RATIOS} FROM feed_totals)"""

    # ── star schema ──
    q["dim_team"] = "SELECT * FROM dim_team"
    q["dim_player"] = "SELECT * FROM dim_player"
    q["dim_date"] = f"SELECT {_day('date')}, season, season_type FROM dim_date"
    game = f"game_id, {_day('date')}, home_team_id, away_team_id, home_score, away_score"
    q["fact_game"] = f"SELECT {game} FROM fact_game"
    q["fact_game_team_stats"] = f"SELECT game_id, team_id, {_BOX}, {_r(_PCT)} FROM team_stats"
    q["fact_game_player_stats"] = f"""SELECT game_id, player_id, team_id, min, {_BOX}, {_r(_PCT)}
        FROM player_rows"""
    q["append_new_rows"] = f"SELECT {game} FROM fact_game WHERE date >= DATE '1998-01-01'"
    q["incremental_day"] = f"""SELECT {game} FROM fact_game
        WHERE date >= (SELECT max(chunk_start) FROM chunks)
          AND CAST(right(game_id, 1) AS INTEGER) % 2 = 1"""
    counts = [
        f"SELECT '{n}' AS tbl, CAST(count(*) AS BIGINT) AS {{}} FROM "
        + (f"(SELECT DISTINCT {', '.join(_KEYS[n])} FROM {_FROM[n]})" if n.startswith("fact")
           else _FROM[n])
        for n in _KEYS
    ]
    q["load_star"] = "SELECT tbl, first_load, CAST(0 AS BIGINT) AS second_load, " \
        "first_load AS stored FROM (" + " UNION ALL ".join(c.format("first_load") for c in counts) + ")"

    # ── backfill plan ──
    q["chunk_plan"] = f"""SELECT {_day('chunk_start')}, {_day('chunk_end')},
        strftime(chunk_start, '%m/%d/%Y') AS date_from, strftime(chunk_end, '%m/%d/%Y') AS date_to
        FROM chunks"""
    q["chunk_plan_pending"] = q["chunk_plan"] + """
        WHERE chunk_start NOT IN (SELECT date FROM games WHERE day < DATE '1999-01-01')"""
    q["chunk_game_counts"] = f"""SELECT {_day('date')}, count(DISTINCT GAME_ID) AS games
        FROM games GROUP BY games.date"""

    # ── season questions ──
    figures = _r(["avg_pts_for", "avg_pts_against"])
    q["team_record"] = f"SELECT wins, games, {figures}, losses FROM records WHERE {_OWN}"
    q["team_record_sql"] = f"SELECT wins, games, {figures} FROM records WHERE {_OWN}"
    q["team_record_all"] = f"SELECT team_id, season, wins, games, {figures}, losses FROM records"
    q["team_summary"] = f"""SELECT wins || '–' || losses AS record,
        {_one('avg_pts_for')} AS avg_pts_for, {_one('avg_pts_against')} AS avg_pts_against,
        (SELECT {_pct('avg(fg_pct)')} FROM team_log WHERE {_OWN}) AS avg_fg_pct
        FROM records WHERE {_OWN}"""
    q["game_log"] = f"""SELECT {_day('date')}, {', '.join(_COUNTED)}, {_r(_PCT)}
        FROM team_log WHERE {_OWN}"""
    q["points_trend"] = f"SELECT {_day('date')}, pts FROM team_log WHERE {_OWN}"
    q["season_averages"] = "SELECT " + ", ".join(f"{_six(f'avg({c})')} AS {c}" for c in _LOG) + \
        f" FROM team_log WHERE {_OWN}"
    q["rollup_after_relanding"] = f"""SELECT team_id, {_day('date')}, count(*) AS games,
        CAST(sum(pts) AS BIGINT) AS sum_pts, count(pts) AS n_pts,
        {_six('coalesce(sum(fg_pct), 0)')} AS sum_fg_pct, count(fg_pct) AS n_fg_pct
        FROM team_stats JOIN fact_game USING (game_id) GROUP BY team_id, date"""
    q["rollup_player_days"] = f"""SELECT team_id, player_id, {_day('date')}, count(*) AS games,
        CAST(sum(reb) AS BIGINT) AS sum_reb,
        CAST(sum(10*pts + 4*fgm - 7*fga - 4*(fta - ftm) + 7*oreb + 3*dreb + 10*stl + 7*ast + 7*blk
            - 4*pf - 10*tov) AS BIGINT) AS sum_tenths, count(*) AS n_tenths,
        {_six('coalesce(sum(ft_pct), 0)')} AS sum_ft_pct, count(ft_pct) AS n_ft_pct
        FROM player_stats JOIN fact_game USING (game_id) GROUP BY team_id, player_id, date"""
    q["season_averages_all"] = "SELECT team_id, season, " + \
        ", ".join(f"{_six(f'avg({c})')} AS {c}" for c in _LOG) + \
        " FROM team_log GROUP BY team_id, season"
    q["season_averages_display"] = "SELECT " + ", ".join(
        f"{(_pct if c in _PCT else _one)(f'avg({c})')} AS {c}" for c in _LOG
    ) + f" FROM team_log WHERE {_OWN}"
    q["avg_fg_pct"] = f"""SELECT {_six('coalesce(avg(fg_pct), 0.0)')} AS avg_fg_pct
        FROM team_log WHERE {_OWN}"""
    q["roster_stats"] = f"SELECT {_ROSTER} FROM rosters WHERE {_OWN}"
    q["roster_game_score"] = f"SELECT {_ROSTER}, game_score FROM rosters WHERE {_OWN}"
    q["roster_all"] = f"SELECT team_id, season, player_id, {_ROSTER}, game_score FROM rosters"
    shown = f"""SELECT name AS "Player", position AS "Pos", games AS "GP",
        {_one('ppg')} AS "PPG", {_one('rpg')} AS "RPG", {_one('apg')} AS "APG",
        {_one('spg')} AS "SPG", {_one('bpg')} AS "BPG",
        coalesce({_pct('fg_pct')}, '—') AS "FG%", coalesce({_pct('fg3_pct')}, '—') AS "3P%",
        coalesce({_pct('ft_pct')}, '—') AS "FT%" """
    q["roster_table"] = f"{shown} FROM rosters WHERE {_OWN}"
    q["roster_display"] = f"""{shown}, {_one('game_score')} AS "Game Score"
        FROM rosters WHERE {_OWN}"""
    q["player_collapse"] = "SELECT * FROM players"
    pair = f"""SELECT game_id, g.date, h.abbreviation AS home_team, a.abbreviation AS away_team,
        home_score, away_score FROM fact_game g JOIN regular r ON g.date = r.date
        JOIN names h ON home_team_id = h.team_id JOIN names a ON away_team_id = a.team_id
        WHERE season = '{SEASON}' AND {_PAIR} ORDER BY g.date DESC, game_id DESC LIMIT 10"""
    q["head_to_head"] = f"""SELECT game_id, {_day('date')}, home_team, away_team, home_score,
        away_score FROM ({pair})"""
    q["head_to_head_display"] = f"""SELECT {_day('date', '"Date"')}, home_team AS "Home",
        away_team AS "Away", home_score AS "Home Pts", away_score AS "Away Pts" FROM ({pair})"""
    q["recent_games"] = f"""SELECT game_id, {_day('date')}, home, home_score, away, away_score FROM (
        SELECT game_id, g.date, h.abbreviation AS home, home_score, a.abbreviation AS away, away_score
        FROM fact_game g JOIN names h ON home_team_id = h.team_id
        JOIN names a ON away_team_id = a.team_id
        WHERE home_team_id = {TEAM} OR away_team_id = {TEAM}
        ORDER BY g.date DESC, game_id DESC LIMIT 10)"""
    q["teams"] = "SELECT team_id, name, abbreviation FROM dim_team"
    q["seasons"] = "SELECT DISTINCT season FROM regular WHERE season IS NOT NULL"

    # ── report and checks ──
    q["table_counts"] = " UNION ALL ".join(
        f"SELECT '{n}' AS tbl, count(*) AS row_count FROM {_FROM[n]}" for n in _KEYS
    )
    q["catalog_counts"] = q["table_counts"] + \
        " UNION ALL SELECT 'live_data', count(*) FROM live"
    q["season_type_counts"] = """SELECT season_type, count(*) AS dates FROM dim_date
        GROUP BY season_type"""
    q["home_away_counts"] = f"""SELECT CAST(count_if(home_team_id = {TEAM}) AS BIGINT) AS home_games,
        CAST(count_if(away_team_id = {TEAM}) AS BIGINT) AS away_games FROM fact_game"""
    q["team_by_name"] = """SELECT team_id, name, abbreviation FROM dim_team
        WHERE name = 'Supplier#000000003' ORDER BY team_id LIMIT 1"""
    q["team_by_abbr"] = "SELECT team_id, name, abbreviation FROM dim_team WHERE abbreviation = 'T03'"
    q["table_samples"] = f"""SELECT {game} FROM (SELECT * FROM fact_game
        ORDER BY game_id, date LIMIT 5)"""
    q["sample_found"] = "SELECT least(5, count(*)) AS found FROM player_stats"
    first = "ORDER BY ALL ASC NULLS FIRST LIMIT 5"
    q["sample_dim_team"] = f"SELECT * FROM dim_team {first}"
    q["sample_dim_player"] = f"SELECT * FROM dim_player {first}"
    q["sample_dim_date"] = f"""SELECT {_day('date')}, season, season_type
        FROM (SELECT * FROM dim_date {first})"""
    q["sample_fact_game"] = q["table_samples"]
    q["sample_fact_game_team_stats"] = f"""SELECT game_id, team_id, {_BOX}, {_r(_PCT)}
        FROM (SELECT * FROM team_stats {first})"""
    q["sample_fact_game_player_stats"] = f"""SELECT game_id, player_id, team_id, min, {_BOX},
        {_r(_PCT)} FROM (SELECT * FROM player_stats {first})"""
    q["sample_live_data"] = f"SELECT {_LIVE} FROM (SELECT * FROM live {first})"
    q["pk_violations"] = " UNION ALL ".join(
        f"""SELECT '{n}' AS tbl, {" || '|' || ".join(_text(c) for c in keys)} AS key,
            count(*) AS rows FROM {_FROM[n]} GROUP BY {', '.join(keys)} HAVING count(*) > 1"""
        for n, keys in _KEYS.items()
    )
    q["fk_orphans"] = " UNION ALL ".join(
        f"""SELECT '{n}' AS tbl, '{c}' AS "column", CAST({c} AS VARCHAR) AS key, count(*) AS rows
            FROM {_FROM[n]} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {_FROM[p]})
            GROUP BY {c}"""
        for n, c, p, k in _REFERENCES
    )
    q["null_violations"] = " UNION ALL ".join(
        f"""SELECT '{n}' AS tbl, '{c}' AS "column",
            count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM {_FROM[n]}"""
        for n, columns in _NOT_NULL.items() for c in columns
    )
    q["unkeyed_rows"] = """
        SELECT 'games' AS tbl, 'TEAM_ID' AS "column",
               count(*) FILTER (WHERE TEAM_ID IS NULL) AS rows FROM games
        UNION ALL SELECT 'games', 'GAME_DATE', count(*) FILTER (WHERE day IS NULL) FROM games
        UNION ALL SELECT 'player_stats', 'PLAYER_ID', count(*) FILTER (WHERE PLAYER_ID IS NULL)
        FROM player_raw"""
    q["length_violations"] = " UNION ALL ".join(
        f"""SELECT '{n}' AS tbl, '{c}' AS "column",
            count(*) FILTER (WHERE length({c}) > {size}) AS long_rows FROM {_FROM[n]}"""
        for n, columns in _LENGTHS.items() for c, size in columns.items()
    )

    # ── live scores ──
    q["parse_live_json"] = f"SELECT {_LIVE} FROM parsed"
    q["live_stamped"] = "SELECT game_id, count(*) AS rows, TRUE AS fresh FROM parsed GROUP BY game_id"
    states = "h_team, a_team, h_points, a_points, quarter, clock, game_status"
    q["state_changes"] = f"""SELECT {_LIVE} FROM (
        SELECT *, row_number() OVER w AS rn, lag(ROW({states})) OVER w AS before FROM live
        WINDOW w AS (PARTITION BY game_id ORDER BY processed_time,
            {", ".join(f"{c} NULLS FIRST" for c in states.split(", "))}))
        WHERE rn = 1 OR ROW({states}) IS DISTINCT FROM before"""
    q["stream_state_changes"] = q["state_changes"].replace("FROM live", "FROM parsed WHERE game_id IS NOT NULL")
    q["flatten_scoreboard"] = f"SELECT {_LIVE} FROM board"
    q["flatten_scoreboard_defaults"] = f"SELECT {_LIVE} FROM board_defaults"
    q["live_latest"] = f"SELECT {_LIVE} FROM latest"
    q["live_games"] = f"SELECT {_LIVE} FROM playing"
    q["live_cards"] = """SELECT game_id, h_team, a_team, h_points, a_points,
        h_points > a_points AS h_winning, a_points > h_points AS a_winning,
        'Q' || quarter AS quarter_label, clock FROM playing"""
    q["live_labels"] = """SELECT h_team || ' vs ' || a_team AS label, max(game_id) AS game_id
        FROM playing GROUP BY 1"""
    q["score_history"] = f"""SELECT {_time()}, h_points, a_points, h_team, a_team, quarter, clock
        FROM live WHERE game_id = '0000000003'"""
    q["live_team_lookup"] = "SELECT * FROM lookup"
    q["live_matchup"] = f"""SELECT l.game_id, l.side, l.code, l.team_id, l.name,
        coalesce(wins, 0) AS wins, coalesce(losses, 0) AS losses,
        {_six('coalesce(avg_pts_for, 0.0)')} AS avg_pts_for,
        {_six('coalesce(avg_pts_against, 0.0)')} AS avg_pts_against,
        {_six('coalesce(f.avg_fg_pct, 0.0)')} AS avg_fg_pct
        FROM lookup l
        LEFT JOIN (SELECT * FROM records WHERE season = '{SEASON}') r ON l.team_id = r.team_id
        LEFT JOIN (SELECT team_id, avg(fg_pct) AS avg_fg_pct FROM team_log
                   WHERE season = '{SEASON}' GROUP BY team_id) f ON l.team_id = f.team_id"""
    live_teams = f"season = '{SEASON}' AND team_id IN (SELECT team_id FROM lookup)"
    q["live_trend"] = f"SELECT team_id, {_day('date')}, game_id, pts FROM team_log WHERE {live_teams}"
    q["live_season_averages"] = f"""SELECT l.game_id, l.side, l.team_id, {_r(_LOG)} FROM lookup l
        LEFT JOIN (SELECT team_id, {', '.join(f'avg({c}) AS {c}' for c in _LOG)} FROM team_log
                   WHERE season = '{SEASON}' GROUP BY team_id) a ON l.team_id = a.team_id"""
    q["live_roster"] = f"""SELECT team_id, player_id, {_ROSTER}, game_score FROM rosters
        WHERE {live_teams}"""
    q["live_head_to_head"] = f"""SELECT live_game_id, CAST(rank AS INTEGER) AS rank, game_id,
        {_day('date')}, home_team, away_team, home_score, away_score FROM (
        SELECT p.game_id AS live_game_id, g.game_id, g.date, hn.abbreviation AS home_team,
               an.abbreviation AS away_team, home_score, away_score,
               row_number() OVER (PARTITION BY p.game_id ORDER BY g.date DESC, g.game_id DESC) AS rank
        FROM (SELECT h.game_id, h.team_id AS h, a.team_id AS a FROM lookup h
              JOIN lookup a ON h.game_id = a.game_id AND h.side = 'home' AND a.side = 'away') p
        JOIN fact_game g ON least(p.h, p.a) = least(home_team_id, away_team_id)
                        AND greatest(p.h, p.a) = greatest(home_team_id, away_team_id)
        JOIN regular r ON g.date = r.date AND season = '{SEASON}'
        JOIN names hn ON home_team_id = hn.team_id JOIN names an ON away_team_id = an.team_id)
        WHERE rank <= 10"""

    # ── streams ──
    q["stream_append"] = f"SELECT {_LIVE} FROM parsed"
    q["stream_scoreboard"] = f"SELECT {_LIVE} FROM board_defaults"
    q["stream_two_sources"] = f"""SELECT {_LIVE} FROM (SELECT * FROM parsed UNION ALL
        SELECT * FROM parsed UNION ALL SELECT * FROM board_defaults)"""
    q["live_compacted"] = f"SELECT {_LIVE} FROM (SELECT * FROM parsed UNION ALL SELECT * FROM live)"
    q["stream_quarantine"] = """SELECT game_id, count(*) AS rows, 'live_data' AS kept_in FROM parsed
        WHERE game_id IS NOT NULL GROUP BY game_id
        UNION ALL SELECT '{not json', count(*), 'quarantine' FROM parsed WHERE game_id IS NULL
        HAVING count(*) > 0"""
    whole = CTES["latest"].replace("FROM recent", "FROM parsed WHERE game_id IS NOT NULL")
    q["stream_latest_state"] = f"SELECT {_LIVE} FROM ({whole})"
    q["stream_changed_only"] = """SELECT DISTINCT game_id, h_team, a_team, h_points, a_points,
        quarter, clock, game_status FROM parsed"""

    return {name: _with(text) for name, text in q.items()}
