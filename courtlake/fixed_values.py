"""Names, codes and constants that results depend on.

They describe the source feeds and the published tables; nothing here is tuned.
"""

# Newer box-score feed (camelCase) -> older feed (UPPER_CASE), player rows.
PLAYER_V3_TO_V2 = {
    "gameId": "GAME_ID",
    "teamId": "TEAM_ID",
    "teamTricode": "TEAM_ABBREVIATION",
    "teamName": "TEAM_NAME",
    "personId": "PLAYER_ID",
    "position": "START_POSITION",
    "minutes": "MIN",
    "fieldGoalsMade": "FGM",
    "fieldGoalsAttempted": "FGA",
    "fieldGoalsPercentage": "FG_PCT",
    "threePointersMade": "FG3M",
    "threePointersAttempted": "FG3A",
    "threePointersPercentage": "FG3_PCT",
    "freeThrowsMade": "FTM",
    "freeThrowsAttempted": "FTA",
    "freeThrowsPercentage": "FT_PCT",
    "reboundsOffensive": "OREB",
    "reboundsDefensive": "DREB",
    "reboundsTotal": "REB",
    "assists": "AST",
    "steals": "STL",
    "blocks": "BLK",
    "turnovers": "TO",
    "foulsPersonal": "PF",
    "points": "PTS",
    "plusMinusPoints": "PLUS_MINUS",
}

# The counted statistics of a box score, in feed order.
STATS = [
    "FGM", "FGA", "FG3M", "FG3A", "FTM", "FTA", "OREB", "DREB", "REB",
    "AST", "STL", "BLK", "TO", "PF", "PTS",
]

# Percentage column -> (made, attempted).
SHOOTING = {
    "FG_PCT": ("FGM", "FGA"),
    "FG3_PCT": ("FG3M", "FG3A"),
    "FT_PCT": ("FTM", "FTA"),
}

# Leading digit of SEASON_ID -> season type; other digits have none.
SEASON_TYPES = {"1": "Pre-Season", "2": "Regular Season", "4": "Playoffs"}
REGULAR_SEASON = "Regular Season"

# How MATCHUP marks the home and the away row of a game.
HOME_MARK = " vs. "
AWAY_MARK = " @ "

# GAME_ID layout (two-digit league, then season year at characters 4-5).
LEAGUE = "00"
FIRST_V3_SEASON = 25

# Game score, weight of each statistic in tenths of a point.
GAME_SCORE_TENTHS = {
    "pts": 10, "fgm": 4, "fga": -7, "fta": -4, "ftm": 4, "oreb": 7, "dreb": 3,
    "stl": 10, "ast": 7, "blk": 7, "pf": -4, "tov": -10,
}

# Dashboard limits.
MIN_GAMES = 5
HEAD_TO_HEAD_GAMES = 10
SAMPLE_ROWS = 5

# Live scores.
LIVE_HOURS = 6
IN_PROGRESS_CODE = "2"
IN_PROGRESS_TEXT = "^(Q[1-4]|OT)"
TRIGGER_SECONDS = 5

# Backfill window in months per landing partition.
CHUNK_MONTHS = 6

# Columns of the published game log, its shares, and the means of the roster.
LOG_STATS = [
    "pts", "fgm", "fga", "fg_pct", "fg3m", "fg3a", "fg3_pct", "ftm", "fta", "ft_pct",
    "oreb", "dreb", "reb", "ast", "stl", "blk", "tov", "pf",
]
PCT_STATS = ["fg_pct", "fg3_pct", "ft_pct"]
ROSTER_MEANS = {
    "ppg": "pts", "rpg": "reb", "apg": "ast", "spg": "stl", "bpg": "blk",
    "fg_pct": "fg_pct", "fg3_pct": "fg3_pct", "ft_pct": "ft_pct",
}
