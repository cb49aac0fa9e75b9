"""Live games next to their teams' season figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtlake import fixed_values as V
from courtlake.operators.live import game_sides, team_lookup
from courtlake.plans import season as S


def live_matchup(live_games: DataFrame, star: S.Star, season: str) -> DataFrame:
    """Each side of each live game with its team's record and shooting in a season.

    Season figures are computed once per team, then joined, however many games are live.
    """
    sides = team_lookup(game_sides(live_games), star["dim_team"])
    record = S.team_record_all(star, season).drop("season")
    shooting = S.season_averages_all(star, season, _playing(live_games, star), ["fg_pct"]).select(
        "team_id", F.col("fg_pct").alias("avg_fg_pct"))
    joined = sides.join(record, "team_id", "left").join(shooting, "team_id", "left")
    zero, none = F.lit(0), F.lit(0.0)
    return joined.select(
        "game_id", "side", "code", "team_id", "name",
        F.coalesce("wins", zero).alias("wins"),
        F.coalesce("losses", zero).alias("losses"),
        F.coalesce("avg_pts_for", none).alias("avg_pts_for"),
        F.coalesce("avg_pts_against", none).alias("avg_pts_against"),
        F.coalesce("avg_fg_pct", none).alias("avg_fg_pct"),
    )


def _playing(live_games: DataFrame, star: S.Star) -> DataFrame:
    """(team_id) of the teams in live games, each once."""
    sides = team_lookup(game_sides(live_games), star["dim_team"])
    return sides.where("team_id IS NOT NULL").select("team_id").distinct()


def live_trend(live_games: DataFrame, star: S.Star, season: str) -> DataFrame:
    """Points by date of every team in a live game: a team's rows once, however many it plays."""
    own = S.season_rows(star, star["fact_game_team_stats"], season).select(
        "game_id", "team_id", "pts").join(_playing(live_games, star), "team_id", "left_semi")
    return own.join(S.season_games(star, season), "game_id").select(
        "team_id", "date", "game_id", "pts"
    )


def live_season_averages(live_games: DataFrame, star: S.Star, season: str) -> DataFrame:
    """Each side of each live game with its team's season averages."""
    sides = team_lookup(game_sides(live_games), star["dim_team"])
    means = S.season_averages_all(star, season, _playing(live_games, star)).drop("season")
    return sides.select("game_id", "side", "team_id").join(means, "team_id", "left").select(
        "game_id", "side", "team_id", *S.LOG_STATS
    )


def live_roster(live_games: DataFrame, star: S.Star, season: str) -> DataFrame:
    """The season's roster, with game score, of every team in a live game."""
    return S.roster_all(star, season, _playing(live_games, star)).drop("season")


def live_head_to_head(
    live_games: DataFrame, star: S.Star, season: str, rows: int = V.HEAD_TO_HEAD_GAMES
) -> DataFrame:
    """Past games of the season between the two teams of each live game, latest ten each.

    The season's games are ranked before they meet the live ones: each task passes on at most
    ``rows`` games per pair, so a pair that plays very often is small when it is shuffled.
    """
    sides = team_lookup(game_sides(live_games), star["dim_team"]).where("team_id IS NOT NULL")
    team = {s: F.max(F.when(F.col("side") == s, F.col("team_id"))) for s in ("home", "away")}
    paired = sides.groupBy("game_id").agg(team["home"].alias("h"), team["away"].alias("a"))
    live_pairs = paired.where("h IS NOT NULL AND a IS NOT NULL").select(
        F.col("game_id").alias("live_game_id"),
        F.least("h", "a").alias("low"), F.greatest("h", "a").alias("high"),
    )
    pair = {
        "low": F.least("home_team_id", "away_team_id"),
        "high": F.greatest("home_team_id", "away_team_id"),
    }
    past = S.in_season(star, star["fact_game"], season).withColumns(pair)
    order = Window.partitionBy("low", "high").orderBy(F.desc("date"), F.desc("game_id"))
    ranked = past.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rows)
    matched = ranked.join(live_pairs, ["low", "high"])
    return S.with_team_names(star, matched, "home_team", "away_team").select(
        "live_game_id", "rank", "game_id", "date", "home_team", "away_team",
        "home_score", "away_score",
    )
