"""Season questions over the star schema: records, logs, rosters, head-to-head.

Every function takes the star tables it reads and returns one DataFrame. Dimension sides
carry no broadcast hint: Spark broadcasts them when their stored or measured size is small
and otherwise sorts and merges, splitting hot partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlake import fixed_values as V
from courtlake.functions import display
from courtlake.functions.league import game_score_tenths, season_start
from courtlake.operators.pruning import within_span
from courtlake.schemas import NO_SEASON, SEASON_FOLDER

Star = Mapping[str, DataFrame]

# Daily sums, if a warehouse keeps them (plans/rollup.py).
TEAM_DAYS, PLAYER_DAYS = "team_days", "player_days"
LOG_STATS, PCT_STATS, ROSTER_MEANS = V.LOG_STATS, V.PCT_STATS, V.ROSTER_MEANS


# ── Lists ────────────────────────────────────────────────────────────────────────


def teams(star: Star) -> DataFrame:
    return star["dim_team"].select("team_id", "name", "abbreviation").orderBy("name", "team_id")


def team_by_name(star: Star, name: str) -> DataFrame:
    """The team of that name; of several, the one with the least id."""
    return teams(star).where(F.col("name") == name).limit(1)


def regular_dates(star: Star, season: str | None = None) -> DataFrame:
    """Dates of regular-season games, with their season."""
    dates = star["dim_date"].where(F.col("season_type") == V.REGULAR_SEASON)
    if season is not None:
        dates = dates.where(F.col("season") == season)
    return dates.select("date", "season")


def _with_folder(df: DataFrame) -> DataFrame:
    return df.withColumn(SEASON_FOLDER, season_start(F.col("date")))


def season_folders(dates: DataFrame) -> DataFrame:
    """The folders that may hold rows of games on these dates, that of no season included."""
    return dates.select(
        F.explode(F.array(season_start(F.col("date")), F.lit(NO_SEASON))).alias(SEASON_FOLDER)
    )


def seasons(star: Star) -> DataFrame:
    known = regular_dates(star).where(F.col("season").isNotNull())
    return known.select("season").distinct().orderBy(F.desc("season"))


# ── Records ──────────────────────────────────────────────────────────────────────


def team_sides(fact_game: DataFrame) -> DataFrame:
    """Two rows per game, one per team: points for and against, and whether it won."""

    def side(team: str, own: str, other: str) -> Column:
        return F.struct(
            F.col(team).alias("team_id"),
            F.col(own).alias("points_for"),
            F.col(other).alias("points_against"),
            F.coalesce((F.col(own) > F.col(other)).cast("bigint"), F.lit(0)).alias("win"),
        )

    sides = F.array(
        side("home_team_id", "home_score", "away_score"),
        side("away_team_id", "away_score", "home_score"),
    )
    return fact_game.select("game_id", "date", F.inline(sides))


def _daily(sides: DataFrame) -> DataFrame:
    # Totals per team and day: what meets dim_date grows with the calendar, not with games.
    return sides.groupBy("team_id", "date").agg(
        F.sum("win").alias("wins"),
        F.count(F.lit(1)).alias("games"),
        F.sum("points_for").alias("sum_for"),
        F.count("points_for").alias("n_for"),
        F.sum("points_against").alias("sum_against"),
        F.count("points_against").alias("n_against"),
    )


def _record_columns() -> list[Column]:
    return [
        F.coalesce(F.sum("wins"), F.lit(0)).alias("wins"),
        F.coalesce(F.sum("games"), F.lit(0)).alias("games"),
        F.try_divide(F.sum("sum_for"), F.sum("n_for")).alias("avg_pts_for"),
        F.try_divide(F.sum("sum_against"), F.sum("n_against")).alias("avg_pts_against"),
    ]


def _with_losses(df: DataFrame) -> DataFrame:
    return df.withColumn("losses", F.col("games") - F.col("wins"))


def team_record(star: Star, team_id: int, season: str) -> DataFrame:
    """One row: wins, losses, games, average points for and against."""
    own = star["fact_game"].where(
        (F.col("home_team_id") == team_id) | (F.col("away_team_id") == team_id)
    )
    # Home wins over away for a team listed on both sides, so a game counts once.
    sides = own.select(
        "date", *_folder_of(own), F.lit(team_id).alias("team_id"),
        *_own_side(F.col("home_team_id") == team_id)
    )
    return _with_losses(_daily(in_season(star, sides, season)).agg(*_record_columns()))


def _folder_of(df: DataFrame) -> list[str]:
    """The folder column, where a table is stored by season."""
    return [c for c in df.columns if c == SEASON_FOLDER]


def _own_side(is_home: Column) -> list[Column]:
    own = F.when(is_home, F.col("home_score")).otherwise(F.col("away_score"))
    other = F.when(is_home, F.col("away_score")).otherwise(F.col("home_score"))
    return [
        own.alias("points_for"),
        other.alias("points_against"),
        F.coalesce((own > other).cast("bigint"), F.lit(0)).alias("win"),
    ]


def team_record_all(star: Star, season: str | None = None) -> DataFrame:
    """The record of every team in every regular season, or in one."""
    dates, games = regular_dates(star, season), star["fact_game"]
    if season is not None:
        games = in_season(star, games, season, keep=True)
    joined = _daily(team_sides(games)).join(dates, "date")
    return _with_losses(joined.groupBy("team_id", "season").agg(*_record_columns()))


# ── Game logs ────────────────────────────────────────────────────────────────────


def season_games(star: Star, season: str | None = None) -> DataFrame:
    """Regular-season games with date and season."""
    games = star["fact_game"]
    return in_season(star, games.select("game_id", "date", *_folder_of(games)), season)


def in_season(star: Star, games: DataFrame, season: str | None, keep: bool = False) -> DataFrame:
    """Games on regular-season dates, with their season; ``keep`` adds and repeats nothing.

    Where games are stored by season, the join itself prunes folders: a date's folder
    follows from the date, so the few folders of the wanted dates are known before the scan. Other
    tables are bounded by the dates' span.
    """
    dates = regular_dates(star, season)
    on = ["date"]
    if season is not None:
        if SEASON_FOLDER in games.columns:
            dates, on = _with_folder(dates), ["date", SEASON_FOLDER]
        else:
            games = within_span(games, "date", dates.select("date"))
    return games.join(dates, on, "left_semi" if keep else "inner")


def season_rows(star: Star, stats: DataFrame, season: str | None) -> DataFrame:
    """Box scores that may belong to games of a season: a superset that spares other folders."""
    if season is None:
        return stats
    if SEASON_FOLDER in stats.columns:
        return stats.join(season_folders(regular_dates(star, season)), SEASON_FOLDER, "left_semi")
    # Stored by (team, game): within a team's pages, only those of the season are read.
    return within_span(stats, "game_id", season_games(star, season).select("game_id"))


def _team_games(star: Star, team_id: int, season: str) -> DataFrame:
    own = star["fact_game_team_stats"].where(F.col("team_id") == team_id)
    own = season_rows(star, own, season).select("game_id", *LOG_STATS)
    return own.join(season_games(star, season), "game_id")


def game_log(star: Star, team_id: int, season: str) -> DataFrame:
    """A team's box score per game, by date; games of one day in order of their id."""
    log = _team_games(star, team_id, season).orderBy("date", "game_id")
    return log.select("date", *LOG_STATS)


def points_trend(star: Star, team_id: int, season: str) -> DataFrame:
    return game_log(star, team_id, season).select("date", "pts")


def season_averages(star: Star, team_id: int, season: str) -> DataFrame:
    """One row: the mean of each column of the game log."""
    means = [F.avg(c).alias(c) for c in LOG_STATS]
    return _team_games(star, team_id, season).agg(*means)


def season_averages_all(
    star: Star, season: str | None = None, teams: DataFrame | None = None,
    stats: Sequence[str] = tuple(LOG_STATS),
) -> DataFrame:
    """Season averages of every team (or of ``teams``) in every regular season, or in one.

    Read from the team's daily sums where they are kept, otherwise from the box scores.
    """
    if TEAM_DAYS in star:
        days = _kept(star[TEAM_DAYS], teams)
        return rolled_means(in_season(star, days, season), ["team_id", "season"], {c: c for c in stats})
    own = season_rows(star, _kept(star["fact_game_team_stats"], teams), season)
    joined = own.select("game_id", "team_id", *stats).join(season_games(star, season), "game_id")
    return joined.groupBy("team_id", "season").agg(*[F.avg(c).alias(c) for c in stats])


def _kept(df: DataFrame, teams: DataFrame | None) -> DataFrame:
    return df if teams is None else df.join(teams, "team_id", "left_semi")


def rolled_means(days: DataFrame, by: list[str], means: Mapping[str, str]) -> DataFrame:
    """Means per group from daily sums and counts, groups without a game left out."""
    out = days.groupBy(*by).agg(
        F.sum("games").alias("_games"),
        *[F.try_divide(F.sum(f"sum_{c}").cast("double"), F.sum(f"n_{c}")).alias(name)
          for name, c in means.items()],
    )
    return out.where("_games > 0").drop("_games")


def season_averages_display(star: Star, team_id: int, season: str) -> DataFrame:
    """Season averages as shown: one decimal, percentages as percent."""
    shown = [
        (display.percent if c in PCT_STATS else display.one_decimal)(F.col(c)).alias(c)
        for c in LOG_STATS
    ]
    return season_averages(star, team_id, season).select(shown)


def avg_fg_pct(star: Star, team_id: int, season: str) -> DataFrame:
    """The mean of per-game field-goal percentages; 0 for a team without games."""
    mean = F.coalesce(F.avg("fg_pct"), F.lit(0.0))
    return _team_games(star, team_id, season).agg(mean.alias("avg_fg_pct"))


def team_summary(star: Star, team_id: int, season: str) -> DataFrame:
    """The headline figures as shown: record, points for and against, field-goal share."""
    record = team_record(star, team_id, season)
    zero = F.lit(0.0)
    share = avg_fg_pct(star, team_id, season).scalar()
    return record.select(
        display.record_text(F.col("wins"), F.col("losses")).alias("record"),
        display.one_decimal(F.coalesce("avg_pts_for", zero)).alias("avg_pts_for"),
        display.one_decimal(F.coalesce("avg_pts_against", zero)).alias("avg_pts_against"),
        display.percent(share).alias("avg_fg_pct"),
    )


# ── Rosters ──────────────────────────────────────────────────────────────────────


def player_collapse(star: Star) -> DataFrame:
    """One row per player: the greatest name and position seen."""
    return star["dim_player"].groupBy("player_id").agg(
        F.max("name").alias("name"), F.max("position").alias("position")
    )


def _roster(star: Star, stats: DataFrame, games: DataFrame, by: list[str]) -> DataFrame:
    """Means per player; the player's name joins after the means, once per player."""
    needed = sorted(set(ROSTER_MEANS.values()) | set(V.GAME_SCORE_TENTHS))
    tenths = game_score_tenths()
    means = (
        stats.select("game_id", "player_id", *[c for c in by if c in stats.columns], *needed)
        .join(games, "game_id")
        .groupBy("player_id", *by)
        .agg(
            F.count("game_id").alias("games"),
            *[F.avg(stat).alias(name) for name, stat in ROSTER_MEANS.items()],
            _game_score(F.sum(tenths), F.count(tenths)).alias("game_score"),
        )
    )
    return _named_roster(star, means)


def _game_score(tenths: Column, games: Column) -> Column:
    return F.round(F.try_divide(tenths.cast("double"), games * 10), 2)


def _named_roster(star: Star, means: DataFrame) -> DataFrame:
    return means.where(F.col("games") >= V.MIN_GAMES).join(player_collapse(star), "player_id")


def _team_roster(star: Star, team_id: int, season: str) -> DataFrame:
    own = star["fact_game_player_stats"].where(F.col("team_id") == team_id)
    games = season_games(star, season).select("game_id")
    return _roster(star, season_rows(star, own, season), games, [])


ROSTER_COLUMNS = ["name", "position", "games", *ROSTER_MEANS]


def roster_stats(star: Star, team_id: int, season: str) -> DataFrame:
    """Per-game means of players with at least five games, best scorers first."""
    roster = _team_roster(star, team_id, season)
    return roster.orderBy(F.desc("ppg"), "player_id").select(ROSTER_COLUMNS)


def roster_game_score(star: Star, team_id: int, season: str) -> DataFrame:
    """Roster means with game score, best game score first."""
    roster = _team_roster(star, team_id, season)
    ranked = roster.orderBy(F.desc_nulls_last("game_score"), "player_id")
    return ranked.select(*ROSTER_COLUMNS, "game_score")


def roster_all(
    star: Star, season: str | None = None, teams: DataFrame | None = None
) -> DataFrame:
    """Roster means and game score of every team (or of ``teams``) in every regular season, or in one.

    Read from the players' daily sums where they are kept, otherwise from the box scores.
    """
    by = ["team_id", "season"]
    if PLAYER_DAYS in star:
        days = in_season(star, _kept(star[PLAYER_DAYS], teams), season)
        means = days.groupBy("player_id", *by).agg(
            F.sum("games").alias("games"),
            *[F.try_divide(F.sum(f"sum_{c}").cast("double"), F.sum(f"n_{c}")).alias(name)
              for name, c in ROSTER_MEANS.items()],
            _game_score(F.sum("sum_tenths"), F.sum("n_tenths")).alias("game_score"),
        )
        roster = _named_roster(star, means)
    else:
        own = season_rows(star, _kept(star["fact_game_player_stats"], teams), season)
        games = season_games(star, season).select("game_id", "season")
        roster = _roster(star, own, games, by)
    return roster.select("team_id", "season", "player_id", *ROSTER_COLUMNS, "game_score")


def _shown(ranked: DataFrame) -> DataFrame:
    one, pct = display.one_decimal, display.percent
    shown = {
        "Player": F.col("name"), "Pos": F.col("position"), "GP": F.col("games"),
        "PPG": one(F.col("ppg")), "RPG": one(F.col("rpg")), "APG": one(F.col("apg")),
        "SPG": one(F.col("spg")), "BPG": one(F.col("bpg")),
        "FG%": display.or_missing(pct(F.col("fg_pct"))),
        "3P%": display.or_missing(pct(F.col("fg3_pct"))),
        "FT%": display.or_missing(pct(F.col("ft_pct"))),
    }
    if "game_score" in ranked.columns:
        shown["Game Score"] = one(F.col("game_score"))
    return ranked.select([column.alias(name) for name, column in shown.items()])


def roster_table(star: Star, team_id: int, season: str) -> DataFrame:
    """The roster as shown: headings, one decimal, percent, a dash for no attempts."""
    return _shown(roster_stats(star, team_id, season))


def roster_display(star: Star, team_id: int, season: str) -> DataFrame:
    """The roster as shown, with game score and in its order."""
    return _shown(roster_game_score(star, team_id, season))


# ── Pairs of teams ───────────────────────────────────────────────────────────────


def team_names(star: Star) -> DataFrame:
    """One row per team id, so that a renamed team does not multiply its games."""
    return star["dim_team"].groupBy("team_id").agg(F.max("abbreviation").alias("abbreviation"))


def with_team_names(star: Star, games: DataFrame, home: str, away: str) -> DataFrame:
    names = team_names(star)

    def role(key: str, label: str) -> DataFrame:
        return names.select(F.col("team_id").alias(key), F.col("abbreviation").alias(label))

    named = games.join(role("home_team_id", home), "home_team_id")
    return named.join(role("away_team_id", away), "away_team_id")


def latest(games: DataFrame, rows: int) -> DataFrame:
    return games.orderBy(F.desc("date"), F.desc("game_id")).limit(rows)


def head_to_head(
    star: Star, team_a: int, team_b: int, season: str, rows: int = V.HEAD_TO_HEAD_GAMES
) -> DataFrame:
    """The latest games between two teams, whichever was at home."""
    home, away = F.col("home_team_id"), F.col("away_team_id")
    pair = ((home == team_a) & (away == team_b)) | ((home == team_b) & (away == team_a))
    games = in_season(star, star["fact_game"].where(pair), season)
    named = with_team_names(star, games, "home_team", "away_team")
    return latest(named, rows).select(
        "game_id", "date", "home_team", "away_team", "home_score", "away_score"
    )


def head_to_head_display(star: Star, team_a: int, team_b: int, season: str) -> DataFrame:
    shown = {
        "date": "Date", "home_team": "Home", "away_team": "Away",
        "home_score": "Home Pts", "away_score": "Away Pts",
    }
    games = head_to_head(star, team_a, team_b, season).drop("game_id")
    return games.withColumnsRenamed(shown)


def recent_games(star: Star, team_id: int, rows: int = V.HEAD_TO_HEAD_GAMES) -> DataFrame:
    """A team's latest games of any season, with names."""
    own = (F.col("home_team_id") == team_id) | (F.col("away_team_id") == team_id)
    named = with_team_names(star, star["fact_game"].where(own), "home", "away")
    return latest(named, rows).select(
        "game_id", "date", "home", "home_score", "away", "away_score"
    )
