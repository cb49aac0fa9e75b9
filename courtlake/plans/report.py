"""The warehouse report: sizes, samples and diagnostics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlake import fixed_values as V
from courtlake.plans.season import Star, recent_games
from courtlake.schemas import STAR


def table_counts(star: Star) -> DataFrame:
    counts = [
        star[name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("tbl"), "row_count"
        )
        for name in STAR
    ]
    return reduce(DataFrame.union, counts).orderBy("tbl")


def season_type_counts(star: Star) -> DataFrame:
    return star["dim_date"].groupBy("season_type").agg(F.count(F.lit(1)).alias("dates"))


def home_away_counts(star: Star, team_id: int) -> DataFrame:
    return star["fact_game"].agg(
        F.count_if(F.col("home_team_id") == team_id).alias("home_games"),
        F.count_if(F.col("away_team_id") == team_id).alias("away_games"),
    )


def team_by_abbr(star: Star, abbreviation: str) -> DataFrame:
    found = star["dim_team"].where(F.col("abbreviation") == abbreviation)
    return found.select("team_id", "name", "abbreviation")


def sample(df: DataFrame, rows: int = V.SAMPLE_ROWS) -> DataFrame:
    """Any few rows, as a look at a table: no more files are read than hold them."""
    return df.limit(rows)


def first_rows(df: DataFrame, rows: int = V.SAMPLE_ROWS) -> DataFrame:
    """The same few rows every time, the first in order of all columns: reads the whole table."""
    return df.orderBy(*df.columns).limit(rows)


def warehouse_report(star: Star, team_id: int, abbreviation: str) -> dict[str, DataFrame]:
    """Every part of the report, each a DataFrame of its own shape."""
    return {
        "table_counts": table_counts(star),
        **{f"sample_{name}": sample(star[name].select(STAR[name].schema.names)) for name in STAR},
        "team_by_abbr": team_by_abbr(star, abbreviation),
        "home_away_counts": home_away_counts(star, team_id),
        "recent_games": recent_games(star, team_id),
        "season_type_counts": season_type_counts(star),
    }
