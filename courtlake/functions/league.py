"""Season labels, routing, shooting ratios and game score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtlake import fixed_values as V

# Every Unicode white-space character, as Python's own strip() knows them.
WHITE_SPACE = "".join(c for c in map(chr, range(0x10000)) if c.isspace())


def game_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text to a date; text of another form becomes NULL."""
    return F.try_to_date(text, "yyyy-MM-dd")


def us_date(day: Column) -> Column:
    """The ``MM/DD/YYYY`` form that the game finder expects."""
    return F.date_format(day, "MM/dd/yyyy")


def season_label(season_id: Column) -> Column:
    """``22019`` -> ``2019-20``."""
    start = F.substring(season_id, 2, 4).try_cast("int")
    end = F.lpad(F.pmod(start + 1, F.lit(100)).cast("string"), 2, "0")
    return F.concat(start.cast("string"), F.lit("-"), end)


def season_type(season_id: Column) -> Column:
    """Season type by the leading digit, NULL for digits without one."""
    pairs = [F.lit(part) for pair in V.SEASON_TYPES.items() for part in pair]
    return F.create_map(*pairs)[F.substring(season_id, 1, 1)]


def season_year(game_id: Column) -> Column:
    """Two-digit season year inside a game id."""
    return F.substring(game_id, 4, 2).try_cast("int")


def season_start(day: Column) -> Column:
    """The year in which the season around a day begins: seasons part on the first of August.

    A function of the day alone, whatever season the feed names, so a join on the day may also
    join on this.
    """
    return F.year(F.add_months(day, -7))


def uses_new_feed(game_id: Column) -> Column:
    """Whether a game's box score comes from the newer feed."""
    return F.coalesce(season_year(game_id) >= V.FIRST_V3_SEASON, F.lit(False))


def strip(text: Column) -> Column:
    """Text without outer white space of any kind."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def full_name(first: Column, family: Column) -> Column:
    """``first family`` with missing parts empty and outer white space removed."""
    joined = F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(family, F.lit("")))
    return strip(joined)


def ratio(made: Column, attempted: Column) -> Column:
    """``made / attempted``, NULL without attempts."""
    return F.try_divide(made.cast("double"), attempted.cast("double"))


def game_score_tenths() -> Column:
    """Game score of one row in tenths: whole numbers, so sums do not depend on row order."""
    terms = [F.col(stat) * F.lit(weight) for stat, weight in V.GAME_SCORE_TENTHS.items()]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def in_progress(status: Column) -> Column:
    """Live status: the numeric code, or text that starts with a quarter or overtime."""
    text = strip(status)
    live = (text == V.IN_PROGRESS_CODE) | text.rlike(V.IN_PROGRESS_TEXT)
    return F.coalesce(live, F.lit(False))
