"""Text shown to people: one-decimal numbers, percentages, records, live labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "—"


def one_decimal(value: Column) -> Column:
    """One decimal, rounded on the exact binary value with ties to even; NULL stays NULL.

    ``format_number`` with a pattern rounds this way. ``format_string`` and ``round`` work on
    the shortest decimal text of the double and send ties up: 112.25 would show as 112.3.
    """
    return F.call_function("format_number", value.cast("double"), F.lit("0.0"))


def percent(value: Column) -> Column:
    """A share as a percentage with one decimal; NULL stays NULL.

    Shares are means of fractions, whose last bits depend on the order of summation; they
    are dropped first, so that a tie is a tie in every run.
    """
    return F.concat(one_decimal(F.round(value, 12) * 100), F.lit("%"))


def or_missing(text: Column) -> Column:
    return F.coalesce(text, F.lit(MISSING))


def record_text(wins: Column, losses: Column) -> Column:
    return F.concat(wins.cast("string"), F.lit("–"), losses.cast("string"))


def quarter_label(quarter: Column) -> Column:
    """``Q3``; empty when the quarter is missing or zero."""
    known = F.coalesce(quarter, F.lit(0)) != 0
    return F.when(known, F.concat(F.lit("Q"), quarter.cast("string"))).otherwise("")


def matchup_label(home: Column, away: Column) -> Column:
    return F.concat(home, F.lit(" vs "), away)
