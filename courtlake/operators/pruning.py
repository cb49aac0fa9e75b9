"""Range bounds taken from one table and applied to the scan of another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def within_span(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``column`` lies between the least and greatest of ``keys`` (its first column).

    Before an equality join on ``column`` this changes no result. The bounds are scalar
    subqueries that reach the Parquet scan as plain filters, so sorted files are skipped
    by their statistics and fewer rows are shuffled. It does not hold anything but two
    values, however many keys there are.

    The bounds have different shapes on purpose. Spark merges two aggregates over one table
    into a single subquery of a struct, and a field of a struct is not pushed to the scan.
    """
    values = keys.select(F.col(keys.columns[0]).alias("value"))
    low = values.select(F.min("value")).scalar()
    high = values.orderBy(F.desc("value")).limit(1).scalar()
    return df.where(F.col(column).between(low, high))
