"""Global row numbers by a distributed sort, whatever the size of a group.

Rows are dealt by ranges of their sort key and sorted inside each range; a row's place is its
range and its position there. A small table (one row per range and group) then tells how many
rows of a group lie in earlier ranges. Rows that agree in the whole key are dealt by their
position in the input too, so that many equal rows do not meet in one range; as they are alike,
the numbers depend on what the table holds and not on how it is stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtlake.llm.common import join_null_safe, stored

#: ``monotonically_increasing_id`` holds the partition above these bits, the position below.
POSITION_BITS = 33


def ranked(rows: DataFrame, order: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``index`` (from 0 in each group, nulls first) and ``total`` (rows of the group).

    ``group`` and ``order`` name columns; a null group is a group. The rows are written twice:
    as they are, so that sampling for the ranges does not compute them again, and sorted. An
    empty table gives no row.
    """
    rows = stored(rows, "rank-rows").withColumn("_salt", F.monotonically_increasing_id())
    keys = [*group, *order, "_salt"]
    places = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_salt").withColumn(
        "_place", F.monotonically_increasing_id())
    places = stored(places, "rank-places").withColumns({
        "_range": F.shiftright("_place", POSITION_BITS),
        "_at": F.col("_place").bitwiseAND((1 << POSITION_BITS) - 1)})
    spans = places.groupBy("_range", *group).agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"))
    whole = Window.partitionBy(*group)
    before = F.sum("n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    spans = stored(spans.select(
        "_range", *group, (F.coalesce(before, F.lit(0)) - F.col("first")).alias("_shift"),
        F.sum("n").over(whole).alias("total")), "rank-spans")
    found = join_null_safe(places, spans, ["_range", *group])
    return found.withColumn("index", F.col("_at") + F.col("_shift")).drop("_place", "_range", "_at", "_shift")
