"""Replacing partitions of a landed table so that a stop at any point loses nothing.

The new partitions are written whole into a generation folder beside the table. One appended
line then points at it: from that moment readers take its dates from there and all others
from the table. Afterwards the generation is copied into the table, date by date, and a second
line closes the pointer. Stopped before the first line, nothing has happened; stopped
after it, readers see the new rows, and whoever writes to the table next (or a second try)
finishes the copy, which may be repeated.
"""

from __future__ import annotations

import posixpath
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.schemas import struct

POINTER = struct("generation string, moment timestamp, closed boolean")


@dataclass(frozen=True)
class Pending:
    """A generation that readers resolve to and that is not copied into its table yet."""

    path: str
    dates: tuple

    def covers(self, date: Column) -> Column:
        """Whether a date, null included, is read from the generation."""
        known = [d for d in self.dates if d is not None]
        inside = F.coalesce(date.isin(known), F.lit(False)) if known else F.lit(False)
        return inside | date.isNull() if None in self.dates else inside


def write_dates(df: DataFrame, path: str, gathered: bool = False) -> None:
    """Write or replace the date partitions present in ``df``; the others stay.

    The rebalance hint gathers each date into few files and splits a date that holds much
    of the data over many writers. Rows that a source has ``gathered`` so are written as they come.
    """
    (
        (df if gathered else df.hint("rebalance", "date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def _lines(root: str, table: str) -> str:
    return posixpath.join(root, f"{table}.pointer")


def _point(spark: SparkSession, root: str, table: str, generation: str, closed: bool) -> None:
    line = spark.range(1).select(
        F.lit(generation).alias("generation"), F.current_timestamp().alias("moment"), F.lit(closed).alias("closed"))
    line.coalesce(1).write.mode("append").parquet(_lines(root, table))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a folder, in whatever file system the path names."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def pending(spark: SparkSession, root: str, table: str) -> Pending | None:
    """The generation to finish, the oldest if there are several."""
    if not exists(spark, _lines(root, table)):
        return None
    lines = spark.read.schema(POINTER).parquet(_lines(root, table))
    still = lines.groupBy("generation").agg(F.min("moment").alias("moment"), F.max("closed").alias("closed"))
    first = still.where("NOT closed").orderBy("moment", "generation").first()
    if first is None:
        return None
    # As many rows as there are date folders.
    dates = spark.read.parquet(first.generation).select("date").distinct().collect()
    return Pending(first.generation, tuple(r.date for r in dates))


def settle(spark: SparkSession, root: str, table: str) -> int:
    """Finish what a stopped replacement left; returns how many generations were copied."""
    done = 0
    while (found := pending(spark, root, table)) is not None:
        write_dates(spark.read.parquet(found.path), posixpath.join(root, table))
        _point(spark, root, table, found.path, closed=True)
        done += 1
    return done


def replace(df: DataFrame, root: str, table: str, staging: str) -> None:
    """Replace the dates of ``df``, which may read the table itself."""
    spark = df.sparkSession
    settle(spark, root, table)
    generation = posixpath.join(staging, f"{table}-{uuid.uuid4().hex}")
    write_dates(df, generation)
    _point(spark, root, table, generation, closed=False)
    settle(spark, root, table)


def resolved(spark: SparkSession, root: str, table: str, read) -> DataFrame:
    """The table's rows: ``read(path)`` of its folder, or of the generation for the dates there."""
    base = read(posixpath.join(root, table))
    found = pending(spark, root, table)
    if found is None:
        return base
    return base.where(~found.covers(F.col("date"))).unionByName(read(found.path))
