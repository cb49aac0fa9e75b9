"""Raw landing folders: ``<root>/<table>/date=<chunk start>/*.parquet``."""

from __future__ import annotations

import datetime as dt
import posixpath
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtlake import fixed_values as V
from courtlake.functions.league import us_date
from courtlake.operators.normalize import repair, type_changes
from courtlake.schemas import RAW, struct
from courtlake.sources import publish

PARTITION = struct("date date")


#: Of each landed chunk: the least and greatest day of play in it, as the feed writes them.
CHUNKS = struct("first_day string, last_day string, rows long")
_DAY = "GAME_DATE"


def scan(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A landed table with its fixed schema and its ``date`` partition column.

    Reading the root, not a file glob, is what lets filters on ``date`` prune folders. Dates
    that are being replaced are read from where they are complete.
    """
    schema = T.StructType(RAW[table].fields + PARTITION.fields)
    return publish.resolved(spark, root, table, spark.read.schema(schema).parquet)


def land(df: DataFrame, root: str, table: str, gathered: bool = False) -> None:
    """Write or replace the date partitions present in ``df``; the others stay.

    A replacement that was stopped is finished first, so that it cannot undo this one. The
    chunks' days of play are noted beside the table. ``gathered`` as in
    :func:`~courtlake.sources.publish.write_dates`.
    """
    spark = df.sparkSession
    publish.settle(spark, root, table)
    if _DAY not in df.columns:
        publish.write_dates(df, posixpath.join(root, table), gathered)
        return
    # As many values as there are chunks in the batch.
    seen = Observation()
    publish.write_dates(df.observe(seen, F.collect_set(F.coalesce(F.col("date").cast("string"), F.lit(""))).alias("dates")),
                        posixpath.join(root, table), gathered)
    index_chunks(spark, root, table, seen.get["dates"])


def _chunks_path(root: str, table: str) -> str:
    return posixpath.join(root, f"{table}.chunks")


def index_chunks(spark: SparkSession, root: str, table: str, dates: list[str] | None = None) -> None:
    """Note the days of play of landed chunks: of all, or of some ("" is the one without a date).

    A row per chunk, in a folder per chunk like the chunk itself, so landing a chunk again
    replaces its row. Reads one column.
    """
    landed = spark.read.schema(T.StructType(RAW[table].fields + PARTITION.fields)).parquet(
        posixpath.join(root, table))
    if dates is not None:
        known = [dt.date.fromisoformat(d) for d in dates if d]
        wanted = F.col("date").isin(known) if known else F.lit(False)
        landed = landed.where(wanted | F.col("date").isNull() if "" in dates else wanted)
    days = landed.groupBy("date").agg(
        F.min(_DAY).alias("first_day"), F.max(_DAY).alias("last_day"), F.count(F.lit(1)).alias("rows"))
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(
        _chunks_path(root, table))


def chunk_index(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """(date, first_day, last_day, rows) of the landed chunks; None where none were noted."""
    path = _chunks_path(root, table)
    if not publish.exists(spark, path):
        return None
    return spark.read.schema(T.StructType(CHUNKS.fields + PARTITION.fields)).parquet(path)


def without_chunks(games: DataFrame, index: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """``games`` without the chunks that are known to hold no day between two, both included.

    A chunk that the index does not know is read. The list is at most one date per chunk.
    """
    apart = index.where(~F.coalesce(
        (F.col("first_day") <= end.isoformat()) & (F.col("last_day") >= start.isoformat()), F.lit(False)))
    known = [r.date for r in apart.select("date").collect()]
    dated = [d for d in known if d is not None]
    if dated:
        games = games.where(F.col("date").isNull() | ~F.col("date").isin(dated))
    return games.where("date IS NOT NULL") if None in known else games


def find_games(
    games: DataFrame,
    start: dt.date,
    end: dt.date,
    league: str = V.LEAGUE,
    months: int | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    """Landed games of a league played between two dates, both included.

    With ``index`` (:func:`chunk_index`) only chunks that hold such days are read, however long
    they are, and the one without a date too. Otherwise a game is taken to lie in the partition
    whose chunk covers it, so only chunks that begin no later than ``end`` are read, and with
    ``months``, the longest chunk that was landed, none that begin earlier than that before ``start``;
    games landed without a chunk's date are then not found.
    """
    if index is not None:
        games = without_chunks(games, index, start, end)
    else:
        games = games.where(F.col("date") <= F.lit(end))
        if months is not None:
            games = games.where(F.col("date") > F.add_months(F.lit(start), -months))
    return games.where(
        F.col(_DAY).between(start.isoformat(), end.isoformat())
        & F.col("GAME_ID").startswith(league)
    )


# ── Backfill plan ────────────────────────────────────────────────────────────────


def chunk_plan(bounds: DataFrame, months: int = V.CHUNK_MONTHS) -> DataFrame:
    """Date chunks that cover a span: ``bounds`` is one row with ``start`` and ``end``.

    Each chunk begins ``months`` after the one before, so a start on the 29th to 31st moves
    to the shorter month's last day and stays there. The last chunk is clipped to ``end``.
    """
    span = F.floor(F.months_between("end", "start") / months).cast("int") + 1
    starts = F.aggregate(
        F.sequence(F.lit(1), span),
        F.array("start"),
        lambda done, _: F.concat(done, F.array(F.add_months(F.element_at(done, -1), months))),
    )
    chunks = (
        bounds.where("start <= end")
        .select("end", F.explode(starts).alias("chunk_start"))
        .where("chunk_start <= end")
    )
    last_day = F.date_sub(F.add_months("chunk_start", months), 1)
    return chunks.select(
        "chunk_start",
        F.least(last_day, F.col("end")).alias("chunk_end"),
    ).select(
        "*",
        us_date(F.col("chunk_start")).alias("date_from"),
        us_date(F.col("chunk_end")).alias("date_to"),
    )


def pending_chunks(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """Chunks without a landed partition; reads no column but the partition's."""
    have = landed.select(F.col("date").alias("chunk_start")).distinct()
    return plan.join(have, "chunk_start", "left_anti")


def chunk_days(plan: DataFrame) -> DataFrame:
    """Every day of the plan with its chunk: one row per calendar day."""
    days = F.explode(F.sequence("chunk_start", "chunk_end")).alias("day")
    return plan.select(days, F.col("chunk_start").alias("date"))


def chunk_game_counts(games: DataFrame) -> DataFrame:
    """Distinct games per landed chunk.

    Distinct first, count second: copies of a game collapse in each task, and no task ever
    holds the set of games of a whole chunk.
    """
    ids = games.select("date", "GAME_ID").distinct()
    return ids.groupBy("date").agg(F.count("GAME_ID").alias("games"))


# ── Folders whose files disagree on column types ─────────────────────────────────


@dataclass(frozen=True)
class SchemaGroup:
    """Partition folders (or files) that Spark can read as one schema."""

    paths: tuple[str, ...]
    schema: T.StructType

    @property
    def changes(self) -> dict[str, tuple[str, str]]:
        return type_changes(self.schema)


def _folders(spark: SparkSession, path: str) -> list[str]:
    # Spark's own file listing; the schema given is never used to read a row.
    files = spark.read.schema("_ INT").parquet(path).inputFiles()
    return sorted({posixpath.dirname(f) for f in files})


def _files(spark: SparkSession, folder: str) -> list[str]:
    return sorted(spark.read.schema("_ INT").parquet(folder).inputFiles())


def schema_groups(spark: SparkSession, path: str) -> list[SchemaGroup]:
    """Partition the folders of a table into runs that share compatible column types.

    Feeds change type at few points in time, so folders are halved until each run's
    footers merge: a handful of distributed footer jobs instead of one per folder. Only
    schemas reach the driver.
    """

    def merged(paths: list[str]) -> T.StructType | None:
        reader = spark.read.option("mergeSchema", True).option("basePath", path)
        try:
            return reader.parquet(*paths).schema
        except (PySparkException, Py4JJavaError) as error:
            if "CANNOT_MERGE_SCHEMAS" not in str(error):
                raise
            return None

    def split(paths: list[str]) -> list[SchemaGroup]:
        schema = merged(paths)
        if schema is not None:
            return [SchemaGroup(tuple(paths), schema)]
        if len(paths) == 1:
            files = _files(spark, paths[0])
            if files == paths:
                raise ValueError(f"unreadable schema: {paths[0]}")
            return split(files)
        middle = len(paths) // 2
        return split(paths[:middle]) + split(paths[middle:])

    runs = split(_folders(spark, path))
    by_types: dict[str, SchemaGroup] = {}
    for run in runs:
        types = ",".join(sorted(f"{f.name}:{f.dataType.simpleString()}" for f in run.schema))
        seen = by_types.get(types)
        paths = (seen.paths if seen else ()) + run.paths
        by_types[types] = SchemaGroup(paths, run.schema)
    return list(by_types.values())


def _read_group(spark: SparkSession, path: str, group: SchemaGroup) -> DataFrame:
    reader = spark.read.schema(group.schema).option("basePath", path)
    return repair(reader.parquet(*group.paths))


def scan_repaired(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A landed table whose files hold a column as BIGINT here and DOUBLE there.

    One scan per distinct schema (not per folder), cast, stacked by name. The vectorised
    reader stays on.
    """
    return publish.resolved(spark, root, table, lambda path: _stacked(spark, path, schema_groups(spark, path)))


def _stacked(spark: SparkSession, path: str, groups: list[SchemaGroup]) -> DataFrame:
    out = _read_group(spark, path, groups[0])
    for group in groups[1:]:
        out = out.unionByName(_read_group(spark, path, group), allowMissingColumns=True)
    return out


def _date_of(path: str) -> dt.date | None:
    """The date of a partition folder, or of a file in it; None for that of rows without one."""
    value = path.rsplit("date=", 1)[1].split("/", 1)[0]
    return None if value == "__HIVE_DEFAULT_PARTITION__" else dt.date.fromisoformat(value)


def repair_in_place(spark: SparkSession, root: str, table: str, staging: str) -> int:
    """Rewrite only the folders that need repair; returns how many were rewritten.

    The repaired folders are published as one generation (:mod:`~courtlake.sources.publish`): a folder is
    never overwritten while it is read, a stop between the two writes loses nothing, and a second
    run, or the next landing, finishes what the first began. The folder of rows without a
    date is repaired like any other.
    """
    publish.settle(spark, root, table)
    path = posixpath.join(root, table)
    groups = schema_groups(spark, path)
    dates = {_date_of(p) for g in groups if g.changes for p in g.paths}
    if not dates:
        return 0
    touched = publish.Pending("", tuple(dates)).covers(F.col("date"))
    publish.replace(_stacked(spark, path, groups).where(touched), root, table, staging)
    return len(dates)
