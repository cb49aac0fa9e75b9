"""Compaction of LIVE_DATA: many small batch folders become few files a day.

Streams leave a folder per day, stream and batch. A compaction writes the rows of all finished
batches, with what was packed of those days before, into a folder of a new generation; one file in the log
then says, for every day, which generation holds it and up to which batch of every stream. Readers
take packed rows by that log and batch folders beyond it, so a row is read once: before
the log file is written nothing has changed, after it the packed batches are passed over,
also if one of them is written again by a replay. Folders that no reader needs are removed later, by
``vacuum``.

The last batch of a stream may still be replayed or be incomplete, so it is left to the next
compaction; appends of a single batch are finished when they are there.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtlake.schemas import APPEND_STREAM, LIVE_DATA, LIVE_STORED, LIVE_TABLE, struct
from courtlake.sources.publish import exists

LOG = struct("day date, generation integer, stream string, upto long")
PACKED = T.StructType(
    LIVE_DATA.fields + struct("stream string, batch_id long, generation integer, day date").fields)


def _log_path(path: str) -> str:
    return f"{path.rstrip('/')}.log"


def _packed_path(path: str) -> str:
    return f"{path.rstrip('/')}.packed"


def log(spark: SparkSession, path: str) -> DataFrame | None:
    """(day, generation, stream, upto) of the last compaction; None before the first."""
    if not exists(spark, _log_path(path)):
        return None
    lines = spark.read.schema(T.StructType(LOG.fields + struct("made integer").fields)).parquet(_log_path(path))
    return lines.where(F.col("made") == lines.select(F.max("made")).scalar()).drop("made")


def batches(spark: SparkSession, path: str) -> DataFrame:
    """Batch folders as they are, packed ones included."""
    return spark.read.schema(LIVE_STORED).parquet(path)


def _beyond(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """Rows of batches that are not packed."""
    if known is None:
        return rows
    upto = known.select("day", "stream", "upto")
    return rows.join(upto, ["day", "stream"], "left").where("upto IS NULL OR batch_id > upto").select(rows.columns)


def _packed(spark: SparkSession, path: str, known: DataFrame) -> DataFrame:
    rows = spark.read.schema(PACKED).parquet(_packed_path(path))
    valid = known.select("day", "generation").distinct()
    return rows.join(valid, ["day", "generation"], "left_semi").select(LIVE_STORED.names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every row once, from packed files and from the batches since; ``day`` prunes both."""
    known = log(spark, path)
    rows = batches(spark, path).select(LIVE_STORED.names)
    return rows if known is None else _beyond(rows, known).unionByName(_packed(spark, path, known))


def compact(spark: SparkSession, path: str) -> int:
    """Pack what is finished and not packed yet; returns how many days were written.

    Only days with new batches are read and written again.
    """
    known = log(spark, path)
    rows = _beyond(batches(spark, path), known)
    # Folder columns alone: a row per day, stream and batch.
    found = rows.select("day", "stream", "batch_id").distinct()
    last = batches(spark, path).groupBy("stream").agg(F.max("batch_id").alias("last"))
    done = found.join(last, "stream").where(
        (F.col("batch_id") < F.col("last")) | F.col("stream").startswith(APPEND_STREAM))
    upto = done.groupBy("day", "stream").agg(F.max("batch_id").alias("upto"))
    # At most a row per day and stream with news.
    fresh = [tuple(r) for r in upto.collect()]
    if not fresh:
        return 0
    news = spark.createDataFrame(fresh, "day date, stream string, upto long")
    days = sorted({d for d, _, _ in fresh})
    before = [] if known is None else [tuple(r) for r in known.collect()]
    generation = 1 + max((g for _, g, _, _ in before), default=0)

    ready = rows.where(F.col("day").isin(days)).join(news, ["day", "stream"]).where("batch_id <= upto").select(LIVE_STORED.names)
    if known is not None:
        ready = ready.unionByName(_packed(spark, path, known).where(F.col("day").isin(days)))
    (
        ready.hint("rebalance", "day").sortWithinPartitions("day", *LIVE_TABLE.sort_by)
        .write.mode("overwrite").partitionBy("day").parquet(posixpath.join(_packed_path(path), f"generation={generation}"))
    )
    ends = {(d, s): (generation if d in days else g, u) for d, g, s, u in before}
    ends |= {(d, s): (generation, u) for d, s, u in fresh}
    lines = spark.createDataFrame([(d, g, s, u) for (d, s), (g, u) in ends.items()], LOG)
    # One file: it is there whole or not at all. What a compaction without it left is written over.
    lines.coalesce(1).write.mode("overwrite").parquet(posixpath.join(_log_path(path), f"made={generation}"))
    return len(days)


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove batch folders and generations that the log passes over; returns how many folders.

    To be called when no reader or compaction that began before the last compaction is running.
    """
    known = log(spark, path)
    if known is None:
        return 0
    rows = batches(spark, path).select("day", "stream", "batch_id").distinct()
    gone = rows.join(known, ["day", "stream"]).where("batch_id <= upto").select("day", "stream", "batch_id")
    folders = [posixpath.join(path, f"day={r.day}", f"stream={r.stream}", f"batch_id={r.batch_id}") for r in gone.collect()]
    packed = spark.read.schema(PACKED).parquet(_packed_path(path)).select("generation", "day").distinct()
    old = packed.join(known.select("day", "generation").distinct(), ["day", "generation"], "left_anti")
    folders += [posixpath.join(_packed_path(path), f"generation={r.generation}", f"day={r.day}") for r in old.collect()]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for folder in folders:
        place = hadoop.Path(folder)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return len(folders)


def files_per_day(spark: SparkSession, path: str) -> DataFrame:
    """(day, files) that a reader opens."""
    known = log(spark, path)
    file = F.col("_metadata.file_path").alias("file")
    raw = batches(spark, path).select("day", "stream", "batch_id", file)
    seen = _beyond(raw, known).select("day", "file")
    if known is not None:
        packed = spark.read.schema(PACKED).parquet(_packed_path(path)).select("day", "generation", file)
        valid = known.select("day", "generation").distinct()
        seen = seen.union(packed.join(valid, ["day", "generation"], "left_semi").select("day", "file"))
    return seen.distinct().groupBy("day").agg(F.count(F.lit(1)).alias("files"))
