"""Live scores as structured streams.

Messages come from Kafka in production and from landed files otherwise; both carry the
message body in ``value``. Every query has a checkpoint folder of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from courtlake import fixed_values as V
from courtlake.operators.live import (
    STATE, flatten_scoreboard, latest_per_game, parse_live_json, readable, state_changes,
    write_live,
)
from courtlake.schemas import MESSAGE, QUARANTINE
from courtlake.sources import live_store

EVERY = {"processingTime": f"{V.TRIGGER_SECONDS} seconds"}
CATCH_UP = {"availableNow": True}
_ADAPTIVE = "spark.sql.adaptive.enabled"


# ── Sources ──────────────────────────────────────────────────────────────────────


def kafka_messages(
    spark: SparkSession, brokers: str, topic: str, starting: str = "latest"
) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )


def file_messages(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Landed messages, oldest files first, a bounded number of files per micro-batch."""
    return (
        spark.readStream.schema(MESSAGE)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


# ── Sink ─────────────────────────────────────────────────────────────────────────


def append_batches(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Write each micro-batch to ``<path>/day=<d>/stream=<id>/batch_id=<n>``: LIVE_DATA's layout.

    The id is that of the query, which Spark keeps with its checkpoint: a second stream, or one
    with a new checkpoint, counts its batches from 0 again but in a folder of its own. After a
    failure Spark repeats the last batch under the same number; it then replaces its own
    folders, so nothing is doubled. A batch runs once. Its files follow its size, not the number of
    tasks that made its rows: a small batch is one file a day, a large one is written by as many
    tasks as it has parts of the advisory size; without rows it leaves none.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        owner = _owner(batch)
        with _adaptive(batch.sparkSession):
            write_live(batch.hint("rebalance"), path, owner, batch_id)

    return (
        df.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY))
        .start()
    )


@contextmanager
def _adaptive(spark: SparkSession) -> Iterator[None]:
    """Run-time planning, which a stream has off, counts the bytes before the files are cut."""
    before = spark.conf.get(_ADAPTIVE)
    spark.conf.set(_ADAPTIVE, "true")
    try:
        yield
    finally:
        spark.conf.set(_ADAPTIVE, before)


def _owner(batch: DataFrame) -> str:
    owner = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not owner:
        raise RuntimeError("a batch without the id of its stream")
    return owner


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """What the live streams of a table have written so far, with ``batch_id``."""
    return live_store.read(spark, path).drop("day", "stream")


# ── Streams ──────────────────────────────────────────────────────────────────────


def live_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    processed_time: Column | None = None,
) -> StreamingQuery:
    """Messages with one game each, appended to LIVE_DATA."""
    rows = parse_live_json(messages, processed_time)
    return append_batches(rows, path, checkpoint, trigger)


def quarantining_stream(
    messages: DataFrame,
    path: str,
    quarantine: str,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    processed_time: Column | None = None,
) -> StreamingQuery:
    """``live_stream`` for messages that may be unreadable: those are kept as they came.

    Each batch has two sinks, both replaced by a replay: rows of readable messages in LIVE_DATA, the
    text and time of the others under ``quarantine``, in a folder of the stream and batch, in as
    many files as their size asks for.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        owner, judged = _owner(batch), readable(batch).persist()
        try:
            rows = parse_live_json(judged.where("readable"), processed_time)
            write_live(rows, path, owner, batch_id)
            unread = judged.where("NOT readable").select(
                "value", "timestamp", F.lit(owner).alias("stream"), F.lit(batch_id).cast("long").alias("batch_id"))
            with _adaptive(batch.sparkSession):
                unread.hint("rebalance").write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic").partitionBy("stream", "batch_id").parquet(quarantine)
        finally:
            judged.unpersist()

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY))
        .start()
    )


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Messages that no row could be made of."""
    return spark.read.schema(QUARANTINE).parquet(path)


def scoreboard_stream(
    documents: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    processed_time: Column | None = None,
) -> StreamingQuery:
    """Whole scoreboard documents, flattened by the executors, appended to LIVE_DATA."""
    rows = flatten_scoreboard(documents, processed_time, defaults=True)
    return append_batches(rows, path, checkpoint, trigger)


def changed_only(live: DataFrame, delay: str = f"{V.LIVE_HOURS} hours") -> DataFrame:
    """A live stream without repeats: a state of a game seen again within ``delay`` is left
    out. State older than the watermark is dropped, so it does not grow without end."""
    # Watermarks need a timestamp with zone; the column itself stays as it is.
    stamped = live.withColumn("_seen", F.col("processed_time").cast("timestamp"))
    kept = stamped.withWatermark("_seen", delay)
    return kept.dropDuplicatesWithinWatermark(["game_id", *STATE]).drop("_seen")


def latest_state(live: DataFrame, delay: str = f"{V.LIVE_HOURS} hours") -> DataFrame:
    """The last snapshot of each game and day on a stream; use output mode ``update``.

    State is one row per game and day; only games of a micro-batch are emitted. A day leaves the
    state once the latest snapshot is ``delay`` past its end, so games that are over do not
    stay; snapshots that come later than that, and those without a time, are left out.
    """
    stamped = live.withColumn("_seen", F.col("processed_time").cast("timestamp")).withWatermark("_seen", delay)
    last = F.max(F.struct("processed_time", *STATE)).alias("last")
    by_day = stamped.groupBy(F.window("_seen", "1 day"), "game_id").agg(last)
    return by_day.select("game_id", *[f"last.{c}" for c in STATE], "last.processed_time")


def latest_written(batches: DataFrame) -> DataFrame:
    """The current state per game from the batches an ``update`` stream has written.

    What is emitted for a game and day only moves forward, so the last snapshot is the state.
    """
    return latest_per_game(batches)


def changes_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
    processed_time: Column | None = None,
) -> StreamingQuery:
    """Messages of which only changes of a game's state are kept; a state that comes back is one.

    Each batch is compared with the last stored state of its games, as other batches left it: a
    replay does not see what it wrote itself. Nothing is held in memory between batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        owner = _owner(batch)
        rows = parse_live_json(batch, processed_time).where("game_id IS NOT NULL").persist()
        try:
            new = rows.withColumn("_new", F.lit(True))
            if live_store.exists(batch.sparkSession, path):
                others = live_store.read(batch.sparkSession, path).where(
                    (F.col("stream") != owner) | (F.col("batch_id") < batch_id))
                games = rows.select("game_id").distinct()
                stored = latest_per_game(others.join(games, "game_id", "left_semi"))
                new = new.unionByName(stored.withColumn("_new", F.lit(False)))
            write_live(state_changes(new).where("_new"), path, owner, batch_id)
        finally:
            rows.unpersist()

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY))
        .start()
    )
