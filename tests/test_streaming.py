import datetime as dt
import json
import glob
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from courtlake.operators import live as L
from courtlake.plans.rollup import ROLLUPS
from courtlake.schemas import LIVE_STORED, MESSAGE, STAR
from courtlake.sources.warehouse import Warehouse
from courtlake.streaming import live_stream as S

T0 = dt.datetime(2024, 1, 1, 12)


def event(game, points, status="Q1"):
    return json.dumps({"game_id": game, "h_team": "A", "a_team": "B", "h_points": points,
                       "a_points": 0, "quarter": 1, "clock": "", "game_status": status})


class Topic:
    """Landed message files; each ``send`` is one file and so one micro-batch."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.path, self.out, self.checkpoint = (f"{root}/{n}" for n in ("topic", "out", "ckpt"))
        os.makedirs(self.path)

    def send(self, *events, minute=0):
        stamp = T0 + dt.timedelta(minutes=minute)
        df = self.spark.createDataFrame([(e, stamp) for e in events], MESSAGE)
        df.coalesce(1).write.mode("append").parquet(self.path)

    def source(self):
        return S.file_messages(self.spark, self.path, files_per_batch=1)

    def parsed(self):
        return L.parse_live_json(self.source(), F.col("timestamp"))

    def run(self, df, **options):
        query = S.append_batches(df, self.out, self.checkpoint, S.CATCH_UP, **options)
        query.awaitTermination()
        return S.read_batches(self.spark, self.out)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, str(tmp_path))


def test_a_second_stream_keeps_the_rows_of_the_first(spark, topic, rows):
    topic.send(event("a", 1))
    topic.run(topic.parsed())
    topic.checkpoint += "-new"
    topic.send(event("b", 2))
    both = topic.run(topic.parsed())
    assert rows(both, "game_id", "batch_id") == [("a", 0), ("a", 0), ("b", 1)]


def test_append_beside_a_stream_keeps_both(spark, topic, rows, plan):
    store = Warehouse(spark, topic.root)
    topic.out = store.path("live_data")
    topic.send(event("a", 1), event("b", 2))
    topic.run(topic.parsed())
    more = L.parse_live_json(spark.createDataFrame([(event("c", 3), T0)], MESSAGE), F.col("timestamp"))
    assert store.append("live_data", more) == 1 and store.append("live_data", more) == 1
    both = store.read("live_data")
    assert both.columns == LIVE_STORED.names
    assert rows(both, "game_id", "day") == [(g, T0.date()) for g in "abcc"]
    try:
        store.create_tables()
        assert rows(spark.table("live_data"), "game_id") == [("a",), ("b",), ("c",), ("c",)]
    finally:
        spark.sql("DROP VIEW IF EXISTS live_data")
        for t in (*STAR, *ROLLUPS):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
    recent = L.since(both, T0 + dt.timedelta(days=2))
    assert "day" in plan(recent).split("PartitionFilters: [")[1].split("]")[0]
    assert recent.isEmpty()


def test_files_of_a_batch_follow_its_size(spark, topic):
    topic.send(*[event(f"g{i}", i) for i in range(100)])
    topic.run(topic.parsed().repartition(40))
    assert len(glob.glob(f"{topic.out}/*/*/*/*.parquet")) == 1
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_append_equals_batch_and_restart_adds_nothing(spark, topic, rows):
    topic.send(event("a", 1), event("b", 2))
    topic.send(event("a", 3), "{oops")
    batch = L.parse_live_json(spark.read.schema(MESSAGE).parquet(topic.path), F.col("timestamp"))
    first = topic.run(topic.parsed())
    assert rows(first.drop("batch_id")) == rows(batch)
    assert first.select("batch_id").distinct().count() == 2
    assert topic.run(topic.parsed()).count() == 4
    topic.send(event("c", 5))
    assert topic.run(topic.parsed()).count() == 5


def test_replayed_batch_replaces_itself(spark, topic, rows):
    topic.send(event("a", 1), event("b", 2))
    topic.send(event("a", 3))
    before = rows(topic.run(topic.parsed()))
    # The last commit is lost, as in a crash between the write and the commit.
    commits = os.path.join(topic.checkpoint, "commits")
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        path = os.path.join(commits, name)
        if os.path.exists(path):
            os.remove(path)
    assert rows(topic.run(topic.parsed())) == before


def test_live_stream_stamps_each_batch(spark, topic):
    topic.send(event("a", 1), event("b", 2))
    S.live_stream(topic.source(), topic.out, topic.checkpoint, S.CATCH_UP).awaitTermination()
    got = S.read_batches(spark, topic.out)
    assert got.select("processed_time").distinct().count() == 1


def test_scoreboard_stream(spark, topic, rows):
    game = {"gameId": "g", "homeTeam": {"teamTricode": "A", "score": None},
            "awayTeam": {"teamTricode": "B", "score": 4}, "period": 1, "gameStatus": 2}
    topic.send(json.dumps({"scoreboard": {"games": [game, {**game, "gameId": "h"}]}}))
    topic.send(json.dumps({"scoreboard": {"games": []}}))
    S.scoreboard_stream(
        topic.source(), topic.out, topic.checkpoint, S.CATCH_UP, F.col("timestamp")
    ).awaitTermination()
    got = S.read_batches(spark, topic.out)
    assert rows(got, "game_id", "h_points", "a_points", "game_status", "batch_id") == [
        ("g", 0, 4, "2", 0), ("h", 0, 4, "2", 0),
    ]
    assert not glob.glob(f"{topic.out}/*/*/batch_id=1")


def test_latest_state_over_batches(topic, rows):
    topic.send(event("a", 1), event("b", 1), minute=0)
    topic.send(event("a", 2), minute=1)
    topic.send(event("b", 7), minute=-5)  # late: does not replace
    out = topic.run(S.latest_state(topic.parsed()), mode="update")
    assert rows(S.latest_written(out), "game_id", "h_points") == [("a", 2), ("b", 1)]


def test_changed_only(topic, rows):
    topic.send(event("a", 1), event("a", 1), event("b", 1))
    topic.send(event("a", 1), event("a", 2))
    topic.send(event("a", 1), minute=60 * 24)
    topic.send(event("a", 1), minute=60 * 24 + 1)
    topic.send(event("a", 1), minute=60 * 24 + 2)
    out = topic.run(S.changed_only(topic.parsed()))
    # A state that comes back after the watermark has dropped it is a change again.
    assert rows(out, "game_id", "h_points") == [("a", 1), ("a", 1), ("a", 2), ("b", 1)]
    assert out.where("game_id = 'a' AND h_points = 1").agg(F.max("batch_id")).first()[0] >= 3


def test_default_trigger():
    assert S.EVERY == {"processingTime": "5 seconds"}


def test_kafka_source_needs_its_package(spark):
    try:
        df = S.kafka_messages(spark, "localhost:9092", "live")
    except AnalysisException as error:
        assert "kafka" in str(error).lower()
    else:
        assert {"value", "timestamp"} <= set(df.columns)
