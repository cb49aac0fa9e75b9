"""Compaction of LIVE_DATA: every row once, before, between and after."""

import glob

from pyspark.sql import functions as F
from test_streaming import T0, Topic, event, topic  # noqa: F401

from courtlake.operators import live as L
from courtlake.schemas import LIVE_DATA, MESSAGE, STAR
from courtlake.sources import live_store
from courtlake.sources.warehouse import Warehouse
from courtlake.streaming import live_stream as S


def content(df):
    return sorted((tuple(r) for r in df.select(LIVE_DATA.names).collect()), key=repr)


def send(topic, first, last):  # noqa: F811
    for i in range(first, last):
        topic.send(event(f"g{i % 3}", i), event("h", -i), minute=i * 7)
        topic.run(topic.parsed())


def test_rows_are_read_once(spark, topic):  # noqa: F811
    send(topic, 0, 6)
    before = content(live_store.read(spark, topic.out))
    assert len(before) == 12
    assert live_store.compact(spark, topic.out) == 1
    assert content(live_store.read(spark, topic.out)) == before
    assert content(S.read_batches(spark, topic.out)) == before
    assert live_store.compact(spark, topic.out) == 0
    assert live_store.vacuum(spark, topic.out) == 5
    assert content(live_store.read(spark, topic.out)) == before
    # One packed file and the stream's last batch.
    assert [r.files for r in live_store.files_per_day(spark, topic.out).collect()] == [2]


def test_replay_of_a_packed_batch_adds_nothing(spark, topic):  # noqa: F811
    send(topic, 0, 4)
    before = content(live_store.read(spark, topic.out))
    batch = live_store.batches(spark, topic.out).where("batch_id = 1")
    owner = batch.first().stream
    again = spark.createDataFrame(batch.select(LIVE_DATA.names).collect(), LIVE_DATA)
    live_store.compact(spark, topic.out)
    live_store.vacuum(spark, topic.out)
    L.write_live(again, topic.out, owner, 1)
    assert content(live_store.read(spark, topic.out)) == before
    send(topic, 4, 7)
    live_store.compact(spark, topic.out)
    live_store.vacuum(spark, topic.out)
    after = content(live_store.read(spark, topic.out))
    assert len(after) == 14 and set(before) <= set(after)


def test_a_compaction_cut_off_changes_nothing(spark, topic):  # noqa: F811
    send(topic, 0, 3)
    before = content(live_store.read(spark, topic.out))
    # Packed files are there, the log is not.
    spark.range(1).selectExpr("'x' AS game_id").write.parquet(f"{topic.out}.packed/generation=1/day=2024-01-01")
    assert content(live_store.read(spark, topic.out)) == before
    assert live_store.compact(spark, topic.out) == 1
    assert content(live_store.read(spark, topic.out)) == before


def test_days_without_news_stay(spark, topic):  # noqa: F811
    send(topic, 0, 3)
    live_store.compact(spark, topic.out)
    files = set(glob.glob(f"{topic.out}.packed/**/*.parquet", recursive=True))
    topic.send(event("next", 1), minute=60 * 24 * 3)
    topic.run(topic.parsed())
    topic.send(event("last", 1), minute=60 * 24 * 3 + 5)
    topic.run(topic.parsed())
    whole = content(live_store.read(spark, topic.out))
    live_store.compact(spark, topic.out)
    live_store.vacuum(spark, topic.out)
    assert content(live_store.read(spark, topic.out)) == whole and len(whole) == 8
    day = live_store.read(spark, topic.out).where(F.col("day") == F.lit(T0.date()))
    assert len(content(day)) == 6 and files


def test_catalog_reads_packed_rows(spark, topic):  # noqa: F811
    store = Warehouse(spark, topic.root)
    topic.out = store.path("live_data")
    send(topic, 0, 3)
    more = L.parse_live_json(spark.createDataFrame([(event("c", 3), T0)], MESSAGE), F.col("timestamp"))
    store.append("live_data", more)
    try:
        for _ in range(2):
            store.create_tables()
            assert spark.table("live_data").count() == 7
            live_store.compact(spark, topic.out)
            live_store.vacuum(spark, topic.out)
    finally:
        spark.sql("DROP VIEW IF EXISTS live_data")
        for t in (*STAR, "team_days", "player_days"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_a_small_batch_is_one_file(spark, topic):  # noqa: F811
    rows = [event(f"g{i}", i) for i in range(200)]
    topic.send(*rows)
    topic.run(topic.parsed().repartition(7))
    assert len(glob.glob(f"{topic.out}/**/*.parquet", recursive=True)) == 1


def test_unreadable_messages_are_kept(spark, topic, rows):  # noqa: F811
    wrong = '{"game_id": "w", "h_points": "many"}'
    topic.send(event("a", 1), "{not json", "", wrong)
    topic.send(event("b", 1), '{"h_points": 3}')
    for checkpoint in ("one", "one", "two"):
        S.quarantining_stream(topic.source(), topic.out, f"{topic.root}/bad", f"{topic.root}/{checkpoint}", S.CATCH_UP,
                              F.col("timestamp")).awaitTermination()
    good, bad = S.read_batches(spark, topic.out), S.read_quarantine(spark, f"{topic.root}/bad")
    assert rows(good, "game_id") == [("a",), ("a",), ("b",), ("b",)]
    assert rows(bad, "value") == sorted([("{not json",), ("",), (wrong,), ('{"h_points": 3}',)] * 2, key=repr)


def test_state_that_comes_back_is_a_change(spark):
    def row(game, minute, points):
        return (game, "A", "B", points, 0, 1, "", "Q1", T0.replace(hour=10 + minute // 60, minute=minute % 60))

    given = [row("a", m, p) for m, p in [(0, 1), (5, 1), (10, 2), (59, 2), (61, 2), (125, 1), (130, 1), (240, 1), (241, 3)]]
    given += [row("b", 0, 1), row("b", 0, 1), row("b", 0, 2), row(None, 3, 1), row(None, 4, 1)]
    found = L.state_changes(spark.createDataFrame(given, LIVE_DATA)).collect()
    by = {g: sorted((r.processed_time, r.h_points) for r in found if r.game_id == g) for g in ("a", "b", None)}
    assert [p for _, p in by["a"]] == [1, 2, 1, 3] and [p for _, p in by["b"]] == [1, 2] and len(by[None]) == 1


def test_changes_against_the_stored_state(spark, topic, rows):  # noqa: F811
    def run(checkpoint):
        S.changes_stream(topic.source(), topic.out, f"{topic.root}/{checkpoint}", S.CATCH_UP,
                         F.col("timestamp")).awaitTermination()

    for minute, points in ((0, 1), (1, 1), (2, 2), (3, 2), (4, 1)):
        topic.send(event("a", points), "{not json", minute=minute)
        run("one")
    kept = live_store.read(spark, topic.out)
    assert sorted((r.processed_time.minute, r.h_points) for r in kept.collect()) == [(0, 1), (2, 2), (4, 1)]
    # A batch that runs again finds the states before it, not its own.
    live_store.compact(spark, topic.out)
    assert sorted(r.h_points for r in live_store.read(spark, topic.out).collect()) == [1, 1, 2]


def test_finished_games_leave_the_state(spark, topic):  # noqa: F811
    sizes = []
    for day in range(4):
        topic.send(*[event(f"g{day}-{i}", i) for i in range(5)], minute=60 * 24 * 2 * day)
        rows = S.latest_state(topic.parsed().where("game_id IS NOT NULL"))
        query = S.append_batches(rows, topic.out, topic.checkpoint, S.CATCH_UP, mode="update")
        query.awaitTermination()
        sizes.append(max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]))
        last = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1]
    assert last <= 5 and max(sizes) <= 10
    states = S.latest_written(S.read_batches(spark, topic.out))
    assert states.count() == 20
