"""What is shuffled on the way to the landed and published tables, and by how many tasks it is written."""

import re

import pytest

from pyspark.sql import functions as F

from courtlake import fixtures
from courtlake.operators import delta
from courtlake.plans import rollup, star
from courtlake.sources import landing, warehouse
from courtlake.streaming import live_stream
from courtlake.workspace import Workspace


@pytest.fixture
def league(spark, tmp_path):
    root = str(tmp_path)
    spark.sql(
        "SELECT id div 4 AS l_orderkey, id % 97 AS l_partkey, id % 23 AS l_suppkey, id % 7 + 1 AS l_linenumber, "
        "CAST(id % 50 + 1 AS decimal(15,2)) AS l_quantity, CAST(id % 11 / 100 AS decimal(15,2)) AS l_discount, "
        "CAST(id % 9 / 100 AS decimal(15,2)) AS l_tax, IF(id % 2 = 0, 'A', 'N') AS l_returnflag, "
        "IF(id % 3 = 0, 'F', 'O') AS l_linestatus FROM range(400)").write.parquet(f"{root}/lineitem.parquet")
    spark.sql(
        "SELECT id AS o_orderkey, date_add(DATE'1996-01-01', CAST(id * 7 AS int)) AS o_orderdate, "
        "concat(id % 5 + 1, '-X') AS o_orderpriority FROM range(100)").write.parquet(f"{root}/orders.parquet")
    spark.sql("SELECT id AS s_suppkey, concat('S', id) AS s_name FROM range(23)").write.parquet(f"{root}/supplier.parquet")
    return root


@pytest.mark.parametrize("source", ["player_stats", "team_stats"])
def test_sources_come_gathered(spark, league, tmp_path, source):
    """Landing such a source leaves the rows as they are and a file a date, as its own shuffle would."""
    built = fixtures.RAW_SOURCES[source](spark, league)
    for number, gathered in enumerate((True, False)):
        landing.land(built, f"{tmp_path}/{number}", source, gathered)
    one, other = (landing.scan(spark, f"{tmp_path}/{n}", source) for n in (0, 1))
    assert source in fixtures.GATHERED and one.count() > 100
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
    assert len(one.inputFiles()) == one.select("date").distinct().count()


def test_only_few_columns_are_shuffled(spark, league):
    """Of a performance's thirty columns those it is made of; sums without their ratios and ids."""
    for source, wide in (("player_stats", ("FG_PCT", "PTS", "REB")), ("team_stats", ("FG_PCT", "GAME_ID"))):
        built = fixtures.RAW_SOURCES[source](spark, league)
        text = built._jdf.queryExecution().optimizedPlan().toString()
        gathered = text[text.index("RebalancePartitions"):]
        assert not any(re.search(rf"AS {c}#", gathered) for c in wide)


def test_duplicate_games_repeat_their_sums(spark, league):
    """An order that comes twice gives its team's sums twice, not doubled."""
    before = fixtures.team_stats(spark, league)
    expected = before.unionByName(before).collect()
    orders = spark.read.parquet(f"{league}/orders.parquet").checkpoint()
    orders.union(orders).write.mode("overwrite").parquet(f"{league}/orders.parquet")
    spark.catalog.refreshByPath(f"{league}/orders.parquet")
    assert sorted(fixtures.team_stats(spark, league).collect()) == sorted(expected)


def test_rollups_need_only_their_own_box_scores(spark, league):
    space = Workspace(spark, league)
    space.star["team_days"]
    done = space._written["_".join(space._RAW_FROM)][2]
    assert "star/team_days" in done and not any("player" in name for name in done)
    assert space.star["player_days"].count() > 0


def test_repeated_keys_leave_the_other_rows_in_place(spark, plan, monkeypatch):
    df = spark.sql("SELECT id % 90 AS k, id AS v FROM range(100)").checkpoint()
    text = plan(delta.one_row_per_key(df, ["k"]))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    few = sorted(delta.one_row_per_key(df, ["k"]).collect())
    monkeypatch.setattr(delta, "SENT_KEYS", 3)
    assert few == sorted(delta.one_row_per_key(df, ["k"]).collect()) == [(i, i) for i in range(90)]


@pytest.mark.parametrize("number", [1, 40, 3000])
def test_a_bitmap_of_keys_misses_none(spark, number):
    df = spark.sql("SELECT IF(id % 50 = 0, NULL, concat('g', id)) AS k, id AS v FROM range(20000)").checkpoint()
    keys = df.where(f"v < {number}").select("k").distinct()
    hit = delta.marked(df, keys, ["k"], number).where("_hit").drop("_hit")
    held = df.join(keys.toDF("_k"), F.col("k").eqNullSafe(F.col("_k")), "left_semi")
    assert held.exceptAll(hit).isEmpty() and hit.count() <= held.count() + 20_000 / 8


def test_only_games_of_another_season_meet_their_game(spark, league, monkeypatch):
    """Of box scores, those whose game has another season than most of the landing partition's,
    or is not stored, are joined with the games; every row is in its game's folder."""
    passed = []
    monkeypatch.setattr(warehouse, "marked", lambda df, keys, on, n: passed.append((df, keys)) or delta.marked(df, keys, on, n))
    space = Workspace(spark, league)
    boxes = space.star["fact_game_team_stats"]
    games = space.star["fact_game"].select("game_id", F.col("season_start").alias("_of"))
    placed = boxes.join(games, "game_id", "left").groupBy(F.coalesce("_of", F.lit(-1)).alias("of"), "season_start").count()
    assert all(r.of == r.season_start for r in placed.collect()) and placed.count() > 2
    (df, others), = passed
    assert 0 < others.count() < boxes.select("game_id").distinct().count() / 2
    assert boxes.count() == space.raw("team_stats").count() == df.count()


def test_loading_again_compares_keys_alone(spark, league, monkeypatch):
    space = Workspace(spark, league)
    store = space.warehouse("fact_game", "fact_game_player_stats")
    monkeypatch.setattr(delta, "least_per_key", None)
    raw = {"player_stats": space.raw("player_stats")}
    before = store.read("fact_game_player_stats").count()
    monkeypatch.setattr(store, "append", None)
    assert store.append_new("fact_game_player_stats", star.batch("fact_game_player_stats", raw), star.lead_keys("fact_game_player_stats", raw)) == 0
    assert store.read("fact_game_player_stats").count() == before > 100


def test_sums_of_few_dates_leave_other_box_scores_in_place(spark, league, plan, monkeypatch):
    space = Workspace(spark, league)
    tables = {t: space.star[t] for t in ("fact_game", "fact_game_team_stats")}
    dates = tables["fact_game"].select("date").distinct().orderBy("date").limit(5).checkpoint()
    few = rollup.computed(tables, "team_days", dates)
    monkeypatch.setattr(delta, "SENT_KEYS", 2)
    many = rollup.computed(tables, "team_days", dates)
    whole = rollup.computed(tables, "team_days").join(dates, "date", "left_semi").select(few.columns)
    assert sorted(few.collect()) == sorted(many.collect()) == sorted(whole.collect()) != []
    assert "_bits" in many._jdf.queryExecution().toString()
    assert "SortMergeJoin" not in plan(few)


def test_unreadable_messages_are_written_by_several_tasks(spark, tmp_path):
    bad = spark.range(40_000).selectExpr(
        "concat('{not json ', sha2(string(id), 512)) AS value", "TIMESTAMP_NTZ'2024-01-01 10:00:00' AS timestamp")
    bad.write.parquet(f"{tmp_path}/topic")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "256k")
    try:
        live_stream.quarantining_stream(
            live_stream.file_messages(spark, f"{tmp_path}/topic"), f"{tmp_path}/out", f"{tmp_path}/bad",
            f"{tmp_path}/checkpoint", live_stream.CATCH_UP).awaitTermination()
    finally:
        spark.conf.set(size, before)
    kept = live_stream.read_quarantine(spark, f"{tmp_path}/bad")
    assert kept.count() == 40_000 and len(kept.inputFiles()) > 1
    assert kept.select("value").exceptAll(bad.select("value")).isEmpty()
