import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from courtlake.operators import delta, quality
from courtlake.plans import star
from courtlake.plans.rollup import ROLLUPS
from courtlake.schemas import RAW, STAR
from courtlake.sources import landing
from courtlake.sources.warehouse import Warehouse, list_tables

D = dt.date


def raw_row(schema, **values):
    return tuple(values.get(f.name) for f in schema)


@pytest.fixture
def raw(spark, tmp_path):
    """Three games over two partitions; the daily partition repeats a game of the other."""
    root = str(tmp_path / "raw")
    g, p, t = [], [], []
    for game, day, part in [("0021900001", "2019-11-01", "2019-10-01"),
                            ("0021900002", "2019-11-02", "2019-10-01"),
                            ("0021900002", "2019-11-02", "2019-11-02"),
                            ("0021900003", "2019-11-02", "2019-11-02")]:
        part = D.fromisoformat(part)
        for team, match, pts in [(1, "A vs. B", 100.0), (2, "B @ A", 90.0)]:
            base = {"GAME_ID": game, "TEAM_ID": team, "TEAM_NAME": f"Team {team}",
                    "TEAM_ABBREVIATION": "AB"[team - 1], "PTS": pts}
            g.append((*raw_row(RAW["games"], SEASON_ID="22019", GAME_DATE=day, MATCHUP=match,
                               **base), part))
            t.append((*raw_row(RAW["team_stats"], FG_PCT=0.5, **base), part))
            p.append((*raw_row(RAW["player_stats"], PLAYER_ID=team * 10, PLAYER_NAME="P",
                               START_POSITION="G", **base), part))
    for name, entries in (("games", g), ("team_stats", t), ("player_stats", p)):
        ddl = RAW[name].simpleString()[7:-1] + ", date date"
        landing.land(spark.createDataFrame(entries, ddl), root, name)
    return root


def counts(store):
    return {t: store.read(t).count() for t in STAR}


WHOLE = {"dim_team": 2, "dim_player": 2, "dim_date": 2, "fact_game": 3,
         "fact_game_team_stats": 6, "fact_game_player_stats": 6}


def test_load_is_idempotent_and_unique(spark, raw, tmp_path):
    store = Warehouse(spark, str(tmp_path / "star"))
    assert star.load_star(star.scan_raw(spark, raw), store) == WHOLE
    assert counts(store) == WHOLE
    assert set(star.load_star(star.scan_raw(spark, raw), store).values()) == {0}
    assert counts(store) == WHOLE


def test_daily_loads_reach_the_same_star(spark, raw, tmp_path):
    store = Warehouse(spark, str(tmp_path / "star"))
    star.load_day(spark, raw, store, D(2019, 10, 1))
    added = star.load_day(spark, raw, store, D(2019, 11, 2))
    assert added["fact_game"] == 1 and added["fact_game_player_stats"] == 2
    assert counts(store) == WHOLE


def test_partly_loaded_game_is_completed(spark, raw, tmp_path):
    store = Warehouse(spark, str(tmp_path / "star"))
    whole = star.build_table("fact_game_team_stats", star.scan_raw(spark, raw))
    store.append("fact_game_team_stats", whole.where("team_id = 1 AND game_id LIKE '%1'"))
    assert star.load_star(star.scan_raw(spark, raw), store)["fact_game_team_stats"] == 5


def test_rows_without_a_key_are_left_out_and_reported(spark, rows, tmp_path):
    store = Warehouse(spark, str(tmp_path / "star"))
    g = [raw_row(RAW["games"], GAME_ID="g", SEASON_ID=s, GAME_DATE=d, TEAM_ID=t, TEAM_NAME="n",
                 TEAM_ABBREVIATION="A") for s, d, t in
         [("22019", "2019-11-01", None), ("22019", "oops", 1), ("92019", "2019-11-02", 1)]]
    raw = {n: spark.createDataFrame(g if n == "games" else [], RAW[n]) for n in RAW}
    first = star.load_star(raw, store)
    assert first["dim_team"] == 1 and first["dim_date"] == 2  # season kind 9 has no name
    for _ in range(2):
        assert set(star.load_star(raw, store).values()) == {0}
    assert rows(quality.unkeyed_rows(raw)) == [
        ("games", "GAME_DATE", 1), ("games", "TEAM_ID", 1), ("player_stats", "PLAYER_ID", 0)]


def test_late_season_type_of_a_known_date_is_added(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "star"))
    ddl = "date date, season string, season_type string"
    pre = spark.createDataFrame([(D(2019, 10, 5), "2019-20", "Pre-Season")], ddl)
    both = pre.union(spark.createDataFrame([(D(2019, 10, 5), "2019-20", "Regular Season")], ddl))
    assert [store.append_new("dim_date", df) for df in (pre, both, both)] == [1, 1, 0]


def test_new_position_of_a_known_player_is_not_added(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "star"))
    ddl = "player_id bigint, name string, position string, height string, weight int"
    store.append_new("dim_player", spark.createDataFrame([(1, "A", "G", None, None)], ddl))
    more = spark.createDataFrame([(1, "A", "F", None, None), (2, "B", "C", None, None)], ddl)
    assert store.append_new("dim_player", more) == 1


def test_unreadable_table_is_an_error_not_a_reload(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "star"))
    assert not store.exists("dim_team")
    bad = tmp_path / "star" / "dim_team"
    bad.mkdir(parents=True)
    (bad / "part-0.parquet").write_bytes(b"not parquet")
    ddl = STAR["dim_team"].schema.simpleString()[7:-1]
    with pytest.raises(Exception, match="(?i)parquet"):
        store.append_new("dim_team", spark.createDataFrame([(1, "A", "x", None, None, None)], ddl))


def test_anti_join_matches_null_with_null(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    held = spark.createDataFrame([(2,), (None,)], "k int")
    assert rows(delta.new_rows(df, held, ["k"])) == [(1, "a")]
    assert rows(delta.new_rows(df, held, ["k"], df.select("k"))) == [(1, "a"), (None, "c")]
    none = df.where("k > 5")
    assert delta.new_rows(none, held, ["k"], none.select("k")).isEmpty()


def test_one_row_per_key(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "a", 4), (1, "b", 9), (None, "a", 2), (None, "a", 1), (3, "c", None),
         (3, "c", 0)], "k int, j string, v int",
    )
    assert rows(delta.one_row_per_key(df, ["k", "j"])) == [
        (1, "a", 4), (1, "b", 9), (3, "c", None), (None, "a", 1),
    ]


def test_clean_batch_is_not_shuffled(spark, plan):
    df = spark.range(100).selectExpr("id AS k", "id AS v")
    assert "Exchange" not in plan(delta.one_row_per_key(df, ["k"]))


def test_hot_key_keeps_every_other_row(spark):
    df = spark.range(30_000).selectExpr(
        "IF(id % 3 = 0, -1, id) AS k", "id AS v", "CAST(id AS string) AS t"
    )
    out = delta.one_row_per_key(df, ["k"])
    assert out.count() == 20_001 and out.where("k = -1").first().v == 0


def test_bounds_reach_the_scan(spark, raw, tmp_path, plan):
    store = Warehouse(spark, str(tmp_path / "star"))
    star.load_star(star.scan_raw(spark, raw), store)
    day = star.day_delta(spark, raw, store.read("fact_game"), "fact_game", D(2019, 11, 2))
    text = plan(day)
    assert "LeftAnti" in text and "PartitionFilters: [isnotnull(date" in text
    assert "game_id" in text.split("LeftAnti")[1] and "Subquery" in text.split("LeftAnti")[1]


def test_day_delta_reads_only_the_table_it_needs(spark, tmp_path):
    root = str(tmp_path / "raw")
    day = D(2019, 11, 1)
    rows = [(*raw_row(RAW["games"], GAME_ID="g", GAME_DATE="2019-11-01", TEAM_ID=t, MATCHUP=m,
                      PTS=1.0), day) for t, m in ((1, "A vs. B"), (2, "B @ A"))]
    ddl = RAW["games"].simpleString()[7:-1] + ", date date"
    landing.land(spark.createDataFrame(rows, ddl), root, "games")
    empty = spark.createDataFrame([], STAR["fact_game"].schema)
    assert star.day_delta(spark, root, empty, "fact_game", day).count() == 1
    assert star.day_delta(spark, root, empty, "fact_game", D(2020, 1, 1)).count() == 0


def test_catalog_tables_and_bound_parameters(spark, raw, tmp_path):
    store = Warehouse(spark, str(tmp_path / "star"))
    star.load_star(star.scan_raw(spark, raw), store)
    try:
        store.create_tables()
        store.create_tables()
        names = {r.tableName for r in list_tables(spark, "*live*|dim*").collect()}
        assert names == {"live_data", "dim_team", "dim_player", "dim_date"}
        found = store.query(
            "SELECT GAME_ID, HOME_SCORE AS Score FROM fact_game WHERE date >= :day AND game_id = :id",
            {"day": D(2019, 11, 2), "id": "0021900003' OR '1'='1"},
        )
        assert found.columns == ["game_id", "score"] and found.count() == 0
    finally:
        spark.sql("DROP VIEW IF EXISTS live_data")
        for t in (*STAR, *ROLLUPS):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_columns_bind_by_name(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "star"))
    df = spark.createDataFrame(
        [(20, 10, D(2020, 1, 1), "g", 2, 1)],
        "away_score bigint, home_score bigint, date date, game_id string, away_team_id bigint, "
        "home_team_id bigint",
    )
    assert store.append("fact_game", df) == 1
    row = store.read("fact_game").first()
    assert (row.home_score, row.away_score, row.home_team_id) == (10, 20, 1)
    with pytest.raises(AnalysisException):
        store.append("fact_game", df.drop("date"))


def test_stored_files_are_sorted_for_page_skipping(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "star"))
    schema = STAR["fact_game_team_stats"].schema
    df = spark.range(1000).select(
        F.lpad(F.col("id").cast("string"), 10, "0").alias("game_id"),
        (F.col("id") * 7 % 30).alias("team_id"),
        *[F.lit(1).cast(f.dataType).alias(f.name) for f in schema.fields[2:]],
    )
    store.append("fact_game_team_stats", df.coalesce(1))
    ids = [r.team_id for r in store.read("fact_game_team_stats").select("team_id").collect()]
    assert ids == sorted(ids)
