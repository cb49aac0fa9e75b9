"""The warehouse: one Parquet folder per published table, bound by name, open to SQL."""

from __future__ import annotations

import posixpath
import uuid
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from courtlake.functions.league import season_start
from courtlake.operators.delta import absent_keys, marked, new_rows, one_row_per_key, rows_of
from courtlake.operators.live import write_live
from courtlake.operators.pruning import within_span
from courtlake.session import shared_dir
from courtlake.sources import live_store
from courtlake.schemas import APPEND_STREAM, CHUNK, LIVE_TABLE, NO_SEASON, SEASON_FOLDER, STAR, Table

TABLES: dict[str, Table] = {**STAR, "live_data": LIVE_TABLE}


class Warehouse:
    """Published tables under one root folder.

    Dimensions are read back as stored files, so Spark knows their size and decides from
    it whether a join may broadcast them.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return posixpath.join(self.root, table)

    def exists(self, table: str) -> bool:
        """Whether the table has been written; any failure but a missing folder is raised."""
        try:
            self.read(table)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    def create_tables(self, database: str | None = None) -> None:
        """Declare every table in the catalog, if absent, over its folder.

        Seasons are the catalog's partitions of facts; called again, it makes new ones known. The
        live table is a view of the folder: the days are found when it is read, and no micro-batch
        leaves a partition in the catalog.
        """
        prefix = f"`{database}`." if database else ""
        if database:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}'")
        for name, table in TABLES.items():
            if table is LIVE_TABLE:
                self._declare_live(prefix + f"`{name}`")
                continue
            columns = ", ".join(
                f"`{f.name}` {f.dataType.simpleString()}" for f in table.stored
            )
            folders = f"PARTITIONED BY ({', '.join(table.partition_by)})" if table.partition_by else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {prefix}`{name}` ({columns}) "
                f"USING parquet {folders} LOCATION '{self.path(name)}'"
            )
            if folders and self.exists(name):
                self.spark.catalog.recoverPartitions(f"{prefix}`{name}`")

    def _declare_live(self, name: str) -> None:
        """A view that reads packed files and the batches since, as ``live_store.read`` does.

        Declared again after the first rows, or the first compaction, it reads those too.
        """
        path, names = self.path("live_data"), ", ".join(f"`{c}`" for c in LIVE_TABLE.schema.names)
        rows = f"SELECT {names} FROM parquet.`{path}`"
        if not self.exists("live_data"):
            empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in LIVE_TABLE.schema)
            rows = f"SELECT {empty} WHERE FALSE"
        elif live_store.log(self.spark, path) is not None:
            last = f"SELECT * FROM parquet.`{path}.log` WHERE made = (SELECT max(made) FROM parquet.`{path}.log`)"
            rows = (
                f"WITH known AS ({last}) "
                f"SELECT {names} FROM parquet.`{path}` b WHERE NOT EXISTS (SELECT 1 FROM known k "
                f"WHERE k.day = b.day AND k.stream = b.stream AND b.batch_id <= k.upto) "
                f"UNION ALL SELECT {names} FROM parquet.`{path}.packed` p WHERE EXISTS (SELECT 1 FROM known k "
                f"WHERE k.day = p.day AND k.generation = p.generation)")
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {rows}")

    def read(self, table: str) -> DataFrame:
        """The published columns."""
        return self.stored(table).select(TABLES[table].schema.names)

    def stored(self, table: str) -> DataFrame:
        """The table with its folder columns, which joins and filters prune folders by."""
        if TABLES[table] is LIVE_TABLE:
            return live_store.read(self.spark, self.path(table))
        return self.spark.read.schema(TABLES[table].stored).parquet(self.path(table))

    def append(self, table: str, df: DataFrame, lead_keys: DataFrame | None = None) -> int:
        """Append rows, columns matched by name; returns the number written.

        The count is observed during the write, so the plan runs once. Live rows go where the
        streams write theirs, under a stream name of this append alone. Facts go to the folder of
        their season: the rebalance hint gathers each into few files and splits a heavy one. Box
        scores that carry their landing partition (``CHUNK``) are gathered already, see ``_in_season``.
        """
        spec = TABLES[table]
        seen = Observation()
        names = [c for c in spec.schema.names if c not in spec.partition_by]
        count = F.count(F.lit(1)).alias("rows")
        if spec is LIVE_TABLE:
            rows = df.select(names).observe(seen, count)
            write_live(rows, self.path(table), f"{APPEND_STREAM}{uuid.uuid4().hex}", 0)
            return seen.get["rows"]
        folders = list(spec.partition_by)
        rows = df.select(names + [CHUNK] if CHUNK in df.columns else names)
        if folders and CHUNK in rows.columns and lead_keys is not None and CHUNK in lead_keys.columns:
            rows = self._by_chunk(rows, lead_keys)
        elif folders:
            rows = self._in_season(table, rows.drop(CHUNK), lead_keys).hint("rebalance", *folders)
        rows = rows.observe(seen, count)
        if spec.sort_by:
            rows = rows.sortWithinPartitions(*folders, *spec.sort_by)
        rows.write.mode("append").partitionBy(*folders).parquet(self.path(table))
        return seen.get["rows"]

    def _in_season(self, table: str, rows: DataFrame, lead_keys: DataFrame | None) -> DataFrame:
        """Rows with the folder of their season: by the game's date, or by the stored game's folder.

        A row that comes before its game goes to the folder of no season, which every
        season's question reads too.
        """
        if "date" in rows.columns:
            return rows.withColumn(SEASON_FOLDER, F.coalesce(season_start(F.col("date")), F.lit(NO_SEASON)))
        if not self.exists("fact_game"):
            return rows.withColumn(SEASON_FOLDER, F.lit(NO_SEASON))
        games = self.stored("fact_game").select(F.col("game_id").alias("_game"), SEASON_FOLDER)
        if lead_keys is not None:
            games = within_span(games, "_game", lead_keys)
        found = rows.join(games, rows["game_id"] == games["_game"], "left").drop("_game")
        return found.withColumn(SEASON_FOLDER, F.coalesce(SEASON_FOLDER, F.lit(NO_SEASON)))

    def _by_chunk(self, rows: DataFrame, lead_keys: DataFrame) -> DataFrame:
        """Box scores with the folder of their season, most of them where they were read.

        A first job learns from the two key columns alone which season most games of a landing
        partition have, and which games have another, or are not stored. Rows of the others'
        games, told by a bitmap, meet their game; the rest takes the partition's season unshuffled.
        """
        if not self.exists("fact_game"):
            return rows.withColumn(SEASON_FOLDER, F.lit(NO_SEASON)).drop(CHUNK)
        shared_dir(self.spark)
        games = self.stored("fact_game").select(F.col("game_id").alias("_game"), SEASON_FOLDER)
        games = within_span(games, "_game", lead_keys)
        season = F.coalesce(SEASON_FOLDER, F.lit(NO_SEASON))
        listed = lead_keys.toDF("game_id", "_of").distinct().join(
            games, F.col("game_id") == F.col("_game"), "left").select("game_id", "_of", season.alias("_season"))
        # As many rows as there are landing partitions.
        most = F.broadcast(listed.groupBy("_of", "_season").agg(F.count(F.lit(1)).alias("_games")).groupBy("_of").agg(
            F.max(F.struct("_games", "_season")).alias("_most")).select(
            F.col("_of").alias("_chunk_of"), F.col("_most._season").alias("_usual")).checkpoint())
        others = listed.join(most, F.col("_of").eqNullSafe(F.col("_chunk_of"))).where(
            "_season <> _usual").select("game_id").distinct().checkpoint()
        placed = rows.join(most, F.col(CHUNK).eqNullSafe(F.col("_chunk_of"))).drop("_chunk_of", CHUNK)
        number = others.count()
        if not number:
            return placed.withColumnRenamed("_usual", SEASON_FOLDER)
        known = marked(placed, others, ["game_id"], number)
        usual = known.where("NOT _hit").withColumnRenamed("_usual", SEASON_FOLDER).drop("_hit")
        met = known.where("_hit").drop("_hit", "_usual").join(games, F.col("game_id") == F.col("_game"), "left")
        return usual.unionByName(met.drop("_game").withColumn(SEASON_FOLDER, season))

    def append_new(self, table: str, df: DataFrame, lead_keys: DataFrame | None = None) -> int:
        """Append only rows whose key the table does not hold; loading twice adds nothing.

        ``lead_keys`` as in :func:`~courtlake.operators.delta.new_rows`. Of facts the keys alone
        are compared first, so that rows that are held are not shuffled.
        """
        spec = TABLES[table]
        if SEASON_FOLDER in spec.partition_by and self.exists(table) and spec.unique_on in ((), spec.match_on):
            absent = absent_keys(df, self.read(table), spec.match_on, lead_keys)
            number = absent.count()
            if not number:
                return 0
            rows = rows_of(df, absent, spec.match_on, number)
            return self.append(table, one_row_per_key(rows, spec.unique_on) if spec.unique_on else rows, lead_keys)
        rows = one_row_per_key(df, spec.unique_on) if spec.unique_on else df
        if self.exists(table):
            rows = new_rows(rows, self.read(table), spec.match_on, lead_keys)
        return self.append(table, rows, lead_keys)

    def register_views(self, *tables: str) -> None:
        for table in tables or TABLES:
            self.read(table).createOrReplaceTempView(table)

    def query(self, sql: str, args: dict[str, Any] | None = None) -> DataFrame:
        """Run SQL with named parameters (``:name``); result columns in lower case."""
        return lower_names(self.spark.sql(sql, args=args or {}))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def list_tables(
    spark: SparkSession, pattern: str = "*", database: str | None = None
) -> DataFrame:
    where = f"IN `{database}` " if database else ""
    return spark.sql(f"SHOW TABLES {where}LIKE :pattern", args={"pattern": pattern})
