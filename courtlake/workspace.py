"""Landed and published tables for one set of test tables, written when first needed.

The way the engine is meant to be used: raw tables are landed once, the star schema is
built from them once, and questions read the stored star. Tables go to the shared folder
that ``spark.checkpoint.dir`` names, so they outlive lost executors. A table is written
again when the files it comes from have changed.
"""

from __future__ import annotations

import datetime as dt
import posixpath
import threading
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake import fixtures
from courtlake.fixed_values import STATS
from courtlake.operators.star_tables import BUILDERS
from courtlake.plans import rollup
from courtlake.plans.star import batch, lead_keys
from courtlake.schemas import STAR
from courtlake.session import shared_dir
from courtlake.sources import landing
from courtlake.sources.warehouse import Warehouse

_LOCK = threading.RLock()
_WORKSPACES: dict[tuple[str, str], Workspace] = {}


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = posixpath.join(shared_dir(spark), f"courtlake-{uuid.uuid4().hex}")
        self._written: dict[str, tuple] = {}
        self._marks: dict[tuple[str, ...], tuple] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Workspace:
        key = (spark.sparkContext.applicationId, sf_dir)
        with _LOCK:
            if key not in _WORKSPACES:
                _WORKSPACES[key] = cls(spark, sf_dir)
            found = _WORKSPACES[key]
            found.spark = spark
            found._marks.clear()
            return found

    @property
    def database(self) -> str:
        """The catalog's name for this workspace's tables, one for each state of their sources."""
        roots = self._root_for(*self._RAW_FROM)
        return f"courtlake_{posixpath.basename(roots)}"

    def new_path(self, name: str) -> str:
        return posixpath.join(self.root, name, uuid.uuid4().hex)

    def _fingerprint(self, *names: str) -> tuple:
        """Number, size and age of the source files: a listing, no file is opened.

        Taken once for each time the workspace is asked for.
        """
        if names not in self._marks:
            paths = [posixpath.join(self.sf_dir, f"{n}.parquet") for n in names]
            files = self.spark.read.format("binaryFile").load(paths)
            newest = F.max("modificationTime").cast("string")
            self._marks[names] = tuple(
                files.agg(F.count(F.lit(1)), F.sum("length"), newest).first()
            )
        return self._marks[names]

    def _root_for(self, *sources: str) -> str:
        """The folder for tables derived from these sources, in their present state."""
        mark = self._fingerprint(*sources)
        name = "_".join(sources)
        with _LOCK:
            if self._written.get(name, (None,))[0] != mark:
                self._written[name] = (mark, posixpath.join(self.root, uuid.uuid4().hex), set())
            return self._written[name][1]

    def _once(self, sources: tuple[str, ...], name: str, write) -> str:
        with _LOCK:
            root = self._root_for(*sources)
            done = self._written["_".join(sources)][2]
            if name not in done:
                write(root)
                done.add(name)
            return root

    # ── Raw tables ──

    _RAW_FROM = ("lineitem", "orders", "supplier")

    def landing_root(self, name: str) -> str:
        def write(root: str) -> None:
            landing.land(
                fixtures.RAW_SOURCES[name](self.spark, self.sf_dir),
                posixpath.join(root, "raw"), name, name in fixtures.GATHERED,
            )

        return posixpath.join(self._once(self._RAW_FROM, f"raw/{name}", write), "raw")

    def drifting_root(self) -> str:
        """Team statistics landed as DOUBLE before 1998 and as BIGINT from then on."""

        def write(root: str) -> None:
            rows, path = self.raw("team_stats"), posixpath.join(root, "drift")
            early = F.col("date") < F.lit(dt.date(1998, 1, 1))
            whole = {c: F.col(c).cast("bigint") for c in (*STATS, "PLUS_MINUS")}
            landing.land(rows.where(early), path, "team_stats")
            landing.land(rows.where(~early).withColumns(whole), path, "team_stats")

        return posixpath.join(self._once(self._RAW_FROM, "drift", write), "drift")

    def yearly_root(self) -> str:
        """Games landed in chunks of twelve months, those of one day in a daily folder."""

        def write(root: str) -> None:
            days = landing.chunk_days(landing.chunk_plan(fixtures.span(self.spark, self.sf_dir), 12))
            games = self.raw("games").drop("date").withColumn("day", F.col("GAME_DATE").cast("date"))
            own = F.lit(dt.date(1997, 5, 20))
            placed = games.join(days, "day").withColumn(
                "date", F.when(F.col("day") == own, own).otherwise(F.col("date"))).drop("day")
            landing.land(placed, posixpath.join(root, "yearly"), "games")

        return posixpath.join(self._once(self._RAW_FROM, "yearly", write), "yearly")

    def raw(self, name: str) -> DataFrame:
        return landing.scan(self.spark, self.landing_root(name), name)

    # ── Star schema ──

    def warehouse(self, *names: str) -> Warehouse:
        """A warehouse that holds at least the named tables, as ``load_star`` first writes them."""
        root = self._root_for(*self._RAW_FROM)
        store = Warehouse(self.spark, posixpath.join(root, "star"))
        for name in names or STAR:
            if name in rollup.ROLLUPS:
                # Sums of the box scores of teams need none of the players', and the other way round.
                self.warehouse("fact_game", rollup.SOURCE[name])
                self._once(self._RAW_FROM, f"star/{name}",
                           lambda _, name=name: rollup.build_rollups(store, (name,)))
                continue
            if name.startswith("fact_game_"):
                self.warehouse("fact_game")
            source, _ = BUILDERS[name]

            def write(_: str, name: str = name, source: str = source) -> None:
                raw = {source: self.raw(source)}
                store.append_new(name, batch(name, raw), lead_keys(name, raw))

            self._once(self._RAW_FROM, f"star/{name}", write)
        return store

    def live(self) -> DataFrame:
        """The stored LIVE_DATA table."""
        return self._live_store().read("live_data")

    def _live_store(self) -> Warehouse:
        store = Warehouse(self.spark, posixpath.join(self._root_for("events"), "published"))

        def write(_: str) -> None:
            store.append("live_data", fixtures.live(self.spark, self.sf_dir))

        self._once(("events",), "published", write)
        return store

    @property
    def star(self) -> Mapping[str, DataFrame]:
        return _LazyStar(self)

    # ── Live messages ──

    def messages_path(self, kind: str) -> str:
        def write(root: str) -> None:
            source = {"live": fixtures.live_messages, "board": fixtures.scoreboards}[kind]
            rows = source(self.spark, self.sf_dir)
            rows.write.mode("overwrite").option("maxRecordsPerFile", 1_000_000).parquet(
                posixpath.join(root, kind)
            )

        return posixpath.join(self._once(("events",), kind, write), kind)


class _LazyStar(Mapping[str, DataFrame]):
    """The star tables by name; only those looked up are built."""

    def __init__(self, workspace: Workspace):
        self._workspace = workspace

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self:
            raise KeyError(name)
        return self._workspace.warehouse(name).stored(name)

    def __contains__(self, name: object) -> bool:
        return name in STAR or name in rollup.ROLLUPS

    def __iter__(self) -> Iterator[str]:
        return iter((*STAR, *rollup.ROLLUPS))

    def __len__(self) -> int:
        return len(STAR) + len(rollup.ROLLUPS)
