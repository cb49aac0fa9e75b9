"""Near-duplicate vectors: all pairs above a cosine, by dual traversal of cover trees.

Unit vectors with a cosine of at least c are at most sqrt(2 - 2c) apart. Equal vectors are one
class and compared once. Classes go to the cell of the nearest of a few pivots, cells are cut
into blocks of bounded size, and every block gets a cover tree of its own: nested levels of
centres with halving radii, each centre with the distance of the farthest class below it. Two
blocks, and inside them two nodes, are dropped together if their centres are farther apart than
the limit and both covering radii; what is left goes down a level, and the classes at the bottom
are compared exactly, in double precision (near the limit in extended precision).

Pairs of blocks are compared in tiles: the blocks of a dimension are cut into groups, and the task
of a tile holds one group's blocks while the other group's pass by. A block is thus sent once per
group in which some block is near enough, not once per pair.

A tile returns every class's number of links and a spanning forest of the links, in
proportion to the classes, however many links a group has. Components are those of the forest.

The pivots are a bounded sample and only decide who is compared early; the pairs are all pairs.
Vectors that are null, empty, zero or hold null or non-finite components link with nothing. Only
vectors of one dimension can link. Every row is a vector: repeated rows link with each other,
and rows that share a vec_id but not the vector stay apart. Ties go to the smaller vec_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from courtlake.llm.common import components, hashed_sample, pick, stored

COSINE = 0.9
#: Most pivots (a sample), classes per pivot, most classes in a block.
PIVOTS, PER_PIVOT, BLOCK_ROWS = 256, 2048, 2560
RADII = (1.0, 0.5, 0.25, 0.125)
#: Vectors that a task holds, and most partitions of tiles; smaller tables have about three tiles per core.
HELD_BYTES, TILE_PARTS = 32 << 20, 4096
#: All pairs of classes are multiplied if at least one of so many is a candidate, else these alone, so many at once.
DENSE, DENSE_ROWS = 32, 1 << 14
#: Links of a tile that are kept before they become a forest, rows of a batch of results.
KEPT_LINKS, FOUND_ROWS = 1 << 20, 1 << 16
NO_ID = -(2**63)
SLACK = 1e-9
#: Nodes are compared in single precision, with this much more room.
COARSE = 1e-4


def units_of(flat: np.ndarray, dim: int) -> np.ndarray:
    rows = flat.reshape(-1, dim)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True).astype(np.float64)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


class Tree:
    """Levels of centres (places in ``units``), their parents a level up and covering radii."""

    def __init__(self, units: np.ndarray):
        n = len(units)
        self.units = units
        nearest = np.full(n, np.inf)
        centre = np.empty(0, np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        owner = np.zeros(n, np.int64)
        for radius in RADII:
            added = []
            while True:
                i = int(nearest.argmax())
                if nearest[i] <= radius:
                    break
                added.append(i)
                apart = np.sqrt(np.maximum(2 - 2 * (units @ units[i]), 0))
                apart[i] = 0.0
                nearest = np.minimum(nearest, apart)
            before = len(centre)
            centre = np.concatenate([centre, np.array(added, np.int64)])
            parent = owner[centre] if before else np.zeros(len(centre), np.int64)
            # Points stay below the node that their centre belongs to: nearest among its children.
            dots = units @ units[centre].T
            if before:
                dots = np.where(parent[None, :] == owner[:, None], dots, -np.inf)
            owner = dots.argmax(axis=1)
            owner[centre] = np.arange(len(centre))
            apart = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", units, units[centre[owner]]), 0))
            reach = np.zeros(len(centre))
            np.maximum.at(reach, owner, apart)
            reach[np.bincount(owner, minlength=len(centre)) == 1] = 0.0
            self.levels.append((centre, parent, reach))
        self.levels.append((np.arange(n), owner, np.zeros(n)))
        self.coarse = units.astype(np.float32)

    def columns(self) -> dict[str, pa.Array]:
        """The tree as one row, see ``Block``; places and radii in 32 bits, radii rounded up."""
        reach = np.concatenate([level[2] for level in self.levels[:-1]])
        parts = {
            "centres": np.concatenate([level[0] for level in self.levels[:-1]]).astype(np.int32),
            "parents": np.concatenate([level[1] for level in self.levels]).astype(np.int32),
            "reaches": np.where(reach > 0, np.nextafter(reach.astype(np.float32), np.float32(np.inf)), np.float32(0)),
        }
        sizes = pa.array([[len(level[0]) for level in self.levels]], pa.list_(pa.int32()))
        return {"sizes": sizes, **{name: pa.array([x.tobytes()], pa.binary()) for name, x in parts.items()}}


class Block:
    """A stored block: a tree with only single-precision units, exact ones are made when asked for."""

    def __init__(self, row: dict):
        n = row["sizes"][-1]
        self.ids, self.highs, self.copies = (np.frombuffer(row[name], np.int64) for name in ("ids", "highs", "copies"))
        self.raw = np.frombuffer(row["raw"], f"f{len(row['raw']) // (n * row['dim'])}").reshape(n, -1)
        self.coarse = units_of(self.raw, row["dim"]).astype(np.float32)
        cuts = np.cumsum(row["sizes"])[:-1]
        centres = [*np.split(np.frombuffer(row["centres"], np.int32), cuts[:-1]), np.arange(n)]
        reaches = [*np.split(np.frombuffer(row["reaches"], np.float32), cuts[:-1]), np.zeros(n, np.float32)]
        parents = np.split(np.frombuffer(row["parents"], np.int32), cuts)
        self.levels = list(zip(centres, parents, reaches))
        self.middle, self.reach = np.array(row["middle"]), row["reach"]
        self.links = np.zeros(n, np.int64)

    def exact(self, rows: np.ndarray) -> np.ndarray:
        return units_of(self.raw[rows], self.raw.shape[1])

    def done(self) -> None:
        """Compared with all blocks that come: only ids and links are still needed."""
        self.raw = self.coarse = self.levels = None


def links_between(a: Block, b: Block, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with a cosine of at least ``cosine`` between classes of two blocks."""
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    _descend(a, b, np.arange(len(a.levels[0][0])), np.arange(len(b.levels[0][0])), None, 0, np.sqrt(2 - 2 * cosine), hits)
    i, j = (np.concatenate(x) for x in zip(*hits))
    if not len(i):
        return i, j
    (some_a, at_a), (some_b, at_b) = _places(i, len(a.ids)), _places(j, len(b.ids))
    exact_a, exact_b = a.exact(some_a), b.exact(some_b)
    if len(some_a) * len(some_b) <= DENSE * len(i):
        value = (exact_a @ exact_b.T)[at_a, at_b]
    else:
        value = np.concatenate([np.einsum("ij,ij->i", exact_a[at_a[k : k + DENSE_ROWS]], exact_b[at_b[k : k + DENSE_ROWS]])
                                for k in range(0, len(i), DENSE_ROWS)])
    for at in np.flatnonzero(np.abs(value - cosine) <= SLACK):
        x, y = exact_a[at_a[at]].astype(np.longdouble), exact_b[at_b[at]].astype(np.longdouble)
        value[at] = 1.0 if (x @ y) >= cosine * np.sqrt((x @ x) * (y @ y)) else 0.0
    good = value >= cosine
    return i[good], j[good]


def _places(i: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of ``i``, all below n, and where each of ``i`` stands among them."""
    there = np.zeros(n, bool)
    there[i] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[i]


def _descend(a: Block, b: Block, rows: np.ndarray, columns: np.ndarray, open_: np.ndarray | None, depth: int,
             limit: float, hits: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Append classes (i, j) that may be near, below these nodes of a level.

    Nodes of one class have no radius: two of them that are near are classes to compare exactly.
    Pairs with a wider node go down a level, apart from the others: those nodes are few.
    """
    (ca, _, ra), (cb, _, rb) = a.levels[depth], b.levels[depth]
    ca, ra, cb, rb = ca[rows], ra[rows], cb[columns], rb[columns]
    dots = a.coarse[ca] @ b.coarse[cb].T
    near = dots >= 1 - (limit + COARSE) ** 2 / 2
    if open_ is not None:
        near &= open_
    i, j = np.divmod(np.flatnonzero(near), len(columns))
    plain = (ra[i] <= 0) & (rb[j] <= 0)
    hits.append((ca[i[plain]], cb[j[plain]]))
    wide_a, wide_b = np.flatnonzero(ra > 0), np.flatnonzero(rb > 0)
    for some_a, some_b in ((wide_a, np.arange(len(columns))), (np.flatnonzero(ra <= 0), wide_b)):
        if len(some_a) and len(some_b):
            reach = np.minimum(limit + ra[some_a][:, None] + rb[some_b][None, :] + np.float32(COARSE), np.float32(2))
            cut = np.ix_(some_a, some_b)
            near = dots[cut] >= 1 - reach * reach / 2
            if open_ is not None:
                near &= open_[cut]
            keep_a, keep_b = near.any(axis=1), near.any(axis=0)
            if keep_a.any():
                below_a, up_a = _below(a, depth, rows[some_a[keep_a]])
                below_b, up_b = _below(b, depth, columns[some_b[keep_b]])
                allowed = near[keep_a][:, keep_b][up_a][:, up_b]
                _descend(a, b, below_a, below_b, allowed, depth + 1, limit, hits)


def _below(block: Block, depth: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes a level below these, and for each the place of its parent among these."""
    place = np.full(len(block.levels[depth][0]), -1)
    place[nodes] = np.arange(len(nodes))
    parents = place[block.levels[depth + 1][1]]
    below = np.flatnonzero(parents >= 0)
    return below, parents[below]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star over every connected group of places 0..n-1: (member, its group's least place)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    member = np.flatnonzero(label != np.arange(n))
    return member, label[member]


def _vectors(embeddings: DataFrame) -> DataFrame:
    """Single precision stays as it is, half as wide in every shuffle; other numbers become doubles."""
    rows = pick(embeddings, "vec_id", "embedding")
    kind = "array<float>" if rows.schema["embedding"].dataType == ArrayType(FloatType()) else "array<double>"
    rows = rows.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.col("embedding").cast(kind).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    able = F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0.0)
    return rows.withColumn("able", F.coalesce(able, F.lit(False)))


def _marks(vector: str) -> list[Column]:
    """Two hashes and the dimension; zeros of either sign are alike."""
    return [F.xxhash64(vector).alias("high"), F.xxhash64(F.lit(1), vector).alias("low"), F.size(vector).alias("dim")]


def similar_vectors(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``embeddings``."""
    rows = _vectors(embeddings)
    marks = ["high", "low", "dim"]
    classes = stored(rows.where("able").groupBy("vector").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")).select(
        "id", *_marks("vector"), "vector", "copies"), "tree-classes")
    number, apart = classes.agg(F.count(F.lit(1)), F.count_distinct(*marks)).first()
    wanted = min(PIVOTS, max(1, number // PER_PIVOT))
    sample = hashed_sample(classes, F.xxhash64("high", "id"), wanted, "id", "high").collect()
    pivots: dict[int, np.ndarray] = {}
    for dim in {r["dim"] for r in sample}:
        pivots[dim] = units_of(np.array([r["vector"] for r in sample if r["dim"] == dim]).ravel(), dim)

    def cells_of(batch: pa.RecordBatch) -> pa.Array:
        dims = batch.column("dim").to_numpy()
        cell = np.zeros(batch.num_rows, np.int32)
        for dim in np.unique(dims).tolist():
            if dim in pivots:
                mine = np.flatnonzero(dims == dim)
                flat = batch.column("vector").take(pa.array(mine)).flatten().to_numpy(zero_copy_only=False)
                cell[mine] = np.argmax(units_of(flat, dim) @ pivots[dim].T, axis=1)
        return pa.array(cell)

    def name_cells(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("dim"), cells_of(batch)], ["dim", "cell"])

    def place(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, cells_of(batch)], [*batch.schema.names, "cell"])

    # A block is a part of a cell. Cells are found twice, as that stores no second copy of the vectors.
    cells = classes.select("dim", "vector").mapInArrow(name_cells, "dim int, cell int").groupBy("dim", "cell").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS * 0.8)).alias("parts"))
    held = classes.mapInArrow(place, f"{classes.schema.simpleString()[7:-1]}, cell int").join(
        cells, ["dim", "cell"], "left").withColumn(
        "part", F.pmod(F.xxhash64("high", "id", F.lit(3)), F.coalesce("parts", F.lit(1))))

    def grow(key: tuple, table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        units = units_of(flat, dim)
        middle = units.mean(axis=0)
        reach = float(np.sqrt(((units - middle) ** 2).sum(axis=1)).max())
        with np.errstate(over="ignore"):
            narrow = flat.astype(np.float32)
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "cell": pa.array([key[1].as_py()], pa.int32()),
            "part": pa.array([key[2].as_py()], pa.int64()),
            "ids": pa.array([table.column("id").to_numpy().tobytes()], pa.binary()),
            "highs": pa.array([table.column("high").to_numpy().tobytes()], pa.binary()),
            "copies": pa.array([table.column("copies").to_numpy().tobytes()], pa.binary()),
            "raw": pa.array([(narrow if (narrow == flat).all() else flat).tobytes()], pa.binary()),
            **Tree(units).columns(),
            "middle": pa.array([middle.tolist()], pa.list_(pa.float64())),
            "reach": pa.array([reach]),
        })

    block = ["dim", "cell", "part"]
    blocks = stored(held.groupBy(*block).applyInArrow(
        grow, "dim int, cell int, part long, ids binary, highs binary, copies binary, raw binary, "
              "sizes array<int>, centres binary, parents binary, reaches binary, middle array<double>, reach double"), "tree-blocks")
    tiles = stored(_tiles(blocks, cosine), "tree-tiles")
    parts = min(TILE_PARTS, max(1, tiles.select("dim", "a", "b").distinct().count()))
    sent = blocks.join(tiles, block).repartitionById(
        parts, F.pmod(F.pmod(F.xxhash64("dim"), F.lit(parts)) + F.col("tile"), F.lit(parts)).cast("int"))

    def compare(batches):
        tile = None
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["dim"], row["a"], row["b"])
                if tile is None or tile.key != key:
                    if tile is not None:
                        yield from tile.found()
                    tile = _Tile(key, cosine)
                tile.add(Block(row), row["passing"])
        if tile is not None:
            yield from tile.found()

    node = "struct<id:long,high:long>"
    found = stored(sent.sortWithinPartitions("dim", "a", "b", "passing").mapInArrow(
        compare, f"a {node}, b {node}, links long"), "tree-links")

    edges = found.where("b is not null").select("a", "b")
    degree = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    # Rows find their class by its hashes if no two classes share them, so that vectors are not shuffled again.
    keys = marks if apart == number else ["vector"]
    known = classes.select(*keys, F.struct("id", "high").alias("node"), "copies").join(
        degree, "node", "left").join(components(edges), "node", "left").select(
        *keys, F.coalesce("component", "node").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.where("able").select("id", "vector", *_marks("vector")).join(known, keys).select(
        "id", "n_links", F.col("component.id").alias("component_id")).unionByName(
        rows.where("not able").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    named = lambda c: F.when(F.col(c) != F.lit(NO_ID), F.col(c))
    return out.select(named("id").alias("vec_id"), "n_links", named("component_id").alias("component_id"),
                      (F.col("id") == F.col("component_id")).alias("kept"))


def _tiles(blocks: DataFrame, cosine: float) -> DataFrame:
    """dim, a, b, tile, cell, part, passing: which blocks the tile of groups a and b has to see.

    Groups have about the same number of bytes and consecutive cells. Blocks of group a are held,
    those of b pass. Node pairs at the top: a block comes if its ball is near that of a block of the
    other group; a group's own tile has all its blocks.
    """
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    own = Window.partitionBy("dim")
    before = F.sum("bytes").over(own.orderBy("cell", "part").rowsBetween(Window.unboundedPreceding, -1))
    groups = F.least(F.count(F.lit(1)).over(own), F.greatest(
        F.lit(int(np.ceil(np.sqrt(6 * cores)))), F.ceil(F.sum("bytes").over(own) / F.lit(HELD_BYTES))))
    top = blocks.select("dim", "cell", "part", "middle", "reach", F.length("raw").cast("long").alias("bytes")).select(
        "*", groups.alias("groups"), F.coalesce(before, F.lit(0)).alias("before"), F.sum("bytes").over(own).alias("all"))
    top = stored(top.select("dim", "cell", "part", "middle", "reach", "groups", F.least(
        F.col("groups") - 1, F.floor(F.col("before") / F.col("all") * F.col("groups"))).alias("group")), "tree-groups")
    others = top.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("other"))
    first = others.where("group < other").withColumnsRenamed({"group": "a", "other": "b"})
    second = others.where("other < group").withColumnsRenamed({"group": "b", "other": "a"})
    limit = float(np.sqrt(2 - 2 * cosine)) + SLACK

    def near(these: DataFrame, those: DataFrame) -> DataFrame:
        those = those.select(*[F.col(c).alias(f"{c}_") for c in ("dim", "a", "b", "middle", "reach")])
        square = F.aggregate(
            F.zip_with("middle", "middle_", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
        same = [F.col(c) == F.col(f"{c}_") for c in ("dim", "a", "b")]
        return these.join(
            those, [*same, F.sqrt(square) <= F.col("reach") + F.col("reach_") + F.lit(limit)], "left_semi")

    alone = top.withColumnsRenamed({"group": "a"}).withColumn("b", F.col("a"))
    columns = ["dim", "a", "b", "cell", "part", "groups"]
    seen = alone.select(*columns, F.lit(False).alias("passing")).unionByName(
        near(first, second).select(*columns, F.lit(False).alias("passing"))).unionByName(
        near(second, first).select(*columns, F.lit(True).alias("passing")))
    # Tiles are numbered row by row, so that those of a dimension fall on different partitions.
    return seen.withColumn("tile", F.col("a") * F.col("groups") - F.expr("a * (a + 1) div 2") + F.col("b")).drop("groups")


class _Tile:
    """The blocks of one tile, and the links found between them so far."""

    def __init__(self, key: tuple[int, int, int], cosine: float):
        self.key, self.cosine = key, cosine
        self.limit = np.sqrt(2 - 2 * cosine) + SLACK
        self.held: list[tuple[int, Block]] = []
        self.blocks: list[Block] = []
        self.number = 0
        self.first, self.second = np.empty(0, np.int64), np.empty(0, np.int64)
        self.more: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, block: Block, passing: bool) -> None:
        """Compare a block with those held; one of a group's own tile also with itself."""
        at = self.number
        self.blocks.append(block)
        self.number += len(block.ids)
        if not passing:
            self.held.append((at, block))
        if passing or self.key[1] == self.key[2]:
            for place, other in self.held:
                apart = np.sqrt(((other.middle - block.middle) ** 2).sum())
                if apart <= other.reach + block.reach + self.limit:
                    self._link(other, place, block, at)
        if passing:
            block.done()

    def _link(self, a: Block, at_a: int, b: Block, at_b: int) -> None:
        i, j = links_between(a, b, self.cosine)
        if a is b:
            i, j = i[i < j], j[i < j]
        if not len(i):
            return
        np.add.at(a.links, i, b.copies[j])
        np.add.at(b.links, j, a.copies[i])
        if a is b:
            first, second = _forest(len(a.ids), i, j)
        else:
            first, second = _forest(len(a.ids) + len(b.ids), i, j + len(a.ids))
        place = lambda x: np.where(x < len(a.ids), x + at_a, x - len(a.ids) + at_b)
        self.more.append((place(first), place(second)))
        self.waiting += len(first)
        if self.waiting >= KEPT_LINKS:
            self._join()

    def _join(self) -> None:
        self.first, self.second = _forest(
            self.number, *(np.concatenate([x, *y]) for x, y in zip((self.first, self.second), zip(*self.more))))
        self.more, self.waiting = [], 0

    def found(self) -> Iterator[pa.RecordBatch]:
        """(a, b) of the forest without links, (a, null) with the links of every class that has some."""
        if self.more:
            self._join()
        ids, highs, links = (np.concatenate([getattr(x, name) for x in self.blocks]) for name in ("ids", "highs", "links"))
        some = np.flatnonzero(links)
        first = np.concatenate([self.first, some])
        second = np.concatenate([self.second, np.zeros(len(some), np.int64)])
        none = np.concatenate([np.zeros(len(self.first), bool), np.ones(len(some), bool)])
        fields = ["id", "high"]
        whole = pa.RecordBatch.from_arrays([
            pa.StructArray.from_arrays([pa.array(ids[first]), pa.array(highs[first])], fields),
            pa.StructArray.from_arrays([pa.array(ids[second]), pa.array(highs[second])], fields, mask=pa.array(none)),
            pa.array(np.concatenate([np.zeros(len(self.first), np.int64), links[some]])),
        ], ["a", "b", "links"])
        for at in range(0, whole.num_rows, FOUND_ROWS):
            yield whole.slice(at, FOUND_ROWS)
