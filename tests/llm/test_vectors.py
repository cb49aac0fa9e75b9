"""Vector search and vector dedup against brute force, with odd rows among them."""

import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from courtlake.llm import cover_tree, vector_file

INF = float("inf")


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 8))
    near = base[:20] + rng.normal(size=(20, 8)) * 0.1
    rows = [(i, v.tolist(), "x", 1) for i, v in enumerate(np.vstack([base, near, base[:5]]))]
    rows += [(200, None, "x", 1), (201, [1.0, None] + [0.0] * 6, "x", 1), (202, [INF] * 8, "x", 1),
             (203, [0.0] * 8, "x", 1), (204, [1.0, 2.0], "x", 1), (205, [2.0, 4.0], "x", 1),
             (220, [1.0, 2.0], "x", 1), (206, [float("nan")] * 8, "x", 1)]
    # Extra columns use names that the operators use themselves.
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, block string, dim int")


def able(rows):
    return [(i, np.array(v)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all()]


def test_search(table, rows):
    vectors = [(i, np.floor(64 * v)) for i, v in able([r[:2] for r in table.collect()])]
    expected = []
    for q, x in vectors:
        if q % 20 == 0:
            scores = sorted((-int(x @ y), i) for i, y in vectors if i != q and len(y) == len(x))[:20]
            expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert rows(vector_file.top_k(table)) == sorted(expected, key=repr)


def exact_search(vectors, k=20):
    whole = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in vectors]
    out = []
    for q, x in whole:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in whole if i != q and len(y) == len(x))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out, key=repr)


def test_search_of_large_numbers(spark, rows):
    """Sums beyond 2^53 and components beyond 2^31 keep their exact order."""
    far = [(0, [1.0, 1.0]), (1, [300000.0, 0.0]), (2, [400000.0, 0.0]), (3, [500000.0, 0.0]),
           (20, [3e5, 1e-3]), (4, [3e9, 1.0]), (5, [3e9, 1.0 + 2**-6]), (6, [-3e9, 5.0]), (40, [2.0**18, 3.0])]
    table = spark.createDataFrame(far, "vec_id long, embedding array<double>")
    found = rows(vector_file.top_k(table))
    assert found == exact_search(far)
    assert [r[2:] for r in found if r[0] == 0 and r[2] in (1, 2, 3)] == [(3, 2048000000), (2, 1638400000), (1, 1228800000)]


def test_scores_beyond_64_bits_fail(spark):
    table = spark.createDataFrame([(0, [2.0**40]), (1, [2.0**40])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        vector_file.top_k(table).collect()


def test_search_of_repeated_ids(spark, rows):
    """Other repeated rows count each; a repeated query row is asked once; vectors under one id rank together."""
    same = [(20, [1.0, 0.0])] * 2 + [(20, [0.0, 1.0]), (1, [1.0, 0.5]), (1, [1.0, 0.5])]
    table = spark.createDataFrame(same, "vec_id long, embedding array<double>")
    assert rows(vector_file.top_k(table)) == [(20, 1, 1, 4096), (20, 2, 1, 4096), (20, 3, 1, 2048), (20, 4, 1, 2048)]


def test_search_over_many_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(vector_file, "BLOCK_CELLS", 400)
    monkeypatch.setattr(vector_file, "QUERY_ROWS", 3)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 8))
    far = [(i, (centres[i % 6] * 4 + rng.normal(size=8) * 0.2).tolist()) for i in range(600)]
    table = spark.createDataFrame(far, "vec_id long, embedding array<double>")
    assert rows(vector_file.top_k(table, k=5)) == exact_search(far, 5)


def test_search_of_few_and_none(spark, rows):
    few = spark.createDataFrame([(0, [1.0]), (1, [0.5]), (2, [-0.01])], "vec_id long, embedding array<float>")
    assert rows(vector_file.top_k(few)) == [(0, 1, 1, 2048), (0, 2, 2, -64)]
    assert rows(vector_file.top_k(few.limit(0))) == []


def test_bounds_hold():
    rng = np.random.default_rng(1)
    import pyarrow as pa

    flat = rng.normal(size=(300, 6))
    block = pa.table({"vec_id": np.arange(300), "dim": pa.array([6] * 300, pa.int32()), "vector": flat.tolist()})
    index = vector_file._index_block((None, pa.scalar(0)), block).to_pylist()[0]
    asked = vector_file._query_block((None, pa.scalar(0)), block.slice(0, 40)).to_pylist()[0]
    pair = vector_file._Pair({**index, **asked})
    whole = np.floor(64 * flat)
    exact = whole[:40] @ whole.T
    np.fill_diagonal(exact, -np.inf)
    assert (pair.lower <= exact).all() and (exact <= pair.upper).all()


def test_dedup(table, rows):
    vectors = [(i, v / np.linalg.norm(v)) for i, v in able([r[:2] for r in table.collect()]) if v.any()]
    linked = {i: [j for j, y in vectors if j != i and len(x) == len(y) and x @ y >= 0.9] for i, x in vectors}
    linked |= {r.vec_id: [] for r in table.collect() if r.vec_id not in linked}
    part = {i: i for i in linked}
    while any(part[i] > part[j] for i in linked for j in linked[i]):
        part = {i: min([part[i], *(part[j] for j in linked[i])]) for i in linked}
    expected = [(i, len(linked[i]), part[i], part[i] == i) for i in linked]
    assert rows(cover_tree.similar_vectors(table)) == sorted(expected, key=repr)


def test_dedup_of_repeated_rows_and_none(spark, rows):
    same = spark.createDataFrame(
        [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.0, 1.0]), (None, None)], "vec_id long, embedding array<float>")
    assert rows(cover_tree.similar_vectors(same)) == [
        (1, 0, 1, True), (1, 1, 1, True), (1, 1, 1, True), (None, 0, None, True)]
    assert rows(cover_tree.similar_vectors(same.limit(0))) == []


def exact_links(vectors, cosine=0.9):
    units = np.array([np.array(v, float) / np.linalg.norm(np.array(v, float)) for _, v in vectors])
    near = units @ units.T >= cosine
    np.fill_diagonal(near, False)
    part = np.arange(len(units))
    while any((least := np.where(near[i], part, part[i]).min()) < part[i] and not part.__setitem__(i, least) for i in range(len(part))):
        pass
    ids = [i for i, _ in vectors]
    return [(ids[n], int(near[n].sum()), ids[part[n]], part[n] == n) for n in range(len(ids))]


@pytest.fixture
def sent(spark, monkeypatch):
    """The tables that Python functions get."""
    kind, seen = type(spark.range(0)), []
    run = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **b: seen.append(self) or run(self, *a, **b))
    return seen


def test_blocks_are_not_sent_once_a_pair(spark, rows, sent, monkeypatch):
    """With four times the vectors, about four times as many bytes go to the tasks that compare blocks."""
    monkeypatch.setattr(cover_tree, "BLOCK_ROWS", 20)
    rng = np.random.default_rng(4)
    far = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(960, 6)))]
    sizes = []
    for n in (240, 960):
        found = rows(cover_tree.similar_vectors(spark.createDataFrame(far[:n], "vec_id long, embedding array<double>")))
        assert found == sorted(exact_links(far[:n]), key=repr)
        blocks = sent[-1]
        binary = [f.name for f in blocks.schema if f.dataType.typeName() == "binary"]
        sizes.append(sum(sum(len(r[c]) for c in binary) for r in blocks.select(*binary).collect()))
    assert 0 < sizes[1] < 6 * sizes[0]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_dedup_over_many_tiles(spark, rows, monkeypatch, kind):
    """Several tiles a partition and groups of few blocks, of two dimensions; clusters, single vectors."""
    for name, value in (("BLOCK_ROWS", 20), ("HELD_BYTES", 2000), ("TILE_PARTS", 5), ("KEPT_LINKS", 7), ("FOUND_ROWS", 3)):
        monkeypatch.setattr(cover_tree, name, value)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(6, 5))
    large = np.vstack([rng.normal(size=(150, 5)), base.repeat(25, axis=0) + rng.normal(size=(150, 5)) * 0.1, base[:2]])
    small = [v for i in range(20) for v in ([10.0, i], [9.0, i * 0.01 + 4.3])]
    far = [(i, np.array(v, np.float32 if kind == "float" else float).tolist()) for i, v in enumerate(large)]
    two = [(1000 + i, np.array(v, np.float32 if kind == "float" else float).tolist()) for i, v in enumerate(small)]
    table = spark.createDataFrame(far + two, f"vec_id long, embedding array<{kind}>")
    assert rows(cover_tree.similar_vectors(table)) == sorted(exact_links(far) + exact_links(two), key=repr)


@pytest.mark.parametrize("alike", [False, True])
def test_zeros_of_either_sign_and_equal_hashes(spark, rows, monkeypatch, alike):
    """Rows find their class also where its hashes are those of another."""
    if alike:
        one = [F.lit(1).cast("long").alias("high"), F.lit(1).cast("long").alias("low"), F.lit(2).alias("dim")]
        monkeypatch.setattr(cover_tree, "_marks", lambda vector: one)
    for kind in ("float", "double"):
        table = spark.createDataFrame(
            [(1, [1.0, 0.0]), (2, [1.0, -0.0]), (3, [-0.0, 1.0]), (4, [0.0, -1.0])], f"vec_id long, embedding array<{kind}>")
        assert rows(cover_tree.similar_vectors(table)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True)]


def test_tree_covers_and_nests():
    units = cover_tree.units_of(np.random.default_rng(2).normal(size=(400, 5)).ravel(), 5)
    tree = cover_tree.Tree(units)
    for (up, _, reach), (down, parent, _) in zip(tree.levels, tree.levels[1:]):
        assert set(up) <= set(down)
        assert (np.linalg.norm(units[down] - units[up[parent]], axis=1) <= reach[parent] + 1e-7).all()
