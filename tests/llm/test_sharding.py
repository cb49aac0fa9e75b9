"""Feistel shards: a permutation, its laws, and the same answer however the rows are stored."""

import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from courtlake.llm import sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, slot string, Row_Number long"


@given(st.integers(1, 3000), st.integers(0, 2**62), st.integers(1, 50))
@settings(max_examples=60, deadline=None)
def test_numbers_are_permuted(total, seed, shards):
    found = [sharding.locate(i, total, shards, seed) for i in range(total)]
    assert len(set(found)) == total
    sizes = Counter(shard for shard, _ in found)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1
    assert all(sorted(slot for s, slot in found if s == shard) == list(range(n)) for shard, n in sizes.items())


def test_neighbours_part():
    total = 50_000
    shard = [sharding.locate(i, total)[0] for i in range(total)]
    together = sum(a == b for a, b in zip(shard, shard[1:])) / total
    assert abs(together - 1 / 40) < 0.004
    first = Counter(shard[: total // 10])
    # Chi-square of 40 shards: mean 39, deviation 9.
    assert sum((first[s] - total / 400) ** 2 for s in range(40)) / (total / 400) < 80


@pytest.mark.parametrize("total", [1, 2, 3, 5, 37, 2501, 4099])
def test_columns_follow_the_rule(spark, total):
    found = sharding.permute(spark.range(total), "id", total, seed=9).collect()
    assert [r.permuted for r in sorted(found)] == [
        slot * 7 + shard for shard, slot in (sharding.locate(i, total, 7, 9) for i in range(total))]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, f"text {i % 7} ä" * (i % 5), "en", f"s{i % 3}", i, 5, "x", 1) for i in range(200)]
    rows += [(7, "copy", "en", "s", 4, 5, "x", 1)] * 90 + [(7, None, None, None, None, None, None, None)] * 2
    rows += [(None, "no id", "en", "s", 5, 5, "x", 1), (500, "é" * 300_000, "fr", "s", 3, 5, "x", 1), (501, "", "", "", 0, 1, "", 1)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(documents, shards):
    keyed = []
    for r in documents.collect():
        body = (r.text or "").encode()
        keyed.append((r.doc_id, len(body) + 16, zlib.crc32(body)))
    keyed.sort(key=lambda k: (k[0] is not None, k[0] or 0, *k[1:]))
    return sorted(((*k, i, *sharding.locate(i, len(keyed), shards)) for i, k in enumerate(keyed)), key=repr)


def test_places(documents, rows):
    expected = brute(documents, 40)
    assert rows(sharding.place(documents)) == expected
    # Another order, other partitions.
    assert rows(sharding.place(documents.orderBy("text").repartition(3))) == expected


def test_digest(documents):
    found = sharding.shard_digest(documents).collect()
    assert len(found) == documents.count() and {r.law for r in found} == {"rows"}
    assert {r.grown_shard for r in found} == {None}
    null = [r for r in found if r.doc_id == 7 and r.size == 16]
    assert [r.text_crc32 for r in null] == [0, 0]


def test_empty(documents):
    empty = sharding.shard_digest(documents.limit(0))
    assert empty.collect() == []
    assert dict(empty.dtypes)["grown_shard"] == "int"


def test_written_shards(spark, documents, tmp_path):
    sharding.write_shards(documents, str(tmp_path / "shards"), shards=6)
    back = []
    for shard in range(6):
        rows = sharding.read_shard(spark, str(tmp_path / "shards"), shard).collect()
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        back += [tuple(r.row) for r in rows]
    assert sorted(back, key=repr) == sorted((tuple(r) for r in documents.collect()), key=repr)


def test_no_python_on_the_path(documents, plan):
    text = plan(sharding.shard_digest(documents))
    assert "Python" not in text and "InArrow" not in text
