"""Merkle manifest against a plain one, with blocks small enough for several rounds of exchange."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from courtlake.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    values = [r.doc_id, r.source, r.lang, r.n_chars, text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def proofs(leaves):
    """(root, list of (left, right) per level for each leaf)."""
    spots, paths, nodes = list(range(len(leaves))), [[] for _ in leaves], list(leaves)
    while len(nodes) > 1:
        for i, at in enumerate(spots):
            run = nodes[at // 16 * 16 : at // 16 * 16 + 16]
            paths[i].append((run[: at % 16], run[at % 16 + 1 :]))
        spots = [at // 16 for at in spots]
        nodes = [H(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(records):
    sources = {}
    for r in records:
        sources.setdefault(r.source, []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        members = sorted(sources[s], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        trees[s] = members, *proofs([leaf(r, r.text) for r in members])
    root, above = proofs([trees[s][1] for s in order])
    out = []
    for s, top in zip(order, above):
        members, subroot, paths = trees[s]
        for r, path in zip(members, paths):
            path = path + top
            changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
            node = leaf(r, lower(r.text) if changed else r.text)
            for left, right in path:
                node = H(*left, node, *right)
            out.append((r.doc_id, leaf(r, r.text), subroot, root, H(*[d for p in path for side in p for d in side]),
                        node, node == root))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, f"Text {i} ÄB", "en", "hot", i, "x", 1) for i in range(700)]
    rows += [(1000 + i, f"T{i}", "de", f"s{i % 20:02d}", 2, "x", 1) for i in range(90)]
    rows += [(7, "Twice", "en", "hot", 5, "x", 1)] * 40
    rows += [(None, None, None, None, None, None, None), (3, "", "", "", 0, "", 0), (3, "Ends", None, None, 1, "", 0),
             (4, "Z" * 200_000, "en", "é", 1, "x", 1), (5, "last", "en", "\U0001F600", 4, "x", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_against_plain(documents, rows, levels):
    assert rows(manifest.tamper_check(documents, levels)) == brute(documents.collect())


@pytest.mark.parametrize("size", [1, 2, 16, 17, 33, 256, 257])
def test_one_source(spark, rows, size):
    some = spark.range(size).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("A"), "id").alias("text"), F.lit("en").alias("lang"),
        F.lit("s").alias("source"), F.lit(3).cast("long").alias("n_chars"))
    assert rows(manifest.tamper_check(some, levels=1)) == brute(some.collect())


def test_lone_leaf_is_its_own_root(spark):
    one = spark.createDataFrame([(1, "x", "en", "s", 1, "", 1)], SCHEMA)
    (found,) = manifest.tamper_check(one).collect()
    assert found.leaf == found.subroot == found.root and found.proof_sha256 == H("") and found.verified


def test_empty(documents):
    assert manifest.tamper_check(documents.limit(0)).collect() == []


def test_no_message_hub(documents):
    """Every block sends and receives at most a run of digests a round, ragged ends included."""
    blocks = manifest._blocks(
        documents.select("source", F.sha2("text", 256).alias("leaf")), ["source"], ["leaf"], 1)
    found = manifest._exchange(blocks, ["source"])
    assert found.count() == blocks.count()
    assert found.agg(F.max(F.size("upper"))).first()[0] == 2
