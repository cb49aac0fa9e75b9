"""Near-duplicate documents by BagMinHash signatures of weighted shingle sets.

A text is the multiset of its runs of ``SHINGLE`` words (lower case, split at white space; a
shorter text is one shingle). Signatures are weighted minimum hashes: every shingle owns a
Poisson process over (0, weight] whose points fall into the signature's slots, and a slot keeps
its earliest point, so two slots agree with the probability of the weighted Jaccard similarity.
The weight axis is discretised at whole numbers and split hierarchically: octaves
(0, 1], (1, 2], (2, 4], (4, 8], ... are processes of their own, and an octave that a weight cuts
is halved until its pieces lie inside or outside. Points come in order of time and stop as soon
as they are later than every slot of the text.

Bands of slots propose families, the exact multisets decide. Texts with equal multisets are one
class and compared once. The classes of a bucket hang on its least one, so a bucket makes a row
per member and not per pair, and the connected families of these rows hold every pair that
shares a bucket. Within a family all classes are compared exactly, block against block inside a
task; a large family is cut into parts that meet pairwise, so no group is collected whole. A
task returns a spanning forest of the links it finds and every class's number of links: rows in
proportion to the classes, whatever the links. Groups are the components of the forest.

Null, empty and blank texts have no shingle and are each a group of their own. Rows with one
doc_id and equal texts are one document; a null doc_id is a value like others. Ties go to the
smaller doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlake.llm.common import (
    components, free_name, mix64, offsets_of, pick, stored, text_slices, words_of,
)

SHINGLE, SIMILAR = 5, 0.8
#: Slots in a band, bands: a pair at the threshold is missed with a chance of 2.6e-5.
ROWS, BANDS = 4, 20
SLICE_BYTES = 2 << 20
#: Shingles compared in one group of a task; a family with more is cut into parts.
GROUP_ITEMS = 100_000

_U = np.uint64


def _word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter((xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def shingles(texts: list[str | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle hash, weight, shingles per text): the multisets, by text and then hash."""
    words, codes, counts = words_of([t.lower().encode("utf-8", "replace") if t else None for t in texts])
    hashes = _word_hashes(words)[codes] if len(words) else np.empty(0, np.uint64)
    width = np.minimum(counts, size)
    per = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    ends = offsets_of(per)
    doc = np.repeat(np.arange(len(texts)), per)
    first = offsets_of(counts)[:-1][doc] + np.arange(ends[-1]) - ends[:-1][doc]
    mixed = np.zeros(ends[-1], np.uint64)
    for i in range(size):
        inside = i < width[doc]
        at = np.minimum(first + i, max(len(hashes) - 1, 0))
        step = mix64(mixed ^ hashes[at]) if len(hashes) else mixed
        mixed = np.where(inside, step, mixed)
    order = np.lexsort((mixed, doc))
    doc, mixed = doc[order], mixed[order]
    lead = np.ones(len(doc), bool)
    lead[1:] = (doc[1:] != doc[:-1]) | (mixed[1:] != mixed[:-1])
    at = np.flatnonzero(lead)
    weight = np.diff(np.append(at, len(doc)))
    return mixed[at], weight, np.bincount(doc[at], minlength=len(texts))


def _uniform(key: np.ndarray, salt: int) -> np.ndarray:
    bits = mix64(key ^ mix64(np.full(1, salt, np.uint64))[0])
    return ((bits >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


def _octaves(
    key: np.ndarray, weight: np.ndarray, doc: np.ndarray
) -> Iterator[tuple[np.ndarray, ...]]:
    """(process key, first point, cells, cells inside the weight, text) for every octave touched."""
    low, span, number = 0, 1, 0
    while len(key):
        octave = mix64(key + _U(2 * number + 1))
        first = -np.log(_uniform(octave, 1)) / span
        cells = np.full(len(key), span, np.int64)
        yield octave, first, cells, np.minimum(weight - low, span), doc
        low, span, number = low + span, max(low, 1) + (span if low else 0), number + 1
        more = weight > low
        key, weight, doc = key[more], weight[more], doc[more]


def signatures(
    hashes: np.ndarray, weights: np.ndarray, per_text: np.ndarray, slots: int = ROWS * BANDS
) -> np.ndarray:
    """One row per text: for every slot the identity of its earliest point (0 without any).

    Every entry of the work list is a process over ``cells`` unit cells, of which the first
    ``inside`` belong to the weight, with the time of its next point. A point of a process over
    one cell falls into a slot, and the process runs on. A point of a longer one belongs to one
    of its halves, by a coin; the other half waits anew from that time. As the halving depends
    on the process alone, texts with different weights of a shingle see the same points.
    """
    n = len(per_text)
    doc = np.repeat(np.arange(n), per_text)
    work = [np.concatenate(x) for x in zip(*_octaves(hashes, weights, doc))]
    best = np.full(n * slots, np.inf)
    owner = np.zeros(n * slots, np.uint64)
    if not work:
        return owner.reshape(n, slots)
    total = np.bincount(work[4], weights=work[3], minlength=n)
    horizon = np.where(total > 0, (np.log(slots) + 1) * slots / np.maximum(total, 1e-300), 0)
    waiting: list[list[np.ndarray]] = []
    while len(work[0]):
        due = work[1] <= horizon[work[4]]
        waiting.append([x[~due] for x in work])
        key, time, cells, inside, doc = (x[due] for x in work)
        if not len(key):
            # All points up to the horizon are in. Later ones matter where a slot is empty,
            # and up to the time of the latest slot.
            latest = best.reshape(n, slots).max(axis=1)
            work = [np.concatenate(x) for x in zip(*waiting)]
            useful = work[1] < latest[work[4]]
            work, waiting = [x[useful] for x in work], []
            horizon = np.where(np.isfinite(latest), latest, 2 * horizon)
            continue
        leaf = cells == 1
        point = mix64(key[leaf] + _U(7))
        slot = doc[leaf] * slots + (point % _U(slots)).astype(np.int64)
        at = time[leaf]
        np.minimum.at(best, slot, at)
        mine = best[slot] == at
        owner[slot[mine]] = point[mine]
        onward = [point, at - np.log(_uniform(point, 2)), cells[leaf], inside[leaf], doc[leaf]]
        key, time, cells, inside, doc = (x[~leaf] for x in (key, time, cells, inside, doc))
        half = cells // 2
        goes_left = _uniform(key, 3) < 0.5
        halves = []
        for side, chosen in ((1, goes_left), (2, ~goes_left)):
            own = mix64(key + _U(16 * side))
            when = np.where(chosen, time, time - np.log(_uniform(own, 4)) / np.maximum(half, 1))
            within = np.minimum(inside, half) if side == 1 else inside - half
            some = within > 0
            halves.append([x[some] for x in (own, when, half, within, doc)])
        work = [np.concatenate(x) for x in zip(onward, *halves)]
    return owner.reshape(n, slots)


def _elements(hashes: np.ndarray, weights: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The multisets as sets: the i-th copy of a shingle is an element of its own."""
    copies = offsets_of(weights)
    which = np.repeat(np.arange(len(hashes)), weights)
    nth = (np.arange(copies[-1]) - copies[:-1][which]).astype(np.uint64)
    ends = np.append(0, copies[offsets_of(per_text)[1:]])
    return mix64(hashes[which] + nth * _U(0xD1342543DE82EF95)), ends


def _signed(docs: DataFrame) -> DataFrame:
    """Every row's identity of text (mark) and of multiset (high, low), and its band hashes."""

    def run(batches):
        for part in text_slices(batches, "text", SLICE_BYTES):
            hashes, weights, per = shingles(part.column("text").to_pylist())
            n, ends, some = len(per), offsets_of(per), per > 0
            cell = mix64(hashes ^ mix64(weights.astype(np.uint64)))
            high, low = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            if some.any():
                with np.errstate(over="ignore"):
                    high[some] = np.add.reduceat(cell, ends[:-1][some])
                    low[some] = np.add.reduceat(mix64(cell), ends[:-1][some])
            owner = signatures(hashes, weights, per).reshape(n, BANDS, ROWS)
            bands = np.tile(np.arange(BANDS, dtype=np.uint64), (n, 1))
            for i in range(ROWS):
                bands = mix64(bands ^ owner[:, :, i])
            lists = pa.ListArray.from_arrays(
                pa.array(offsets_of(np.where(some, BANDS, 0)), pa.int32()),
                pa.array(bands[some].ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("mark"), pa.array(high.view(np.int64)),
                 pa.array(low.view(np.int64)), pa.array(some), lists],
                ["key", "mark", "high", "low", "worded", "bands"])

    return docs.mapInArrow(
        run, "key long, mark long, high long, low long, worded boolean, bands array<long>")


def _sets(texts: DataFrame) -> DataFrame:
    """(node, items): the expanded multiset of every text."""

    def run(batches):
        for part in text_slices(batches, "text", SLICE_BYTES):
            items, ends = _elements(*shingles(part.column("text").to_pylist()))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(items.view(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("node"), lists], ["node", "items"])

    return texts.select("node", "text").mapInArrow(
        run, "node struct<id:long,high:long>, items array<long>")


def _compare(table: pa.Table, similar: float, both: bool = False) -> pa.Table:
    """Exact comparison of the texts of a few families, each with all others of its own.

    Returns a spanning forest of the links (a, b), and in rows without b every text's number of
    links. With ``both`` the group is two parts of a family, and only texts of different parts are
    compared: those of one part have a group of their own. A group without rows of the other part
    has nothing to compare.
    """
    family = table.column("family").combine_chunks()
    order = np.lexsort((family.field("high").to_numpy(zero_copy_only=False),
                        family.field("id").to_numpy(zero_copy_only=False)))
    table = table.take(pa.array(order))
    family = table.column("family").combine_chunks()
    fid = family.field("id").to_numpy(zero_copy_only=False)
    fhigh = family.field("high").to_numpy(zero_copy_only=False)
    lead = np.flatnonzero(np.append(True, (fid[1:] != fid[:-1]) | (fhigh[1:] != fhigh[:-1])))
    lists = table.column("items").combine_chunks()
    values = lists.values.to_numpy(zero_copy_only=False)
    ends = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    part = table.column("part").to_numpy()
    if both and (part == part[0]).all():
        table, part, lead = table.slice(0, 0), part[:0], lead[:0]
    pairs_a, pairs_b, degree = [], [], np.zeros(table.num_rows, np.int64)
    for start, stop in zip(lead, np.append(lead[1:], table.num_rows)):
        if stop - start < 2:
            continue
        _, code = np.unique(values[ends[start] : ends[stop]], return_inverse=True)
        cuts = ends[start:stop] - ends[start]
        size = np.diff(np.append(cuts, len(code)))
        held = np.zeros(int(code.max()) + 1, bool)
        root = np.arange(stop - start)
        for i in range(stop - start - 1):
            mine = code[cuts[i] : cuts[i] + size[i]]
            held[mine] = True
            rest = np.add.reduceat(held[code[cuts[i + 1] :]].astype(np.int64), cuts[i + 1 :] - cuts[i + 1])
            held[mine] = False
            whole = size[i] + size[i + 1 :] - rest
            near = rest >= similar * whole
            if both:
                near &= part[start + i + 1 : stop] != part[start + i]
            found = np.flatnonzero(near) + i + 1
            degree[start + i] += len(found)
            degree[start + found] += 1
            for j in found:
                if root[i] != root[j]:
                    pairs_a.append(start + i)
                    pairs_b.append(start + j)
                    root[root == root[j]] = root[i]
    node = table.column("node").combine_chunks()
    some = np.flatnonzero(degree)
    left = pa.array(np.concatenate([pairs_a, some]).astype(np.int64))
    right = pa.array([*pairs_b, *[None] * len(some)], pa.int64())
    count = pa.array([*[0] * len(pairs_a), *degree[some].tolist()], pa.int64())
    return pa.table({"a": node.take(left), "b": node.take(right), "links": count})


def _links(sets: DataFrame, families: DataFrame, similar: float) -> DataFrame:
    """``_compare`` over all families; a large one is cut into parts, and the parts paired."""
    sized = sets.join(families, "node")
    total = sized.groupBy("family").agg(F.sum(F.size("items")).alias("cells"))
    total = total.withColumn("parts", F.ceil(F.col("cells") / GROUP_ITEMS).cast("int"))
    small = total.agg(F.sum(F.when(F.col("parts") == 1, F.col("cells")))).first()[0] or 0
    bins = max(1, -(-int(small) // GROUP_ITEMS))
    placed = sized.join(total.select("family", "parts"), "family")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    placed = placed.withColumn("part", part).withColumn("other", F.explode(
        F.sequence(F.lit(0), F.col("parts") - 1)))
    several = F.col("parts") > 1
    keyed = placed.select(
        "node", "family", "items", "part",
        F.when(several, F.col("family.id")).alias("k0"),
        F.when(several, F.col("family.high")).otherwise(
            F.pmod(F.xxhash64("family"), F.lit(bins))).alias("k1"),
        F.least("part", "other").alias("k2"), F.greatest("part", "other").alias("k3"),
    )
    node = "struct<id:long,high:long>"
    return keyed.groupBy("k0", "k1", "k2", "k3").applyInArrow(
        lambda key, table: _compare(table, similar, key[2].as_py() != key[3].as_py()),
        f"a {node}, b {node}, links long")


NO_ID = -(2**63)


def _keyed(documents: DataFrame) -> DataFrame:
    docs = pick(documents, "doc_id", "text")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"),
        F.xxhash64("text").alias("mark"), "text")


def _members(documents: DataFrame, similar: float) -> DataFrame:
    """(key, mark, rows, high, low, worded, class_id, component, links) for each (id, text)."""
    docs = _keyed(documents)
    signed = stored(_signed(docs), "signed")
    once = stored(signed.groupBy("key", "mark", "high", "low", "worded").agg(
        F.count(F.lit(1)).alias("rows")), "once")
    # A class is one multiset; its node is the least id that holds it, and the hash, since
    # different texts may carry one id.
    classes = stored(
        signed.where("worded").groupBy("high", "low").agg(
            F.min(F.struct("key", "mark")).alias("first"), F.any_value("bands").alias("bands"))
        .select(F.struct(F.col("first.key").alias("id"), "high").alias("node"),
                F.col("first.key").alias("key"), F.col("first.mark").alias("mark"),
                "high", "low", "bands"), "classes")
    buckets = classes.select("node", F.explode("bands").alias("band"))
    leaders = buckets.groupBy("band").agg(
        F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").select("band", "a")
    mates = stored(buckets.join(leaders, "band"), "mates")
    stars = stored(mates.where("a <> node").select("a", F.col("node").alias("b")).distinct(), "stars")
    wanted = classes.join(mates.select("node").distinct(), "node").select("key", "mark", "node")
    texts = docs.join(wanted, ["key", "mark"])
    if not once.where("rows > 1").isEmpty():
        texts = texts.dropDuplicates(["node"])
    sets = stored(_sets(texts), "sets")
    families = stored(components(stars).withColumnRenamed("component", "family"), "families")
    found = stored(_links(sets, families, similar), "links")
    links = found.where("b is not null").select("a", "b")
    degree = found.where("b is null").groupBy(F.col("a").alias("node")).agg(
        F.sum("links").alias("links"))
    named = classes.select("node", "high", "low").join(components(links), "node", "left").join(
        degree, "node", "left").select(
        "high", "low", F.col("node.id").alias("class_id"),
        F.coalesce("component", "node").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    return once.join(named, ["high", "low"], "left")


def near_duplicates(documents: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, class_id, component_id, n_links, kept: one row per document.

    ``class_id`` is the least doc_id with the same multiset of shingles, ``component_id`` the
    least doc_id of the group, ``n_links`` the number of classes that the search linked with the
    document's own, ``kept`` true for the one document of each group that stays.
    """
    named = lambda c: F.when(c != F.lit(NO_ID), c)
    return _members(documents, similar).select(
        named(F.col("key")).alias("doc_id"),
        named(F.coalesce("class_id", "key")).alias("class_id"),
        named(F.coalesce("component.id", "key")).alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        _kept().alias("kept"),
    )


def _kept():
    """The least id of a group stays; of its texts with one multiset the first mark does."""
    return ~F.col("worded") | (
        (F.col("key") == F.col("component.id")) & (F.col("high") == F.col("component.high")))


def keep_one(documents: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The documents that stay, all their columns: one row for each group."""
    members = _members(documents, similar).where(_kept())
    first = members.groupBy("key", "high", "low", "worded").agg(
        F.min(F.struct("mark", "rows")).alias("first"))
    stay = stored(first.select("key", "first.mark", "first.rows"), "stay")
    repeats = not stay.where("rows > 1").isEmpty()
    key, mark, rows = (free_name(documents, f"dedup_{c}") for c in ("key", "mark", "rows"))
    wide = documents.withColumns({
        key: F.coalesce(_column(documents, "doc_id").cast("long"), F.lit(NO_ID)),
        mark: F.xxhash64(_column(documents, "text"))})
    found = wide.join(stay.toDF(key, mark, rows), [key, mark])
    if repeats:
        # Repeated rows of one document: any one of them, they differ in other columns at most.
        once = found.where(F.col(rows) > 1).dropDuplicates([key, mark])
        found = found.where(F.col(rows) == 1).unionByName(once)
    return found.drop(key, mark, rows)


def _column(documents: DataFrame, name: str):
    exact = [c for c in documents.columns if c == name] or [
        c for c in documents.columns if c.lower() == name]
    return documents[exact[0]]
