"""Merkle manifest of a dataset: a tree per source, one over the sources, a proof for every row.

H is the lower-case hex SHA-256 of its inputs joined. A leaf is H over doc_id, source, lang, n_chars
and text, each "-" if null, else its UTF-8 byte count, ":" and the value. The leaves of a source
ascend by doc_id; while several nodes remain, every ``FANOUT`` consecutive ones become one, the last
run with what is left. The last nodes of the sources, null first, then by bytes, form a tree alike.

Leaves are numbered by a distributed sort and packed into aligned blocks of FANOUT^3; a block hashes
its own levels. The levels above are a butterfly exchange of blocks: in round r a block sends the
digest of its ancestor to the blocks whose number differs in base-FANOUT digit r alone, so each
gets the whole run of siblings, hashes it itself (as all of its group do) and keeps the run as its
proof. Every block sends and receives at most FANOUT digests a round, whatever the shape of the
tree; nothing is gathered at a root and handed down. Ragged ends are filled with blocks without
a digest, at most as many as there are blocks, which take part and are left out of every run.

Nulls count as "-" and a null source is one of its own. Rows with equal doc_id are ordered by
leaf, equal leaves are interchangeable. Texts are read once and never leave their task. An empty table has
no rows and so no root. Columns besides the five take no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlake.llm.common import join_null_safe, pick, stored
from courtlake.llm.ranking import ranked

FANOUT, BLOCK_LEVELS = 16, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PATH = "array<struct<at:int,run:array<string>>>"


def digest_of(parts: Column) -> Column:
    """H of an array of strings."""
    return F.sha2(F.array_join(parts, ""), 256)


def leaf_of(fields: Sequence[Column]) -> Column:
    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(written, fields)), 256)


# ── Proofs: per level, the run of siblings and the place of one's own among them ──


def siblings(path: Column) -> Column:
    """The other digests of every run, from the bottom, left to right."""
    others = lambda p: F.concat(
        F.slice(p["run"], F.lit(1), p["at"]), F.slice(p["run"], p["at"] + 2, F.size(p["run"])))
    return F.flatten(F.transform(path, others))


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the others of its runs."""
    def up(own: Column, p: Column) -> Column:
        return digest_of(F.concat(
            F.slice(p["run"], F.lit(1), p["at"]), F.array(own), F.slice(p["run"], p["at"] + 2, F.size(p["run"]))))

    return F.aggregate(path, leaf, up)


# ── A tree over the rows of each group ──


def _parents(nodes: Column) -> Column:
    firsts = F.sequence(F.lit(1), F.size(nodes), F.lit(FANOUT))
    return F.transform(firsts, lambda i: digest_of(F.slice(nodes, i, F.lit(FANOUT))))


def _blocks(rows: DataFrame, group: Sequence[str], order: Sequence[str], levels: int) -> DataFrame:
    """A row per aligned block: its members in order and its nodes by level (n0 are the leaves)."""
    span = FANOUT**levels
    numbered = ranked(rows, order, group)
    own = [c for c in rows.columns if c not in group]
    div = lambda a: F.call_function("div", a, F.lit(span).cast("long"))
    packed = numbered.withColumn("block", div(F.col("index"))).groupBy(*group, "block").agg(
        F.sort_array(F.collect_list(F.struct("index", *own))).alias("members"),
        (div(F.max("total") - 1) + 1).alias("blocks"))
    packed = packed.withColumn("n0", F.transform("members", lambda m: m["leaf"]))
    for level in range(levels):
        nodes = F.col(f"n{level}")
        # One node is the end of a tree that is a single block; elsewhere it goes on alone.
        packed = packed.withColumn(f"n{level + 1}", F.when(
            (F.col("blocks") > 1) | (F.size(nodes) > 1), _parents(nodes)))
    tops = [F.get(F.col(f"n{level}"), F.lit(0)) for level in range(levels, -1, -1)]
    return stored(packed.withColumn("node", F.coalesce(*tops)), "merkle-blocks")


def _exchange(blocks: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group, block, node, upper): the root that each block ends at and its runs on the way there."""
    rows = blocks.select(*group, "block", "blocks", "node")
    most = rows.agg(F.max("blocks")).first()[0] or 0
    # The end of a tree is filled up to a multiple of the span below its last round.
    width = F.lit(1).cast("long")
    step = 1
    while step < most:
        width = F.when(F.col("blocks") > step, F.lit(step).cast("long")).otherwise(width)
        step *= FANOUT
    filled = F.ceil(F.col("blocks") / width).cast("long") * width
    rows = rows.withColumn("filled", filled).withColumn("upper", F.array().cast(_PATH))
    ghosts = rows.where(F.col("block") + F.col("blocks") < F.col("filled")).withColumns({
        "block": F.col("block") + F.col("blocks"), "node": F.lit(None).cast("string")})
    rows = rows.unionByName(ghosts)
    stride = 1
    while stride < most:
        active, done = rows.where(F.col("blocks") > stride), rows.where(F.col("blocks") <= stride)
        digit = F.call_function("div", F.col("block"), F.lit(stride).cast("long")) % FANOUT
        sent = active.withColumn("digit", digit.cast("int")).withColumn(
            "other", F.explode(F.array(*[F.lit(i) for i in range(FANOUT)]))).withColumn(
            "to", F.col("block") + (F.col("other") - F.col("digit")) * F.lit(stride).cast("long"))
        mine = F.col("to") == F.col("block")
        got = sent.where("to < filled").groupBy(*group, "to").agg(
            F.sort_array(F.collect_list(F.when(F.col("node").isNotNull(), F.struct("digit", "node")))).alias("got"),
            F.max(F.when(mine, F.col("digit"))).alias("at"), F.max(F.when(mine, F.col("upper"))).alias("upper"),
            F.max("blocks").alias("blocks"), F.max("filled").alias("filled"))
        run = F.transform("got", lambda x: x["node"])
        met = got.withColumn("run", run).select(
            *group, F.col("to").alias("block"), "blocks", F.when(F.size("run") > 0, digest_of(F.col("run"))).alias("node"),
            "filled", F.concat("upper", F.array(F.struct("at", "run"))).cast(_PATH).alias("upper"))
        rows = stored(met.unionByName(done), "merkle-round")
        stride *= FANOUT
    return rows.where("block < blocks").select(*group, "block", F.col("node").alias("root"), "upper")


def tree(rows: DataFrame, group: Sequence[str], order: Sequence[str], levels: int = BLOCK_LEVELS) -> DataFrame:
    """A row per block of members (with ``index`` and ``leaf``), nodes by level, ``root`` and ``upper``.

    ``rows`` has a column ``leaf``; each group has a tree over its rows by ``order``.
    """
    blocks = _blocks(rows, group, order, levels)
    top = _exchange(blocks, group)
    return join_null_safe(blocks.drop("node"), top, [*group, "block"])


def _path(member: Column, levels: int) -> Column:
    """The runs of a member inside its block, then those of the block."""
    span = F.lit(FANOUT**levels).cast("long")
    steps = []
    for level in range(levels):
        at = F.call_function("div", member["index"] % span, F.lit(FANOUT**level).cast("long")).cast("int")
        first = at - at % FANOUT + 1
        steps.append(F.when(F.col(f"n{level + 1}").isNotNull(), F.struct(
            (at % FANOUT).alias("at"), F.slice(F.col(f"n{level}"), first, F.lit(FANOUT)).alias("run"))))
    inside = F.filter(F.array(*steps), lambda s: s.isNotNull()).cast(_PATH)
    return F.concat(inside, F.col("upper"))


def manifest(documents: DataFrame, altered: Column | None = None, levels: int = BLOCK_LEVELS) -> DataFrame:
    """doc_id, source, leaf, subroot, root and ``path`` (at, run per level up to root) of every row.

    ``altered``, a text in terms of the five columns, adds ``altered_leaf``: the leaf with that
    text, null where it is null.
    """
    rows = pick(documents, *FIELDS)
    columns = [F.col(c) for c in FIELDS]
    changed = F.lit(None).cast("string")
    if altered is not None:
        rows = rows.withColumn("altered", altered)
        changed = F.when(F.col("altered").isNotNull(), leaf_of([*columns[:-1], F.col("altered")]))
    leaves = rows.select("source", "doc_id", leaf_of(columns).alias("leaf"), changed.alias("altered_leaf"))
    below = tree(leaves, ["source"], ["doc_id", "leaf"], levels)
    subroots = below.where("block = 0").select("source", F.col("root").alias("leaf"))
    above = tree(subroots, [], ["source"], levels).select(
        "root", F.explode(F.transform("members", lambda m: F.struct(
            m["source"].alias("source"), _path(m, levels).alias("top")))).alias("m"))
    above = stored(above.select(F.col("m.source").alias("source"), F.col("m.top").alias("top"),
                                F.col("root").alias("whole")), "merkle-sources")
    # Digests of blocks meet those of sources first: a hot source is many blocks of small rows there.
    spots = join_null_safe(below.select("source", "block"), above, ["source"])
    packed = join_null_safe(below, spots, ["source", "block"])
    found = packed.select("source", "root", "whole", F.explode(F.transform("members", lambda m: F.struct(
        m["doc_id"].alias("doc_id"), m["leaf"].alias("leaf"), m["altered_leaf"].alias("altered_leaf"),
        F.concat(_path(m, levels), F.col("top")).alias("path")))).alias("m"))
    return found.select("m.doc_id", "source", "m.leaf", "m.altered_leaf", F.col("root").alias("subroot"),
                        F.col("whole").alias("root"), "m.path")


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def tamper_check(documents: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """Proofs of every row, checked against leaves of which a fifth had their text lower-cased."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = manifest(documents, F.when(chosen, lowered(F.col("text"))), levels)
    back = found.withColumns({
        "proof_sha256": digest_of(siblings(F.col("path"))),
        "folded_root": folded(F.coalesce("altered_leaf", "leaf"), F.col("path"))})
    return back.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))
