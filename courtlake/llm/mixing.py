"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent, normalised. The
exponent (1: as they come, 0: all alike) is found by sections, an aggregate over the sources at
a time, so that the weights reach a target entropy; if a source would then be repeated more often
than the limit, the exponent moves towards 1 until it is not. Weights times the token budget are
the sources' quotas. Without a budget it is the least that shows every document once.

Quotas are realised as permutations of blocks: a source's documents are dealt by hash into
blocks of about ``BLOCK_TOKENS``; every epoch orders the blocks, and the documents inside them,
by a hash of its own. A quota takes whole epochs, then blocks of one more epoch up to the rest,
then documents of the block in which it ends. What to take is thus three numbers per source, and
each document decides by itself: texts are never shuffled.

Tokens are runs of characters other than white space. A null source is a source. Null, empty and
blank texts have no token and are taken in every epoch that is whole; a source without tokens
has weight 0 and is shown once. Equal rows share their place, so the last epoch takes all or none
of them. No table is collected but one row of sums.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtlake.llm.common import free_name, join_null_safe, stored

BLOCK_TOKENS = 1 << 16
#: Exponents tried in one aggregate, and the precision they are found to.
SECTIONS, PRECISION = 16, 1e-9
HIGHEST = 8.0
#: Parts of a running total: sums of parts are chained, rows inside a part are ordered.
PARTS = 1024


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _named(documents: DataFrame, name: str) -> Column:
    hits = [c for c in documents.columns if c == name] or [
        c for c in documents.columns if c.lower() == name]
    return documents[hits[0]]


class _Shares:
    """Sums over the sources' token shares, for many exponents in one job."""

    def __init__(self, totals: DataFrame):
        self.spark_rows = totals.where("tokens > 0")
        row = self.spark_rows.agg(
            F.sum("tokens"), F.min("tokens"), F.max("tokens"), F.count(F.lit(1))).first()
        self.tokens, self.least, self.most, self.sources = (int(x or 0) for x in row)

    def at(self, exponents: list[float]) -> list[tuple[float, float]]:
        """(sum of powers, entropy of the weights) for each exponent."""
        share = F.col("tokens") / F.lit(float(self.tokens))
        sums = []
        for e in exponents:
            sums += [F.sum(F.pow(share, F.lit(e))), F.sum(F.pow(share, F.lit(e)) * F.log(share))]
        row = self.spark_rows.agg(*[c.alias(f"s{i}") for i, c in enumerate(sums)]).first()
        return [(row[2 * i], math.log(row[2 * i]) - e * row[2 * i + 1] / row[2 * i])
                for i, e in enumerate(exponents)]

    def repeats(self, exponent: float, power: float, budget: float | None) -> tuple[float, float]:
        """Least and greatest number of times that a source is shown."""
        ends = [(t / self.tokens) ** (exponent - 1) / power for t in (self.least, self.most)]
        low, high = min(ends), max(ends)
        scale = 1 / low if budget is None else budget / self.tokens
        return low * scale, high * scale

    def section(self, good, low: float, high: float) -> float:
        """The point between low (good) and high (not) where ``good`` ends, kept on its side."""
        while abs(high - low) > PRECISION:
            steps = [low + (high - low) * i / SECTIONS for i in range(1, SECTIONS)]
            fits = [good(e, *found) for e, found in zip(steps, self.at(steps))]
            last = next((i for i, fit in enumerate(fits) if not fit), len(fits))
            points = [low, *steps, high]
            low, high = points[last], points[last + 1]
        return low


def exponent_for(
    totals: DataFrame, target_entropy: float | None, max_repeats: float | None,
    budget: float | None,
) -> tuple[float, float, _Shares]:
    """(exponent, sum of powers) that meets the target as far as the repetition limit lets it.

    ``target_entropy`` is a fraction of the highest, the logarithm of the number of sources.
    """
    shares = _Shares(totals)
    if not shares.sources:
        return 1.0, 1.0, shares
    exponent = 0.0
    if target_entropy is not None:
        wanted = target_entropy * math.log(shares.sources)
        reached = lambda e, power, entropy: entropy >= wanted - 1e-12
        if not reached(HIGHEST, *shares.at([HIGHEST])[0]):
            exponent = shares.section(reached, 0.0, HIGHEST)
        else:
            exponent = HIGHEST
    if max_repeats is not None:
        fits = lambda e, power, entropy: (
            shares.repeats(e, power, budget)[1] <= max_repeats * (1 + 1e-12))
        if not fits(1.0, *shares.at([1.0])[0]):
            raise ValueError("the budget needs more repeats than allowed, whatever the weights")
        if not fits(exponent, *shares.at([exponent])[0]):
            exponent = shares.section(fits, 1.0, exponent)
    exponent = round(exponent, 8)
    return exponent, shares.at([exponent])[0][0], shares


def _running(df: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """``before``: the sum of ``value`` over rows of the group that come earlier by a hash.

    In two steps, so that a source with a third of all rows is not one task's: the hash range
    is cut into parts, their sums are chained, and rows are ordered inside their part.
    """
    cut = df.withColumn("_part", F.shiftrightunsigned(F.col(order), 64 - int(math.log2(PARTS))))
    sums = cut.groupBy(*by, "_part").agg(F.sum(value).alias("_sum"))
    over = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(over), F.lit(0)))
    placed = join_null_safe(cut, sums.drop("_sum"), [*by, "_part"])
    # Equal places count together: the order is that of unsigned numbers, as the parts are.
    rank = F.col(order).bitwiseXOR(F.lit(-(2**63)))
    inside = Window.partitionBy(*by, "_part").orderBy(rank).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    upto = F.col("_start") + F.sum(value).over(inside)
    return placed.withColumn("upto", upto).drop("_part", "_start")


def mix(
    documents: DataFrame,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget_tokens: float | None = None,
    seed: int = 1,
    places: bool = True,
) -> DataFrame:
    """``documents``, every row as often as its source's quota says.

    With ``places``, columns ``n_tokens``, ``source_weight``, ``epoch`` (from 0), ``block_order`` and
    ``document_order`` are added (underscores before a name in use); sorted by the last three,
    unsigned, the rows are the mixture in order. ``budget_tokens``: tokens of the mixture, None
    for the least that shows every document at least once.
    """
    spark_names = {c: free_name(documents, f"mix_{c}") for c in (
        "source", "tokens", "blocks", "full", "rest", "weight", "block", "cut", "inner", "order")}
    n = spark_names
    row_hash = F.xxhash64(F.lit(seed), _named(documents, "doc_id"), _named(documents, "text"))
    narrow = stored(documents.select(
        _named(documents, "source").alias("source"), row_hash.alias("row"),
        token_count(_named(documents, "text")).alias("tokens")), "mix-rows")
    totals = stored(narrow.groupBy("source").agg(F.sum("tokens").alias("tokens")), "mix-totals")
    exponent, power, shares = exponent_for(totals, target_entropy, max_repeats, budget_tokens)
    share = F.col("tokens") / F.lit(float(max(shares.tokens, 1)))
    weight = F.round(F.pow(share, F.lit(exponent)) / F.lit(power), 12)
    if budget_tokens is None and shares.sources:
        low = shares.repeats(exponent, power, float(shares.tokens))[0]
        budget = shares.tokens / low
        # Rounded weights must not cost the largest source its last document.
        quota = F.greatest(F.floor(F.col("weight") * F.lit(budget)), F.col("tokens"))
    else:
        quota = F.floor(F.col("weight") * F.lit(float(budget_tokens or 0)))
    some = F.col("tokens") > 0
    plan = totals.withColumn("weight", F.when(some, weight).otherwise(0.0))
    plan = plan.withColumn("quota", F.when(some, quota).otherwise(0).cast("long")).select(
        "source", "weight", "tokens",
        F.ceil(F.col("tokens") / F.lit(BLOCK_TOKENS)).alias("blocks"),
        F.when(some, F.floor(F.col("quota") / F.col("tokens"))).otherwise(1).cast("int").alias("full"),
        F.when(some, F.col("quota") % F.col("tokens")).otherwise(0).alias("rest"))
    plan = plan.withColumn("blocks", F.greatest("blocks", F.lit(1)))

    joined = join_null_safe(narrow, plan.drop("tokens", "weight"), ["source"])
    dealt = joined.where("rest > 0").withColumn("block", F.pmod("row", "blocks"))
    dealt = dealt.withColumn("place", _block_place(F.col("source"), F.col("block"), F.col("full"), seed))
    blocks = dealt.groupBy("source", "place", "rest").agg(F.sum("tokens").alias("size"))
    passed = _running(blocks, ["source"], "place", "size").where("upto > rest")
    # The first block that does not fit whole; before it all do.
    earliest = F.col("place").bitwiseXOR(F.lit(-(2**63)))
    cut = passed.groupBy("source").agg(F.min_by(F.struct(
        "place", (F.col("rest") - F.col("upto") + F.col("size")).alias("room")), earliest).alias("cut"))
    cut = cut.select("source", "cut.place", "cut.room")
    last = join_null_safe(dealt, cut, ["source", "place"]).select(
        "source", "tokens", "room", _inner_place(F.col("row"), F.col("full"), seed).alias("order"))
    fitting = _running(last, ["source"], "order", "tokens").where("upto <= room")
    ends = fitting.groupBy("source").agg(
        F.max(F.col("order").bitwiseXOR(F.lit(-(2**63)))).alias("inner"))
    both = join_null_safe(cut, ends, ["source"], "left").select(
        "source", F.col("place").bitwiseXOR(F.lit(-(2**63))).alias("cut"), "inner")
    decided = join_null_safe(plan.drop("tokens"), both, ["source"], "left").select(
        "source", "weight", "blocks", "full", "rest", "cut", "inner")
    decided = stored(decided, "mix-plan").toDF(
        n["source"], n["weight"], n["blocks"], n["full"], n["rest"], n["cut"], n["inner"])

    wide = documents.withColumn(n["order"], row_hash)
    wide = wide.join(decided, _named(wide, "source").eqNullSafe(decided[n["source"]]))
    block = F.pmod(F.col(n["order"]), F.col(n["blocks"]))
    source, full = F.col(n["source"]), F.col(n["full"])
    at = _block_place(source, block, full, seed).bitwiseXOR(F.lit(-(2**63)))
    inner = _inner_place(F.col(n["order"]), full, seed).bitwiseXOR(F.lit(-(2**63)))
    cut_at = F.col(n["cut"])
    extra = (F.col(n["rest"]) > 0) & (
        cut_at.isNull() | (at < cut_at) | ((at == cut_at) & F.coalesce(inner <= F.col(n["inner"]), F.lit(False))))
    times = full + extra.cast("int")
    epoch = free_name(wide, "epoch")
    shown = wide.withColumn(n["tokens"], times).where(F.col(n["tokens"]) > 0).withColumn(
        epoch, F.explode(F.sequence(F.lit(0), F.col(n["tokens"]) - 1)))
    if not places:
        return shown.drop(*n.values(), epoch)
    return shown.select(
        *[shown[c] for c in documents.columns],
        token_count(_named(documents, "text")).alias(free_name(documents, "n_tokens")),
        F.col(n["weight"]).alias(free_name(documents, "source_weight")), F.col(epoch),
        _block_place(source, block, F.col(epoch), seed).alias(free_name(documents, "block_order")),
        _inner_place(F.col(n["order"]), F.col(epoch), seed).alias(free_name(documents, "document_order")),
    )


def _block_place(source: Column, block: Column, epoch: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), epoch.cast("int"), F.coalesce(source.cast("string"), F.lit("\0")), block)


def _inner_place(row: Column, epoch: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(~seed), epoch.cast("int"), row)
