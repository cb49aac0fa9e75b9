"""Text quality by the perplexity of a modified Kneser-Ney model of trusted text.

The model is over characters: n-grams of ``ORDER`` symbols, interpolated over all lower orders with
three discounts per order, a model for each language. It is fitted on every labelled good document
(the held-out fold is not used), whole texts. Counts, continuation counts, contexts and probabilities are tables keyed by (language,
n-gram) and are joined with one another; no table is collected.

Scoring joins the n-grams that occur with these tables. Tasks emit each n-gram once for a block of
texts; its probability is looked up once for the corpus, by joins order after order, and goes
back to the blocks that asked. So the joins grow with the distinct n-grams, a frequent one is a
row per block, and a block meets its texts again compressed. A block's texts are read twice;
should a second run ever cut blocks differently, the task fails instead of guessing.

A document is kept if its perplexity lies between two quantiles of the trusted documents' of its
language: above are shouting, tables and symbol noise, below what repeats itself. The quantiles
are taken over all trusted documents.

White space runs count as one space. Every character of 16 bits is a symbol of its own; those beyond
share the symbols of the private-use area. Ties at a quantile are kept. Null and empty texts
are the end symbol alone. A null language is a language; one without trusted text has no model:
perplexity null, kept. Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlake.llm.common import (
    fold_of, offsets_of, pick, stored, text_slices,
)

ORDER, BITS = 4, 16
#: Ids of labelled good rows that are sent to every task, at most; more meet the texts in a join.
SENT_IDS = 1_000_000
LOW, HIGH = 0.004, 0.996
START, END, SPACE = 0, 1, 32
#: Code points beyond 16 bits share the symbols of the private-use area, which texts do not use.
SHARED, SHARED_SYMBOLS = 0xE000, 6400
#: Below all orders, each of the first COMMON symbols has 1 / ALPHABET, the others share the rest.
COMMON, ALPHABET = 3072, 4096
SLICE_BYTES, BLOCK_BYTES = 4 << 20, 32 << 20
NO_LANG = "\x01"


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts, number per text): ORDER - 1 starts, the characters, one end."""
    lengths = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
    points = np.frombuffer("".join(t for t in texts if t).encode("utf-32-le", "surrogatepass"), np.uint32)
    white = (points == 32) | ((points >= 9) & (points <= 13)) | (points == 0x85) | (points == 0xA0) | (
        (points >= 0x2000) & (points <= 0x200A)) | (points == 0x3000)
    code = np.where(points < 1 << 16, np.maximum(points, 2), SHARED + points % SHARED_SYMBOLS)
    code = np.where(white, SPACE, code).astype(np.uint16)
    doc = np.repeat(np.arange(len(texts)), lengths)
    again = np.zeros(len(code), bool)
    again[1:] = white[1:] & white[:-1] & (doc[1:] == doc[:-1])
    code, doc = code[~again], doc[~again]
    sizes = np.bincount(doc, minlength=len(texts)) + ORDER
    ends = offsets_of(sizes)
    out = np.zeros(ends[-1], np.uint16)
    inner = offsets_of(sizes - ORDER)
    out[np.arange(len(code)) + (ends[:-1] + ORDER - 1 - inner[:-1])[doc]] = code
    out[ends[1:] - 1] = END
    return out, sizes


def grams(code: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The n-gram that ends at every symbol but the starts, as a number of BITS per symbol."""
    out = code[: len(code) - ORDER + 1].astype(np.int64)
    for i in range(1, ORDER):
        out = (out << BITS) | code[i : len(code) - ORDER + 1 + i]
    ends = offsets_of(sizes)
    keep = np.ones(len(out), bool)
    for i in range(ORDER - 1):
        keep[(ends[1:-1] - 1 - i)] = False
    return out[keep]


def _by_language(part: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    langs = part.column("lang").to_pylist()
    for lang in sorted(set(langs)):
        yield lang, np.array([i for i, x in enumerate(langs) if x == lang])


def _counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): counts of the highest order, summed in each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SLICE_BYTES):
            texts = part.column("text").to_pylist()
            for lang, rows in _by_language(part):
                found, n = np.unique(grams(*symbols([texts[i] for i in rows])), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found)), pa.array(found), pa.array(n)], ["lang", "gram", "n"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))


def _last(gram: Column, symbols: int) -> Column:
    return gram if symbols == ORDER else gram.bitwiseAND(F.lit((1 << (BITS * symbols)) - 1))


def _suffix(gram: Column, order: int) -> Column:
    return _last(gram, order - 1)


def _uniform(symbol: Column) -> Column:
    return F.when(symbol < COMMON, 1 / ALPHABET).otherwise((1 - COMMON / ALPHABET) / ((1 << BITS) - COMMON))


def _context(gram: Column) -> Column:
    # An n-gram fills all 64 bits, the sign too.
    return F.shiftrightunsigned(gram, BITS)


def fit(trusted: DataFrame) -> dict[int, tuple[DataFrame, DataFrame]]:
    """For every order: (lang, gram, p) of seen n-grams, (lang, context, left) of seen contexts.

    ``left`` is the share that a context leaves to the order below.
    """
    level = stored(_counts(trusted), "kn-counts")
    levels = {ORDER: level}
    for order in range(ORDER - 1, 0, -1):
        # Continuation counts: distinct symbols seen before the n-gram.
        level = levels[order + 1].select("lang", _suffix(F.col("gram"), order + 1).alias("gram"))
        levels[order] = stored(level.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n")), "kn-level")
    model: dict[int, tuple[DataFrame, DataFrame]] = {}
    for order in range(1, ORDER + 1):
        table = levels[order]
        often = table.groupBy("lang").agg(*[
            F.sum((F.col("n") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)])
        share = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))

        def discount(i: int, share: Column = share) -> Column:
            ratio = F.col(f"n{i + 1}") / F.greatest(F.col(f"n{i}"), F.lit(1.0))
            return F.least(F.greatest(i - (i + 1) * share * ratio, F.lit(0.05)), F.lit(i - 0.05))

        # One row per language, stored so that the join knows its size and need not deal out a
        # language's n-grams to one task.
        often = stored(often.select("lang", *[discount(i).alias(f"d{i}") for i in (1, 2, 3)]), "kn-discounts")
        own = table.join(often, "lang").withColumn("d", F.when(F.col("n") == 1, F.col("d1")).when(
            F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))).withColumn("context", _context(F.col("gram")))
        contexts = own.groupBy("lang", "context").agg(
            F.sum("n").alias("total"), F.sum("d").alias("given")).select(
            "lang", "context", "total", (F.col("given") / F.col("total")).alias("left"))
        contexts = stored(contexts, "kn-contexts")
        seen = own.join(contexts, ["lang", "context"])
        if order == 1:
            below = _uniform(F.col("gram"))
        else:
            lower = model[order - 1][0].select("lang", F.col("gram").alias("tail"), F.col("p").alias("below"))
            seen = seen.withColumn("tail", _suffix(F.col("gram"), order)).join(lower, ["lang", "tail"])
            below = F.col("below")
        p = (F.col("n") - F.col("d")) / F.col("total") + F.col("left") * below
        model[order] = (stored(seen.select("lang", "gram", p.alias("p")), "kn-seen"),
                        contexts.select("lang", "context", "left"))
    return model


def probabilities(asked: DataFrame, model: dict[int, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(lang, gram, logp): log10 of every asked n-gram's probability, null without a model."""
    found = asked
    for order in range(ORDER, 0, -1):
        seen, contexts = model[order]
        cut = _last(F.col("gram"), order)
        found = found.withColumns({"g": cut, "c": _context(cut)})
        found = found.join(seen.select("lang", F.col("gram").alias("g"), F.col("p").alias(f"p{order}")),
                           ["lang", "g"], "left")
        found = found.join(contexts.select("lang", F.col("context").alias("c"), F.col("left").alias(f"l{order}")),
                           ["lang", "c"], "left").drop("g", "c")
    # An unseen n-gram takes what its context leaves of the order below, all if that is unseen.
    p = F.col("l1") * _uniform(_last(F.col("gram"), 1))
    for order in range(1, ORDER + 1):
        unseen = F.coalesce(F.col(f"l{order}"), F.lit(1.0)) * p if order > 1 else p
        p = F.coalesce(F.col(f"p{order}"), unseen)
    return found.select("lang", "gram", F.log10(p).alias("logp"))


def _block_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """(number, slices) of blocks of about BLOCK_BYTES, alike whenever the rows are."""
    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for part in text_slices(batches, "text", SLICE_BYTES):
        held.append(part)
        size += part.nbytes
        if size >= BLOCK_BYTES:
            yield number, held
            number, held, size = number + 1, [], 0
    if held:
        yield number, held


def _asked(docs: DataFrame) -> DataFrame:
    """(block, lang, gram): every n-gram once for each block it occurs in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in _block_numbers(batches):
            by: dict[str, list[np.ndarray]] = {}
            for part in held:
                texts = part.column("text").to_pylist()
                for lang, rows in _by_language(part):
                    by.setdefault(lang, []).append(np.unique(grams(*symbols([texts[i] for i in rows]))))
            for lang, several in by.items():
                found = np.unique(np.concatenate(several))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), number)), pa.array([lang] * len(found)), pa.array(found)],
                    ["block", "lang", "gram"])

    return docs.mapInArrow(run, "block long, lang string, gram long")


def _sent(docs: DataFrame) -> DataFrame:
    """(block, lang, ids, sizes, data): the symbols of a block's slices, by byte planes, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held in _block_numbers(batches):
            for part in held:
                texts = part.column("text").to_pylist()
                for lang, rows in _by_language(part):
                    code, sizes = symbols([texts[i] for i in rows])
                    planes = np.ascontiguousarray(code.view(np.uint8).reshape(-1, 2).T).tobytes()
                    yield pa.RecordBatch.from_arrays([
                        pa.array([number]), pa.array([lang]),
                        pa.array([part.column("doc_id").take(pa.array(rows)).to_pylist()], pa.list_(pa.int64())),
                        pa.array([sizes.tolist()], pa.list_(pa.int64())),
                        pa.array([pa.compress(planes, codec="zstd", asbytes=True)], pa.binary()),
                    ], ["of", "lang", "ids", "sizes", "data"])

    return docs.mapInArrow(run, "of long, lang string, ids array<long>, sizes array<long>, data binary")


def _judge(known: pa.Table, sent: pa.Table) -> pa.Table:
    langs = np.array(known.column("lang").to_pylist(), dtype=object)
    gram = known.column("gram").to_numpy()
    logp = known.column("logp").to_numpy(zero_copy_only=False)
    tables = {}
    for lang in set(langs.tolist()):
        mine = np.flatnonzero(langs == lang)
        mine = mine[np.argsort(gram[mine])]
        tables[lang] = gram[mine], logp[mine]
    out = []
    for row in sent.to_pylist():
        sizes = np.array(row["sizes"], np.int64)
        raw = pa.decompress(row["data"], decompressed_size=2 * int(sizes.sum()), codec="zstd", asbytes=True)
        code = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(2, -1).T).view("<u2").ravel()
        keys, values = tables[row["lang"]]
        asked = grams(code, sizes)
        at = np.searchsorted(keys, asked)
        if (at >= len(keys)).any() or (keys[at] != asked).any():
            raise RuntimeError("a block was cut differently when its texts were read again")
        count = sizes - ORDER + 1
        total = np.add.reduceat(values[at], offsets_of(count)[:-1])
        out.append(pa.table({
            "doc_id": pa.array(row["ids"], pa.int64()), "lang": pa.array([row["lang"]] * len(sizes)),
            "n_symbols": pa.array(count), "log10_prob": pa.array(total, from_pandas=True)}))
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("n_symbols", pa.int64()), ("log10_prob", pa.float64())])
    return pa.concat_tables(out) if out else schema.empty_table()


def perplexities(documents: DataFrame, labels: DataFrame, held_out_fold: int = 0) -> DataFrame:
    """(doc_id, lang, n_symbols, log10_prob) of every row, by a model of trusted text."""
    docs = pick(documents, "doc_id", "text", "lang").select(
        F.col("doc_id").cast("long"), "text", F.coalesce("lang", F.lit(NO_LANG)).alias("lang"))
    good = stored(_trusted(labels).where(fold_of(F.col("doc_id")) != held_out_fold), "kn-trusted")
    if good.count() <= SENT_IDS:
        # Safe to send to every task, and the texts need not be shuffled.
        good = F.broadcast(good)
    model = fit(docs.join(good, "doc_id", "left_semi"))
    asked = stored(_asked(docs), "kn-asked")
    answers = stored(probabilities(asked.select("lang", "gram").distinct(), model), "kn-answers")
    known = asked.join(answers, ["lang", "gram"])
    return known.groupBy("block").cogroup(_sent(docs).groupBy("of")).applyInArrow(
        _judge, "doc_id long, lang string, n_symbols long, log10_prob double")


def _trusted(labels: DataFrame) -> DataFrame:
    return pick(labels, "doc_id", "quality").where(
        F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality")).where("quality = 1").select("doc_id")


def classify(
    documents: DataFrame, labels: DataFrame, low: float = LOW, high: float = HIGH,
) -> DataFrame:
    """doc_id, lang, held_out, n_symbols, perplexity, lowest, highest, kept for every row."""
    scored = stored(perplexities(documents, labels).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_symbols"))), "kn-scored")
    trusted = scored.join(_trusted(labels), "doc_id", "left_semi")
    # A row per language, stored so that the join knows its size before it deals out the texts.
    bounds = stored(trusted.groupBy("lang").agg(F.percentile_approx(
        "perplexity", F.array(F.lit(low), F.lit(high)), F.lit(20_000)).alias("q")).select(
        "lang", F.get("q", F.lit(0)).alias("lowest"), F.get("q", F.lit(1)).alias("highest")), "kn-bounds")
    kept = reduce(Column.__and__, [F.col("perplexity") >= F.col("lowest"), F.col("perplexity") <= F.col("highest")])
    return scored.join(bounds, "lang", "left").select(
        "doc_id", F.when(F.col("lang") != NO_LANG, F.col("lang")).alias("lang"),
        F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "n_symbols", "perplexity", "lowest", "highest", F.coalesce(kept, F.lit(True)).alias("kept"))
