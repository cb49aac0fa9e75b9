"""Packing documents into sequences of a fixed length, best two fit.

A sequence is filled greedily, the longest document that fits first. Then its smallest document
gives way to two unpacked ones, if their sum fills the gap that its removal leaves more tightly;
that is repeated while it helps.

Which documents go together depends on their lengths alone, of which there are at most
``max_tokens``; so the plan is made on the driver from the number of pieces of each length, one
pattern at a time, repeated as often as the counts allow (what greedy filling would do, its
decisions being the same until a length runs out). Pieces are numbered within their length and
look their sequence up by that number. The plan is bounded by ``max_tokens``, whatever the data.

Only documents longer than a sequence are cut, into full pieces and a shorter last one. Null and
empty texts are the end token alone. Repeated rows are packed as often as they occur.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from courtlake.llm.common import offsets_of, pick, stored, text_slices, trim_memory, words_of

MAX_TOKENS, END_ID = 4096, 1
SLICE_BYTES, CACHED_WORDS = 12 << 20, 400_000
#: Letters, perhaps with signs after them: one word of the vocabulary's splitting, or two.
PLAIN = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+([!-&(-/:-@\[-`{-~]*)")
TOGETHER = 500
#: Parts of a length's numbering: counts of parts are chained, rows inside one are ordered.
PARTS = 256


class WordTokens:
    """Ids of whole texts from the ids of their words, each tokenised once while remembered.

    The vocabulary ignores white space and treats what lies between it independently, so a
    text's ids are those of its runs of other characters, one after the other.
    """

    def __init__(self, vocabulary: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if vocabulary is None:
            import public_tokenizers

            vocabulary = public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer = Tokenizer.from_file(vocabulary)
        known = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(known.values()) + 1, bool)
        self.is_end[[i for token, i in known.items() if token.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids, self.ends = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        """Ids of new words. Plain ones are tokenised many at a time, told apart by word ends."""
        texts = [w.decode("utf-8", "replace") for w in words]
        ends = [0 if (m := PLAIN.fullmatch(t)) is None else 1 + (m[1] != "") for t in texts]
        plain = [i for i, n in enumerate(ends) if n]
        others = [i for i, n in enumerate(ends) if not n]
        order, sizes, ids = [], [], []
        groups = [plain[i : i + TOGETHER] for i in range(0, len(plain), TOGETHER)]
        joined = self.tokenizer.encode_batch_fast(
            [" ".join([texts[i] for i in g]) for g in groups], add_special_tokens=False)
        for group, found in zip(groups, joined):
            flat = np.array(found.ids, np.uint32)
            last = np.flatnonzero(self.is_end[flat]) + 1
            closes = np.cumsum([ends[i] for i in group]) - 1
            if len(last) != closes[-1] + 1:
                others += group
                continue
            order += group
            sizes.append(np.diff(last[closes], prepend=0))
            ids.append(flat)
        single = self.tokenizer.encode_batch_fast([texts[i] for i in others], add_special_tokens=False)
        order += others
        sizes.append(np.fromiter((len(e.ids) for e in single), np.int64, len(single)))
        ids += [np.array(e.ids, np.uint32) for e in single]
        first = len(self.place)
        self.place.update((words[i], first + at) for at, i in enumerate(order))
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes))])
        self.ids = np.concatenate([self.ids, *ids])

    def encode(self, texts: list[bytes | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by ``end_id``, and where each text starts and ends)."""
        words, codes, counts = words_of(texts)
        if len(self.place) > CACHED_WORDS:
            self._clear()
        self._learn([w for w in words if w not in self.place])
        at = np.fromiter((self.place[w] for w in words), np.int64, len(words))
        # The end token is one more word, after the last of every text.
        begins = np.append(self.ends[at], len(self.ids))
        sizes = np.append(self.ends[at + 1] - self.ends[at], 1)
        codes = np.insert(codes, offsets_of(counts)[1:], len(words))
        size = sizes[codes]
        ends = offsets_of(size)
        take = np.arange(ends[-1]) + np.repeat(begins[codes] - ends[:-1], size)
        return np.append(self.ids, np.uint32(end_id))[take], ends[offsets_of(counts + 1)]


def _gathered(parts: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``limit`` bytes from smaller ones: a word is looked up once in each."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += part.nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


_TOKENS: dict[str | None, WordTokens] = {}


def _tokens(vocabulary: str | None) -> WordTokens:
    """One for each worker process, which serves many tasks and remembers their words."""
    if vocabulary not in _TOKENS:
        _TOKENS[vocabulary] = WordTokens(vocabulary)
    return _TOKENS[vocabulary]


def pieces(
    documents: DataFrame, max_tokens: int = MAX_TOKENS, end_id: int = END_ID,
    vocabulary: str | None = None, with_ids: bool = False, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document's pieces."""
    docs = pick(documents, "doc_id", "text")
    fields = [StructField("doc_id", docs.schema["doc_id"].dataType),
              StructField("piece", IntegerType()), StructField("start", LongType()),
              StructField("length", LongType()), StructField("ids_crc32", LongType())]
    if with_ids:
        fields.append(StructField("ids", ArrayType(IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim_memory()
        tokens = _tokens(vocabulary)
        for part in _gathered(text_slices(batches, "text", slice_bytes), slice_bytes):
            texts = part.column("text").cast(pa.binary()).to_pylist()
            ids, ends = tokens.encode(texts, end_id)
            ids = ids.astype("<u4")
            number = -(-np.diff(ends) // max_tokens)
            doc = np.repeat(np.arange(len(texts)), number)
            piece = np.arange(len(doc)) - offsets_of(number)[:-1][doc]
            start = piece * max_tokens
            length = np.minimum(max_tokens, np.diff(ends)[doc] - start)
            first = ends[:-1][doc] + start
            view = memoryview(ids.tobytes())
            crc = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist())]
            columns = [part.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()),
                       pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(
                    pa.array(offsets_of(length), pa.int32()), pa.array(ids.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return docs.mapInArrow(run, StructType(fields))


def plan(counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (how many pieces of each length) and how many sequences follow each.

    ``counts[n]`` is the number of pieces of length n, 0 < n <= capacity.
    """
    left = counts.astype(np.int64).copy()
    lengths = np.arange(capacity + 1)
    out = []
    while True:
        below = np.maximum.accumulate(np.where(left > 0, lengths, 0))
        if not below[-1]:
            return out
        used: dict[int, int] = {}
        gap, top = capacity, capacity
        while gap and (fit := int(below[min(gap, top)])):
            number = min(gap // fit, int(left[fit]))
            used[fit] = number
            gap -= number * fit
            top = fit - 1
        while gap and used:
            pair = _best_two(left, used, below, gap + min(used))
            if not pair:
                break
            small = min(used)
            gap += small - sum(pair)
            for n, change in ((small, -1), (pair[0], 1), (pair[1], 1)):
                used[n] = used.get(n, 0) + change
                if not used[n]:
                    del used[n]
        times = min(int(left[n]) // number for n, number in used.items())
        for n, number in used.items():
            left[n] -= times * number
        out.append((used, times))


def _best_two(left: np.ndarray, used: dict[int, int], below: np.ndarray, gap: int) -> tuple[int, int] | None:
    """The two unpacked lengths with the greatest sum up to ``gap``, if above the smallest used."""
    free = left[: gap + 1].copy()
    for n, number in used.items():
        if n <= gap:
            free[n] -= number
    lengths = np.arange(gap + 1)
    some = np.flatnonzero(free > 0)
    some = some[(some > 0) & (some < gap)]
    if not len(some):
        return None
    under = np.maximum.accumulate(np.where(free > 0, lengths, 0))
    other = under[gap - some]
    alone = (other == some) & (free[some] < 2)
    other = np.where(alone, under[np.maximum(some - 1, 0)], other)
    total = np.where(other > 0, some + other, 0)
    best = int(total.argmax())
    if total[best] <= min(used):
        return None
    return int(some[best]), int(other[best])


class _Lookup:
    """From a piece's length and number to its sequence and the place in it."""

    def __init__(self, patterns: list[tuple[dict[int, int], int]], capacity: int):
        taken = np.zeros(capacity + 1, np.int64)
        rows, sequence = [], 0
        for used, times in patterns:
            offset = 0
            for n, number in sorted(used.items(), reverse=True):
                rows.append((n, taken[n], number, sequence, offset))
                taken[n] += number * times
                offset += n * number
            sequence += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.length, self.first, self.number, self.sequence, self.offset = table.T
        self.reach = 1 + int(taken.max(initial=0))
        self.sequences = sequence

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.searchsorted(self.length, np.arange(int(self.length.max(initial=0)) + 2))
        at = np.empty(len(length), np.int64)
        for n in np.unique(length):
            mine = length == n
            low, high = starts[n], starts[n + 1]
            at[mine] = low + np.searchsorted(self.first[low:high], number[mine], side="right") - 1
        within = number - self.first[at]
        return (self.sequence[at] + within // self.number[at],
                self.offset[at] + within % self.number[at] * length)


def _numbered(table: DataFrame) -> DataFrame:
    """``number``: from 0 within the pieces of a length, however many share it."""
    cut = table.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(PARTS)))
    counts = cut.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    inside = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32")
    placed = cut.withColumn("_at", F.row_number().over(inside) - 1)
    return placed.join(counts.drop("_n"), ["length", "_part"]).withColumn(
        "number", (F.col("_start") + F.col("_at")).cast("long")).drop("_part", "_at", "_start")


def pack(
    documents: DataFrame, max_tokens: int = MAX_TOKENS, end_id: int = END_ID,
    vocabulary: str | None = None, with_ids: bool = False, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Every piece with the sequence it went to and its place there.

    ``vocabulary`` is the path of a tokenizer file that every executor has; by default that of
    the public word vocabulary. ``with_ids`` adds the pieces' ids, see ``sequences``.
    """
    table = stored(
        pieces(documents, max_tokens, end_id, vocabulary, with_ids, slice_bytes), "pieces")
    # One row per length: at most max_tokens rows.
    counted = table.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(max_tokens + 1, np.int64)
    for row in counted:
        counts[row["length"]] = row["n"]
    lookup = _Lookup(plan(counts, max_tokens), max_tokens)
    numbered = _numbered(table)
    schema = StructType([f for f in numbered.schema if f.name != "number"] + [
        StructField("sequence_id", LongType()), StructField("offset", LongType())])
    names = [f.name for f in schema][:-2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = lookup.find(
                batch.column("length").to_numpy(), batch.column("number").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"])

    return numbered.mapInArrow(run, schema).select(
        *table.columns, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of a packing made with ids: the training sequences themselves."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
