"""A hidden Markov language model over words, and the exact likelihood of every text under it.

Tokens are runs of characters other than ASCII white space, A-Z in lower case, and one end per
text. Baum-Welch runs over every training text, ``CORPUS_ROUNDS`` times: each task runs the
forward-backward recursion over its texts and emits expected counts per word, transition and
first state, which are summed over all tasks and give the next round's probabilities. So
vocabulary, counts, states and probabilities come from the whole corpus and grow with it.

Only the first round's probabilities, the start, are seeded by a bounded sample: the ``SAMPLE``
documents with the least hash of their id, of whatever length; of a text over ``SAMPLE_BYTES``
about that many bytes, from a place that the hash gives. They are clustered by their frequent
words, a state per cluster, and some rounds of Baum-Welch follow. Words that the sample lacks
share one probability per state in the first round, and have their own from the second on.

Texts are read once into blocks: one row of encoded texts, and one row for each distinct word of
a block. Counts are joined with these rows and not with the words of every text, and go back to
their blocks for the next round; at the end the scaled forward recursion gives each text's exact
probability. A frequent word makes a row per block, partly summed before the shuffle; no text or
vocabulary is ever in one place. Expected counts travel as whole numbers of 1/``UNIT``, so sums
do not depend on order.

The smoothed word frequencies (the base) leave a share for the unknown word, and every state
gives it the same. The rest of a state's distribution is, over the known words, ``1 - BLEND`` of
its expected counts and ``BLEND`` of the base; so each state's probabilities add up to one.

Null and empty texts are the end alone. Texts are scored row by row, repeated rows alike. Null
ids count as training rows. Without training rows every word has probability 1 by the base
formula, and the model equals it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlake.llm.common import (
    fold_of, hashed_sample, offsets_of, pick, stored, text_slices, words_of,
)

STATES = 6
SAMPLE, SAMPLE_BYTES, SAMPLE_WORDS = 3_000, 16_384, 50_000
STARTS, ROUNDS, BLEND, UNIT = 5, 8, 0.05, 1024
#: Rounds of Baum-Welch over all training texts; ROUNDS is on the sample.
CORPUS_ROUNDS = 3
SLICE_BYTES, BLOCK_BYTES = 2 << 20, 16 << 20
#: Tokens whose state probabilities are in memory at once; a longer text is alone.
GROUP_TOKENS = 1 << 18
END = b""


class Timeline:
    """Texts of different lengths laid out step by step, the longest first in every step."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        rank = np.empty(len(lengths), np.int64)
        rank[self.order] = np.arange(len(lengths))
        steps = int(lengths.max(initial=0))
        self.active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(steps), side="right")
        self.starts = offsets_of(self.active)
        step = np.arange(len(codes)) - np.repeat(offsets_of(lengths)[:-1], lengths)
        self.place = self.starts[step] + np.repeat(rank, lengths)
        self.codes = np.empty_like(codes)
        self.codes[self.place] = codes

    def forward(self, emit: np.ndarray, first: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scaled state probabilities of every token, and the scale: its probability so far."""
        alpha = emit[self.codes]
        scale = np.empty(len(self.codes), emit.dtype)
        before = None
        for start, stop in zip(self.starts[:-1].tolist(), self.starts[1:].tolist()):
            now = alpha[start:stop]
            now *= first if before is None else before[: stop - start] @ move
            total = now.sum(axis=1, out=scale[start:stop])
            now /= total[:, None]
            before = now
        return alpha, scale

    def expect(self, emit: np.ndarray, first: np.ndarray, move: np.ndarray):
        """(state probabilities of every token, transitions, first states, log likelihood)."""
        alpha, scale = self.forward(emit, first, move)
        moves = np.zeros(move.shape)
        behind = None
        for t in range(len(self.active) - 1, -1, -1):
            start, stop = self.starts[t], self.starts[t + 1]
            now = alpha[start:stop]
            if behind is None:
                beta = np.ones_like(now)
            else:
                n = len(behind)
                moves += now[:n].T @ behind
                beta = np.ones_like(now)
                beta[:n] = behind @ move.T
            weighted = emit[self.codes[start:stop]] * beta
            weighted /= scale[start:stop, None]
            now *= beta
            behind = weighted
        firsts = alpha[: self.active[0]].sum(axis=0) if len(self.active) else np.zeros(len(first))
        return alpha, moves * move, firsts, float(np.log(scale, dtype=np.float64).sum())

    def sum_by_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per token (in this layout), for each text in its given order."""
        rank = np.arange(len(values)) - np.repeat(self.starts[:-1], self.active)
        out = np.empty(len(self.order))
        out[self.order] = np.bincount(rank, weights=values, minlength=len(self.order))
        return out


def _groups(codes: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(texts, their codes) for texts of similar length, up to about GROUP_TOKENS together."""
    order = np.argsort(-lengths, kind="stable")
    ends, begins = np.cumsum(lengths[order]), offsets_of(lengths)[:-1]
    at = 0
    while at < len(order):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + GROUP_TOKENS, side="right")))
        texts = order[at:to]
        inner = offsets_of(lengths[texts])
        take = np.arange(inner[-1]) + np.repeat(begins[texts] - inner[:-1], lengths[texts])
        yield texts, codes[take]
        at = to


class Start:
    """The model of the sample: its frequent words, and one entry for all others."""

    def __init__(self, words: list[bytes], emit: np.ndarray, first: np.ndarray, move: np.ndarray):
        self.place = {w: i for i, w in enumerate(words)}
        self.emit, self.first, self.move = emit, first, move

    def rows(self, words: list[bytes]) -> np.ndarray:
        other = len(self.place)
        return self.emit[np.fromiter((self.place.get(w, other) for w in words), np.int64, len(words))]


def _encoded(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words, codes, lengths) with the end after every text; the end is the last word."""
    words, codes, counts = words_of([t.encode("utf-8", "replace").lower() if t else None for t in texts])
    return [*words, END], np.insert(codes, offsets_of(counts)[1:], len(words)), counts + 1


def _frequent(codes: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """A unit vector for each text: its frequent words, rare ones weighing more."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    top = np.flatnonzero(codes < size)
    tf = np.zeros((len(lengths), size), np.float32)
    np.add.at(tf, (doc[top], codes[top]), 1)
    tf = np.log1p(tf) * np.log(len(lengths) / np.maximum((tf > 0).sum(axis=0), 1) + 1)
    return tf / np.maximum(np.linalg.norm(tf, axis=1, keepdims=True), 1e-9)


def _clusters(tf: np.ndarray, states: int, seed: int) -> np.ndarray:
    """A cluster for each text, from centres drawn far from one another."""
    rng = np.random.default_rng(seed)
    centre = tf[rng.integers(len(tf))][None]
    while len(centre) < states:
        far = np.maximum(1 - (tf @ centre.T).max(axis=1), 0) + 1e-9
        centre = np.vstack([centre, tf[rng.choice(len(tf), p=far / far.sum())]])
    for _ in range(15):
        mine = np.argmax(tf @ centre.T, axis=1)
        centre = np.stack([tf[mine == k].mean(axis=0) if (mine == k).any() else centre[k] for k in range(states)])
        centre /= np.linalg.norm(centre, axis=1, keepdims=True).clip(1e-9)
    return mine


def fit_start(docs: DataFrame, states: int = STATES) -> Start:
    """The start model; the driver holds at most SAMPLE texts of about SAMPLE_BYTES each."""
    able = docs.where("not held_out").where(F.octet_length("text") > 0)
    chosen = hashed_sample(able, F.xxhash64("doc_id"), SAMPLE, "doc_id", "text")
    chars = F.char_length("text")
    piece = F.floor(chars * F.lit(SAMPLE_BYTES) / F.octet_length("text")).cast("int")
    begin = (F.pmod(F.xxhash64("doc_id", F.lit(1)), chars - piece + 1) + 1).cast("int")
    sample = chosen.select(F.when(F.octet_length("text") <= SAMPLE_BYTES, F.col("text")).otherwise(
        F.substring("text", begin, piece)).alias("text")).collect()
    words, codes, lengths = _encoded([r.text for r in sample])
    count = np.bincount(codes, minlength=len(words))
    order = np.argsort(-count, kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    size = min(SAMPLE_WORDS, len(words))
    codes = np.minimum(rank[codes], size)
    first, move = np.full(states, 1 / states), np.full((states, states), 0.02 / max(states - 1, 1))
    np.fill_diagonal(move, 0.98 if states > 1 else 1.0)
    if not sample:
        return Start([], np.ones((1, states)), first, move)
    seen = np.bincount(codes, minlength=size + 1)
    base = (seen + 0.5) / (seen + 0.5).sum()
    line, tf = Timeline(codes, lengths), _frequent(codes, lengths, min(2_000, size))

    def emissions(gamma: np.ndarray) -> np.ndarray:
        return (1 - BLEND) * gamma / gamma.sum(axis=0).clip(1e-9) + BLEND * base[:, None]

    def train(model: tuple, rounds: int) -> tuple:
        emit, first, move, _ = model
        for _ in range(rounds):
            alpha, moves, firsts, likelihood = line.expect(emit, first, move)
            emit = emissions(np.stack([
                np.bincount(line.codes, weights=alpha[:, k], minlength=size + 1)
                for k in range(states)], axis=1))
            first = (firsts + 0.1) / (firsts + 0.1).sum()
            move = (moves + 0.1) / (moves + 0.1).sum(axis=1, keepdims=True)
        return emit, first, move, likelihood

    # Baum-Welch finds the optimum near its start: a few short runs, the likeliest goes on.
    runs = []
    for seed in range(STARTS):
        gamma = np.zeros((size + 1, states))
        np.add.at(gamma, (codes, np.repeat(_clusters(tf, states, seed), lengths)), 1)
        runs.append(train((emissions(gamma), first, move, 0.0), 2))
    emit, first, move, _ = train(max(runs, key=lambda r: r[3]), ROUNDS)
    return Start([words[i] for i in order[:size]], emit, first, move)


def _pack_codes(codes: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed."""
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unpack_codes(data: bytes, size: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=4 * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(
        np.frombuffer(raw, np.uint8).reshape(4, size).T).view("<u4").ravel().astype(np.int64)


def _expected(
    codes: np.ndarray, lengths: np.ndarray, held: np.ndarray, emit: np.ndarray,
    first: np.ndarray, move: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(occurrences, expected counts of all states but the last) of a block's words in its
    training texts, transitions, first states."""
    train, states = codes[np.repeat(~held, lengths)], len(first)
    seen = np.bincount(train, minlength=len(emit))
    gamma = np.zeros((states - 1, len(emit)))
    moves, firsts = np.zeros((states, states)), np.zeros(states)
    first, move = first.astype(np.float32), move.astype(np.float32)
    for texts, part in _groups(train, lengths[~held]):
        line = Timeline(part, lengths[~held][texts])
        alpha, own_moves, own_firsts, _ = line.expect(emit, first, move)
        moves += own_moves
        firsts += own_firsts
        for k in range(states - 1):
            gamma[k] += np.bincount(line.codes, weights=alpha[:, k], minlength=len(emit))
    return seen, gamma, moves, firsts


class _Block:
    """Texts of one task up to about BLOCK_BYTES, with one numbering of their words."""

    def __init__(self):
        self.place: dict[bytes, int] = {}
        self.codes, self.lengths, self.ids, self.held, self.bytes = [], [], [], [], 0

    def add(self, part: pa.RecordBatch) -> None:
        words, codes, lengths = _encoded(part.column("text").to_pylist())
        own = np.fromiter((self.place.setdefault(w, len(self.place)) for w in words), np.int64, len(words))
        self.codes.append(own[codes].astype(np.int32))
        self.lengths.append(lengths)
        # A copy: a view would keep the whole batch, texts included, in memory.
        self.ids += part.column("doc_id").to_pylist()
        self.held.append(part.column("held_out").to_numpy(zero_copy_only=False))
        self.bytes += part.nbytes

    def rows(self, number: int, start: Start) -> Iterator[pa.RecordBatch]:
        codes, lengths = np.concatenate(self.codes), np.concatenate(self.lengths)
        held = np.concatenate(self.held).astype(bool)
        words = list(self.place)
        count = np.bincount(codes, minlength=len(words))
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words), dtype=np.int32)
        codes, words = rank[codes], [words[i] for i in order]
        emit = start.rows(words).astype(np.float32)
        seen, gamma, moves, firsts = _expected(codes, lengths, held, emit, start.first, start.move)
        payload = pa.array([_pack_codes(codes)], pa.large_binary()).cast(pa.binary())
        sums = np.concatenate([moves.ravel(), firsts])
        yield _row_batch({
            "block": pa.array([number], pa.int64()), "codes": payload,
            "ids": pa.array([self.ids], pa.list_(pa.int64())),
            "held": pa.array([held.tolist()], pa.list_(pa.bool_())),
            "lengths": pa.array([lengths.tolist()], pa.list_(pa.int32())),
            "sums": pa.array([sums.tolist()], pa.list_(pa.float64())),
        }, 1)
        for at in range(0, len(words), 20_000):
            to = min(at + 20_000, len(words))
            share = [np.rint(g[at:to] * UNIT).astype(np.int64).tolist() for g in gamma]
            yield _row_batch({
                "block": pa.array(np.full(to - at, number)),
                "word": pa.array(words[at:to], pa.binary()),
                "place": pa.array(np.arange(at, to), pa.int32()),
                "seen": pa.array(seen[at:to], pa.int64()),
                "share": pa.array(list(zip(*share)) if share else [()] * (to - at), pa.list_(pa.int64())),
            }, to - at)


_WORD_ROW = {
    "block": pa.int64(), "word": pa.binary(), "place": pa.int32(), "seen": pa.int64(),
    "share": pa.list_(pa.int64()), "codes": pa.binary(), "ids": pa.list_(pa.int64()),
    "held": pa.list_(pa.bool_()), "lengths": pa.list_(pa.int32()), "sums": pa.list_(pa.float64()),
}
_WORD_SCHEMA = (
    "block long, word binary, place int, seen long, share array<long>, codes binary, "
    "ids array<long>, held array<boolean>, lengths array<int>, sums array<double>")


def _row_batch(columns: dict[str, pa.Array], size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [columns.get(n, pa.nulls(size, kind)) for n, kind in _WORD_ROW.items()], list(_WORD_ROW))


def _blocks(docs: DataFrame, start: Start) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The same rows come in the same order when a task is run again, so blocks keep their
        # number and their words.
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for part in text_slices(batches, "text", SLICE_BYTES):
            block.add(part)
            if block.bytes >= BLOCK_BYTES:
                yield from block.rows(number, start)
                number, block = number + 1, _Block()
        if block.lengths:
            yield from block.rows(number, start)

    return docs.mapInArrow(run, _WORD_SCHEMA)


@dataclass
class _Model:
    """What a round over all training texts found, but for the counts of words."""

    tokens: int
    distinct: int
    mass: np.ndarray
    first: np.ndarray
    move: np.ndarray

    @staticmethod
    def of(tokens: int, distinct: int, shares: list, sums: np.ndarray) -> _Model:
        mass = np.array([float(x or 0) / UNIT for x in shares])
        mass = np.append(mass, max(tokens - mass.sum(), 0.0))
        states = len(mass)
        move = sums[: states * states].reshape(states, states) + 0.1
        first = sums[states * states :] + 0.1
        return _Model(tokens, distinct, mass, first / first.sum(), move / move.sum(axis=1, keepdims=True))

    def emissions(self, words: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(occurrences, base, probability in every state) of a block's words."""
        states = len(self.mass)
        below = self.tokens + 0.5 * (self.distinct + 1)
        seen, gamma = np.zeros(size), np.zeros((size, states))
        place = words.column("place").to_numpy()
        seen[place] = words.column("seen").to_numpy()
        for k in range(states - 1):
            gamma[place, k] = words.column(f"g{k}").to_numpy() / UNIT
        gamma[:, -1] = np.maximum(seen - gamma[:, :-1].sum(axis=1), 0)
        base = (seen + 0.5) / below
        unknown = 0.5 / below
        known = base / max(1 - unknown, unknown)
        emit = np.where(
            self.mass > 0,
            (1 - BLEND) * gamma / np.where(self.mass > 0, self.mass, 1) + BLEND * known[:, None],
            known[:, None]) * (1 - unknown)
        emit[seen == 0] = unknown
        return seen, base, emit


def _block_codes(block: pa.Table, at: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array(block.column("lengths")[at].as_py(), np.int64)
    return _unpack_codes(block.column("codes")[at].as_py(), int(lengths.sum())).astype(np.int32), lengths


def _next_round(places: DataFrame, counts: DataFrame, blocks: DataFrame, model: _Model, shares: list[str]) -> DataFrame:
    """(id, shares): expected counts of all training texts under the model, in 1/UNIT.

    Transitions and first states are in the first share of the ids -1, -2, ...
    """
    def run(words: pa.Table, block: pa.Table) -> pa.Table:
        found = [_no_counts(shares)]
        for at in range(block.num_rows):
            codes, lengths = _block_codes(block, at)
            held = np.array(block.column("held")[at].as_py(), bool)
            _, _, emit = model.emissions(words, int(codes.max()) + 1)
            seen, gamma, moves, firsts = _expected(
                codes, lengths, held, emit.astype(np.float32), model.first, model.move)
            place = words.column("place").to_numpy()
            own = np.flatnonzero(seen[place] > 0)
            sums = np.concatenate([moves.ravel(), firsts])
            ids = np.concatenate([words.column("id").to_numpy()[own], -1 - np.arange(len(sums))])
            columns = {"id": pa.array(ids)}
            for k, g in enumerate(shares):
                extra = sums if k == 0 else np.zeros(len(sums))
                columns[g] = pa.array(np.rint(
                    np.concatenate([gamma[k][place[own]], extra]) * UNIT).astype(np.int64))
            found.append(pa.table(columns))
        return pa.concat_tables(found)

    known = places.join(counts, "id").select("block", "place", "id", "seen", *shares)
    return known.groupBy("block").cogroup(blocks.groupBy("of")).applyInArrow(
        run, ", ".join(f"{c} long" for c in ("id", *shares))
    ).groupBy("id").agg(*[F.sum(g).alias(g) for g in shares])


def _no_counts(shares: list[str]) -> pa.Table:
    return pa.schema([(c, pa.int64()) for c in ("id", *shares)]).empty_table()


def score(
    documents: DataFrame, states: int = STATES, held_out_fold: int = 1, rounds: int = CORPUS_ROUNDS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    docs = pick(documents, "doc_id", "text")
    held = F.coalesce(fold_of(F.col("doc_id")) == held_out_fold, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long"), "text", held.alias("held_out"))
    table = stored(_blocks(docs, fit_start(docs, states)), "hmm-blocks")

    words = table.where("word is not null").select("block", "word", "place", "seen", "share")
    shares = [f"g{k}" for k in range(states - 1)]
    vocabulary = stored(words.where("seen > 0").groupBy("word").agg(
        F.sum("seen").alias("seen"),
        *[F.sum(F.get("share", F.lit(k))).alias(g) for k, g in enumerate(shares)]
    ).withColumn("id", F.monotonically_increasing_id()), "hmm-words")
    totals = vocabulary.agg(F.sum("seen"), F.count(F.lit(1)), *[F.sum(g) for g in shares]).first()
    tokens, distinct = int(totals[0] or 0), int(totals[1])
    blocks = table.where("codes is not null").select(
        F.col("block").alias("of"), "codes", "ids", "held", "lengths")
    size = states * states + states
    sums = table.where("sums is not null").agg(
        *[F.sum(F.get("sums", F.lit(i))) for i in range(size)]).first()
    model = _Model.of(tokens, distinct, totals[2:], np.array([float(x or 0) for x in sums]))

    # The words of a block by number: later rounds neither move nor compare strings.
    places = stored(words.select("word", "block", "place").join(
        vocabulary.select("word", "id", "seen"), "word").select("block", "place", "id", "seen"), "hmm-places")
    counts = vocabulary.select("id", *shares)
    for _ in range(rounds - 1 if states > 1 and tokens else 0):
        found = stored(_next_round(places, counts, blocks, model, shares), "hmm-counts")
        sums = np.zeros(size)
        for row in found.where("id < 0").collect():
            sums[-1 - row.id] = row[shares[0]] / UNIT
        counts = found.where("id >= 0")
        masses = counts.agg(*[F.sum(g) for g in shares]).first()
        model = _Model.of(tokens, distinct, masses, sums)

    def judge(words: pa.Table, block: pa.Table) -> pa.Table:
        found = []
        for at in range(block.num_rows):
            codes, lengths = _block_codes(block, at)
            seen, base, emit = model.emissions(words, int(codes.max()) + 1)
            known_words, score_of = np.zeros(len(lengths), np.int64), np.zeros(len(lengths))
            base_of = np.zeros(len(lengths))
            for texts, part in _groups(codes, lengths):
                line = Timeline(part, lengths[texts])
                _, scale = line.forward(emit, model.first, model.move)
                known_words[texts] = np.rint(line.sum_by_text((seen > 0)[line.codes]))
                base_of[texts] = line.sum_by_text(np.log10(base)[line.codes])
                score_of[texts] = line.sum_by_text(np.log10(scale))
            found.append(pa.table({
                "doc_id": pa.array(block.column("ids")[at].as_py(), pa.int64()),
                "held_out": pa.array(block.column("held")[at].as_py(), pa.bool_()),
                "n_tokens": pa.array(lengths), "n_known": pa.array(known_words),
                "train_tokens": pa.array(np.full(len(lengths), tokens)),
                "base_score": pa.array(base_of), "score": pa.array(score_of),
            }))
        return pa.concat_tables(found) if found else _EMPTY

    known = places.join(counts, "id").select("block", "place", "seen", *shares)
    return known.groupBy("block").cogroup(blocks.groupBy("of")).applyInArrow(
        judge, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
               "base_score double, score double")


_EMPTY = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
    ("score", pa.float64()),
]).empty_table()
