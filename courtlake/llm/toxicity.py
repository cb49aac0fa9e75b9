"""Toxicity by a support vector machine over a string kernel.

The kernel of two words is the gap-weighted subsequence kernel of order three: every triple of
letters that both hold in this order counts, with ``DECAY`` to the power of the span it covers,
so inserted characters ("i-d.i o_t") cost little. Accents and digit look-alikes fold into
letters, other signs are gaps, and runs of single letters are read as one word. Kernel values
are divided by the norms of both words.

Words may also run across white space ("i - d - i - o - t", "i, d, i", "id io t"). Tokens of one
to ``PIECE`` letters are pieces, tokens of signs alone are gaps, and every window of consecutive
pieces is read as one word if less than half of its characters are in ordinary short words of
clean texts ("to do it") and at least half are letters. Three letters in pieces are one triple
and near to much, so they count only if they are a toxic word of the training texts.

A sentence, and a text, is as toxic as its worst word or phrase (multiple-instance learning): training
instances are the words that stand out in labelled toxic texts, weighted by the number of texts
they occur in, against words of clean texts, among them the worst ones of a first model. If at
least ``MISSED`` of the toxic texts hold none of these words, they are searched for phrases of two or three words that stand out;
where there are some, every window of as many words is read as one long word. The
machine is linear on Nyström features of a few landmark words. As its decision value is a sum
of kernel values with landmarks, it folds into one weight per letter triple; scoring is exact,
needs no landmark at run time, and is a pass without a shuffle. Latin letters have a weight for each
triple (the few without a base, such as sharp s, are nine kinds); triples with letters of other
scripts, each a kind of its own, share ``OTHER`` hashed weights.

Labels may be wrong: the words that stand out most show which share of clean labels hides
toxic texts, and the bound on a toxic word's share of clean texts is that much wider. If no word
passes, those that stand out most are taken as they are.

Null and empty texts have no word and score the least value. Repeated rows score alike. Without
labels of both classes there is no model and every score is 0; with both there always is one, if
need be one that knows their shares alone. Nothing but the text enters a score.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlake.llm.common import (
    bounded_batches, fold_of, free_name, mix64, offsets_of, pick, stored, text_slices,
    words_of,
)

ORDER = 3
DECAY = 0.6
#: Letters of a word are read in windows of this many, half overlapping.
WINDOW = 24
#: Bytes of text handled at once, words remembered at once.
SLICE_BYTES, CACHED_WORDS = 2 << 20, 200_000
#: A single letter counts as part of a spelled-out word in runs of at least this many.
SPELLED = 4
#: Letters of a token that may be a piece of a word. Windows of pieces are as long as the longest
#: toxic word of the training texts and SPARE letters; pieces are handled so many at once.
PIECE, SPARE, PIECES_AT_ONCE = 3, 2, 100_000

#: Bounds of the labelled sample that the classifier is fitted on, rows of each class.
SAMPLE_TOXIC, SAMPLE_CLEAN = 6_000, 12_000
LANDMARKS, POSITIVE_WORDS, NEGATIVE_WORDS = 128, 600, 3_000
#: Mean cost of a training word on the wrong side.
PENALTY = 10.0
#: Standard errors by which a word's share of toxic texts must exceed that of clean ones.
STANDS_OUT = 4.0
#: A toxic word's share of clean texts is at most this part of its share of toxic ones.
PURE = 0.02
#: A short word in at least this share of the clean texts is ordinary; the most frequent ones.
ORDINARY, ORDINARY_WORDS = 0.005, 2_000

# Digits and signs that stand for letters.
LOOKS_LIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}

#: Kinds with a weight for each triple: gaps, Latin letters, digits.
KINDS = 37
#: Latin letters lie below this.
LATIN = 0x250
#: Hashed weights of triples that hold other letters.
OTHER = 1 << 18
#: Words that show the share of wrong labels, and the widest bound that may follow from it.
WITNESSES, LEAST_PURE = 20, 0.5
#: Words of a phrase, texts that must hold it, and the share of toxic texts without a toxic word
#: from which phrases are looked for.
PHRASE, PHRASE_TEXTS, MISSED = (2, 3), 4, 0.05

_NO_SIGNS = re.compile(r"[^\w]|_")
_NO_LETTERS = re.compile(r"[^\w@]|_")


def _piece(word: str) -> str | None:
    """The letters and digits of a short token, empty for signs alone; None for a longer word."""
    kept = word if word.isalnum() else _NO_LETTERS.sub("", word)
    return kept if len(kept) <= PIECE else None


def _kind(char: str) -> int:
    """0 is a gap, 1-26 Latin letters, 27-35 those without a base, 36 digits; others from KINDS on."""
    if char in LOOKS_LIKE:
        return ord(LOOKS_LIKE[char]) - 96
    if "0" <= char <= "9":
        return 36
    if not char.isalpha():
        return 0
    base = unicodedata.normalize("NFKD", char.lower())[0]
    if "a" <= base <= "z":
        return ord(base) - 96
    return 27 + ord(base) % 9 if ord(base) < LATIN else KINDS + ord(base)


_KINDS: np.ndarray | None = None


def _kinds_of(points: np.ndarray) -> np.ndarray:
    global _KINDS
    if _KINDS is None:
        _KINDS = np.array([_kind(chr(code)) for code in range(1 << 16)], np.int64)
    kinds = _KINDS[np.minimum(points, (1 << 16) - 1)]
    beyond = np.flatnonzero(points >= 1 << 16)
    if len(beyond):
        codes, place = np.unique(points[beyond], return_inverse=True)
        kinds[beyond] = np.array([_kind(chr(code)) for code in codes], np.int64)[place]
    return kinds


def kind_rows(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, matrix of letter kinds) for windows of equal length."""
    kinds = _kinds_of(np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = offsets_of(lengths)[:-1]
    number = np.arange(len(words))
    long = lengths > WINDOW
    if long.any():
        step = WINDOW // 2
        pieces = 1 + -(-(lengths[long] - WINDOW) // step)
        within = np.arange(int(pieces.sum())) - np.repeat(offsets_of(pieces)[:-1], pieces)
        first = np.repeat(starts[long], pieces) + within * step
        last = np.repeat(starts[long] + lengths[long], pieces)
        starts = np.concatenate([starts[~long], first])
        lengths = np.concatenate([lengths[~long], np.minimum(WINDOW, last - first)])
        number = np.concatenate([number[~long], np.repeat(np.flatnonzero(long), pieces)])
    for n in np.unique(lengths):
        if n >= ORDER:
            at = np.flatnonzero(lengths == n)
            yield number[at], kinds[starts[at][:, None] + np.arange(n)]


def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    where = np.array(list(itertools.combinations(range(n), ORDER)), np.int64).reshape(-1, ORDER)
    return where, DECAY ** (where[:, 2] - where[:, 0] + 1)


def _triple_keys(rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the triples at three places, and which hold no gap."""
    a, b, c = rows[:, at[0]], rows[:, at[1]], rows[:, at[2]]
    keys, valid = (a * KINDS + b) * KINDS + c, (a > 0) & (b > 0) & (c > 0)
    other = np.flatnonzero(valid & ((a >= KINDS) | (b >= KINDS) | (c >= KINDS)))
    if len(other):
        mixed = mix64(mix64(mix64(a[other]) + b[other].astype(np.uint64)) + c[other].astype(np.uint64))
        keys[other] = KINDS**ORDER + (mixed % np.uint64(OTHER)).astype(np.int64)
    return np.where(valid, keys, 0), valid


def self_kernel(rows: np.ndarray) -> np.ndarray:
    """k(w, w) for words of equal length, by the dynamic programme over prefixes."""
    size, n = rows.shape
    same = (rows[:, :, None] == rows[:, None, :]) & (rows[:, :, None] > 0)
    prefix = np.ones((size, n + 1, n + 1))
    total = np.zeros(size)
    for order in range(1, ORDER + 1):
        if order == ORDER:
            total = DECAY**2 * (same * prefix[:, :-1, :-1]).sum(axis=(1, 2))
            break
        following = np.zeros_like(prefix)
        for i in range(1, n + 1):
            run = np.zeros(size)
            for j in range(1, n + 1):
                run = DECAY * run + DECAY**2 * same[:, i - 1, j - 1] * prefix[:, i - 1, j - 1]
                following[:, i, j] = DECAY * following[:, i - 1, j] + run
        prefix = following
    return total


def windows_of(word: str) -> list[str]:
    """The windows in which a word is scored."""
    step = WINDOW // 2
    return [word[i : i + WINDOW] for i in range(0, max(1, len(word) - step), step)]


def features(word: str) -> dict[int, float]:
    """The unit vector of a word of one window in the space of letter triples."""
    out: dict[int, float] = {}
    for _, rows in kind_rows([word]):
        for at, weight in zip(*_triples(rows.shape[1])):
            keys, valid = _triple_keys(rows, at)
            if valid[0]:
                out[int(keys[0])] = out.get(int(keys[0]), 0.0) + weight
    norm = sum(v * v for v in out.values()) ** 0.5
    return {k: v / norm for k, v in out.items()} if norm else {}


@dataclass
class Model:
    """``weights``: one per letter triple; probability = logistic(slope * margin + shift).

    ``ordinary`` short words and ``toxic_words`` of the training texts tell which windows of
    pieces are read as one word.
    """

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    ordinary: frozenset[str] = frozenset()
    toxic_words: frozenset[str] = frozenset()
    #: Numbers of words in a window that is read as one word, besides single ones.
    phrases: tuple[int, ...] = ()

    def __post_init__(self) -> None:
        gaps = np.arange(KINDS**ORDER)
        gap = (gaps % KINDS == 0) | (gaps // KINDS % KINDS == 0) | (gaps // KINDS**2 == 0)
        self.weights[: KINDS**ORDER][gap] = 0.0

    def word_margins(self, words: list[str]) -> np.ndarray:
        """bias + the positive part of the kernel sum, for each word's worst window."""
        out = np.zeros(len(words))
        for numbers, every in kind_rows(words):
            where, decay = _triples(every.shape[1])
            other = (every >= KINDS).any(axis=1)
            slices = [(part, side) for side in (True, False) for part in np.array_split(
                np.flatnonzero(other != side), max(1, int((other != side).sum()) // 20_000)) if len(part)]
            for part, latin in slices:
                rows, number = every[part], numbers[part]
                linear = np.zeros(len(rows))
                if latin:
                    # Triples with a gap have weight 0: their numbers need no look at the gaps.
                    last = np.ascontiguousarray(rows.T, np.int32)
                    first, middle = last * (KINDS * KINDS), last * KINDS
                    for (i, j, k), weight in zip(where.tolist(), decay):
                        linear += weight * self.weights.take(first[i] + middle[j] + last[k])
                else:
                    for at, weight in zip(where, decay):
                        keys, valid = _triple_keys(rows, at)
                        linear += weight * self.weights[keys] * valid
                hot = np.flatnonzero(linear > 0)
                for part in np.array_split(hot, max(1, len(hot) // 2_000)):
                    if len(part):
                        norm = np.sqrt(self_kernel(rows[part]))
                        np.maximum.at(out, number[part], linear[part] / norm)
        return self.bias + out

    def margins(self, texts: list[str | None], cache: dict[str, float]) -> np.ndarray:
        words, codes, counts = words_of([t.lower() if t else None for t in texts])
        if len(cache) > CACHED_WORDS:
            cache.clear()
        new = [w for w in words if w not in cache]
        cache.update(zip(new, self.word_margins(new).tolist()))
        known = np.fromiter((cache[w] for w in words), float, len(words))
        ends = offsets_of(counts)
        out = np.full(len(texts), self.bias)
        some = counts > 0
        if some.any():
            out[some] = np.maximum.reduceat(known[codes], ends[:-1][some])
        self._spelled(words, codes, ends, out)
        self._pieced(words, codes, ends, out, cache)
        for size in self.phrases:
            self._phrased(words, codes, ends, out, cache, size)
        return out

    def _phrased(self, words, codes, ends, out, cache, size) -> None:
        """Every window of ``size`` words, joined into one; tokens of signs alone are no words."""
        bare = [_NO_SIGNS.sub("", w) for w in words]
        where = np.flatnonzero(np.fromiter(map(bool, bare), bool, len(bare))[codes])
        doc, codes = np.repeat(np.arange(len(out)), np.diff(ends))[where], codes[where]
        starts = np.flatnonzero(doc[: len(doc) - size + 1] == doc[size - 1 :]) if len(doc) >= size else np.zeros(0, int)
        for at in range(0, len(starts), PIECES_AT_ONCE):
            first = starts[at : at + PIECES_AT_ONCE]
            joined = ["".join([bare[c] for c in codes[i : i + size]]) for i in first]
            if len(cache) > CACHED_WORDS:
                cache.clear()
            new = list({w for w in joined if w not in cache})
            cache.update(zip(new, self.word_margins(new).tolist()))
            np.maximum.at(out, doc[first], np.fromiter((cache[w] for w in joined), float, len(joined)))

    def _spelled(self, words, codes, ends, out) -> None:
        """Runs of single letters, joined into words."""
        single = np.fromiter((len(w) == 1 and w.isalnum() for w in words), bool, len(words))
        if not single.any():
            return
        flags = np.zeros(len(codes) + 1, np.int8)
        flags[:-1] = single[codes]
        doc = np.repeat(np.arange(len(out)), np.diff(ends))
        breaks = np.flatnonzero(np.diff(doc)) + 1
        edges = np.diff(np.concatenate([[0], flags]))
        starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        runs = []
        for start, stop in zip(starts[stops - starts >= SPELLED], stops[stops - starts >= SPELLED]):
            inner = breaks[np.searchsorted(breaks, start, "right") : np.searchsorted(breaks, stop)]
            cuts = [start, *inner.tolist(), stop]
            runs += [(a, b) for a, b in itertools.pairwise(cuts) if b - a >= SPELLED]
        if runs:
            joined = ["".join(words[c] for c in codes[a:b]) for a, b in runs]
            np.maximum.at(out, doc[[a for a, _ in runs]], self.word_margins(joined))

    def _pieced(self, words, codes, ends, out, cache) -> None:
        """Windows of short tokens, joined into words."""
        longest = min(WINDOW, max(map(len, self.toxic_words), default=0) + SPARE)
        letters = [_piece(w) for w in words]
        size = np.fromiter((PIECE + 1 if w is None else len(w) for w in letters), np.int64, len(words))
        usual = np.fromiter((w is not None and len(w) > 1 and w in self.ordinary for w in letters), bool, len(words))
        alpha = np.fromiter((0 if w is None else sum(map(str.isalpha, w)) for w in letters), np.int64, len(words))
        # Tokens of signs alone are gaps; longer words and ends of texts part the runs.
        where = np.flatnonzero(size[codes] > 0)
        doc = np.searchsorted(ends, where, "right") - 1
        code = codes[where]
        long = size[code] > PIECE
        run = np.cumsum(long + np.append(0, np.diff(doc) != 0)) if len(code) else long
        whole, common, plain = (offsets_of(x[code].astype(np.int64)) for x in (size, size * usual, alpha))
        starts = np.flatnonzero(~long)
        for at in range(0, len(starts), PIECES_AT_ONCE):
            first = starts[at : at + PIECES_AT_ONCE]
            found: dict[str, list[int]] = {}
            for n in range(2, longest + 1):
                first = first[first + n <= len(code)]
                stop = first + n
                chars = whole[stop] - whole[first]
                on = (run[stop - 1] == run[first]) & ~long[stop - 1] & (chars <= longest)
                first, stop, chars = first[on], stop[on], chars[on]
                if not len(first):
                    break
                take = (2 * (common[stop] - common[first]) < chars) & (chars >= ORDER) & (
                    2 * (plain[stop] - plain[first]) >= chars)
                for a in first[take].tolist():
                    joined = "".join([letters[c] for c in code[a : a + n]])
                    if len(joined) > ORDER or joined in self.toxic_words:
                        found.setdefault(joined, []).append(a)
            if len(cache) > CACHED_WORDS:
                cache.clear()
            new = [w for w in found if w not in cache]
            cache.update(zip(new, self.word_margins(new).tolist()))
            for joined, places in found.items():
                if cache[joined] > self.bias:
                    np.maximum.at(out, doc[places], cache[joined])

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -500, 500)))


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Linear machine with hinge loss by dual coordinate ascent; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    square, alpha, w = (x * x).sum(axis=1), np.zeros(len(x)), np.zeros(x.shape[1])
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            step = alpha[i] - (y[i] * (x[i] @ w) - 1) / square[i]
            step = min(max(step, 0.0), cost[i])
            if step != alpha[i]:
                w += (step - alpha[i]) * y[i] * x[i]
                alpha[i] = step
    return w


def _fit_words(positive: dict[str, float], negative: dict[str, float]) -> Model:
    """Long words are trained on in every window that they are scored in."""
    found: dict[str, tuple[float, float, dict[int, float]]] = {}
    for side, words in ((1.0, positive), (-1.0, negative)):
        for word, count in words.items():
            for window in windows_of(word):
                if window not in found and (vector := features(window)):
                    found[window] = side, count, vector
    y, count = (np.array([v[i] for v in found.values()]) for i in (0, 1))
    if not (y > 0).any() or not (y < 0).any():
        return Model(np.zeros(KINDS**ORDER + OTHER), -1.0)
    # Only triples that occur have a row here.
    used = np.unique(np.concatenate([np.fromiter(v[2], np.int64) for v in found.values()]))
    matrix = [(np.searchsorted(used, np.fromiter(v[2], np.int64)), np.array(list(v[2].values()))) for v in found.values()]
    # Landmarks: the most frequent words of each class, two thirds of them toxic.
    lead = [i for i in np.argsort(-count, kind="stable") if y[i] > 0][: 2 * LANDMARKS // 3]
    rest = [i for i in np.argsort(-count, kind="stable") if y[i] < 0][: LANDMARKS - len(lead)]
    marks = np.zeros((len(used), len(lead + rest)))
    for column, i in enumerate(lead + rest):
        marks[matrix[i][0], column] = matrix[i][1]
    values, vectors = np.linalg.eigh(marks.T @ marks)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    mapped = np.stack([values @ marks[at] for at, values in matrix]) @ root
    cost = PENALTY * np.sqrt(count)
    for side in (1.0, -1.0):
        cost[y == side] /= cost[y == side].mean() / PENALTY
    w = _svm(mapped, y, cost)
    weights = np.zeros(KINDS**ORDER + OTHER)
    weights[used] = marks @ (root @ w[:-1])
    return Model(weights, float(w[-1]))


def _calibrate(model: Model, margins: np.ndarray, toxic: np.ndarray) -> None:
    """Logistic fit of text margins, with smoothed targets and the classes as they occur."""
    n1, n0 = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        g = np.array([((p - target) * margins).sum() + 1e-3 * a, (p - target).sum()])
        r = p * (1 - p)
        h = np.array([[(r * margins**2).sum() + 1e-3, (r * margins).sum()],
                      [(r * margins).sum(), r.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    model.slope, model.shift = max(a, 1e-6), b


def fit(
    documents: DataFrame,
    labels: DataFrame,
    sample_toxic: int = SAMPLE_TOXIC,
    sample_clean: int = SAMPLE_CLEAN,
    held_out_fold: int = 0,
) -> Model | None:
    """A model from at most ``sample_toxic`` + ``sample_clean`` labelled rows, whole texts.

    The sample is the labelled documents with the least hash of their id; ids of the held-out
    fold (crc32 of the id modulo 5) are never used. The driver holds the sample's ids, a
    bounded list of words, and one margin per sampled document. None without both classes.
    """
    marked = pick(labels, "doc_id", "toxic").where(
        F.col("toxic").isNotNull() & (fold_of(F.col("doc_id")) != held_out_fold)
    ).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    sample = marked.where("toxic = 1").orderBy(order, "doc_id").limit(sample_toxic).union(
        marked.where("toxic <> 1").orderBy(order, "doc_id").limit(sample_clean)
    )
    # At most sample_toxic + sample_clean ids: safe to send to every task.
    # Their texts are stored: fitting reads them several times, and the documents once.
    texts = stored(pick(documents, "doc_id", "text").join(F.broadcast(sample), "doc_id"), "toxicity-sample")

    words = texts.select("toxic", F.explode(F.array_distinct(
        F.split(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}\s]", ""), r"\s+")
    )).alias("word")).where("word <> ''")
    counted = stored(words.groupBy("word").agg(
        F.sum((F.col("toxic") == 1).cast("long")).alias("bad"),
        F.sum((F.col("toxic") != 1).cast("long")).alias("good"),
    ), "toxicity-words")
    totals = texts.agg(
        F.sum((F.col("toxic") == 1).cast("long")), F.sum((F.col("toxic") != 1).cast("long"))
    ).first()
    n1, n0 = (int(x or 0) for x in totals)
    if not n1 or not n0:
        return None
    share = (F.col("bad") + F.col("good")) / F.lit(float(n1 + n0))
    spread = F.sqrt(share * (1 - share + 1e-9) * F.lit(1 / n1 + 1 / n0))
    lift = (F.col("bad") / F.lit(float(n1)) - F.col("good") / F.lit(float(n0))) / spread
    # One text cannot tell a toxic word from a rare one.
    scored = counted.withColumn("lift", lift).where("bad + good > 1")
    short = scored.where(F.length("word").between(2, PIECE) & (F.col("good") >= F.lit(ORDINARY * n0)))
    counted, scored = counted.where("length(word) > 2"), scored.where("length(word) > 2")
    stands_out = scored.where((F.length("word") > 2) & (F.col("lift") >= STANDS_OUT))
    best = stands_out.orderBy(F.desc("lift"), "word").limit(WITNESSES).collect()
    pure = _purity([r.good * n1 / (r.bad * n0) for r in best])
    toxic_word = (F.col("lift") >= STANDS_OUT) & (
        F.col("good") * F.lit(n1) <= F.lit(pure * n0) * F.col("bad"))
    scored = scored.withColumn("toxic_word", toxic_word).withColumn("ordinary", F.lit(False))
    short = short.withColumn("toxic_word", toxic_word).withColumn("ordinary", F.lit(True))
    heads = (
        scored.where("toxic_word").orderBy(F.desc("lift"), "word").limit(POSITIVE_WORDS)
        .union(scored.where("lift < 1").orderBy(F.desc("good"), "word").limit(NEGATIVE_WORDS // 2))
        .union(scored.where("lift < 1").orderBy(F.xxhash64("word"), "word").limit(NEGATIVE_WORDS // 2))
        .union(short.where("not toxic_word").orderBy(F.desc("good"), "word").limit(ORDINARY_WORDS))
    ).collect()
    ordinary = frozenset(r.word for r in heads if r.ordinary)
    heads = [r for r in heads if not r.ordinary]
    short_toxic = short.where("toxic_word").limit(POSITIVE_WORDS).collect()
    positive = {r.word: float(r.bad) for r in heads if r.toxic_word}
    negative = {r.word: float(r.good + r.bad) for r in heads if not r.toxic_word}
    phrases = _phrases(texts, [*positive, *(r.word for r in short_toxic)], n1, n0, pure)
    positive |= {w: n for w, (_, n) in phrases.items()}
    if not positive:
        # No word is pure enough: those that stand out most, whatever clean texts say.
        most = scored.where("lift > 0").orderBy(F.desc("lift"), "word").limit(WITNESSES).collect()
        positive = {r.word: float(r.bad) for r in most}
        negative = {w: n for w, n in negative.items() if w not in positive}
    model = _fit_words(positive, negative)

    worst = _word_margins(counted.where(f"bad * {n0} <= good * {n1}").select("word"), model)
    for row in worst.orderBy(F.desc("margin"), "word").limit(NEGATIVE_WORDS // 2).collect():
        if row.word not in positive:
            negative.setdefault(row.word, 1.0)
    for size in sorted({size for size, _ in phrases.values()}):
        clean = _grams(_split_words(texts).where("toxic <> 1"), size).select(
            F.replace("gram", F.lit(" "), F.lit("")).alias("word")).distinct()
        for row in _word_margins(clean, model).orderBy(F.desc("margin"), "word").limit(NEGATIVE_WORDS // 2).collect():
            if row.word not in positive:
                negative.setdefault(row.word, 1.0)
    model = _fit_words(positive, negative)
    model.ordinary, model.toxic_words = ordinary, frozenset(w for w in positive if w not in phrases)
    model.phrases = tuple(sorted({size for size, _ in phrases.values()}))
    held = _margins(texts.select("toxic", "text"), model, "toxic", texts.schema["toxic"].dataType).collect()
    _calibrate(model, np.array([r.margin for r in held]), np.array([r.toxic == 1 for r in held]))
    return model


def _purity(shares: list[float]) -> float:
    """The bound on a toxic word's share of clean texts, as a part of its share of toxic ones.

    A word of toxic texts alone occurs in clean ones as often as labels are wrong, whatever the
    word: the median over the words that stand out most tells how often that is.
    """
    wrong = float(np.median(shares)) if shares else 0.0
    return min(LEAST_PURE, PURE + 2 * wrong) if wrong < LEAST_PURE else PURE


def _split_words(texts: DataFrame) -> DataFrame:
    plain = F.split(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}\s]", ""), r"\s+")
    return texts.select("toxic", F.filter(plain, lambda w: w != "").alias("words"))


def _grams(split: DataFrame, size: int) -> DataFrame:
    """(gram): the runs of ``size`` words of each text, each once, words parted by a space."""
    spots = F.sequence(F.lit(1), F.size("words") - (size - 1))
    every = F.when(F.size("words") >= size, F.transform(
        spots, lambda i: F.array_join(F.slice("words", i, F.lit(size)), " ")))
    return split.select(F.explode(F.array_distinct(every)).alias("gram"))


def _phrases(texts: DataFrame, words: list[str], n1: int, n0: int, pure: float) -> dict[str, tuple[int, float]]:
    """Phrases, joined, that stand out in the toxic texts without a toxic word: (words, texts).

    Counted in those few texts first; of the sample's clean texts only their phrases are counted.
    """
    split = _split_words(texts)
    # At most POSITIVE_WORDS and as many short words.
    known = F.array(*map(F.lit, words)).cast("array<string>")
    left = split.where((F.col("toxic") == 1) & ~F.arrays_overlap("words", known))
    out: dict[str, tuple[int, float]] = {}
    if left.count() < MISSED * n1:
        return out
    for size in PHRASE:
        often = _grams(left, size).groupBy("gram").agg(F.count(F.lit(1)).alias("bad")).where(
            F.col("bad") >= PHRASE_TEXTS).orderBy(F.desc("bad"), "gram").limit(POSITIVE_WORDS)
        bad = {r.gram: r.bad for r in often.collect()}
        if not bad:
            continue
        some = _grams(split.where("toxic <> 1"), size).where(F.col("gram").isin(list(bad)))
        good = {r.gram: r.n for r in some.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()}
        for gram, n in bad.items():
            clean = good.get(gram, 0)
            share = (n + clean) / (n1 + n0)
            lift = (n / n1 - clean / n0) / (share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12) ** 0.5
            if lift >= STANDS_OUT and clean * n1 <= pure * n0 * n:
                out.setdefault(gram.replace(" ", ""), (size, float(n)))
    return out


def _word_margins(words: DataFrame, model: Model) -> DataFrame:
    def run(batches):
        for batch in batches:
            values = batch.column("word").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), pa.array(model.word_margins(values))], ["word", "margin"])

    return words.mapInArrow(run, "word string, margin double")


def _margins(df: DataFrame, model: Model, keep: str, kind) -> DataFrame:
    from pyspark.sql.types import DoubleType, StructField, StructType

    def run(batches):
        cache: dict[str, float] = {}
        for part in text_slices(batches, "text", SLICE_BYTES):
            found = model.margins(part.column("text").to_pylist(), cache)
            yield pa.RecordBatch.from_arrays(
                [part.column(keep), pa.array(found)], [keep, "margin"])

    schema = StructType([StructField(keep, kind), StructField("margin", DoubleType())])
    return df.select(keep, "text").mapInArrow(run, schema)


def score(documents: DataFrame, model: Model | None, held_out_fold: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``documents``."""
    docs = pick(documents, "doc_id", "text")
    held = F.coalesce(fold_of(F.col("doc_id")) == held_out_fold, F.lit(False))
    if model is None:
        return docs.select("doc_id", held.alias("held_out"), F.lit(0.0).alias("score"),
                           F.lit(0).alias("predicted"))
    scored = _margins(docs, model, "doc_id", docs.schema["doc_id"].dataType)
    logit = F.lit(model.slope) * F.col("margin") + F.lit(model.shift)
    chance = 1 / (1 + F.exp(-logit))
    return scored.select(
        "doc_id", held.alias("held_out"), chance.alias("score"),
        (chance >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(documents: DataFrame, model: Model | None) -> DataFrame:
    """The rows whose text is not predicted toxic, all their columns; a pass without a shuffle."""
    if model is None:
        return documents
    bounded_batches(documents.sparkSession)
    text = free_name(documents, "judged_text")
    wide = documents.withColumn(text, pick_text(documents))
    names = wide.columns
    at = names.index(text)

    def run(batches):
        cache: dict[str, float] = {}
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, [f"c{i}" for i in range(len(names))])
            for part in text_slices(iter([batch]), f"c{at}", SLICE_BYTES):
                found = model.probability(
                    model.margins(part.column(at).to_pylist(), cache))
                part = part.filter(pa.array(found < 0.5))
                yield pa.RecordBatch.from_arrays(part.columns[:at], names[:at])

    return wide.mapInArrow(run, documents.schema)


def pick_text(documents: DataFrame):
    exact = [c for c in documents.columns if c == "text"] or [
        c for c in documents.columns if c.lower() == "text"]
    return documents[exact[0]]
