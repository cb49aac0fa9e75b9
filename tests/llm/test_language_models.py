"""The hidden Markov model, the Kneser-Ney model and the packing against plain versions."""

import collections
import itertools
import zlib

import numpy as np
import pytest

from courtlake.llm import hidden_markov, kneser_ney, packing

WORDS = {"en": "the of and to in a is that".split(), "de": "der die und in den von zu das".split()}


@pytest.fixture(scope="module")
def documents(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(80):
        lang = ("en", "de")[i % 2]
        rows.append((i, " ".join(rng.choice(WORDS[lang], 30)) + f" w{i}", lang, 0))
    rows += [(100, None, "en", 0), (101, "", "en", 0), (102, " \t\n", "de", 0), (None, "the of", None, 0),
             (103, "THE Of\x0bthe", "en", 0), (103, "THE Of\x0bthe", "en", 0), (104, "the " * 5000, "fr", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, block int")


def test_base_and_known(documents):
    source = documents.collect()
    tokens = {id(r): (r.text or "").encode().lower().split() + [b""] for r in source}
    held = {id(r): r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1 for r in source}
    count = collections.Counter(t for r in source if not held[id(r)] for t in tokens[id(r)])
    total, distinct = sum(count.values()), len(count)
    expected = sorted(((
        r.doc_id, held[id(r)], len(tokens[id(r)]), sum(t in count for t in tokens[id(r)]), total,
        sum(np.log10((count[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens[id(r)])
    ) for r in source), key=repr)
    got = hidden_markov.score(documents).collect()
    found = sorted((tuple(r)[:6] for r in got), key=repr)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    assert np.allclose([r[5] for r in found], [r[5] for r in expected])
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_no_documents(documents):
    assert hidden_markov.score(documents.limit(0)).collect() == []


def test_recursion_is_exact():
    rng = np.random.default_rng(3)
    emit, first, move = rng.random((5, 3)), rng.random(3), rng.random((3, 3))
    texts = [rng.integers(0, 5, n) for n in (4, 1, 6, 2)]
    line = hidden_markov.Timeline(np.concatenate(texts), np.array([4, 1, 6, 2]))
    alpha, scale = line.forward(emit, first, move)
    found = line.sum_by_text(np.log(scale))
    gamma, moves, firsts, _ = line.expect(emit, first, move)
    expected_moves = np.zeros((3, 3))
    for text, value in zip(texts, found):
        paths = {}
        for path in itertools.product(range(3), repeat=len(text)):
            p = first[path[0]] * emit[text[0], path[0]]
            for a, b, t in zip(path, path[1:], text[1:]):
                p *= move[a, b] * emit[t, b]
            paths[path] = p
        total = sum(paths.values())
        assert np.isclose(value, np.log(total))
        for path, p in paths.items():
            for a, b in zip(path, path[1:]):
                expected_moves[a, b] += p / total
    assert np.allclose(moves, expected_moves) and np.isclose(firsts.sum(), 4) and np.allclose(gamma.sum(axis=1), 1)


def test_kneser_ney_probabilities_add_up(spark, documents):
    model = kneser_ney.fit(documents.where("lang = 'en'").select("lang", "text").na.fill(""))
    bits = kneser_ney.BITS
    context = int(kneser_ney.grams(*kneser_ney.symbols(["the"]))[1]) & ((1 << 3 * bits) - 1)
    every = [np.array((context << bits) | i, np.uint64).astype(np.int64).item() for i in range(1 << bits)]
    asked = spark.createDataFrame([("en", g) for g in every], "lang string, gram long")
    total = sum(10**r.logp for r in kneser_ney.probabilities(asked, model).collect())
    assert abs(total - 1) < 1e-9


def plain_kneser_ney(texts):
    """p(symbol | context) of interpolated modified Kneser-Ney over tuples, straight from its definition."""
    order, counts = kneser_ney.ORDER, {}
    top = collections.Counter()
    for t in texts:
        code = kneser_ney.symbols([t])[0].tolist()
        top.update(tuple(code[i : i + order]) for i in range(len(code) - order + 1))
    counts[order] = top
    for n in range(order - 1, 0, -1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])
    discounts = {}
    for n, table in counts.items():
        n1, n2, n3, n4 = (sum(v == i for v in table.values()) for i in (1, 2, 3, 4))
        y = n1 / max(n1 + 2 * n2, 1)
        raw = [i - (i + 1) * y * b / max(a, 1) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        discounts[n] = [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]

    def p(gram, symbol=None):
        n, symbol = len(gram), gram[-1] if symbol is None else symbol
        if n == 0:
            common, alphabet = kneser_ney.COMMON, kneser_ney.ALPHABET
            return 1 / alphabet if symbol < common else (1 - common / alphabet) / (65536 - common)
        same = {g: c for g, c in counts[n].items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:], symbol)
        cut = lambda c: discounts[n][min(c, 3) - 1]
        total, left = sum(same.values()), sum(map(cut, same.values()))
        own = max(same[gram] - cut(same[gram]), 0) if gram in same else 0.0
        return own / total + left / total * p(gram[1:], symbol)

    return p


def test_against_plain_kneser_ney(spark):
    texts = ["the cat and the hat", "that cat", "а кот и код", "猫と犬、猫", "กขก กข", "the the the", "", "한국어 한국"]
    model = kneser_ney.fit(spark.createDataFrame([("x", t) for t in texts], "lang string, text string"))
    p = plain_kneser_ney(texts)
    asked = {}
    for t in [*texts, "the dog", "кот cat", "犬猫", "zzz", "\U0001F600\U0001F601", "국한"]:
        code, sizes = kneser_ney.symbols([t])
        for i, gram in enumerate(kneser_ney.grams(code, sizes).tolist()):
            asked[gram] = tuple(code[i : i + kneser_ney.ORDER].tolist())
    found = kneser_ney.probabilities(
        spark.createDataFrame([("x", g) for g in asked], "lang string, gram long"), model).collect()
    assert len(found) == len(asked)
    for r in found:
        assert abs(r.logp - np.log10(p(asked[r.gram]))) < 1e-9


def test_quality(spark, documents):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(70)] + [(3, 0, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    shout = spark.createDataFrame([(500, "XX!! YY!! ZZ!! QQ!!", "en", 0)], documents.schema)
    got = kneser_ney.classify(documents.union(shout), labels).collect()
    assert len(got) == documents.count() + 1
    by = {r.doc_id: r for r in got}
    assert not by[500].kept and by[104].kept and by[104].perplexity is None
    assert sum(r.kept for r in got if r.doc_id is not None and r.doc_id < 80) >= 76
    assert kneser_ney.classify(documents.limit(0), labels).collect() == []


@pytest.mark.parametrize("sent", [0, 1_000_000])
def test_every_trusted_text_is_learned(spark, monkeypatch, sent):
    """More labelled good rows than the 40,000 that the model was once fitted on."""
    docs = spark.range(50_200).selectExpr("id AS doc_id", "'a' AS text", "'en' AS lang")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 1000 > 0 AS int) AS quality")
    expected = sum(i % 1000 > 0 and zlib.crc32(str(i).encode()) % 5 != 0 for i in range(50_200))
    learned = []

    class Fitted(Exception):
        pass

    def fit(trusted):
        learned.append(trusted.count())
        raise Fitted

    monkeypatch.setattr(kneser_ney, "fit", fit)
    monkeypatch.setattr(kneser_ney, "SENT_IDS", sent, raising=False)
    with pytest.raises(Fitted):
        kneser_ney.perplexities(docs, labels)
    assert learned == [expected] and expected > 40_000


def test_symbols():
    code, sizes = kneser_ney.symbols(["a \n b", None, ""])
    assert code.tolist() == [0, 0, 0, 97, 32, 98, 1, 0, 0, 0, 1, 0, 0, 0, 1] and sizes.tolist() == [7, 4, 4]
    assert len(kneser_ney.grams(code, sizes)) == 6
    code, _ = kneser_ney.symbols(["中刬กข"])
    assert len(set(code.tolist()[3:7])) == 4


def test_packing(documents):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("word_bpe_49k.json"))
    packed = packing.pack(documents, with_ids=True)
    got = packed.collect()
    expected = []
    for r in documents.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        for n, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            expected.append((r.doc_id, n, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), part))
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(expected, key=repr)
    at = collections.defaultdict(list)
    for r in got:
        at[r.sequence_id].append((r.offset, r.length))
    for parts in at.values():
        ends = 0
        for offset, length in sorted(parts):
            assert offset == ends
            ends += length
        assert ends <= 4096
    assert len(at) == -(-sum(len(p[5]) for p in expected) // 4096)
    rows = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in rows) == sum(len(p[5]) for p in expected)
    assert packing.pack(documents.limit(0)).collect() == []


def test_words_alone_give_the_ids_of_the_text():
    tokens = packing.WordTokens(None)
    texts = ["It's a-b naïve, İstanbul x*** THE!! don't 12.5%  é é 😀 ﬁ", "", "áb ... ''s"]
    ids, ends = tokens.encode([t.encode() for t in texts], 1)
    for i, t in enumerate(texts):
        expected = tokens.tokenizer.encode(t, add_special_tokens=False).ids + [1]
        assert ids[ends[i] : ends[i + 1]].tolist() == expected


def test_two_replace_the_smallest():
    counts = np.zeros(11, int)
    counts[[7, 2, 3]] = 1, 1, 1
    counts[6] = 0
    assert packing.plan(counts, 10) == [({7: 1, 3: 1}, 1), ({2: 1}, 1)]
    counts = np.zeros(101, int)
    counts[[50, 30, 25, 24]] = 1, 1, 1, 1
    # Greedy: 50 + 30; then 30 gives way to 25 + 24, which fill 49 of 50.
    assert packing.plan(counts, 100)[0] == ({50: 1, 25: 1, 24: 1}, 1)
    left = np.random.default_rng(0).integers(0, 50, 65)
    left[0] = 0
    used = np.zeros(65, int)
    for pattern, times in packing.plan(left, 64):
        assert sum(n * k for n, k in pattern.items()) <= 64
        for n, k in pattern.items():
            used[n] += k * times
    assert (used == left).all()


def test_rounds_cover_the_corpus(spark, monkeypatch):
    """A sample of one language: words and states of the other come from the rounds over all texts."""
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice([*WORDS["en"], *WORDS["de"]] if i % 4 else WORDS["de"], 40)) for i in range(60)]
    texts[7] = " ".join(rng.choice(WORDS["de"], 6000))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(hidden_markov, "SAMPLE", 3)
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 1 for i in range(60)])
    marked = docs.withColumn("held_out", hidden_markov.fold_of(docs.doc_id) == 1)
    start, states = hidden_markov.fit_start(marked, 3), 3
    words, codes, lengths = hidden_markov._encoded(texts)
    doc = np.repeat(np.arange(60), lengths)
    emit, first, move = start.rows(words), start.first, start.move
    line = hidden_markov.Timeline(codes[~held[doc]], lengths[~held])
    seen = np.bincount(line.codes, minlength=len(words))
    base = (seen + 0.5) / (seen.sum() + 0.5 * ((seen > 0).sum() + 1))
    unknown = 0.5 / (seen.sum() + 0.5 * ((seen > 0).sum() + 1))
    expected = {}
    for number in range(1, 5):
        alpha, moves, firsts, _ = line.expect(emit, first, move)
        gamma = np.stack([np.bincount(line.codes, alpha[:, k], len(words)) for k in range(states)], axis=1)
        emit = 0.95 * gamma / gamma.sum(axis=0) + 0.05 * base[:, None] / (1 - unknown)
        emit = np.where(seen[:, None] > 0, emit * (1 - unknown), unknown)
        first = (firsts + 0.1) / (firsts + 0.1).sum()
        move = (moves + 0.1) / (moves + 0.1).sum(axis=1, keepdims=True)
        whole = hidden_markov.Timeline(codes, lengths)
        expected[number] = whole.sum_by_text(np.log10(whole.forward(emit, first, move)[1]))
    by = {n: [r.score for r in sorted(hidden_markov.score(docs, 3, rounds=n).collect())] for n in (1, 4)}
    for n, found in by.items():
        assert np.allclose(found, expected[n], rtol=2e-3)
    assert np.array(by[4])[~held].sum() > np.array(by[1])[~held].sum() + 1
    got = [r.score for r in sorted(hidden_markov.score(docs, 3).collect())]
    assert np.allclose(got, expected[hidden_markov.CORPUS_ROUNDS], rtol=2e-3)
    assert not np.allclose(got, expected[1], rtol=2e-3)


def test_long_texts_are_in_the_start(spark):
    docs = spark.createDataFrame([(i, "the of ü " * 3000, False) for i in range(9)], "doc_id long, text string, held_out boolean")
    assert b"the" in hidden_markov.fit_start(docs).place
