"""Near-duplicates, personal data, mixing, toxicity and the pipeline against plain versions."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from courtlake.llm import bagminhash, mixing, personal_data, toxicity

TEN = "one two three four five six seven eight nine ten"


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    for low, high in ((1, 2), (1, 40), (3, 9)):
        keys = rng.integers(0, 2**63, 120).astype(np.uint64)
        a, b = rng.integers(low, high, 120), rng.integers(low, high, 120)
        for weights, drop in ((a, 10), (b, 25)):
            weights[rng.choice(120, drop, replace=False)] = 0
        signs = [bagminhash.signatures(keys[w > 0], w[w > 0], np.array([(w > 0).sum()]), 2000)[0] for w in (a, b)]
        exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((signs[0] == signs[1]).mean() - exact) < 0.05


@pytest.mark.parametrize("similar,least", [(0.8, 0.999), (0.85, 1.0), (0.9, 1.0)])
def test_bands_find_pairs_at_the_threshold(similar, least):
    """The share of pairs of exactly that weighted Jaccard similarity that meet in a bucket."""
    rng = np.random.default_rng(int(similar * 100))
    pairs, rows, bands = 1500, bagminhash.ROWS, bagminhash.BANDS
    keys = rng.integers(0, 2**63, (pairs, 60)).astype(np.uint64)
    a = rng.integers(1, 4, (pairs, 60))
    b = a.copy()
    for x, y in zip(a, b):
        # Weights are taken off one by one until the next would fall below the threshold.
        for at in rng.permutation(np.repeat(np.arange(60), x)):
            y[at] -= 1
            if np.minimum(x, y).sum() / np.maximum(x, y).sum() < similar:
                y[at] += 1
                break
    signs = []
    for w in (a, b):
        on = w > 0
        signs.append(bagminhash.signatures(keys[on], w[on], on.sum(axis=1)))
    same = (signs[0] == signs[1]).reshape(pairs, bands, rows).all(axis=2).any(axis=1)
    assert same.mean() >= least


def copies():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(12):
        text = rng.choice(words, 80).tolist()
        for change in range(6):
            changed = list(text)
            for at in rng.choice(80, change // 2, replace=False):
                changed[at] = "new"
            rows.append((len(rows), " ".join(changed), "s", 1))
    rows += [(100, TEN, "a", 1), (100, TEN, "b", 1), (101, TEN.upper(), "c", 1), (102, None, "d", 1),
             (103, "", "e", 1), (104, " \n", "f", 1), (105, "short text", "g", 1), (106, "short  text", "h", 1),
             (107, "of of of of of of of of of", "i", 1), (108, "of of of of of of of of", "j", 1)]
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(copies(), "doc_id long, text string, mark string, rows int")


def expected_groups(rows, similar=0.8):
    bags = {}
    for i, text, *_ in rows:
        w = (text or "").lower().split()
        bags[i] = collections.Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else None
    part = {i: i for i in bags}
    for a in bags:
        for b in bags:
            if a < b and bags[a] and bags[b]:
                if (bags[a] & bags[b]).total() >= similar * (bags[a] | bags[b]).total() and part[a] != part[b]:
                    old, new = max(part[a], part[b]), min(part[a], part[b])
                    part = {i: new if p == old else p for i, p in part.items()}
    return part


def test_near_duplicates(table):
    expected = expected_groups(copies())
    got = bagminhash.near_duplicates(table).collect()
    assert {r.doc_id: r.component_id for r in got} == expected and len(got) == len(expected)
    assert {r.doc_id for r in got if r.kept} == set(expected.values())


def test_one_of_each_group_stays(table):
    stay = bagminhash.keep_one(table)
    assert stay.columns == table.columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted(set(expected_groups(copies()).values()))
    assert bagminhash.keep_one(table.limit(0)).collect() == []


def test_a_family_in_parts_loses_no_link(table, monkeypatch):
    monkeypatch.setattr(bagminhash, "GROUP_ITEMS", 100)
    got = bagminhash.near_duplicates(table).collect()
    assert {r.doc_id: r.component_id for r in got} == expected_groups(copies())


def test_parts_count_every_link_once(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = []
    for base in range(8):
        text = [f"b{base}w{i}" for i in rng.integers(0, 400, 60)]
        for change in range(2 + base % 3):
            rows.append((len(rows), " ".join([*text, *[f"x{i}" for i in range(change)]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bags = [collections.Counter(zip(*[t.split()[i:] for i in range(5)])) for _, t in rows]
    expected = [sum(i != j and (a & b).total() >= 0.8 * (a | b).total() for j, b in enumerate(bags))
                for i, a in enumerate(bags)]
    assert min(expected) == 1 and max(expected) == 3
    # One part, two (some of them empty), and more parts than texts.
    for items in (100_000, 100, 40):
        monkeypatch.setattr(bagminhash, "GROUP_ITEMS", items)
        got = {r.doc_id: r.n_links for r in bagminhash.near_duplicates(docs).collect()}
        assert [got[i] for i in range(len(rows))] == expected, items


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TRICKY = [
    "a@b.c_d@e.f", "a@b.c.@d.e x@y", "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.1.1.1", "0001.02.3.4",
    "4669 7017 6630 4244 and 4111-1111-1111-1111", "+1 (787) 555-1710 +44 20 7946 0958", "12 34 " * 50,
    "é ü 😀 a@b.co 😀 1.2.3.4", "", None, "1" * 20000, "a" * 20000 + "@", "a@b.c " * 300, "+" * 50 + "12345678901",
    "99999999999999999999.1.1.1", "+1 23 ((4567 890.12-",
]


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def test_base_spans(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TRICKY)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in personal_data.find(docs).collect()}
    for i, text in enumerate(TRICKY):
        spans = sorted((m.start(), rank, m.end(), kind) for rank, (kind, p) in enumerate(PLAIN.items())
                       for m in re.finditer(p, text or "") if valid(kind, m.group()))
        written = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert got[i].base_sha256 == hashlib.sha256(written.encode()).hexdigest(), text
        assert [got[i][f"n_{k}"] for k in PLAIN] == [sum(s[3] == k for s in spans) for k in PLAIN]
    assert personal_data.find(docs.limit(0)).collect() == []


def test_added_spans_and_masks(spark):
    rows = [(1, "pay GB82 WEST 1234 5698 7654 32 now", 0), (2, "pay GB83 WEST 1234 5698 7654 32 now", 0),
            (3, "ssn 123-45-6789" + " " * 50 + "123-45-6789", 0), (4, "call (212) 555-1234", 0),
            (5, "order 212-555-1234", 0), (6, "a@b.co 1.2.3.4", 0), (7, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    spans = {r.doc_id: r.spans for r in personal_data.find(docs).collect()}
    assert spans == {1: "iban:4:31", 2: "", 3: "ssn:4:15", 4: "local_phone:5:19", 5: "",
                     6: "email:0:6,ip:7:14", 7: ""}
    clean = {r.doc_id: (r.text, r.n_chars) for r in personal_data.masked(docs).collect()}
    assert clean[1][0] == "pay [IBAN] now" and clean[6] == ("[EMAIL] [IP]", 12) and clean[7] == (None, 5)
    assert personal_data.masked(docs).columns == docs.columns


def sources(spark):
    rows = [(i, "w " * (1 + i % 7), ("big" if i % 3 else None), 9) for i in range(300)]
    rows += [(300 + i, "w " * 5, f"s{i % 4}", 9) for i in range(60)] + [(400, None, "empty", 9), (401, "", "s1", 9)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, epoch int"), rows


def test_mixture_document_by_document(spark, monkeypatch):
    """Which rows are shown how often, against plain sums over sorted lists; equal rows and nulls included."""
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 40)
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 25))), rng.choice(["a"] * 8 + ["b", "c"])) for i in range(400)]
    rows += [(900 + i % 3, "same row " * 3, "b") for i in range(9)] + [(950, None, "c"), (951, "x y", None), (952, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    tokens = collections.Counter()
    for _, text, source in rows:
        tokens[source] += len((text or "").split())
    total = sum(tokens.values())
    mixed = mixing.mix(docs, target_entropy=0.9, budget_tokens=total).collect()

    # The exponent by halves, straight from the definition.
    def weights(e):
        power = {s: (n / total) ** e for s, n in tokens.items() if n}
        return {s: v / sum(power.values()) for s, v in power.items()}

    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        w = weights(middle)
        entropy = -sum(v * math.log(v) for v in w.values())
        low, high = (middle, high) if entropy >= 0.9 * math.log(len(w)) else (low, middle)
    weight = {r.source: r.source_weight for r in mixed}
    assert all(abs(weight[s] - v) < 1e-6 for s, v in weights(low).items())

    plan = {}
    for s, n in tokens.items():
        full, rest = divmod(math.floor(weight[s] * total), n)
        plan[s] = full, rest, max(1, -(-n // 40))
    keyed = spark.createDataFrame(
        [(i, d, t, s, *plan[s]) for i, (d, t, s) in enumerate(rows)],
        "n long, doc_id long, text string, source string, full int, rest long, blocks long")
    row = F.xxhash64(F.lit(1), "doc_id", "text")
    hashed = keyed.select(
        "n", mixing._block_place(F.col("source"), F.pmod(row, "blocks"), F.col("full"), 1).alias("place"),
        mixing._inner_place(row, F.col("full"), 1).alias("inner")).collect()
    unsigned = lambda x: x % 2**64
    expected = collections.Counter()
    for source, (full, rest, _) in plan.items():
        blocks = collections.defaultdict(lambda: collections.defaultdict(list))
        for h in hashed:
            if rows[h.n][2] == source:
                blocks[unsigned(h.place)][unsigned(h.inner)].append(h.n)
                expected[rows[h.n]] += full
        size = lambda ns: sum(len((rows[n][1] or "").split()) for n in ns)
        for place in sorted(blocks):
            members = [n for ns in blocks[place].values() for n in ns]
            if size(members) <= rest:
                rest -= size(members)
                expected.update(rows[n] for n in members)
                continue
            for inner in sorted(blocks[place]):
                if size(blocks[place][inner]) > rest:
                    break
                rest -= size(blocks[place][inner])
                expected.update(rows[n] for n in blocks[place][inner])
            break
    found = collections.Counter((r.doc_id, r.text, r.source) for r in mixed)
    assert found == +expected


def test_mixture_meets_its_weights(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 40)
    docs, rows = sources(spark)
    totals = collections.Counter()
    for _, text, source, _ in rows:
        totals[source] += len((text or "").split())
    whole, count = sum(totals.values()), sum(v > 0 for v in totals.values())
    mixed = mixing.mix(docs, target_entropy=0.9, max_repeats=3.0, budget_tokens=whole).collect()
    weights = {r.source: r.source_weight for r in mixed}
    entropy = -sum(w * math.log(w) for w in weights.values() if w)
    assert math.isclose(entropy, 0.9 * math.log(count), abs_tol=1e-6)
    ratios = [math.log(weights[a] / weights[b]) / math.log(totals[a] / totals[b])
              for a, b in (("big", None), ("big", "s0"))]
    assert math.isclose(*ratios, rel_tol=1e-6)
    got, seen = collections.Counter(), collections.Counter()
    for r in mixed:
        got[r.source] += r.n_tokens
        seen[r.doc_id, r._epoch] += 1
    assert max(seen.values()) == 1
    for source, tokens in totals.items():
        if tokens:
            assert weights[source] * whole - 7 <= got[source] <= weights[source] * whole + 1e-6
    assert seen[400, 0] == 1


def test_every_document_is_shown(spark):
    docs, rows = sources(spark)
    shown = collections.Counter(r.doc_id for r in mixing.mix(docs, max_repeats=1.5, places=False).collect())
    assert set(shown) == {r[0] for r in rows} and max(shown.values()) == 2
    assert mixing.mix(docs.limit(0), max_repeats=1.5, places=False).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(docs, max_repeats=1.5, budget_tokens=10**6)


def labelled(spark):
    rng = np.random.default_rng(1)
    words = "the of and to in is that for was on with by house river garden paper window".split()
    rows, labels = [], []
    for i in range(400):
        text = rng.choice(words, 30).tolist()
        toxic = i % 5 == 0
        if toxic:
            text[3], text[9] = rng.choice(["moron", "idiot", "scum"], 2)
        rows.append((i, " ".join(text), i % 3, "x"))
        labels.append((i, 1, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string, score int, c0 string"),
            spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int"))


def test_toxicity(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    odd = [(900, "you i-d-i-o-t you", 0, "x"), (901, "an i d i o t here", 0, "x"), (902, None, 0, "x"),
           (903, "", 0, "x"), (904, "the house " * 20000, 0, "x"), (905, "m.o.r.o.n!", 0, "x"), (906, "x" * 100_000, 0, "x")]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    truth = {r.doc_id: r.toxic for r in labels.where("toxic is not null").collect()}
    held = [i for i in range(400) if got[i].held_out]
    assert held and all(got[i].predicted == truth[i] for i in held)
    assert [got[i].predicted for i in range(900, 907)] == [1, 1, 0, 0, 0, 1, 0]
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted == 0}
    assert toxicity.fit(docs, labels.where("toxic = 0")) is None
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_words_across_white_space(spark):
    docs, labels = labelled(spark)
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    rows = [(i, t + " git git" if i % 10 == 0 else t, 0, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, docs.schema)
    model = toxicity.fit(docs, labels)
    assert "git" in model.toxic_words and "the" in model.ordinary
    toxic = ["i - d - i - o - t", "i * d * i * o * t", "i, d, i, o, t", "id io t", "m o r on", "g i t",
             "g. i. t.", "a b c m o r o n"]
    clean = ["J. R. R. T.", "J R R T K", "a, b, c, d, e", "A. B. C. D. E. F. G. H.", "to do it is in", "1 2 3 4 5 6 7 8",
             "4 5 5 1 0", "the git was here by 1 - 2 - 3".replace("git", "garden"), "- - - * * *", "i the o to", "j. s. b. and w. a. m."]
    given = [f"the house {t} by river" for t in toxic + clean] + ["s", "u m", "i d", "i o t"]
    cache = {}
    found = model.probability(model.margins(given, cache)) >= 0.5
    assert found[: len(toxic)].all(), [t for t, f in zip(toxic, found) if not f]
    assert not found[len(toxic) :].any(), [t for t, f in zip(given[len(toxic) :], found[len(toxic) :]) if f]
    many = model.margins(["x y " * 60_000 + "i - d - i - o - t", None, ""], cache)
    assert (model.probability(many) >= 0.5).tolist() == [True, False, False]


def relabelled(spark, insult, wrong=0.0, rows=600):
    """Texts of ordinary words; a fifth hold ``insult``, ``wrong`` of them are labelled clean."""
    rng = np.random.default_rng(5)
    ordinary = ["the", "house", "river", "garden", "of", "by", "window", "letter", "go", "back", "home", "to", "we",
                "they", "went", "came"]
    docs, labels, truth = [], [], {}
    for i in range(rows):
        text = rng.choice(ordinary, 14).tolist()
        truth[i] = int(i % 5 == 0)
        if truth[i]:
            text[int(rng.integers(13))] = insult
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(truth[i] and rng.random() >= wrong)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth)


@pytest.mark.parametrize("insult,wrong", [("moron", 0.2), ("moron", 0.05), ("дурак", 0.0), ("дурак", 0.2), ("笨蛋东西", 0.0)])
def test_wrong_labels_and_other_scripts(spark, insult, wrong):
    docs, labels, truth = relabelled(spark, insult, wrong)
    found = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    held = [i for i, r in found.items() if r.held_out]
    assert len(held) > 90 and all(found[i].predicted == truth[i] for i in held)


def test_phrase_of_ordinary_words(spark):
    docs, labels, truth = relabelled(spark, "go crawl back home")
    words = docs.withColumn("text", F.regexp_replace("text", "crawl", "we"))
    model = toxicity.fit(words, labels)
    assert model.phrases
    found = {r.doc_id: r for r in toxicity.score(words, model).collect()}
    held = [i for i, r in found.items() if r.held_out]
    right = [found[i].predicted == truth[i] for i in held]
    assert sum(found[i].predicted for i in held if truth[i]) >= 0.9 * sum(truth[i] for i in held)
    assert sum(right) >= 0.95 * len(right)


def test_labels_without_a_sign(spark):
    """Labels that follow nothing in the text still give a model, and few false alarms."""
    docs, labels, _ = relabelled(spark, "the")
    model = toxicity.fit(docs, labels)
    assert model is not None
    found = toxicity.score(docs, model).collect()
    assert sum(r.predicted for r in found) <= 0.05 * len(found)
    empty = docs.withColumn("text", F.lit(""))
    model = toxicity.fit(empty, labels)
    assert model is not None and {r.predicted for r in toxicity.score(empty, model).collect()} == {0}


def test_repeated_rows_score_alike(spark):
    docs, labels, _ = relabelled(spark, "moron")
    model = toxicity.fit(docs, labels)
    twice = docs.limit(30).union(docs.limit(30))
    scores = collections.defaultdict(set)
    for r in toxicity.score(twice, model).collect():
        scores[r.doc_id].add(r.score)
    assert {len(v) for v in scores.values()} == {1} and len(scores) == 30


def test_letters_of_other_scripts_are_kinds_of_their_own():
    kinds = {toxicity._kind(c) for c in "гмхюбд\u4e2d\u522c\U00020000"}
    assert len(kinds) == 9 and min(kinds) >= toxicity.KINDS
    assert toxicity._kind("É") == 5 and toxicity._kind("-") == 0 and toxicity._kind("\U0001F600") == 0
    rows = toxicity._kinds_of(np.array([ord("а"), ord("-"), 0x20000, 0x1F600], np.uint32))
    assert (rows > 0).tolist() == [True, False, True, False]


def test_margins_by_enumeration():
    """A margin is the worst window's normalised kernel sum, by plain enumeration of triples."""
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.normal(size=toxicity.KINDS**3 + toxicity.OTHER), -0.5)
    for word in ["moron", "m-o_ron", "дурак", "x" * 30 + "moronic" + "y" * 20, "ab", ""]:
        best = 0.0
        for window in toxicity.windows_of(word):
            by = collections.Counter()
            kinds = toxicity._kinds_of(np.array([ord(c) for c in window], np.uint32))
            for i in range(len(window)):
                for j in range(i + 1, len(window)):
                    for k in range(j + 1, len(window)):
                        if kinds[i] and kinds[j] and kinds[k]:
                            row = np.array([[kinds[i], kinds[j], kinds[k]]], np.int64)
                            key, _ = toxicity._triple_keys(row, np.array([0, 1, 2]))
                            by[tuple(row[0]), int(key[0])] += toxicity.DECAY ** (k - i + 1)
            norm = sum(v * v for v in by.values()) ** 0.5
            if norm:
                best = max(best, sum(v * model.weights[key] for (_, key), v in by.items()) / norm)
        assert math.isclose(model.word_margins([word])[0], model.bias + best, abs_tol=1e-9)


def test_kernel_by_enumeration():
    words = ["moron", "m-o_ron", "aab"]
    for word in words:
        (numbers, rows), = toxicity.kind_rows([word])
        value = toxicity.self_kernel(rows)[0]
        where, weight = toxicity._triples(rows.shape[1])
        by = collections.Counter()
        for at, w in zip(where, weight):
            key, ok = toxicity._triple_keys(rows, at)
            if ok[0]:
                by[int(key[0])] += w
        assert math.isclose(value, sum(v * v for v in by.values()))


def test_pipeline(spark, tmp_path):
    rows = [(r[0], r[1], "en", f"s{r[0] % 3}", len(r[1] or "")) for r in copies()]
    rows += [(500, "mail me at a@b.co please now", "en", "s1", 28), (501, "you moron idiot scum", "en", "s1", 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    _, labels = labelled(spark)
    texts, _ = labelled(spark)
    more = texts.select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit("en").alias("lang"),
                        F.lit("s2").alias("source"), F.length("text").cast("long").alias("n_chars"))
    docs.union(more).write.parquet(str(tmp_path / "documents.parquet"))
    labels.withColumn("doc_id", F.col("doc_id") + 1000).write.parquet(str(tmp_path / "labels.parquet"))
    given = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = given
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == given.columns, name
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert 501 not in texts and texts[500] == "mail me at [EMAIL] please now"
    assert set(texts) & set(range(110)) == set(expected_groups(copies()).values())
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(texts)


def test_pipeline_edges(spark, tmp_path):
    """Nulls, repeats, a very long text, clashing extra columns, an empty table."""
    texts, labels = labelled(spark)
    long = " ".join(np.random.default_rng(2).choice("the house by the river was small and old".split(), 40_000))
    odd = [(5000, None, None, None, None), (5001, "", "en", "", 0), (5002, long, "en", "s9", len(long)),
           (5003, "same row here", "en", "s9", 13), (5003, "same row here", "en", "s9", 13), (None, "no id at all", "en", "s8", 12)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long").union(
        texts.limit(40).select("doc_id", "text", F.lit("en"), F.lit("s2"), F.length("text").cast("long")))
    names = ["length", "piece", "spans", "score", "tokens", "block", "found", "epoch", "c0", "_c0"]
    docs = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    given = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept, empty = given, given.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        kept, empty = stage(spark, kept, str(tmp_path)), stage(spark, empty, str(tmp_path))
        if name != "packing":
            assert kept.columns == given.columns and kept.schema.simpleString() == given.schema.simpleString(), name
        path = str(tmp_path / f"stage-{name}")
        kept.write.parquet(path)
        kept = spark.read.parquet(path)
    assert empty.collect() == []
    found = collections.Counter(r.doc_id for r in kept.where("piece = 0").collect())
    assert {5000, 5001, 5002, 5003, None} <= set(found)
    assert kept.where("doc_id = 5002").count() > 1
