"""Personal data in texts: patterns propose spans, checksums confirm, nearby words decide.

Base kinds (email, ip, card, phone) are the leftmost non-overlapping matches of their pattern
that pass their test; they always stay. The method adds kinds that a pattern alone cannot tell:
account numbers confirmed by mod-97 (iban), and social security and local phone numbers, which
need a word such as "ssn" or "call" within ``NEARBY`` characters to reach ``ENOUGH``. Every span
has a score: its kind's, plus or minus what context words around it add.

DataFrame functions only. A pattern is scanned once for the matches, and once more, in texts
that have some, to split the text there: the lengths of the pieces give the places. Patterns
start only where a run of their characters starts, or where the last match ended, and take runs
possessively; so a long text costs time in proportion to its length, and the matches are those
of the plain pattern. Places are code points, ends exclusive.

Null and empty texts hold no span. Every row has its own result, repeated rows included. Spans
of different kinds may overlap; masking covers their union.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlake.llm.common import pick

# Kinds in the order of the result, their patterns, base scores and the words
# that raise the score of a span near them.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}
BASE = ("email", "ip", "card", "phone")
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4, "local_phone": 0.3}
CONTEXT = {
    "email": ("mail", "contact", "@"),
    "ip": ("ip", "address", "server", "host"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social security"),
    "local_phone": ("phone", "call", "tel", "mobile", "fax"),
}
AGAINST = {"ip": ("version", "release"), "local_phone": ("order", "invoice", "item"), "ssn": ("part no", "serial")}
RAISE, LOWER, ENOUGH, NEARBY = 0.3, 0.3, 0.6, 40
#: Matches whose places are summed up together; the sums of blocks are chained.
BLOCK = 64


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, nines cast out; the sum is a multiple of ten."""
    right = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(right, i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    places = F.sequence(F.lit(1), F.length(digits))
    return (F.length(digits) > 0) & (F.aggregate(places, F.lit(0), add) % 10 == 0)


def mod97(match: Column) -> Column:
    """The first four signs moved to the end, letters as 10 to 35: the remainder is 1."""
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))

    def add(rest: Column, char: Column) -> Column:
        letter = F.ascii(char) - 55
        return F.when(letter >= 10, rest * 100 + letter).otherwise(rest * 10 + F.ascii(char) - 48) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda rest, c: F.when(
        F.length(c) == 0, rest).otherwise(add(rest, c))) == 1


def _valid(kind: str, match: Column) -> Column:
    digits = _digits(match)
    if kind == "ip":
        small = lambda part: (F.length(part) <= 3) & (
            F.coalesce(part.try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(match, r"\."), lambda p: small(F.regexp_replace(p, "^0+", "")))
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        return mod97(match)
    if kind == "ssn":
        return ~match.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def _places(matches: Column, gaps: Column) -> Column:
    """(start, end, match) of every match, from the lengths of matches and of what lies between."""
    sized = F.transform(matches, lambda m, i: F.struct(
        F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("size"), m.alias("match")))
    blocks = F.transform(
        F.sequence(F.lit(1), F.size(matches), F.lit(BLOCK)), lambda at: F.slice(sized, at, BLOCK))
    length = F.transform(blocks, lambda b: F.aggregate(
        b, F.lit(0), lambda n, x: n + x["gap"] + x["size"]))
    starts = F.aggregate(
        length, F.array(F.lit(0)), lambda out, n: F.concat(out, F.array(F.element_at(out, -1) + n)))
    kind = "array<struct<start:int,end:int,match:string>>"

    def chain(block: Column, start: Column) -> Column:
        def step(done: Column, x: Column) -> Column:
            begin = done["at"] + x["gap"]
            end = begin + x["size"]
            return F.struct(end.alias("at"), F.concat(done["out"], F.array(F.struct(
                begin.alias("start"), end.alias("end"), x["match"].alias("match")))).alias("out"))

        first = F.struct(start.alias("at"), F.array().cast(kind).alias("out"))
        return F.aggregate(block, first, step, lambda done: done["out"])

    return F.when(F.size(matches) > 0, F.flatten(
        F.transform(blocks, lambda b, i: chain(b, F.get(starts, i))))).otherwise(F.array().cast(kind))


def _mentions(around: Column, words: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [around.contains(w) for w in words], F.lit(False))


def _scored(kind: str, text: Column, span: Column) -> Column:
    begin = F.greatest(span["start"] - NEARBY, F.lit(0))
    before = F.substr(text, begin + 1, span["start"] - begin)
    after = F.substr(text, span["end"] + 1, F.lit(NEARBY))
    around = F.lower(F.concat(before, F.lit(" "), after))
    score = F.lit(SCORES[kind]) + F.when(_mentions(around, CONTEXT[kind]), RAISE).otherwise(0.0)
    if kind in AGAINST:
        score = score - F.when(_mentions(around, AGAINST[kind]), LOWER).otherwise(0.0)
    return F.round(F.least(score, F.lit(1.0)), 2)


def _gaps(kind: str, text: Column, matches: Column) -> Column:
    """What lies between the matches of a text, null unless one of them is valid."""
    return F.when(
        F.exists(matches, lambda m: _valid(kind, m)), F.split(text, PATTERNS[kind], -1))


def _spans(kind: str, rank: int, text: Column, matches: Column, gaps: Column) -> Column:
    valid = F.filter(_places(matches, gaps), lambda s: _valid(kind, s["match"]))
    named = F.transform(valid, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
        F.lit(kind).alias("kind"), _scored(kind, text, s).alias("score")))
    if kind not in BASE:
        named = F.filter(named, lambda s: s["score"] >= ENOUGH)
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,score:double>>")
    return F.when(gaps.isNotNull(), named).otherwise(none)


def with_spans(documents: DataFrame, text: str, out: str, own: str = "_pii") -> DataFrame:
    """``documents`` with ``out``: an array of (start, place of the kind, end, kind, score)."""
    body = F.coalesce(F.col(text), F.lit(""))
    # A look for a sign that every match holds spares most texts the scan.
    needed = {"email": "@", "phone": "+", "ssn": "-"}
    found = documents
    scanned = {}
    for kind, pattern in PATTERNS.items():
        matches = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
        if kind in needed:
            matches = F.when(body.contains(needed[kind]), matches).otherwise(F.array().cast("array<string>"))
        scanned[f"{own}_m_{kind}"] = matches
    found = found.withColumns(scanned)
    placed = {
        f"{own}_g_{kind}": _gaps(kind, body, F.col(f"{own}_m_{kind}")) for kind in PATTERNS}
    found = found.withColumns(placed)
    kept = {
        f"{own}_s_{kind}": _spans(kind, rank, body, F.col(f"{own}_m_{kind}"), F.col(f"{own}_g_{kind}"))
        for rank, kind in enumerate(PATTERNS)}
    found = found.withColumns(kept)
    joined = F.array_sort(F.concat(*[F.col(c) for c in kept]))
    return found.withColumn(out, joined).drop(*scanned, *placed, *kept)


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(documents: DataFrame) -> DataFrame:
    """doc_id, counts and hash of the base spans, all spans and their scores, for every row."""
    found = with_spans(pick(documents, "doc_id", "text"), "text", "found")
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.col("found")).alias("spans"),
        F.array_join(F.transform("found", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def masked(documents: DataFrame) -> DataFrame:
    """``documents`` with every span replaced by its kind in brackets; n_chars follows the text.

    Spans that overlap are covered by one mask, named after the first. Null texts stay null.
    """
    columns = documents.columns
    places = [f"c{i}" for i in range(len(columns))]

    def place(name: str) -> str | None:
        hits = [i for i, c in enumerate(columns) if c == name] or [
            i for i, c in enumerate(columns) if c.lower() == name]
        return places[hits[0]] if hits else None

    text, size = place("text"), place("n_chars")
    found = with_spans(documents.toDF(*places), text, "spans")

    def cover(done: Column, span: Column) -> Column:
        fresh = span["start"] >= done["at"]
        piece = F.concat(
            F.substr(F.col(text), done["at"] + 1, span["start"] - done["at"]),
            F.lit("["), F.upper(span["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(done["out"], F.array(piece))).otherwise(done["out"]).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    cleaned = F.aggregate("spans", first, cover, lambda done: F.concat(
        F.array_join(done["out"], ""), F.substr(F.col(text), done["at"] + 1)))
    some = F.size("spans") > 0
    found = found.withColumn("cleaned", F.when(some, cleaned).otherwise(F.col(text)))
    changed = {text: F.col("cleaned")}
    if size:
        kind = documents.schema[columns[places.index(size)]].dataType
        changed[size] = F.when(some, F.length("cleaned").cast(kind)).otherwise(F.col(size))
    return found.select(*[changed.get(c, F.col(c)).alias(n) for c, n in zip(places, columns)])
