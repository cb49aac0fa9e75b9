"""Conversation repair against plain dynamic programming over strings."""

import hashlib
import re
import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from courtlake.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, stretch int, audit string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}


def damaged(records):
    out = []
    for r in records:
        words = [" " if v is None else str(v) for v in (r.conv_id, r.turn)]
        kind = zlib.crc32(":".join(words).encode()) % 20
        role, text = (" " if v is None else v for v in (r.role, r.text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(r.conv_id, r.turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def least(rows):
    """(cost, audit, lines) by plain dynamic programming that carries whole strings."""
    def grown(best):
        for _ in range(3):
            for s, (cost, audit, lines) in list(best.items()):
                role, then = NEXT[s]
                offer(best, then, (cost + 5, audit + "I", lines + [f"{role}:"]))
        return best

    def offer(best, s, found):
        if s not in best or found[:2] < best[s][:2]:
            best[s] = found

    best = {0: (0, "", [])}
    for role, text, fault in rows:
        fresh = {}
        for s, (cost, audit, lines) in grown(best).items():
            offer(fresh, s, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            named, then = NEXT[s]
            offer(fresh, then, (cost + 1 + extra, audit + "R", lines + [f"{named}:{text}"]))
            if role[:1] == named[0]:
                offer(fresh, then, (cost + extra, audit + "K", lines + [f"{role}:{text}"]))
            elif role[:1] == "s" and s == 0:
                offer(fresh, 1, (cost + extra, audit + "K", lines + [f"{role}:{text}"]))
        best = fresh
    return min(v for s, v in grown(best).items() if s in (0, 3))


def brute(records):
    every, convs = {r.conv_id for r in records}, {}
    for conv, turn, role, text in damaged(records):
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role, text))
    out = []
    for conv in every:
        turns, seen, rows = sorted(convs.get(conv, [])), set(), []
        for _, _, role, text in turns:
            signs = BLANK.findall(text)
            fault = ("blank" if not signs else "duplicate" if (role, text) in seen
                     else "truncated" if signs[-1] not in ".!?" else "")
            seen.add((role, text))
            rows.append((role, text, fault))
        known = [t for some, t, _, _ in turns if some]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[:1] for r, _, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = least(rows)
        faults = [sum(f == kind for _, _, f in rows) for kind in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


signs = st.text("suaoSUAOx", max_size=14)


def as_rows(text):
    role = {"s": "system", "u": "user", "a": "assistant", "o": "other", "x": "user"}
    fault = lambda c: "blank" if c == "x" else "truncated" if c.isupper() else ""
    return [(role[c.lower()], str(i), fault(c)) for i, c in enumerate(text)]


@given(signs)
@settings(max_examples=400, deadline=None)
def test_audit_is_the_least(text):
    audit, _, cost = C.best_audit(text, C.START, C.ending_costs(), True)
    ending = C.stretch_costs(text, C.START)
    expected = least(as_rows(text))
    assert (audit) == expected[1]
    assert cost == expected[0] == min(c + e for c, e in zip(ending, C.ending_costs()))


@given(st.lists(st.sampled_from("DIKR"), max_size=40), st.lists(st.sampled_from("DIKR"), max_size=40),
       st.lists(st.sampled_from("DIKR"), max_size=20), st.sampled_from([1_000_003, 0, 1]))
@settings(max_examples=300, deadline=None)
def test_order_of_audits(left, right, shared, base):
    """Also with hashes that collide: a base of 1 only sums, one of 0 only knows the last edit."""
    kept, C._HASH_BASE = C._HASH_BASE, base
    try:
        stem = C.Audit()
        for edit in shared:
            stem = C.Audit(stem, edit)
        a = b = stem
        for edit in left:
            a = C.Audit(a, edit)
        for edit in right:
            b = C.Audit(b, edit)
        assert C.before(a, b) == (str(a) < str(b))
        assert str(a.ancestor(len(shared))) == "".join(shared)
    finally:
        C._HASH_BASE = kept


@pytest.fixture(scope="module")
def table(spark):
    roles, texts = ["user", "assistant", "system", None, "tool", ""], ["Yes.", "No", " ", None, "Why?", "é!  ", "x" * 5000 + "."]
    rows = []
    for conv in range(40):
        for turn in range((conv * 7) % 23):
            pick = zlib.crc32(f"{conv}/{turn}".encode())
            role = roles[turn % 2] if pick % 4 else roles[pick // 4 % 6]
            rows.append((conv, turn + (pick % 17 == 0), role, f"{turn} " + (texts[pick // 32 % 7] or "") if pick % 3 else texts[pick // 32 % 7], 1, "x"))
    rows += [(50, None, "user", "a.", 1, "x"), (50, None, "assistant", "b.", 1, "x"), (None, 1, "user", "q?", 1, "x"),
             (None, None, None, None, None, None), (60, 2, "user", "same.", 1, "x"), (60, 2, "user", "same.", 1, "x")]
    rows += [(70, t, "user", "again.", 1, "x") for t in range(300)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("stretch,fan", [(2048, 512), (3, 2), (1, 3)])
def test_against_plain(table, rows, stretch, fan):
    assert rows(C.audit_repairs(table, stretch, fan)) == brute(table.collect())


def test_given_table(spark, rows):
    given = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert rows(C.audit_repairs(given)) == brute(given.collect())


def test_empty_and_dropped(spark, table):
    assert C.audit_repairs(table.limit(0)).collect() == []
    gone = next(c for c, t in product(range(500), range(1)) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(gone, 0, "user", "Hi.", 1, "x")], SCHEMA)
    (found,) = C.audit_repairs(one).collect()
    assert tuple(found) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_rows(table):
    repair = C.Repair(C.damage(table), stretch=4, fan=2)
    lines = {}
    for r in repair.repaired().collect():
        lines.setdefault(r.conv, []).append((r["index"], [x.role[:1] for x in r.lines]))
    for conv in lines.values():
        text = "".join(x for _, part in sorted(conv) for x in part)
        assert re.fullmatch("(s?(ua)+)?", text)
