"""Conversations repaired by the cheapest edits; a persistent audit decides among equally cheap ones.

A conversation is well formed if its role initials read ``(s?(ua)+)?``. Rows are kept (free),
given the role user or assistant (1) or deleted (2; the only choice for blank and repeated rows),
and empty rows of either role may be inserted anywhere (5). A truncated row that stays adds 5. The
audit is the list of edits by initial, D, I, K or R; of equally cheap audits the least in ASCII
order stands.

The programme runs over the rows with four states: nothing yet, after the system row, after a user
row, after an assistant row. An audit is a linked node that shares its prefix with others and holds
ancestors at powers of two and a rolling hash. Two equally cheap audits that meet in a state
are compared at the end of their longest common prefix, which a search over the ancestors'
hashes finds; equal hashes of different nodes are verified edit by edit, and a collision falls
back to the plain comparison.

A conversation may hold any number of rows: it is cut into stretches of ``STRETCH`` rows. A
stretch tells what it costs to get from each state to each other one; costs to the end are
summed over stretches from behind, in tables of up to ``FAN`` stretches that are summarised
again while there are more. Every stretch then finds, for each state that it may begin in, the
audit that is best with the known cost behind it, and the state it ends in; following those maps
from the start, in the same way, picks one audit of each. Edits before a row belong to the
row's stretch, so stretches' audits joined are the conversation's.

Null roles and texts are one space, null turns come first; rows that tie on the turn are ordered by role
and text, equal ones are interchangeable. A null conv_id is a conversation. Texts of any length stay in
JVM rows; the audit, and the hash of a repaired conversation, which is read in order as a stream, are the
only things a task holds or passes per whole conversation. Other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtlake.llm.common import pick, stored
from courtlake.llm.ranking import ranked

STRETCH, FAN = 2048, 512
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: Costs are whole numbers below this.
NEVER = 1 << 60
#: The next role's initial and state; a system row may only come first.
ONWARD = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
#: Words end at these characters alone.
_SIGN = r"[^\x20\x09-\x0D]"
_HASH_BASE, _HASH_PRIME = 1_000_003, (1 << 61) - 1


# ── The audit ──


class Audit:
    """A list of edits as a node: its last edit, and a link to the list before it."""

    __slots__ = ("edit", "depth", "up", "hash")

    def __init__(self, before: Audit | None = None, edit: str = ""):
        self.edit = edit
        if before is None:
            self.depth, self.up, self.hash = 0, (), 0
            return
        self.depth = before.depth + 1
        self.hash = rolled(before.hash, edit)
        links, k = [before], 0
        while k < len(links[k].up):
            links.append(links[k].up[k])
            k += 1
        self.up = tuple(links)

    def ancestor(self, depth: int) -> Audit:
        node = self
        while node.depth > depth:
            node = node.up[min((node.depth - depth).bit_length(), len(node.up)) - 1]
        return node

    def __str__(self) -> str:
        edits, node = [], self
        while node.up:
            edits.append(node.edit)
            node = node.up[0]
        return "".join(reversed(edits))


def rolled(before: int, edit: str) -> int:
    return (before * _HASH_BASE + ord(edit)) % _HASH_PRIME


def _same_prefix(a: Audit, b: Audit) -> bool:
    """Whether two nodes of equal depth hold the same edits: shared links end the walk."""
    while a is not b and a.up:
        if a.edit != b.edit:
            return False
        a, b = a.up[0], b.up[0]
    return True


def before(a: Audit, b: Audit) -> bool:
    """Whether audit ``a`` comes before ``b`` in ASCII order."""
    depth = min(a.depth, b.depth)
    x, y = a.ancestor(depth), b.ancestor(depth)
    if x is y or x.hash == y.hash:
        return a.depth < b.depth if _same_prefix(x, y) else str(a) < str(b)
    while True:
        # The highest ancestors that differ, as far up as the links go: their parents agree.
        for k in range(len(x.up) - 1, -1, -1):
            if x.up[k].hash != y.up[k].hash:
                x, y = x.up[k], y.up[k]
                break
        else:
            break
    if not _same_prefix(x.up[0], y.up[0]):
        return str(a) < str(b)
    return x.edit < y.edit


# ── A stretch: one sign per row. "x" must go, otherwise the role's initial, upper case if truncated ──


def _step(costs: list, audits: list | None, sign: str) -> tuple[list, list | None]:
    """Costs (and audits) by state after one row, insertions before it included."""
    costs, audits = _inserted(costs, audits)
    out, names = [NEVER] * STATES, [None] * STATES

    def offer(state: int, cost: int, source: int, edit: str) -> None:
        if cost > out[state] or cost >= NEVER:
            return
        if audits is None:
            out[state] = cost
            return
        found = Audit(audits[source], edit)
        if cost < out[state] or before(found, names[state]):
            out[state], names[state] = cost, found

    for state in range(STATES):
        cost = costs[state]
        if cost >= NEVER:
            continue
        offer(state, cost + DELETE, state, "D")
        if sign == "x":
            continue
        initial, extra = sign.lower(), TRUNCATED if sign.isupper() else 0
        wanted, then = ONWARD[state]
        offer(then, cost + REROLE + extra, state, "R")
        if initial == wanted:
            offer(then, cost + KEEP + extra, state, "K")
        elif initial == "s" and state == START:
            offer(SYSTEM, cost + KEEP + extra, state, "K")
    return out, names if audits is not None else None


def _inserted(costs: list, audits: list | None) -> tuple[list, list | None]:
    """Costs once empty rows may have been put in, cheapest states first."""
    costs = list(costs)
    audits = None if audits is None else list(audits)
    for state in sorted(range(STATES), key=lambda s: costs[s]) * 2:
        if costs[state] >= NEVER:
            continue
        then, cost = ONWARD[state][1], costs[state] + INSERT
        if audits is None:
            costs[then] = min(costs[then], cost)
        elif cost <= costs[then]:
            found = Audit(audits[state], "I")
            if cost < costs[then] or before(found, audits[then]):
                costs[then], audits[then] = cost, found
    return costs, audits


def stretch_costs(signs: str, entry: int) -> list[int]:
    costs = [0 if s == entry else NEVER for s in range(STATES)]
    for sign in signs:
        costs, _ = _step(costs, None, sign)
    return costs


def ending_costs() -> list[int]:
    """Cost behind the last row: nothing, or the empty rows that are missing."""
    return [min(_inserted([0 if s == entry else NEVER for s in range(STATES)], None)[0][s]
                for s in (START, ASSISTANT)) for entry in range(STATES)]


def best_audit(signs: str, entry: int, behind: list[int], last: bool) -> tuple[str, int, int]:
    """The audit from ``entry`` that is best with the costs ``behind``, the state it ends in, its cost."""
    costs = [0 if s == entry else NEVER for s in range(STATES)]
    audits: list = [Audit() if s == entry else None for s in range(STATES)]
    for sign in signs:
        costs, audits = _step(costs, audits, sign)
    if last:
        costs, audits = _inserted(costs, audits)
        behind = [0 if s in (START, ASSISTANT) else NEVER for s in range(STATES)]
    chosen = None
    for state in range(STATES):
        total = costs[state] + behind[state]
        if costs[state] >= NEVER or behind[state] >= NEVER:
            continue
        if chosen is None or total < chosen[0] or total == chosen[0] and before(audits[state], audits[chosen[1]]):
            chosen = total, state
    if chosen is None:
        return "", entry, 0
    return str(audits[chosen[1]]), chosen[1], costs[chosen[1]]


# ── Damage and faults ──


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copy after the damage that crc32 of ``conv_id:turn`` asks for."""
    rows = pick(conversations, "conv_id", "turn", "role", "text")
    kind = F.crc32(F.concat(_filled("conv_id"), F.lit(":"), _filled("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", _filled("role").alias("role"), _filled("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(
        F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(copies).alias("copy"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a key that is never null, their place in the conversation and their sign."""
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    placed = ranked(rows.withColumn("conv", key), ["turn", "role", "text", "copy"], ["conv"]).drop("copy")
    named = placed.withColumn("said", F.sha2(F.to_json(F.struct("role", "text")), 256))
    # Rows said twice, and where first: counted in each task before the shuffle.
    first = named.groupBy("conv", "said").agg(F.min("index").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    marked = named.join(first.drop("n"), ["conv", "said"], "left")
    blank = ~F.col("text").rlike(_SIGN)
    ended = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")).rlike(r"[.!?]\z")
    fault = F.when(blank, "blank").when(F.col("index") > F.col("first"), "duplicate").when(~ended, "truncated").otherwise("")
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    marked = marked.withColumns({"fault": fault, "initial": initial})
    sign = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(
        F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    return marked.withColumn("sign", sign).select(
        "conv_id", "conv", "index", "total", "turn", "role", "text", "fault", "initial", "sign")


def _stretches(rows: DataFrame, size: int) -> DataFrame:
    """A row per stretch: its signs in order and the counts of what lies in it."""
    span = F.lit(size).cast("long")
    stretch = F.call_function("div", F.col("index"), span)
    # The first row of a stretch also ends the one before it, for the pair across the cut.
    spots = F.when((F.col("index") > 0) & (F.col("index") % span == 0), F.array(stretch, stretch - 1)).otherwise(F.array(stretch))
    dealt = rows.withColumn("stretch", F.explode(spots))
    own = F.col("stretch") == stretch
    counts = [F.count(F.when(own & (F.col("fault") == f), 1)).alias(f) for f in ("blank", "duplicate", "truncated")]
    packed = dealt.groupBy("conv", "stretch").agg(
        F.sort_array(F.collect_list(F.when(own, F.struct("index", "sign")))).alias("signs"),
        F.sort_array(F.collect_list(F.struct("index", "initial"))).alias("initials"), *counts,
        F.max("total").alias("total"))
    joined = lambda c, f: F.array_join(F.transform(c, lambda x: x[f]), "")
    pairs = F.transform(F.sequence(F.lit(1), F.length("initials") - 1), lambda i: F.substr(F.col("initials"), i, F.lit(2)))
    packed = packed.withColumns({"signs": joined("signs", "sign"), "initials": joined("initials", "initial")})
    illegal = F.when(F.length("initials") > 1, F.size(F.filter(pairs, lambda p: ~p.isin("su", "ua", "au")))).otherwise(0)
    last = F.col("stretch") == F.call_function("div", F.col("total") - 1, span)
    return packed.select("conv", "stretch", "signs", "blank", "duplicate", "truncated",
                         illegal.cast("long").alias("illegal"), last.alias("last"))


# ── Sums over stretches ──


def _mapped(df: DataFrame, run, schema: str) -> DataFrame:
    """Rows through ``run`` (a dict to a dict), a batch at a time."""
    names = [part.split()[0] for part in schema.split(", ")]

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None
        for batch in found:
            rows = [run(row) for row in batch.to_pylist()]
            kinds = kinds or pa.schema([(n, _arrow(schema, n)) for n in names])
            yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows], kinds)

    return df.mapInArrow(batches, schema)


def _arrow(schema: str, name: str) -> pa.DataType:
    kind = dict(part.split(" ", 1) for part in schema.split(", "))[name]
    plain = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.list_(plain[kind[6:-1]]) if kind.startswith("array<") else plain[kind]


def _followed(first: list[int], then: list[int]) -> list[int]:
    """Costs from state to state over two stretches, in rows of STATES."""
    cells = [(first[a * STATES + b], b) for a in range(STATES) for b in range(STATES)]
    return [min(min(cells[a * STATES + b][0] + then[b * STATES + c] for b in range(STATES)), NEVER)
            for a in range(STATES) for c in range(STATES)]


def _swept(parts: DataFrame, value: str, together, handed, start: list[int], forward: bool, fan: int) -> DataFrame:
    """(conv, stretch, given): for every stretch what reaches it from the end (or the start).

    ``parts`` has conv, stretch and ``value``, an array of whole numbers; ``together`` joins the values of
    two neighbours, ``handed`` passes what reaches a stretch on over it. Levels of up to
    ``fan`` stretches are joined into one until each conversation is one, then handed down again.
    """
    levels = [parts.select("conv", F.col("stretch").alias("at"), F.col(value).alias("value"))]
    while True:
        size = levels[-1].agg(F.max("at")).first()[0]
        if size is None or size == 0:
            break
        grouped = _gathered(levels[-1], fan)

        def join(row: dict) -> dict:
            values = [m["value"] for m in row["members"]]
            out = values[0]
            for v in values[1:]:
                out = together(out, v)
            return {"conv": row["conv"], "at": row["above"], "value": out}

        levels.append(stored(_mapped(grouped, join, "conv string, at long, value array<long>"), "sweep-up"))
    given = levels[-1].select("conv", "at", F.array(*[F.lit(x).cast("long") for x in start]).alias("given"))
    for level in reversed(levels[:-1]):
        above = given.select("conv", F.col("at").alias("above"), "given")
        grouped = _gathered(level, fan).join(above, ["conv", "above"])

        def hand(row: dict) -> dict:
            now, out = row["given"], []
            members = row["members"] if forward else row["members"][::-1]
            for m in members:
                out.append({"at": m["at"], "given": now})
                now = handed(m["value"], now)
            return {"conv": row["conv"], "at": [m["at"] for m in out], "given": [x for m in out for x in m["given"]]}

        spread = _mapped(grouped, hand, "conv string, at array<long>, given array<long>")
        width = len(start)
        given = stored(spread.select("conv", F.posexplode("at").alias("i", "at"), F.col("given").alias("all")).select(
            "conv", "at", F.slice("all", F.col("i") * width + 1, F.lit(width)).alias("given")), "sweep-down")
    return given.withColumnRenamed("at", "stretch")


def _gathered(level: DataFrame, fan: int) -> DataFrame:
    return level.withColumn("above", F.call_function("div", F.col("at"), F.lit(fan).cast("long"))).groupBy(
        "conv", "above").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("members"))


def _handed_costs(over: list[int], behind: list[int]) -> list[int]:
    return [min(NEVER, min(over[a * STATES + b] + behind[b] for b in range(STATES))) for a in range(STATES)]


def _audits(parts: DataFrame, fan: int) -> DataFrame:
    """(conv, stretch, audit, cost, entry): the edits of every stretch and the state it begins in."""

    def costs(row: dict) -> dict:
        # The first stretch is only ever entered with nothing before it.
        out = [x for entry in range(STATES) for x in (
            stretch_costs(row["signs"], entry) if row["stretch"] or entry == START else [NEVER] * STATES)]
        return {"conv": row["conv"], "stretch": row["stretch"], "value": out}

    # What a long conversation's stretches hand to each other; one stretch alone needs none of it.
    long = parts.where(~(F.col("last") & (F.col("stretch") == 0)))
    over = stored(_mapped(long.select("conv", "stretch", "signs"), costs,
                          "conv string, stretch long, value array<long>"), "stretch-costs")
    behind = _swept(over, "value", _followed, _handed_costs, ending_costs(), False, fan)

    def audits(row: dict) -> dict:
        cost = row["behind"] or ending_costs()
        found = [best_audit(row["signs"], entry, cost, row["last"]) if row["stretch"] or entry == START else ("", entry, 0)
                 for entry in range(STATES)]
        audits, value, spent = zip(*found)
        return {"conv": row["conv"], "stretch": row["stretch"], "audits": audits, "value": value, "spent": spent}

    known = parts.join(behind.withColumnRenamed("given", "behind"), ["conv", "stretch"], "left")
    named = stored(_mapped(known.select("conv", "stretch", "signs", "last", "behind"), audits,
                           "conv string, stretch long, audits array<string>, value array<long>, spent array<long>"), "stretch-audits")
    chain = named.join(long.select("conv", "stretch"), ["conv", "stretch"])
    entries = _swept(chain, "value", lambda a, b: [b[s] for s in a],
                     lambda over, at: [over[at[0]]], [START], True, fan)
    entry = F.coalesce(F.get("given", F.lit(0)), F.lit(START).cast("long")).cast("int")
    return named.join(entries, ["conv", "stretch"], "left").select(
        "conv", "stretch", F.get("audits", entry).alias("audit"), F.get("spent", entry).alias("cost"),
        entry.alias("entry"))


# ── Repaired rows ──


def _edits(parts: DataFrame, size: int) -> DataFrame:
    """(conv, index, inserted, role, kept): what becomes of every row; ``inserted`` roles before it.

    The rows that are put in behind the last one have an index of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, at, inserted, edit, role = [], [], [], [], []
            for row in batch.to_pylist():
                state, index, added = row["entry"], row["stretch"] * size, []
                for one, sign in zip(*_aligned(row["audit"], row["signs"])):
                    name, then = ONWARD[state]
                    named = "user" if name == "u" else "assistant"
                    if one == "I":
                        added.append(named)
                        state = then
                        continue
                    conv.append(row["conv"])
                    at.append(index)
                    inserted.append(added)
                    edit.append(one)
                    role.append(named if one == "R" else None)
                    index, added = index + 1, []
                    if one != "D":
                        state = SYSTEM if one == "K" and sign.lower() == "s" else then
                if added:
                    conv.append(row["conv"])
                    at.append(index)
                    inserted.append(added)
                    edit.append("I")
                    role.append(None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv, pa.string()), pa.array(at, pa.int64()), pa.array(inserted, pa.list_(pa.string())),
                 pa.array(edit, pa.string()), pa.array(role, pa.string())],
                ["conv", "index", "inserted", "edit", "new_role"])

    return parts.mapInArrow(run, "conv string, index long, inserted array<string>, edit string, new_role string")


def _aligned(audit: str, signs: str) -> tuple[str, list[str]]:
    rows = iter(signs)
    return audit, ["" if edit == "I" else next(rows) for edit in audit]


def _streamed_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, joined by line breaks; rows come in order."""
    now, digest, done = None, None, []
    for batch in batches:
        for conv, lines in zip(batch.column("conv").to_pylist(), batch.column("lines").to_pylist()):
            if conv != now:
                if digest is not None:
                    done.append((now, digest.hexdigest()))
                now, digest, some = conv, hashlib.sha256(), False
            for line in lines:
                digest.update(b"\n" * some + line.encode())
                some = True
        yield _hashes(done)
        done = []
    if digest is not None:
        yield _hashes([(now, digest.hexdigest())])


def _hashes(done: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([c for c, _ in done], pa.string()), pa.array([h for _, h in done], pa.string())],
        ["conv", "repaired_sha256"])


class Repair:
    """The stages of a repair over rows (conv_id, turn, role, text, copy), stored between them."""

    def __init__(self, rows: DataFrame, stretch: int = STRETCH, fan: int = FAN):
        self.rows = stored(_numbered(rows), "turns")
        self.parts = stored(_stretches(self.rows, stretch), "stretches")
        self.audits = stored(self.parts.join(_audits(self.parts, fan), ["conv", "stretch"]), "audits")
        self.edits = _edits(self.audits.select("conv", "stretch", "signs", "audit", "entry"), stretch)

    def repaired(self) -> DataFrame:
        """conv_id, conv, index, lines: the rows of every conversation as (role, text), in order."""
        fresh = F.transform(F.coalesce("inserted", F.array().cast("array<string>")), lambda r: F.struct(
            r.alias("role"), F.lit("").alias("text")))
        own = F.when(F.col("edit").isin("K", "R"), F.array(F.struct(
            F.coalesce("new_role", "role").alias("role"), F.col("text"))))
        none = F.array().cast("array<struct<role:string,text:string>>")
        joined = self.edits.join(self.rows.select("conv", "index", "conv_id", "role", "text"), ["conv", "index"], "left")
        return joined.select("conv_id", "conv", "index", F.concat(fresh, F.coalesce(own, none)).alias("lines"))

    def hashes(self) -> DataFrame:
        lines = F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
        rows = self.repaired().select("conv", "index", lines.alias("lines")).where(F.size("lines") > 0)
        return rows.repartition("conv").sortWithinPartitions("conv", "index").select(
            "conv", "lines").mapInArrow(_streamed_hash, "conv string, repaired_sha256 string")

    def summary(self) -> DataFrame:
        """conv, conv_id, gaps, counts of faults, illegal, audit and repaired_sha256 per conversation."""
        turns = self.rows.groupBy("conv").agg(
            F.min("conv_id").alias("conv_id"), F.min("turn").alias("low"), F.max("turn").alias("high"))
        turns = turns.join(self.rows.select("conv", "turn").distinct().groupBy("conv").agg(
            F.count("turn").alias("distinct")), "conv")
        gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("distinct"), F.lit(0)).cast("long")
        counts = self.audits.groupBy("conv").agg(
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("stretch", "audit"))),
                                     lambda x: x["audit"]), "").alias("audit"),
            F.sum("cost").alias("cost"))
        return turns.join(counts, "conv").join(self.hashes(), "conv", "left").select(
            "conv", "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
            "repaired_sha256")


def audit_repairs(conversations: DataFrame, stretch: int = STRETCH, fan: int = FAN) -> DataFrame:
    """Damage, then repair: one row per original conv_id."""
    every = pick(conversations, "conv_id").distinct()
    found = Repair(damage(conversations), stretch, fan).summary()
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    joined = every.withColumn("conv", key).join(found.drop("conv_id"), "conv", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return joined.select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
