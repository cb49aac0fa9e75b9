"""SQL for the registered queries that SQL can express, over the same tables."""

from courtlake.llm import sharding


def _crc32(text: str) -> str:
    """CRC-32 of a string's UTF-8 bytes, half a byte at a time, the lower half first."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    halves = f"string_split(regexp_replace(hex(encode({text})), '(.)(.)', '\\2\\1', 'g'), '')"
    digits = f"list_transform({halves}, lambda h: CAST(strpos('0123456789ABCDEF', h) - 1 AS BIGINT))"
    step = f"lambda c, h: xor(c >> 4, ({table})[xor(c & 15, h) + 1])"
    return (f"CASE WHEN {text} = '' THEN 0 ELSE xor(list_reduce({digits}, {step}, 4294967295::BIGINT), "
            f"4294967295) END")


def _permuted(source: str) -> str:
    """``source`` (rn, pos, step, total, side) with ``pos`` permuted once."""
    sql = f"SELECT *, pos // side AS l, pos % side AS r FROM {source}"
    for a, b, c in sharding.round_keys(sharding.SEED):
        sql = f"SELECT * REPLACE (r AS l, (l + (x * x % {sharding.PRIME}) * ((r + {c}) % {sharding.PRIME}) % " \
              f"{sharding.PRIME}) % side AS r) FROM (SELECT *, (r * {a} + {b}) % {sharding.PRIME} AS x FROM ({sql}))"
        sql = f"SELECT rn, pos, step, total, side, l, r FROM ({sql})"
    return f"SELECT rn, l * side + r AS pos, step + 1 AS step, total, side FROM ({sql})"


_SHARDS = f"""
    WITH RECURSIVE sized AS (
        SELECT doc_id, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size,
               CAST({_crc32("coalesce(text, '')")} AS BIGINT) AS text_crc32 FROM documents),
    numbered AS (
        SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS rn,
               count(*) OVER () AS total FROM sized),
    walk(rn, pos, step, total, side) AS (
        SELECT rn, rn, 0, total, CAST(ceil(sqrt(total)) AS BIGINT) FROM numbered
        UNION ALL
        {_permuted("(SELECT * FROM walk WHERE step = 0 OR pos >= total)")})
    SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(pos % {sharding.SHARDS} AS INTEGER) AS shard,
           CAST(pos // {sharding.SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard,
           CAST(n.rn AS BIGINT) AS row_number
    FROM numbered n JOIN walk w ON n.rn = w.rn AND step > 0 AND pos < n.total"""


def _others(level: int) -> tuple[str, str]:
    return f"list_slice(run{level}, 1, at{level})", f"list_slice(run{level}, at{level} + 2, len(run{level}))"


def _tree(rows: str, name: str, levels: int) -> list[str]:
    """Tables of a tree over ``rows`` (g, i, n, d): its last node by g, and every row's runs."""
    out = [f"{name}0 AS (SELECT g, i, n, d FROM {rows})"]
    for k in range(levels):
        out.append(f"{name}r{k} AS (SELECT g, i // 16 AS i, any_value(n) AS n, list(d ORDER BY i) AS run "
                   f"FROM {name}{k} GROUP BY g, i // 16)")
        out.append(f"{name}{k + 1} AS (SELECT g, i, (n + 15) // 16 AS n, CASE WHEN n > 1 THEN "
                   f"sha256(array_to_string(run, '')) ELSE run[1] END AS d FROM {name}r{k})")
    joins = "".join(f" JOIN {name}r{k} r{k} ON r{k}.g IS NOT DISTINCT FROM m.g AND r{k}.i = m.i // {16 ** (k + 1)}"
                    for k in range(levels))
    runs = ", ".join(f"CASE WHEN r{k}.n > 1 THEN r{k}.run ELSE [NULL] END AS run{k}, (m.i // {16 ** k}) % 16 AS at{k}"
                     for k in range(levels))
    out.append(f"{name}path AS (SELECT m.*, {runs} FROM {rows} m{joins})")
    return out


def _proof(levels: int) -> str:
    """Siblings of the runs, one string; a level that a tree does not have is a run of itself."""
    return " || ".join(f"array_to_string({side}, '')" for k in range(levels) for side in _others(k))


def _fold(own: str, levels: int) -> str:
    sql = f"SELECT *, {own} AS f0 FROM x"
    for k in range(levels):
        left, right = _others(k)
        node = f"sha256(array_to_string({left}, '') || f{k} || array_to_string({right}, ''))"
        sql = f"SELECT *, CASE WHEN run{k}[1] IS NULL THEN f{k} ELSE {node} END AS f{k + 1} FROM ({sql})"
    return sql


_LEVELS = 5
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    fields = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")] + [text]
    return "sha256(" + " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in fields) + ")"


_MANIFEST = f"""
    WITH leaves AS (
        SELECT doc_id, source, {_leaf("text")} AS leaf, CASE WHEN doc_id IS NOT NULL
               AND ({_crc32("CAST(doc_id AS VARCHAR)")}) % 5 = 0 THEN {_leaf(_LOWER)} ELSE {_leaf("text")} END AS other
        FROM documents),
    members AS (
        SELECT *, source AS g, leaf AS d, count(*) OVER (PARTITION BY source) AS n,
               row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves),
    {", ".join(_tree("members", "t", _LEVELS))},
    subroots AS (SELECT g AS source, d FROM t{_LEVELS}),
    tops AS (
        SELECT 0 AS g, source, d, count(*) OVER () AS n,
               row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS i FROM subroots),
    {", ".join(_tree("tops", "u", _LEVELS))},
    below AS (
        SELECT doc_id, source, leaf, {_proof(_LEVELS)} AS proof, f{_LEVELS} AS sub
        FROM ({_fold("other", _LEVELS).replace("FROM x", "FROM tpath")})),
    above AS (
        SELECT source, d AS subroot, {_proof(_LEVELS)} AS proof, {", ".join(f"run{k}, at{k}" for k in range(_LEVELS))}
        FROM upath),
    both_parts AS (
        SELECT b.doc_id, b.leaf, a.subroot, b.proof || a.proof AS proof, b.sub,
               {", ".join(f"a.run{k}, a.at{k}" for k in range(_LEVELS))}
        FROM below b JOIN above a ON a.source IS NOT DISTINCT FROM b.source),
    folded AS ({_fold("sub", _LEVELS).replace("FROM x", "FROM both_parts")})
    SELECT doc_id, leaf, subroot, (SELECT d FROM u{_LEVELS}) AS root, sha256(proof) AS proof_sha256,
           f{_LEVELS} AS folded_root, f{_LEVELS} = (SELECT d FROM u{_LEVELS}) AS verified
    FROM folded"""


def _edit(state: str, cost: str, initial: str, line: str) -> str:
    """What a state becomes by one edit; null if it is not reached."""
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{initial}', " \
           f"'t': {state}.t || {line}}} END"


def _edited(state: str, role: str) -> str:
    """Reroled to ``role``, or kept as it if it is that already, of a row that may stay."""
    late = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"
    keep = f"CASE WHEN role[1] = '{role[0]}' THEN " + _edit(state, late, "K", "chr(10) || role || ':' || text") + " END"
    give = _edit(state, f"1 + {late}", "R", f"chr(10) || '{role}:' || text")
    return f"CASE WHEN fault NOT IN ('blank', 'duplicate') THEN least({keep}, {give}) END"


_NONE = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR))"


def _inserted(rows: str) -> str:
    """States once rows may have been put in: a user row after any but a user's, then an assistant's."""
    user = ", ".join(_edit(s, "5", "I", "chr(10) || 'user:'") for s in ("s0", "s1", "s3"))
    sql = f"SELECT * REPLACE (least(s2, {user}) AS s2) FROM {rows}"
    assistant = _edit("s2", "5", "I", "chr(10) || 'assistant:'")
    return f"SELECT * REPLACE (least(s3, {assistant}) AS s3) FROM ({sql})"


_REPAIRS = f"""
    WITH RECURSIVE given AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               ({_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")}) % 20 AS k
        FROM conversations),
    damaged AS (
        SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
               CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(CASE k WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
        FROM given WHERE k <> 0),
    ordered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
               count(*) OVER (PARTITION BY conv_id) AS n,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS said
        FROM damaged),
    marked AS (
        SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN said > 1 THEN 'duplicate'
                       WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault,
               coalesce(lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au'), FALSE) AS odd
        FROM ordered),
    state AS (
        SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 't': ''}} AS s0,
               {_NONE} AS s1, {_NONE} AS s2, {_NONE} AS s3 FROM marked
        UNION ALL
        SELECT conv_id, i + 1, s0d, least(s1d, s1k), least(s2d, s2k), least(s3d, s3k) FROM (
            SELECT p.conv_id, p.i, {", ".join(_edit(f"s{k}", "2", "D", "''") + f" AS s{k}d" for k in range(4))},
                   CASE WHEN fault NOT IN ('blank', 'duplicate') AND role[1] = 's' THEN
                       {_edit("s0", "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END", "K", "chr(10) || role || ':' || text")}
                   END AS s1k,
                   least({_edited("s0", "user")}, {_edited("s1", "user")}, {_edited("s3", "user")}) AS s2k,
                   {_edited("s2", "assistant")} AS s3k
            FROM ({_inserted("state")}) p JOIN marked m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.i = p.i + 1)),
    ended AS (
        SELECT p.conv_id, least(s0, s3) AS best FROM ({_inserted("state")}) p
        JOIN (SELECT conv_id, count(*) AS n FROM marked GROUP BY conv_id) m
            ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = m.n),
    counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate,
               count_if(fault = 'truncated') AS truncated, count_if(odd) AS illegal FROM marked GROUP BY conv_id)
    SELECT a.conv_id, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal"))}, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
           coalesce(best.a, '') AS audit, sha256(substr(coalesce(best.t, ''), 2)) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) a
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
    LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM a.conv_id"""

_ABLE = """
    SELECT vec_id, embedding FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

SQL: dict[str, str] = {
    "op1_vector_file": f"""
        WITH able AS ({_ABLE}),
        whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM able),
        scored AS (
            SELECT q.vec_id AS query_id, w.vec_id, CAST(list_inner_product(q.v, w.v) AS BIGINT) AS score
            FROM whole q JOIN whole w ON q.vec_id <> w.vec_id AND len(q.v) = len(w.v)
            WHERE q.vec_id % 20 = 0),
        ranked AS (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op6_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS bytes FROM pages),
        o AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS owner FROM p)
        SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN bytes >= 1000 AND owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN bytes >= 1000 AND owner <> page_id THEN owner END AS refers_to
        FROM o""",
    "op9_cover_tree": f"""
        WITH RECURSIVE able AS ({_ABLE}),
        unit AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM able),
        link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id
            WHERE list_inner_product(a.v, b.v)
                  >= 0.9 * sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))
              AND list_inner_product(a.v, a.v) > 0 AND list_inner_product(b.v, b.v) > 0),
        reach AS (
            SELECT vec_id, vec_id AS other FROM embeddings
            UNION
            SELECT reach.vec_id, link.b FROM reach JOIN link ON link.a = reach.other),
        part AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
        degree AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
        SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id,
               vec_id = component_id AS kept
        FROM part LEFT JOIN degree USING (vec_id)""",
    "op11_feistel_sharding": _SHARDS,
    "op12_persistent_audit": _REPAIRS,
    "op13_butterfly_manifest": _MANIFEST,
}
