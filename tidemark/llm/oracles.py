"""DuckDB statements for the operators that SQL can express, over whole tables.

They recompute everything by plain definitions: every window of three words,
every window's entropy anew, every pair of texts that share a shingle.
"""

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINE_RULES = rf"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, source, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
),
windows AS (
    SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM docs)
),
repeated AS (
    SELECT doc_id, count(DISTINCT place) AS n_repeat_words
    FROM (
        SELECT doc_id, unnest([i, i + 1, i + 2]) AS place
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS times FROM windows)
        WHERE times > 1
    )
    GROUP BY doc_id
),
lines AS (
    SELECT doc_id, source, line, regexp_extract_all(line, '{WORD}') AS w
    FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM docs)
),
real_lines AS (
    SELECT doc_id, source, line, len(w) AS n,
        translate(array_to_string(w, ' '), '{UPPER}123456789', '{LOWER}000000000') AS normal
    FROM lines WHERE len(w) > 0
),
doubled AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM real_lines GROUP BY doc_id),
hosts AS (SELECT coalesce(source, chr(0)) AS host, count(*) AS held FROM documents GROUP BY ALL),
common AS (
    SELECT host, normal
    FROM (SELECT coalesce(source, chr(0)) AS host, normal, count(DISTINCT doc_id) AS n FROM real_lines GROUP BY ALL)
        JOIN hosts USING (host)
    WHERE n > 3 AND 20 * n > held
),
removed AS (
    SELECT doc_id, sum(n) AS n_removed_words
    FROM real_lines JOIN common ON coalesce(source, chr(0)) = host AND real_lines.normal = common.normal
    GROUP BY doc_id
),
counted AS (
    SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(n_removed_words, 0) AS n_removed_words
    FROM docs LEFT JOIN doubled USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN removed USING (doc_id)
),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
    NOT base_failed AND 5 * n_removed_words <= n_words AS kept, n_removed_words::BIGINT AS n_removed_words
FROM based
"""

_CONTROLS = r"<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|\[ROLE\]|\[/ROLE\]|\[/TURN\]"


def _written(column: str) -> str:
    """Characters of an escaped text."""
    return (
        f"length({column}) + length({column}) - length(replace({column}, chr(92), ''))"
        f" + len(regexp_extract_all({column}, '{_CONTROLS}'))"
    )


CHAT_FORMAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
chats AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS spoken,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS learned,
        string_agg(role, ',' ORDER BY turn NULLS FIRST, role, text) AS roles,
        sum({_written("text")} + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7
            ELSE 20 + {_written("role")} END) AS formatted_chars
    FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(spoken) AS turns_sha256, length(learned)::BIGINT AS loss_chars,
    sha256(learned) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars,
    regexp_full_match(roles, '(system,)?user,assistant(,user,assistant)*') AS valid
FROM chats
"""

_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_KINDS = [
    ("assign", 0, _ASSIGN),
    ("access", 1, "AKIA[A-Z0-9]{12,}"),
    ("hex", 2, "[0-9a-f]{32,}"),
    ("hex_entropy", 3, "[0-9a-f]{16,}"),
    ("base64_entropy", 4, "[A-Za-z0-9+/_=-]{24,}"),
]
_ALLOWED = [
    "^[A-Za-z=]+$",
    "^[0-9=]+$",
    "^[a-z0-9]{0,15}([-_/][a-z0-9]{0,15})+$",
    "^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
]
_ALLOWED_PARTS = [
    ("(?i)example", " " * 7),
    ("(?i)abcdefgh|01234567|qwertyui", " " * 8),
    ("(^|[^A-Za-z0-9+/_=-])[0-9]{4}-[0-9]{2}-[0-9]{2}", chr(92) + "1" + " " * 10),
]


def _matches(kinds: list[tuple[str, int, str]], table: str) -> str:
    """All matches of each kind with their places: what lies between them is counted."""
    parts = []
    for kind, place, pattern in kinds:
        parts.append(f"""
        SELECT doc_id, '{kind}' AS kind, {place} AS place, k, m[k] AS value,
            list_sum(list_transform(p[1:k], lambda x: length(x)))
                + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0) AS start_at
        FROM (
            SELECT doc_id, m, p, unnest(range(1, len(m) + 1)) AS k
            FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS p FROM {table})
        )""")
    return " UNION ALL ".join(parts)


def _without_allowed(column: str) -> str:
    for pattern, instead in _ALLOWED_PARTS:
        column = f"regexp_replace({column}, '{pattern}', '{instead}', 'g')"
    return column


SECRET_SCAN = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS (SELECT *, start_at + length(value) AS end_at FROM ({_matches(_KINDS[:3], "docs")})),
base AS (SELECT * FROM found WHERE place > 0 OR length(regexp_extract(value, '{_ASSIGN}', 1)) >= 8),
places AS (SELECT doc_id, list(start_at) AS low, list(end_at) AS high FROM base GROUP BY doc_id),
masked AS (
    SELECT doc_id, {_without_allowed("text")} AS text, low, high FROM docs LEFT JOIN places USING (doc_id)
),
runs AS (
    SELECT doc_id, CASE WHEN low IS NULL THEN text ELSE array_to_string(list_transform(string_split(text, ''),
        lambda c, i: CASE WHEN len(list_filter(range(1, len(low) + 1), lambda j: low[j] < i AND i <= high[j])) > 0 THEN ' ' ELSE c END), '') END AS text
    FROM masked
),
candidates AS (
    SELECT *, start_at + length(value) AS end_at,
        CASE place WHEN 3 THEN 16 ELSE 24 END AS wide, CASE place WHEN 3 THEN 3.0 ELSE 3.9 END AS least
    FROM ({_matches(_KINDS[3:], "runs")})
    WHERE {" AND ".join(f"NOT regexp_matches(value, '{p}')" for p in _ALLOWED)}
),
chars AS (
    SELECT doc_id, place, k, pos, substr(value, pos + i, 1) AS c, wide
    FROM (
        SELECT *, unnest(range(0, wide)) AS i
        FROM (SELECT *, unnest(range(1, length(value) - wide + 2)) AS pos FROM candidates)
    )
),
entropies AS (
    SELECT doc_id, place, k, pos, sum(-(n / wide) * log2(n / wide)) AS bits
    FROM (SELECT doc_id, place, k, pos, c, wide, count(*) AS n FROM chars GROUP BY ALL)
    GROUP BY ALL
),
peaks AS (SELECT doc_id, place, k, max(bits) AS bits FROM entropies GROUP BY ALL),
spans AS (
    SELECT doc_id, kind, place, start_at, end_at FROM base
    UNION ALL
    SELECT doc_id, kind, place, start_at, end_at FROM candidates JOIN peaks USING (doc_id, place, k) WHERE bits >= least - 1e-9
),
shown AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex,
        coalesce(string_agg(kind || ':' || start_at || ':' || end_at, ',' ORDER BY start_at, place) FILTER (place < 3), '') AS base,
        string_agg(kind || ':' || start_at || ':' || end_at, ',' ORDER BY start_at, place) AS spans
    FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
    coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN shown USING (doc_id)
"""

JACCARD_JOIN = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
),
shingled AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM shingled x JOIN shingled y ON x.s = y.s AND x.doc_id < y.doc_id
    GROUP BY ALL
),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common >= 80 * (x.n + y.n - common)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM docs
    UNION
    SELECT reached.doc_id, edges.b FROM reached JOIN edges ON reached.other = edges.a
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other)::BIGINT AS component_id
FROM reached LEFT JOIN sizes USING (doc_id)
GROUP BY doc_id
"""

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

SOURCE_DIVERGENCE = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        list_transform(regexp_extract_all(coalesce(text, ''), '{TERM}'), lambda w: translate(w, '{UPPER}', '{LOWER}')) AS w
    FROM documents
),
terms AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
kept AS (
    SELECT lang, term, count(*)::HUGEINT AS n FROM terms GROUP BY ALL HAVING count(DISTINCT d) >= 30
),
sizes AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM terms JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY ALL),
shares AS (
    SELECT lang, source, term, coalesce(counts.n, 0) AS n,
        1 + (1000000000 * (coalesce(counts.n, 0) + 5)) // (coalesce(totals.total, 0) + 5 * v) AS p,
        1 + (1000000000 * (kept.n + 5)) // (sizes.total + 5 * v) AS q
    FROM groups JOIN kept USING (lang) JOIN sizes USING (lang)
        LEFT JOIN totals USING (lang, source) LEFT JOIN counts USING (lang, source, term)
),
apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
),
found AS (
    SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value
    FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
        LEFT JOIN apart ON apart.lang = x.lang AND apart.source = x.source AND apart.item = y.source
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def _edit(before: str, cost: str, letter: str, turn: str | None = None) -> str:
    """State ``before`` after one more edit; NULL if there is no such state."""
    out = f"{before}.out" if turn is None else f"{before}.out || CASE WHEN {before}.out = '' THEN '' ELSE chr(10) END || {turn}"
    return f"CASE WHEN {before} IS NOT NULL THEN {{'cost': {before}.cost + {cost}, 'audit': {before}.audit || '{letter}', 'out': {out}}} END"


def _spoken(before: str, name: str) -> str:
    """The turn as ``name``: kept, or given that role."""
    kept, changed = _edit(before, "late", "K", "role || ':' || text"), _edit(before, "2 + late", "R", f"'{name}:' || text")
    return f"CASE WHEN must_go THEN NULL WHEN starts_with(role, '{name[0]}') THEN {kept} ELSE {changed} END"


def _put_in(before: str, name: str) -> str:
    return _edit(before, "2", "I", f"'{name}:'")


STRUCTURE_REPAIR = f"""
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
),
kinds AS (
    SELECT *, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda c: unicode(c)::BIGINT)),
        lambda crc, b: list_reduce(
            list_concat([xor(crc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda bits, i: xor(bits >> 1, 3988292384 * (bits & 1)))
    )) % 20 AS kind
    FROM named
),
damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM kinds WHERE kind <> 0
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
        regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS shown
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged)
),
faulty AS (
    SELECT *, shown = '' AS blank, shown <> '' AND again AS duplicate,
        shown <> '' AND NOT again AND NOT regexp_matches(shown, '[.!?]$') AS truncated
    FROM placed
),
turns AS (SELECT *, blank OR duplicate AS must_go, CASE WHEN truncated THEN 1 ELSE 0 END AS late FROM faulty),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (wrong) AS illegal
    FROM (
        SELECT *, lag(role) OVER w || '' IS NOT NULL AND lag(role[1]) OVER w || role[1] NOT IN ('su', 'ua', 'au') AS wrong
        FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY i)
    )
    GROUP BY conv_id
),
begun AS (SELECT DISTINCT conv_id, {{'cost': 0::BIGINT, 'audit': '', 'out': ''}} AS e, NULL::STRUCT(cost BIGINT, audit VARCHAR, out VARCHAR) AS s FROM conversations),
opened AS (SELECT conv_id, e, s, {_put_in("e", "user")} AS u FROM begun),
steps AS (
    SELECT conv_id, 0::BIGINT AS i, e, s, u, {_put_in("u", "assistant")} AS a FROM opened
    UNION ALL
    SELECT conv_id, i, e, s, u, list_min([a, {_put_in("u", "assistant")}]) AS a
    FROM (
        SELECT conv_id, i, e, s, a,
            list_min([u, {_put_in("e", "user")}, {_put_in("s", "user")}, {_put_in("a", "user")}]) AS u
        FROM (
            SELECT steps.conv_id, turns.i,
                {_edit("e", "3", "D")} AS e,
                list_min([{_edit("s", "3", "D")},
                    CASE WHEN NOT must_go AND starts_with(role, 's') THEN {_edit("e", "late", "K", "role || ':' || text")} END]) AS s,
                list_min([{_edit("u", "3", "D")}, {_spoken("e", "user")}, {_spoken("s", "user")}, {_spoken("a", "user")}]) AS u,
                list_min([{_edit("a", "3", "D")}, {_spoken("u", "assistant")}]) AS a
            FROM steps JOIN turns ON steps.conv_id IS NOT DISTINCT FROM turns.conv_id AND turns.i = steps.i + 1
        )
    )
),
ends AS (SELECT conv_id, list_min([arg_max(e, i), arg_max(a, i)]) AS best FROM steps GROUP BY conv_id)
SELECT ends.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, best.cost::BIGINT AS cost,
    best.audit AS audit, sha256(best.out) AS repaired_sha256
FROM ends LEFT JOIN counted ON ends.conv_id IS NOT DISTINCT FROM counted.conv_id
"""

SUBSTRING_DEDUP = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs)
),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1),
removed AS (SELECT doc_id, list(DISTINCT place) AS gone FROM (SELECT doc_id, unnest(range(i, i + 20)) AS place FROM again) GROUP BY doc_id),
kept AS (
    SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
        CASE WHEN gone IS NULL THEN w ELSE list_select(w, list_sort(list_filter(range(1, len(w) + 1), lambda k: NOT list_contains(gone, k)))) END AS words
    FROM docs LEFT JOIN removed USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
    sha256(coalesce(array_to_string(words, ' '), '')) AS kept_sha256
FROM kept
"""

ORACLES = {
    "op2_line_rules": LINE_RULES,
    "op3_chat_format": CHAT_FORMAT,
    "op5_secret_scan": SECRET_SCAN,
    "op6_jaccard_join": JACCARD_JOIN,
    "op11_structure_repair": STRUCTURE_REPAIR,
    "op12_substring_dedup": SUBSTRING_DEDUP,
    "op13_source_divergence": SOURCE_DIVERGENCE,
}
