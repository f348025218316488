"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

import string

from tidemark.llm.mixing import MOST, WEIGHTS
from tidemark.llm.quality_rules import Rules

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = (
    f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
)


def _shingles(links: bool = False) -> str:
    return f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3),
                                      lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM texts),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g
    AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reached AS (
  SELECT a, b FROM pairs
  UNION SELECT r.a, p.b FROM reached r JOIN pairs p ON p.a = r.b)
SELECT doc_id, len(s)::BIGINT AS n_shingles,
       least(doc_id, coalesce(low, doc_id)) AS component_id{", coalesce(n, 0)::BIGINT AS n_links" if links else ""}
FROM sets LEFT JOIN (SELECT a, min(b) AS low FROM reached GROUP BY a) ON a = doc_id
LEFT JOIN (SELECT a AS linked, count(*) AS n FROM pairs GROUP BY a) ON linked = doc_id"""


def _quality(rules: Rules) -> str:
    grams = {n: f"g{n}" for n in sorted({rules.window, *rules.ngram_percent})}
    ctes = "".join(
        f""",
{name} AS (
  SELECT doc_id, count(*) AS words, sum(length(w[k])) AS chars FROM (
    SELECT DISTINCT doc_id, i + j AS k FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times FROM (
        SELECT doc_id, i, array_to_string(w[i:i + {n - 1}], ' ') AS g
        FROM texts, unnest(range(1, len(w) - {n - 2})) AS r(i))),
      unnest(range({n})) AS s(j) WHERE times > 1)
  JOIN texts USING (doc_id) GROUP BY doc_id)"""
        for n, name in grams.items()
    )
    within = " AND ".join(
        f"100 * coalesce({grams[n]}.chars, 0) <= {most} * word_chars"
        for n, most in rules.ngram_percent.items()
    )
    joins = " ".join(f"LEFT JOIN {name} ON {name}.doc_id = base.doc_id" for name in grams.values())
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
lines AS (
  SELECT doc_id, line, count(*) AS times, any_value(length(array_to_string(
           regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'), ''))) AS chars
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY ALL),
repeated AS (
  SELECT doc_id, sum(times - 1) AS n, sum(CASE WHEN times > 1 THEN times * chars ELSE 0 END)
    AS chars FROM lines GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols FROM texts){ctes}
SELECT base.doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, coalesce(repeated.n, 0)::BIGINT AS n_dup_lines,
       coalesce(g{rules.window}.words, 0)::BIGINT AS n_repeat_words,
       n_words < {rules.min_words} OR 100 * coalesce(g{rules.window}.words, 0)
         > {rules.repeat_percent} * n_words AS base_failed,
       NOT base_failed AND {within}
         AND 100 * coalesce(repeated.chars, 0) <= {rules.line_percent} * word_chars AS kept
FROM base {joins} LEFT JOIN repeated ON repeated.doc_id = base.doc_id"""


def _mix() -> str:
    weight = f"[{', '.join(map(str, WEIGHTS))}][rank % {len(WEIGHTS)} + 1]"
    return f"""
WITH docs AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE
          + 0.5) / 281474976710656.0 AS u FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM docs GROUP BY source),
weighed AS (SELECT *, {weight}::BIGINT AS weight FROM sources),
spread AS (
  SELECT *, (sum(source_size) OVER ()
             - {MOST} * coalesce(sum(source_size) OVER before, 0))::BIGINT AS rest_size,
         (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS rest_weight
  FROM weighed WINDOW before AS (ORDER BY source_size / weight, rank
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stopped AS (
  SELECT *, bool_and({MOST}::DOUBLE * source_size * rest_weight <= rest_size::DOUBLE * weight)
    OVER (ORDER BY source_size / weight, rank) AS stops FROM spread),
goals AS (
  SELECT s.source, s.source_size,
         CASE WHEN stops THEN ({MOST} * s.source_size)::DOUBLE
              ELSE (free.rest_size * s.weight)::DOUBLE / free.rest_weight END AS target,
         CASE WHEN s.source_size > 0 THEN floor(target / s.source_size) ELSE 0 END::BIGINT
           AS copies,
         target - copies * s.source_size AS quota
  FROM stopped s LEFT JOIN (
    SELECT rest_size, rest_weight FROM stopped WHERE NOT stops
    ORDER BY source_size / weight, rank LIMIT 1) free ON true),
shares AS (
  SELECT source, size, coalesce(sum(size * n) OVER larger, 0)::DOUBLE AS certain,
         (sum(size::HUGEINT * size * n) OVER rest)::DOUBLE AS squares
  FROM (SELECT source, size, count(*) AS n FROM docs WHERE size > 0 GROUP BY ALL)
  WINDOW larger AS (PARTITION BY source ORDER BY size DESC
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (PARTITION BY source ORDER BY size DESC
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
rates AS (
  SELECT s.source, max(size) AS most, arg_max((quota - certain) / squares, size) AS rate
  FROM shares s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
  WHERE quota > 0 AND (quota - certain) / squares * size < 1 GROUP BY s.source),
draws AS (
  SELECT d.doc_id, d.source, d.size, CASE WHEN d.size > r.most THEN 0.0
         WHEN rate * d.size > 0 THEN u / (1 - u) / (rate * d.size / (1 - rate * d.size))
         ELSE u / (1 - u) END AS odds
  FROM docs d LEFT JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
ordered AS (
  SELECT d.*, g.source_size, g.target, g.copies, g.quota,
         sum(size) OVER (PARTITION BY d.source ORDER BY odds, doc_id, size) AS upto
  FROM draws d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source),
sampled AS (SELECT *, quota > 0 AND upto <= quota AS chosen FROM ordered),
gaps AS (
  SELECT *, quota - coalesce(sum(size) FILTER (chosen) OVER (PARTITION BY source), 0) AS gap
  FROM sampled),
filled AS (
  SELECT *, NOT chosen AND quota > 0 AND abs(gap - size) < gap AND row_number() OVER (
           PARTITION BY source, chosen ORDER BY abs(gap - size), odds, doc_id) = 1 AS filler
  FROM gaps)
SELECT doc_id, size, source_size, target,
       ((copies + CASE WHEN chosen OR filler THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM filled"""


def _lines() -> str:
    return """
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS words,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line
  FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, line, list_sort(list_distinct(
           regexp_extract_all(words, '[^\\x20\\x09-\\x0D]+'))) AS t
  FROM split WHERE regexp_matches(words, '[^\\x20\\x09-\\x0D]')),
sets AS (
  SELECT t, min((doc_id, line)) AS first, row_number() OVER () AS class FROM lines GROUP BY t),
tokens AS (SELECT class, len(t) AS n, unnest(t) AS token FROM sets),
ranked AS (
  SELECT class, token, row_number() OVER (PARTITION BY class ORDER BY times, token) AS at,
         n - (80 * n + 99) // 100 + 1 AS prefix
  FROM (SELECT *, count(*) OVER (PARTITION BY token) AS times FROM tokens)),
shared AS (
  SELECT DISTINCT a.class AS later, b.class AS earlier FROM ranked a
  JOIN ranked b ON a.token = b.token AND a.at <= a.prefix AND b.at <= b.prefix
  JOIN sets sa ON sa.class = a.class JOIN sets sb ON sb.class = b.class
  WHERE sa.first > sb.first AND 100 * least(len(sa.t), len(sb.t))
    >= 80 * greatest(len(sa.t), len(sb.t))),
near AS (
  SELECT DISTINCT later FROM shared JOIN sets a ON a.class = later
  JOIN sets b ON b.class = earlier
  WHERE 180 * len(list_intersect(a.t, b.t)) >= 80 * (len(a.t) + len(b.t))),
judged AS (
  SELECT l.doc_id, l.line, (l.doc_id, l.line) > s.first AS exact,
         NOT exact AND near.later IS NOT NULL AS close
  FROM lines l JOIN sets s USING (t) LEFT JOIN near ON near.later = s.class)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (exact)::BIGINT AS n_exact,
       count(*) FILTER (close)::BIGINT AS n_near,
       coalesce(string_agg(line::VARCHAR, ',' ORDER BY line) FILTER (exact OR close), '')
         AS removed
FROM judged GROUP BY doc_id"""


def _contamination() -> str:
    words = f"regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH texts AS (SELECT doc_id, {words} AS w FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, {words} AS w FROM benchmark),
tests AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ')
    AS g FROM items, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS r(i) WHERE len(w) > 0),
windows AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM texts, (SELECT DISTINCT n FROM tests), unnest(range(1, len(w) - n + 2)) AS r(i)),
hits AS (SELECT doc_id, i, n, item FROM windows JOIN tests USING (n, g)),
hit_words AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hits, unnest(range(n)) AS s(j)
  GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM texts t LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


def crc32(x: str) -> str:
    """The unsigned CRC-32 of an ASCII text: each byte, then eight steps marked -1."""
    steps = (
        f"flatten(list_transform(string_split({x}, ''),"
        " lambda b: [ord(b)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    )
    return (
        f"xor(list_reduce([4294967295::BIGINT] || {steps}, lambda c, v: CASE WHEN v >= 0"
        " THEN xor(c, v) ELSE xor(c >> 1, 3988292384::BIGINT * (c & 1)) END), 4294967295::BIGINT)"
    )


#: Levels of the trees in SQL: 16 million leaves a group, 1,024 groups.
LEAF_LEVELS, GROUP_LEVELS = 24, 10


def _merkle() -> str:
    def size(x: str) -> str:
        return f"coalesce(octet_length(encode({x}::VARCHAR)) || ':' || {x}::VARCHAR, '-')"

    def leaf(n_chars: str) -> str:
        parts = [size(x) for x in ("doc_id", "source", "lang", n_chars, "text")]
        return f"sha256({' || '.join(parts)})"

    def levels(name: str, n: int) -> str:
        """Tables name0 (grp, pos, node) to name<n>, and their siblings."""
        return "".join(
            f""",
{name}{k + 1} AS MATERIALIZED (
  SELECT grp, pos // 2 AS pos, CASE WHEN max(total) = 1 THEN any_value(node)
           ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS total FROM {name}{k}) GROUP BY ALL)"""
            for k in range(n)
        )

    def climb(name: str, k: int, source: str, target: str) -> str:
        """One level up: siblings so far, and the node from the offered leaf."""
        return f""",
{target} AS MATERIALIZED (
  SELECT p.* REPLACE (
    p.pos // 2 AS pos,
    p.proof || coalesce(s.node, '') AS proof,
    CASE WHEN t.total = 1 THEN p.node WHEN s.pos IS NULL THEN sha256(p.node)
         WHEN s.pos < p.pos THEN sha256(s.node || p.node)
         ELSE sha256(p.node || s.node) END AS node)
  FROM {source} p
  JOIN (SELECT grp, count(*) AS total FROM {name}{k} GROUP BY grp) t ON t.grp = p.grp
  LEFT JOIN {name}{k} s ON s.grp = p.grp AND s.pos = xor(p.pos, 1))"""

    climbs = "".join(
        climb("n", k, f"p{k}", f"p{k + 1}") for k in range(LEAF_LEVELS)
    ) + f""",
q0 AS (SELECT * REPLACE (0 AS grp, grp AS pos) FROM p{LEAF_LEVELS})""" + "".join(
        climb("g", k, f"q{k}", f"q{k + 1}") for k in range(GROUP_LEVELS)
    )
    return f"""
WITH leaves AS MATERIALIZED (
  SELECT doc_id, {leaf("n_chars")} AS leaf,
         CASE WHEN {crc32("doc_id::VARCHAR")} % 7 = 0 THEN {leaf("(n_chars::HUGEINT + 1)")}
              ELSE leaf END AS offered,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM documents),
n0 AS (SELECT grp, pos, leaf AS node FROM leaves){levels("n", LEAF_LEVELS)},
g0 AS (SELECT 0 AS grp, grp AS pos, node FROM n{LEAF_LEVELS}){levels("g", GROUP_LEVELS)},
p0 AS (SELECT doc_id, leaf, grp, pos, offered AS node, '' AS proof, grp AS lang FROM leaves){climbs}
SELECT doc_id, leaf, sub.node AS subroot, top.node AS root, sha256(proof) AS proof_sha256,
       q{GROUP_LEVELS}.node AS folded_root, q{GROUP_LEVELS}.node = top.node AS verified
FROM q{GROUP_LEVELS} JOIN n{LEAF_LEVELS} sub ON sub.grp = lang CROSS JOIN g{GROUP_LEVELS} top"""


def _repair() -> str:
    def best(*offers: str) -> str:
        return f"list_min([{', '.join(offers)}])"

    def edit(state: str, cost: str, letter: str, line: str = "", when: str = "NOT go") -> str:
        out = f"{state}.o || CASE WHEN {state}.o = '' THEN '' ELSE chr(10) END || {line}"
        return (
            f"CASE WHEN {state} IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost},"
            f" 'a': {state}.a || '{letter}', 'o': {out if line else f'{state}.o'}}} END"
        )

    def keep(state: str, initial: str) -> str:
        return edit(state, "cut", "K", "role || ':' || text", f"NOT go AND initial = '{initial}'")

    def rerole(state: str, role: str) -> str:
        return edit(state, "2 + cut", "R", f"'{role}:' || text")

    def insert(state: str, role: str) -> str:
        return edit(state, "2", "I", f"'{role}:'", "true")

    def delete(state: str) -> str:
        return edit(state, "3", "D", when="true")

    def inserted(source: str) -> str:
        """Two rounds of insertions over the four states; others than u and a stay."""
        for _ in range(2):
            user = best("u", insert("z", "user"), insert("s", "user"), insert("a", "user"))
            source = f"""(
    SELECT * REPLACE ({user} AS u, {best("a", insert("u", "assistant"))} AS a) FROM {source})"""
        return source

    from_any = [f(x, *y) for x in "zsa" for f, y in ((keep, "u"), (rerole, ["user"]))]
    step = f"""(
    SELECT conv, n + 1 AS n, {delete("z")} AS z,
           {best(delete("s"), keep("z", "s"))} AS s,
           {best(delete("u"), *from_any)} AS u,
           {best(delete("a"), keep("u", "a"), rerole("u", "assistant"))} AS a
    FROM (SELECT d.*, r.go, r.cut, r.initial, r.role, r.text
          FROM search d JOIN judged r ON r.conv = d.conv AND r.n = d.n))"""
    nothing = "{'c': 0::BIGINT, 'a': '', 'o': ''}"
    name = "coalesce(t.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    blank = "[\\x20\\x09-\\x0D]"
    return f"""
WITH RECURSIVE convs AS (
  SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
faulty AS (
  SELECT conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32(name)} % 20 AS fault
  FROM conversations t JOIN convs c ON t.conv_id IS NOT DISTINCT FROM c.conv_id),
turns AS (
  SELECT conv, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                    ELSE text END AS text
  FROM faulty, unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copies(copy)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) - 1 AS n,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         NOT regexp_matches(text, '[.!?]{blank}*\\z') AS open FROM turns),
judged AS (
  SELECT *, substr(role, 1, 1) AS initial, NOT blank AND row_number() OVER (
           PARTITION BY conv, role, text ORDER BY n) > 1 AS again,
         blank OR again AS go, CASE WHEN open AND NOT blank THEN 1 ELSE 0 END AS cut,
         lag(initial) OVER (PARTITION BY conv ORDER BY n) || initial AS pair FROM placed),
search AS (
  SELECT * FROM {inserted(f"""(
    SELECT conv, 0::BIGINT AS n, {nothing} AS z, NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR) AS s,
           s AS u, s AS a FROM convs)""")}
  UNION ALL SELECT * FROM {inserted(step)}),
ended AS (
  SELECT conv, {best("z", "a")} AS found FROM search s
  WHERE n = (SELECT count(*) FROM judged j WHERE j.conv = s.conv)),
counts AS (
  SELECT conv, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate,
         count(*) FILTER (cut = 1 AND NOT again) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, found.c::BIGINT AS cost, found.a AS audit,
       sha256(found.o) AS repaired_sha256
FROM convs JOIN ended USING (conv) LEFT JOIN counts USING (conv)"""


def _repeats() -> str:
    return """
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS id, hex(encode(coalesce(text, ''))) AS digits,
         length(digits) // 2 AS n FROM documents),
strings AS (
  SELECT id, i, md5(substr(digits, 2 * i + 1, 800)) AS s
  FROM texts, unnest(range(n - 399)) AS r(i)),
hits AS (
  SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY s) AS times FROM strings)
  WHERE times > 1),
spans AS (
  SELECT id, min(i) AS lo, max(i) + 400 AS hi FROM (
    SELECT id, i, count(*) FILTER (i > coalesce(last, -401) + 400) OVER (PARTITION BY id ORDER BY i)
      AS span
    FROM (SELECT id, i, lag(i) OVER (PARTITION BY id ORDER BY i) AS last FROM hits))
  GROUP BY id, span),
edges AS (
  SELECT id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY id ORDER BY lo), 0) AS since FROM spans),
cut AS (
  SELECT id, sum(hi - lo) AS removed, count(*) AS n_spans, max(hi) AS since,
         string_agg(substr(digits, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo) AS parts
  FROM edges JOIN texts USING (id) GROUP BY id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(parts, '') || substr(digits, 2 * coalesce(since, 0) + 1)))
         AS kept_sha256
FROM texts LEFT JOIN cut USING (id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mix_sources": _mix(),
        "op3_ngram_join": _shingles(),
        "op3_ngram_links": _shingles(links=True),
        "op4_quality_rules": _quality(Rules()),
        "op8_line_dedup": _lines(),
        "op10_decontaminate": _contamination(),
        "op11_merkle_manifest": _merkle(),
        "op12_conversation_repair": _repair(),
        "op13_suffix_dedup": _repeats(),
    }
