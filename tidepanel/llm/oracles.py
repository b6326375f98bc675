"""SQL (DuckDB) for the queries that it can express."""

from __future__ import annotations

from tidepanel.llm.quality import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS, SYMBOLS, WINDOW

ORACLES: dict[str, str] = {}


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _rules() -> str:
    parts = []
    for r in RULES:
        per = f"({r.per} - {r.beyond})"
        parts += [f"100 * {r.amount} >= {r.at_least} * {per}"] if r.at_least is not None else []
        parts += [f"100 * {r.amount} <= {r.at_most} * {per}"] if r.at_most is not None else []
    return " AND ".join(parts)


ORACLES["op2_quality_rules"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
g AS (SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w WHERE len(w) >= {WINDOW}) u),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) c WHERE n > 1),
rep AS (SELECT r, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW})))::BIGINT AS n_repeat_words
        FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) s GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
             (length(t) - length(translate(t, '!', '')))::BIGINT AS n_exclaims,
             len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             len(list_filter(w, lambda x: list_contains([{', '.join(map(_quoted, STOP_WORDS))}], x)))::BIGINT AS n_stop_words,
             len(list_filter(l, lambda x: regexp_matches(ltrim(x), '^[-*•] ')))::BIGINT AS n_bullet_lines,
             len(list_filter(l, lambda x: rtrim(x) LIKE '%...'))::BIGINT AS n_ellipsis_lines
      FROM w LEFT JOIN rep USING (r)),
b AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM m)
SELECT *, (NOT base_failed AND {_rules()}) AS kept FROM b
"""

ORACLES["op6_mix_sources"] = """
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t,
                  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
k AS (SELECT doc_id, source, size,
             -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)
             / CASE WHEN size > 0 THEN size / (size + length(t) - length(translate(t, '#*$%&|<>', '')))::DOUBLE ELSE 1 END AS key
      FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT source, source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w FROM s),
c AS (SELECT *, row_number() OVER o AS n, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
             coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
             coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_before
      FROM w WINDOW o AS (ORDER BY 3 * source_size / w::DOUBLE, source)),
f AS (SELECT min(n) AS n FROM c WHERE (total - cap_before)::DOUBLE * w / (all_w - w_before)::DOUBLE <= 3 * source_size),
share AS (SELECT (total - cap_before)::DOUBLE AS rest, (all_w - w_before)::DOUBLE AS open_w FROM c JOIN f USING (n)),
g AS (SELECT source, source_size, least(rest * w / open_w, (3 * source_size)::DOUBLE) AS target FROM w, share),
u AS (SELECT k.doc_id, k.source, k.size, source_size, target,
             sum(size) OVER (PARTITION BY k.source ORDER BY key, k.doc_id, size ROWS UNBOUNDED PRECEDING) AS upto,
             CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole
      FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source),
t AS (SELECT *, (whole + CASE WHEN target - whole * source_size > 0 AND upto - size / 2 <= target - whole * source_size
                 THEN 1 ELSE 0 END)::BIGINT AS times FROM u)
SELECT doc_id, source, size, source_size, target, times, (times * size)::BIGINT AS taken FROM t
"""

ORACLES["op8_exact_dedup"] = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
           FROM documents),
cut AS (SELECT (min(doc_id) + max(doc_id)) // 2 AS mid FROM d),
old AS (SELECT DISTINCT text_sha256 FROM d, cut WHERE doc_id <= mid),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, text_sha256, (old.text_sha256 IS NOT NULL) AS member, doc_id IS NOT DISTINCT FROM keep_id AS kept
FROM d JOIN g USING (text_sha256) LEFT JOIN old USING (text_sha256)
"""


def _licences() -> str:
    from tidepanel.llm.common import LOWER, UPPER
    from tidepanel.llm.licences import KNOWN, PUNCTUATION, SPELLINGS

    def text(s: str) -> str:
        return " || ".join(_quoted(x) for x in s.split("\n")).replace(" || ", " || chr(10) || ")

    spaced = "' ' || array_to_string(list_filter(string_split(x, ' '), lambda y: y <> ''), ' ') || ' '"
    for old, new in SPELLINGS.items():
        spaced = f"replace({spaced}, ' {old} ', ' {new} ')"
    odd = "".join(c for c in PUNCTUATION if c not in "\t\x0b\x0c\r")
    chars = f"{_quoted(UPPER + odd)} || chr(9) || chr(11) || chr(12) || chr(13)"
    into = f"{_quoted(LOWER)} || repeat(' ', {len(PUNCTUATION)})"
    lines = f"""list_transform(list_filter(list_transform(string_split(translate(t, {chars}, {into}), chr(10)), lambda x: {spaced}),
        lambda z: NOT (z LIKE ' copyright c %' OR regexp_matches(z, '^ copyright [0-9©]') OR z LIKE ' © %'
                       OR z LIKE ' all rights reserved %') AND z <> '  '), lambda z: trim(z))"""
    known = ", ".join(f"({_quoted(k)}, {text(v)})" for k, v in KNOWN)
    longest = max(len(v) for _, v in KNOWN)
    return f"""
WITH k AS (SELECT known, min(licence) AS licence FROM
           (SELECT licence, md5(array_to_string({lines}, ' ')) AS known FROM (VALUES {known}) v(licence, t)) z GROUP BY known),
d AS (SELECT row_number() OVER () AS r, doc_id, {lines} AS l FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) q),
n AS (SELECT r, array_to_string(list_sort(list(DISTINCT k.licence)), ',') AS notices, count(*)::BIGINT AS n_notices
      FROM (SELECT r, md5(x) AS known FROM (SELECT r, unnest(l) AS x FROM d) e WHERE length(x) <= {longest}) h JOIN k USING (known) GROUP BY r)
SELECT doc_id, md5(array_to_string(l, ' ')) AS digest, k.licence, coalesce(notices, '') AS notices, coalesce(n_notices, 0)::BIGINT AS n_notices
FROM d LEFT JOIN k ON md5(array_to_string(l, ' ')) = k.known LEFT JOIN n USING (r)
"""


ORACLES["op1_licence_scan"] = _licences()

# Bits of the checksum of a decimal id: every character's code, then eight shifts (-1).
ORACLES["op11_merkle_manifest"] = """
WITH RECURSIVE d AS (
  SELECT *, coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') AS f1,
         coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS f23,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS f5,
         coalesce(xor(list_reduce([4294967295] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: [unicode(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
           lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 7 = 0, false) AS hit
  FROM documents),
h AS (SELECT doc_id, lang, sha256(f1 || f23 || coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') || f5) AS leaf,
             sha256(f1 || f23 || coalesce(length((n_chars + hit::INT)::VARCHAR) || ':' || (n_chars + hit::INT), '-') || f5) AS given FROM d),
g AS (SELECT lang, (row_number() OVER (ORDER BY lang NULLS FIRST) - 1)::BIGINT AS tree, n FROM (SELECT lang, count(*) AS n FROM h GROUP BY lang) x),
l AS (SELECT doc_id, leaf, given, tree, n, (row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1)::BIGINT AS pos
      FROM h JOIN g ON h.lang IS NOT DISTINCT FROM g.lang),
low AS (SELECT tree, 0 AS level, pos, leaf AS hash, n FROM l
        UNION ALL
        SELECT tree, level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2 FROM low WHERE n > 1
        GROUP BY tree, level, pos // 2, n),
s AS (SELECT tree, hash AS subroot, max(level) OVER () AS top FROM low WHERE n = 1),
high AS (SELECT 0 AS level, tree AS pos, subroot AS hash, (SELECT count(*) FROM g) AS n FROM s
         UNION ALL
         SELECT level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2 FROM high WHERE n > 1
         GROUP BY level, pos // 2, n),
nodes AS (SELECT tree, level, pos, hash, n FROM low WHERE n > 1
          UNION ALL SELECT -1, level, pos, hash, n FROM high),
climb AS (SELECT tree AS home, pos AS spot, tree, 0 AS level, pos, n, given AS folded, '' AS siblings FROM l
          UNION ALL
          SELECT home, spot,
                 CASE WHEN c.n = 1 THEN -1 ELSE c.tree END, CASE WHEN c.n = 1 THEN 0 ELSE c.level + 1 END,
                 CASE WHEN c.n = 1 THEN c.tree ELSE c.pos // 2 END,
                 CASE WHEN c.n = 1 THEN (SELECT count(*) FROM g) ELSE (c.n + 1) // 2 END,
                 CASE WHEN c.n = 1 THEN folded WHEN o.hash IS NULL THEN sha256(folded)
                      WHEN c.pos % 2 = 1 THEN sha256(o.hash || folded) ELSE sha256(folded || o.hash) END,
                 CASE WHEN c.n = 1 THEN siblings ELSE siblings || coalesce(o.hash, '') END
          FROM climb c LEFT JOIN nodes o ON c.n > 1 AND o.tree = c.tree AND o.level = c.level AND o.pos = xor(c.pos, 1)
          WHERE c.tree >= 0 OR c.n > 1)
SELECT l.doc_id, l.leaf, s.subroot, r.hash AS root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = r.hash AS verified
FROM l JOIN s USING (tree) JOIN climb c ON c.home = l.tree AND c.spot = l.pos AND c.tree = -1 AND c.n = 1
JOIN high r ON r.n = 1
"""


def _chat() -> str:
    from tidepanel.llm.chat import ASSISTANT, END, PLANTED, START

    safe = "regexp_replace({}, '<(\\\\*)\\|', '<\\\\\\1|', 'g')"
    role = safe.format("replace(replace(coalesce(role, ''), '\\', '\\\\'), chr(10), '\\n')")
    return f"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE '{ASSISTANT}' END, '{PLANTED}' FROM range(2) r(i)),
f AS (SELECT *, '{START}' || {role} || chr(10) || {safe.format('text')} || '{END}' || chr(10) AS formatted FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = '{ASSISTANT}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, formatted) FILTER (role = '{ASSISTANT}'), '')) AS loss_sha256,
       sum(length(formatted))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


ORACLES["op13_chat_formatting"] = _chat()
