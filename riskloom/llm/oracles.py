"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

import re

from riskloom.llm.licence_texts import NOTICES, TEXTS
from riskloom.llm.licences import SPELLINGS
from riskloom.llm.secrets import BASE, RULES, Rule

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> str:
    """List of the words of a text, as ``arrays`` finds them."""
    lowered = f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP5 = f"""
WITH RECURSIVE w AS (SELECT doc_id, text, {words("text")} AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN 'raw ' || coalesce(text, '')
    ELSE array_to_string(ws[i:i + 4], ' ') END AS run, 1 + ln(count(*)) AS x
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w) GROUP BY ALL),
n AS (SELECT doc_id, sum(x) AS n FROM s GROUP BY doc_id),
-- The sum bounds the similarity from above.
pair AS (SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.run = b.run AND a.doc_id <> b.doc_id
  JOIN n p ON p.doc_id = a.doc_id JOIN n q ON q.doc_id = b.doc_id
  GROUP BY ALL HAVING sum(least(a.x / p.n, b.x / q.n)) >= 0.8 - 1e-9),
e AS (SELECT a, b, run, sum(x) AS x, sum(y) AS y
  FROM (SELECT a, b, run, x, 0.0::DOUBLE AS y FROM pair JOIN s ON doc_id = a
    UNION ALL SELECT a, b, run, 0.0, x FROM pair JOIN s ON doc_id = b) GROUP BY ALL),
f AS (SELECT a, b, x, y,
    sum(x) OVER (PARTITION BY a, b) - sum(x) OVER up AS above, sum(y) OVER up AS below
  FROM (SELECT *, CASE WHEN y = 0 THEN 1e300 ELSE x / y END AS r FROM e)
  WINDOW up AS (PARTITION BY a, b ORDER BY r RANGE UNBOUNDED PRECEDING)),
link AS (SELECT a, b FROM f WHERE x > 0 AND y > 0 GROUP BY a, b
  HAVING sum(1 / (above / x + below / y)) >= 0.8 - 1e-9),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w
  UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT a AS doc_id, min(b) AS class_id, a = min(b) AS kept FROM reach GROUP BY a
"""

OP8 = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {words("text")} AS ws
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS size,
    array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM item
        WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
doc AS (SELECT row_number() OVER () AS r, doc_id, {words("text")} AS ws FROM documents),
spot AS (SELECT r, size, i, array_to_string(ws[i:i + size - 1], ' ') AS phrase
  FROM (SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
        FROM doc JOIN sizes ON len(ws) >= size)),
met AS (SELECT r, i, spot.size, item_id FROM spot JOIN win USING (size, phrase)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(i, i + size)) AS p FROM met) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM met GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), false) AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""

def _escaped(text: str) -> str:
    return (
        rf"regexp_replace({text}, '([<\[])(\\*)(/?s>|/?INST\]|image>|audio>|document>)', "
        rf"'\1\\\2\3', 'g')"
    )


OP9 = f"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
c AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text)
      FILTER (WHERE role = 'assistant'), '') AS learned,
    sum(length({_escaped("role")}) + 1 + length({_escaped("text")})
      + CASE WHEN role = 'assistant' THEN 7 ELSE 13 END) AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned) AS loss_chars,
  sha256(learned) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS attached_tokens FROM c
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical_lines(text: str) -> str:
    lines = (
        r"(?m)^[^\p{L}\p{N}\n©]*(?:©|\(c\)|copyright\s*(?:\(c\)|©|\d|:|<|\[|\{|by\b)|"
        r"all rights reserved)[^\n]*$"
    )
    out = f"regexp_replace(lower({text}), '{lines}', '', 'g')"
    for spelling, common in SPELLINGS.items():
        out = f"replace({out}, '{spelling}', '{common}')"
    return rf"regexp_replace({out}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"


def _joined(lines: str) -> str:
    return rf"nullif(trim(regexp_replace({lines}, '\s+', ' ', 'g')), '')"


_KNOWN = ", ".join(
    f"({_quoted(name)}, {_quoted(text)})"
    for table in (TEXTS, NOTICES)
    for name, texts in table.items()
    for text in texts
)

OP10 = f"""
WITH known AS (
  SELECT {_joined(_canonical_lines("text"))} AS form, min(licence) AS licence
  FROM (VALUES {_KNOWN}) AS k(licence, text) GROUP BY 1),
d AS (SELECT row_number() OVER () AS r, doc_id, {_canonical_lines("text")} AS lines
  FROM documents),
inner_ AS (
  SELECT r, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences_inside
  FROM (SELECT r, trim(unnest(string_split(lines, chr(10)))) AS form FROM d)
  JOIN known USING (form) GROUP BY r)
SELECT doc_id, sha256({_joined("lines")}) AS licence_digest, licence,
  coalesce(licences_inside, '') AS licences_inside
FROM d LEFT JOIN known ON known.form = {_joined("lines")} LEFT JOIN inner_ USING (r)
"""

# Unsigned crc32 of a decimal id, byte by byte through the table of the polynomial.
_CRC = """
tab(k, c, step) AS (SELECT range, range, 0 FROM range(256) UNION ALL
  SELECT k, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1
  FROM tab WHERE step < 8),
byte AS (SELECT k, c FROM tab WHERE step = 8),
crc(id, digits, pos, c) AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR), 1, 4294967295 FROM documents
  WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT id, digits, pos + 1, xor(crc.c >> 8, byte.c) FROM crc
  JOIN byte ON byte.k = xor(crc.c, ascii(digits[pos])) & 255 WHERE pos <= length(digits)),
tampered AS (SELECT id FROM crc WHERE pos > length(digits) AND xor(c, 4294967295) % 5 = 0)
"""


def _merkle_levels(name: str, levels: int) -> str:
    """Nodes of each level of the trees in table <name>0 (g, i, n, d), and their siblings."""
    parts = []
    for at in range(levels):
        here, several = f"{name}{at}", f"n > {16**at}"
        run = "OVER (PARTITION BY g, i // 16 ORDER BY i ROWS BETWEEN"
        parts.append(
            f"""{name}{at + 1} AS (SELECT g, i // 16 AS i, min(n) AS n,
  CASE WHEN min(n) > {16**at} THEN sha256(string_agg(d, '' ORDER BY i)) ELSE min(d) END AS d
  FROM {here} GROUP BY g, i // 16),
{name}_side{at} AS (SELECT g, i,
  CASE WHEN {several} THEN coalesce(string_agg(d, '') {run}
    UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS x,
  CASE WHEN {several} THEN coalesce(string_agg(d, '') {run}
    1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS y
  FROM {here})"""
        )
    return ",\n".join(parts)


def _merkle_folds(name: str, levels: int) -> str:
    return ",\n".join(
        f"""{name}_fold{at + 1} AS (SELECT p.* EXCLUDE (proof, f),
  proof || coalesce(x || y, '') AS proof,
  CASE WHEN x IS NULL THEN f ELSE sha256(x || f || y) END AS f
  FROM {name}_fold{at} p JOIN {name}_side{at} s ON s.g = p.g AND s.i = p.i // {16**at})"""
        for at in range(levels)
    )


def _merkle_leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    told = [
        f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')"
        for f in fields
    ]
    return f"sha256({' || '.join(told)})"


_INNER, _OUTER = 8, 4
OP11 = f"""
WITH RECURSIVE {_CRC},
told AS (SELECT doc_id, coalesce('1' || source, '0') AS g, {_merkle_leaf("text")} AS leaf,
  CASE WHEN doc_id IN (SELECT id FROM tampered)
    THEN {_merkle_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")}
    ELSE {_merkle_leaf("text")} END AS claim FROM documents),
leaves AS (SELECT *, count(*) OVER (PARTITION BY g) AS n,
  row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM told),
a0 AS (SELECT g, i, n, leaf AS d FROM leaves),
{_merkle_levels("a", _INNER)},
b_leaves AS (SELECT g AS own, d AS subroot, 0 AS g, count(*) OVER () AS n,
  row_number() OVER (ORDER BY g) - 1 AS i FROM a{_INNER}),
b0 AS (SELECT g, i, n, subroot AS d FROM b_leaves),
{_merkle_levels("b", _OUTER)},
a_fold0 AS (SELECT doc_id, leaf, g, i, '' AS proof, claim AS f FROM leaves),
{_merkle_folds("a", _INNER)},
b_fold0 AS (SELECT doc_id, leaf, subroot, b_leaves.g, b_leaves.i, proof, f
  FROM a_fold{_INNER} p JOIN b_leaves ON own = p.g),
{_merkle_folds("b", _OUTER)}
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, f AS folded_root,
  f = d AS verified FROM b_fold{_OUTER} CROSS JOIN b{_OUTER}
"""


def _either_case(pattern: str) -> str:
    """The letters outside of classes and escapes in both cases."""

    def told(part: re.Match) -> str:
        letter = part.group()
        return f"[{letter.upper()}{letter.lower()}]" if len(letter) == 1 else letter

    return re.sub(r"\[[^\]]*\]|\\x..|\\.|[A-Za-z]", told, pattern)


def _matches(order: int, rule: Rule) -> str:
    pattern = _quoted(_either_case(rule.pattern) if rule.any_case else rule.pattern)
    before = "coalesce(list_sum(list_transform(cut[:i], lambda x: length(x))), 0)"
    found = "coalesce(list_sum(list_transform(found[:i - 1], lambda x: length(x))), 0)"
    return f"""
SELECT r, {order} AS rule, '{rule.kind}' AS kind, {before} + {found} AS first,
  {before} + {found} + length(found[i]) AS stop
FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i
  FROM (SELECT r, string_split_regex(text, {pattern}) AS cut,
      regexp_extract_all(text, {pattern}) AS found,
      regexp_extract_all(text, {pattern}, {rule.group}) AS counted
    FROM d WHERE regexp_matches(text, {pattern})))
WHERE length(counted[i]) >= {rule.least}"""


_TOLD = "string_agg(kind || ':' || first || ':' || stop, ',' ORDER BY first, rule)"
OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text
  FROM documents),
s AS ({" UNION ALL ".join(_matches(i, rule) for i, rule in enumerate(RULES))}),
t AS (SELECT r, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
    count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    {_TOLD} FILTER (WHERE rule < {len(BASE)}) AS base, {_TOLD} AS spans
  FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM d LEFT JOIN t USING (r)
"""

_SHARE = "CAST(1 + (1000000000::HUGEINT * ({} + 1)) // ({} + v) AS HUGEINT)"
OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang,
  coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''),
    '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
w AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(term) AS v, coalesce(sum(c), 0) AS n
  FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
held AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term)
  GROUP BY ALL),
sizes AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN held
  USING (lang, source) GROUP BY ALL),
p AS (SELECT lang, source, term, coalesce(held.c, 0) AS c,
    {_SHARE.format("coalesce(held.c, 0)", "sizes.n")} AS p,
    {_SHARE.format("kept.c", "l.n")} AS q
  FROM sizes JOIN l USING (lang) JOIN kept USING (lang)
  LEFT JOIN held USING (lang, source, term)),
pair AS (SELECT x.lang, x.source, y.source AS item
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source),
far AS (SELECT x.lang, x.source, y.source AS item,
    sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
  GROUP BY ALL),
e AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0) AS value
  FROM pair LEFT JOIN far USING (lang, source, item)
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p
  WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part
  ORDER BY value DESC, item) AS place FROM e)
WHERE part = 'pair' OR place <= 200
"""

ORACLES = {
    "op5_minhash_near_dedup": OP5,
    "op8_benchmark_decontamination": OP8,
    "op9_chat_formatting": OP9,
    "op10_license_scans": OP10,
    "op11_merkle_manifest": OP11,
    "op12_secret_scans": OP12,
    "op13_source_divergence": OP13,
}
