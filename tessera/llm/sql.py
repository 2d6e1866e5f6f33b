"""The operators that SQL can express, for DuckDB: the same results by the plainest way."""

from __future__ import annotations

from .merkle import DIGEST, LEAF_DIGITS, LEAVES, SECTION_DIGITS, SECTION_PARAGRAPHS
from .ngram_join import SHARE, WORDS

_ENDING = ", ".join(f"'{d:x}'" for d in range(0, 16, SECTION_PARAGRAPHS))


def _fingerprint(text: str) -> str:
    """The fingerprint of a text expression, as nested expressions."""
    hashed = f"array_to_string(list_transform(regexp_extract_all({text}, '{LEAVES}'), lambda x: CASE WHEN x = chr(10) THEN ',' ELSE sha256(x) END), '')"
    paragraphs = f"list_transform(string_split({hashed}, ','), lambda p: sha256(p) || ':' || regexp_replace(p, '([0-9a-f]{{{LEAF_DIGITS}}})[0-9a-f]{{{DIGEST - LEAF_DIGITS}}}', '\\1', 'g'))"
    ended = f"array_to_string(list_transform({paragraphs}, lambda p: p || CASE WHEN p[1] IN ({_ENDING}) THEN ';' ELSE ',' END), '')"
    digests = f"array_to_string(list_transform(string_split(x, ','), lambda p: p[1:{DIGEST}]), '')"
    sections = f"list_transform(string_split(e[1:length(e) - 1], ';'), lambda x: sha256({digests}) || '=' || regexp_replace(x, '[0-9a-f]{{{DIGEST}}}:', '', 'g'))"
    return f"(SELECT sha256(array_to_string(list_transform(s, lambda x: x[1:{DIGEST}]), '')) || '/' || array_to_string(list_transform(s, lambda x: x[1:{SECTION_DIGITS}] || x[{DIGEST + 1}:]), ';') FROM (SELECT {sections} AS s FROM (SELECT {ended} AS e)))"


def _leaves(fp: str) -> str:
    return f"list_distinct(regexp_extract_all(regexp_replace({fp}[{DIGEST + 2}:], '[0-9a-f]{{{SECTION_DIGITS}}}=', '', 'g'), '[0-9a-f]{{{LEAF_DIGITS}}}'))"


def _likeness(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect({a}, {b})) / (len({a}) + len({b})) END"


def _differing(mine: str, other: str) -> str:
    """(section, place, paragraph) of the paragraphs in the sections that the other list of sections lacks."""
    numbered = f"list_filter(list_transform({mine}, lambda x, i: {{'s': x, 'i': i - 1}}), lambda x: NOT list_contains({other}, x.s))"
    return f"flatten(list_transform({numbered}, lambda x: list_transform(string_split(x.s[{SECTION_DIGITS + 2}:], ','), lambda p, j: {{'at': x.i || '.' || (j - 1), 'p': p}})))"


def _lacking(mine: str, other: str) -> str:
    return f"coalesce(array_to_string(list_transform(list_filter({mine}, lambda x: NOT list_contains(list_transform({other}, lambda q: q.p), x.p)), lambda x: x.at), ','), '')"


MERKLE = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
 n AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS nt FROM d),
 e AS (SELECT *, t[1:length(t) - length(t) // 4] || substr(nt, 1, length(t) // 4) AS ed FROM n),
 f AS (SELECT doc_id, length(t) AS n_chars, sha256(ed) AS edited_sha256, {_fingerprint('t')} AS fingerprint, {_fingerprint('ed')} AS edited_fingerprint, {_fingerprint('nt')} AS nf FROM e),
 l AS (SELECT *, {_leaves('fingerprint')} AS a, {_leaves('edited_fingerprint')} AS b, {_leaves('nf')} AS c, string_split(fingerprint[{DIGEST + 2}:], ';') AS sa, string_split(edited_fingerprint[{DIGEST + 2}:], ';') AS sb FROM f),
 p AS (SELECT *, {_differing('sa', 'sb')} AS pa, {_differing('sb', 'sa')} AS pb FROM l)
 SELECT doc_id, CAST(n_chars AS BIGINT) AS n_chars, edited_sha256, fingerprint, edited_fingerprint, {_likeness('a', 'b')} AS near_edited, {_likeness('a', 'c')} AS near_next,
 '-' || {_lacking('pa', 'pb')} || ' +' || {_lacking('pb', 'pa')} AS edits FROM p"""

_GRAM = " || ' ' || ".join(f"w[i + {k}]" if k else "w[i]" for k in range(WORDS))

NGRAM_JOIN = f"""WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
 grams AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {WORDS} THEN list_transform(range(1, len(w) - {WORDS - 2}), lambda i: {_GRAM}) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words),
 sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
 pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
 links AS (SELECT x, y FROM pairs JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id WHERE 100 * k >= {SHARE} * (p.n + q.n - k)),
 either_way AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
 reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT a, y FROM reach JOIN either_way ON b = x)
 SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) USING (doc_id)"""
