"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from kinfold.llm import decontaminate as d
from kinfold.llm import licenses as n
from kinfold.llm.common import LOWER, SPACE, UPPER
from kinfold.llm.queries import FIRST_CAPTURE
from kinfold.llm.warc import REVISIT_BYTES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


EXACT = f"""
WITH docs AS (
  SELECT doc_id, length(coalesce(text, '')) AS len, regexp_replace(coalesce(text, ''), '{SPACE}+', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM docs WINDOW best AS (PARTITION BY norm ORDER BY len DESC, doc_id NULLS LAST)"""

_URL = "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)"
WARC = f"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, strlen(coalesce(html, '')) AS size, sha256(coalesce(html, '')) AS digest FROM pages),
k AS (
  SELECT *, min(CASE WHEN size >= {REVISIT_BYTES} THEN page_id END) OVER (PARTITION BY digest) AS least,
         CASE WHEN url = '' THEN '-' WHEN NOT regexp_matches(url, '{_URL}') THEN lower(url)
              ELSE array_to_string(list_reverse(string_split(lower(regexp_extract(url, '{_URL}', 1)), '.')), ',') || ')'
                   || lower(coalesce(nullif(regexp_extract(url, '{_URL}', 2), ''), '/')) END AS url_key
  FROM p)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
       CASE WHEN size >= {REVISIT_BYTES} AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= {REVISIT_BYTES} AND page_id <> least THEN least END AS refers_to, url_key,
       row_number() OVER (PARTITION BY url_key ORDER BY {FIRST_CAPTURE} + coalesce(page_id, 0), page_id NULLS LAST) AS capture
FROM k"""

# The checksum goes over the bytes one by one, with the usual table, here made from its rule.
SHARDS = """
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
steps AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
summed AS (
  SELECT doc_id, size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) AS text_crc32
  FROM sized, steps),
walk AS (
  SELECT DISTINCT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 16))::UBIGINT::HUGEINT AS k, 0::BIGINT AS pos, 0::BIGINT AS shard, 0::BIGINT AS grown FROM documents
  UNION ALL
  SELECT doc_id, k2, floor((pos + 1)::DOUBLE * (2147483648.0::DOUBLE / (k2 // 8589934592 + 1)::DOUBLE))::BIGINT,
         CASE WHEN pos < 16 THEN pos ELSE shard END, pos
  FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616 AS k2 FROM walk WHERE pos <= 16)),
landed AS (SELECT doc_id, shard, grown FROM walk WHERE pos > 16)
SELECT s.doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard, grown::INT AS grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(concat_ws('|', coalesce(s.doc_id::VARCHAR, ''), size, text_crc32)), s.doc_id NULLS FIRST) - 1 AS slot
FROM summed s JOIN landed l ON s.doc_id IS NOT DISTINCT FROM l.doc_id"""

LINES = f"""
WITH parts AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM parts),
often AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(o.key) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (o.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN often o ON k.key = o.key GROUP BY doc_id"""


def _canonical(text: str) -> str:
    """Line by line, since the pattern of copyright lines looks ahead, which not every engine can."""
    team = f"regexp_full_match(x, {_text(n.WITH_TEAM)}) AND NOT regexp_matches(x, {_text('^' + n.NO_HOLDER)})"
    gone = f"regexp_full_match(x, {_text(n.WITH_YEAR)}) OR regexp_full_match(x, {_text(n.WITH_SIGN)}) OR ({team})"
    out = f"array_to_string(list_transform(string_split(lower(translate({text}, chr(2), ' ')), chr(10)), lambda x: CASE WHEN {gone} THEN '' ELSE x END), chr(10))"
    for pattern, replacement in n.SPELLINGS:
        if "(" in pattern:
            out = f"regexp_replace({out}, {_text(pattern)}, {_text(replacement.replace('$1', chr(92) + '1'))}, 'g')"
        else:
            out = f"replace({out}, {_text(pattern)}, {_text(replacement)})"
    return f"trim(regexp_replace(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'), '[ \\n]+', ' ', 'g'))"


LICENSES = f"""
WITH docs AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g') AS text FROM documents),
cut AS (SELECT doc_id, text, regexp_split_to_array(text, '\\n[ \\t]*\\n') AS ps, string_split(text, chr(10)) AS ls FROM docs),
units AS (
  SELECT doc_id, 'text' AS unit, text AS body FROM cut
  UNION ALL SELECT doc_id, 'paragraph', unnest(ps) FROM cut WHERE len(ps) > 1
  UNION ALL SELECT doc_id, 'line', unnest(ls) FROM cut WHERE len(ls) > 1),
known AS (SELECT DISTINCT license, {_canonical("text")} AS form
  FROM (VALUES {", ".join(f"({_text(a)}, {_text(b)})" for a, b in n.NOTICES + n.headers() + n.full_texts())}) v(license, text))
SELECT doc_id, license, unit, count(*) AS n_matches
FROM (SELECT doc_id, unit, {_canonical("body")} AS form FROM units) u JOIN known USING (form) WHERE form <> '' GROUP BY ALL"""


def _windows(table: str, keys: str) -> str:
    """The windows of the operator, known by their words instead of a hash."""

    def words(values: list[str]) -> str:
        return ", ".join(map(_text, values))

    clean = "regexp_replace(translate(coalesce(text, ''), chr(1), ''), '([0-9])[.,:/]([0-9])', '\\1\\2', 'g')"
    clean = f"regexp_replace({clean}, {_text(d.STARTS)}, '\\1\\2' || chr(1) || '\\3', 'g')"
    clean = f"trim(regexp_replace(regexp_replace({clean}, {_text(d.NOISE)}, ' ', 'g'), {_text(d.SPACES)}, ' ', 'g'))"
    low = "lower(ltrim(w, chr(1)))"
    name = "w[1] <> chr(1) AND w[1] <> lower(w[1]) AND w[2] <> upper(w[2])"
    form = f"CASE WHEN w[1] BETWEEN '0' AND '9' OR {low} IN ({words(d.NUMBERS)}) THEN '<n>' WHEN {low} IN ({words(d.UNITS)}) THEN '<u>' WHEN {name} THEN '<p>' ELSE {low} END"
    return f"""
  SELECT {keys}, pos, wide, array_to_string(f[pos:pos + wide - 1], ' ') AS form,
         list_filter(list_transform(range(pos, pos + wide), lambda j: CASE WHEN f[j] IN ('<n>', '<u>', '<p>') THEN lower(ltrim(ws[j], chr(1))) END), lambda x: x IS NOT NULL) AS slots
  FROM (SELECT *, unnest(range(1, len(ws) - wide + 2)) AS pos
        FROM (SELECT {keys}, ws, list_transform(ws, lambda w: {form}) AS f, least({d.WINDOW}, len(ws)) AS wide
              FROM (SELECT {keys}, string_split({clean}, ' ') AS ws FROM {table})))
  WHERE wide - len(list_filter(f[pos:pos + wide - 1], lambda x: x IN ('<n>', '<u>', '<p>'))) >= {d.LITERAL}"""


LEAKS = f"""
WITH seen AS ({_windows("documents", "doc_id")}), known AS ({_windows("benchmark", "item_id")}),
totals AS (SELECT item_id, count(*) AS n_item_windows FROM known GROUP BY item_id),
met AS (SELECT doc_id, item_id, s.pos - k.pos AS shift, s.pos, s.wide, list_zip(k.slots, s.slots) AS fills FROM seen s JOIN known k USING (form)),
passages AS (
  SELECT doc_id, item_id, shift, count(DISTINCT pos) AS n_windows, min(pos) AS from_token, max(pos + wide - 1) AS to_token, list_distinct(flatten(list(fills))) AS fills
  FROM met GROUP BY ALL)
SELECT doc_id, item_id, CASE WHEN len(list_filter(fills, lambda x: x[1] <> x[2])) = 0 THEN 'exact' ELSE 'changed' END AS kind,
       n_windows, n_item_windows, from_token::INT AS from_token, to_token::INT AS to_token
FROM passages JOIN totals USING (item_id)
WHERE n_windows >= least({d.LEAK_TOKENS - d.WINDOW + 1}, greatest(1, n_item_windows - 1)) AND len(fills) = len(list_distinct(list_transform(fills, lambda x: x[1])))"""

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^ \\t]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, p, len(p) AS k, count(*) AS f FROM (
    SELECT lang, unnest(list_transform(range(1, len(w) + 1), lambda i: [w[i]])) AS p FROM pieces
    UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]])) FROM pieces
    UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: [w[i], w[i + 1], w[i + 2]])) FROM pieces)
  GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
often AS (SELECT * FROM grams WHERE f >= 10),
cuts AS (
  SELECT c.lang, c.p, c.k, c.f AS a, x.f AS l, y.f AS r, x.k AS cut, (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS at_word FROM often WHERE k > 1) c
  JOIN often x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, at_word) JOIN often y ON y.lang = c.lang AND y.p = list_slice(c.p, at_word + 1, c.k)),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, part, max(f) AS most FROM (
    SELECT lang, p[1:2] AS part, f FROM often WHERE k = 3 UNION ALL SELECT lang, p[2:3], f FROM often WHERE k = 3)
  GROUP BY ALL),
kept AS (
  SELECT s.*, array_to_string(p, ' ') AS phrase FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.part = s.p
  WHERE s.k = 3 OR most IS NULL OR 100 * most < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INT AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000"""

NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.vec, b.vec)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score QUALIFY rank <= 3"""

ORACLES: dict[str, str] = {
    "op1_exact_dedup": EXACT,
    "op2_warc": WARC,
    "op4_jump_hash_shards": SHARDS,
    "op8_decontamination": LEAKS,
    "op9_license_scan": LICENSES,
    "op10_line_dedup": LINES,
    "op11_collocations": COLLOCATIONS,
    "op12_hard_negatives": NEGATIVES,
}
