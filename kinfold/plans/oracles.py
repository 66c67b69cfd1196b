"""Equivalent SQL (DuckDB) of the registered queries, as the correctness check."""

from __future__ import annotations

import re

from kinfold.functions.text import ABBREVIATIONS, TITLES
from kinfold.operators.model import LinkModel
from kinfold.plans.catalog import ARRIVALS, FROZEN, MATCH_WEIGHT, NEW_FROM, NOT_ID, NOT_NAME, RULES, SAMPLE_ROWS, U_PAIRS
from kinfold.settings import DATE, DEFAULT_SETTINGS, EXACT
from kinfold.sources.persons import CYRILLIC, LATIN, PLACEHOLDER

COLUMNS = DEFAULT_SETTINGS.columns
TEXTS = [c for c in DEFAULT_SETTINGS.comparisons if c.kind not in (EXACT, DATE)]
TF = [c.column for c in DEFAULT_SETTINGS.comparisons if c.term_frequency]

PERSONS = f"""parts AS (SELECT count(*) AS n FROM part),
persons AS (
  WITH keyed AS (
    SELECT c_custkey AS k, c_nationkey AS nk, c_mktsegment AS seg, CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 9 ELSE c_custkey END AS base FROM customer),
  related AS (SELECT *, CASE WHEN base % 10 = 4 THEN base - 4 ELSE base END AS fam FROM keyed),
  named AS (
    SELECT r.*, a.p_name || ' ' || b.p_name AS nm, f.p_name || ' ' || g.p_name AS fa, m.p_name || ' ' || g.p_name AS mo
    FROM related r, parts
    JOIN part a ON a.p_partkey = r.base % parts.n
    JOIN part b ON b.p_partkey = (r.base * 7 + 3) % parts.n
    JOIN part f ON f.p_partkey = (r.fam * 11 + 5) % parts.n
    JOIN part g ON g.p_partkey = (r.fam * 17 + 2) % parts.n
    JOIN part m ON m.p_partkey = (r.fam * 13 + 1) % parts.n)
  SELECT lpad(cast(nk AS string), 3, '0') || '20240101' || lpad(cast(k AS string), 7, '0') AS record_id,
         CASE k % 50 WHEN 21 THEN '' WHEN 32 THEN '{PLACEHOLDER} ' || k WHEN 16 THEN translate(lower(nm), '{LATIN}', '{CYRILLIC}')
              ELSE (CASE WHEN k % 7 = 0 THEN 'Dr. ' ELSE '' END)
                   || (CASE WHEN k % 20 = 19 THEN substring(nm, 1, 2) || substring(nm, 4, 1) || substring(nm, 3, 1) || substring(nm, 5) ELSE nm END)
                   || (CASE WHEN k % 11 = 0 THEN ', S.Kom' ELSE '' END) END AS full_name,
         CASE WHEN k % 30 <> 29 THEN '11' || lpad(cast(base * 7919 % 99999999 AS string), 14, '0') END AS national_id,
         DATE '1960-01-01' + cast(fam * 7919 % 15000 AS int) AS birth_date,
         CASE WHEN base % 2 = 0 THEN 'L' ELSE 'P' END AS gender,
         CASE WHEN k % 50 <> 43 THEN 'Jl. ' || seg || ' No. ' || cast(base % 300 AS string) || ' Kec. ' || cast(nk AS string) END AS address,
         lpad(cast(nk AS string), 3, '0') AS site_id,
         fa AS father_name, mo AS mother_name, base AS true_entity
  FROM named)"""
CASES = """cases AS (
  SELECT cast(o_orderkey AS varchar) AS case_id,
         lpad(cast(c_nationkey AS varchar), 3, '0') || '20240101' || lpad(cast(c_custkey AS varchar), 7, '0') AS record_id,
         lpad(cast(c_nationkey AS varchar), 3, '0') AS site_id
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
MAPPED = "cif_mapping AS (SELECT record_id FROM persons WHERE true_entity % 17 = 0)"
SOURCE = "record_id, full_name, national_id, birth_date, gender, address, site_id, father_name, mother_name"


def clean(column: str) -> str:
    """The cleaning chain, one replacement per pattern in order."""
    out = f"strip_accents(replace(translate(lower({column}), '{CYRILLIC}', '{LATIN}'), 'ß', 'ss'))"
    for pattern, word in [*((p, "") for p in TITLES), *ABBREVIATIONS]:
        out = f"regexp_replace({out}, '{pattern}', '{word}', 'g')"
    out = f"regexp_replace({out}, '[^a-z0-9\\s]', ' ', 'g')"
    out = f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"
    return f"CASE WHEN {column} <> '' THEN {out} END"


def staged(column: str) -> str:
    """A text of which nothing is left is null."""
    return f"nullif({clean(column)}, '')"


CLEANED = f"""cleaned AS (
  SELECT *, {staged("full_name")} AS clean_name, {staged("address")} AS clean_address,
         {staged("father_name")} AS clean_father, {staged("mother_name")} AS clean_mother
  FROM persons)"""


def _holds(rule) -> str:
    return " AND ".join(f"l.{c} = r.{c}" for c in rule)


def pairs_cte(order: str = "l.record_id < r.record_id", rules=RULES, left: str = "cleaned", name: str = "pairs") -> str:
    """Pairs under the first rule that finds them."""
    parts = []
    for number, rule in enumerate(rules, 1):
        earlier = "".join(f" AND NOT coalesce({_holds(r)}, false)" for r in rules[: number - 1])
        parts.append(f"SELECT l.record_id AS id_l, r.record_id AS id_r, {number} AS rule FROM {left} l JOIN cleaned r ON {_holds(rule)} AND {order}{earlier}")
    return f"{name} AS (" + "\n  UNION ALL ".join(parts) + ")"


def level(c, left: str = "l", right: str = "r") -> str:
    x, y = f"{left}.{c.column}", f"{right}.{c.column}"
    head = f"CASE WHEN {x} IS NULL OR {y} IS NULL THEN -1 WHEN {x} = {y} THEN {c.top}"
    if c.kind == DATE:
        apart = f"abs(datediff('day', {x}, {y})) * 86400"
        head += f" WHEN damerau_levenshtein(cast({x} AS varchar), cast({y} AS varchar)) <= 1 THEN 3"
        head += f" WHEN {apart} <= 2629800 THEN 2 WHEN {apart} <= 63115200 THEN 1"
    for number in range(c.top - 1, 0, -1) if c.kind not in (EXACT, DATE) else ():
        head += f" WHEN jaro_winkler_similarity({x}, {y}) >= {sorted(c.thresholds)[number - 1]} THEN {number}"
    return head + " ELSE 0 END"


def gammas_cte(pairs: str = "pairs", extra: str = "") -> str:
    levels = ", ".join(f"{level(c)} AS gamma_{c.column}" for c in DEFAULT_SETTINGS.comparisons)
    return f"gammas AS (SELECT id_l, id_r, {levels}{extra} FROM {pairs} JOIN cleaned l ON l.record_id = id_l JOIN cleaned r ON r.record_id = id_r)"


TF_CTES = ",\n".join(
    f"tf_{c} AS (SELECT {c} AS value, count(*) AS n, count(*) / (SELECT count({c}) FROM cleaned)::DOUBLE AS tf FROM cleaned WHERE {c} IS NOT NULL GROUP BY {c})" for c in TF
)
TF_EXTRA = "".join(f", (SELECT tf FROM tf_{c} WHERE value = l.{c}) AS tf_{c}" for c in TF)


def weight_parts(model: LinkModel) -> dict[str, str]:
    """What each comparison adds."""
    parts = {}
    for c in model.settings.comparisons:
        gamma = f"gamma_{c.column}"
        cases = "".join(f" WHEN {i} THEN {model.weight(c.column, i)!r}" for i in range(c.top + 1))
        parts[c.column] = f"cast(CASE {gamma}{cases} ELSE 0.0 END AS DOUBLE)"
        if c.term_frequency:
            parts[c.column] += f" + CASE WHEN {gamma} = {c.top} THEN log2({model.u[c.column][c.top]!r} / tf_{c.column}) ELSE 0.0 END"
    return parts


def weights(model: LinkModel) -> str:
    return " + ".join(f"({p})" for p in (repr(model.prior_weight), *weight_parts(model).values()))


SCORED = f"""scored AS (
  SELECT *, 1.0 / (1.0 + pow(2.0, -match_weight)) AS match_probability FROM (SELECT *, cast({weights(FROZEN)} AS DOUBLE) AS match_weight FROM gammas))"""
MATCHED = "edges AS (SELECT id_l AS src, id_r AS dst FROM scored WHERE match_weight >= -4.0 AND match_probability >= 0.9)"
FULL = ",\n".join([PERSONS, CLEANED, TF_CTES, pairs_cte(), gammas_cte(extra=TF_EXTRA), SCORED, MATCHED])


def components(edges: str, of: str = "") -> str:
    """Smallest node reachable from each node: recursive CTEs named ``links``, ``reached`` and ``component``, with ``of`` behind."""
    return f"""links{of} AS (SELECT src AS a, dst AS b FROM {edges} UNION SELECT dst, src FROM {edges}),
reached{of}(node, least) AS (SELECT a, a FROM links{of} UNION SELECT l.b, r.least FROM reached{of} r JOIN links{of} l ON l.a = r.node),
component{of} AS (SELECT node, min(least) AS component FROM reached{of} GROUP BY node)"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def batch_ctes(parts: int, edges: str = "edges", people: str = "cleaned") -> str:
    """The numbers that linking in batches gives, one batch after the other: ``held_b`` after batch b, ``merged_b`` in it.

    ``placed(record_id, batch)`` deals the records. Records that agree on all compared columns go by their smallest
    id. ``{b}`` in the names of ``edges`` and ``people`` stands for the batch.
    """
    ctes = ["held_0 AS (SELECT NULL::VARCHAR AS record_id, NULL::VARCHAR AS cif WHERE false)"]
    for b in range(1, parts + 1):
        pairs, known = edges.format(b=b), people.format(b=b)
        ctes.append(f"""rep_{b} AS (SELECT record_id, batch, min(record_id) OVER (PARTITION BY {", ".join(COLUMNS)}) AS rep FROM {known} JOIN placed USING (record_id)),
touch_{b} AS (SELECT DISTINCT x.rep AS src, y.rep AS dst FROM {pairs} e JOIN rep_{b} x ON x.record_id = e.src JOIN rep_{b} y ON y.record_id = e.dst WHERE x.batch = {b} OR y.batch = {b}),
nodes_{b} AS (SELECT src AS node FROM touch_{b} UNION SELECT dst FROM touch_{b}),
graph_{b} AS (SELECT 'n:' || src AS src, 'n:' || dst AS dst FROM touch_{b}
  UNION ALL SELECT 'n:' || rep, 'c:' || cif FROM held_{b - 1} JOIN rep_{b} USING (record_id) JOIN nodes_{b} ON node = rep),
{components(f"graph_{b}", f"_{b}")},
given_{b} AS (SELECT record_id, CASE WHEN component LIKE 'c:%' THEN substr(component, 3) ELSE 'CIF-' || coalesce(substr(component, 3), record_id) END AS cif
  FROM rep_{b} LEFT JOIN component_{b} ON node = 'n:' || rep WHERE batch = {b}),
merged_{b} AS (SELECT substr(node, 3) AS old_cif, substr(component, 3) AS new_cif FROM component_{b} WHERE node LIKE 'c:%' AND node <> component),
held_{b} AS (SELECT record_id, coalesce(new_cif, cif) AS cif FROM (SELECT * FROM held_{b - 1} UNION ALL SELECT * FROM given_{b}) LEFT JOIN merged_{b} ON old_cif = cif)""")
    return ",\n".join(ctes)


def statistics_sql(parts: int = 3) -> str:
    """The figures of each batch."""
    placed = f"placed AS (SELECT record_id, (row_number() OVER (ORDER BY record_id) - 1) // ((count(*) OVER () + {parts - 1}) // {parts}) + 1 AS batch FROM cleaned)"
    figures = " UNION ALL ".join(
        f"""SELECT {b}::INT AS batch, (SELECT count(*) FROM placed WHERE batch = {b}) AS records, (SELECT count(*) FROM sided WHERE batch = {b}) AS record_pairs,
  (SELECT count(DISTINCT record_id) FROM sided WHERE batch = {b}) AS matched_records, (SELECT count(*) FROM merged_{b}) AS merged_numbers,
  (SELECT count(DISTINCT cif) FROM held_{parts}) AS entities"""
        for b in range(1, parts + 1)
    )
    sided = "sided AS (SELECT record_id, batch FROM (SELECT src AS record_id FROM edges UNION ALL SELECT dst FROM edges) JOIN placed USING (record_id))"
    return with_(FULL, placed, sided, batch_ctes(parts)) + figures


def stream_sql() -> str:
    """Three micro-batches: each is linked with the frequencies, and against the records, that have arrived by then."""
    cut = f"CASE WHEN record_id >= '{ARRIVALS[1]}' THEN 3 WHEN record_id >= '{ARRIVALS[0]}' THEN 2 ELSE 1 END"
    ctes = [PERSONS, CLEANED, f"placed AS (SELECT record_id, {cut} AS batch FROM cleaned)"]
    names = "|".join(["cleaned", "pairs", "gammas", "scored", "edges", *[f"tf_{c}" for c in TF]])
    for b in (1, 2, 3):
        ctes.append(f"cleaned_{b} AS (SELECT * FROM cleaned WHERE {cut} <= {b})")
        ctes.append(re.sub(rf"\b({names})\b", rf"\1_{b}", ",\n".join([TF_CTES, pairs_cte(), gammas_cte(extra=TF_EXTRA), SCORED, MATCHED])))
    ctes.append(batch_ctes(3, "edges_{b}", "cleaned_{b}"))
    return with_(*ctes) + "SELECT n, count(*) AS entities, 3::BIGINT AS batches FROM (SELECT count(*) AS n FROM held_3 GROUP BY cif) GROUP BY n"


def hashed(text: str, seed: int) -> str:
    return f"('0x' || substr(md5({text} || ':{seed}'), 1, 13))::BIGINT"


def stable_id(text: str) -> str:
    digits = f"CASE WHEN regexp_full_match({text}, '[0-9]+') THEN TRY_CAST({text} AS BIGINT) END"
    return f"coalesce({digits}, ('0x' || substr(sha1({text}), 1, 15))::BIGINT)"


def cluster_of(cif: str) -> str:
    return stable_id(f"regexp_replace({cif}, '^CIF-', '')")


def histogram(source: str, column: str, name: str) -> str:
    width = "(hi - lo) / 30"
    number = f"least(floor((v - lo) / ({width})), 29)"
    return f"""SELECT '{name}' AS "column", cast({number} AS INTEGER) AS bin, round(lo + {number} * ({width}), 6) AS low,
  round(lo + ({number} + 1) * ({width}), 6) AS high, count(*) AS n
  FROM (SELECT length({column})::DOUBLE AS v FROM {source} WHERE {column} IS NOT NULL) x, (SELECT min(length({column}))::DOUBLE AS lo, max(length({column}))::DOUBLE AS hi FROM {source}) y
  GROUP BY ALL"""


def top(source: str, column: str) -> str:
    return f"""(SELECT '{column}' AS "column", {column} AS value, count(*) AS n FROM {source} GROUP BY {column} ORDER BY n DESC, value LIMIT 5)"""


def duplicates(source: str, keys: str, where: str = "true") -> str:
    return f"SELECT count(*) AS dup_groups, coalesce(sum(n), 0)::BIGINT AS dup_rows FROM (SELECT count(*) AS n FROM {source} WHERE {where} GROUP BY {keys} HAVING count(*) > 1)"


ELIGIBLE = f"""eligible AS (
  WITH open_cases AS (SELECT case_id, record_id, site_id FROM cases WHERE case_id IS NOT NULL AND site_id IS NOT NULL)
  SELECT record_id, full_name, national_id, birth_date, gender, address, o.site_id, father_name, mother_name, o.case_id
  FROM persons JOIN open_cases o USING (record_id)
  WHERE record_id NOT IN (SELECT record_id FROM cif_mapping) AND length(full_name) > 0
    AND NOT starts_with(full_name, '{NOT_NAME}') AND NOT starts_with(record_id, '{NOT_ID}'))"""
LATEST = "latest AS (SELECT * FROM eligible QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY case_id DESC) = 1)"
STAGED = f"{SOURCE.replace(', father_name, mother_name', '')}, clean_name, clean_address, clean_father, clean_mother"

FIRST = """numbers AS (
  SELECT record_id, 'CIF-' || coalesce(CASE WHEN national_id IS NOT NULL THEN min(record_id) OVER (PARTITION BY national_id) END, record_id) AS cif_number
  FROM cleaned)"""
BRIDGE_EDGES = f"""family AS (SELECT 'n:' || l.record_id AS src, 'n:' || r.record_id AS dst FROM cleaned l JOIN cleaned r ON {_holds(RULES[2])} AND l.record_id < r.record_id),
graph AS (SELECT * FROM family UNION ALL SELECT 'n:' || record_id, 'c:' || cif_number FROM numbers)"""
BRIDGES = with_(PERSONS, CLEANED, FIRST, BRIDGE_EDGES, components("graph"), "merged AS (SELECT substr(node, 3) AS old_cif, substr(component, 3) AS new_cif FROM component WHERE node LIKE 'c:%' AND node <> component)")

U_SLOTS = f"""(SELECT CASE WHEN count(*) * (count(*) - 1) // 2 <= {U_PAIRS} THEN 1 WHEN count(*) <= {U_PAIRS} THEN ceil(count(*) * count(*) / {2 * U_PAIRS}.0)::BIGINT
  ELSE count(*) // 2 END FROM cleaned)"""
U_DRAWN = f"(SELECT count(*) <= {U_PAIRS} FROM cleaned)"


def u_ctes(seed: int) -> tuple[str, ...]:
    """Level counts of random pairs: CTEs up to ``counts``."""
    slot = f"slots AS (SELECT *, {hashed('record_id', seed)} % {U_SLOTS} AS slot FROM cleaned)"
    pairs = f"pairs AS (SELECT l.record_id AS id_l, r.record_id AS id_r FROM slots l JOIN slots r ON l.slot = r.slot AND l.record_id < r.record_id WHERE {U_DRAWN} OR l.slot < {U_PAIRS // 2})"
    parts = [f"SELECT '{c}' AS comparison, gamma_{c} AS level, count(*) AS pairs FROM gammas WHERE gamma_{c} >= 0 GROUP BY gamma_{c}" for c in COLUMNS]
    return PERSONS, CLEANED, slot, pairs, gammas_cte(), f"counts AS ({' UNION ALL '.join(parts)})"


def u_sql() -> str:
    return with_(*u_ctes(5)) + (
        "SELECT comparison, cast(level AS INTEGER) AS level, pairs, round(pairs / sum(pairs) OVER (PARTITION BY comparison)::DOUBLE, 9) AS u FROM counts"
    )


def em_sql(number: int, prior: float = 0.5) -> str:
    rule = RULES[number - 1]
    active = [c for c in DEFAULT_SETTINGS.comparisons if c.column not in rule]
    factors = [f"({prior / (1 - prior)!r})"]
    for c in active:
        cases = "".join(f" WHEN {i} THEN {FROZEN.m[c.column][i] / FROZEN.u[c.column][i]!r}" for i in range(c.top + 1))
        factors.append(f"CASE gamma_{c.column}{cases} ELSE 1.0 END")
        if c.term_frequency:
            factors.append(f"CASE WHEN gamma_{c.column} = {c.top} THEN {FROZEN.u[c.column][c.top]!r} / tf_{c.column} ELSE 1.0 END")
    odds = " * ".join(f"cast({f} AS DOUBLE)" for f in factors)
    chance = f"chance AS (SELECT *, odds / (1 + odds) AS p FROM (SELECT *, {odds} AS odds FROM gammas))"
    parts = [
        f"SELECT '{c.column}' AS comparison, {i} AS level, coalesce(sum(p) FILTER (gamma_{c.column} = {i}), 0) / sum(p) FILTER (gamma_{c.column} >= 0) AS m FROM chance"
        for c in active
        for i in range(c.top + 1)
    ]
    ctes = [PERSONS, CLEANED, TF_CTES, pairs_cte(rules=(rule,)), gammas_cte(extra=TF_EXTRA), chance, f"steps AS ({' UNION ALL '.join(parts)})"]
    return with_(*ctes) + f"SELECT {number} AS rule, comparison, cast(level AS INTEGER) AS level, round(m, 6) AS m, round((SELECT avg(p) FROM chance), 6) AS prior FROM steps"


def em_trained_sql(max_rounds: int = 25, settled: float = 1e-4, tiny: float = 1e-12) -> str:
    """Training to the end: each rule's rounds as a recursive CTE over its comparison vectors, then the medians.

    Parameters of all comparisons stand in one list, in the order of comparisons and levels.
    """
    levels = [(c, i) for c in DEFAULT_SETTINGS.comparisons for i in range(c.top + 1)]
    place = {(c.column, i): n for n, (c, i) in enumerate(levels, 1)}
    start = [0.05 / c.top if i < c.top else 0.95 for c, i in levels]
    counted = [f"greatest(coalesce(max(pairs) FILTER (comparison = '{c.column}' AND level = {i}), 0), 0.5)" for c, i in levels]
    of_column = {c.column: [n for n, (d, _) in enumerate(levels, 1) if d is c] for c in DEFAULT_SETTINGS.comparisons}
    shares = [f"w[{n}] / (" + " + ".join(f"w[{k}]" for k in of_column[c.column]) + ")" for n, (c, _) in enumerate(levels, 1)]
    ctes = [
        *u_ctes(0)[:4],
        u_ctes(0)[4].replace("gammas AS", "u_gammas AS"),
        u_ctes(0)[5].replace("FROM gammas", "FROM u_gammas"),
        f"weighed AS (SELECT [{', '.join(counted)}]::DOUBLE[] AS w FROM counts)",
        f"us AS MATERIALIZED (SELECT [{', '.join(shares)}] AS u FROM weighed)",
        TF_CTES,
        """priors AS (SELECT least(1.0, pairs / 0.7 / (records::DOUBLE * (records - 1) / 2)) AS prior FROM (SELECT (SELECT count(*) FROM cleaned) AS records,
  coalesce(sum(n * (n - 1) / 2.0), 0)::DOUBLE AS pairs FROM (SELECT count(*) AS n FROM cleaned WHERE national_id IS NOT NULL GROUP BY national_id)))""",
        f"model_0 AS (SELECT {start}::DOUBLE[] AS m)",
    ]
    for s, rule in enumerate(RULES, 1):
        active = [c for c in DEFAULT_SETTINGS.comparisons if c.column not in rule]
        keys = ", ".join(f"gamma_{c.column}" for c in active)
        factor = " * ".join(["1.0::DOUBLE"] + [f"CASE WHEN gamma_{c.column} = {c.top} THEN greatest(u[{place[c.column, c.top]}], {tiny}) / tf_{c.column} ELSE 1.0 END" for c in active if c.term_frequency])
        weight = " + ".join(["log2(p / (1 - p))"] + [f"log2(greatest(m[{k}], {tiny}) / greatest(u[{k}], {tiny}))" for k in (place[c, DEFAULT_SETTINGS.comparison(c).top] for c in rule)])
        odds = [f"prior / greatest(1 - prior, {tiny})", "tf_factor"]
        for c in active:
            cases = "".join(f" WHEN {i} THEN greatest(m[{place[c.column, i]}], {tiny}) / greatest(u[{place[c.column, i]}], {tiny})" for i in range(c.top + 1))
            odds.append(f"CASE gamma_{c.column}{cases} ELSE 1.0 END")
        new = []
        for n, (c, i) in enumerate(levels, 1):
            gained = f"coalesce(sum(e) FILTER (gamma_{c.column} = {i}), 0) / nullif(sum(e) FILTER (gamma_{c.column} >= 0), 0)"
            new.append(f"coalesce(greatest({gained}, {tiny}), m[{n}])" if c in active else f"m[{n}]")
        moved = ", ".join(["abs(now - prior)", *[f"abs(ms[{n}] - m[{n}])" for n, (c, _) in enumerate(levels, 1) if c in active]])
        seen = [f"count(*) FILTER (gamma_{c.column} = {i}) > 0" if c in active else "false" for c, i in levels]
        known = [f"[{', '.join(f'taught_{t}.m[{n}]' for t in range(1, s + 1))}]" for n in range(1, len(levels) + 1)]
        medians = [f"coalesce(list_aggregate({k}, 'median'), model_0.m[{n}])" for n, k in enumerate(known, 1)]
        ctes += [
            pairs_cte(rules=(rule,), name=f"pairs_{s}"),
            gammas_cte(f"pairs_{s}", TF_EXTRA).replace("gammas AS", f"gammas_{s} AS"),
            f"vectors_{s} AS MATERIALIZED (SELECT {keys}, {factor} AS tf_factor, count(*)::DOUBLE AS n FROM gammas_{s}, us GROUP BY ALL)",
            f"start_{s} AS (SELECT 1 / (1 + pow(2.0, -greatest(least({weight}, 500), -500))) AS prior, m FROM model_{s - 1}, us, (SELECT least(greatest(prior, {tiny}), 1 - {tiny}) AS p FROM priors))",
            f"""em_{s}(round, prior, m, moved) AS (
  SELECT 0, prior, m, 1.0::DOUBLE FROM start_{s} UNION ALL
  SELECT round + 1, now, ms, greatest({moved}) FROM (
    SELECT round, prior, m, sum(e) / sum(n) AS now, [{", ".join(new)}] AS ms
    FROM (SELECT *, n * odds / (1 + odds) AS e FROM (SELECT *, {" * ".join(odds)} AS odds FROM em_{s}, vectors_{s}, us WHERE round < {max_rounds} AND moved >= {settled}))
    GROUP BY round, prior, m))""",
            f"last_{s} AS (SELECT m, moved FROM em_{s} ORDER BY round DESC LIMIT 1)",
            f"seen_{s} AS (SELECT [{', '.join(seen)}] AS s FROM vectors_{s})",
            f"taught_{s} AS (SELECT [{', '.join(f'CASE WHEN s[{n}] THEN m[{n}] END' for n in range(1, len(levels) + 1))}] AS m FROM last_{s}, seen_{s})",
            f"raw_{s} AS (SELECT [{', '.join(medians)}] AS w FROM model_0, {', '.join(f'taught_{t}' for t in range(1, s + 1))})",
            f"model_{s} AS (SELECT [{', '.join(shares)}] AS m FROM raw_{s})",
        ]
    done = " AND ".join(f"(SELECT moved FROM last_{s}) < {settled}" for s in range(1, len(RULES) + 1))
    label = lambda c, i: c.labels[i].replace("'", "''")
    rows = " UNION ALL ".join(
        f"SELECT '{c.column}' AS comparison, {i}::INT AS level, '{label(c, i)}' AS label, round(m[{n}], 6) AS m, round(u[{n}], 9) AS u, {str(c.term_frequency).lower()} AS tf, round(prior, 12) AS prior FROM model_{len(RULES)}, us, priors"
        for n, (c, i) in enumerate(levels, 1)
    )
    return with_(*ctes) + f"SELECT *, {done} AS settled FROM ({rows})"


ENTITIES = with_(FULL, components("edges"), "entity AS (SELECT c.record_id, coalesce(k.component, c.record_id) AS least FROM cleaned c LEFT JOIN component k ON k.node = c.record_id)")


def resolve_batch_sql(held: str = "true") -> str:
    """New records against known numbers, in the graph of records and numbers."""
    known = f"known AS (SELECT * FROM numbers WHERE record_id < '{NEW_FROM}' AND {held})"
    touching = f"touching AS (SELECT * FROM edges WHERE src >= '{NEW_FROM}' OR dst >= '{NEW_FROM}')"
    nodes = f"nodes AS (SELECT src AS node FROM touching UNION SELECT dst FROM touching UNION SELECT record_id FROM cleaned WHERE record_id >= '{NEW_FROM}')"
    graph = "graph AS (SELECT 'n:' || src AS src, 'n:' || dst AS dst FROM touching UNION ALL SELECT 'n:' || record_id, 'c:' || cif_number FROM known JOIN nodes ON node = record_id)"
    given = f"""given AS (SELECT record_id, CASE WHEN k.component LIKE 'c:%' THEN substr(k.component, 3) ELSE 'CIF-' || coalesce(substr(k.component, 3), record_id) END AS cif_number
      FROM cleaned LEFT JOIN component k ON k.node = 'n:' || record_id WHERE record_id >= '{NEW_FROM}')"""
    return with_(FULL, FIRST, known, touching, nodes, graph, components("graph"), given) + f"SELECT record_id, {cluster_of('cif_number')} AS cluster_id, cif_number FROM given"


SOURCE_COLUMNS = ("record_id", "full_name", "national_id", "birth_date", "gender", "address", "site_id")


def report_sql(profiled=SOURCE_COLUMNS, *more: str) -> str:
    null = "cast(NULL AS varchar)"
    parts = [f"SELECT 'rows' AS metric, {null} AS \"column\", {null} AS item, count(*) AS value FROM persons"]
    source = "cleaned" if more else "persons"
    parts += [f"SELECT 'missing', '{c}', {null}, count(*) - count({c}) FROM {source}" for c in profiled]
    for keys, name, where in (("national_id", "national_id", "national_id IS NOT NULL"), ("full_name, birth_date", "full_name+birth_date", "true")):
        found = duplicates("persons", keys, where)
        parts += [f"SELECT '{m}', '{name}', {null}, {m} FROM ({found})" for m in ("dup_groups", "dup_rows")]
    for c in ("full_name", "address"):
        parts.append(f"""SELECT 'length', "column", cast(round(low, 3) AS varchar), n FROM ({histogram("persons", c, c)})""")
    for c in ("full_name", "site_id"):
        parts.append(f"""SELECT 'frequent', "column", value, n FROM {top("persons", c)}""")
    return with_(PERSONS, *more) + " UNION ALL ".join(parts)


def spread_labels(rounds: int) -> str:
    """The smallest node reachable in ``rounds`` steps, by handing smaller labels to neighbours."""
    ctes = ["labels0 AS MATERIALIZED (SELECT DISTINCT a AS node, a AS label FROM links)"]
    for i in range(rounds):
        ctes.append(
            f"labels{i + 1} AS MATERIALIZED (SELECT node, min(label) AS label FROM (SELECT node, label FROM labels{i} "
            f"UNION ALL SELECT b, label FROM labels{i} JOIN links ON a = node) GROUP BY node)"
        )
    return ",\n".join(ctes)


PART_GRAPH = """links AS MATERIALIZED (
  SELECT DISTINCT 'o' || l_orderkey AS a, 'p' || l_partkey AS b FROM lineitem UNION SELECT DISTINCT 'p' || l_partkey, 'o' || l_orderkey FROM lineitem)"""


def _chosen(share: float, seed: int) -> str:
    return f"{hashed('record_id', seed)} < {int(share * 2**52)}"


def inject_sql(rate: float = 0.2, seed: int = 9) -> str:
    place = f"({hashed('record_id', seed + 3)} % greatest(length(full_name) - 1, 1) + 1)"
    swapped = f"substr(full_name, 1, {place} - 1) || substr(full_name, {place} + 1, 1) || substr(full_name, {place}, 1) || substr(full_name, {place} + 2)"
    return (
        with_(PERSONS)
        + f"""SELECT record_id, full_name, address, record_id AS true_entity FROM persons UNION ALL
SELECT record_id || '-D', CASE WHEN {_chosen(0.5, seed + 1)} AND length(full_name) > 3 THEN {swapped} ELSE full_name END,
  CASE WHEN {_chosen(0.5, seed + 2)} THEN 'Jl. Baru No. ' || cast({hashed("record_id", seed + 4)} % 900 + 1 AS varchar) ELSE address END, record_id
FROM persons WHERE {_chosen(rate, seed)}"""
    )


def _national_digits(date: str, gender: str) -> str:
    return f"lpad(cast(day({date}) + CASE WHEN {gender} = 'P' THEN 40 ELSE 0 END AS varchar), 2, '0') || lpad(cast(month({date}) AS varchar), 2, '0') || lpad(cast(year({date}) % 100 AS varchar), 2, '0')"


def _number(value: str, width: int) -> str:
    return f"lpad(cast({value} AS varchar), {width}, '0')"


NIK = f"""WITH rows AS (
  SELECT c_custkey, DATE '1960-01-01' + cast(c_custkey * 7919 % 15000 AS int) AS birth_date, CASE WHEN c_custkey % 2 = 0 THEN 'L' ELSE 'P' END AS gender, c_nationkey AS nk
  FROM customer),
composed AS (
  SELECT *, {_number("nk + 11", 2)} || {_number("c_custkey % 99 + 1", 2)} || {_number("c_custkey % 97 + 1", 2)} || {_national_digits("birth_date", "gender")} || {_number("c_custkey % 9999 + 1", 4)} AS number
  FROM rows)
SELECT c_custkey, number,
  {_number("nk", 3)} || strftime(DATE '2010-01-01' + cast(c_custkey // 5000 AS int), '%Y%m%d') || {_number("c_custkey % 5000 + 1", 4)} AS record_key,
  CASE WHEN cast(substr(number, 7, 2) AS int) > 40 THEN 'P' ELSE 'L' END AS decoded_gender,
  substr(number, 7, 6) = {_national_digits("birth_date", "gender")} AS agrees
FROM composed"""

PAIRS_OF = "coalesce(sum(n * (n - 1) / 2), 0)::BIGINT"
QUALITY = f""", labelled AS (SELECT least, true_entity, count(*)::DOUBLE AS n FROM entity JOIN persons USING (record_id) GROUP BY ALL),
figures AS (SELECT
  (SELECT {PAIRS_OF} FROM labelled) AS common_pairs,
  (SELECT {PAIRS_OF} FROM (SELECT sum(n) AS n FROM labelled GROUP BY least)) AS found_pairs,
  (SELECT {PAIRS_OF} FROM (SELECT sum(n) AS n FROM labelled GROUP BY true_entity)) AS true_pairs)
SELECT *, round(common_pairs / found_pairs::DOUBLE, 9) AS precision, round(common_pairs / true_pairs::DOUBLE, 9) AS recall FROM figures"""


def _ids(number: int) -> str:
    return with_(PERSONS, CLEANED, pairs_cte(rules=(RULES[number - 1],))) + "SELECT id_l AS record_id_l, id_r AS record_id_r FROM pairs"


def oracle_sql() -> dict[str, str]:
    people = with_(PERSONS)
    cleaned = with_(PERSONS, CLEANED)
    pairs = with_(PERSONS, CLEANED, pairs_cte())
    gammas = with_(PERSONS, CLEANED, pairs_cte(), gammas_cte())
    scored = with_(FULL)
    names = [f"gamma_{c}" for c in COLUMNS]
    estimate = " UNION ALL ".join(
        f"SELECT {i} AS rule, count(*) AS n FROM cleaned WHERE {' AND '.join(f'{c} IS NOT NULL' for c in rule)} GROUP BY {', '.join(rule)}" for i, rule in enumerate(RULES, 1)
    )
    batch = f"(SELECT * FROM cleaned WHERE record_id >= '{NEW_FROM}')"
    queries = {
        "normalize_names": people
        + f"SELECT record_id, {clean('full_name')} AS clean_full_name, {clean('father_name')} AS clean_father_name, {clean('mother_name')} AS clean_mother_name FROM persons",
        "normalize_addresses": people + f"SELECT record_id, {clean('address')} AS clean_address FROM persons",
        "normalize_documents": "SELECT doc_id, strip_accents(replace(text, 'ß', 'ss')) AS plain FROM documents",
        "clean_documents": f"SELECT doc_id, {clean('text')} AS clean FROM documents",
        "extract_keyset": people + f"SELECT {SOURCE} FROM persons WHERE record_id > '010'",
        "extract_limited": people + f"SELECT {SOURCE} FROM persons WHERE record_id > '010' ORDER BY record_id LIMIT 500",
        "extract_half": people + f"SELECT {SOURCE} FROM persons ORDER BY record_id LIMIT (SELECT count(*) // 2 FROM persons)",
        "extract_site_filter": people + f"SELECT {SOURCE} FROM persons WHERE site_id IN ('001', '002')",
        "extract_custom_sql": with_(PERSONS, MAPPED, CASES, ELIGIBLE) + "SELECT * FROM eligible",
        "source_contract": people
        + " UNION ALL ".join(
            [f"SELECT q AS query, 'placeholder' AS kind, p AS item, q = 'good' OR p <> ':limit' AS present, cast(0 AS BIGINT) AS values FROM (VALUES ('good'), ('broken')) a(q), (VALUES (':last_id'), (':limit')) b(p)"]
            + [f"SELECT q, 'column', '{c}', {'true' if c not in ('national_id', 'full_name') else 'q = ' + chr(39) + 'good' + chr(39)}, (SELECT count({c}) FROM persons) FROM (VALUES ('good'), ('broken')) a(q)" for c in SOURCE.split(", ")]
        ),
        "unmapped_anti_join": with_(PERSONS, MAPPED) + "SELECT record_id, full_name, site_id FROM persons p WHERE NOT EXISTS (SELECT 1 FROM cif_mapping m WHERE m.record_id = p.record_id)",
        "case_inner_fanout_latest": with_(PERSONS, MAPPED, CASES, ELIGIBLE, LATEST) + "SELECT record_id, full_name, site_id, case_id FROM latest",
        "staging_rows": cleaned + f"SELECT {STAGED} FROM cleaned",
        "staging_upsert": with_(PERSONS, CLEANED, MAPPED, CASES, ELIGIBLE, LATEST, "delta AS (SELECT record_id, full_name || ' bin ' || case_id AS full_name, site_id FROM latest)")
        + f"""SELECT record_id, full_name, clean_name, site_id FROM cleaned WHERE record_id NOT IN (SELECT record_id FROM delta)
        UNION ALL SELECT record_id, full_name, {staged("full_name")}, site_id FROM delta""",
        "high_water_mark": people + "SELECT site_id, max(record_id) AS position FROM persons GROUP BY site_id UNION ALL SELECT 'all', max(record_id) FROM persons",
        "events_high_water_mark": "SELECT event_type, max(event_id) AS position, count(*) AS n FROM events GROUP BY event_type",
        "mark_processed": with_(PERSONS, CASES)
        + "SELECT site_id, count(*) FILTER (record_id IN (SELECT record_id FROM cases)) AS processed, count(*) FILTER (record_id NOT IN (SELECT record_id FROM cases)) AS pending FROM persons GROUP BY site_id",
        "null_profile": people + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM persons" for c in SOURCE.split(", ")),
        "dup_groups_key": people + duplicates("persons", "national_id", "national_id IS NOT NULL"),
        "dup_groups_name_dob": cleaned + duplicates("cleaned", "clean_name, birth_date"),
        "length_histogram": people + histogram("persons", "full_name", "full_name") + " UNION ALL " + histogram("persons", "address", "address"),
        "document_length_histogram": f"SELECT bin, low, high, n FROM ({histogram('documents', 'text', 'text')})",
        "top_values": people + f"SELECT * FROM {top('persons', 'full_name')} UNION ALL SELECT * FROM {top('persons', 'site_id')}",
        "value_counts": people + "SELECT national_id AS value, count(*) AS n FROM persons GROUP BY national_id",
        "profile_report": report_sql(),
        "profile_staged": report_sql((*SOURCE_COLUMNS, "clean_name", "clean_address", "clean_father", "clean_mother"), CLEANED),
        "extract_resumed": people
        + """SELECT 'row' AS kind, record_id AS name, site_id AS value FROM persons WHERE site_id IN ('001', '002', '003')
        UNION ALL SELECT 'position', '001,002', max(record_id) FROM persons WHERE site_id IN ('001', '002')
        UNION ALL SELECT 'position', '003', max(record_id) FROM persons WHERE site_id = '003'""",
        "order_components": with_(PART_GRAPH, spread_labels(16)) + "SELECT label AS component, count(*) AS nodes FROM labels16 GROUP BY label",
        "sample_rows": people + f"SELECT record_id, full_name FROM persons ORDER BY {hashed('record_id', 3)}, record_id LIMIT {SAMPLE_ROWS // 100}",
        "tf_table": with_(PERSONS, CLEANED, TF_CTES) + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", value, n, round(tf, 9) AS tf FROM tf_{c}" for c in TF),
        "pairs_all_rules": pairs + "SELECT id_l AS record_id_l, id_r AS record_id_r, rule FROM pairs",
        "pair_estimate": cleaned + f"SELECT rule, count(*) AS blocks, max(n) AS largest_block, sum(n * (n - 1) // 2)::BIGINT AS pairs FROM ({estimate}) GROUP BY rule",
        "new_vs_all_pairs": with_(PERSONS, CLEANED, pairs_cte("l.record_id <> r.record_id", left=batch)) + "SELECT id_l AS new_id, id_r AS candidate_id, rule FROM pairs",
        "jaro_winkler_pairs": pairs
        + "SELECT id_l AS record_id_l, id_r AS record_id_r, "
        + ", ".join(f"round(jaro_winkler_similarity(l.{c.column}, r.{c.column}), 6) AS similarity_{c.column}" for c in TEXTS)
        + " FROM pairs JOIN cleaned l ON l.record_id = id_l JOIN cleaned r ON r.record_id = id_r",
        "dob_levels": gammas + "SELECT id_l AS record_id_l, id_r AS record_id_r, gamma_birth_date AS level FROM gammas",
        "order_date_levels": f"""WITH days AS (
          SELECT o_orderkey, cast(o_orderdate AS date) AS birth_date, lag(cast(o_orderdate AS date)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS earlier FROM orders),
        l AS (SELECT o_orderkey AS k, earlier AS birth_date FROM days), r AS (SELECT o_orderkey, birth_date FROM days)
        SELECT o_orderkey, {level(DEFAULT_SETTINGS.comparison("birth_date"))} AS level FROM l JOIN r ON k = o_orderkey""",
        "gamma_pattern_counts": gammas + f"SELECT {', '.join(names)}, count(*) AS pairs FROM gammas GROUP BY {', '.join(names)}",
        "scored_pairs_frozen": scored + "SELECT id_l AS record_id_l, id_r AS record_id_r, round(match_weight, 6) AS match_weight, round(match_probability, 6) AS match_probability FROM scored",
        "pairs_over_threshold": scored
        + "SELECT id_l AS record_id_l, id_r AS record_id_r, round(match_probability, 6) AS match_probability FROM scored WHERE match_weight >= -4.0 AND match_probability >= 0.9",
        "pairs_over_weight": scored
        + f"SELECT id_l AS record_id_l, id_r AS record_id_r, round(match_weight, 6) AS match_weight FROM scored WHERE match_weight >= {MATCH_WEIGHT} AND match_probability >= 0.9",
        "scored_pairs_debug": scored + f"SELECT id_l AS record_id_l, id_r AS record_id_r, {', '.join(names)}, round(match_weight, 6) AS match_weight, "
        + ", ".join(f"round({p}, 6) AS weight_{c}" for c, p in weight_parts(FROZEN).items())
        + " FROM scored",
        "u_from_random_pairs": u_sql(),
        "prior_estimate": cleaned
        + """SELECT records, pairs::BIGINT AS pairs, round(least(1.0, pairs / 0.7 / (records::DOUBLE * (records - 1) / 2)), 12) AS prior
        FROM (SELECT (SELECT count(*) FROM cleaned) AS records, coalesce(sum(n * (n - 1) / 2.0), 0)::DOUBLE AS pairs FROM (SELECT count(*) AS n FROM cleaned WHERE national_id IS NOT NULL GROUP BY national_id))""",
        "em_one_iteration": " UNION ALL ".join(f"SELECT * FROM ({em_sql(i)})" for i in range(1, len(RULES) + 1)),
        "em_trained": em_trained_sql(),
        "connected_components": with_(FULL, components("edges")) + "SELECT node, component FROM component",
        "stable_cluster_id": people + f"SELECT record_id, {stable_id('record_id')} AS numeric_id, {stable_id(chr(39) + 'CIF-' + chr(39) + ' || record_id')} AS hashed_id FROM persons",
        "resolve_entities": ENTITIES + f"SELECT record_id, {cluster_of(chr(39) + 'CIF-' + chr(39) + ' || least')} AS cluster_id, 'CIF-' || least AS cif_number FROM entity",
        "resolve_batch": resolve_batch_sql(),
        "resolve_batch_gaps": resolve_batch_sql("right(record_id, 1) NOT IN ('3', '7')"),
        "bridge_merges": BRIDGES + "SELECT old_cif, new_cif FROM merged",
        "apply_merges": BRIDGES
        + f"SELECT record_id, {cluster_of('coalesce(new_cif, cif_number)')} AS cluster_id, coalesce(new_cif, cif_number) AS cif_number FROM numbers LEFT JOIN merged ON cif_number = old_cif",
        "incremental_two_batches": ENTITIES + "SELECT record_id, least AS entity FROM entity",
        "incremental_three_batches": ENTITIES + "SELECT record_id, least AS entity FROM entity",
        "run_statistics": statistics_sql(),
        "tf_merged": with_(PERSONS, CLEANED, TF_CTES) + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", value, n, round(tf, 9) AS tf FROM tf_{c}" for c in TF),
        "stream_stage_and_link": stream_sql(),
        "record_mapping": ENTITIES + "SELECT record_id, 'CIF-' || least AS cif_number FROM entity",
        "nik_compose_decode": NIK,
        "national_id_quality": people
        + f"""SELECT gender, count(*) FILTER (agrees) AS agree, count(*) FILTER (NOT agrees) AS differ, count(*) FILTER (agrees IS NULL) AS unknown
        FROM (SELECT gender, substr(national_id, 7, 6) = {_national_digits("birth_date", "gender")} AS agrees FROM persons) GROUP BY gender""",
        "inject_duplicates": inject_sql(),
        "pair_precision_recall": ENTITIES + QUALITY,
    }
    queries.update({f"pairs_rule_{i}": _ids(i) for i in range(1, len(RULES) + 1)})
    return queries
