"""SQL of the package's queries, as far as SQL can say them. All of it is quadratic or long, and meant for small tables."""

from __future__ import annotations

from tessera.llm.ranking import _A, _B, _C, _D, _LOW

_USABLE = "v IS NOT NULL AND len(v) = 64 AND len(list_filter(v, lambda x: x IS NULL OR isnan(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0"
_STORED = "stored AS (SELECT id, any_value(vector) AS v FROM (SELECT id, vector, rank() OVER (PARTITION BY id ORDER BY updated_at DESC) AS n FROM stored_records WHERE id IS NOT NULL) WHERE n = 1 GROUP BY id)"
_RESPONSES = "responses AS (SELECT id, any_value(v) AS v FROM (SELECT unnest(ids) AS id, unnest(vectors) AS v FROM embed_responses) WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM stored) GROUP BY id)"


def _unit(source: str) -> str:
    return f"u AS (SELECT id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM ({source}) WHERE {_USABLE}), c AS (SELECT a.id AS id, b.id AS other, round(list_dot_product(a.v, b.v), 6) + 0.0 AS cosine FROM u a JOIN u b ON a.id <> b.id)"


_ALL = f"WITH {_STORED}, {_RESPONSES}, {_unit('SELECT * FROM stored UNION ALL SELECT * FROM responses')}, r AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY cosine DESC, other) AS rank, other, cosine FROM c)"
P1_FOUND = f"{_ALL} SELECT DISTINCT least(id, other) AS id_a, greatest(id, other) AS id_b FROM r WHERE rank <= 5 AND cosine >= 0.9"
P1_NEIGHBOURS = f"{_ALL} SELECT id, rank, other, cosine FROM r WHERE rank <= 5"
P7_FOUND = f"WITH {_STORED}, {_unit('SELECT * FROM stored')} SELECT id FROM c WHERE cosine >= 0.9 GROUP BY id HAVING count(*) >= 20"


def _words(c: str) -> str:
    return f"regexp_extract_all(lower(strip_accents({c})), '[0-9a-z]+')"


def _runs(n: int, c: str = "w") -> str:
    return f"list_distinct(list_transform(generate_series(1, len({c}) - {n - 1}), lambda i: array_to_string({c}[i:i + {n - 1}], ' ')))"


_TEXTS = (
    "live AS (SELECT id, max(document) AS t FROM (SELECT id, document, rank() OVER (PARTITION BY id ORDER BY updated_at DESC) AS n FROM stored_records WHERE id IS NOT NULL) WHERE n = 1 GROUP BY id), "
    "texts AS (SELECT id, any_value(text) AS t FROM chunks WHERE text IS NOT NULL GROUP BY id UNION ALL SELECT id, t FROM live WHERE t IS NOT NULL AND id NOT IN (SELECT id FROM chunks))"
)


def _similar(run: int, least: int, num: int, den: int) -> str:
    return (
        f"WITH {_TEXTS}, k AS (SELECT id, {_words('t')} AS w FROM texts), s AS (SELECT id, {_runs(run)} AS r FROM k WHERE len(w) >= {least}), "
        "p AS (SELECT id, len(r) AS n, unnest(r) AS x FROM s), o AS (SELECT a.id AS id_a, b.id AS id_b, a.n AS na, b.n AS nb, count(*) AS o FROM p a JOIN p b ON a.x = b.x AND a.id < b.id GROUP BY ALL), "
        f"e AS (SELECT id_a, id_b FROM o WHERE o * {den} >= {num} * (na + nb - o))"
    )


P2_FOUND = f"{_similar(3, 20, 3, 5)} SELECT id_a, id_b FROM e"
P2_GROUPS = (
    f"{_similar(5, 5, 4, 5).replace('WITH ', 'WITH RECURSIVE ', 1)}, b AS (SELECT id_a AS x, id_b AS y FROM e UNION ALL SELECT id_b, id_a FROM e), "
    "g AS (SELECT x AS id, x AS other FROM b UNION SELECT g.id, b.y FROM g JOIN b ON b.x = g.other), m AS (SELECT id, min(other) AS group_id FROM g GROUP BY id) "
    "SELECT m.id, m.group_id, count(*) AS links FROM m JOIN b ON b.x = m.id GROUP BY ALL"
)
P8_FOUND = (
    f"WITH i AS (SELECT item_id, unnest({_runs(10)}) AS x FROM (SELECT item_id, {_words('text')} AS w FROM eval_items) WHERE len(w) >= 10), "
    f"d AS (SELECT doc_id, unnest({_runs(10)}) AS x FROM (SELECT doc_id, {_words('text')} AS w FROM documents) WHERE len(w) >= 10) SELECT DISTINCT doc_id, item_id FROM d JOIN i USING (x)"
)


def _poly(c: tuple, x: str) -> str:
    out = f"{c[0]!r}::DOUBLE"
    for k in c[1:]:
        out = f"({out} * {x} + {k!r}::DOUBLE)"
    return out


_Q = "sqrt(-2 * ln(greatest(least(p, 1 - p), 1e-300)))"
_R = "(p - 0.5)"
_Z = f"CASE WHEN least(p, 1 - p) >= {_LOW} THEN {_poly(_A, f'({_R} * {_R})')} * {_R} / {_poly(_B, f'({_R} * {_R})')} WHEN p < 0.5 THEN {_poly(_C, _Q)} / {_poly(_D, _Q)} ELSE -({_poly(_C, _Q)} / {_poly(_D, _Q)}) END"
P5_RANKING = f"""
WITH h AS (SELECT query_id, 'keyword' AS lane, id, score AS s FROM keyword_matches UNION ALL SELECT query_id, metric, id, CASE WHEN metric = 'l2' THEN -score ELSE score END FROM dense_hits),
b AS (SELECT query_id, lane, id, max(s) AS s FROM h WHERE s IS NOT NULL AND NOT isnan(s) AND id IS NOT NULL GROUP BY ALL),
p AS (SELECT query_id, lane, id, (rank() OVER (PARTITION BY query_id, lane ORDER BY s) - 1 + count(*) OVER (PARTITION BY query_id, lane, s) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY query_id, lane) AS p FROM b),
z AS (SELECT query_id, lane, id, {_Z} AS z FROM p),
l AS (SELECT query_id, lane, min(z) AS least FROM z GROUP BY ALL),
n AS (SELECT query_id, count(*) AS n, sum(least) AS floor FROM l GROUP BY ALL),
i AS (SELECT z.query_id, z.id, sum(z - least) AS above FROM z JOIN l USING (query_id, lane) GROUP BY ALL),
s AS (SELECT i.query_id, i.id, round((floor + above) / n, 9) AS score FROM i JOIN n USING (query_id))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, round(score, 6) + 0.0 AS score FROM s
"""
