"""Check SQL (DuckDB) of the training-data queries that SQL can express."""

from __future__ import annotations

from chroniq.llm.common import LOWER, UPPER, WORD_PATTERN, words_of
from chroniq.llm.license_scan import PHRASES, TEMPLATES, THRESHOLD, template_words


def words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{WORD_PATTERN}')"


def shingles(w: str, size: int = 5) -> str:
    """Distinct shingles of a word list, each as one string."""
    runs = f"list_transform(generate_series(1, greatest(len({w}) - {size - 1}, 1)), lambda i: array_to_string({w}[i : i + {size - 1}], ' '))"
    return f"CASE WHEN len({w}) = 0 THEN [] ELSE list_distinct({runs}) END"


OP9 = f"""
WITH d AS (SELECT doc_id, {words("text")} AS w FROM documents),
s AS (SELECT row_number() OVER () AS r, doc_id, {shingles("w")} AS held FROM d),
b AS (SELECT item_id, {words("text")} AS w FROM benchmark),
i AS (SELECT row_number() OVER () AS q, item_id, {shingles("w")} AS wanted FROM b),
ix AS (SELECT q, unnest(wanted) AS g FROM i),
sx AS (SELECT r, unnest(held) AS g FROM s),
n AS (SELECT r, q, count(*) AS n_found FROM sx JOIN ix USING (g) GROUP BY r, q)
SELECT doc_id, item_id, len(wanted) AS n_item_shingles, n_found, n_found / len(wanted) AS containment
FROM n JOIN s USING (r) JOIN i USING (q) WHERE n_found >= 0.8 * len(wanted)
"""

OP1 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {words("text")} AS w FROM documents),
t AS (
    SELECT array_to_string(w, ' ') AS k, any_value(w) AS w, count(*) AS copies, min(doc_id) AS least
    FROM d WHERE len(w) > 0 GROUP BY 1
),
s AS (SELECT row_number() OVER (ORDER BY k) AS v, k, copies, least, {shingles("w")} AS held FROM t),
x AS (SELECT v, unnest(held) AS g FROM s),
p AS (SELECT a.v AS a, b.v AS b, count(*) AS n FROM x a JOIN x b ON a.g = b.g AND a.v <> b.v GROUP BY 1, 2),
e AS (
    SELECT p.a, p.b FROM p JOIN s sa ON sa.v = p.a JOIN s sb ON sb.v = p.b
    WHERE n >= 0.8 * (len(sa.held) + len(sb.held) - n)
),
reach AS (SELECT v AS a, v AS b FROM s UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
c AS (SELECT reach.a AS v, min(s.least) AS class_id FROM reach JOIN s ON s.v = reach.b GROUP BY 1),
l AS (SELECT e.a AS v, sum(s.copies) AS links FROM e JOIN s ON s.v = e.b GROUP BY 1)
SELECT d.doc_id, CASE WHEN s.v IS NULL THEN d.doc_id ELSE c.class_id END AS class_id,
    coalesce(s.copies, 1) AS n_copies, CAST(coalesce(s.copies - 1, 0) + coalesce(l.links, 0) AS BIGINT) AS n_links
FROM d LEFT JOIN s ON s.k = array_to_string(d.w, ' ') AND len(d.w) > 0
LEFT JOIN c ON c.v = s.v LEFT JOIN l ON l.v = s.v
"""

_PHRASES = ", ".join(f"('{label}', {p.split()})" for label, p in PHRASES.items())
_TEMPLATES = ", ".join(
    f"('{label}', {[w.decode() for w in ws]}, {2 * len(words_of(TEMPLATES[label].encode()))})" for label, ws in template_words(TEMPLATES).items()
)

OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {words("text")} AS w FROM documents),
p(label, phrase) AS (VALUES {_PHRASES}),
c(label, wanted, span) AS (VALUES {_TEMPLATES}),
s AS (
    SELECT r, label, unnest(list_filter(generate_series(0, len(w) - len(phrase)), lambda i: w[i + 1 : i + len(phrase)] = phrase)) AS place
    FROM d, p WHERE len(w) >= len(phrase) AND list_contains(w, phrase[1])
),
b AS (
    SELECT r, count(*) AS n, min(place) AS first_word, max(place) AS last_word,
        array_to_string(list_sort(list_distinct(list(label))), ',') AS labels FROM s GROUP BY r
),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS line_no FROM d),
lw AS (SELECT r, line_no, {words("line")} AS ws, list_distinct(ws) AS held FROM l),
runs AS (SELECT r, line_no - row_number() OVER (PARTITION BY r ORDER BY line_no) AS run, line_no, ws FROM lw WHERE len(ws) > 0),
placed AS (SELECT *, sum(len(ws)) OVER (PARTITION BY r, run ORDER BY line_no) - len(ws) AS before FROM runs),
pw AS (SELECT r, run, unnest(ws) AS word, before + generate_subscripts(ws, 1) AS pos FROM placed),
cw AS (SELECT label, unnest(wanted) AS word, len(wanted) AS size, span FROM c),
wins AS (
    SELECT r, label, size, count(DISTINCT word) OVER (
        PARTITION BY r, run, label ORDER BY pos RANGE BETWEEN CURRENT ROW AND span - 1 FOLLOWING) AS n
    FROM pw JOIN cw USING (word)
),
m AS (
    SELECT r, label, len(list_intersect(held, wanted)) / len(wanted) AS share FROM lw, c
    WHERE len(list_intersect(held, wanted)) >= {THRESHOLD} * len(wanted) - 1e-9
    UNION ALL SELECT r, label, max(n) / any_value(size) FROM wins WHERE n >= {THRESHOLD} * size - 1e-9 GROUP BY r, label
),
x AS (SELECT r, label FROM m UNION SELECT r, label FROM s),
y AS (SELECT r, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels FROM x GROUP BY r),
z AS (SELECT r, max(share) AS share FROM m GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(b.n, 0) AS n_base, b.first_word, b.last_word, coalesce(b.labels, '') AS base_labels,
    coalesce(y.labels, '') AS labels, CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(z.share, 0)::DOUBLE END AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN y USING (r) LEFT JOIN z USING (r)
"""

OP8 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        CAST(list_sum(list_transform(generate_series(1, len(q.x)), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""

OP13 = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
    SELECT q.vec_id AS anchor_id, c.vec_id AS vec_id, q.label = c.label AS same,
        CAST(list_sum(list_transform(generate_series(1, len(q.x)), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0
),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same
    ) WHERE n <= 5
)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS n
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    WHERE 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
) WHERE n <= 3
"""
