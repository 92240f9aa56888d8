"""DuckDB SQL for the queries that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"

_COMPONENTS = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w FROM documents
), shingled AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s
    FROM worded
), sized AS (
    SELECT doc_id, len(s) AS n, s FROM shingled
), spread AS (
    SELECT doc_id, n, unnest(s) AS shingle FROM sized
), linked AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM spread a JOIN spread b USING (shingle) WHERE a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
    SELECT a, b FROM linked UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a
), least AS (
    SELECT a, min(b) AS low FROM reach GROUP BY a
)
SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(low, doc_id)) AS kept
FROM sized LEFT JOIN least ON a = doc_id
"""

_EXACT_TOP = """
WITH whole AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER nearest AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW nearest AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5
"""

# Saturated sources are the first in order of size per weight: the budget per
# unit of weight is the first for which the next source is not above its cap.
_MIXED = rf"""
WITH rows_ AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
        CAST('0x' || substr(md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))), 1, 15) AS BIGINT) AS h
    FROM documents
), sized AS (
    SELECT source, sum(size) AS source_size FROM rows_ GROUP BY source
), ranked AS (
    SELECT source, CAST(source_size AS DOUBLE) AS s,
        [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM sized
), ordered AS (
    SELECT *, row_number() OVER (ORDER BY s / w, source) AS k FROM ranked
), levels AS (
    SELECT *, (1.5 * (SELECT sum(s) FROM ranked) - 2 * coalesce(sum(s) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ordered
), chosen AS (
    SELECT level FROM levels WHERE level * w <= 2 * s ORDER BY k LIMIT 1
), planned AS (
    SELECT source, s, least(2 * s, w * (SELECT level FROM chosen)) AS target FROM ranked
), budget AS (
    SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END AS whole FROM planned
), summed AS (
    SELECT r.*, b.s, b.target, b.whole, b.target - b.whole * b.s AS left_,
        coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS upto,
        sum(r.size) OVER (PARTITION BY r.source, r.h) AS tied
    FROM rows_ r JOIN budget b ON r.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target,
    CAST(size * (whole + CASE WHEN upto <= left_ OR (upto - tied <= left_ AND 2 * (left_ - (upto - tied)) >= tied) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed
"""

_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_PHRASES = rf"""
WITH spoken AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + 9], ' ') AS phrase
    FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM spoken WHERE len(w) > 0)
), docs AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') AS w FROM documents
), places AS (
    SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size
), occurs AS (
    SELECT p.row, p.i, p.size, v.item_id FROM places p JOIN windows v ON p.size = v.size AND array_to_string(p.w[p.i:p.i + p.size - 1], ' ') = v.phrase
), hits AS (
    SELECT row, count(*) AS n FROM (SELECT DISTINCT row, unnest(range(i, i + size)) FROM occurs) GROUP BY row
), named AS (
    SELECT row, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS id FROM occurs WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(m.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits h USING (row) LEFT JOIN named m USING (row)
"""

_RANKED = rf"""
WITH documents_ AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') AS w FROM documents
), items AS (
    SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') AS w FROM benchmark
), wanted AS (
    SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(w) AS term FROM items) GROUP BY ALL
), held AS (
    SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM documents_) GROUP BY ALL
), totals AS (
    SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM documents_ WHERE len(w) > 0
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM held, totals GROUP BY term
), adjusted AS (
    SELECT row, doc_id, 75 + ((25 * CAST(len(w) AS BIGINT) * n_docs) // n_terms) AS m FROM documents_, totals WHERE len(w) > 0
), scored AS (
    SELECT item, item_id, row, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM wanted JOIN weights USING (term) JOIN held USING (term) JOIN adjusted USING (row) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""

_COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), sized AS (
    SELECT lang, w, unnest([1, 2, 3, 4]) AS k FROM worded
), grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized WHERE len(w) >= k)
), often AS (
    SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS p FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 30
), totals AS (
    SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang
), cuts AS (
    SELECT lang, phrase, f, cut, array_to_string(p[1:cut], ' ') AS first, array_to_string(p[cut + 1:], ' ') AS rest FROM (SELECT *, unnest(range(1, k)) AS cut FROM often WHERE k > 1)
), scores AS (
    SELECT c.lang, c.phrase, c.f AS a, c.cut, x.f AS l, y.f AS r, CAST((CAST(2000000 AS HUGEINT) * c.f) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
    FROM cuts c JOIN often x ON c.lang = x.lang AND c.first = x.phrase JOIN often y ON c.lang = y.lang AND c.rest = y.phrase
), lowest AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_ AS (
    SELECT lang, f, array_to_string(p[i:i + size - 1], ' ') AS phrase FROM (
        SELECT lang, f, p, size, unnest(range(1, k - size + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS size FROM often WHERE k > 2))
), longer AS (
    SELECT lang, phrase, max(f) AS f FROM inner_ GROUP BY lang, phrase
), kept AS (
    SELECT s.* FROM lowest s LEFT JOIN longer g USING (lang, phrase) WHERE g.f IS NULL OR 100 * CAST(g.f AS HUGEINT) < 80 * CAST(s.a AS HUGEINT)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op5_minhash": _COMPONENTS,
    "op8_kdtree": _EXACT_TOP,
    "op10_mixing": _MIXED,
    "op11_phrase_index": _PHRASES,
    "op12_reversed_search": _RANKED,
    "op13_collocations": _COLLOCATIONS,
}
