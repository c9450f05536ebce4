"""SQL twins of the operators that SQL can say in full."""

from tierlake.llm.licences import GAPS, LOWER, TEMPLATES, UPPER
from tierlake.llm.queries import ORACLES


def _template_rows() -> str:
    """One row per word of each template: number, label, base, place, word, whether it is mandatory."""
    return ",\n    ".join(
        f"({number}, '{t.label}', {t.base}, {place}, '{word}', {place in t.fixed_places()})"
        for number, t in enumerate(TEMPLATES) for place, word in enumerate(t.words)
    )


ORACLES["op1_licences"] = rf"""
WITH templates(t, label, base, place, word, fixed) AS (VALUES
    {_template_rows()}
), d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                      '{GAPS.replace("[", "[^")}') AS words FROM documents
), places AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(0, len(words))) AS i FROM d
), has AS (
    SELECT word, count(DISTINCT doc_id) AS n FROM places WHERE word IN (SELECT word FROM templates) GROUP BY word
), idf AS (
    SELECT v.word, 1 + ln(((SELECT count(*) FROM documents) + 1) / CAST(coalesce(has.n, 0) + 1 AS DOUBLE)) AS idf
    FROM (SELECT DISTINCT word FROM templates) v LEFT JOIN has ON v.word = has.word
), weighted AS (
    SELECT templates.*, idf / sum(idf) OVER (PARTITION BY t) AS weight,
           row_number() OVER (PARTITION BY t ORDER BY idf DESC, place) AS rarity,
           fixed AND row_number() OVER (PARTITION BY t, fixed ORDER BY idf DESC, place) = 1 AS rarest_fixed
    FROM templates JOIN idf ON templates.word = idf.word
), starts AS (
    SELECT DISTINCT places.doc_id, a.t, places.i - a.place AS start
    FROM places JOIN weighted a ON places.word = a.word
    WHERE a.rarity <= CASE WHEN a.base THEN 1 ELSE 2 END OR a.rarest_fixed
), compared AS (
    SELECT s.doc_id, s.start, w.label, w.base,
           bool_and(NOT w.fixed OR coalesce(p.word = w.word, FALSE)) AS fixed,
           round(least(coalesce(sum(w.weight) FILTER (p.word = w.word), 0), 1), 6) AS score
    FROM starts s JOIN weighted w ON s.t = w.t
    LEFT JOIN places p ON p.doc_id = s.doc_id AND p.i = s.start + w.place
    GROUP BY s.doc_id, s.start, s.t, w.label, w.base
), found AS (
    SELECT doc_id, max(score) AS score, count(*) FILTER (fixed AND score >= 0.8 AND base) AS n_base,
           min(start) FILTER (fixed AND score >= 0.8 AND base) AS first_word,
           max(start) FILTER (fixed AND score >= 0.8 AND base) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (fixed AND score >= 0.8 AND base) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (fixed AND score >= 0.8) AS labels
    FROM compared GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM d LEFT JOIN found ON d.doc_id = found.doc_id
"""

ORACLES["op2_top_k"] = r"""
WITH v AS (
    SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum([q.x[i] * c.x[i] FOR i IN range(1, len(q.x) + 1)]) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10
"""

ORACLES["op3_warc"] = r"""
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
    SELECT page_id, payload_bytes, array_to_string([substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        ((CAST('0x' || substr(h, 10 * (i // 8) + 1, 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31) + 1, 1
    ) FOR i IN range(0, 32)], '') AS payload_digest FROM p
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS original FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM f
"""

ORACLES["op10_substring_dedup"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
    SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM d
), windows AS (
    SELECT doc_id, start, array_to_string(words[start:start + 19], ' ') AS seq FROM starts
), later AS (
    SELECT doc_id, start, row_number() OVER (PARTITION BY seq ORDER BY doc_id, start) AS place FROM windows
), gone AS (
    SELECT DISTINCT doc_id, start + unnest(range(0, 20)) AS i FROM later WHERE place > 1
), placed AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d
), kept AS (
    SELECT placed.doc_id, count(gone.i) AS n_removed,
           string_agg(word, ' ' ORDER BY placed.i) FILTER (gone.i IS NULL) AS kept
    FROM placed LEFT JOIN gone ON placed.doc_id = gone.doc_id AND placed.i = gone.i GROUP BY placed.doc_id
)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


ORACLES["op11_divergence"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
), places AS (
    SELECT row, lang, source, unnest(words) AS term FROM d
), kept AS (
    SELECT lang, term, count(*) AS n FROM places GROUP BY lang, term HAVING count(DISTINCT row) >= 3
), counts AS (
    SELECT p.lang, p.source, p.term, count(*) AS n
    FROM places p JOIN kept k ON p.lang = k.lang AND p.term = k.term GROUP BY p.lang, p.source, p.term
), langs AS (
    SELECT lang, count(*) AS size, sum(n) AS total FROM kept GROUP BY lang
), sources AS (
    SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total
    FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source
    GROUP BY g.lang, g.source
), dense AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
           CAST(1 + (1000000000 * (coalesce(c.n, 0) + 1)::HUGEINT) // (s.total + l.size) AS HUGEINT) AS p,
           CAST(1 + (1000000000 * (k.n + 1)::HUGEINT) // (l.total + l.size) AS HUGEINT) AS q
    FROM sources s JOIN kept k ON s.lang = k.lang JOIN langs l ON s.lang = l.lang
    LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
), parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(v.value, 0) AS BIGINT) AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM dense WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def _codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Assignments and means, a pair of common table expressions for each round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
    SELECT part, vec_id, position, min(ROW(distance, entry)) AS best FROM (
        SELECT p.part, p.vec_id, p.position, b.entry,
               list_sum([(p.x[j] - b.x[j]) * (p.x[j] - b.x[j]) FOR j IN range(1, len(p.x) + 1)]) AS distance
        FROM parts p JOIN b{r} b ON p.part = b.part)
    GROUP BY part, vec_id, position)""")
        if r < rounds:
            steps.append(f"""b{r + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{r} b LEFT JOIN (
        SELECT part, entry, list(mean ORDER BY j) AS x FROM (
            SELECT part, entry, j, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS mean
            FROM (SELECT p.part, a.best[2] AS entry, unnest(p.x) AS v, unnest(range(1, len(p.x) + 1)) AS j
                  FROM parts p JOIN a{r} a ON p.part = a.part AND p.position = a.position)
            GROUP BY part, entry, j)
        GROUP BY part, entry) m ON b.part = m.part AND b.entry = m.entry)""")
    return f"""
WITH v AS MATERIALIZED (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS position,
           [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), parts AS MATERIALIZED (
    SELECT vec_id, position, part, x[1 + part * len(x) // {parts} : (part + 1) * len(x) // {parts}] AS x
    FROM v, (SELECT unnest(range(0, {parts})) AS part)
), b0 AS MATERIALIZED (
    SELECT part, position - 1 AS entry, x FROM parts WHERE position <= {entries}
), {", ".join(steps)}, digest AS (
    SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds}
), coded AS (
    SELECT v.vec_id, v.label, string_agg(format('{{:02x}}', a.best[2]), '' ORDER BY a.part) AS code,
           CAST(sum(a.best[1]) AS BIGINT) AS error
    FROM v JOIN a{rounds} a ON v.position = a.position GROUP BY v.vec_id, v.label, v.position
)
SELECT vec_id, code, error, label, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, digest
"""


ORACLES["op12_vector_codes"] = _codes()
