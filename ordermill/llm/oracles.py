"""SQL twins of the training-data queries that SQL can say as a whole."""

from __future__ import annotations

_HARD_NEGATIVES = """
WITH usable AS (
    SELECT row_number() OVER () AS place,
           vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vec
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.place AS anchor, a.vec_id AS anchor_id, a.label AS anchor_label, c.place, c.vec_id, c.label,
           coalesce(list_sum(list_transform(list_zip(a.vec, c.vec, true), lambda z: z[1] * z[2])), 0)::BIGINT AS score
    FROM usable a JOIN usable c ON c.place <> a.place
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor, anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) AS nth
    FROM scored WHERE label = anchor_label
    QUALIFY nth <= 5
), ranked AS (
    SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor, p.nth ORDER BY n.score DESC, n.vec_id NULLS LAST) AS rank
    FROM positives p JOIN scored n ON n.anchor = p.anchor AND n.label <> p.anchor_label
    WHERE 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""

_PHRASE_COLLOCATIONS = """
WITH texts AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), pieces AS (
    SELECT row_number() OVER () AS piece, lang, list_filter(string_split_regex(part, '[ \\t]+'), lambda w: w <> '') AS words
    FROM (SELECT doc, lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS part FROM texts)
), totals AS (
    SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang
), counts AS (
    SELECT lang, len(phrase) AS size, phrase, count(*) AS f
    FROM (
        SELECT lang, unnest(flatten(list_transform([1, 2, 3], lambda m:
            list_transform(range(1, len(words) - m + 2), lambda i: words[i : i + m - 1])))) AS phrase
        FROM pieces
    )
    GROUP BY ALL HAVING count(*) >= 10
), cuts AS (
    SELECT c.lang, c.size, c.phrase, c.f AS a, k.k, x.f AS l, y.f AS r,
           (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
    FROM counts c
    JOIN (SELECT unnest([1, 2]) AS k) k ON k.k < c.size
    JOIN counts x ON x.lang = c.lang AND x.phrase = c.phrase[1 : k.k]
    JOIN counts y ON y.lang = c.lang AND y.phrase = c.phrase[k.k + 1 :]
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, part, max(a) AS most
    FROM (
        SELECT lang, phrase[1 : 2] AS part, a FROM lowest WHERE size = 3
        UNION ALL SELECT lang, phrase[2 : 3], a FROM lowest WHERE size = 3
    )
    GROUP BY ALL
), ranked AS (
    SELECT w.lang, array_to_string(w.phrase, ' ') AS phrase, a, l, r, t.n, score
    FROM lowest w JOIN totals t USING (lang) LEFT JOIN inside i ON i.lang = w.lang AND i.part = w.phrase
    WHERE i.most IS NULL OR 100 * i.most < 50 * w.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM ranked QUALIFY rank <= 2000
"""

_SUBSTRING_DEDUP = r"""
WITH texts AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), starts AS (
    SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM texts
), windows AS (
    SELECT doc_id, start, row_number() OVER (PARTITION BY words[start : start + 19] ORDER BY doc_id, start) AS turn FROM starts
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS pos FROM windows WHERE turn > 1
), flat AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM texts
), judged AS (
    SELECT f.doc_id, f.word, f.pos, c.pos IS NOT NULL AS gone FROM flat f LEFT JOIN covered c ON c.doc_id = f.doc_id AND c.pos = f.pos
), joined AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
           string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS kept
    FROM judged GROUP BY doc_id
)
SELECT t.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN joined j ON j.doc_id = t.doc_id
"""

_BENCHMARK_DECONTAMINATION = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), items AS (
    SELECT DISTINCT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), wanted AS (
    SELECT DISTINCT item, len(words[start : start + 12]) AS size, words[start : start + 12] AS phrase
    FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 11, 2))) AS start FROM items WHERE len(words) > 0)
), found AS (
    SELECT d.doc_id, w.item, s.start, s.size
    FROM (SELECT doc_id, size, unnest(range(1, len(words) - size + 2)) AS start, words FROM docs, (SELECT DISTINCT size FROM wanted)) s
    JOIN docs d ON d.doc_id = s.doc_id
    JOIN wanted w ON w.size = s.size AND w.phrase = s.words[s.start : s.start + s.size - 1]
), hits AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(start, start + size)) AS pos FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.words) AS contaminated
FROM docs d LEFT JOIN hits h ON h.doc_id = d.doc_id LEFT JOIN named n ON n.doc_id = d.doc_id
"""

_NGRAM_JACCARD_JOIN = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, words[start : start + 3] AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS start FROM texts WHERE len(words) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    WHERE 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), lowest AS (
    SELECT a, min(b) AS low FROM reach GROUP BY a
)
SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles, least(t.doc_id, coalesce(l.low, t.doc_id)) AS component_id
FROM texts t LEFT JOIN sizes s ON s.doc_id = t.doc_id LEFT JOIN lowest l ON l.a = t.doc_id
"""


def all_oracles() -> dict[str, str]:
    return {
        "op3_substring_dedup": _SUBSTRING_DEDUP,
        "op9_ngram_jaccard_join": _NGRAM_JACCARD_JOIN,
        "op10_benchmark_decontamination": _BENCHMARK_DECONTAMINATION,
        "op12_hard_negatives": _HARD_NEGATIVES,
        "op13_phrase_collocations": _PHRASE_COLLOCATIONS,
    }
