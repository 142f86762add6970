"""SQL for the operators that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i
        FROM split WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, m.n, n.n
  HAVING 100 * count(*) >= 75 * (m.n + n.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other
), component AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id,
       d.doc_id = c.component_id AS kept
FROM documents d JOIN component c ON c.doc_id = d.doc_id
LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

OP3 = r"""
WITH split AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), word AS (
  SELECT doc_id, lang, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split
), win AS (
  SELECT doc_id, i, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' '
         || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS five
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), twice AS (
  SELECT doc_id, i FROM win WHERE five IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM twice, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM split)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), joined AS (
  SELECT doc_id, lang, len(words) AS n_words, array_to_string(words, '') AS j FROM split
), classes AS (
  SELECT doc_id, lang, n_words, length(j) AS word_chars,
         length(regexp_replace(j, '[^\p{Ll}]+', '', 'g')) AS c0,
         length(regexp_replace(j, '[^\p{Lu}]+', '', 'g')) AS c1,
         length(regexp_replace(j, '[^#*$%&|<>]+', '', 'g')) AS c2,
         length(regexp_replace(j, '[^!"''()+,\-./:;=?@\[\\\]^_`{}~]+', '', 'g')) AS c3,
         length(regexp_replace(j, '[^\p{Nd}]+', '', 'g')) AS digits
  FROM joined
), class_bins AS (
  SELECT doc_id, lang, n_words, 'c' AS kind, unnest([0, 1, 2, 3, 4]) AS bin,
         unnest([c0, c1, c2, c3, word_chars - digits - c0 - c1 - c2 - c3]) AS n
  FROM classes
), common AS (
  SELECT lang, w, row_number() OVER (PARTITION BY lang ORDER BY docs DESC, w) - 1 AS bin
  FROM (SELECT lang, lower(w) AS w, count(DISTINCT doc_id) AS docs FROM word
        WHERE length(w) <= 4 GROUP BY lang, lower(w))
  QUALIFY bin < 20
), used AS (
  SELECT x.doc_id, c.bin, count(*) AS n
  FROM word x JOIN common c ON c.lang IS NOT DISTINCT FROM x.lang AND c.w = lower(x.w)
  GROUP BY x.doc_id, c.bin
), word_bins AS (
  SELECT j.doc_id, j.lang, j.n_words, 'w' AS kind, c.bin, coalesce(u.n, 0) AS n
  FROM joined j JOIN common c ON c.lang IS NOT DISTINCT FROM j.lang
  LEFT JOIN used u ON u.doc_id = j.doc_id AND u.bin = c.bin
  UNION ALL
  SELECT j.doc_id, j.lang, j.n_words, 'w', 20, j.n_words - coalesce(sum(u.n), 0)
  FROM joined j LEFT JOIN used u ON u.doc_id = j.doc_id
  GROUP BY j.doc_id, j.lang, j.n_words
), shares AS (
  SELECT doc_id, lang, n_words, kind, bin,
         CASE WHEN sum(n) OVER d > 0 THEN n::DOUBLE / sum(n) OVER d ELSE 0 END AS share
  FROM (SELECT * FROM class_bins UNION ALL SELECT * FROM word_bins)
  WINDOW d AS (PARTITION BY doc_id, kind)
), ranked AS (
  SELECT lang, kind, bin, round(share * 1000) AS share,
         row_number() OVER (PARTITION BY lang, kind, bin ORDER BY round(share * 1000)) AS r,
         count(*) OVER (PARTITION BY lang, kind, bin) AS documents
  FROM shares WHERE n_words >= CASE kind WHEN 'c' THEN 10 ELSE 50 END
), medians AS (
  SELECT lang, kind, bin, documents,
         CASE WHEN sum(share) OVER l > 0 THEN share / sum(share) OVER l ELSE 0 END AS q
  FROM ranked WHERE r = (documents + 1) // 2 WINDOW l AS (PARTITION BY lang, kind)
), distances AS (
  SELECT s.doc_id, s.kind, sqrt(greatest(sum(
           CASE WHEN s.share > 0 THEN s.share * log2(2 * s.share / (s.share + m.q)) ELSE 0 END
         + CASE WHEN m.q > 0 THEN m.q * log2(2 * m.q / (s.share + m.q)) ELSE 0 END) / 2, 0)) AS d
  FROM shares s JOIN medians m
    ON m.lang IS NOT DISTINCT FROM s.lang AND m.kind = s.kind AND m.bin = s.bin
  WHERE s.n_words >= CASE s.kind WHEN 'c' THEN 10 ELSE 50 END AND m.documents >= 20
  GROUP BY s.doc_id, s.kind
), base AS (
  SELECT c.doc_id, c.n_words::BIGINT AS n_words, c.word_chars::BIGINT AS word_chars,
         c.c2::BIGINT AS n_symbols, coalesce(l.n, 0)::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         c.n_words < 10 OR 100 * coalesce(r.n, 0) > 20 * c.n_words AS base_failed
  FROM classes c LEFT JOIN lines l ON l.doc_id = c.doc_id
  LEFT JOIN repeats r ON r.doc_id = c.doc_id
)
SELECT b.*, NOT b.base_failed AND coalesce(c.d, 0) <= 0.2 AND coalesce(w.d, 0) <= 0.35 AS kept
FROM base b
LEFT JOIN distances c ON c.doc_id = b.doc_id AND c.kind = 'c'
LEFT JOIN distances w ON w.doc_id = b.doc_id AND w.kind = 'w'
"""

OP11 = r"""
WITH split AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), word AS (
  SELECT doc, lang, source, unnest(terms) AS term FROM split
), kept AS (
  SELECT lang, term FROM word GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
), size AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), grp AS (
  SELECT DISTINCT lang, source FROM split
), used AS (
  SELECT w.lang, w.source, w.term, count(*) AS n
  FROM word w JOIN kept k ON k.lang = w.lang AND k.term = w.term GROUP BY ALL
), counts AS (
  SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n
  FROM grp g JOIN kept k ON k.lang = g.lang
  LEFT JOIN used u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term
), shares AS (
  SELECT c.lang, c.source, c.term, c.n,
         1 + (1000000000::HUGEINT * (c.n + 2)) // (sum(c.n) OVER (PARTITION BY c.lang, c.source) + 2 * s.v) AS p
  FROM counts c JOIN size s ON s.lang = c.lang
), whole AS (
  SELECT x.lang, x.term, 1 + (1000000000::HUGEINT * (x.n + 2)) // (sum(x.n) OVER (PARTITION BY x.lang) + 2 * s.v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term) x JOIN size s ON s.lang = x.lang
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source
  GROUP BY a.lang, a.source, b.source
), terms AS (
  SELECT a.lang, a.source, a.term AS item, (a.p - w.q) * (a.p - w.q) // (a.p + w.q) AS value
  FROM shares a JOIN whole w ON w.lang = a.lang AND w.term = a.term WHERE a.n > 0 AND a.p > w.q
), both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM grp a JOIN grp b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', item, value FROM terms
)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM both_parts
QUALIFY part = 'pair' OR rank <= 10
"""

OP12 = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, vec_id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id))::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""

ORACLES: dict[str, str] = {
    "op1_minhash_odd_sketch": OP1,
    "op3_distribution_divergence": OP3,
    "op11_source_stripes": OP11,
    "op12_inverted_multi_index": OP12,
}
