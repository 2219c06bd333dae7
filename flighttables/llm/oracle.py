"""DuckDB SQL for the corpus queries that SQL can express (ids are taken to be unique)."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ITEM_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
               r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS m FROM (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
wins AS (SELECT DISTINCT item, m, w[i:i + m - 1] AS k FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM b)),
dw AS (SELECT doc_id, m, i, w[i:i + m - 1] AS k
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM wins))),
hits AS (SELECT doc_id, i, dw.m, item FROM dw JOIN wins ON dw.k = wins.k),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
wins AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS k FROM (SELECT *, unnest(range(1, len(w) - 18)) AS i FROM d)),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM wins) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""

QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
wins AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 7], ' ')) AS k FROM (SELECT *, unnest(range(1, len(w) - 6)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM wins) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
shapes AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE substr(ltrim(line), 1, 1) IN ('-', '*', '•', '·')) AS bullets,
                  count(*) FILTER (WHERE rtrim(line) LIKE '%...' OR rtrim(line) LIKE '%…') AS cut
           FROM lines WHERE trim(line) <> '' GROUP BY 1),
tops AS (SELECT doc_id, max(n) AS n FROM (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM d) GROUP BY 1, 2) GROUP BY 1),
c AS (SELECT d.doc_id, len(w) AS n_words, CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
             coalesce(list_sum([strlen(x) FOR x IN w]), 0) AS word_bytes,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines,
             coalesce(covered.n, 0) AS n_repeat_words, len(regexp_extract_all(t, '\pL')) AS letters, len(regexp_extract_all(t, '\p{{Lu}}')) AS capitals,
             len(regexp_extract_all(t, '[!?]')) AS calls, coalesce(tops.n, 0) AS top, coalesce(shapes.n, 0) AS n_lines,
             coalesce(bullets, 0) AS bullets, coalesce(cut, 0) AS cut
      FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN shapes USING (doc_id) LEFT JOIN tops USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (10 * n_symbols > n_words OR (letters >= 20 AND 2 * capitals > letters) OR 2 * calls > n_words
           OR word_bytes < 2 * n_words OR word_bytes > 20 * n_words OR 10 * letters < 4 * word_chars OR 10 * top > 4 * n_words
           OR (n_lines >= 5 AND 10 * bullets > 9 * n_lines) OR (n_lines >= 5 AND 2 * cut > n_lines)) AS kept
FROM f"""

JACCARD_JOIN = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 3], ' ')) AS k
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS id, a AS other FROM edges UNION SELECT id, b FROM reach JOIN edges ON other = a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.least, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT id, min(other) AS least FROM reach GROUP BY 1) c ON c.id = d.doc_id"""

HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
r AS (SELECT p.*, other AS negative_id, score AS negative_score,
             CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 5"""

ORACLE_SQL = {"op4_decontamination": DECONTAMINATION, "op5_substring_dedup": SUBSTRING_DEDUP, "op6_quality_rules": QUALITY_RULES,
              "op11_jaccard_join": JACCARD_JOIN, "op12_hard_negatives": HARD_NEGATIVES}
