"""DuckDB statements that compute the results of the registered queries independently."""

CAPS = r"""
WITH RECURSIVE valid AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM valid a JOIN valid b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT vec_id AS node, vec_id AS other FROM valid
  UNION SELECT r.node, s.b FROM reached r JOIN steps s ON r.other = s.a),
found AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM steps GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links,
  coalesce(component_id, vec_id) AS component_id,
  coalesce(vec_id = coalesce(component_id, vec_id), false) AS kept
FROM embeddings LEFT JOIN found ON vec_id = node LEFT JOIN counts ON vec_id = a
"""

JACCARD = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 4 THEN words ELSE words[i:i + 3] END AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - 3) + 1)) AS i
    FROM texts WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
sized AS (SELECT s.doc_id, hash(shingle) AS shingle, n FROM shingles s JOIN sizes USING (doc_id)),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sized a JOIN sized b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
steps AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS node, doc_id AS other FROM sizes
  UNION SELECT r.node, s.b FROM reached r JOIN steps s ON r.other = s.a),
found AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node)
SELECT t.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, t.doc_id)
  AS component_id
FROM texts t LEFT JOIN sizes z ON t.doc_id = z.doc_id LEFT JOIN found f ON t.doc_id = f.node
"""

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
    (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(text, '\\', '\\\\', 'g'),
    '<(/?s>|\|)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g') AS formatted
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
    ORDER BY turn, role, text)) AS loss_sha256,
  sum(length(role) + length(formatted) + 8)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""

MIXING = r"""
WITH measured AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS source,
    ('0x' || left(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 15))::BIGINT AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][((row_number() OVER (ORDER BY left(source, 1) DESC, source)) - 1) % 3 + 1] AS weight
  FROM measured GROUP BY source),
levels AS (
  SELECT *, 2.0::DOUBLE * source_size AS most,
    row_number() OVER by_limit AS place,
    (1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT
     - coalesce(sum(2.0::DOUBLE * source_size) OVER
        (by_limit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER (by_limit ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT
      AS level
  FROM sources WINDOW by_limit AS (ORDER BY 2.0::DOUBLE * source_size / weight, source)),
first_free AS (SELECT min(place) AS place FROM levels WHERE level <= most / weight),
goals AS (
  SELECT source, source_size, CASE WHEN f.place IS NULL OR l.place < f.place THEN most
    ELSE least(most, weight * (SELECT level FROM levels WHERE place = f.place)) END AS target
  FROM levels l, first_free f),
budgets AS (
  SELECT *, floor(target + 0.5)::BIGINT AS budget,
    CASE WHEN source_size = 0 THEN 0 ELSE floor(target + 0.5)::BIGINT // source_size END AS epochs
  FROM goals)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size,
  budget - epochs * source_size - (sum(size) OVER (PARTITION BY source ORDER BY key, doc_id
    ROWS UNBOUNDED PRECEDING) - size))))::BIGINT AS taken
FROM measured JOIN budgets USING (source)
"""

QUALITY = r"""
WITH texts AS (SELECT doc_id, coalesce('s' || source, 'n') AS host, coalesce(text, '') AS text
  FROM documents),
split AS (
  SELECT doc_id, host, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    list_filter(string_split(text, chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
numbered AS (SELECT row_number() OVER () AS rid, * FROM split),
windows AS (
  SELECT rid, i, [words[i], words[i + 1], words[i + 2]] AS tri
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM numbered)),
repeated AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, tri) AS n FROM windows)
  WHERE n > 1),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM repeated, range(3) r(k) GROUP BY rid),
measured AS (
  SELECT doc_id, host, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM numbered LEFT JOIN covered USING (rid)),
flagged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    100 * n_symbols > 10 * n_words OR (100 * n_dup_lines > 50 * n_lines AND n_dup_lines > 3)
    OR 100 * word_chars < 200 * n_words OR 100 * word_chars > 1200 * n_words AS soft
  FROM measured),
hosts AS (
  SELECT host, count(*) AS n, sum((base_failed OR soft)::INT)::DOUBLE AS f
  FROM flagged GROUP BY host),
means AS (SELECT sum(f) / sum(n) AS mean FROM hosts),
spread AS (
  SELECT mean, sum(n * (f / n - mean) * (f / n - mean)) / sum(n) AS variance
  FROM hosts, means GROUP BY mean),
prior AS (
  SELECT mean, least(1e6, greatest(1.0,
    CASE WHEN variance > 0 THEN mean * (1 - mean) / variance - 1 ELSE 1e6 END)) AS strength
  FROM spread),
verdicts AS (
  SELECT host, (f + mean * strength) / (n + strength) > 0.05 AS bad_host FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (soft AND bad_host) AS kept
FROM flagged JOIN verdicts USING (host)
"""

SEARCH = r"""
WITH texts AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 1, item_id, text FROM benchmark),
terms AS (
  SELECT kind, id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM texts),
lengths AS (SELECT id AS doc_id, count(*) AS n FROM terms WHERE kind = 0 GROUP BY id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths),
asked AS (SELECT DISTINCT id AS item_id, term FROM terms WHERE kind = 1),
counts AS (
  SELECT id AS doc_id, term, count(*) AS tf FROM terms
  WHERE kind = 0 AND term IN (SELECT term FROM asked) GROUP BY id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, totals GROUP BY term, docs),
scores AS (
  SELECT item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT
      AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER best AS rank, doc_id, score FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER best <= 50
"""
