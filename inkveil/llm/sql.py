"""DuckDB SQL for the queries of this package that SQL can express on whole tables."""

WORD = r"[^\x20\x09-\x0D]+"
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

RULE_LEDGER = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, unnest(regexp_extract_all(text, '{WORD}')) AS w, generate_subscripts(regexp_extract_all(text, '{WORD}'), 1) AS i
  FROM t),
n AS (
  SELECT r, w, i, lag(w) OVER (PARTITION BY r ORDER BY i) AS before, lead(w) OVER (PARTITION BY r ORDER BY i) AS w2,
         lead(w, 2) OVER (PARTITION BY r ORDER BY i) AS w3
  FROM w),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, w, w2, w3) AS n FROM n WHERE w3 IS NOT NULL),
repeated AS (SELECT r, count(DISTINCT i + k) AS n FROM windows, range(3) AS s(k) WHERE n > 1 GROUP BY r),
word_sums AS (
  SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars,
         count(*) FILTER (regexp_matches(w, '[A-Za-z\x{{80}}-\x{{10FFFF}}]')) AS n_lettered_words,
         count(*) FILTER (w = before) AS n_adjacent
  FROM n GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t),
line_sums AS (
  SELECT r, count(*) AS n_word_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY r),
m AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(repeated.n, 0) AS n_repeat_words, coalesce(n_word_lines, 0) AS n_word_lines,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
         length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
         coalesce(n_lettered_words, 0) AS n_lettered_words, coalesce(n_adjacent, 0) AS n_adjacent
  FROM t LEFT JOIN word_sums USING (r) LEFT JOIN line_sums USING (r) LEFT JOIN repeated USING (r)),
f AS (
  SELECT *, (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * word_chars < 25 * n_words)::INT
    + 8 * (word_chars > 12 * n_words)::INT + 16 * (10 * n_symbols > n_words)::INT
    + 32 * (100 * n_dup_lines > 30 * n_word_lines)::INT + 64 * (2 * n_capitals > n_letters)::INT
    + 128 * (100 * n_lettered_words < 70 * n_words)::INT + 256 * (100 * n_adjacent > 20 * n_words)::INT AS failures
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, failures::BIGINT AS failures,
       (failures & 3) <> 0 AS base_failed, failures = 0 AS kept
FROM f
"""

DECONTAMINATION = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{TOKEN}') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{TOKEN}') AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
patterns AS (SELECT DISTINCT item_id, m, w[i:i + m - 1] AS pattern FROM starts),
lengths AS (SELECT DISTINCT m FROM patterns),
own_starts AS (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lengths WHERE len(w) >= m),
own AS (SELECT r, m, i, w[i:i + m - 1] AS pattern FROM own_starts),
found AS (SELECT r, own.m AS m, i, item_id FROM own JOIN patterns ON own.m = patterns.m AND own.pattern = patterns.pattern),
hit AS (SELECT r, count(DISTINCT i + k) AS n FROM (SELECT DISTINCT r, m, i FROM found), range(10) AS s(k) WHERE k < m GROUP BY r),
items AS (
  SELECT r, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS named
  FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(named, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id OR page_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.r AS other, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.r <> c.r WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, other))::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

#: `crc_table`, the step of each byte by its rule, for CRC32, which takes the bytes of a text.
CRC_TABLE = """
steps AS (
  SELECT i, 0 AS k, i::BIGINT AS c FROM range(256) AS b(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS step FROM steps WHERE k = 8)"""
CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(strlen({0})),
    lambda i: ('0x' || substr(hex({0}), (2 * i + 1)::INT, 2))::BIGINT)), lambda a, b: xor(a >> 8, step[(xor(a, b) & 255) + 1])))"""

RESAMPLING = rf"""
WITH RECURSIVE {CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{TOKEN}') AS w FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{TOKEN}') AS w FROM benchmark),
own AS (SELECT r, unnest(w) AS w FROM d),
wanted AS (SELECT unnest(w) AS w FROM b),
words AS (SELECT DISTINCT w FROM (SELECT w FROM own UNION ALL SELECT w FROM wanted)),
buckets AS (SELECT w, {CRC32.format('w')} % 10000 AS bucket FROM words, crc_table),
s AS (SELECT bucket, count(*) AS s FROM own JOIN buckets USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM wanted JOIN buckets USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) + 10000 AS s_all, (SELECT coalesce(sum(t), 0) FROM t) + 10000 AS t_all),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * s_all::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * t_all::DOUBLE)))::BIGINT AS gain
  FROM range(10000) AS n(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), totals),
sums AS (SELECT r, sum(gain)::BIGINT AS gain FROM own JOIN buckets USING (w) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, len(w)::BIGINT AS n_features, CASE WHEN len(w) > 0 THEN floor(gain / len(w))::BIGINT ELSE 0 END AS weight,
         ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN sums USING (r)),
noisy AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, r) AS rank, count(*) OVER () AS n
  FROM noisy WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM noisy LEFT JOIN ranked USING (r)
"""

SPELLING = rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
counted AS (SELECT id, run, id || ':' || run AS named, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY id, run),
slips AS (SELECT run, n, {CRC32.format('named')} AS h FROM counted, crc_table),
slipped AS (
  SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM slips),
words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
places AS (SELECT word, n, unnest(range(0, length(word) + 1)) AS i FROM words),
keys AS (
  SELECT word, n, i, substr(word, i + 1, 1) AS letter, substr(word, 1, i) AS head, substr(word, i + 2) AS rest
  FROM places WHERE i < length(word)
  UNION ALL
  SELECT word, n, i, substr(word, i + 1, 1), substr(word, 1, i), substr(word, i + 1) FROM places),
near AS (
  SELECT a.word, b.word AS other, b.n FROM keys AS a JOIN keys AS b USING (i, head, rest)
  WHERE a.word <> b.word AND a.letter <> b.letter),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS best_n, min_by(other, struct_pack(a := -n, b := other)) AS best FROM near GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
         CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root FROM forms
  UNION ALL
  SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root WHERE forms.form IS NOT NULL),
roots AS (SELECT chain.word, root FROM chain JOIN forms ON forms.word = chain.root WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n FROM forms JOIN roots USING (word)
"""
