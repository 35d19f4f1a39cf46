"""The same queries in DuckDB SQL, written from the rule definitions and not from the Spark plans.

Each statement is put together from named steps (CTEs); STEPS holds them in order of dependence.
"""

from __future__ import annotations

import re


def _lines(tol: float) -> str:
    """The line fold as recursion over the words of each page."""
    return f"""fold AS (
  SELECT doc_id, page_no, ord, word_idx, y0 AS mean, 0 AS line_no FROM ordered WHERE ord = 1
  UNION ALL
  SELECT o.doc_id, o.page_no, o.ord, o.word_idx,
         CASE WHEN abs(o.y0 - f.mean) <= {tol} THEN (f.mean + o.y0) / 2 ELSE o.y0 END,
         CASE WHEN abs(o.y0 - f.mean) <= {tol} THEN f.line_no ELSE f.line_no + 1 END
  FROM fold f JOIN ordered o ON o.doc_id = f.doc_id AND o.page_no = f.page_no AND o.ord = f.ord + 1
)"""


_WORDS = r"""cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \n\t\r]+'), lambda t: t <> '') AS toks FROM documents{source}
), tok AS (
  SELECT doc_id, unnest(toks) AS token, unnest(range(len(toks))) AS i FROM cut
), words{suffix} AS (
  SELECT doc_id, CAST(i // 600 + 1 AS INTEGER) AS page_no, i AS word_idx, x0, y0,
         x0 + 5.0 * least(length(text), 10) AS x1, y0 + 9.0 AS y1, text
  FROM (SELECT doc_id, i, 36.0::DOUBLE + 52.0::DOUBLE * (i % 10) AS x0,
               36.0::DOUBLE + 12.0::DOUBLE * ((i // 10) % 60) + 0.0625::DOUBLE * ((i * 7) % 5) AS y0,
               CASE WHEN i % 37 = 0 THEN token || ':' ELSE token END AS text FROM tok)
)"""

_STORED = """stored AS (
  SELECT doc_id, text FROM documents
  UNION ALL SELECT -page_id - 1, ' ' || chr(10) FROM pages WHERE page_id % 11 = 7
)"""

_MEASURED_DOCS = " WHERE doc_id IN (SELECT doc_id FROM items)"


def _steps(tol: float, all_pages: bool, source: str = "") -> dict[str, str]:
    only_text_page = "" if all_pages else " WHERE page_no = 1"
    return {
        "words_all": _WORDS.format(suffix="_all", source=source),
        "words": f"words AS (SELECT * FROM words_all{only_text_page})",
        "doc_pages": """doc_pages AS (
  SELECT DISTINCT doc_id, page_no, 0.0::DOUBLE AS bx0, 0.0::DOUBLE AS by0,
         595.0::DOUBLE AS width, 842.0::DOUBLE AS height FROM words_all
)""",
        "ordered": """ordered AS (
  SELECT *, round_even(y0, 1) AS yr,
         row_number() OVER (PARTITION BY doc_id, page_no ORDER BY round_even(y0, 1), x0, word_idx) AS ord
  FROM words
)""",
        "fold": _lines(tol),
        "tokens": """tokens AS (
  SELECT o.*, f.line_no,
         row_number() OVER (PARTITION BY o.doc_id, o.page_no, f.line_no ORDER BY o.ord) - 1 AS pos,
         count(*) OVER (PARTITION BY o.doc_id, o.page_no, f.line_no) AS line_len
  FROM ordered o JOIN fold f USING (doc_id, page_no, ord)
)""",
        "rule_labels": """rule_labels AS (
  SELECT * FROM (VALUES ('the:', 'redact'), ('de:', 'redact'), ('der:', 'redact'), ('is:', 'redact'),
                        ('of:', 'keep'), ('la:', 'keep'), ('and:', 'keep')) AS t(label, action)
)""",
        "regions": """regions AS (
  SELECT * FROM (VALUES (1, 0, 0.375, 0.25, 0.625, 0.5), (1, 1, 50, 50, 200, 80),
                        (2, 0, 0.125, 0.125, 0.375, 0.25), (2, 1, 0.75, 0.5, 0.5, 0.625),
                        (2, 2, 100, 200, 400, 250)) AS t(page_no, region_id, r0, r1, r2, r3)
)""",
        "labelled": """labelled AS (
  SELECT t.*, r.action FROM tokens t LEFT JOIN rule_labels r
    ON r.label = CASE WHEN t.text LIKE '%:' THEN t.text ELSE t.text || ':' END
)""",
        "bounded": """bounded AS (
  SELECT *, coalesce(min(CASE WHEN action IS NOT NULL THEN pos END) OVER (
              PARTITION BY doc_id, page_no, line_no ORDER BY pos
              ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), line_len) AS next_pos
  FROM labelled
)""",
        "spans": """spans AS (
  SELECT doc_id, page_no, line_no, pos AS label_pos, pos + 1 AS start_pos, next_pos AS end_pos
  FROM bounded WHERE action = 'redact' AND next_pos > pos + 1
)""",
        "value_boxes": """value_boxes AS (
  SELECT s.doc_id, s.page_no, s.line_no, s.label_pos,
         min(x0) - 1 AS rx0, min(y0) - 1 AS ry0, max(x1) + 1 AS rx1, max(y1) + 1 AS ry1
  FROM spans s JOIN tokens t ON t.doc_id = s.doc_id AND t.page_no = s.page_no AND t.line_no = s.line_no
                            AND t.pos >= s.start_pos AND t.pos < s.end_pos
  GROUP BY ALL
)""",
        "tails": """tails AS (
  SELECT c.doc_id, c.page_no, c.line_no, c.pos,
         min(t.x0) - 1 AS rx0, min(t.y0) - 1 AS ry0, max(t.x1) + 1 AS rx1, max(t.y1) + 1 AS ry1
  FROM tokens c JOIN tokens t ON t.doc_id = c.doc_id AND t.page_no = c.page_no AND t.line_no = c.line_no
                             AND t.pos >= c.pos
  WHERE c.text IN ('that', 'that:', 'que')
  GROUP BY ALL
)""",
        "line_boxes": """line_boxes AS (
  SELECT doc_id, page_no, line_no, min(x0) - 1 AS rx0, min(y0) - 1 AS ry0, max(x1) + 1 AS rx1, max(y1) + 1 AS ry1,
         string_agg(text, ' ' ORDER BY pos) AS line_text
  FROM tokens GROUP BY ALL
)""",
        "hits": """hits AS (
  SELECT * FROM words WHERE lower(text) LIKE '%that%' OR lower(text) LIKE '%que%'
)""",
        "signatures": """nearest AS (
  SELECT l.*, row_number() OVER (PARTITION BY h.doc_id, h.page_no, h.word_idx
                                 ORDER BY h.y0 - l.ry1, l.line_no) AS rank
  FROM hits h JOIN line_boxes l ON l.doc_id = h.doc_id AND l.page_no = h.page_no
   AND l.ry1 <= h.y0 AND h.y0 - l.ry1 <= 10 AND l.rx1 > h.x0 - 50 AND l.rx0 < h.x1 + 50
), signatures AS (
  SELECT DISTINCT doc_id, page_no, line_no, rx0, ry0, rx1, ry1 FROM nearest
  WHERE rank = 1 AND line_text NOT LIKE '%:%'
)""",
        "clamped": """clamped AS (
  SELECT p.*, g.region_id,
         greatest(0, least(1, r0)) AS a0, greatest(0, least(1, r1)) AS b0,
         greatest(0, least(1, r2)) AS a1, greatest(0, least(1, r3)) AS b1
  FROM doc_pages p JOIN regions g USING (page_no)
)""",
        "fixed": """fixed AS (
  SELECT doc_id, page_no, region_id,
         bx0 + width * least(a0, a1) AS rx0, by0 + height * least(b0, b1) AS ry0,
         bx0 + width * greatest(a0, a1) AS rx1, by0 + height * greatest(b0, b1) AS ry1
  FROM clamped
)""",
        "plan": """plan AS (
  SELECT DISTINCT * FROM (
    SELECT doc_id, page_no, 'value' AS rule, rx0, ry0, rx1, ry1 FROM value_boxes
    UNION ALL SELECT doc_id, page_no, 'register_tail', rx0, ry0, rx1, ry1 FROM tails
    UNION ALL SELECT doc_id, page_no, 'signature', rx0, ry0, rx1, ry1 FROM signatures
    UNION ALL SELECT doc_id, page_no, 'region', rx0, ry0, rx1, ry1 FROM fixed
  ) WHERE rx1 > rx0 AND ry1 > ry0 AND page_no = 1
)""",
        "kept": """kept AS (
  SELECT * FROM tokens t WHERE page_no = 1 AND NOT EXISTS (
    SELECT 1 FROM plan b WHERE b.doc_id = t.doc_id AND b.page_no = t.page_no
     AND t.x0 < b.rx1 AND t.x1 > b.rx0 AND t.y0 < b.ry1 AND t.y1 > b.ry0)
)""",
        "kept_lines": """kept_lines AS (
  SELECT doc_id, page_no, line_no, string_agg(text, ' ' ORDER BY pos) AS line_text, count(*) AS n_words
  FROM kept GROUP BY ALL
)""",
    }


_EVENTS = r"""source AS (
  SELECT page_id, url, html, page_id % 7 AS kind, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host,
         regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1) || '_' || page_id AS stem FROM pages
), records AS (
  SELECT page_id // 10 AS event_id, page_id, url, html,
         CAST(row_number() OVER (PARTITION BY page_id // 10 ORDER BY page_id) - 1 AS INTEGER) AS pos,
         CASE WHEN kind = 3 THEN 'aws:sqs' ELSE 'aws:s3' END AS event_source,
         CASE WHEN kind = 6 THEN '' ELSE host END AS bucket,
         CASE page_id % 11 WHEN 3 THEN page_id + 1000000000000 WHEN 7 THEN -page_id - 1 ELSE page_id END AS doc_id,
         CASE kind WHEN 1 THEN 'in/' || stem || '.PDF' WHEN 2 THEN 'in/' || stem || '.txt' WHEN 4 THEN NULL
                   WHEN 5 THEN 'in/a+b%20c/' || stem || '.pdf' ELSE 'in/' || stem || '.pdf' END AS raw_key
  FROM source
), items AS (
  SELECT event_id, pos, bucket, replace(replace(raw_key, '+', ' '), '%20', ' ') AS key, page_id, doc_id, url, html
  FROM records
  WHERE event_source = 'aws:s3' AND bucket <> '' AND raw_key IS NOT NULL AND lower(raw_key) LIKE '%.pdf'
)"""

_KEYED = """keyed AS (
  SELECT *, regexp_replace(key, '[^/]*$', '') || 'anonymized_'
            || upper(substr(sha256(bucket || '/' || key), 1, 26)) || '.' || regexp_extract(key, '[^.]*$') AS output_key
  FROM items
)"""

_AUDIT = """wanted AS (
  SELECT * FROM stored WHERE doc_id IN (SELECT doc_id FROM items)
), measures AS (
  SELECT doc_id, strlen(text) AS input_size,
    coalesce((SELECT max(page_no) FROM doc_pages p WHERE p.doc_id = d.doc_id), 0) AS n_pages,
    (SELECT count(*) FROM words w WHERE w.doc_id = d.doc_id) AS n_words_in,
    (SELECT count(*) FROM kept k WHERE k.doc_id = d.doc_id) AS n_kept,
    (SELECT count(*) FROM plan b WHERE b.doc_id = d.doc_id) AS n_boxes,
    coalesce((SELECT sum(strlen(line_text)) FROM kept_lines l WHERE l.doc_id = d.doc_id), 0) AS output_size
  FROM wanted d
), judged AS (
  SELECT k.*, m.* EXCLUDE (doc_id), CASE WHEN m.doc_id IS NULL THEN 'object not found'
                        WHEN k.url LIKE '%blog.%' THEN 'content is not a PDF'
                        WHEN n_pages = 0 THEN 'PDF must have at least 1 page'
                        WHEN n_pages > 1 THEN 'region corners are out of order' END AS error
  FROM keyed k LEFT JOIN measures m ON m.doc_id = k.doc_id
), audit AS (
  SELECT event_id, pos, CASE WHEN error IS NULL THEN 'success' ELSE 'error' END AS status,
         bucket AS input_bucket, key AS input_key,
         CASE WHEN error IS NULL THEN 'anonymized' END AS output_bucket,
         CASE WHEN error IS NULL THEN output_key END AS output_key,
         CASE WHEN error IS NULL THEN CAST(input_size AS BIGINT) END AS input_size,
         CASE WHEN error IS NULL THEN CAST(output_size AS BIGINT) END AS output_size,
         CASE WHEN error IS NULL THEN CAST(n_pages AS BIGINT) END AS n_pages,
         CASE WHEN error IS NULL THEN n_words_in END AS n_words_in,
         CASE WHEN error IS NULL THEN n_words_in - n_kept END AS n_words_removed,
         CASE WHEN error IS NULL THEN n_boxes END AS n_boxes,
         CASE WHEN error IS NULL THEN CAST(greatest(n_pages - 2, 0) AS BIGINT) END AS n_pages_dropped,
         error
  FROM judged
)"""

_SUMMARY = """summary AS (
  SELECT e.event_id, count(a.status) AS total_files,
         count(*) FILTER (a.status = 'success') AS successful,
         count(a.status) FILTER (a.status <> 'success') AS failed
  FROM (SELECT DISTINCT event_id FROM records) e LEFT JOIN audit a USING (event_id) GROUP BY e.event_id
), summed AS (
  SELECT *, CASE WHEN failed = 0 THEN 200 ELSE 207 END AS status_code,
         CASE WHEN total_files = 0 THEN 'No PDF files to process' ELSE 'PDF processing completed' END AS message
  FROM summary
)"""

_RESPONSE = """bodies AS (
  SELECT event_id, string_agg(CASE WHEN status = 'success' THEN
      json_object('status', status, 'input_bucket', input_bucket, 'input_key', input_key,
                  'output_bucket', output_bucket, 'output_key', output_key,
                  'input_size', input_size, 'output_size', output_size)::VARCHAR
    ELSE json_object('status', status, 'input_bucket', input_bucket, 'input_key', input_key,
                     'error', error)::VARCHAR END, ',' ORDER BY pos) AS results
  FROM audit GROUP BY event_id
)"""


# Labels of up to three words: the longest at each word, then from left to right what begins behind the one before.
_MULTIWORD = (
    """multiword AS (
  SELECT label, len(string_split(label, ' ')) AS n_words, action FROM (
    SELECT * FROM rule_labels UNION ALL
    SELECT * FROM (VALUES ('of the:', 'redact'), ('the the the:', 'redact'), ('de la:', 'redact'),
                          ('the of:', 'keep'), ('and the:', 'keep'), ('to the:', 'keep')) AS t(label, action))
)""", """ahead AS (
  SELECT doc_id, page_no, line_no, pos, line_len, text AS t0, lead(text) OVER l AS t1, lead(text, 2) OVER l AS t2 FROM tokens
  WINDOW l AS (PARTITION BY doc_id, page_no, line_no ORDER BY pos)
), phrases AS (
  SELECT *, 1 AS n_words, t0 AS phrase FROM ahead
  UNION ALL SELECT *, 2, t0 || ' ' || t1 FROM ahead
  UNION ALL SELECT *, 3, t0 || ' ' || t1 || ' ' || t2 FROM ahead
), matched AS (
  SELECT p.doc_id, p.page_no, p.line_no, p.pos, p.line_len, m.n_words, m.label, m.action FROM phrases p
  JOIN multiword m ON m.n_words = p.n_words AND m.label = CASE WHEN phrase LIKE '%:' THEN phrase ELSE phrase || ':' END
  QUALIFY row_number() OVER (PARTITION BY p.doc_id, p.page_no, p.line_no, p.pos ORDER BY m.n_words DESC) = 1
), onward AS (
  SELECT m.*, min(pos) OVER (PARTITION BY doc_id, page_no, line_no) AS first_pos,
    (SELECT min(o.pos) FROM matched o WHERE o.doc_id = m.doc_id AND o.page_no = m.page_no AND o.line_no = m.line_no
                                       AND o.pos >= m.pos + m.n_words) AS next_pos
  FROM matched m
), kept_labels AS (
  SELECT * FROM onward WHERE pos = first_pos
  UNION ALL
  SELECT o.* FROM kept_labels k JOIN onward o
    ON o.doc_id = k.doc_id AND o.page_no = k.page_no AND o.line_no = k.line_no AND o.pos = k.next_pos
)""")


def _statement(select: str, steps: dict[str, str], extra: tuple[str, ...] = ()) -> str:
    """The steps a query needs, directly or through others, followed by the query."""
    text, needed = " ".join((select, *extra)), []
    for name, body in reversed(steps.items()):
        mentions = " ".join([text, *(steps[n] for n in needed)])
        defines = {name} if name != "signatures" else {"signatures", "nearest"}
        if any(re.search(rf"\b{d}\b", mentions) for d in defines):
            needed.append(name)
    return "WITH RECURSIVE " + ",\n".join([*(steps[n] for n in reversed(needed)), *extra]) + "\n" + select


def statements() -> dict[str, str]:
    every = _steps(1.0, all_pages=True)
    text_page = _steps(1.0, all_pages=False)
    folded, folded_text = _steps(0.15, True), _steps(0.15, False)
    audited = _steps(1.0, False, _MEASURED_DOCS)
    cols = "doc_id, page_no"
    tokens = f"SELECT {cols}, line_no, pos, line_len, word_idx, text FROM tokens"
    segments = f"SELECT {cols}, word_idx, line_no FROM tokens"
    text = f"SELECT {cols}, line_no, line_text FROM kept_lines"

    def of(select: str, steps: dict[str, str] = every) -> str:
        return _statement(select, steps)

    def from_events(select: str, *extra: str) -> str:
        return "WITH " + ",\n".join([_EVENTS, *extra]) + "\n" + select

    def from_audit(select: str, *extra: str) -> str:
        steps = {"events": _EVENTS, "keyed": _KEYED, "stored": _STORED, **audited}
        return "WITH RECURSIVE " + ",\n".join([*(v for k, v in steps.items()), _AUDIT, *extra]) + "\n" + select

    return {
        "event_records": from_events("SELECT event_id, pos, event_source, bucket, raw_key FROM records"),
        "pdf_work_items": from_events("SELECT event_id, pos, bucket, key FROM items"),
        "object_scan": from_events(
            r"""SELECT event_id, pos, bucket, key, CAST(strlen(content) AS BIGINT) AS length,
       md5(content) AS content_md5,
       CASE WHEN content IS NULL THEN 'object not found'
            WHEN content NOT LIKE '%PDF-%' OR substr(content, 1, 5) <> '%PDF-' THEN 'content is not a PDF' END AS error
FROM contents""",
            r"""contents AS (
  SELECT *, CASE WHEN page_id % 11 NOT IN (3, 7) THEN
           (CASE WHEN url LIKE '%blog.%' THEN '' ELSE '%PDF-' END) || html || chr(10) END AS content
  FROM items
)"""),
        "output_keys": from_events("SELECT event_id, pos, output_key FROM keyed", _KEYED),
        "provenance": from_events(
            """SELECT event_id, pos, 'original-bucket' AS name, bucket AS value FROM items
UNION ALL SELECT event_id, pos, 'original-key', key FROM items
UNION ALL SELECT event_id, pos, 'processing-timestamp', '1700000000' FROM items
UNION ALL SELECT event_id, pos, 'anonymized', 'true' FROM items"""),
        "metadata_cleared": """
SELECT doc_id, '' AS xmp, name, CASE name WHEN 'format' THEN 'PDF' ELSE '' END AS value
FROM documents, (VALUES ('title'), ('author'), ('producer'), ('format')) AS t(name)""",
        "rule_tables": of("""SELECT label, min(action) AS action FROM (
  SELECT * FROM rule_labels UNION ALL SELECT lang || ':', 'redact' FROM documents) GROUP BY label"""),
        "doc_words": of("SELECT * FROM words"),
        "word_filter": r"""SELECT doc_id, CAST(i AS INTEGER) AS word_idx, w AS text FROM (
  SELECT doc_id, unnest(string_split(text, ' ')) AS w, unnest(range(len(string_split(text, ' ')))) AS i FROM documents
) WHERE regexp_replace(w, '[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]', '', 'g') <> ''""",
        "reading_order": of("SELECT doc_id, page_no, word_idx, round(yr * 10) AS band, ord FROM ordered"),
        "reading_order_split": of("SELECT doc_id, page_no, word_idx, round(yr * 10) AS band, ord FROM ordered"),
        "line_segments": of(segments),
        "line_segments_fold": of(segments, folded),
        "line_tokens": of(tokens),
        "line_tokens_split": of(tokens, folded),
        "line_boxes": of(f"SELECT {cols}, line_no, rx0, ry0, rx1, ry1 FROM line_boxes"),
        "line_text": of(f"SELECT {cols}, line_no, line_text FROM line_boxes"),
        "label_hits": of(f"""SELECT {cols}, word_idx, text, action FROM words
JOIN rule_labels ON label = CASE WHEN text LIKE '%:' THEN text ELSE text || ':' END"""),
        "label_hits_multiword": _statement(
            f"SELECT {cols}, line_no, pos::INT AS pos, n_words::INT AS n_words, label, action FROM kept_labels", every, _MULTIWORD),
        "value_spans_multiword": _statement(
            f"""SELECT {cols}, line_no, pos + n_words - 1 AS label_pos, pos + n_words AS start_pos,
       coalesce(next_pos, line_len) AS end_pos
FROM kept_labels WHERE action = 'redact' AND coalesce(next_pos, line_len) > pos + n_words""", every, _MULTIWORD),
        "value_spans": of("SELECT * FROM spans"),
        "value_boxes": of("SELECT * FROM value_boxes"),
        "register_hits": of(f"SELECT {cols}, word_idx, text, x0, y0, x1, y1 FROM hits"),
        "register_tail_boxes": of("SELECT * FROM tails"),
        "signature_lines": of("SELECT * FROM signatures"),
        "fixed_boxes": of("SELECT * FROM fixed"),
        "pixel_boxes": of(f"""SELECT {cols}, region_id,
       CAST(trunc(r0 * img_w) AS INTEGER) AS px0, CAST(trunc(r1 * img_h) AS INTEGER) AS py0,
       CAST(trunc(r2 * img_w) AS INTEGER) AS px1, CAST(trunc(r3 * img_h) AS INTEGER) AS py1
FROM (SELECT *, ceil(width * 220 / 72 - 0.001) AS img_w, ceil(height * 220 / 72 - 0.001) AS img_h FROM doc_pages)
JOIN regions USING (page_no)"""),
        "raster_burn": """SELECT vec_id, CAST(idx AS INTEGER) AS idx,
       CASE WHEN idx // 8 BETWEEN 1 AND 3 AND idx % 8 BETWEEN 2 AND 5 THEN 0.0::DOUBLE ELSE v END AS v
FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS idx FROM embeddings)""",
        "redaction_plan": of("SELECT * FROM plan", text_page),
        "removed_words": of(f"""SELECT {cols}, word_idx, text FROM words w WHERE EXISTS (
  SELECT 1 FROM plan b WHERE b.doc_id = w.doc_id AND b.page_no = w.page_no
   AND w.x0 < b.rx1 AND w.x1 > b.rx0 AND w.y0 < b.ry1 AND w.y1 > b.ry0)""", text_page),
        "kept_words": of(f"SELECT {cols}, word_idx, text FROM kept", text_page),
        "page_routing": of("""SELECT doc_id, n_pages,
       CASE WHEN n_pages = 0 THEN 'error' WHEN n_pages = 1 THEN 'single' ELSE 'multi' END AS route,
       CASE WHEN n_pages = 0 THEN 'PDF must have at least 1 page' END AS error
FROM (SELECT d.doc_id, count(p.page_no) AS n_pages
      FROM stored d LEFT JOIN doc_pages p ON p.doc_id = d.doc_id GROUP BY d.doc_id)""", {"stored": _STORED, **every}),
        "page_policy": of(f"""SELECT {cols}, CASE page_no WHEN 1 THEN 'text' WHEN 2 THEN 'raster' ELSE 'dropped' END
  AS outcome FROM doc_pages"""),
        "published_pages": of(f"""SELECT {cols}, line_no, 'text' AS kind, line_text AS text,
       n_words, CAST(NULL AS INTEGER) AS img_w, CAST(NULL AS INTEGER) AS img_h FROM kept_lines
UNION ALL
SELECT {cols}, NULL, 'raster', NULL, 0, CAST(ceil(width * 220 / 72 - 0.001) AS INTEGER),
       CAST(ceil(height * 220 / 72 - 0.001) AS INTEGER) FROM doc_pages WHERE page_no = 2""", text_page),
        "redacted_text": of(text, text_page),
        "redacted_text_fold": of(text, folded_text),
        "stream_redacted_text": of(text, text_page),
        "redaction_plan_of_tables": of("SELECT * FROM plan", text_page | {"rule_labels": """rule_labels AS (
  SELECT label, min(action) AS action FROM (
    SELECT * FROM (VALUES ('the:', 'redact'), ('de:', 'redact'), ('der:', 'redact'), ('is:', 'redact'),
                          ('of:', 'keep'), ('la:', 'keep'), ('and:', 'keep')) AS t(label, action)
    UNION ALL SELECT lang || ':', 'redact' FROM documents) GROUP BY label
)"""}),
        "published_rasters": """SELECT vec_id AS doc_id, 2 AS page_no, 8 AS width, 8 AS height, CAST(idx AS INTEGER) AS idx,
       CASE WHEN idx // 8 BETWEEN 1 AND 2 AND idx % 8 BETWEEN 1 AND 3 THEN 0 ELSE CAST(floor(abs(v) * 100) AS INTEGER) % 256 END
         AS level
FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS idx FROM embeddings)""",
        "stored_objects": from_audit("""SELECT a.event_id, a.pos, k.doc_id, a.output_bucket, a.output_key,
       'text/plain; charset=utf-8' AS content_type, coalesce(content, '') AS content, '2023-11-14' AS ingest_date
FROM audit a JOIN keyed k USING (event_id, pos)
LEFT JOIN (SELECT doc_id, string_agg(line_text, chr(10) ORDER BY line_no) AS content FROM kept_lines GROUP BY doc_id) t
  ON t.doc_id = k.doc_id
WHERE a.status = 'success'"""),
        "stored_metadata": from_audit("""SELECT a.event_id, a.pos, '' AS xmp, name,
       CASE name WHEN 'format' THEN 'PDF' ELSE '' END AS value
FROM audit a JOIN keyed k USING (event_id, pos) JOIN documents d ON d.doc_id = k.doc_id,
     (VALUES ('title'), ('author'), ('producer'), ('format')) AS t(name)
WHERE a.status = 'success'"""),
        "batch_metrics": from_audit("""SELECT metric, value::DOUBLE AS value FROM (
  UNPIVOT (SELECT count(*) AS items, count(*) FILTER (status = 'success') AS successes,
                  coalesce(sum(input_size), 0)::BIGINT AS input_size, coalesce(sum(output_size), 0)::BIGINT AS output_size,
                  coalesce(sum(n_pages), 0)::BIGINT AS n_pages, coalesce(sum(n_words_in), 0)::BIGINT AS n_words_in,
                  coalesce(sum(n_words_removed), 0)::BIGINT AS n_words_removed, coalesce(sum(n_boxes), 0)::BIGINT AS n_boxes,
                  coalesce(sum(n_pages_dropped), 0)::BIGINT AS n_pages_dropped FROM audit)
  ON COLUMNS(*) INTO NAME metric VALUE value
  UNION ALL SELECT 'error: ' || error, count(*) FROM audit WHERE error IS NOT NULL GROUP BY error)"""),
        "audit": from_audit("SELECT * FROM audit"),
        "batch_summary": from_audit("SELECT * FROM summed", _SUMMARY),
        "batch_response": from_audit("""SELECT s.event_id, s.status_code, CASE WHEN total_files = 0
    THEN json_object('message', message)::VARCHAR
    ELSE '{"message":"' || message || '","summary":' || json_object(
           'total_files', total_files, 'successful', successful, 'failed', failed)::VARCHAR
         || ',"results":[' || results || ']}' END AS body
FROM summed s LEFT JOIN bodies USING (event_id)""", _SUMMARY, _RESPONSE),
    }
