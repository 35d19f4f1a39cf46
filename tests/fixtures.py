"""Small hand-made pages, and a plain fold to compare lines with."""

from inkveil.sources.words import PAGE_SCHEMA, WORD_SCHEMA

CHAR, GAP, HEIGHT = 5.0, 5.0, 9.0


def line(text, y, x=10.0, doc=1, page=1, first=0):
    """Words of one line, left to right, 5 points apart."""
    rows = []
    for n, token in enumerate(text.split(" ")):
        rows.append((doc, page, first + n, x, y, x + CHAR * len(token), y + HEIGHT, token))
        x += CHAR * len(token) + GAP
    return rows


def page_of(*texts, doc=1, page=1, pitch=30.0):
    rows = []
    for n, text in enumerate(texts):
        rows += line(text, 100.0 + pitch * n, doc=doc, page=page, first=len(rows))
    return rows


def words_df(spark, rows):
    return spark.createDataFrame(rows, WORD_SCHEMA)


def a4_pages(spark, *keys):
    return spark.createDataFrame([(d, p, 0.0, 0.0, 595.0, 842.0) for d, p in keys], PAGE_SCHEMA)


def fold_lines(rows, tolerance):
    """(doc, page, word_idx) -> (line_no, pos), word by word."""
    found, pages = {}, {}
    for r in rows:
        if r[7].strip():
            pages.setdefault(r[:2], []).append(r)
    for key, words in pages.items():
        mean, line_no, pos = None, -1, 0
        for w in sorted(words, key=lambda w: (round(w[4], 1), w[3], w[2])):
            if mean is None or abs(w[4] - mean) > tolerance:
                mean, line_no, pos = w[4], line_no + 1, 0
            else:
                mean, pos = (mean + w[4]) / 2, pos + 1
            found[(*key, w[2])] = (line_no, pos)
    return found
