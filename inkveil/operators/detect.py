"""Lines -> boxes around personal data: labelled values, register tails, signature lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkveil.functions.text import contains_any, norm_label, strip
from inkveil.operators.lines import LINE, PAGE, padded_box
from inkveil.params import RuleParams
from inkveil.sources.rules import KEEP, REDACT

BOX = ["rx0", "ry0", "rx1", "ry1"]
# Height in points of the strips in which lines and register hits meet, beyond the reach of a hit.
STRIP_HEIGHT = 128.0
VALUE, TAIL, SIGNATURE, LINE_BOX, HIT = "value", "register_tail", "signature", "line", "hit"


def mark_words(words: DataFrame, labels: DataFrame, tokens: DataFrame, search_terms) -> DataFrame:
    """Adds what later steps need to know about the text, before the text itself is shuffled.

    action: of the label this word is, if any; is_register: the word is a register token;
    is_hit: the word contains a search term; has_colon.
    """
    marked = label_hits(words, labels).withColumn("is_hit", contains_any(F.col("text"), search_terms))
    return marked_register(marked, tokens).withColumn("has_colon", F.col("text").contains(":"))


def marked_register(hits: DataFrame, tokens: DataFrame) -> DataFrame:
    """Adds is_register. Search terms are the lower-case register tokens, so only hits need the test.

    Other words get one of many keys that no token has, so that a shuffled join does not meet them all in one task.
    """
    register = tokens.select(F.col("token").alias("_token"), F.lit(True).alias("is_register"))
    spread = F.concat(F.lit("\x00 "), F.pmod(F.xxhash64("doc_id", "page_no", "word_idx"), F.lit(65536)).cast("string"))
    stripped = F.when(F.col("is_hit"), strip(F.col("text"))).otherwise(spread)
    return hits.join(register, stripped == F.col("_token"), "left").drop("_token") \
        .withColumn("is_register", F.coalesce("is_register", F.lit(False)))


def label_hits(words: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds the action of the label a word is, or null."""
    rules = labels.select(F.col("label").alias("_label"), "action")
    return words.join(rules, norm_label(F.col("text")) == F.col("_label"), "left").drop("_label")


def multiword_hits(tokens: DataFrame, labels: DataFrame) -> DataFrame:
    """(line, pos, n_words, label, action): where a line holds a label of one or more words, white space between two.

    The words of a label follow each other in one line, and the last is compared as single words are. At a word the
    longest label counts; down the line, labels that begin inside one before them do not. Every word is compared once
    for each number of words that labels have, by equality, so the label table may be of any size.
    """
    words = F.split(F.btrim("label"), r"\s+")
    rules = labels.groupBy(F.array_join(words, " ").alias("label"), F.size(words).alias("n_words")).agg(F.min("action").alias("action"))
    lengths = sorted(r.n_words for r in rules.select("n_words").distinct().collect())  # a row for each number of words
    in_line = Window.partitionBy(*LINE).orderBy("pos")
    ahead = tokens.select(*LINE, "pos", "text", *[F.lead("text", k).over(in_line).alias(f"_{k}") for k in range(1, max(lengths, default=1))])
    phrases = []
    for n in lengths:
        parts = [F.col("text"), *[F.col(f"_{k}") for k in range(1, n)]]
        phrase = reduce(lambda a, b: F.concat(a, F.lit(" "), b), [*parts[:-1], norm_label(parts[-1])])
        phrases.append(F.struct(F.lit(n).alias("n_words"), phrase.alias("label")))
    if not phrases:
        phrases = [F.struct(F.lit(0).alias("n_words"), F.lit(None).cast("string").alias("label"))]
    listed = ahead.select(*LINE, "pos", F.inline(F.array(*phrases))).where("label is not null")
    found = listed.join(rules, ["label", "n_words"]).groupBy(*LINE, "pos").agg(
        F.max(F.struct("n_words", "label", "action")).alias("hit"))
    match = F.struct("pos", "hit.n_words", "hit.label", "hit.action")
    kept = """aggregate(hits, named_struct('free', 0, 'kept', filter(hits, h -> false)),
        (acc, h) -> IF(h.pos >= acc.free, named_struct('free', h.pos + h.n_words, 'kept', concat(acc.kept, array(h))), acc),
        acc -> acc.kept)"""
    lines = found.groupBy(*LINE).agg(F.array_sort(F.collect_list(match)).alias("hits"))
    return lines.select(*LINE, F.inline(F.expr(kept)))


def with_multiword_labels(tokens: DataFrame, labels: DataFrame) -> DataFrame:
    """Tokens with the actions of labels of any number of words in place of those of single words.

    The last word of a label has its action, so that a value begins behind it; those before are kept, as they end the
    value of the label before them.
    """
    place = F.struct(*LINE, "pos").alias("_place")
    parts = multiword_hits(tokens, labels).select(
        *LINE, "pos", "n_words", "action", F.explode(F.sequence(F.lit(0), F.col("n_words") - 1)).alias("i")).select(
        F.struct(*LINE, (F.col("pos") + F.col("i")).alias("pos")).alias("_place"),
        F.when(F.col("i") == F.col("n_words") - 1, F.col("action")).otherwise(KEEP).alias("action"))
    return tokens.drop("action").withColumn("_place", place).join(parts, "_place", "left").drop("_place")


def register_hits(words: DataFrame, search_terms) -> DataFrame:
    """Words that contain a search term, each once however many terms it contains."""
    return words.filter(contains_any(F.col("text"), search_terms))


def value_spans(tokens: DataFrame) -> DataFrame:
    """Per redact label with a value: [start_pos, end_pos) from behind the label to the next label."""
    return (
        _with_label_pos(tokens)
        .filter(_in_value())
        .groupBy(*LINE, F.col("label_pos"))
        .agg((F.max("pos") + 1).alias("end_pos"))
        .select(*LINE, "label_pos", (F.col("label_pos") + 1).alias("start_pos"), "end_pos")
    )


def value_boxes(tokens: DataFrame, params: RuleParams) -> DataFrame:
    return _group_boxes(tokens, params, [VALUE]).select(*LINE, F.col("key").alias("label_pos"), *BOX)


def register_tail_boxes(tokens: DataFrame, params: RuleParams) -> DataFrame:
    """Per register token: the box from the token to the end of its line."""
    groups = _group_boxes(tokens, params, [TAIL])
    return _extend_tails(groups).select(*LINE, F.col("key").alias("pos"), *BOX)


def signature_lines(tokens: DataFrame, params: RuleParams) -> DataFrame:
    """Lines to redact: nearest above a register hit, overlapping it sideways, and without a colon."""
    groups = _group_boxes(tokens, params, [LINE_BOX, HIT])
    return (
        _nearest_above(groups, params)
        .filter(F.col("nearest").isNotNull() & ~F.col("nearest.has_colon"))
        .select(*PAGE, F.col("nearest.line_no").alias("line_no"), *[F.col(f"nearest.{c}").alias(c) for c in BOX])
        .dropDuplicates(LINE)
    )


def text_redactions(tokens: DataFrame, params: RuleParams) -> DataFrame:
    """All text rules in one pass over the tokens: (doc_id, page_no, rule, box). Several hits below a
    line repeat its box."""
    groups = _nearest_above(
        _extend_tails(_group_boxes(tokens, params, [VALUE, TAIL, LINE_BOX, HIT])), params)
    signature = F.col("nearest").isNotNull() & ~F.col("nearest.has_colon")
    return (
        groups.filter(F.col("kind").isin(VALUE, TAIL) | signature)
        .select(*PAGE, F.when(F.col("kind") == HIT, SIGNATURE).otherwise(F.col("kind")).alias("rule"),
                *[F.coalesce(f"nearest.{c}", c).alias(c) for c in BOX])
    )


def _with_label_pos(tokens: DataFrame) -> DataFrame:
    """Adds the position and action of the last label at or before each word in its line, and the
    position of the last register token."""
    so_far = Window.partitionBy(*LINE).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return tokens.withColumns({
        "label_pos": F.max(F.when(F.col("action").isNotNull(), F.col("pos"))).over(so_far),
        "label_action": F.last("action", True).over(so_far),
        "register_pos": F.max(F.when(F.col("is_register"), F.col("pos"))).over(so_far)})


def _in_value() -> Column:
    return F.coalesce(F.col("label_action") == REDACT, F.lit(False)) & F.col("action").isNull()


def _stretches(tokens: DataFrame) -> DataFrame:
    """Lines cut at labels, register tokens and hits; all boxes are unions of these few rows."""
    hit_pos = F.when(F.col("is_hit"), F.col("pos")).alias("hit_pos")
    return _with_label_pos(tokens).groupBy(
        *LINE, "label_pos", "register_pos", hit_pos, _in_value().alias("in_value"),
    ).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"),
          F.max("has_colon").alias("has_colon"))


def _group_boxes(tokens: DataFrame, params: RuleParams, kinds: list[str]) -> DataFrame:
    """One padded box per group of words: (line, kind, key, box, has_colon), and the box unpadded.

    A stretch counts for the value it is in (key: its label), for all that follows the last register
    token (key: that token) and for its line. A hit is a group of its own (key: its position).
    """
    belongs = {
        VALUE: (F.col("in_value"), F.col("label_pos")),
        TAIL: (F.col("register_pos").isNotNull(), F.col("register_pos")),
        LINE_BOX: (F.lit(True), F.lit(0)),
        HIT: (F.col("hit_pos").isNotNull(), F.col("hit_pos")),
    }
    groups = F.array(*[
        F.when(belongs[k][0], F.struct(F.lit(k).alias("kind"), belongs[k][1].alias("key"))) for k in kinds])
    return (
        _stretches(tokens)
        .select(*LINE, "x0", "y0", "x1", "y1", "has_colon", F.explode(groups).alias("g"))
        .filter(F.col("g").isNotNull())
        .groupBy(*LINE, F.col("g.kind").alias("kind"), F.col("g.key").alias("key"))
        .agg(*padded_box(params), F.max("has_colon").alias("has_colon"), F.min("y0").alias("y0"),
             F.min("x0").alias("x0"), F.max("x1").alias("x1"))
    )


def _extend_tails(groups: DataFrame) -> DataFrame:
    """Lets the box of each register token cover the stretches of the later ones in its line."""
    onwards = Window.partitionBy(*LINE, "kind").orderBy(F.desc("key")) \
        .rowsBetween(Window.unboundedPreceding, 0)
    tail = F.col("kind") == TAIL
    return groups.withColumns({
        c: F.when(tail, f(c).over(onwards)).otherwise(F.col(c))
        for c, f in zip(BOX, (F.min, F.min, F.max, F.max))})


def _nearest_above(groups: DataFrame, params: RuleParams) -> DataFrame:
    """Adds to each hit the nearest line above it, or null.

    Lines are placed at their lower edge and hits at their upper edge, so the candidates are the
    lines in the range frame before the hit. The frame is a little wider than the tolerance and the
    exact test follows, as the frame bound is computed by another subtraction.
    """
    reach = params.prevline_tolerance + 0.01
    strip = f"floor({{}} / {STRIP_HEIGHT + reach}D)"
    box = ", ".join(BOX)
    placed = groups.withColumns({
        "edge": F.expr(f"CASE kind WHEN '{LINE_BOX}' THEN ry1 WHEN '{HIT}' THEN y0 END"),
        "line": F.expr(f"IF(kind = '{LINE_BOX}', struct(line_no, {box}, has_colon), NULL)")})
    # A page is cut into strips, and a line near the end of one is listed in the next one as well.
    listed = placed.withColumn("strip", F.explode(F.expr(f"""
        IF(kind = '{LINE_BOX}', sequence({strip.format('ry1')}, {strip.format(f'(ry1 + {reach}D)')}),
           array({strip.format('y0')}))""")))
    above = listed.withColumn("above", F.expr(
        f"collect_list(line) OVER (PARTITION BY doc_id, page_no, strip ORDER BY edge "
        f"RANGE BETWEEN {reach}D PRECEDING AND CURRENT ROW)"))
    nearest = F.expr(f"""
        IF(kind = '{HIT}', array_min(transform(
          filter(above, l -> l.ry1 <= y0 AND y0 - l.ry1 <= {params.prevline_tolerance}D
                             AND l.rx1 > x0 - {params.signature_x_slack}D
                             AND l.rx0 < x1 + {params.signature_x_slack}D),
          l -> struct(y0 - l.ry1 AS gap, l.line_no, l.rx0, l.ry0, l.rx1, l.ry1, l.has_colon))), NULL)""")
    return above.withColumn("nearest", nearest).drop("above", "line", "edge", "strip")
