"""The redaction pipeline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from inkveil.operators.apply import kept_words, redaction_plan
from inkveil.operators.detect import mark_words, text_redactions, with_multiword_labels
from inkveil.operators.lines import PAGE, line_tokens, non_blank
from inkveil.operators.pages import published_pages, redacted_text, text_page
from inkveil.operators.regions import fixed_boxes
from inkveil.params import RuleParams, RuleSet
from inkveil.session import staged
from inkveil.sources.rules import RuleTables


@dataclass(frozen=True)
class Redactor:
    """Rules and parameters bound together.

    rules: lists, or tables as they were read. page_rows: the proven largest number of words on a page, if the
    source has one. Methods are lazy but for kept, text and publish: these write the segmented words once, as two
    later steps need them.
    """

    rules: RuleSet | RuleTables = RuleSet()
    params: RuleParams = RuleParams()
    page_rows: int | None = None

    def tables(self, spark: SparkSession) -> RuleTables:
        return self.rules if isinstance(self.rules, RuleTables) else RuleTables.of(spark, self.rules)

    def tokens(self, words: DataFrame) -> DataFrame:
        """Words with their line and position."""
        return line_tokens(non_blank(words), self.params, self.page_rows)

    def marked_tokens(self, words: DataFrame) -> DataFrame:
        """Words with line, position and the rules their text meets."""
        rules = self.tables(words.sparkSession)
        marked = mark_words(non_blank(words), rules.labels, rules.tokens, rules.search_terms)
        tokens = line_tokens(marked, self.params, self.page_rows)
        return with_multiword_labels(tokens, rules.labels) if self.params.multiword_labels else tokens

    def plan(self, words: DataFrame, pages: DataFrame) -> DataFrame:
        """Boxes to redact on the text page."""
        return self.plan_of(self.marked_tokens(text_page(words)), pages)

    def plan_of(self, marked: DataFrame, pages: DataFrame) -> DataFrame:
        """Boxes to redact on the text page, from its marked tokens."""
        regions = self.tables(marked.sparkSession).regions
        return redaction_plan(text_redactions(marked, self.params), fixed_boxes(text_page(pages), regions))

    def kept(self, words: DataFrame, pages: DataFrame) -> DataFrame:
        """Tokens of the text page that survive."""
        marked = self.by_page(staged(self.marked_tokens(text_page(words)), "tokens"))
        return kept_words(marked, self.plan_of(marked, pages), self.dense_rows)

    def by_page(self, tokens: DataFrame) -> DataFrame:
        """A table of tokens dealt out by page, where pages are known to be small: detection, the join with boxes and the
        lines of what is left then find their rows together, so that the text is shuffled once and the flags once."""
        return tokens.repartition(*PAGE) if self.dense_rows is None else tokens

    @property
    def dense_rows(self) -> int | None:
        """Words above which a cell is dealt to parts; None where no page has as many."""
        return None if self.page_rows is not None and self.page_rows <= self.params.dense_rows else self.params.dense_rows

    def text(self, words: DataFrame, pages: DataFrame) -> DataFrame:
        return redacted_text(self.kept(words, pages))

    def publish(self, words: DataFrame, pages: DataFrame) -> DataFrame:
        return published_pages(self.kept(words, pages), pages, self.params)
