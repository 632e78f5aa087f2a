"""Main text of pages of any shape, by shallow features of text blocks, as expressions.

A page is cut into blocks at block-level tags. A block counts as content by its number of words, the share of them that stands in links, and the
same of the blocks before and after it: the decision tree that Kohlschütter, Fankhauser and Nejdl (2010) learned from web pages. Entities stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.pages import MAX_BODY, MIN_BODY

# Elements without text for readers, and those that end a block.
HIDDEN = ("script", "style", "template", "noscript", "head", "select", "button")
BLOCKS = "address article aside blockquote body br center dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split()
# The tree's bounds on shares of linked words, and on numbers of words.
LINKED, LINKED_BEFORE = 0.333333, 0.555556
SHORT, SHORT_AFTER, SHORT_BEFORE, SHORT_BY_LINKS, SHORT_AFTER_BY_LINKS = 16, 15, 4, 40, 17

HIDDEN_PATTERN = "(?is)<!--.*?-->|" + "|".join(rf"<{t}\b.*?</{t}\s*>" for t in HIDDEN)
BLOCK_PATTERN = rf"(?i)</?(?:{'|'.join(BLOCKS)})\b[^>]*>"


def _plain(part: Column) -> Column:
    """Text without tags, runs of white space as one blank."""
    return F.btrim(F.regexp_replace(F.regexp_replace(part, r"<[^>]*>", " "), r"\s+", " "))


def _words(text: Column) -> Column:
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))


def blocks(html: Column) -> Column:
    """The blocks with text of a page: struct(text, words, linked), linked being the share of words in links."""

    def block(part: Column) -> Column:
        text = _plain(part)
        links = _plain(F.array_join(F.regexp_extract_all(part, F.lit(r"(?is)<a\b[^>]*>(.*?)</a\s*>"), F.lit(1)), " "))
        return F.struct(text.alias("text"), _words(text).alias("words"), (_words(links) / F.greatest(_words(text), F.lit(1))).alias("linked"))

    parts = F.split(F.regexp_replace(html, HIDDEN_PATTERN, " "), BLOCK_PATTERN)
    return F.filter(F.transform(parts, block), lambda b: b["words"] > 0)


def is_content(before: Column, own: Column, after: Column) -> Column:
    """Whether a block is content, from it and its neighbours; a missing neighbour has no words and no links."""
    words = lambda b: F.coalesce(b["words"], F.lit(0))
    plain = F.when(words(own) > SHORT, True).when(words(after) > SHORT_AFTER, True).otherwise(words(before) > SHORT_BEFORE)
    by_links = (words(own) > SHORT_BY_LINKS) | (words(after) > SHORT_AFTER_BY_LINKS)
    return (own["linked"] <= LINKED) & F.when(F.coalesce(before["linked"], F.lit(0.0)) <= LINKED_BEFORE, plain).otherwise(by_links)


def main_text(html: Column) -> Column:
    """The content blocks' texts, one a line; null if shorter than MIN_BODY, cut at MAX_BODY."""

    def content(b: Column) -> Column:
        marked = F.transform(b, lambda own, i: F.struct(own["text"].alias("text"), is_content(F.get(b, i - 1), own, F.get(b, i + 1)).alias("keep")))
        return F.array_join(F.transform(F.filter(marked, lambda x: x["keep"]), lambda x: x["text"]), "\n")

    text = F.get(F.transform(F.array(blocks(html)), content), 0)  # the blocks are made once
    return F.get(F.transform(F.array(text), lambda t: F.when(F.length(t) >= MIN_BODY, F.substring(t, 1, MAX_BODY))), 0)
