"""Text column functions. All are Catalyst expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character sets that must match the way the results are defined.
LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
EDGE_BLANKS = r"(?U)^\s+|\s+$"
SENTENCE_GAP = r"(?U)(?<=[.!?])\s+"
WORD = r"[\p{L}\p{N}_]+"
LONG_WORD = r"[\p{L}\p{N}_]{2,}"
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"
SECTION_HEADER = r"(?md)^##\s+(\d+)\.\s+(.+)$"

# The words that the extractive answers pass over.
STOP_WORDS = (
    "the", "is", "are", "a", "an", "of", "to", "in", "and", "what", "how",
    "why", "does", "do", "did", "for", "on", "with", "this", "that", "it",
    "was", "were", "be", "as", "at", "by", "from", "or", "which", "who",
)


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def strip(column) -> Column:
    """Trim any white space, not just blanks."""
    return F.regexp_replace(_c(column), EDGE_BLANKS, "")


def non_empty(items: Column) -> Column:
    return F.array_remove(items, "")


def clean_lines(column) -> Column:
    """Strip each line and drop the empty ones."""
    return F.array_join(non_empty(F.transform(F.split(_c(column), LINE_BREAKS), strip)), "\n")


def words(column) -> Column:
    """Lower-case words with punctuation removed."""
    return non_empty(F.split(F.translate(F.lower(_c(column)), PUNCTUATION, " " * len(PUNCTUATION)), " "))


def lines(column) -> Column:
    return F.split(_c(column), "\n")


def sentences(column) -> Column:
    """Sentences of each line: a break follows `.`, `!` or `?` and white space."""
    parts = F.transform(non_empty(F.transform(lines(column), strip)), lambda p: F.split(p, SENTENCE_GAP))
    return non_empty(F.transform(F.flatten(parts), strip))


def tokens(column, pattern: str = LONG_WORD) -> Column:
    return F.regexp_extract_all(F.lower(_c(column)), F.lit(pattern), F.lit(0))


def bigrams(items: Column) -> Column:
    """Neighbouring pairs joined by a blank."""
    n = F.size(items)
    pairs = F.zip_with(F.slice(items, F.lit(1), n - 1), F.slice(items, F.lit(2), n - 1), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(n > 1, pairs).otherwise(F.array().cast("array<string>"))


def tokens_and_bigrams(column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Tokens without stop words, followed by the pairs of what is left."""
    kept = F.filter(tokens(column), lambda t: ~t.isin(list(stop_words)))
    return F.concat(kept, bigrams(kept))


def keywords(column, longer_than: int = 4, count: int = 5) -> Column:
    """Distinct lower-case words above a length, the first few in alphabetical order."""
    found = F.filter(F.split(_c(column), r"(?U)\s+"), lambda w: F.length(w) > longer_than)
    return F.slice(F.sort_array(F.array_distinct(F.transform(found, F.lower))), 1, count)


def contains_any(column, hints: Sequence[str]) -> Column:
    """True where the lower-cased text holds one of the hints."""
    low, hit = F.lower(_c(column)), F.lit(False)
    for h in hints:
        hit = hit | F.contains(low, F.lit(h))
    return hit
