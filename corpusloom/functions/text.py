"""Column expressions over text. All of them stay in the JVM.

Whitespace is the ASCII class ``[ \\t\\n\\r\\f]`` and word characters are Unicode letters, digits and
the underscore, written out so that every engine reads the patterns alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[ \t\n\r\f]"
NON_WS = r"[^ \t\n\r\f]+"
WORD = r"[\p{L}\p{N}_]+"
TRIM_CHARS = " \t\n\r\f"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(TRIM_CHARS))


def tokens(c: Column) -> Column:
    """Whitespace-separated tokens, without empty strings."""
    return F.filter(F.split(c, WS + "+"), lambda t: t != "")


def words(c: Column) -> Column:
    """Runs of word characters."""
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(NON_WS)).cast("bigint")


def squeeze(c: Column) -> Column:
    """Every run of whitespace becomes one space; the ends are stripped."""
    return strip(F.regexp_replace(c, WS + "+", " "))


def normalise_query(c: Column) -> Column:
    return F.lower(squeeze(c))


def clean_text(c: Column) -> Column:
    """Squash newlines, squash whitespace runs, drop page marks, strip, in this order."""
    c = F.regexp_replace(c, r"\n+", "\n")
    c = F.regexp_replace(c, WS + "{2,}", " ")
    c = F.regexp_replace(c, r"(?i)page [0-9]+", "")
    return strip(c)


# HTML blocks that carry no body text, and the entities of the page corpus.
HTML_BLOCKS = (
    r"(?is)<script[^>]*>.*?</script>",
    r"(?is)<style[^>]*>.*?</style>",
    r"(?is)<nav[^>]*>.*?</nav>",
    r"(?s)<!--.*?-->",
    r"(?s)<[^>]+>",
)
HTML_ENTITIES = (
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
)


def html_to_text(c: Column) -> Column:
    """Visible text of a page: blocks and tags become spaces, entities are decoded last-``&`` first."""
    for pattern in HTML_BLOCKS:
        c = F.regexp_replace(c, pattern, " ")
    for entity, char in HTML_ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return clean_text(c)


def first_line(c: Column) -> Column:
    return F.substring_index(c, "\n", 1)


def first_words(c: Column, n: int) -> tuple[Column, Column]:
    """(text cut to ``n`` words with an ellipsis, whether it was cut)."""
    toks = tokens(c)
    cut = F.size(toks) > n
    return F.when(cut, F.concat(F.array_join(F.slice(toks, 1, n), " "), F.lit("..."))).otherwise(c), cut


def lead_sentences(c: Column, level: Column) -> Column:
    """Reference answer taken from a context: one, two or all sentences for simple, moderate, complex."""
    parts = F.split(c, r"\. ")
    two = F.concat(F.array_join(F.slice(parts, 1, 2), ". "), F.lit("."))
    return (
        F.when(level == "simple", F.concat(parts[0], F.lit(".")))
        .when((level == "moderate") & (F.size(parts) >= 2), two)
        .otherwise(c)
    )


def terms_without(c: Column, stop: Sequence[str]) -> Column:
    """Distinct lower-case tokens minus a stop list."""
    return F.array_except(F.array_distinct(tokens(F.lower(c))), F.array(*[F.lit(s) for s in stop]))


def any_of(c: Column, needles: Sequence[str]) -> Column:
    """True when one of the plain substrings occurs."""
    hit = F.lit(False)
    for needle in needles:
        hit = hit | F.contains(c, F.lit(needle))
    return hit
