"""Sentences, keyword matches and text clean-up as JVM column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from coverlens.session import batched_udf

# --- Fixed values --------------------------------------------------------------------
# Every character that str.strip() removes.
WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
CURLY_QUOTES = "‘’‚‛“”„‟"
STRAIGHT_QUOTES = "''''\"\"\"\""
# Titles and the like after which a full stop does not end a sentence.
ABBREVIATIONS = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Sen", "Rep", "Gov", "Gen", "Sgt", "Lt", "Col",
                 "Rev", "Hon", "St", "Jr", "Sr", "vs", "a\\.m", "p\\.m", "e\\.g", "i\\.e")
# The same, but only before a lower-case letter or a digit.
SHORT_FORMS = ("No", "Nos", "Inc", "Ltd", "Corp", "Co", "Bros", "Vol", "Fig", "Sec", "Art", "pp", "p",
               "approx", "est", "dept", "Jan", "Feb", "Mar", "Apr", "Jun", "Jul", "Aug", "Sept", "Sep",
               "Oct", "Nov", "Dec")
# --- end of fixed values -------------------------------------------------------------

# Unicode noncharacters: never part of interchanged text, so safe as marks.
CUT, KEEP = chr(0xFDD0), chr(0xFDD1)
_NO_CUT = r"(^|[^\p{L}])((?:" + "|".join(ABBREVIATIONS) + r")\.|(?:\p{Lu}\.)+)"
_NO_CUT_BEFORE_SMALL = r"(^|[^\p{L}])((?:" + "|".join(SHORT_FORMS) + r")\.)(?=[ \t\r\n\f]+[\p{Ll}\d])"
_BOUNDARY = "([.!?]+[\"'”’)\\]]*)[ \\t\\r\\n\\f]+|\\n[ \\t\\r\\f]*\\n"
_BOUNDARY_SPACE = "([.!?]+[\"'”’)\\]]*)([ \\t\\r\\n\\f]+)|(\\n[ \\t\\r\\f]*\\n)"


def strip(text: Column) -> Column:
    """Trim every kind of white space from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def _guarded(text: Column) -> Column:
    """The text with a mark after every full stop that ends no sentence."""
    guarded = F.regexp_replace(text, _NO_CUT, "$1$2" + KEEP)
    return F.regexp_replace(guarded, _NO_CUT_BEFORE_SMALL, "$1$2" + KEEP)


def cut_marks(text: Column) -> Column:
    """The text with CUT before the white space between sentences, and KEEP marks still in it."""
    return F.regexp_replace(_guarded(text), _BOUNDARY_SPACE, "$1" + CUT + "$2$3")


def sentences(text: Column) -> Column:
    """Sentences in order, trimmed, without empty ones.

    A sentence ends at ``. ! ?`` (and closing quotes or brackets) followed by white
    space, or at a blank line.  A dot inside a word ("example.org"), after a title,
    after single capitals ("J. F.", "U.S.") or after a short form before a small letter or a
    number ("No. 5") does not end one.  The text is marked by three linear passes, then
    split; a model-based splitter may differ.
    """
    marked = F.replace(F.regexp_replace(_guarded(text), _BOUNDARY, "$1" + CUT), F.lit(KEEP), F.lit(""))
    return F.filter(F.transform(F.split(marked, CUT), strip), lambda s: s != "")


def mentions(text: Column, keyword: str) -> Column:
    """Case-insensitive match that ignores dots in both ("Some.Name" mentions "somename" and back)."""
    bare = keyword.replace(".", "").lower()
    if not bare.strip():
        raise ValueError("a keyword needs more than dots and blanks")
    return F.contains(F.lower(F.replace(text, F.lit("."), F.lit(""))), F.lit(bare))


def search_terms(text: Column, terms: Sequence[str]) -> Column:
    """Any of the quoted terms, case-insensitive, as a feed query would OR them."""
    hits = [F.contains(F.lower(text), F.lit(t.lower())) for t in terms]
    return reduce(lambda a, b: a | b, hits)


def keyword_sentences(text: Column, keyword: str) -> Column:
    """All sentences that mention the keyword.

    Text without a mention as a whole is never split: a sentence is a piece of the
    text, so it cannot mention what the text does not.
    """
    found = F.filter(sentences(text), lambda s: mentions(s, keyword))
    return F.when(mentions(text, keyword), found).otherwise(F.array().cast("array<string>"))


def longest(found: Column) -> Column:
    """Longest string of an array, the first among equals; '' for an empty array."""
    ranked = F.transform(found, lambda s, i: F.struct(F.length(s), -i, s.alias("s")))
    return F.coalesce(F.array_max(ranked)["s"], F.lit(""))


def best_sentence(text: Column, keyword: str) -> Column:
    return longest(keyword_sentences(text, keyword))


@batched_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    # Series.str.normalize would keep some memory of every batch
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def nfkc(text: Column) -> Column:
    """Unicode NFKC.  Spark has no built-in for it; ASCII rows are passed to
    Python as NULL and keep their value, so only the others are transferred."""
    needs = text.rlike(r"[^\x00-\x7F]")
    return F.coalesce(_nfkc(F.when(needs, text)), text)


def straighten_quotes(text: Column) -> Column:
    return strip(F.translate(text, CURLY_QUOTES, STRAIGHT_QUOTES))


def normalize_quotes(text: Column) -> Column:
    """NFKC, straight quotes, trimmed; NULL stays NULL."""
    return straighten_quotes(nfkc(text))


def clean_byline(byline: Column, marker: str = ".Wp-") -> Column:
    """Drop style-sheet junk that page parsers leave in bylines.

    Starts with the marker: ''.  Contains ", marker": the part before it.
    Otherwise unchanged; NULL stays NULL.
    """
    tail = ", " + marker
    return F.substring_index(F.when(F.instr(byline, marker) == 1, "").otherwise(byline), tail, 1)


def highlight(text: Column, keyword: str, shown: str | None = None,
              before: str = "<b>", after: str = "</b>") -> Column:
    """Mark up every occurrence of the keyword; ``shown`` is its canonical spelling."""
    shown = (shown or keyword).replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(text, "(?i)" + re.escape(keyword), before + shown + after)


def join_list(items: Column, delimiter: str = ", ") -> Column:
    return F.array_join(items, delimiter)
