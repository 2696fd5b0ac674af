"""Abbreviations learned from a corpus, for sentence boundaries that no fixed list knows.

A word is counted as written with a full stop, with a full stop before a small letter or a digit, and without.
A log-likelihood test tells the words after whose full stop text goes on far more often than after
others'.  The result is a table of rules, which may be stored and used on other texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.functions import text as _text

LEAST_SCORE = 10.83  # chi-squared with one degree of freedom at 0.001
LEAST_DOTTED = 0.5  # of all occurrences; ordinary words mostly stand without a full stop
MAX_RULES = 50_000  # words of a rule list are part of the plan; a longer list is refused, not cut

_OPEN, _CLOSE = "[\"'“‘(\\[]*", "[\"'”’)\\],;:!?]*"
_WORD = r"\p{L}+(?:\.\p{L}+)*"
_GOES_ON = "^" + _OPEN + r"[\p{Ll}\d]"


def count_words(texts: DataFrame, text: str = "text") -> DataFrame:
    """(word, n_dot, n_small, n_plain) of all lower-cased words of all texts.

    ``n_dot``: the word stands before a full stop and white space or the end; ``n_small``: of these, text goes on with a small
    letter or a digit; ``n_plain``: the word stands without a full stop.  Rows without text count nothing.
    One pass, summed map-side; no text is shuffled.
    """
    split = texts.select(F.split(F.col(text), r"[ \t\r\n\f]+").alias("w"))
    of = lambda w, after: F.struct(
        F.lower(F.regexp_extract(w, f"^{_OPEN}({_WORD})(?:\\.|{_CLOSE})$", 1)).alias("word"),
        F.endswith(w, F.lit(".")).alias("dot"), F.coalesce(after.rlike(_GOES_ON), F.lit(False)).alias("small"))
    pairs = F.zip_with(F.col("w"), F.slice("w", 2, F.size("w")), of)
    words = split.filter(F.size("w") > 0).select(F.inline(pairs)).filter("word <> ''")
    return words.groupBy("word").agg(F.count_if("dot").alias("n_dot"), F.count_if(F.col("dot") & F.col("small")).alias("n_small"),
                                     F.count_if(~F.col("dot")).alias("n_plain"))


def _log_likelihood(k: Column, n: Column, p: Column) -> Column:
    """Logarithm of p^k (1 - p)^(n - k), with 0 for an impossible event that did not happen."""
    return (F.when(k > 0, k * F.ln(p)).otherwise(F.lit(0.0)) + F.when(n > k, (n - k) * F.ln(1 - p)).otherwise(F.lit(0.0)))


def learn(counts: DataFrame, least_score: float = LEAST_SCORE, least_dotted: float = LEAST_DOTTED) -> DataFrame:
    """The rule table (word, n_dot, n_small, n_plain, score) from ``count_words``, which may be a sum over many batches.

    ``score`` is twice the log-likelihood ratio of "text goes on after this word's full stop as often as it does"
    against "as often as after all full stops"; only words above that share are taken.
    """
    share = counts.agg(F.sum("n_small") / F.sum("n_dot")).scalar()
    dotted = counts.filter((F.col("n_small") > 0) & (F.col("n_dot") >= least_dotted * (F.col("n_dot") + F.col("n_plain"))))
    k, n = F.col("n_small"), F.col("n_dot")
    here, everywhere = k / n, F.col("_share")
    score = 2 * (_log_likelihood(k, n, here) - _log_likelihood(k, n, everywhere))
    scored = dotted.withColumn("_share", share).filter(here > everywhere).withColumn("score", score)
    return scored.filter(F.col("score") >= least_score).select("word", "n_dot", "n_small", "n_plain", "score")


def rule_list(rules: DataFrame) -> list[str]:
    """The words of a rule table, of at most MAX_RULES."""
    words = [r[0] for r in rules.select("word").distinct().limit(MAX_RULES + 1).collect()]
    if len(words) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} abbreviations; ask for a higher score")
    return sorted(words)


def sentences(text: Column, words: Sequence[str]) -> Column:
    """As ``text.sentences``, but the full stop of a listed word does not end a sentence before a small letter or a digit.

    A blank line always does.  NULL stays NULL.
    """
    if not words:
        return _text.sentences(text)
    pieces = F.split(_text.cut_marks(text), _text.CUT)
    abbreviated = lambda p: F.lower(F.regexp_extract(p, r"(?:^|[^\p{L}.])(" + _WORD + r")\.$", 1)).isin(list(words))
    goes_on = lambda after: (after.rlike(r"^[ \t\r\n\f]+" + _GOES_ON[1:]) & ~after.rlike(r"^[ \t\r\f]*\n[ \t\r\f]*\n"))
    end = lambda p, after: F.when(after.isNull(), "").when(goes_on(after) & abbreviated(p), "").otherwise(_text.CUT)
    joined = F.array_join(F.zip_with(pieces, F.slice(pieces, 2, F.size(pieces)), lambda p, after: F.concat(p, end(p, after))), "")
    clean = F.replace(joined, F.lit(_text.KEEP), F.lit(""))
    return F.filter(F.transform(F.split(clean, _text.CUT), _text.strip), lambda s: s != "")
