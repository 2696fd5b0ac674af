"""The parts of a web page, found in one pass over its tags.

Spark's regular expressions cannot match nested elements in linear time, so this part is an
Arrow UDF.  It only finds the parts; cleaning and parsing them are column expressions.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect_right

import pandas as pd
from pyspark.sql import types as T

from coverlens.session import batched_udf

# --- Fixed values --------------------------------------------------------------------
RAW_ELEMENTS = ["script", "style", "noscript", "template", "textarea"]
BOILERPLATE = ["nav", "footer", "aside", "button", "select", "head"]
AD_CLASSES = ["ad", "ads", "advertisement"]
BLOCK_TAGS = ["p", "div", "br", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "tr", "table",
              "section", "article", "main", "figure", "figcaption", "body", "form", "header"]
BYLINE_NAMES = ["author", "article:author", "byline", "dc.creator", "byl"]
BYLINE_TAGS = ["a", "span", "div", "p", "address", "cite", "strong"]
# --- end of fixed values -------------------------------------------------------------

LEAST_SHARE = 0.25  # articles with a smaller part of the page's words are teasers: the whole body counts
SCHEMA = T.StructType([T.StructField("text", T.StringType()), T.StructField("image", T.StringType()),
                       T.StructField("bylines", T.ArrayType(T.StringType())), T.StructField("times", T.ArrayType(T.StringType()))])

_NAME = re.compile(r"/?([A-Za-z][A-Za-z0-9:-]*)")
_AD = re.compile(rf"""\sclass=["']?(?:{'|'.join(AD_CLASSES)})["'\s>]""", re.I)
_BYLINE = re.compile(rf"""\s(?:rel|itemprop|class|id)=["'](?:{'|'.join(map(re.escape, BYLINE_NAMES))})["']""", re.I)
_SOURCE = re.compile(r"""\ssrc=["']([^"']*)["']""", re.I)
_TIME = re.compile(r"""\sdatetime=["']([^"']*)["']""", re.I)
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW_ELEMENTS}


def _tags(page: str) -> list[tuple[int, int, str, bool]]:
    """(start, end, name, closing) of all tags in order; comments and raw elements count as one nameless tag."""
    out, at, missing = [], 0, set()
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4) if "<!--" not in missing else -1
            if end < 0:
                missing.add("<!--")
            out.append((start, end + 3 if end >= 0 else start + 4, "", False))
            at = out[-1][1]
            continue
        end = page.find(">", start)
        if end < 0:
            break
        found = _NAME.match(page, start + 1)
        if not found:  # a doctype, or a lone "<" before text
            skip = end + 1 if page[start + 1:start + 2] in ("!", "?", "/") else start + 1
            if skip > start + 1:
                out.append((start, skip, "", False))
            at = skip
            continue
        name, closing = found[1].lower(), page[start + 1] == "/"
        if name in _ENDS and not closing and name not in missing:
            last = _ENDS[name].search(page, end + 1)
            if last:
                out.append((start, last.end(), "", False))
                at = last.end()
                continue
            missing.add(name)
        out.append((start, end + 1, name, closing))
        at = end + 1
    return out


class _Places:
    """Disjoint intervals made of many; asks whether a place lies in one."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.ends = [], []
        for start, end in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def __contains__(self, place: int) -> bool:
        i = bisect_right(self.starts, place) - 1
        return i >= 0 and place < self.ends[i]


def _tidy(pieces: list[str]) -> str:
    plain = re.sub(r"[ \t\r\f]+", " ", "".join(pieces))
    return _html.unescape(re.sub(r"\n[ \n]*", "\n\n", plain.replace(" \n", "\n"))).strip()


def attribute(value: str) -> str:
    """An attribute's value: only references that end in ';' are decoded, as in a URL's query."""
    return re.sub(r"&#?\w+;", lambda found: _html.unescape(found[0]), value)


def page_parts(page: str) -> tuple[str, str, list[str], list[str]]:
    """(main text, first image in it, marked-up bylines, times).

    Elements count only if they are closed.  The main text is that of all articles, nested ones
    included, or of the whole body if articles hold little of it; without navigation,
    footers, ads, and headers outside of articles.  Text in forms stays.
    """
    tags = _tags(page)
    opened: dict[str, list[int]] = {}
    spans: list[tuple[int, int, str, int]] = []  # start and end of the content, name, number of the opening tag
    for i, (start, end, name, closing) in enumerate(tags):
        if closing and opened.get(name):
            first = opened[name].pop()
            spans.append((tags[first][1], start, name, first))
        elif name and not closing:
            opened.setdefault(name, []).append(i)
    of = lambda *names: [(a, b) for a, b, name, _ in spans if name in names]
    articles = _Places(of("article"))
    ads = [(a, b) for a, b, name, i in spans if name == "div" and _AD.search(page, tags[i][0], tags[i][1])]
    dropped = _Places(of(*BOILERPLATE) + ads + [(a, b) for a, b in of("header") if a not in articles])

    everything: list[str] = []
    in_articles: list[str] = []
    image = [None, None]
    at = 0
    for start, end, name, _ in [*tags, (len(page), len(page), "", False)]:
        if at < start and at not in dropped:
            everything.append(page[at:start])
            if at in articles:
                in_articles.append(page[at:start])
        if name in BLOCK_TAGS:
            everything.append("\n\n")
            in_articles.append("\n\n")
        if name == "img" and start not in dropped and (source := _SOURCE.search(page, start, end)):
            place = int(start not in articles)
            image[place] = image[place] or source[1].strip()
        at = end
    words = lambda pieces: sum(len(p.split()) for p in pieces)
    own = words(in_articles) >= LEAST_SHARE * words(everything) and words(in_articles) > 0
    bylines = [(a, " ".join(re.sub(r"<[^>]*>", " ", page[a:b]).split())) for a, b, name, i in spans
               if name in BYLINE_TAGS and _BYLINE.search(page, tags[i][0], tags[i][1])]
    times = [found[1] for start, end, name, closing in tags
             if name == "time" and not closing and (found := _TIME.search(page, start, end))]
    picture = image[0] if own else image[0] or image[1]
    return (_tidy(in_articles if own else everything), attribute(picture or ""),
            [_html.unescape(b) for _, b in sorted(bylines)], times)


@batched_udf(SCHEMA)
def parts(pages: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([page_parts(p or "") for p in pages], columns=["text", "image", "bylines", "times"])


@batched_udf(T.StringType())
def decode_attribute(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else attribute(v))


@batched_udf(T.StringType())
def summary(titles: pd.Series, sentences: pd.Series) -> pd.Series:
    return pd.Series([summarise(t or "", list(s) if s is not None else []) for t, s in zip(titles, sentences)], dtype=object)


SUMMARY_SENTENCES, LONG_WORD = 3, 4
_WORD = re.compile(r"[^\W\d_]+")


def summarise(title: str, sentences: list[str]) -> str:
    """The sentences that hold most of the whole text's frequent words, in reading order.

    A sentence scores its distinct words of four letters or more: each by how often it comes
    again in the text, three more if the title has it, in all per (10 + their number),
    in thousandths; ties go to the earlier one.
    """
    known = set(_WORD.findall(title.lower()))
    words = [[w for w in _WORD.findall(s.lower()) if len(w) >= LONG_WORD] for s in sentences]
    count: dict[str, int] = {}
    for w in (w for s in words for w in s):
        count[w] = count.get(w, 0) + 1
    score = lambda own: 1000 * sum(count[w] - 1 + 3 * (w in known) for w in own) // (10 + len(own))
    ranked = sorted(range(len(sentences)), key=lambda i: (-score(set(words[i])), i))[:SUMMARY_SENTENCES]
    return " ".join(sentences[i] for i in sorted(ranked))
