"""Article fields from raw HTML.

``markup.parts`` finds the parts of a page in one pass; meta tags, names, dates and links are
handled by JVM column expressions.  Only text with rarer character references than the
common ones goes through a second Arrow UDF.
"""

from __future__ import annotations

import html as _html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from coverlens.functions import dates, markup, text
from coverlens.operators import templates
from coverlens.session import batched_udf

# --- Fixed values: common character references, the ampersand last -------------------
REFERENCES = [
    ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"),
    ("&nbsp;", "\xa0"), ("&copy;", "©"), ("&middot;", "·"), ("&ndash;", "–"),
    ("&mdash;", "—"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"),
    ("&rdquo;", "”"), ("&hellip;", "…"), ("&amp;", "&"),
]
DATE_NAMES = ["article:published_time", "datePublished", "pubdate", "publish-date", "date"]
IMAGE_NAMES = ["og:image", "twitter:image"]
# --- end of fixed values -------------------------------------------------------------

_COMMON = "|".join(ref[1:] for ref, _ in REFERENCES)
_RARE_REFERENCE = rf"&(?!(?:{_COMMON}))#?[A-Za-z0-9]+"


@batched_udf(StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else _html.unescape(t))


def decode_references(value: Column) -> Column:
    """Character references to characters, each decoded once."""
    decoded = value
    for ref, char in REFERENCES:
        decoded = F.replace(decoded, F.lit(ref), F.lit(char))
    return F.coalesce(_unescape(F.when(value.rlike(_RARE_REFERENCE), value)), decoded)


def _drop(html: Column, pattern: str, by: str = " ") -> Column:
    return F.regexp_replace(html, "(?is)" + pattern, by)


def _one_line(value: Column) -> Column:
    return text.strip(F.regexp_replace(value, r"[ \t\r\n\f]+", " "))


def raw_title(html: Column) -> Column:
    """Title with references still encoded: <title>, else the first <h1>."""
    tag = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    heading = F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)
    return _one_line(_drop(F.when(tag != "", tag).otherwise(heading), "<[^>]*>"))


def parts(html: Column) -> Column:
    """Struct of main text, first image, marked-up bylines and times.  Stage it as a column: used twice
    in one select it would run twice."""
    return markup.parts(F.coalesce(html, F.lit("")))


def meta_tags(html: Column) -> Column:
    """All <meta> tags, so that later passes look at a few short strings."""
    return F.regexp_extract_all(html, F.lit(r"(?is)<meta\s[^>]*>"), F.lit(0))


def _meta(tags: Column, names: list[str]) -> Column:
    """Non-empty contents of the tags with one of these names, in page order."""
    any_name = "|".join(n.replace(".", r"\.") for n in names)
    named = F.filter(tags, lambda t: t.rlike(rf"""(?is)\s(?:name|property|itemprop)=["'](?:{any_name})["']"""))
    content = lambda t: F.concat(F.regexp_extract(t, r'(?is)\scontent="([^"]*)"', 1),
                                 F.regexp_extract(t, r"(?is)\scontent='([^']*)'", 1))
    return F.filter(F.transform(named, lambda t: _one_line(content(t))), lambda c: c != "")


def byline(tags: Column, marked: Column | None = None) -> Column:
    """Authors of meta tags, then of marked-up bylines, joined by ", "; '' for none.

    "By Ann Lee and Bo Ray" names two people."""
    named = F.transform(_meta(tags, markup.BYLINE_NAMES), lambda n: n)
    joined = F.array_join(named, chr(0xFDD0))
    named = F.filter(F.split(decode_references(joined), chr(0xFDD0)), lambda n: n != "")
    if marked is not None:
        named = F.concat(named, F.transform(marked, _one_line))
    bare = F.transform(named, lambda n: F.regexp_replace(n, r"(?i)^(?:by|from)[:\s]+", ""))
    people = F.flatten(F.transform(bare, lambda n: F.split(n, r"\s*,\s*|\s+and\s+")))
    return F.array_join(F.array_distinct(F.filter(people, lambda n: n != "")), ", ")


def url_date(url: Column) -> Column:
    """Day in a path such as /2024/02/15/, else NULL."""
    day = F.regexp_extract(url, r"/((?:19|20)\d{2}[/\-]\d{1,2}[/\-]\d{1,2})(?:[/\-_.?#]|$)", 1)
    return dates.parse_date(F.translate(day, "/", "-"))


def publish_date(tags: Column, times: Column, url: Column | None = None) -> Column:
    """Publish time from the URL, meta tags or the page's times, else NULL."""
    parsed = F.filter(F.transform(F.concat(_meta(tags, DATE_NAMES), times), dates.parse_page_date), lambda t: t.isNotNull())
    found = F.get(parsed, F.lit(0))
    return found if url is None else F.coalesce(url_date(url), found)


def absolute(link: Column, url: Column) -> Column:
    """A link of a page as an absolute URL; '' stays ''."""
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    origin = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*/)", 1)
    return (F.when((link == "") | link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
            .when(F.startswith(link, F.lit("//")), F.concat(scheme, link))
            .when(F.startswith(link, F.lit("/")), F.concat(origin, link))
            .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), link)))


def top_image(tags: Column, first: Column | None = None, url: Column | None = None) -> Column:
    """Lead image of the meta tags, else the main text's first image; '' for none."""
    named = F.get(_meta(tags, IMAGE_NAMES), F.lit(0))
    # most values have no reference and are not transferred
    decoded = F.coalesce(markup.decode_attribute(F.when(F.contains(named, F.lit("&")), named)), named)
    image = F.coalesce(decoded, *([] if first is None else [first]), F.lit(""))
    return image if url is None else absolute(image, url)


def summary(title: Column, body: Column) -> Column:
    """The sentences of the whole text that hold most of its frequent words, in reading order."""
    return markup.summary(title, text.sentences(body))


def page_domain(url: Column, keep_www: bool = False) -> Column:
    """Host of a URL in lower case, without user, port and (by default) ``www.``."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return host if keep_www else F.regexp_replace(host, r"^www\.", "")


def article_records(pages: DataFrame, run_ts: Column | None = None, empty_ok: bool = False,
                    page_templates: DataFrame | None = None) -> DataFrame:
    """One article record per page of (id, url, html).

    ``success`` is false for a missing page ("no page") and, unless ``empty_ok``, for one
    without body text ("no body text"); such a page still yields a record with the reason.
    ``page_templates`` (``templates.find_templates`` on ``page_domain``, of this or an earlier run) takes the
    blocks that a host repeats out of text and summary.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    stamp = run_ts if run_ts is not None else F.localtimestamp()
    # Each step is a column of its own: an expression that is used twice would run twice.
    found = pages.select(
        F.col("id").alias("story_id"), "url", (html == "").alias("no_html"), meta_tags(html).alias("tags"),
        raw_title(html).alias("raw"), parts(html).alias("parts"))
    titled = found.withColumn("title", text.strip(decode_references(F.col("raw")))).withColumn("text", F.col("parts.text"))
    if page_templates is not None:
        hosted = titled.withColumn("_host", page_domain(F.col("url")))
        titled = templates.without_templates(hosted, page_templates, "_host").drop("_host", "n_removed")
    fields = titled.select(
        "story_id", "url", "no_html", "title", "text",
        publish_date(F.col("tags"), F.col("parts.times"), F.col("url")).alias("publish_date"),
        byline(F.col("tags"), F.col("parts.bylines")).alias("authors"),
        top_image(F.col("tags"), F.col("parts.image")).alias("image"),
        summary(F.col("title"), F.col("text")).alias("summary"))
    full = F.col("text") != ""
    ok = ~F.col("no_html") if empty_ok else full
    when_ok = lambda value: F.when(ok, value).otherwise("")
    return fields.select(
        "story_id", stamp.cast("timestamp_ntz").alias("import_date"), when_ok(F.col("title")).alias("title"), "text",
        F.when(ok, F.col("publish_date")).alias("publish_date"), when_ok(F.col("authors")).alias("authors"),
        when_ok(absolute(F.col("image"), F.col("url"))).alias("top_image"), when_ok(F.col("summary")).alias("summary"),
        ok.alias("success"),
        F.when(F.col("no_html"), "no page").when(~full, "no body text").cast("string").alias("error"))
