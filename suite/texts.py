"""Text and HTML extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverlens.functions import dates, html, sql_functions, text
from coverlens.operators import abbreviations, templates
from coverlens.plans import stages
from coverlens.sources import landing
from suite import star
from suite.registry import query, table

KEYWORD = "Tha.t"  # dots count neither in the keyword nor in the text


# --- SQL twins: RE2 has no back-references, so elements go one kind per pass ----------

def sql_chars(chars: str) -> str:
    return " || ".join(f"chr({ord(c)})" for c in chars)


SQL_WHITE = f"({sql_chars(text.WHITE_SPACE)})"


def sql_strip(value: str) -> str:
    return f"trim({value}, {SQL_WHITE})"


def sql_replace_all(value: str, pattern: str, by: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"regexp_replace({value}, '{quoted}', {by}, 'g')"


def sql_marked(value: str) -> str:
    abbreviations = "|".join(text.ABBREVIATIONS)
    guarded = sql_replace_all(value, rf"(^|[^\p{{L}}])((?:{abbreviations})\.|(?:\p{{Lu}}\.)+)", r"'\1\2' || chr(64977)")
    short = "|".join(text.SHORT_FORMS)
    guarded = sql_replace_all(guarded, rf"(^|[^\p{{L}}])((?:{short})\.)([ \t\r\n\f]+[\p{{Ll}}\d])", r"'\1\2' || chr(64977) || '\3'")
    cut = sql_replace_all(guarded, "([.!?]+[\"'”’)\\]]*)[ \\t\\r\\n\\f]+|\\n[ \\t\\r\\f]*\\n", r"'\1' || chr(64976)")
    return f"replace({cut}, chr(64977), '')"


def sql_sentences(source: str, key: str, value: str) -> str:
    """Rows (key, i, s) of all sentences in order."""
    return f"""
    SELECT {key}, (row_number() OVER (PARTITION BY {key} ORDER BY j))::BIGINT AS i, s FROM (
      SELECT {key}, j, {sql_strip('raw')} AS s FROM (
        SELECT {key}, unnest(parts) AS raw, generate_subscripts(parts, 1) AS j
        FROM (SELECT {key}, string_split({sql_marked(value)}, chr(64976)) AS parts FROM {source})))
    WHERE s <> ''"""


def sql_mentions(value: str, keyword: str) -> str:
    return f"contains(lower(replace({value}, '.', '')), '{keyword.replace('.', '').lower()}')"


SQL_SENTENCES = sql_sentences("documents", "doc_id", "text")
SQL_HITS = f"SELECT * FROM ({SQL_SENTENCES}) WHERE {sql_mentions('s', KEYWORD)}"
SQL_BEST = f"SELECT doc_id, first(s ORDER BY length(s) DESC, i) AS s FROM ({SQL_HITS}) GROUP BY doc_id"
STRAIGHT = ("replace(replace(replace(replace({}, '‘', ''''), '’', ''''), '“', '\"'), '”', '\"')")


def docs(spark, sf):
    return table(spark, sf, "documents")


def texts(spark, sf):
    """Whole texts."""
    return docs(spark, sf).select("doc_id", "lang", "text")


@query("text_sentences", SQL_SENTENCES)
def text_sentences(spark, sf):
    return texts(spark, sf).select("doc_id", F.posexplode(text.sentences(F.col("text"))).alias("p", "s")).select(
        "doc_id", (F.col("p") + 1).cast("bigint").alias("i"), "s")


# Two abbreviations that no list has, in place of frequent words.
PLANTED = [(" of ", " ovz. "), (" des ", " d.zt. ")]
SQL_PLANTED = f"(SELECT doc_id, {'replace(' * len(PLANTED)}text{''.join(f', {chr(39)}{a}{chr(39)}, {chr(39)}{b}{chr(39)})' for a, b in PLANTED)} AS text FROM documents)"
SQL_OPEN = "[\"''“‘(\\[]*"
SQL_COUNTS = f"""
SELECT word, count(*) FILTER (WHERE dot) AS n_dot, count(*) FILTER (WHERE dot AND small) AS n_small, count(*) FILTER (WHERE NOT dot) AS n_plain
FROM (SELECT lower(regexp_extract(w, '^{SQL_OPEN}(\\p{{L}}+(?:\\.\\p{{L}}+)*)(?:\\.|["''”’)\\],;:!?]*)$', 1)) AS word, ends_with(w, '.') AS dot,
             coalesce(regexp_matches(lead(w) OVER (PARTITION BY doc_id ORDER BY i), '^{SQL_OPEN}[\\p{{Ll}}\\d]'), false) AS small
      FROM (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
            FROM (SELECT doc_id, regexp_split_to_array(text, '[ \\t\\r\\n\\f]+') AS ws FROM {SQL_PLANTED})))
WHERE word <> '' GROUP BY word"""
SQL_RULES = f"""
SELECT word, n_dot, n_small, n_plain, score FROM (
  SELECT *, 2 * (n_small * ln(n_small / n_dot) + CASE WHEN n_dot > n_small THEN (n_dot - n_small) * ln(1 - n_small / n_dot) ELSE 0 END
                 - n_small * ln(p) - (n_dot - n_small) * ln(1 - p)) AS score
  FROM (SELECT *, sum(n_small) OVER () / sum(n_dot) OVER () AS p FROM ({SQL_COUNTS}))
  WHERE n_small > 0 AND 2 * n_dot >= n_dot + n_plain AND n_small / n_dot > p) WHERE score >= {abbreviations.LEAST_SCORE}"""


def planted(spark, sf):
    """Whole texts with abbreviations that only the corpus can tell."""
    given = F.col("text")
    for word, short in PLANTED:
        given = F.replace(given, F.lit(word), F.lit(short))
    return texts(spark, sf).withColumn("text", given)


@query("text_abbreviations", SQL_RULES)
def text_abbreviations(spark, sf):
    return abbreviations.learn(abbreviations.count_words(planted(spark, sf)))


@query("text_sentences_learned", f"""
WITH pieces AS ({sql_sentences(SQL_PLANTED, 'doc_id', 'text')}),
ends AS (SELECT *, coalesce(lag(lower(regexp_extract(s, '(?:^|[^\\p{{L}}.])(\\p{{L}}+(?:\\.\\p{{L}}+)*)\\.$', 1))) OVER w, '') AS last
         FROM pieces WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
starts AS (SELECT *, sum(CASE WHEN last IN (SELECT word FROM ({SQL_RULES})) AND regexp_matches(s, '^{SQL_OPEN}[\\p{{Ll}}\\d]') THEN 0 ELSE 1 END)
                  OVER (PARTITION BY doc_id ORDER BY i) AS place FROM ends)
SELECT doc_id, place::BIGINT AS i, string_agg(s, ' ' ORDER BY i) AS s FROM starts GROUP BY ALL""")
def text_sentences_learned(spark, sf):
    given = planted(spark, sf)
    words = abbreviations.rule_list(abbreviations.learn(abbreviations.count_words(given)))
    return given.select("doc_id", F.posexplode(abbreviations.sentences(F.col("text"), words)).alias("p", "s")).select(
        "doc_id", (F.col("p") + 1).cast("bigint").alias("i"), "s")


@query("text_keyword_sentences", f"SELECT doc_id, s FROM ({SQL_HITS})")
def text_keyword_sentences(spark, sf):
    return texts(spark, sf).select("doc_id", F.explode(text.keyword_sentences(F.col("text"), KEYWORD)).alias("s"))


@query("agg_longest_match", f"""
SELECT d.doc_id, coalesce(b.s, '') AS sentence FROM documents d LEFT JOIN ({SQL_BEST}) b USING (doc_id)""")
def agg_longest_match(spark, sf):
    return texts(spark, sf).select("doc_id", text.best_sentence(F.col("text"), KEYWORD).alias("sentence"))


@query("text_best_sentence", f"""
SELECT d.doc_id::VARCHAR AS story_id, {star.SQL_TS} AS import_date, {sql_strip(STRAIGHT.format("coalesce(b.s, '')"))} AS sentence
FROM documents d LEFT JOIN ({SQL_BEST}) b USING (doc_id)
WHERE d.text <> '' AND d.doc_id NOT IN (SELECT doc_id FROM labels)""")
def text_best_sentence(spark, sf):
    articles = texts(spark, sf).select(F.col("doc_id").cast("string").alias("story_id"), "text")
    done = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("story_id"))
    return stages.best_sentences(stages.sentence_backlog(articles, done), KEYWORD, dates.run_timestamp(star.RUN_TS))


@query("text_normalize_quotes", """
SELECT doc_id, CASE WHEN lang <> 'es' THEN trim('"It''s" "fine" ... ' || text, chr(10) || ' ') || '''' END AS text FROM documents""")
def text_normalize_quotes(spark, sf):
    curly = F.concat(F.lit(" “It’s” „ﬁne‟ … "), text.strip(F.col("text")), F.lit("’\xa0\n"))
    given = F.when(F.col("lang") != "es", curly)
    return texts(spark, sf).select("doc_id", text.normalize_quotes(given).alias("text"))


@query("udf_vectorized_text", "SELECT doc_id, 'fi 1/2 TM ' || text || 'é' AS text FROM documents")
def udf_vectorized_text(spark, sf):
    # ligature, digits and letters in compatibility forms, e with a combining accent
    given = F.concat(F.lit("ﬁ １／２ ™ "), F.col("text"), F.lit("e" + chr(0x301)))
    return texts(spark, sf).select("doc_id", text.nfkc(given).alias("text"))


SQL_JUNK = """(SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '.Wp-block ' || source WHEN 1 THEN source || ', .Wp-block, ' || lang || ', .Wp-x'
 WHEN 2 THEN source || ' .Wp-inline' END AS byline FROM documents)"""
SQL_CLEAN = f"""
SELECT doc_id, regexp_extract(byline, '^(?:\\.Wp-.*|(.*?)(?:, \\.Wp-.*)?)$', 1, 's') AS byline FROM {SQL_JUNK}"""


def junk_bylines(spark, sf):
    kind = F.col("doc_id") % 4
    byline = (F.when(kind == 0, F.concat(F.lit(".Wp-block "), "source"))
              .when(kind == 1, F.concat("source", F.lit(", .Wp-block, "), "lang", F.lit(", .Wp-x")))
              .when(kind == 2, F.concat("source", F.lit(" .Wp-inline"))))
    return docs(spark, sf).select("doc_id", byline.alias("byline"))


@query("text_clean_byline", SQL_CLEAN)
def text_clean_byline(spark, sf):
    return junk_bylines(spark, sf).select("doc_id", text.clean_byline(F.col("byline")).alias("byline"))


@query("udf_sql_macro", SQL_CLEAN)
def udf_sql_macro(spark, sf):
    sql_functions.register(spark)
    return junk_bylines(spark, sf).select("doc_id", F.expr("clean_byline(byline)").alias("byline"))


@query("fn_split_part", f"SELECT doc_id, split_part(byline, ', .Wp-', 1) AS byline FROM {SQL_JUNK}")
def fn_split_part(spark, sf):
    return junk_bylines(spark, sf).select(
        "doc_id", F.split_part("byline", F.lit(", .Wp-"), F.lit(1)).alias("byline"))


@query("text_highlight", "SELECT doc_id, regexp_replace(text, 'there', '<b>There</b>', 'gi') AS text FROM documents")
def text_highlight(spark, sf):
    return texts(spark, sf).select("doc_id", text.highlight(F.col("text"), "there", "There").alias("text"))


# --- HTML ----------------------------------------------------------------------------

# References that HTML also accepts without their semicolon (a title may be cut off at one).
LEGACY = ["&quot;", "&lt;", "&gt;", "&nbsp;", "&copy;", "&middot;", "&amp;"]


def sql_decoded(value: str) -> str:
    for ref, char in html.REFERENCES:
        if ref in LEGACY:
            value = sql_replace_all(value, ref + "?", sql_chars(char))
        else:
            value = f"replace({value}, '{ref}', {sql_chars(char)})"
    return value


def sql_drop(value: str, pattern: str, by: str = "' '") -> str:
    return sql_replace_all(value, "(?is)" + pattern, by)


def sql_one_line(value: str) -> str:
    return sql_strip(sql_replace_all(value, r"[ \t\r\n\f]+", "' '"))


SQL_TITLE = sql_strip(sql_decoded(sql_one_line("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")))


# The twin works on the given pages, which hold one flat <article>, by its own lists.
_DROPPED = "script style noscript template nav header footer aside".split()
_BREAKS = "p|div|br|li|ul|ol|h[1-6]|blockquote|tr|table|section|article|figure|figcaption"


def _sql_article() -> str:
    clean = sql_drop("html", "<!--.*?-->")
    for tag in _DROPPED:
        clean = sql_drop(clean, rf"<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>")
    clean = sql_drop(clean, r"""<div[^>]*\sclass=["'](?:ad|ads|advertisement)["'][^>]*>.*?</div\s*>""")
    article = f"regexp_extract({clean}, '(?is)<article[^>]*>(.*?)</article>', 1)"
    broken = sql_drop(article, rf"</?(?:{_BREAKS})(?:\s[^>]*)?/?>", "chr(10) || chr(10)")
    plain = sql_replace_all(sql_drop(broken, "<[^>]*>", "''"), r"[ \t\r\f]+", "' '")
    return sql_strip(sql_decoded(sql_replace_all(plain, r" ?\n[ \n]*", "chr(10) || chr(10)")))


SQL_BODY = f"SELECT page_id, url, html, {_sql_article()} AS body FROM pages"


def pages(spark, sf):
    return table(spark, sf, "pages")


@query("html_title", f"SELECT page_id, {SQL_TITLE} AS title FROM pages")
def html_title(spark, sf):
    raw = pages(spark, sf).select("page_id", html.raw_title(F.col("html")).alias("raw"))
    return raw.select("page_id", text.strip(html.decode_references(F.col("raw"))).alias("title"))


def bodies(frame):
    """The pages with their main text as ``body``."""
    return frame.withColumn("parts", html.parts(F.col("html"))).withColumn("body", F.col("parts.text"))


@query("html_body_text", f"SELECT page_id, body FROM ({SQL_BODY})")
def html_body_text(spark, sf):
    return bodies(pages(spark, sf)).select("page_id", "body")


# The same pages with more markup around and in the article, by page_id % 6, and what it adds to the text.
WRAPPED = [
    ("<body>", '<body><form action="/x"><select><option>One</option></select>', ""),
    ("</article>", "<article><p>Inner.</p></article><p>Tail of the story.</p></article>", "\n\nInner.\n\nTail of the story."),
    ("</article>", "</article><article><p>Second.</p></article>", "\n\nSecond."),
    ("</article>", "<header><p>Lead.</p></header></article>", "\n\nLead."),
    ("</article>", '<div class="ad"><div>Buy</div> now</div></article>', ""),
    ("</article>", "</article><nav><p>", ""),
]


@query("html_body_wrapped", f"""
SELECT page_id, body || CASE page_id % 6 {' '.join(f"WHEN {i} THEN replace('{more}', chr(92) || 'n', chr(10))" for i, (_, _, more) in enumerate(WRAPPED))} END AS body
FROM ({SQL_BODY})""".replace("\n\n", "\\n\\n"))
def html_body_wrapped(spark, sf):
    wrapped = F.col("html")
    for i, (tag, by, _) in enumerate(WRAPPED):
        wrapped = F.when(F.col("page_id") % len(WRAPPED) == i, F.replace("html", F.lit(tag), F.lit(by))).otherwise(wrapped)
    form = F.replace(wrapped, F.lit("</body>"), F.when(F.col("page_id") % len(WRAPPED) == 0, "</form></body>").otherwise("</body>"))
    return bodies(pages(spark, sf).select("page_id", form.alias("html"))).select("page_id", "body")


# The same pages with a line of their host in every article but each fifth.
SQL_HOSTED = f"""
SELECT page_id, regexp_replace(lower(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1)), '^www\\.', '') AS host, body
FROM ({SQL_BODY.replace('FROM pages', """FROM (SELECT page_id, url, CASE WHEN page_id % 5 = 0 THEN html ELSE
  replace(html, '</article>', '<p>More on ' || split_part(url, '/', 3) || '</p></article>') END AS html FROM pages)""")})"""


@query("html_body_templates", f"""
WITH hosted AS ({SQL_HOSTED}),
blocks AS (SELECT page_id, host, body, unnest(string_split(body, chr(10) || chr(10))) AS block,
                  generate_subscripts(string_split(body, chr(10) || chr(10)), 1) AS i FROM hosted WHERE body <> ''),
counted AS (SELECT host, block, count(DISTINCT body) AS n FROM blocks GROUP BY ALL),
sizes AS (SELECT host, count(DISTINCT body) AS n_pages FROM blocks GROUP BY ALL),
repeated AS (SELECT host, block FROM counted JOIN sizes USING (host) WHERE n >= 3 AND 2 * n >= n_pages),
kept AS (SELECT page_id, string_agg(b.block, chr(10) || chr(10) ORDER BY i) FILTER (WHERE r.host IS NULL) AS text,
                count(r.host) AS n_removed
         FROM blocks b LEFT JOIN repeated r ON b.host = r.host AND b.block = r.block GROUP BY page_id)
SELECT h.page_id, h.host, coalesce(k.text, '') AS text, coalesce(k.n_removed, 0)::INT AS n_removed
FROM hosted h LEFT JOIN kept k USING (page_id)""")
def html_body_templates(spark, sf):
    line = F.concat(F.lit("<p>More on "), F.split_part("url", F.lit("/"), F.lit(3)), F.lit("</p></article>"))
    planted = F.when(F.col("page_id") % 5 == 0, F.col("html")).otherwise(F.replace("html", F.lit("</article>"), line))
    hosted = bodies(pages(spark, sf).withColumn("html", planted)).select(
        "page_id", html.page_domain(F.col("url")).alias("host"), F.col("body").alias("text"))
    return templates.without_templates(hosted, templates.find_templates(hosted)).select("page_id", "host", "text", "n_removed")


# The formula of the summary: long words count by their other occurrences, title words three more.
SQL_SUMMARY = f"""
SELECT page_id, string_agg(s, ' ' ORDER BY i) AS summary FROM (
  SELECT page_id, i, any_value(s) AS s, row_number() OVER (PARTITION BY page_id ORDER BY
    1000 * coalesce(sum(n - 1 + 3 * hit), 0) // (10 + count(word)) DESC, i) AS place
  FROM (SELECT * FROM ({sql_sentences(f'({SQL_BODY})', 'page_id', 'body')}))
  LEFT JOIN (SELECT page_id, i, word, any_value(n) AS n, any_value(hit) AS hit FROM (
      SELECT page_id, i, word, count(*) OVER (PARTITION BY page_id, word) AS n,
             list_contains(regexp_extract_all(lower(title), '\\p{{L}}+'), word)::INT AS hit
      FROM (SELECT page_id, i, unnest(regexp_extract_all(lower(s), '\\p{{L}}+')) AS word
            FROM ({sql_sentences(f'({SQL_BODY})', 'page_id', 'body')}))
      JOIN (SELECT page_id, {SQL_TITLE} AS title FROM pages) USING (page_id) WHERE length(word) >= 4) GROUP BY ALL) USING (page_id, i)
  GROUP BY page_id, i) WHERE place <= 3 GROUP BY page_id"""
SQL_SUMMARY_OF_ALL = f"SELECT p.page_id, coalesce(l.summary, '') AS summary FROM pages p LEFT JOIN ({SQL_SUMMARY}) l USING (page_id)"


def summaries(spark, sf):
    titled = bodies(pages(spark, sf)).withColumn("title", text.strip(html.decode_references(html.raw_title(F.col("html")))))
    return titled.select("page_id", html.summary(F.col("title"), F.col("body")).alias("summary"))


@query("html_summary", SQL_SUMMARY_OF_ALL)
def html_summary(spark, sf):
    return summaries(spark, sf)


@query("html_lead_summary", SQL_SUMMARY_OF_ALL)
def html_lead_summary(spark, sf):
    """The survey's name for the summary."""
    return summaries(spark, sf)


# Pages carry no author, date or image tags: each gets some, made from its own url and id.
SQL_META_PAGES = """(
SELECT page_id, replace(html, '<head>', '<head>' || CASE page_id % 4
    WHEN 0 THEN '<meta name="author" content="Desk ' || page_id || '"><meta name="author" content="Ann &amp; Co"><meta name="author" content="Desk ' || page_id || '">'
    WHEN 1 THEN '<META content=''Desk ' || page_id || ''' property=''article:author''>' ELSE '' END
  || CASE page_id % 3
    WHEN 0 THEN '<meta property="article:published_time" content="2024-03-' || lpad((page_id % 28 + 1)::VARCHAR, 2, '0') || 'T10:20:30Z">'
    WHEN 1 THEN '<meta name="date" content="soon"><time datetime="2023-12-' || lpad((page_id % 31 + 1)::VARCHAR, 2, '0') || '"></time>' ELSE '' END
  || CASE page_id % 2 WHEN 0 THEN '<meta property="og:image" content="' || url || '/lead.png">' ELSE '' END) AS html, url
FROM pages)"""


def meta_pages(spark, sf):
    key, kind = F.col("page_id").cast("string"), lambda n: F.col("page_id") % n
    cat = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    author = (F.when(kind(4) == 0, cat('<meta name="author" content="Desk ', key, '"><meta name="author" content="Ann &amp; Co">',
                                       '<meta name="author" content="Desk ', key, '">'))
              .when(kind(4) == 1, cat("<META content='Desk ", key, "' property='article:author'>")).otherwise(""))
    two = lambda n: F.lpad((kind(n) + 1).cast("string"), 2, "0")
    date = (F.when(kind(3) == 0, cat('<meta property="article:published_time" content="2024-03-', two(28), 'T10:20:30Z">'))
            .when(kind(3) == 1, cat('<meta name="date" content="soon"><time datetime="2023-12-', two(31), '"></time>'))
            .otherwise(""))
    image = F.when(kind(2) == 0, cat('<meta property="og:image" content="', F.col("url"), '/lead.png">')).otherwise("")
    return pages(spark, sf).select("page_id", "url", F.replace("html", F.lit("<head>"), cat("<head>", author, date, image)).alias("html"))


def _tags():
    return html.meta_tags(F.col("html"))


@query("html_byline", """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Desk ' || page_id || ', Ann & Co' WHEN 1 THEN 'Desk ' || page_id ELSE '' END AS authors
FROM pages""")
def html_byline(spark, sf):
    tagged = meta_pages(spark, sf).select("page_id", _tags().alias("tags"))
    return tagged.select("page_id", html.byline(F.col("tags")).alias("authors"))


@query("html_publish_date", """
SELECT page_id, CASE page_id % 3 WHEN 0 THEN make_timestamp(2024, 3, page_id % 28 + 1, 10, 20, 30)
  WHEN 1 THEN make_timestamp(2023, 12, page_id % 31 + 1, 0, 0, 0) END AS publish_date FROM pages""")
def html_publish_date(spark, sf):
    tagged = meta_pages(spark, sf).select("page_id", _tags().alias("tags"), html.parts(F.col("html")).alias("parts"))
    return tagged.select("page_id", html.publish_date(F.col("tags"), F.col("parts.times")).alias("publish_date"))


@query("html_top_image", f"""
SELECT page_id, regexp_extract(html, '<meta property="og:image" content="([^"]*)"', 1) AS top_image FROM {SQL_META_PAGES}""")
def html_top_image(spark, sf):
    tagged = meta_pages(spark, sf).select("page_id", _tags().alias("tags"))
    return tagged.select("page_id", html.top_image(F.col("tags")).alias("top_image"))


@query("html_article_record", f"""
SELECT p.page_id::VARCHAR AS story_id, {star.SQL_TS} AS import_date, CASE WHEN body <> '' THEN {SQL_TITLE} ELSE '' END AS title,
       body AS text, NULL::TIMESTAMP AS publish_date, '' AS authors, '' AS top_image, coalesce(l.summary, '') AS summary,
       body <> '' AS success, CASE WHEN body = '' THEN 'no body text' END AS error
FROM ({SQL_BODY}) p LEFT JOIN ({SQL_SUMMARY}) l USING (page_id)""")
def html_article_record(spark, sf):
    return html.article_records(landing.read_pages(spark, f"{sf}/pages.parquet"), dates.run_timestamp(star.RUN_TS))


@query("page_domain", r"""
SELECT page_id, regexp_replace(lower(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1)), '^www\.', '') AS domain
FROM pages""")
def page_domain(spark, sf):
    return table(spark, sf, "pages").select("page_id", html.page_domain(F.col("url")).alias("domain"))


@query("fn_join_list", f"SELECT doc_id, string_agg(s, ' | ' ORDER BY i) AS hits FROM ({SQL_HITS}) GROUP BY doc_id")
def fn_join_list(spark, sf):
    hits = texts(spark, sf).select("doc_id", text.keyword_sentences(F.col("text"), KEYWORD).alias("hits"))
    return hits.filter(F.size("hits") > 0).select("doc_id", text.join_list(F.col("hits"), " | ").alias("hits"))
