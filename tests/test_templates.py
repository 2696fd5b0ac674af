"""Blocks that a host repeats, against plain counting."""

from pyspark.sql import functions as F

from coverlens.functions import html
from coverlens.operators import templates

LINE = "Sign up for our letter."
PAGES = (
    [(i, "a.org", f"Lead {i}.\n\n{LINE}\n\nStory {i}." if i != 7 else "Lead 7.\n\nStory 7.") for i in range(10)]
    + [(20, "b.org", f"Alone.\n\n{LINE}"), (21, "c.org", "Same."), (22, "c.org", "Same."), (23, "c.org", "Same."), (24, "c.org", "Same.")]
    + [(30 + i, "d.org", f"Rare.\n\nD {i}." if i < 3 else f"D {i}.") for i in range(7)]
    + [(40, None, LINE), (41, "a.org", None), (42, "a.org", ""), (43, "", LINE), (44, "a.org", f"{LINE}\n\n{LINE}")])


def frame(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id int, host string, text string").withColumn("n", F.lit("extra"))


def plain(rows, least=3, share=0.5):
    found = {}
    for _, host, text in rows:
        if host and text:
            found.setdefault(host, set()).add(text)
    out = {}
    for key, host, text in rows:
        parts = text.split("\n\n") if text else []
        kept = [b for b in parts if not host or (n := sum(b in t.split("\n\n") for t in found[host])) < least
                or n < share * len(found[host])]
        out[key] = ("\n\n".join(kept) if len(kept) < len(parts) else text, len(parts) - len(kept))
    return out


def test_equals_plain_counting(spark):
    for salts in (1, 3):
        pages = frame(spark)
        got = templates.without_templates(pages, templates.find_templates(pages), salts=salts)
        assert got.columns == ["page_id", "host", "text", "n", "n_removed"]
        rows = {r["page_id"]: (r["text"], r["n_removed"]) for r in got.collect()}
        assert rows == plain(PAGES)
        assert rows[0] == ("Lead 0.\n\nStory 0.", 1) and rows[20][1] == 0  # a host of one page loses nothing
        assert rows[21] == ("Same.", 0) and rows[30][1] == 0 and rows[44] == ("", 2)


def test_parameters_and_empty_tables(spark):
    pages = frame(spark)
    wide = templates.find_templates(pages, least_pages=3, least_share=0.4)
    got = {r["page_id"]: (r["text"], r["n_removed"]) for r in templates.without_templates(pages, wide).collect()}
    assert got == plain(PAGES, share=0.4) and got[30] == ("D 0.", 1)
    nothing = frame(spark, [])
    assert templates.find_templates(nothing).count() == 0
    assert templates.without_templates(nothing, wide).count() == 0
    assert templates.without_templates(pages, templates.find_templates(nothing)).agg(F.sum("n_removed")).first()[0] == 0


def test_a_host_with_most_pages_is_counted_map_side(spark):
    plan = templates.find_templates(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan
    assert plan.count("partial_count") >= 2


def test_article_records_without_templates(spark):
    page = "<html><body><article><p>Words of story {0}, told at length.</p><p>" + LINE + "</p></article></body></html>"
    pages = spark.createDataFrame([(str(i), f"http://www.a.org/{i}", page.format(i)) for i in range(4)], "id string, url string, html string")
    hosted = html.article_records(pages).join(pages.select(F.col("id").alias("story_id"), "url"), "story_id")
    found = templates.find_templates(hosted.withColumn("host", html.page_domain(F.col("url"))))
    got = {r["story_id"]: r for r in html.article_records(pages, page_templates=found).collect()}
    assert all(got[str(i)]["text"] == f"Words of story {i}, told at length." for i in range(4))
    assert all(LINE not in r["summary"] and r["success"] for r in got.values())
