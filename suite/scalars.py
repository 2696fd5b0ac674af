"""Scalar display functions and the report table."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverlens.functions import dates, display
from coverlens.plans import dashboard as board
from suite import star
from suite.composites import BOARD_SELECTIONS, SQL_BOARD, SQL_NEWEST
from suite.registry import query, table


def orders(spark, sf):
    return table(spark, sf, "orders")


@query("fn_parse_date_multi", """
SELECT o_orderkey, coalesce(try_strptime(s, '%Y-%m-%d %H:%M:%S'), try_strptime(s, '%Y-%m-%d'), CASE
  WHEN regexp_matches(s, '/[0-9]{4}$') THEN try_strptime(s, '%m/%d/%Y') ELSE try_strptime(s, '%m/%d/%y') END) AS parsed
FROM (SELECT o_orderkey, CASE o_orderkey % 8
  WHEN 0 THEN strftime(o_orderdate + to_seconds(o_custkey), '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(o_orderdate, '%Y-%-m-%-d')
  WHEN 2 THEN strftime(o_orderdate, '%-m/%-d/%Y') WHEN 3 THEN strftime(o_orderdate, '%m/%d/%y')
  WHEN 4 THEN o_orderpriority WHEN 5 THEN '' WHEN 6 THEN strftime(o_orderdate, '%Y-02-30') END AS s FROM orders)""")
def fn_parse_date_multi(spark, sf):
    kind, day = F.col("o_orderkey") % 8, F.to_date("o_orderdate")
    given = (F.when(kind == 0, F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_custkey)").cast("string"))
             .when(kind == 1, F.date_format(day, "yyyy-M-d")).when(kind == 2, F.date_format(day, "M/d/yyyy"))
             .when(kind == 3, F.date_format(day, "MM/dd/yy")).when(kind == 4, F.col("o_orderpriority"))
             .when(kind == 5, "").when(kind == 6, F.date_format(day, "yyyy-02-30")))
    return orders(spark, sf).select("o_orderkey", dates.parse_date(given).alias("parsed"))


@query("fn_normalize_timestamp", """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_orderdate + to_seconds(o_custkey) WHEN 1 THEN date_trunc('day', o_orderdate) END AS ts
FROM orders""")
def fn_normalize_timestamp(spark, sf):
    kind = F.col("o_orderkey") % 3
    moment = F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_custkey)")
    return orders(spark, sf).select("o_orderkey", F.when(kind == 0, dates.normalize_timestamp(moment)).when(
        kind == 1, dates.normalize_timestamp(F.to_date("o_orderdate"))).otherwise(
        dates.normalize_timestamp(F.col("o_orderpriority"))).alias("ts"))


@query("fn_now_defaults", star.with_sql(f"""
SELECT id, {star.SQL_TS} AS edit_time, coalesce(publish_date::DATE, DATE '2000-01-01') AS publish_date FROM feed""", star.SQL_FEED))
def fn_now_defaults(spark, sf):
    return star.feed(spark, sf).select("id", dates.run_timestamp(star.RUN_TS).alias("edit_time"),
                                       dates.publish_day(F.col("publish_date")).alias("publish_date"))


@query("fn_format_date", """
SELECT o_orderkey, strftime(o_orderdate, '%B %-d, %Y') AS short, strftime(o_orderdate, '%A, %B %-d, %Y') AS long FROM orders""")
def fn_format_date(spark, sf):
    return orders(spark, sf).select("o_orderkey", display.format_date(F.col("o_orderdate")).alias("short"),
                                    display.format_date(F.col("o_orderdate"), weekday=True).alias("long"))


@query("fn_seconds_to_clock", """
SELECT l_partkey, l_orderkey, count(*) AS n, (l_partkey * 7 + l_orderkey) // 3600 || ':' || lpad(((l_partkey * 7 + l_orderkey) % 3600 // 60)::VARCHAR, 2, '0')
  || ':' || lpad(((l_partkey * 7 + l_orderkey) % 60)::VARCHAR, 2, '0') AS clock FROM lineitem GROUP BY l_partkey, l_orderkey""")
def fn_seconds_to_clock(spark, sf):
    pairs = table(spark, sf, "lineitem").groupBy("l_partkey", "l_orderkey").agg(F.count("*").alias("n"))
    return pairs.withColumn("clock", display.seconds_to_clock(F.col("l_partkey") * 7 + F.col("l_orderkey")))


@query("fn_add_commas", "SELECT o_orderkey, format('{:,}', round(o_totalprice)::BIGINT * 1000 + o_orderkey) AS shown FROM orders")
def fn_add_commas(spark, sf):
    number = F.round("o_totalprice").cast("bigint") * 1000 + F.col("o_orderkey")
    return orders(spark, sf).select("o_orderkey", display.add_commas(number).alias("shown"))


SQL_DIGITS = "regexp_replace(round({0}::DECIMAL(30, 12), {1})::DECIMAL(30, {1})::VARCHAR, '\\.?0+$', '')"
SQL_SCALED = ("CASE WHEN {0} >= 99.95 THEN round({0}::DECIMAL(30, 12), 0)::BIGINT::VARCHAR WHEN {0} >= 10 THEN "
              + SQL_DIGITS.format("{0}", 1) + " ELSE " + SQL_DIGITS.format("{0}", 2) + " END")


@query("fn_nice_big_number", f"""
SELECT o_orderkey, CASE WHEN sz >= 1e9 THEN sgn || {SQL_SCALED.format('(sz / 1e9)')} || 'B'
  WHEN sz >= 1e6 THEN sgn || {SQL_SCALED.format('(sz / 1e6)')} || 'M' WHEN sz >= 1e3 THEN sgn || {SQL_SCALED.format('(sz / 1e3)')} || 'K'
  WHEN sz = 0 THEN '0' ELSE sgn || sz::BIGINT::VARCHAR END AS shown
FROM (SELECT o_orderkey, abs(v) AS sz, CASE WHEN v < 0 THEN '-' ELSE '' END AS sgn FROM (
  SELECT o_orderkey, (CASE o_orderkey % 5 WHEN 0 THEN o_custkey WHEN 1 THEN round(o_totalprice) * 1000 + o_custkey
    WHEN 2 THEN -round(o_totalprice) WHEN 3 THEN round(o_totalprice) * 10000 ELSE round(o_totalprice) END)::DOUBLE AS v FROM orders))""")
def fn_nice_big_number(spark, sf):
    kind, price = F.col("o_orderkey") % 5, F.round("o_totalprice")
    value = (F.when(kind == 0, F.col("o_custkey").cast("double")).when(kind == 1, price * 1000 + F.col("o_custkey"))
             .when(kind == 2, -price).when(kind == 3, price * 10000).otherwise(price))
    return orders(spark, sf).select("o_orderkey", display.nice_big_number(value).alias("shown"))


@query("fn_ordinal_suffix", """
SELECT o_orderkey, CASE WHEN o_orderkey = 0 THEN '' WHEN o_orderkey % 100 BETWEEN 11 AND 13 THEN 'th'
  ELSE CASE o_orderkey % 10 WHEN 1 THEN 'st' WHEN 2 THEN 'nd' WHEN 3 THEN 'rd' ELSE 'th' END END AS suffix FROM orders""")
def fn_ordinal_suffix(spark, sf):
    return orders(spark, sf).select("o_orderkey", display.ordinal_suffix(F.col("o_orderkey")).alias("suffix"))


@query("fn_slugify", """
SELECT p_partkey, replace(lower(p_name), ' ', '-') AS slug,
  replace(lower(p_name), ' ', '-') || '-' || replace(replace(lower(p_brand), '#', ''), ' ', '-') AS joined FROM part""")
def fn_slugify(spark, sf):
    odd = F.concat(F.lit("--"), F.col("p_name"), F.lit(" -!- "))
    return table(spark, sf, "part").select(
        "p_partkey", display.slugify(odd).alias("slug"),
        display.slugify_list(F.array("p_name", "p_brand")).alias("joined"))


SQL_COLOR = ("CASE {0} " + " ".join(f"WHEN '{bias}' THEN '{color}'" for bias, color in display.BIAS_COLORS.items())
             + " ELSE '{1}' END")


@query("fn_map_lookup", star.outlet_sql(f"""
SELECT o.name, {SQL_COLOR.format('b.name', display.DEFAULT_BAR_COLOR)} AS color,
  CASE b.name WHEN 'Left' THEN 'blue' WHEN 'Center Right' THEN 'red' ELSE 'black' END AS party_color
FROM outlet o JOIN bias_dim b ON b.id = o.bias_rating_id"""))
def fn_map_lookup(spark, sf):
    from coverlens.plans.story import outlet_view

    party = F.when(F.col("bias_rating") == "Left", "Democrat").when(F.col("bias_rating") == "Center Right", "Republican").otherwise("None")
    return outlet_view(star.outlets(spark, sf)).select(
        "name", display.bias_color(F.col("bias_rating")).alias("color"), display.party_color(party).alias("party_color"))


@query("fn_facet_label", "SELECT o_custkey, o_custkey || '  (' || format('{:,}', sum(o_orderkey)::BIGINT) || ')' AS label FROM orders GROUP BY 1")
def fn_facet_label(spark, sf):
    sums = orders(spark, sf).groupBy("o_custkey").agg(F.sum("o_orderkey").alias("n"))
    return sums.select("o_custkey", display.facet_label(F.col("o_custkey").cast("string"), F.col("n")).alias("label"))


@query("fn_rate_per_minute", """
SELECT event_type, round(count(*) * 60.0::DOUBLE / date_diff('second', min(ts), max(ts)), 6) AS per_minute,
  round(100.0::DOUBLE * count(*) FILTER (WHERE value > 10) / count(*), 6) AS pct FROM events GROUP BY 1""")
def fn_rate_per_minute(spark, sf):
    grouped = table(spark, sf, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_if(F.col("value") > 10).alias("ok"),
        F.expr("timestampdiff(SECOND, date_trunc('second', min(ts)), date_trunc('second', max(ts)))").alias("s"))
    return grouped.select("event_type", F.round(display.per_minute(F.col("n"), F.col("s")), 6).alias("per_minute"),
                          F.round(display.percent(F.col("ok"), F.col("n")), 6).alias("pct"))




@query("report_display_table", star.web_sql(f"""
SELECT 'facet' AS part, f.dim AS grp, f.rank::BIGINT AS rank, f.key || '  (' || format('{{:,}}', f.n) || ')' AS label,
  CASE WHEN f.dim = 'bias_rating' THEN {SQL_COLOR.format('f.key', '#c6dbef')} WHEN f.dim = 'media_outlet' THEN c.color ELSE '#c6dbef' END AS color
FROM ({SQL_BOARD}) f LEFT JOIN (SELECT media_outlet, first({SQL_COLOR.format('bias_rating', '#c6dbef')} ORDER BY publish_date, id) AS color
  FROM web GROUP BY 1) c ON c.media_outlet = f.key WHERE f.dim <> 'total'
UNION ALL
SELECT 'story', media_outlet, row_number() OVER (ORDER BY publish_date DESC, id), strftime(publish_date, '%B %-d, %Y') || ': '
  || CASE WHEN title = '' THEN 'Link to story' ELSE title END || ': ' || regexp_replace(sentence, 'returned', '<b>Returned</b>', 'gi'), {SQL_COLOR.format('bias_rating', '#333')}
FROM ({SQL_NEWEST})"""))
def report_display_table(spark, sf):
    from pyspark.sql import Window

    view = star.written_view(spark, sf)
    shown = board.dashboard(view, BOARD_SELECTIONS)
    facets = board.facet_report(shown, view).select(
        F.lit("facet").alias("part"), F.col("dim").alias("grp"), F.col("rank").cast("bigint").alias("rank"), "label", "color")
    # at most 60 rows: the newest-stories list
    newest = shown.newest.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("publish_date"), "id")))
    stories = board.story_report(shown._replace(newest=newest), "Returned").join(newest.select("id", "rank"), "id").select(
        F.lit("story").alias("part"), F.col("media_outlet").alias("grp"), F.col("rank").cast("bigint").alias("rank"),
        F.concat_ws(": ", "shown_date", "title", "excerpt").alias("label"), F.col("bias_color").alias("color"))
    return facets.unionByName(stories)
