"""Page templates: text blocks that a host repeats on a large share of its pages.

A parser keeps what stands in the article, also "Read more on ..." and the like.  Such blocks are
found by counting: one hash per block and page, counted per host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.functions import text as _text
from coverlens.operators.lookup import lookup_left

LEAST_PAGES, LEAST_SHARE = 3, 0.5


def blocks(text: Column) -> Column:
    """The parts between blank lines, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(text, r"\n[ \t\r\f]*\n"), _text.strip), lambda b: b != "")


def find_templates(pages: DataFrame, host: str = "host", text: str = "text",
                   least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """(host, n_pages, template): per host its template blocks as sorted 64-bit hashes.

    A block is a template if it stands in at least ``least_pages`` different texts of the host and in at
    least ``least_share`` of them.  Pages with equal texts count once, so a story under several
    URLs is none.  Rows without a host or without text do not count; hosts without a template have no row.

    Texts stay where they are: hashes of blocks are shuffled, first by host and text, then summed
    map-side by host and block, so a host with a third of all pages is spread over all tasks.  A
    host's array is bounded: it holds at most (mean blocks a text / least_share) hashes.
    """
    if not 0 < least_share <= 1:
        raise ValueError("least_share lies above 0 and is at most 1")
    hashed = F.transform(F.array_distinct(blocks(F.col(text))), lambda b: F.xxhash64(b))
    given = pages.filter((F.col(host) != "") & (F.col(text) != "")).select(
        F.col(host).alias("host"), F.xxhash64(text).alias("t"), hashed.alias("hashes"))
    different = given.groupBy("host", "t").agg(F.first("hashes").alias("hashes"))
    # one more entry a text, NULL, counts the texts: both branches read the same shuffled rows
    entry = different.select("host", F.explode(F.concat("hashes", F.array(F.lit(None).cast("bigint")))).alias("hash"))
    sizes = entry.filter("hash IS NULL").groupBy("host").agg(F.count("*").alias("n_pages"))
    counted = entry.filter("hash IS NOT NULL").groupBy("host", "hash").agg(F.count("*").alias("n")).filter(F.col("n") >= least_pages)
    frequent = counted.join(sizes, "host").filter(F.col("n") >= F.col("n_pages") * least_share)
    return frequent.groupBy("host", "n_pages").agg(F.sort_array(F.collect_list("hash")).alias("template"))


def without_templates(pages: DataFrame, templates: DataFrame, host: str = "host", text: str = "text", salts: int = 1) -> DataFrame:
    """The rows with ``text`` freed of its host's template blocks, and ``n_removed``, the number of blocks that went.

    Where nothing is removed the text stays as it is, NULL included; else what is left is joined by
    blank lines ('' if all was template).  ``templates`` may be an older, stored table.  ``salts`` spreads a hot
    host where the templates are too many to broadcast.
    """
    known = templates.select(F.col("host").alias("_host"), F.col("template").alias("_template"))
    found = lookup_left(pages, known, host, "_host", salts, F.col(text))
    split = found.withColumn("_blocks", F.when(F.col("_template").isNotNull(), blocks(F.col(text))))
    kept = split.withColumn("_kept", F.filter("_blocks", lambda b: ~F.array_contains(F.col("_template"), F.xxhash64(b))))
    removed = F.coalesce(F.size("_blocks") - F.size("_kept"), F.lit(0))
    # size of NULL is -1 outside of ANSI mode; both are NULL together, so the difference is 0 there
    return (kept.withColumn("n_removed", removed)
            .withColumn(text, F.when(F.col("n_removed") > 0, F.array_join("_kept", "\n\n")).otherwise(F.col(text)))
            .select(*pages.columns, "n_removed"))
