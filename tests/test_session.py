"""Batches that Python workers get."""

import pytest
from pyspark.sql import functions as F

from coverlens.functions import html, markup, text
from coverlens.session import BATCH_BYTES, SETTINGS, batched_udf

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def large_batches(spark):
    kept = spark.conf.get(BATCH)
    yield lambda value: spark.conf.set(BATCH, value)
    spark.conf.set(BATCH, kept)


@pytest.mark.parametrize("use", [
    lambda c: text.nfkc(c), lambda c: text.normalize_quotes(c), lambda c: html.parts(c), lambda c: html.decode_references(c),
    lambda c: html.summary(c, c), lambda c: html.top_image(F.array(c)), lambda c: markup.decode_attribute(c)])
def test_text_functions_bound_the_batches(spark, large_batches, use):
    for given, left in (("256m", BATCH_BYTES), ("268435456b", BATCH_BYTES), (str(2**28), BATCH_BYTES), ("1m", "1m")):
        large_batches(given)
        use(F.col("v"))
        assert spark.conf.get(BATCH) == str(left)
    assert SETTINGS[BATCH] == str(BATCH_BYTES)


def test_no_batch_holds_a_whole_task(spark, large_batches):
    large_batches("256m")
    size = batched_udf("int")(lambda v: v.map(lambda _: int(v.str.len().sum())))
    rows = spark.range(2000, numPartitions=1).select(F.repeat(F.lit("x"), 10_000).alias("v"))
    assert rows.select(F.max(size(F.col("v")))).first()[0] < 1.1 * BATCH_BYTES < 2000 * 10_000


def test_nfkc_keeps_no_batch(spark):
    rows = spark.createDataFrame([("é",), (None,), ("a",), ("ﬁ",), ("",)], "v string")
    assert [r[0] for r in rows.select(text.nfkc(F.col("v"))).collect()] == ["\xe9", None, "a", "fi", ""]
