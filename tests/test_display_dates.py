import datetime as dt

from pyspark.sql import functions as F

from coverlens.functions import dates, display

V = F.col("v")


def test_parse_date(column):
    given = ["2024-02-15 14:30:00", "2024-02-15", "2024-2-5", "2/15/2024", "2/15/24", "2/15/75", "2/15/69", "2/15/68",
             "2024-02-30", "13/1/2024", "2024-02-15 14:30", "2024-02-15 14:30:60", "2024-02-15T10:00:00", "15.2.2024", "junk", "", None]
    day = dt.datetime
    assert column(given, dates.parse_date(V)) == [
        day(2024, 2, 15, 14, 30), day(2024, 2, 15), day(2024, 2, 5), day(2024, 2, 15), day(2024, 2, 15), day(1975, 2, 15),
        day(1969, 2, 15), day(2068, 2, 15), None, None, None, None, None, None, None, None, None]


def test_parse_date_has_no_zone(spark, column):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # an hour that daylight saving skips
        assert column(["2024-03-10 02:30:00"], dates.parse_date(V)) == [dt.datetime(2024, 3, 10, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_normalize_and_defaults(spark, column):
    assert column([dt.date(2024, 5, 1), None], dates.normalize_timestamp(V), "date") == [dt.datetime(2024, 5, 1), None]
    moment = dt.datetime(2024, 5, 1, 3, 4, 5)
    assert column([moment], dates.normalize_timestamp(V), "timestamp_ntz") == [moment]
    assert column(["junk", "2024-05-01"], dates.normalize_timestamp(V)) == [None, dt.datetime(2024, 5, 1)]
    assert column(["2024-01-02", None, "x"], dates.publish_day(V)) == [dt.date(2024, 1, 2)] + [dt.date(2000, 1, 1)] * 2
    assert spark.range(1).select(dates.run_timestamp(moment).alias("t")).first()["t"] == moment
    assert spark.range(1).select(dates.run_timestamp().alias("t")).first()["t"] is not None


def test_format_date(column):
    days = [dt.date(2022, 1, 1), dt.date(2024, 12, 25), None]
    assert column(days, display.format_date(V), "date") == ["January 1, 2022", "December 25, 2024", None]
    assert column(days, display.format_date(V, weekday=True), "date") == [
        "Saturday, January 1, 2022", "Wednesday, December 25, 2024", None]


def test_clock_commas_label(column):
    assert column([0, 59, 60, 3661, 36000, 360000], display.seconds_to_clock(V), "bigint") == [
        "0:00:00", "0:00:59", "0:01:00", "1:01:01", "10:00:00", "100:00:00"]
    assert column([0, 999, 1000, 123456789, -1234], display.add_commas(V), "bigint") == [
        "0", "999", "1,000", "123,456,789", "-1,234"]
    assert column(["Ohio"], display.facet_label(V, F.lit(1234))) == ["Ohio  (1,234)"]


def test_nice_big_number(column):
    given = [0.0, 7.0, 42.0, 999.0, 999.5, 1000.0, 1500.0, 12345.0, 99960.0, 123456.0, 999999.0, 1_500_000.0, 1_234_600_000.0,
             -1500.0, 0.5, 0.01234, 12.345, 100.25, 9.996, 0.00012345, 0.00000123456, 1.5e-7, 10.0, 20.04]
    assert column(given, display.nice_big_number(V), "double") == [
        "0", "7", "42", "999", "999", "1K", "1.5K", "12.3K", "100K", "123K", "1000K", "1.5M", "1.23B", "-1.5K", "0.5", "0.0123",
        "12.3", "100.25", "10", "0.000123", "0.00000123", "1.50e-7", "10", "20"]


def test_ordinal_suffix(column):
    given = [0, 1, 2, 3, 4, 11, 12, 13, 21, 22, 101, 111, 112, 113, 1003, -1, -11]
    assert column(given, display.ordinal_suffix(V), "int") == [
        "", "st", "nd", "rd", "th", "th", "th", "th", "st", "nd", "st", "th", "th", "th", "rd", "th", "th"]


def test_slugify(column):
    given = ["Hello  World", "--A_b! c--", "Übung & more", "a--b", "", "  x "]
    assert column(given, display.slugify(V)) == ["hello-world", "a_b-c", "bung-more", "a-b", "", "x"]
    assert column(["x"], display.slugify_list(F.array(F.lit("Big Red"), F.lit("Dog!")))) == ["big-red-dog"]


def test_lookups_and_rates(column):
    assert column(["Left", "Mixed", "Unspecified", None], display.bias_color(V)) == ["#6699FF", "#c6dbef", "#c6dbef", "#c6dbef"]
    assert column(["Green", "Other"], display.party_color(V)) == ["green", "black"]
    assert column(["", "T"], display.title_or_default(V)) == ["Link to story", "T"]
    assert column([30, 0], display.per_minute(F.lit(10), V), "int") == [20.0, None]
    assert column([4, 0], display.percent(F.lit(1), V), "int") == [25.0, None]


def test_run_timestamp_does_not_shift_with_the_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        shown = spark.range(1).select(dates.run_timestamp(dt.datetime(2024, 6, 1, 12, 0, 0)).cast("string").alias("t")).first()["t"]
        assert shown == "2024-06-01 12:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
