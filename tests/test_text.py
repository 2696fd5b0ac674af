import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coverlens.functions import sql_functions, text

V = F.col("v")


def test_sentences_end_at_marks_followed_by_space(column):
    got = column(["One. Two! Three? Four", "Ends.", "", "   ", None], text.sentences(V))
    assert got == [["One.", "Two!", "Three?", "Four"], ["Ends."], [], [], None]


def test_dots_inside_words_titles_and_initials_do_not_end_a_sentence(column):
    got = column(["See example.org for more. Next.", "Mr. Hale met Dr. Poe. They left.",
                  "The U.S. Senate voted. J. F. Moe won.", "He got 3.5 percent. Fine."], text.sentences(V))
    assert got == [["See example.org for more.", "Next."], ["Mr. Hale met Dr. Poe.", "They left."],
                   ["The U.S. Senate voted.", "J. F. Moe won."], ["He got 3.5 percent.", "Fine."]]


def test_closing_quotes_and_blank_lines(column):
    got = column(['He said "stop." Then left.', "Headline\n\nBody text. More\n \nEnd", "wrapped\nline. x"],
                 text.sentences(V))
    assert got == [['He said "stop."', "Then left."], ["Headline", "Body text.", "More", "End"],
                   ["wrapped\nline.", "x"]]


def test_no_character_is_lost_but_white_space(spark):
    samples = ["A. B! C? d.e f", "x\n\ny. z", "Mr. A. B.C. D. end", "...!? what. “Q.” R"]
    for sample in samples:
        rows = spark.createDataFrame([(sample,)], "v string").select(F.array_join(text.sentences(V), "").alias("j"))
        squeeze = lambda s: "".join(s.split())
        assert squeeze(rows.first()["j"]) == squeeze(sample)


def test_keyword_match_ignores_dots_and_case_but_not_spaces(column):
    got = column(["WatchGroup", "watch.group", "Watch Group", "WATCHGROUP.org", "w.a.t.c.h.g.r.o.u.p"],
                 text.mentions(V, "WatchGroup"))
    assert got == [True, True, False, True, True]


def test_best_sentence(column):
    body = "Short acme. The longer acme sentence. The nicest acme sentence? No match here at all, though long."
    got = column([body, "According to Acme.org, it rose. Yes.", "A.c.m.e spoke.", "ACME", "none", "", None],
                 text.best_sentence(V, "acme"))
    # equal lengths keep the first; no match gives ''
    assert got == ["The longer acme sentence.", "According to Acme.org, it rose.", "A.c.m.e spoke.", "ACME", "", "", ""]
    assert column(["Aa acme one. Bb acme two. Cc acme six."], text.best_sentence(V, "acme")) == ["Aa acme one."]


def test_longest_is_measured_before_quotes_are_normalised(column):
    # the ligature counts one character here, though it becomes two later
    got = column(["acme ﬁﬁﬁ. acme abcd."], text.best_sentence(V, "acme"))
    assert got == ["acme abcd."]


def test_keyword_sentences_of_text_without_mention_is_empty(column):
    assert column(["One. Two.", "One acme. Two."], text.keyword_sentences(V, "acme")) == [[], ["One acme."]]


def test_match_across_a_boundary_is_no_match(column):
    # the text as a whole, without dots, contains the keyword only with a blank
    assert column(["It was ac. me too"], text.best_sentence(V, "acme")) == [""]


def test_normalize_quotes(column):
    given = ["“Hi” ‘you’", "it’s… ﬁne", "  plain  ", None, "", "\xa0pad ", "é"]
    assert column(given, text.normalize_quotes(V)) == ['"Hi" \'you\'', "it's... fine", "plain", None, "", "pad", "\xe9"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00"), max_size=20), min_size=1, max_size=20))
def test_normalize_quotes_matches_the_definition(values):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    got = [r["o"] for r in df.select("i", text.normalize_quotes(V).alias("o")).orderBy("i").collect()]
    table = str.maketrans(text.CURLY_QUOTES, text.STRAIGHT_QUOTES)
    assert got == [unicodedata.normalize("NFKC", v).translate(table).strip() for v in values]


BYLINES = [".Wp-Block-Co Authors", "Ann Lee, .Wp-Block, .Wp-X", "Ann Lee", "", None, "Ann .Wp-Block", "Ann, Bo"]
CLEANED = ["", "Ann Lee", "Ann Lee", "", None, "Ann .Wp-Block", "Ann, Bo"]


def test_clean_byline(column):
    assert column(BYLINES, text.clean_byline(V)) == CLEANED


def test_clean_byline_as_sql_function(spark, column):
    sql_functions.register(spark)
    assert column(BYLINES, F.expr("clean_byline(v)")) == CLEANED
    assert column(["https://User@WWW.Ex.org:80/a", "ftp://m.x.net?q", "nothing"], F.expr("page_domain(v)")) == ["ex.org", "m.x.net", ""]
    assert column([0, 1, 11, 22, 113], F.expr("ordinal_suffix(v)"), "bigint") == ["", "st", "th", "nd", "th"]


def test_highlight_and_terms(column):
    assert column(["an ACME and acme", "x"], text.highlight(V, "acme", "Ac$me")) == ["an <b>Ac$me</b> and <b>Ac$me</b>", "x"]
    assert column(["a+b here", "aab"], text.highlight(V, "a+b")) == ["<b>a+b</b> here", "aab"]
    assert column(["An ACME", "b", "other corp"], text.search_terms(V, ["acme", "Corp"])) == [True, False, True]


def test_a_long_text_does_not_overflow(column):
    long = "word " * 400_000 + "acme. " + "x" * 500_000 + ". tail"
    got = column([long], text.best_sentence(V, "acme"))
    assert got[0].endswith("acme.") and len(got[0]) == 5 * 400_000 + 5
