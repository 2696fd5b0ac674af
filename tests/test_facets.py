import datetime as dt
import re
import random

from pyspark.sql import functions as F

from coverlens.operators import audit, facets
from coverlens.plans import dashboard as board
from coverlens.sources import dims
from tests.conftest import plan_of

DIMS = ["a", "b", "c"]
ROWS = [(random.Random(i).choice("xyz"), random.Random(i * 7).choice(["p", "q", None]), random.Random(i * 13).randint(0, 4), i)
        for i in range(400)]


def frame(spark):
    return spark.createDataFrame(ROWS, "a string, b string, c int, id int")


def brute(selections, extra=lambda r: True):
    """Counts per dimension under the other dimensions' selections, zero keys kept."""
    out = {}
    for i, dim in enumerate(DIMS):
        for row in ROWS:
            key = (dim, None if row[i] is None else str(row[i]))
            ok = extra(row) and all(row[j] in selections[d] for j, d in enumerate(DIMS) if d != dim and selections.get(d))
            out[key] = out.get(key, 0) + ok
    return out


CASES = [{}, {"a": ["x"]}, {"a": ["x", "y"], "c": [1]}, {"a": ["x"], "b": ["p"], "c": [0, 1, 2]}, {"a": ["none such"]}, {"a": []}]


def test_crossfilter_matches_brute_force(spark):
    for selections in CASES:
        expected = brute(selections)
        for tuples_first in (True, False):
            got = facets.crossfilter(frame(spark), DIMS, selections, tuples_first=tuples_first)
            assert {(r["dim"], r["key"]): r["n"] for r in got.collect()} == expected


def test_crossfilter_extra_and_total(spark):
    selections, extra = {"a": ["x"], "b": ["p"]}, F.col("id") > 100
    got = {(r["dim"], r["key"]): r["n"] for r in facets.crossfilter(frame(spark), DIMS, selections, extra, with_total=True).collect()}
    expected = brute(selections, lambda r: r[3] > 100)
    total = sum(1 for r in ROWS if r[3] > 100 and r[0] == "x" and r[1] == "p")
    assert got == {**expected, ("total", ""): total}
    assert facets.total(frame(spark), selections, extra).first()["n"] == total
    assert facets.filter_selected(frame(spark), selections, extra).count() == total


def test_a_dimension_without_own_selection_sums_to_the_total(spark):
    selections = {"a": ["x"], "b": ["p"]}
    counts = facets.crossfilter(frame(spark), DIMS, selections).filter("dim = 'c'").agg(F.sum("n")).first()[0]
    assert counts == facets.total(frame(spark), selections).first()["n"]


def test_a_selection_that_empties_other_keys_keeps_them_with_zero(spark):
    got = {r["key"]: r["n"] for r in facets.crossfilter(frame(spark), DIMS, {"a": ["none such"]}).filter("dim = 'c'").collect()}
    assert got == {str(i): 0 for i in range(5)}


def test_top_per_facet_and_keys(spark):
    counts = facets.crossfilter(frame(spark), DIMS, {})
    tops = {"a": 2, "c": 3}
    got = {(r["dim"], r["rank"]): (r["key"], r["n"]) for r in facets.top_per_facet(counts, tops).collect()}
    for dim, n in tops.items():
        ranked = sorted(((k, v) for (d, k), v in brute({}).items() if d == dim), key=lambda kv: (-kv[1], kv[0]))[:n]
        assert [got[(dim, i + 1)] for i in range(n)] == ranked
    assert len(got) == 5
    for n in (160, 5000):  # beyond 1000 Spark limits no window before its exchange
        plan = plan_of(facets.top_per_facet(counts, {"a": n, "c": n}))
        assert re.search(r"hashpartitioning\(dim#\d+, _part#\d+", plan)
        assert "rangepartitioning" not in plan and "SinglePartition" not in plan
    keys = {r["dim"]: (r["n_keys"], r["n_bars"]) for r in facets.distinct_keys(counts, {"a": 2, "c": 100}).collect()}
    assert keys == {"a": (3, 2), "c": (5, 5)}
    top = facets.top_facet(facets.facet_sum(frame(spark), "a"), 2).collect()
    assert len(top) == 2 and top[0]["n"] >= top[1]["n"]
    assert facets.facet_sum(frame(spark), "a", F.col("id")).agg(F.sum("n")).first()[0] == sum(r[3] for r in ROWS)


def test_newest_is_a_bounded_sort(spark, tmp_path):
    days = [(i, dt.date(2024, 1, 1) + dt.timedelta(days=i % 7), "x" if i % 2 else "y") for i in range(100)]
    spark.createDataFrame(days, "id int, d date, k string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = facets.newest(df, {"k": ["x"]}, "d", "id", 5)
    assert [r["id"] for r in got.collect()] == [r[0] for r in sorted((r for r in days if r[2] == "x"), key=lambda r: (-r[1].toordinal(), r[0]))[:5]]
    plan = plan_of(got)
    assert "TakeOrderedAndProject" in plan and "PushedFilters" in plan and "EqualTo(k,x)" in plan


def test_outcome_and_nested(spark):
    got = {r["a"]: (r["n_ok"], r["n_failed"]) for r in facets.outcome_rate(frame(spark), F.col("id") < 100, "a").collect()}
    assert sum(ok for ok, _ in got.values()) == 100 and sum(f for _, f in got.values()) == 300
    nested = facets.nested_groups(frame(spark), ["a", "b"])
    assert nested.agg(F.sum("n")).first()[0] == 400 and nested.count() == len({(r[0], r[1]) for r in ROWS})


# --- dashboard ------------------------------------------------------------------------

VIEW = [  # id, date, title, outlet, type, state, bias, sentence
    ("1", "2024-01-01", "", "A", "Blog", "Ohio", "Left", "acme x"), ("2", "2024-01-03", "T2", "A", "Blog", "Ohio", "Left", "y ACME"),
    ("3", "2024-01-02", "T3", "B", "Other", "National", "Mixed", ""), ("4", "2024-01-03", "T4", "C", "Other", "Ohio", "Right", "z"),
]


def view(spark):
    df = spark.createDataFrame(VIEW, "id string, d string, title string, media_outlet string, media_outlet_type string, "
                                     "state string, bias_rating string, sentence string")
    return df.select("*", F.to_date("d").alias("publish_date"), F.lit("Ann").alias("authors"), F.col("id").alias("url")).drop("d")


def test_dashboard(spark):
    shown = board.dashboard(view(spark), {"state": ["Ohio"]})
    counts = {(r["dim"], r["key"]): r["n"] for r in shown.facets.collect()}
    assert counts[("total", "")] == 3
    assert counts[("media_outlet", "A")] == 2 and counts[("media_outlet", "B")] == 0
    assert counts[("state", "National")] == 1 and counts[("state", "Ohio")] == 3
    assert [r["id"] for r in shown.newest.collect()] == ["2", "4", "1"]
    extra = board.between(dt.date(2024, 1, 1), dt.date(2024, 1, 2)) & board.mentions("Acme")
    filtered = board.dashboard(view(spark), {}, extra=extra)
    assert [r["id"] for r in filtered.newest.collect()] == ["1"]
    assert {r["n"] for r in filtered.facets.filter("dim = 'total'").collect()} == {1}


def test_reports(spark):
    shown = board.dashboard(view(spark), {})
    facet = {(r["dim"], r["label"]): (r["color"], r["title"], r["short_n"]) for r in board.facet_report(shown, view(spark)).collect()}
    assert facet[("media_outlet", "A  (2)")] == ("#6699FF", "Media Outlet", "2")
    assert facet[("media_outlet", "B  (1)")][0] == "#c6dbef"  # a bias without a colour
    assert facet[("bias_rating", "Mixed  (1)")][0] == "#c6dbef" and facet[("bias_rating", "Right  (1)")][0] == "#FF6666"
    assert facet[("state", "Ohio  (3)")] == ("#c6dbef", "State/Country", "3")
    stories = {r["id"]: r for r in board.story_report(shown, "Acme").collect()}
    assert stories["1"]["title"] == "Link to story" and stories["1"]["excerpt"] == "<b>Acme</b> x"
    assert stories["2"]["excerpt"] == "y <b>Acme</b>" and stories["2"]["shown_date"] == "January 3, 2024"
    assert stories["3"]["bias_color"] == "#333"


# --- audits ---------------------------------------------------------------------------

def test_audits(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "b")], "k int, v string")
    assert [tuple(r) for r in audit.duplicates(df, ["k"]).collect()] == [(1, 2)]
    assert {r["column_name"]: (r["n_null"], r["n_rows"]) for r in audit.nulls(df, ["k", "v"]).collect()} == {"k": (1, 4), "v": (1, 4)}
    dim = spark.createDataFrame([(2,)], "id int")
    report = audit.foreign_keys([("k", df, "k", dim, "id"), ("none", df.filter("k = 2"), "k", dim, "id")])
    assert {tuple(r) for r in report.collect()} == {("k", 1, 2), ("none", 0, 0)}


def test_lost_and_unmatched(spark):
    staged = spark.createDataFrame([("A", "a.com", "Blog", "Ohio", "Left", True), ("B", "b.com", "Trade", "Atlantis", "Left", True),
                                    ("C", "c.com", "Blog", "Ohio", None, True)],
                                   "name string, domain_name string, media_outlet_type string, state string, bias string, active boolean")
    assert {(r["name"], r["reason"]) for r in audit.lost_in_lookup(staged).collect()} == {("B", "media_outlet_type, state"), ("C", "bias")}
    stories = spark.createDataFrame([("a.com",), ("x.com",), ("x.com",), (None,)], "media_url string")
    got = audit.unmatched_domains(stories, dims.outlet_dimension(spark, staged))
    assert {tuple(r) for r in got.collect()} == {("x.com", 2), (None, 1)}


# --- facet state and nesting ------------------------------------------------------------

def test_facet_state_equals_one_scan(spark):
    from coverlens.operators import facet_state
    from coverlens.session import work_path
    from coverlens.sources import files

    rows, path = frame(spark), work_path(spark, "state")
    dims_of = lambda f: f.select(*DIMS)
    state = lambda: facet_state.read(spark, path, dims_of(rows).schema)
    assert state().count() == 0 and facet_state.latest(spark, path) is None
    facet_state.add(dims_of(rows.filter("id < 100")), None, path, "1")
    wrong = rows.filter("id BETWEEN 100 AND 200").withColumn("a", F.lit("only wrong"))
    facet_state.add(dims_of(wrong), None, path, "2")
    for _ in range(2):  # made again: counts once
        facet_state.add(dims_of(rows.filter("id >= 100")), dims_of(wrong), path, "3")
    facet_state.add(dims_of(rows), None, path, "4")
    files.remove(spark, f"{path}/change=4/_SUCCESS")  # stopped while it was written
    assert facet_state.latest(spark, path) == "3"
    for selections in CASES:
        expected = {**brute(selections), ("total", ""): facets.total(rows, selections).first()["n"]}
        for tuples_first in (True, False):
            got = facets.crossfilter(state(), DIMS, selections, with_total=True, weight="n", tuples_first=tuples_first)
            assert {(r["dim"], r["key"]): r["n"] for r in got.collect()} == expected
    files.remove(spark, f"{path}/change=4")
    before = sorted(map(str, state().collect()))
    facet_state.compact(spark, path, dims_of(rows).schema)
    assert sorted(map(str, state().collect())) == before and files.folders(spark, path) == ["change=3"]


def test_nested_tree(spark):
    rows = frame(spark)
    got = facets.nested_tree(rows, DIMS, ["id"], [F.desc("id")], 2).collect()
    by = lambda i: sorted({r[i] for r in ROWS}, key=lambda v: (v is not None, v))
    seen = {r["a"]: r for r in got}
    for a in by(0):
        mine = [r for r in ROWS if r[0] == a]
        assert seen[a]["n"] == len(mine) and [c["b"] for c in seen[a]["children"]] == [b for b in by(1) if any(r[1] == b for r in mine)]
        for middle in seen[a]["children"]:
            assert middle["n"] == sum(r[1] == middle["b"] for r in mine)
            for inner in middle["children"]:
                ids = sorted((r[3] for r in mine if r[1] == middle["b"] and r[2] == inner["c"]), reverse=True)
                assert (inner["n"], [m["id"] for m in inner["members"]]) == (len(ids), ids[:2])
    assert facets.nested_tree(rows.limit(0), DIMS, ["id"], [F.desc("id")], 2).collect() == []
