"""The dashboard: linked facets, the filtered total and the newest stories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverlens.functions import display, text
from coverlens.operators import facet_state
from coverlens.operators import facets as fc

# --- Fixed values: facet -> (title, number of bars), newest rows ---------------------
FACETS = {
    "media_outlet": ("Media Outlet", 160),
    "bias_rating": ("Political Orientation", 6),
    "media_outlet_type": ("Media Type", 9),
    "state": ("State/Country", 100),
}
NEWEST = 60
# --- end of fixed values -------------------------------------------------------------


class Dashboard(NamedTuple):
    facets: DataFrame   # dim, key, n, rank; dim "total" holds the filtered total
    newest: DataFrame   # the newest selected rows


def dashboard(view: DataFrame, selections: Mapping[str, Sequence] | None = None,
              tops: Mapping[str, int] | None = None, newest: int = NEWEST,
              extra: Column | None = None) -> Dashboard:
    """All parts for one set of selections over a web view or its export.

    Facets and total need one scan of the facet columns, the list one scan with
    the selections pushed down; neither caches or sorts the table.  ``extra`` adds
    a predicate outside the facets, such as a keyword or a date range.
    """
    return _shown(view, view, selections, tops, newest, extra)


def dashboard_of_state(counted: DataFrame, view: DataFrame, selections: Mapping[str, Sequence] | None = None,
                       tops: Mapping[str, int] | None = None, newest: int = NEWEST) -> Dashboard:
    """``dashboard`` with the facets and the total from a facet state (``facet_state.read``): a click reads counts of
    combinations, not rows.  Only the list reads the view."""
    return _shown(counted, view, selections, tops, newest, weight=facet_state.COUNT)


def _shown(counted: DataFrame, view: DataFrame, selections: Mapping[str, Sequence] | None, tops: Mapping[str, int] | None,
           newest: int, extra: Column | None = None, weight: str | None = None) -> Dashboard:
    chosen = selections or {}
    tops = tops or {dim: n for dim, (_, n) in FACETS.items()}
    counts = fc.crossfilter(counted, list(tops), chosen, extra, with_total=True, weight=weight)
    return Dashboard(
        facets=fc.top_per_facet(counts, {**tops, fc.TOTAL: 1}),
        newest=fc.newest(view, chosen, "publish_date", "id", newest, extra),
    )


def between(start, end, date: str = "publish_date") -> Column:
    """Date filter for ``extra``, inclusive."""
    return F.col(date).between(F.lit(start), F.lit(end))


def mentions(keyword: str) -> Column:
    """Keyword filter for ``extra``, on title and sentence."""
    return text.search_terms(F.concat_ws(" ", "title", "sentence"), [keyword])


def outlet_colors(view: DataFrame) -> DataFrame:
    """Bar colour per outlet, from the bias of its first story (by date, id)."""
    color = display.bias_color(F.col("bias_rating"))
    return view.groupBy("media_outlet").agg(
        F.min_by(color, F.struct("publish_date", "id")).alias("color"))


def facet_report(board: Dashboard, view: DataFrame) -> DataFrame:
    """Facet rows ready for display: title, label, colour, short count.

    At most the facets' display limits in rows, so the colours join a small frame."""
    colors = outlet_colors(view).select(F.lit("media_outlet").alias("dim"),
                                        F.col("media_outlet").alias("key"), "color")
    titles = {dim: title for dim, (title, _) in FACETS.items()}
    color = (F.when(F.col("dim") == "bias_rating", display.bias_color(F.col("key")))
             .otherwise(F.coalesce("color", F.lit(display.DEFAULT_BAR_COLOR))))
    return board.facets.filter(F.col("dim") != fc.TOTAL).join(colors, ["dim", "key"], "left").select(
        "dim", "rank", display.lookup_value(F.col("dim"), titles, "").alias("title"),
        display.facet_label(F.col("key"), F.col("n")).alias("label"), color.alias("color"),
        display.nice_big_number(F.col("n")).alias("short_n"))


def story_report(board: Dashboard, keyword: str) -> DataFrame:
    """The newest stories ready for display."""
    return board.newest.select(
        "id", "url", "media_outlet", display.format_date(F.col("publish_date")).alias("shown_date"),
        "authors", "bias_rating",
        display.bias_color(F.col("bias_rating"), display.DEFAULT_TEXT_COLOR).alias("bias_color"),
        display.title_or_default(F.col("title")).alias("title"),
        text.highlight(F.col("sentence"), keyword).alias("excerpt"))
