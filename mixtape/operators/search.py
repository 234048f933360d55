"""Catalog search: substring, multi-field, pandas-style contains, two tiers.

All searches are literal and case-insensitive (``regex=True`` opts into a
case-insensitive regular expression). Predicates are plain filters, so they
run inside the scan stage of the catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mixtape.functions.predicates import all_of, contains_ci

FIELDS = ("track_name", "artist_name", "album_name")


def track_name_like(catalog: DataFrame, text: str) -> DataFrame:
    return catalog.where(contains_ci("track_name", text))


def track_search(catalog: DataFrame, track_name: str = "", artist_name: str = "",
                 album_name: str = "", regex: bool = False) -> DataFrame:
    """Conjunction over the non-blank fields; all blank -> no rows."""
    terms = dict(zip(FIELDS, (track_name, artist_name, album_name)))
    preds = [contains_ci(c, t, regex) for c, t in terms.items() if t]
    if not preds:
        return catalog.limit(0)
    return catalog.where(all_of(preds))


def track_search_contains(catalog: DataFrame, track_name: str = "", artist_name: str = "",
                          album_name: str = "", regex: bool = False) -> DataFrame:
    """Per field: blank term -> true, else contains (null field -> false)."""
    terms = dict(zip(FIELDS, (track_name, artist_name, album_name)))
    preds = [F.coalesce(contains_ci(c, t, regex), F.lit(False)) for c, t in terms.items() if t]
    return catalog.where(all_of(preds))


def track_search_tiered(hot: DataFrame, full: DataFrame, track_name: str = "",
                        artist_name: str = "", album_name: str = "",
                        regex: bool = False) -> DataFrame:
    """Search ``hot`` first; only if that finds nothing, search ``full``.

    The first tier (a page of bounded size) is looked at right away; the plan of
    the result then reads one tier only.
    """
    args = (track_name, artist_name, album_name)
    first = track_search_contains(hot, *args, regex=regex)
    if not first.isEmpty():
        return first
    return track_search(full, *args, regex=regex)
