"""Recommendations for known playlists and new baskets, in one plan per batch.

Known baskets (their id is an existing playlist) get that playlist's own
top-k; new baskets get the top-k of their nearest existing playlist. Both
sets of users are searched by one bounded top-k (``topk``) and joined back, then
ids are decoded against a one-row-per-id catalog.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, functions as F

from mixtape.functions.text import uri_list
from mixtape.operators import factors
from mixtape.operators import index as idx
from mixtape.operators.neighbors import knn_exact
from mixtape.operators.skew import join_dealt
from mixtape.session import stage

RECS_TRAINING = 5    # fixed: recommendations per playlist in training
RECS_JOB = 10        # fixed: recommendations per basket in the job
NEIGHBOURS = 1       # fixed: neighbours used per new playlist


def decode(recs: DataFrame, by_id: DataFrame, id_col: str = "track_uri_index") -> DataFrame:
    """Attach names/URI of each id from a one-row-per-id catalog (left join)."""
    return recs.join(by_id.select(id_col, "track_name", "artist_name", "track_uri"), id_col, "left")


def recommend_known(model: ALSModel, users: DataFrame, k: int = RECS_TRAINING,
                    by_id: DataFrame | None = None, user_col: str = "playlist_id") -> DataFrame:
    recs = factors.top_k(model, users.select(user_col), k, user_col)
    return decode(recs, by_id) if by_id is not None else recs


def _encode_baskets(baskets: DataFrame, index: DataFrame, basket_col: str) -> DataFrame:
    enc = idx.encode(baskets.select(basket_col, "track_uri"), index, "track_uri", "track_uri_index")
    return enc.select(basket_col, "track_uri_index")


#: A basket that has seen at most this many items is answered from its playlist's first k + SPARE.
SPARE = 16


def _unseen(model: ALSModel, route: DataFrame, k: int, basket_col: str, user_col: str, seen: DataFrame) -> DataFrame:
    """``route`` with ``_recs`` (id, score): the k best items of each basket's playlist that the basket hasn't seen.

    Of a playlist's first k + SPARE at least k remain for a basket that has seen up to
    SPARE items, so such baskets share one search of their playlist. The others are
    searched one by one and leave their tracks out inside the search."""
    held = seen.groupBy(basket_col).agg(F.collect_set("track_uri_index").alias("_seen"))
    asked = stage(route.join(held, basket_col, "left").withColumn("_seen", F.coalesce("_seen", F.array().cast("array<int>"))), "asked")
    few = asked.where(F.size("_seen") <= SPARE)
    lists = (factors.top_k(model, few.select(F.col("_src").alias(user_col)), k + SPARE, user_col)
             .groupBy(F.col(user_col).alias("_src")).agg(F.array_sort(F.collect_list(F.struct("rank", "track_uri_index", "score"))).alias("_l")))
    left = F.filter("_l", lambda x: ~F.array_contains("_seen", x["track_uri_index"]))
    shared = join_dealt(few, lists, "_src", basket_col).withColumn("_recs", F.transform(
        F.slice(left, 1, k), lambda x: F.struct(x["track_uri_index"].alias("track_uri_index"), x["score"].alias("score"))))
    alone = factors.top_k_unseen(model, asked.where(F.size("_seen") > SPARE), k, "_src", "_seen", basket_col).withColumn(
        "_recs", F.transform("recs", lambda x: F.struct(x["id"].cast("int").alias("track_uri_index"), x["score"].cast("float").alias("score"))))
    return shared.select(*route.columns, "_recs").unionByName(alone.select(*route.columns, "_recs"))


def _answer(model: ALSModel, route: DataFrame, k: int, basket_col: str, user_col: str,
            seen: DataFrame | None, by_id: DataFrame | None = None) -> DataFrame:
    """``route`` (a row per basket with ``_src``, the playlist that answers it) with its top-k,
    and with the names of ``by_id``.

    One playlist may answer most baskets, so the results of each playlist get their names
    first and are one row with an array, which baskets meet in parts (``join_dealt``).
    With ``seen`` (basket, id) rows every basket leaves its own tracks out: it gets k rows,
    whatever others have seen.
    """
    columns = [basket_col, "method", "neighbor_id", "distance"]
    if by_id is not None:
        by_id = by_id.select("track_uri_index", "track_name", "artist_name", "track_uri")
    names = by_id.columns[1:] if by_id is not None else []
    ordered = ["track_uri_index", *columns, "rank", "score", *names] if names else [*columns, "rank", "track_uri_index", "score"]
    if seen is not None:
        rows = (_unseen(model, route, k, basket_col, user_col, seen).select(*columns, F.posexplode("_recs").alias("_p", "_x"))
                .select(*columns, (F.col("_p") + 1).alias("rank"), "_x.track_uri_index", "_x.score"))
        if names:
            rows = join_dealt(stage(rows, "unseen"), by_id, "track_uri_index", basket_col, "left")
        return rows.select(*ordered)
    scored = factors.top_k(model, route.select(F.col("_src").alias(user_col)), k, user_col)
    if names:
        scored = join_dealt(stage(scored, "scored"), by_id, "track_uri_index", user_col, "left")
    lists = scored.groupBy(F.col(user_col).alias("_src")).agg(
        F.collect_list(F.struct("rank", "track_uri_index", "score", *names)).alias("_recs"))
    return join_dealt(route, lists, "_src", basket_col).select(*columns, F.inline("_recs")).select(*ordered)


def recommend_new(model: ALSModel, baskets: DataFrame, index: DataFrame, existing: DataFrame,
                  k: int = RECS_JOB, by_id: DataFrame | None = None,
                  basket_col: str = "basket_id", user_col: str = "playlist_id",
                  exclude_seen: bool = False) -> DataFrame:
    """Baskets (basket, track_uri) -> top-k of each basket's nearest playlist.
    ``existing``: distinct (playlist, track_uri_index) pairs (``user_items``)."""
    items = _encode_baskets(baskets, index, basket_col)
    near = knn_exact(items, existing, NEIGHBOURS, basket_col, user_col, existing_distinct=True)
    # one row per basket, read several times: stored once
    route = stage(near.select(basket_col, F.lit("neighbour").alias("method"), "neighbor_id", "distance",
                              F.col("neighbor_id").alias("_src")), "near")
    seen = items.where(F.col("track_uri_index").isNotNull()).distinct() if exclude_seen else None
    return _answer(model, route, k, basket_col, user_col, seen, by_id)


def route_baskets(baskets: DataFrame, index: DataFrame, existing: DataFrame,
                  basket_col: str = "basket_id", user_col: str = "playlist_id") -> DataFrame:
    """basket -> the playlist whose factors answer it: (basket, method,
    neighbor_id, distance, _src). Known ids answer for themselves; a new basket
    is answered by its nearest existing playlist (exact, by (distance, id)).
    ``existing``: distinct (playlist, track_uri_index) pairs (``user_items``)."""
    # one aggregate over the existing pairs serves both the known-id test and
    # the neighbour search (user sizes)
    sizes = (existing.where(F.col("track_uri_index").isNotNull())
             .groupBy(user_col).agg(F.count(F.lit(1)).alias("_b")))
    users = sizes.select(F.col(user_col).alias(basket_col), F.lit(True).alias("_known"))
    # both halves read the marked baskets
    marked = stage(baskets.select(basket_col, "track_uri").join(users, basket_col, "left"), "marked-baskets")
    known = marked.where(F.col("_known")).select(basket_col).distinct()
    new_baskets = marked.where(F.col("_known").isNull()).select(basket_col, "track_uri")
    items = _encode_baskets(new_baskets, index, basket_col)
    near = knn_exact(items, existing, NEIGHBOURS, basket_col, user_col,
                     existing_distinct=True, user_sizes=sizes).drop("rank")
    id_type = near.schema["neighbor_id"].dataType
    return (known.select(basket_col, F.lit("known").alias("method"),
                         F.lit(None).cast(id_type).alias("neighbor_id"),
                         F.lit(None).cast("double").alias("distance"),
                         F.col(basket_col).cast(id_type).alias("_src"))
            .unionByName(near.select(basket_col, F.lit("neighbour").alias("method"),
                                     "neighbor_id", "distance", F.col("neighbor_id").alias("_src"))))


def recommend_all(model: ALSModel, baskets: DataFrame, index: DataFrame, existing: DataFrame,
                  k: int = RECS_TRAINING, by_id: DataFrame | None = None, basket_col: str = "basket_id",
                  user_col: str = "playlist_id", exclude_seen: bool = False) -> DataFrame:
    """Route every basket: known id -> own top-k, new -> nearest playlist's top-k.

    No driver loop: one left join marks the known ids and splits the batch, one
    scoring call serves both halves. ``exclude_seen`` leaves out a basket's own
    tracks and, of a known playlist, the tracks that it already holds.
    """
    # one row per basket, read several times: stored once
    route = stage(route_baskets(baskets, index, existing, basket_col, user_col), "route")
    seen = None
    if exclude_seen:
        own = _encode_baskets(baskets, index, basket_col).where(F.col("track_uri_index").isNotNull())
        known = route.where(F.col("method") == "known").select(basket_col)
        held = existing.select(F.col(user_col).alias(basket_col), "track_uri_index").join(known, basket_col, "left_semi")
        seen = own.unionByName(held).distinct()
    return _answer(model, route, k, basket_col, user_col, seen, by_id)


def enrich(recs: DataFrame, catalog: DataFrame, basket_col: str = "basket_id") -> DataFrame:
    """Recommended URIs -> full catalog rows (every catalog row of the URI)."""
    rows = stage(recs.select(basket_col, "rank", "track_uri"), "recommended")
    return (join_dealt(rows, catalog, "track_uri", basket_col)
                .select(basket_col, "rank", "track_name", "artist_name", "album_name", "track_uri"))


def envelope(recs: DataFrame, baskets: DataFrame, basket_col: str = "basket_id",
             pos_col: str = "pos") -> DataFrame:
    """Per basket: JSON {"recommendations": [uri by rank], "input_tracks": [uri]}.

    The input tracks are the request's own list: in its order (``pos_col``, when
    there) and with its repeats. Without any recommendation the array is empty.
    Both arrays are bounded: k recommendations, and one request.
    """
    out = (recs.groupBy(basket_col)
               .agg(F.array_sort(F.collect_list(F.struct("rank", "track_uri"))).alias("_r"))
               .select(basket_col, F.transform("_r", lambda x: x["track_uri"]).alias("_recs")))
    order = [pos_col] if pos_col in baskets.columns else []
    inp = (baskets.groupBy(basket_col)
                  .agg(F.array_sort(F.collect_list(F.struct(*order, "track_uri"))).alias("_i"))
                  .select(basket_col, F.transform("_i", lambda x: x["track_uri"]).alias("input_tracks")))
    both = inp.join(out, basket_col, "left").withColumn(
        "recommendations", F.coalesce("_recs", F.array().cast("array<string>")))
    return both.select(basket_col, "recommendations", "input_tracks",
                       F.to_json(F.struct("recommendations", "input_tracks")).alias("envelope"),
                       uri_list("recommendations").alias("uri_list"))
