"""Checks of learned results by SQL.

Factors, hashes and scores depend on a fit that SQL can't repeat, but what must
hold of them can be compared: who is answered, by which playlist and how many
times, whether ranks run from 1, scores don't rise and are the products of the
stored factors, and whether models and artefacts come back as they were. Each
entry takes the real rows of its operator and reduces them to such columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mixtape.operators import catalog as cat
from mixtape.operators import factors as fac
from mixtape.operators import index as idx
from mixtape.operators import multiprobe
from mixtape.operators import neighbors as nb
from mixtape.operators import recommend as rec
from mixtape.operators import search
from mixtape.operators import stored_catalog
from mixtape.operators import vectors as vec
from mixtape.operators.skew import join_dealt
from mixtape.plans import queries as q
from mixtape.plans.context import context
from mixtape.plans.oracle import HISTORY_CTES, INCREMENTAL_CTES, UI_CTES
from mixtape.plans.registry import query
from mixtape.session import scratch_path, stage
from mixtape.sources import artefacts
from mixtape.sources import models as mdl
from mixtape.sources import testview as tv

FLAGS = "true as ranks_ok, true as scores_ordered, true as dot_ok, true as decoded_ok"


def recs_facts(recs: DataFrame, model, index: DataFrame, keys: list[str], src) -> DataFrame:
    """Per answered key: how many rows, and whether ranks, scores and names are right.
    ``src`` is the playlist whose factors gave the scores."""
    lists = stage(recs.groupBy(*keys, src.cast("int").alias("_u")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "score", "track_uri_index", "track_uri"))).alias("_l")), "facts-lists")
    # one playlist may answer most keys: each list of a playlist is checked once and its result joined back in parts
    each = stage(lists.select("_u", "_l").distinct().withColumn("_n", F.monotonically_increasing_id()), "facts-distinct")
    users = model.userFactors.select(F.col("id").alias("_u"), F.col("features").alias("_uf"))
    items = model.itemFactors.select(F.col("id").alias("track_uri_index"), F.col("features").alias("_if"))
    names = index.select(F.col("id").alias("track_uri_index"), F.col("track").alias("_name"))
    rows = stage(each.select("_n", "_u", F.inline("_l")), "facts-rows")
    met = join_dealt(rows, items.join(names, "track_uri_index", "left"), "track_uri_index", "_n").join(users, "_u")
    dot = F.aggregate(F.zip_with("_uf", "_if", lambda a, b: (a * b).cast("double")), F.lit(0.0), lambda s, x: s + x)
    right = F.abs(dot - F.col("score")) <= 1e-3 * F.greatest(F.lit(1.0), F.abs("score"))
    checked = F.array_sort(F.collect_list(F.struct("rank", "score", right.alias("dot"),
                                                   F.col("track_uri").eqNullSafe(F.col("_name")).alias("name"))))
    g = met.groupBy("_n").agg(checked.alias("_r"))
    ranks = F.transform("_r", lambda x: x["rank"])
    falls = F.zip_with(F.slice("_r", 2, F.size("_r")), F.slice("_r", 1, F.size("_r") - 1),
                       lambda after, before: after["score"] <= before["score"])
    facts = g.select("_n", F.size("_r").alias("n_recs"), (ranks == F.sequence(F.lit(1), F.size("_r"))).alias("ranks_ok"),
                    F.forall(falls, lambda x: x).alias("scores_ordered"),
                    F.forall("_r", lambda x: x["dot"]).alias("dot_ok"),
                    F.forall("_r", lambda x: x["name"]).alias("decoded_ok"))
    back = each.join(facts, "_n").drop("_n")
    return join_dealt(lists, back, "_u", keys[0], also=("_l",)).select(*keys, "n_recs", "ranks_ok", "scores_ordered", "dot_ok", "decoded_ok")


@query("check_recommend_known", sql=f"""with {UI_CTES}
select distinct playlist_id, 5 as n_recs, {FLAGS} from ui""")
def q_check_recommend_known(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return recs_facts(q.q_recommend_known(spark, sf_dir), ctx.model, ctx.index, ["playlist_id"], F.col("playlist_id"))


# the route of the orders after the history, as baskets under their own ids
NEW_SQL = q.ROUTE_SQL.replace("select distinct playlist_id as basket_id, track_uri from incoming_raw\n        union ", "")


@query("check_recommend_new", sql=f"""select basket_id - {tv.ORDER_BASKET} as basket_id, method, neighbor_id, distance,
  10 as n_recs, {FLAGS} from ({NEW_SQL}) r""")
def q_check_recommend_new(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return recs_facts(q.q_recommend_new(spark, sf_dir), ctx.history_model, ctx.history_index,
                      ["basket_id", "method", "neighbor_id", "distance"], F.col("neighbor_id"))


@query("check_recommend_all", sql=f"""select basket_id, method, neighbor_id, distance, 5 as n_recs, {FLAGS}
from ({q.ROUTE_SQL}) r""")
def q_check_recommend_all(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return recs_facts(q.q_recommend_all(spark, sf_dir), ctx.history_model, ctx.history_index,
                      ["basket_id", "method", "neighbor_id", "distance"], F.coalesce("neighbor_id", "basket_id"))


@query("check_exclude_seen", sql=f"select basket_id, 5 as n_recs, true as ranks_ok, true as none_seen from ({q.ROUTE_SQL}) r")
def q_check_exclude_seen(spark, sf_dir):
    """Nothing that the basket holds, nor, for a known playlist, what it held before."""
    ctx = context(spark, sf_dir)
    baskets = tv.incoming_baskets(spark, sf_dir, since=tv.HISTORY_CUTOFF)
    recs = rec.recommend_all(ctx.history_model, baskets, ctx.history_index, ctx.history_pairs, rec.RECS_TRAINING,
                             cat.catalog_by_id(ctx.history), exclude_seen=True)
    held = ctx.history.select(F.col("playlist_id").alias("basket_id"), "track_uri").unionByName(baskets).distinct()
    met = recs.join(held.withColumn("_seen", F.lit(True)), ["basket_id", "track_uri"], "left")
    ranks = F.array_sort(F.collect_list("rank"))
    return met.groupBy("basket_id").agg(
        F.count(F.lit(1)).cast("int").alias("n_recs"),
        (ranks == F.sequence(F.lit(1), F.count(F.lit(1)).cast("int"))).alias("ranks_ok"),
        F.count("_seen").alias("_s")).select("basket_id", "n_recs", "ranks_ok", (F.col("_s") == 0).alias("none_seen"))


@query("check_recommend_enriched", sql=f"""select basket_id, 5 as n_tracks, true as named
from ({q.ROUTE_SQL}) r""")
def q_check_recommend_enriched(spark, sf_dir):
    rows = q.q_recommend_enriched(spark, sf_dir)
    named = F.col("track_name").isNotNull() & F.col("artist_name").isNotNull() & F.col("album_name").isNotNull()
    return rows.groupBy("basket_id").agg(F.countDistinct("track_uri").cast("int").alias("n_tracks"),
                                         F.min(named).alias("named"))


ENVELOPE_SQL = f"""with {HISTORY_CTES}
select basket_id - {tv.ORDER_BASKET} as basket_id, string_agg(track_uri, ',' order by track_uri) as input_tracks,
       10 as n_recs, true as list_ok
from incoming_orders group by basket_id"""


def _envelope_facts(rows: DataFrame) -> DataFrame:
    doc = F.from_json("envelope", "recommendations array<string>, input_tracks array<string>")
    return rows.withColumn("_d", doc).select(
        "basket_id", F.array_join("_d.input_tracks", ",").alias("input_tracks"),
        F.size("_d.recommendations").alias("n_recs"),
        (F.array_join("_d.recommendations", ",") == F.col("uri_list")).alias("list_ok"))


@query("check_recommend_envelope", sql=ENVELOPE_SQL)
def q_check_recommend_envelope(spark, sf_dir):
    return _envelope_facts(q.q_recommend_envelope(spark, sf_dir))


@query("check_recommend_stream", sql=ENVELOPE_SQL)
def q_check_recommend_stream(spark, sf_dir):
    return _envelope_facts(q.q_recommend_stream(spark, sf_dir))


@query("check_als_factors", sql=f"""with {UI_CTES}
select distinct cast(playlist_id as int) as id, {fac.RANK} as n_features, true as solved from pairs""")
def q_check_als_factors(spark, sf_dir):
    """Whether each playlist's factors solve their regularised normal equations (to a thousandth:
    the fit computes in single precision)."""
    ctx = context(spark, sf_dir)
    left = fac.residuals(ctx.model, ctx.pairs)
    return (q.q_als_factors(spark, sf_dir).join(left, "id", "left")
            .select("id", F.size("features").alias("n_features"), (F.col("residual") < 1e-3).alias("solved")))


@query("check_top_k", sql=f"""with {UI_CTES}
select distinct cast(playlist_id as int) as playlist_id, true as same_scores from pairs""")
def q_check_top_k(spark, sf_dir):
    """The bounded search against the product of all playlists with all tracks, by their scores."""
    ctx = context(spark, sf_dir)
    users = ctx.pairs.select("playlist_id").distinct()
    own = (fac.top_k(ctx.model, users, 5).groupBy("playlist_id")
           .agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("_own")))
    full = fac.all_products(ctx.model, users, 5)
    near = F.zip_with(F.transform("_own", lambda x: x["score"]), "scores",
                      lambda a, b: F.coalesce(F.abs(a - b) <= 1e-5 * F.greatest(F.abs(b), F.lit(1.0)), F.lit(False)))
    return own.join(full, "playlist_id").select("playlist_id", F.forall(near, lambda x: x).alias("same_scores"))


@query("check_top_k_pairs", sql=f"""with {UI_CTES}
select count(distinct playlist_id) as n_users, count(distinct track_uri_index) as n_items, true as fewer from pairs""")
def q_check_top_k_pairs(spark, sf_dir):
    """The bounded search scored under three quarters of all pairs (the more items, the fewer)."""
    ctx = context(spark, sf_dir)
    users = ctx.pairs.select("playlist_id").distinct()
    scored = fac.top_k(ctx.model, users, 5, with_scored=True).where("rank = 1")
    n_items = ctx.model.itemFactors.count()
    return scored.agg(F.count(F.lit(1)).alias("n_users"), F.lit(n_items).cast("long").alias("n_items"),
                      (4 * F.sum("scored") < 3 * F.count(F.lit(1)) * n_items).alias("fewer"))


@query("check_search_tested", sql=f"""{q.CATALOG_SQL},
t as (select unnest(['ring', 'navy ring', 'ng', 'zzzz']) as term)
select term, (select count(*) from cat) as n_rows,
       (select count(*) from cat where contains(lower(track_name), term)) as n_found, true as narrowed from t""")
def q_check_search_tested(spark, sf_dir):
    """Rows that the postings leave to test: all for a term under three characters, else not many
    more than are found (names hold few runs of a term without the term)."""
    stored = context(spark, sf_dir).stored_catalog
    rows = []
    for term in ("ring", "navy ring", "ng", "zzzz"):
        r = stored_catalog.report(stored, {"track_name": term}).first()
        exact = r["n_tested"] == r["n_rows"] if len(term) < 3 else r["n_found"] <= r["n_tested"] <= 2 * r["n_found"] + 10
        rows.append((term, r["n_rows"], r["n_found"], exact))
    return spark.createDataFrame(rows, "term string, n_rows long, n_found long, narrowed boolean")


@query("check_als_roundtrip", sql=f"""with {UI_CTES}
select distinct track_uri_index as id, true as same from pairs""")
def q_check_als_roundtrip(spark, sf_dir):
    stored = q.q_als_roundtrip(spark, sf_dir).select("id", F.col("features").alias("_f"))
    own = fac.factors(context(spark, sf_dir).model, "item")
    return stored.join(own, "id").select("id", (F.col("_f") == F.col("features")).alias("same"))


@query("check_pipeline_stage", sql=f"""with {UI_CTES}
select distinct cast(playlist_id as int) as id, true as same from pairs""")
def q_check_pipeline_stage(spark, sf_dir):
    """The model as stage 0 of a saved pipeline."""
    model = context(spark, sf_dir).model
    stored = mdl.load_pipeline_stage(mdl.save_as_pipeline(model, scratch_path(spark, "pipeline"))).userFactors
    return stored.select("id", F.col("features").alias("_f")).join(model.userFactors, "id").select(
        "id", (F.col("_f") == F.col("features")).alias("same"))


def same_hashes(hashes: DataFrame, projections: DataFrame, key: str) -> DataFrame:
    """Whether each hash value is the floor of the projection, computed by a join and a sum
    (within rounding, where a projection lies on the edge of a bucket)."""
    near = F.zip_with("hashes", "projections", lambda h, p: F.coalesce((h == F.floor(p)) | (F.abs(p - F.round(p)) < 1e-9), F.lit(False)))
    return hashes.join(projections, key, "left").select(
        key, F.size("hashes").alias("n_tables"), F.coalesce(F.forall(near, lambda x: x), F.lit(False)).alias("same"))


@query("check_lsh_hashes", sql=f"""with {UI_CTES}
select distinct playlist_id, {nb.LSH_TABLES} as n_tables, true as same from pairs""")
def q_check_lsh_hashes(spark, sf_dir):
    """The hash values of the sparse vectors, from the stored unit vectors of the model."""
    ctx = context(spark, sf_dir)
    path = mdl.save_model(ctx.lsh, scratch_path(spark, "lsh-units"))
    return same_hashes(q.q_lsh_hashes(spark, sf_dir), nb.projections(ctx.pairs, nb.unit_vectors(spark, path)), "playlist_id")


@query("check_lsh_dense_hashes", sql=f"select vec_id, {nb.LSH_TABLES} as n_tables, true as same from embeddings")
def q_check_lsh_dense_hashes(spark, sf_dir):
    """The same for dense vectors."""
    model = nb.fit_lsh(q._dense_vectors(spark, sf_dir), seed=7)
    path = mdl.save_model(model, scratch_path(spark, "lsh-units"))
    entries = tv.table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("item", "value"))
    return same_hashes(q.q_lsh_dense_hashes(spark, sf_dir),
                       nb.projections(entries, nb.unit_vectors(spark, path), id_col="vec_id", item_col="item", value_col="value"), "vec_id")


@query("check_lsh_roundtrip", sql=f"""with {UI_CTES}
select distinct playlist_id, true as same from pairs""")
def q_check_lsh_roundtrip(spark, sf_dir):
    stored = q.q_lsh_roundtrip(spark, sf_dir).withColumnRenamed("hashes", "_h")
    return stored.join(q.q_lsh_hashes(spark, sf_dir), "playlist_id").select(
        "playlist_id", (F.col("_h") == F.col("hashes")).alias("same"))


# Buckets so wide that only the side of a random plane counts, and tables so many
# that every row shares a side with the key in some: the approximate search must
# then be the exact one.
WIDE = {"bucket_length": 1e9, "num_tables": 40}


def _ranked(rows: DataFrame, digits: int) -> DataFrame:
    """(rank, distance) of a few rows; equal distances may come in any order of ids."""
    found = sorted(r["distCol"] for r in rows.collect())
    return rows.sparkSession.createDataFrame(
        [(i + 1, round(d, digits)) for i, d in enumerate(found)], "rank int, distance double")


@query("check_ann", sql=f"""with {UI_CTES},
b as (select min(l_orderkey) as basket_id from lineitem),
bk as (select distinct idx.id as item from lineitem join b on l_orderkey = basket_id
       join idx on concat('part:', cast(l_partkey as varchar)) = idx.track),
d as (select p.playlist_id, (select count(*) from bk) + count(*) - 2 * count(bk.item) as d2
      from pairs p left join bk on p.track_uri_index = bk.item group by p.playlist_id)
select cast(row_number() over (order by d2) as int) as rank, round(sqrt(d2), 4) as distance from d
order by d2 limit 3""")
def q_check_ann(spark, sf_dir):
    """The 3 nearest playlists of the basket with the smallest id, its LSH buckets so wide that all compete."""
    ctx = context(spark, sf_dir)
    baskets = tv.order_baskets(spark, sf_dir)
    one = baskets.where(F.col("basket_id") == baskets.agg(F.min("basket_id")).scalar())
    items = idx.encode(one, ctx.index).select("basket_id", "track_uri_index").where("track_uri_index is not null")
    key = vec.sparse_vectors(items, vec.vector_size(ctx.pairs), user_col="basket_id").first()["features"]
    return _ranked(nb.ann_tables(ctx.vectors, key, 3, **WIDE), 4)


@query("check_ann_dense", sql="""with k as (select embedding as key from embeddings order by vec_id limit 1),
d as (select list_distance(embedding::double[], key::double[]) as distance from embeddings, k)
select cast(row_number() over (order by distance) as int) as rank, round(distance, 3) as distance from d
order by distance limit 3""")
def q_check_ann_dense(spark, sf_dir):
    vectors = q._dense_vectors(spark, sf_dir)
    key = vectors.orderBy("vec_id").select("features").first()["features"]
    model = nb.fit_lsh(vectors, **WIDE)
    return _ranked(nb.ann_single(model, vectors, key, 3, user_col="vec_id"), 3)


@query("check_dense_summary", sql="""select vec_id, cast(len(embedding) as int) as size,
  cast(len(list_filter(embedding, lambda x: x <> 0)) as int) as n_items from embeddings""")
def q_check_dense_summary(spark, sf_dir):
    vectors = q._dense_vectors(spark, sf_dir)
    return vectors.select("vec_id", vec.vector_summary("features").alias("s")).select("vec_id", "s.size", "s.n_items")


@query("check_artefact_reuse", sql=f"""with {UI_CTES}
select distinct playlist_id, 1 as builds from ui""")
def q_check_artefact_reuse(spark, sf_dir):
    """A table asked for twice: built and stored the first time, read the second."""
    path, builds = scratch_path(spark, "users"), []

    def build():
        builds.append(1)
        return context(spark, sf_dir).interactions.select("playlist_id").distinct()

    artefacts.load_or_build_frame(spark, path, build)
    return artefacts.load_or_build_frame(spark, path, build).withColumn("builds", F.lit(len(builds)))


GUARD_TERMS = ("ring", "no such name")


@query("check_empty_guard", sql=f"{q.CATALOG_SQL} " + " union all ".join(
    f"select '{t}' as term, not exists (select 1 from cat where contains(lower(track_name), '{t}')) as is_empty"
    for t in GUARD_TERMS))
def q_check_empty_guard(spark, sf_dir):
    catalog = context(spark, sf_dir).catalog
    return spark.createDataFrame([(t, search.track_name_like(catalog, t).isEmpty()) for t in GUARD_TERMS],
                                 "term string, is_empty boolean")


@query("check_known_rows", sql=f"""with {UI_CTES}
select playlist_id, count(*) as n_known from pairs group by playlist_id""")
def q_check_known_rows(spark, sf_dir):
    """Stored vectors hold as many ones as the playlist has known tracks."""
    sized = stage(context(spark, sf_dir).vectors.select(
        "playlist_id", vec.vector_summary("features")["n_items"].cast("bigint").alias("n_known")), "vector-sizes")
    return sized


@query("check_index_extensions", sql=f"""with {INCREMENTAL_CTES},
b as (select 1 as version, track_uri from old_raw union all select 2, track_uri from mid_raw
      union all select 3, track_uri from late_raw),
k as (select version, count(distinct track_uri) as batch from b group by version),
a as (select version, count(*) as added from versions group by version)
select k.version, batch, added, true as filtered from k join a on k.version = a.version""")
def q_check_index_extensions(spark, sf_dir):
    """What each extension did. ``filtered``: the key filters kept nine tenths of the new keys at
    least, and no known one, away from the join with the stored rows."""
    _, done = context(spark, sf_dir).dictionary
    return spark.createDataFrame(
        [(e.version, e.batch, e.added, e.skipped <= e.added and 10 * e.skipped >= 9 * e.added) for e in done],
        "version int, batch long, added long, filtered boolean")


@query("check_ann_rows", sql="select true as near, true as ordered, true as few")
def q_check_ann_rows(spark, sf_dir):
    """The rows of ``ann_single`` themselves: each distance is the true one between the basket's tracks
    and the playlist's, they don't fall, and there are three at most."""
    ctx = context(spark, sf_dir)
    found = stage(q.q_ann_single(spark, sf_dir), "ann-rows")
    baskets = tv.order_baskets(spark, sf_dir, since=tv.HISTORY_CUTOFF)
    key = idx.encode(baskets.where(F.col("basket_id") == baskets.agg(F.min("basket_id")).scalar()), ctx.history_index)
    key = key.where("track_uri_index is not null").select("track_uri_index", F.lit(True).alias("_in"))
    size = key.count()
    held = (ctx.history_pairs.join(found, F.col("playlist_id") == F.col("neighbor_id")).join(key, "track_uri_index", "left")
            .groupBy("playlist_id", "distance").agg(F.count(F.lit(1)).alias("_b"), F.count("_in").alias("_o")))
    true = F.sqrt((F.lit(size) + F.col("_b") - 2 * F.col("_o")).cast("double"))
    near = [r[0] for r in held.select(F.abs(true - F.col("distance")) < 1e-5).collect()]
    order = [r["distance"] for r in found.collect()]
    return spark.createDataFrame([(0 < len(near) == len(order) and all(near), order == sorted(order), len(order) <= 3)],
                                 "near boolean, ordered boolean, few boolean")


@query("check_ann_dense_rows", sql="select true as near, true as ordered, true as few")
def q_check_ann_dense_rows(spark, sf_dir):
    """The same of ``ann_dense``, from the embeddings."""
    given = q.q_ann_dense(spark, sf_dir)
    emb = tv.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    key = emb.where(F.col("vec_id") == emb.agg(F.min("vec_id")).scalar()).first()["embedding"]
    apart = F.zip_with("embedding", F.lit(list(key)), lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double")))
    true = F.sqrt(F.aggregate(apart, F.lit(0.0), lambda s, x: s + x))
    near = [r[0] for r in given.join(emb, "vec_id").select(F.abs(true - F.col("distCol")) < 1e-5).collect()]
    order = [r["distCol"] for r in given.collect()]
    return spark.createDataFrame([(len(near) == len(order) and all(near), order == sorted(order), len(order) <= 3)],
                                 "near boolean, ordered boolean, few boolean")


@query("check_ann_multi_probe", sql="select true as enough, true as fewer")
def q_check_ann_multi_probe(spark, sf_dir):
    """Recall of the multi-probe search against the exact one is nine tenths at least, with fewer
    candidates than rows."""
    found = stage(q.q_ann_multi_probe(spark, sf_dir), "probe-found")
    exact = stage(q._probe(spark, sf_dir, 1, 1, 1e9, 3), "probe-exact")
    sums = [df.select("query_id", "candidates").distinct().agg(F.sum("candidates")).first()[0] for df in (found, exact)]
    return spark.createDataFrame([(multiprobe.recall(found, exact) >= 0.9, sums[0] < sums[1])], "enough boolean, fewer boolean")
