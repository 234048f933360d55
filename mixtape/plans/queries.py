"""The registered queries. Each reads the test tables of ``sf_dir`` (whole
tables) and returns a DataFrame; where SQL can express the result, the DuckDB
oracle next to it must return the same rows and column names."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from mixtape.functions import text as txt
from mixtape.operators import catalog as cat
from mixtape.operators import dictionary
from mixtape.operators import factors as fac
from mixtape.operators import index as idx
from mixtape.operators import interactions as inter
from mixtape.operators import multiprobe
from mixtape.operators import neighbors as nb
from mixtape.operators import recommend as rec
from mixtape.operators import search
from mixtape.operators import setsim
from mixtape.operators import stored_catalog
from mixtape.operators import vectors as vec
from mixtape.plans.context import context
from mixtape.plans.oracle import HISTORY_CTES, INCREMENTAL_CTES, TWO_BATCH_CTES, UI_CTES, raw_rows
from mixtape.plans.registry import query
from mixtape.session import scratch_path
from mixtape.sources import json_slices
from mixtape.sources import json_split
from mixtape.sources import models as mdl
from mixtape.sources import testview as tv
from mixtape.streaming import baskets as stream_baskets


# --- index and interactions ---------------------------------------------------

@query("index_build", sql=f"""with {UI_CTES}
select track, id from idx""")
def q_index_build(spark, sf_dir):
    return context(spark, sf_dir).index


@query("interactions", sql=f"""with {UI_CTES}
select * from ui""")
def q_interactions(spark, sf_dir):
    return context(spark, sf_dir).interactions


# --- dictionary: extension, lookups, persistence, set difference ---------------


@query("index_incremental", sql=f"""with {INCREMENTAL_CTES}
select track, id from inc_idx""")
def q_index_incremental(spark, sf_dir):
    """Built from the first batch and extended twice, as read from its log."""
    root, _ = context(spark, sf_dir).dictionary
    return dictionary.read(spark, root)


@query("index_versions", sql=f"""with {INCREMENTAL_CTES}
select version, count(*) as n_rows, cast(min(id) as bigint) as first_id, cast(max(id) as bigint) as last_id
from versions group by version""")
def q_index_versions(spark, sf_dir):
    root, _ = context(spark, sf_dir).dictionary
    return dictionary.versions(spark, root)


@query("index_version_rows", sql=f"""with {INCREMENTAL_CTES}
select track, id, version from versions""")
def q_index_version_rows(spark, sf_dir):
    """Each row with the version that added it: older rows stay where they were written."""
    root, _ = context(spark, sf_dir).dictionary
    return dictionary.read(spark, root, with_version=True)


@query("index_snapshot", sql=f"""with {INCREMENTAL_CTES}
select track, id from mid_idx""")
def q_index_snapshot(spark, sf_dir):
    """The dictionary as it was after the first extension."""
    root, _ = context(spark, sf_dir).dictionary
    return dictionary.read(spark, root, version=2)


@query("new_tracks_except", sql=f"""with {INCREMENTAL_CTES}
select track_uri from new_raw except select track from old_idx""")
def q_new_tracks_except(spark, sf_dir):
    ctx = context(spark, sf_dir)
    old = dictionary.read(spark, ctx.dictionary[0], version=1)
    return ctx.new_rows.select("track_uri").subtract(old.select("track"))


@query("index_lookup", sql=f"""with {INCREMENTAL_CTES}
select k.track, o.id, o.id is null as is_new
from (select distinct track_uri as track from new_raw) k left join old_idx o on k.track = o.track""")
def q_index_lookup(spark, sf_dir):
    """Later keys in the first version: known ones with their id, the others new."""
    ctx = context(spark, sf_dir)
    keys = ctx.new_rows.select(F.col("track_uri").alias("track")).distinct()
    found = dictionary.lookup(spark, ctx.dictionary[0], keys, version=1)
    return found.withColumn("is_new", F.col("id").isNull())


@query("index_new_keys", sql=f"""with {INCREMENTAL_CTES}
select distinct track_uri as track, track_uri not in (select track from mid_idx) as is_new from late_raw""")
def q_index_new_keys(spark, sf_dir):
    """The last batch against the dictionary before it, by a join with all its rows."""
    ctx = context(spark, sf_dir)
    known = dictionary.read(spark, ctx.dictionary[0], version=2)
    late = tv.playlist_tracks(spark, sf_dir, since=tv.DICTIONARY_CUTOFFS[1])
    return idx.is_new_key(known, late.select(F.col("track_uri").alias("track")).distinct())


@query("index_reverse_lookup", sql=f"""with {UI_CTES}
select cast(p.p_partkey as int) as id, idx.track
from part p left join idx on cast(p.p_partkey as int) = idx.id""")
def q_index_reverse_lookup(spark, sf_dir):
    from mixtape.sources.testview import table
    ids = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("id"))
    return idx.decode(ids, context(spark, sf_dir).index, "id", "track")


@query("index_roundtrip", sql=f"""with {UI_CTES}
select track, id from idx""")
def q_index_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "index")
    idx.save_index(context(spark, sf_dir).index, path)
    return idx.load_index(spark, path)


# --- ingest from nested JSON slices --------------------------------------------


def _slices(spark, sf_dir):
    path = scratch_path(spark, "slices")
    json_slices.write_slices(context(spark, sf_dir).rows, path, playlists_per_slice=250)
    return path


@query("json_flatten", sql=f"select * from ({raw_rows()}) r")
def q_json_flatten(spark, sf_dir):
    path = _slices(spark, sf_dir)
    return json_slices.flatten_slices(
        json_slices.read_slices(spark, f"{path}/{json_slices.WRITTEN_GLOB}"))


@query("json_flatten_recursive", sql=f"select * from ({raw_rows()}) r")
def q_json_flatten_recursive(spark, sf_dir):
    path = _slices(spark, sf_dir)
    return json_slices.flatten_slices(json_slices.read_slices(spark, path, recursive=True))


@query("json_ingest", sql=f"""with {UI_CTES}
select * from ui""")
def q_json_ingest(spark, sf_dir):
    path = _slices(spark, sf_dir)
    rows = json_slices.flatten_slices(json_slices.read_slices(spark, path, recursive=True))
    interactions, _ = inter.ingest(rows)
    return interactions


@query("ingest_two_batches", sql=f"""with {TWO_BATCH_CTES}
select distinct b.playlist_id, b.track_uri, b.track_name, b.artist_name, b.album_name,
       i.id as track_uri_index, 1 as rating, b.batch
from (select 1 as batch, * from old_raw union all select 2, * from new_raw) b
left join two_idx i on b.track_uri = i.track""")
def q_ingest_two_batches(spark, sf_dir):
    """Two batches into one stored dictionary: the interactions of both, with the batch."""
    root, first = scratch_path(spark, "dictionary"), tv.DICTIONARY_CUTOFFS[0]
    batches = [tv.playlist_tracks(spark, sf_dir, until=first), tv.playlist_tracks(spark, sf_dir, since=first)]
    done = [inter.ingest_stored(spark, rows, root).withColumn("batch", F.lit(i + 1)) for i, rows in enumerate(batches)]
    return done[0].unionByName(done[1])


@query("json_flatten_document", sql=f"select * from ({raw_rows()}) r")
def q_json_flatten_document(spark, sf_dir):
    """All playlists as one document, which several tasks read."""
    path = json_split.write_document(context(spark, sf_dir).rows, scratch_path(spark, "document"))
    return json_split.flatten_documents(spark, path)


# --- catalog, lookups, search, text rows ------------------------------------------


CATALOG_SQL = f"""with {UI_CTES},
cat as (select distinct substr(track_name, 1, 200) as track_name, substr(artist_name, 1, 200) as artist_name,
               substr(album_name, 1, 200) as album_name, track_uri from ui)"""

# Fixed search parameters of the registered search queries.
PAGE_OFFSET = 100
POINT_URI = "part:7"
NAME_TERM = "RING"
SEARCH = ("ring", "brand#1", "")
CONTAINS = ("Blue", "", "eco")
TIERED = ("widget", "", "promo")


def _catalog(spark, sf_dir):
    return context(spark, sf_dir).catalog


@query("catalog_build", sql=f"{CATALOG_SQL} select * from cat")
def q_catalog_build(spark, sf_dir):
    return cat.build_catalog(context(spark, sf_dir).interactions)


@query("catalog_build_short", sql=f"""with {UI_CTES}
select distinct substr(track_name, 1, 6) as track_name, substr(artist_name, 1, 6) as artist_name,
       substr(album_name, 1, 6) as album_name, track_uri from ui""")
def q_catalog_build_short(spark, sf_dir):
    """The same with a cut that names reach."""
    return cat.build_catalog(context(spark, sf_dir).interactions, max_len=6)


@query("catalog_roundtrip", sql=f"{CATALOG_SQL} select * from cat")
def q_catalog_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "catalog")
    cat.write_catalog(_catalog(spark, sf_dir), path)
    return cat.read_catalog(spark, path)


@query("catalog_page", sql=f"""{CATALOG_SQL}
select * from cat order by track_uri, track_name, artist_name, album_name
limit 100 offset {PAGE_OFFSET}""")
def q_catalog_page(spark, sf_dir):
    return cat.catalog_page(_catalog(spark, sf_dir), PAGE_OFFSET)


@query("catalog_page_sql", sql=f"""{CATALOG_SQL}
select * from cat order by track_uri, track_name, artist_name, album_name
limit 100 offset {PAGE_OFFSET}""")
def q_catalog_page_sql(spark, sf_dir):
    view = cat.register_catalog(_catalog(spark, sf_dir), "tracks")
    return cat.catalog_page_sql(spark, PAGE_OFFSET, view=view)


@query("catalog_page_keyset", sql=f"""{CATALOG_SQL}
select * from cat order by track_uri, track_name, artist_name, album_name
limit 100 offset {PAGE_OFFSET}""")
def q_catalog_page_keyset(spark, sf_dir):
    """The page after the last row of the pages before it."""
    catalog = _catalog(spark, sf_dir)
    last = cat.catalog_page(catalog, PAGE_OFFSET - 1, 1).first()
    return cat.catalog_page_after(catalog, (last["track_uri"], last["track_name"], last["artist_name"],
                                            last["album_name"]))


@query("catalog_page_deep", sql=f"""{CATALOG_SQL},
r as (select *, row_number() over (order by track_uri, track_name, artist_name, album_name) - 1 as pos,
             count(*) over () as n from cat)
select track_name, artist_name, album_name, track_uri from r where pos >= n * 3 // 4 and pos < n * 3 // 4 + 100""")
def q_catalog_page_deep(spark, sf_dir):
    """The page after three quarters of the catalog, from the stored parts that it touches."""
    stored = context(spark, sf_dir).stored_catalog
    n = stored.manifest.agg(F.sum("n_rows")).first()[0]
    return stored_catalog.page(stored, n * 3 // 4)


@query("track_name_like_indexed", sql=f"""{CATALOG_SQL}
select * from cat where contains(lower(track_name), lower('{NAME_TERM}'))""")
def q_track_name_like_indexed(spark, sf_dir):
    return stored_catalog.name_like(context(spark, sf_dir).stored_catalog, NAME_TERM)


@query("track_search_indexed", sql=f"""{CATALOG_SQL}
select * from cat where contains(lower(track_name), '{SEARCH[0]}') and contains(lower(artist_name), '{SEARCH[1]}')""")
def q_track_search_indexed(spark, sf_dir):
    return stored_catalog.search(context(spark, sf_dir).stored_catalog, *SEARCH)


@query("track_search_contains_indexed", sql=f"""{CATALOG_SQL}
select * from cat where contains(lower(track_name), lower('{CONTAINS[0]}')) and contains(lower(album_name), lower('{CONTAINS[2]}'))""")
def q_track_search_contains_indexed(spark, sf_dir):
    return stored_catalog.search_contains(context(spark, sf_dir).stored_catalog, *CONTAINS)


@query("track_by_uri", sql=f"""{CATALOG_SQL}
select * from cat where track_uri = '{POINT_URI}'
order by track_uri, track_name, artist_name, album_name limit 1""")
def q_track_by_uri(spark, sf_dir):
    return cat.track_by_uri(_catalog(spark, sf_dir), POINT_URI)


@query("tracks_by_uri", sql=f"""{CATALOG_SQL},
req as (select distinct l_orderkey as basket_id, concat('part:', cast(l_partkey as varchar)) as track_uri
        from lineitem)
select req.basket_id, cat.* from req join cat on req.track_uri = cat.track_uri""")
def q_tracks_by_uri(spark, sf_dir):
    return cat.tracks_for_requests(_catalog(spark, sf_dir), tv.order_baskets(spark, sf_dir))


@query("track_name_like", sql=f"""{CATALOG_SQL}
select * from cat where contains(lower(track_name), lower('{NAME_TERM}'))""")
def q_track_name_like(spark, sf_dir):
    return search.track_name_like(_catalog(spark, sf_dir), NAME_TERM)


@query("track_search", sql=f"""{CATALOG_SQL}
select * from cat where contains(lower(track_name), '{SEARCH[0]}')
  and contains(lower(artist_name), '{SEARCH[1]}')""")
def q_track_search(spark, sf_dir):
    return search.track_search(_catalog(spark, sf_dir), *SEARCH)


@query("track_search_contains", sql=f"""{CATALOG_SQL}
select * from cat where coalesce(contains(lower(track_name), lower('{CONTAINS[0]}')), false)
  and coalesce(contains(lower(album_name), lower('{CONTAINS[2]}')), false)""")
def q_track_search_contains(spark, sf_dir):
    return search.track_search_contains(_catalog(spark, sf_dir), *CONTAINS)


@query("track_search_tiered", sql=f"""{CATALOG_SQL},
hot as (select * from cat order by track_uri, track_name, artist_name, album_name limit 100),
t1 as (select * from hot where coalesce(contains(lower(track_name), '{TIERED[0]}'), false)
                           and coalesce(contains(lower(album_name), '{TIERED[2]}'), false)),
t2 as (select * from cat where contains(lower(track_name), '{TIERED[0]}')
                           and contains(lower(album_name), '{TIERED[2]}'))
select * from t1 union all select * from t2 where not exists (select 1 from t1)""")
def q_track_search_tiered(spark, sf_dir):
    full = _catalog(spark, sf_dir)
    hot = cat.catalog_page(full, 0)
    return search.track_search_tiered(hot, full, *TIERED)


TEXT_SQL = """concat_ws(', ', coalesce(track_name, 'None'), coalesce(artist_name, 'None'),
                 coalesce(album_name, 'None'), coalesce(track_uri, 'None'))"""


@query("track_text", sql=f"""{CATALOG_SQL}
select track_uri as key_uri, {TEXT_SQL} as text from cat""")
def q_track_text(spark, sf_dir):
    return cat.with_text(_catalog(spark, sf_dir)).select(F.col("track_uri").alias("key_uri"), "text")


@query("track_text_parse", sql=f"""{CATALOG_SQL},
t as (select {TEXT_SQL} as text from cat),
p as (select text, string_split(text, ', ') as parts from t)
select text,
       array_to_string(list_slice(parts, 1, greatest(len(parts) - 3, 1)), ', ') as track_name,
       case when len(parts) >= 4 then parts[len(parts) - 2] end as artist_name,
       case when len(parts) >= 3 then parts[len(parts) - 1] end as album_name,
       case when len(parts) >= 2 then parts[len(parts)] end as track_uri,
       cast(len(parts) as int) as n_parts
from p""")
def q_track_text_parse(spark, sf_dir):
    texts = cat.with_text(_catalog(spark, sf_dir)).select("text")
    return txt.parse_track_text(texts)


@query("uri_list_explode", sql="""with b as (
  select distinct l_orderkey as basket_id, concat('part:', cast(l_partkey as varchar)) as track_uri from lineitem)
select basket_id, cast(row_number() over (partition by basket_id order by track_uri) - 1 as int) as pos,
       track_uri from b""")
def q_uri_list_explode(spark, sf_dir):
    return txt.explode_uri_list(tv.basket_requests(spark, sf_dir))


# --- arrays, vectors, pivot, audits, routing ---------------------------------------


ARRAY_SUMMARY_SQL = f"""with {UI_CTES}
select playlist_id, cast(count(*) as int) as n_items, min(track_uri_index) as min_id,
       max(track_uri_index) as max_id, cast(sum(track_uri_index) as bigint) as sum_id,
       cast(count(*) as double) as sum_values
from pairs group by playlist_id"""


@query("user_item_arrays", sql=ARRAY_SUMMARY_SQL)
def q_user_item_arrays(spark, sf_dir):
    arrays = vec.user_item_arrays(context(spark, sf_dir).pairs)
    return arrays.select(
        "playlist_id", F.size("indices").alias("n_items"),
        F.array_min("indices").alias("min_id"), F.array_max("indices").alias("max_id"),
        F.aggregate("indices", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("sum_id"),
        F.aggregate("values", F.lit(0.0), lambda a, x: a + x).alias("sum_values"))


@query("user_vectors", sql=ARRAY_SUMMARY_SQL)
def q_user_vectors(spark, sf_dir):
    vectors = vec.sparse_vectors(context(spark, sf_dir).pairs)
    s = vectors.select("playlist_id", vec.vector_summary("features").alias("s"))
    return s.select("playlist_id", "s.n_items", "s.min_id", "s.max_id", "s.sum_id", "s.sum_values")


# Fixed: the brands of the test tables.
BRANDS = [f"Brand#{i}" for i in range(1, 26)]
PIVOT_SQL = ", ".join(f"""coalesce(max(case when p_brand = '{b}' then 1 end), 0) as "{b}\"""" for b in BRANDS)


@query("pivot_matrix", sql=f"""select o.o_custkey as playlist_id, {PIVOT_SQL}
from lineitem l join orders o on l.l_orderkey = o.o_orderkey join part p on l.l_partkey = p.p_partkey
group by o.o_custkey""")
def q_pivot_matrix(spark, sf_dir):
    ui = context(spark, sf_dir).interactions
    return vec.pivot_matrix(ui, BRANDS, item_col="artist_name", assemble=False)


@query("item_universe", sql=f"""with {UI_CTES}
select distinct track_uri_index from ui where track_uri_index is not null""")
def q_item_universe(spark, sf_dir):
    ui = context(spark, sf_dir).interactions
    return (ui.select("track_uri_index").where(F.col("track_uri_index").isNotNull())
              .distinct().orderBy("track_uri_index"))


@query("distinct_users", sql=f"""with {UI_CTES}
select distinct playlist_id from ui""")
def q_distinct_users(spark, sf_dir):
    return context(spark, sf_dir).interactions.select("playlist_id").distinct()


DUP_SQL = f"""with {UI_CTES},
enc as (select r.playlist_id, idx.id as track_uri_index from raw r left join idx on r.track_uri = idx.track)
select playlist_id, track_uri_index, count(*) as "count" from enc
group by playlist_id, track_uri_index having count(*) > {{t}}"""


def _encoded_raw(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return idx.encode(ctx.rows, ctx.index)


@query("dup_audit", sql=DUP_SQL.format(t=2))
def q_dup_audit(spark, sf_dir):
    return inter.dup_audit(_encoded_raw(spark, sf_dir), threshold=2)


@query("dup_audit_strict", sql=DUP_SQL.format(t=1))
def q_dup_audit_strict(spark, sf_dir):
    return inter.dup_audit(_encoded_raw(spark, sf_dir), threshold=1)


@query("split_known_new", sql=f"""with {HISTORY_CTES},
b as (select distinct playlist_id as basket_id from incoming_raw)
select basket_id, exists (select 1 from hist_raw h where h.playlist_id = b.basket_id) as is_known
from b""")
def q_split_known_new(spark, sf_dir):
    incoming = tv.customer_baskets(spark, sf_dir, since=tv.HISTORY_CUTOFF)
    history = tv.playlist_tracks(spark, sf_dir, until=tv.HISTORY_CUTOFF)
    return inter.split_known_new(incoming, history)


@query("basket_interactions", sql=f"""{CATALOG_SQL},
b as (select distinct l_orderkey as basket_id, concat('part:', cast(l_partkey as varchar)) as track_uri
      from lineitem)
select distinct b.basket_id, c.track_name, c.artist_name, c.album_name, c.track_uri,
       idx.id as track_uri_index, 1 as rating
from b join (select distinct track_name, artist_name, album_name, track_uri from ui) c
  on b.track_uri = c.track_uri
left join idx on c.track_uri = idx.track""")
def q_basket_interactions(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return inter.basket_interactions(tv.order_baskets(spark, sf_dir), ctx.catalog, ctx.index)


# --- neighbours, factors, recommendations -------------------------------------------


# brute force over every (basket, user) pair: the independent check of the
# pruned candidate set used by knn_exact
KNN_SQL = f"""with {UI_CTES},
bk as (select distinct l.l_orderkey as basket_id, idx.id as item
       from lineitem l left join idx on concat('part:', cast(l.l_partkey as varchar)) = idx.track),
bsize as (select basket_id, count(item) as a from bk group by basket_id),
usize as (select playlist_id, count(*) as b from pairs group by playlist_id),
ov as (select bk.basket_id, p.playlist_id, count(*) as o
       from bk join pairs p on bk.item = p.track_uri_index group by bk.basket_id, p.playlist_id),
allp as (select bs.basket_id, us.playlist_id, bs.a + us.b - 2 * coalesce(ov.o, 0) as d2
         from bsize bs cross join usize us
         left join ov on ov.basket_id = bs.basket_id and ov.playlist_id = us.playlist_id),
ranked as (select basket_id, playlist_id, d2,
                  row_number() over (partition by basket_id order by d2, playlist_id) as rn
           from allp)
select basket_id, playlist_id as neighbor_id, round(sqrt(d2), 6) as distance, cast(rn as int) as rank
from ranked where rn <= {{k}}"""


@query("knn_exact", sql=KNN_SQL.format(k=1))
def q_knn_exact(spark, sf_dir):
    ctx = context(spark, sf_dir)
    items = idx.encode(tv.order_baskets(spark, sf_dir), ctx.index).select("basket_id", "track_uri_index")
    return nb.knn_exact(items, ctx.pairs, k=1, existing_distinct=True)


@query("knn_top3", sql=KNN_SQL.format(k=3))
def q_knn_top3(spark, sf_dir):
    ctx = context(spark, sf_dir)
    items = idx.encode(tv.order_baskets(spark, sf_dir), ctx.index).select("basket_id", "track_uri_index")
    return nb.knn_exact(items, ctx.pairs, k=3, existing_distinct=True)


def sets_sql(similarity: str, k: int) -> str:
    """All orders against all playlists by their common tracks; nothing common counts as zero."""
    return f"""with {UI_CTES},
bk as (select distinct l_orderkey as basket_id, idx.id as item
       from lineitem join idx on concat('part:', cast(l_partkey as varchar)) = idx.track),
a as (select basket_id, count(*) as a from bk group by basket_id),
u as (select playlist_id, count(*) as b from pairs group by playlist_id),
o as (select basket_id, playlist_id, count(*) as o from bk join pairs on item = track_uri_index
      group by basket_id, playlist_id),
s as (select basket_id, playlist_id, {similarity} as s from o join a using (basket_id) join u using (playlist_id)),
z as (select basket_id, playlist_id, cast(0 as double) as s
      from a cross join (select playlist_id from u order by playlist_id limit {k}) f
      where not exists (select 1 from s where s.basket_id = a.basket_id and s.playlist_id = f.playlist_id)),
r as (select *, row_number() over (partition by basket_id order by s desc, playlist_id) as rank
      from (select * from s union all select * from z) sz)
select basket_id, playlist_id as neighbor_id, round(s, 6) as similarity, cast(rank as int) as rank
from r where rank <= {k}"""


def _sets(spark, sf_dir, metric):
    ctx = context(spark, sf_dir)
    items = idx.encode(tv.order_baskets(spark, sf_dir), ctx.index).select("basket_id", "track_uri_index")
    return setsim.knn_sets(items, ctx.pairs, k=3, metric=metric, existing_distinct=True)


@query("knn_jaccard", sql=sets_sql("cast(o as double) / (a + b - o)", 3))
def q_knn_jaccard(spark, sf_dir):
    return _sets(spark, sf_dir, "jaccard")


@query("knn_cosine", sql=sets_sql("cast(o as double) / sqrt(a * b)", 3))
def q_knn_cosine(spark, sf_dir):
    return _sets(spark, sf_dir, "cosine")


@query("als_factors")
def q_als_factors(spark, sf_dir):
    return fac.factors(context(spark, sf_dir).model, "user")


@query("als_roundtrip")
def q_als_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "als")
    mdl.save_model(context(spark, sf_dir).model, path)
    return mdl.load_als(path).itemFactors


@query("lsh_hashes")
def q_lsh_hashes(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return nb.hash_values(ctx.lsh, ctx.vectors)


@query("lsh_roundtrip")
def q_lsh_roundtrip(spark, sf_dir):
    ctx = context(spark, sf_dir)
    path = scratch_path(spark, "lsh")
    mdl.save_model(ctx.lsh, path)
    return nb.hash_values(mdl.load_lsh(path), ctx.vectors)


@query("ann_single")
def q_ann_single(spark, sf_dir):
    """LSH neighbour of one incoming basket (the smallest basket id), with the
    exact neighbour as fallback when no bucket matches."""
    ctx = context(spark, sf_dir)
    baskets = tv.order_baskets(spark, sf_dir, since=tv.HISTORY_CUTOFF)
    first_id = baskets.agg(F.min("basket_id")).first()[0]
    one = baskets.where(F.col("basket_id") == F.lit(first_id))
    items = idx.encode(one, ctx.history_index).select("basket_id", "track_uri_index")
    size = vec.vector_size(ctx.history_pairs)
    key = (vec.sparse_vectors(items.where(F.col("track_uri_index").isNotNull()), size,
                              user_col="basket_id")
           .select("features").first())
    if key is None:  # no known item at all: only the exact path applies
        return nb.knn_exact(items, ctx.history_pairs, 1).select(
            "neighbor_id", "distance", F.lit("exact").alias("method"))
    return nb.ann_with_fallback(ctx.history_lsh, ctx.history_vectors, key["features"], items,
                                ctx.history_pairs, k=1)


def _by_id(ctx):
    return cat.catalog_by_id(ctx.history)


@query("recommend_known")
def q_recommend_known(spark, sf_dir):
    ctx = context(spark, sf_dir)
    users = ctx.pairs.select("playlist_id").distinct()
    return rec.recommend_known(ctx.model, users, rec.RECS_TRAINING, cat.catalog_by_id(ctx.interactions))


@query("recommend_new")
def q_recommend_new(spark, sf_dir):
    ctx = context(spark, sf_dir)
    baskets = tv.order_baskets(spark, sf_dir, since=tv.HISTORY_CUTOFF)
    return rec.recommend_new(ctx.history_model, baskets, ctx.history_index, ctx.history_pairs,
                             rec.RECS_JOB, _by_id(ctx))


def _recommend_all(spark, sf_dir):
    ctx = context(spark, sf_dir)
    baskets = tv.incoming_baskets(spark, sf_dir, since=tv.HISTORY_CUTOFF)
    return baskets, rec.recommend_all(ctx.history_model, baskets, ctx.history_index,
                                      ctx.history_pairs, rec.RECS_TRAINING, _by_id(ctx))


ROUTE_SQL = f"""with {HISTORY_CTES},
hist as (select distinct playlist_id, track_uri from hist_raw),
users as (select distinct playlist_id from hist),
inc as (select distinct playlist_id as basket_id, track_uri from incoming_raw
        union select distinct basket_id, track_uri from incoming_orders),
known as (select distinct basket_id from inc where basket_id in (select playlist_id from users)),
newb as (select * from inc where basket_id not in (select playlist_id from users)),
bk as (select basket_id, track_uri from newb where track_uri in (select track_uri from hist)),
bsize as (select b.basket_id, count(bk.track_uri) as a
          from (select distinct basket_id from newb) b left join bk on b.basket_id = bk.basket_id
          group by b.basket_id),
usize as (select playlist_id, count(*) as b from hist group by playlist_id),
ov as (select bk.basket_id, h.playlist_id, count(*) as o
       from bk join hist h on bk.track_uri = h.track_uri group by bk.basket_id, h.playlist_id),
allp as (select bs.basket_id, us.playlist_id, bs.a + us.b - 2 * coalesce(ov.o, 0) as d2
         from bsize bs cross join usize us
         left join ov on ov.basket_id = bs.basket_id and ov.playlist_id = us.playlist_id),
ranked as (select basket_id, playlist_id, d2,
                  row_number() over (partition by basket_id order by d2, playlist_id) as rn
           from allp)
select basket_id, 'known' as method, cast(null as bigint) as neighbor_id,
       cast(null as double) as distance from known
union all
select basket_id, 'neighbour' as method, playlist_id as neighbor_id,
       round(sqrt(d2), 6) as distance from ranked where rn = 1"""


@query("recommend_route", sql=ROUTE_SQL)
def q_recommend_route(spark, sf_dir):
    """The routing of recommend_all: which playlist answers each incoming one."""
    ctx = context(spark, sf_dir)
    baskets = tv.incoming_baskets(spark, sf_dir, since=tv.HISTORY_CUTOFF)
    route = rec.route_baskets(baskets, ctx.history_index, ctx.history_pairs)
    return route.drop("_src")


@query("recommend_all")
def q_recommend_all(spark, sf_dir):
    return _recommend_all(spark, sf_dir)[1]


@query("recommend_enriched")
def q_recommend_enriched(spark, sf_dir):
    ctx = context(spark, sf_dir)
    _, recs = _recommend_all(spark, sf_dir)
    return rec.enrich(recs, cat.build_catalog(ctx.history))


def _requests(spark, sf_dir):
    """The requests of the orders after the history."""
    return tv.basket_requests(spark, sf_dir).join(
        tv.order_baskets(spark, sf_dir, since=tv.HISTORY_CUTOFF).select("basket_id").distinct(),
        "basket_id", "left_semi")


@query("recommend_envelope")
def q_recommend_envelope(spark, sf_dir):
    ctx = context(spark, sf_dir)
    baskets = txt.explode_uri_list(_requests(spark, sf_dir))
    recs = rec.recommend_new(ctx.history_model, baskets, ctx.history_index, ctx.history_pairs,
                             rec.RECS_JOB, _by_id(ctx))
    return rec.envelope(recs, baskets).select("basket_id", "envelope", "uri_list")


# --- streaming: arriving requests -> envelopes --------------------------------------


@query("recommend_stream")
def q_recommend_stream(spark, sf_dir):
    """Incoming order baskets as request files, recommended by a streaming query
    (available-now trigger); returns the envelopes it wrote."""
    ctx = context(spark, sf_dir)
    root = scratch_path(spark, "stream")
    stream_baskets.write_requests(_requests(spark, sf_dir), f"{root}/in")
    q = stream_baskets.start(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt",
                             ctx.history_model, ctx.history_index, ctx.history_pairs, _by_id(ctx))
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out").select("basket_id", "envelope", "uri_list")


# --- LSH on dense input: the embeddings table ------------------------------------------


def _dense_vectors(spark, sf_dir):
    emb = tv.table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", array_to_vector("embedding").alias("features"))


@query("lsh_dense_hashes")
def q_lsh_dense_hashes(spark, sf_dir):
    vectors = _dense_vectors(spark, sf_dir)
    model = nb.fit_lsh(vectors, seed=7)
    return nb.hash_values(model, vectors, user_col="vec_id")


@query("ann_dense")
def q_ann_dense(spark, sf_dir):
    """Approximate 3 nearest embeddings of the embedding with the smallest id."""
    vectors = _dense_vectors(spark, sf_dir)
    model = nb.fit_lsh(vectors, seed=7)
    first = vectors.agg(F.min("vec_id")).first()[0]
    key = vectors.where(F.col("vec_id") == F.lit(first)).select("features").first()["features"]
    return nb.ann_single(model, vectors, key, k=3, user_col="vec_id")


# tables, projections per table, bucket length and buckets looked up per table
PROBE = {"tables": 8, "width": 4, "length": 0.45}
PROBES, PROBE_K = 5, 5


def _probe(spark, sf_dir, tables, width, length, probes):
    rows = tv.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    dims = rows.agg(F.max(F.size("embedding"))).first()[0]
    units = multiprobe.draw_units(spark, dims, tables, width)
    return multiprobe.neighbours(rows, rows.where(F.col("vec_id") % 100 == 0), units, tables, width, length, PROBE_K, probes)


@query("ann_multi_probe")
def q_ann_multi_probe(spark, sf_dir):
    """Approximate 5 nearest embeddings of every hundredth one."""
    return _probe(spark, sf_dir, **PROBE, probes=PROBES)


@query("ann_probe_wide", sql="""with d as (
  select a.vec_id as query_id, list_distance(a.embedding::double[], b.embedding::double[]) as distance
  from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by distance) as rank from d)
select query_id, cast(rank as int) as rank, round(distance, 4) as distance,
       (select count(*) - 1 from embeddings) as candidates from r where rank <= 5""")
def q_ann_probe_wide(spark, sf_dir):
    """The same with one bucket for all: the distances of the exact neighbours."""
    found = _probe(spark, sf_dir, 1, 1, 1e9, 3)
    return found.select("query_id", "rank", F.round("distance", 4).alias("distance"), "candidates")
