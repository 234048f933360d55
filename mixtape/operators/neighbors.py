"""Nearest existing playlist(s) for query baskets: exact set-overlap kNN, and
random-projection LSH (fit, hashes, single-key ANN with exact fallback).

Exact kNN on 0/1 item sets: for basket A and user B with overlap o the squared
Euclidean distance is |A| + |B| - 2o. Users sharing nothing with A sit at
|A| + |B|, so only the k users smallest by (|B|, id) among them can enter a
top-k; they are found once (k rows, collected) and offered to every basket, and
they bound each basket's k-th distance. Other users qualify only with enough
overlap; they come from a join on the rarest items of each user
(``_prefix_overlaps``). Every user outside both sets is beaten by k users that
are inside, so the result equals the all-pairs answer. Ranking is by
(distance, id).
"""

from __future__ import annotations

from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from mixtape.session import stage

# Fixed LSH settings of the trained model: hash tables and bucket length.
LSH_TABLES = 3
LSH_BUCKET_LENGTH = 0.999799458143871

#: Numbers in the unit vectors of one model that ``ann_tables`` fits: 32 MB on the driver and in a task.
MODEL_NUMBERS = 1 << 22


def knn_exact(baskets: DataFrame, existing: DataFrame, k: int = 1,
              basket_col: str = "basket_id", user_col: str = "playlist_id",
              item_col: str = "track_uri_index", exclude_same_id: bool = False,
              existing_distinct: bool = False, user_sizes: DataFrame | None = None) -> DataFrame:
    """(basket, neighbor_id, distance, rank) for every basket, k rows each
    (fewer only if there are fewer than k users).

    ``baskets``: (basket, item) rows; a null item (unknown key) still makes the
    basket count, with an empty known set. ``existing``: (user, item) rows.
    ``exclude_same_id`` drops the user whose id equals the basket id.
    ``existing_distinct``: the (user, item) rows are already distinct (skips a
    full shuffle of them); ``user_sizes``: precomputed (user, _b = item count).
    """
    # the query baskets are read by four branches below: store them once
    b = stage(baskets.select(basket_col, item_col).distinct(), "knn-baskets")
    bsize = b.groupBy(basket_col).agg(F.count(item_col).alias("_a"))
    ex = existing.select(user_col, item_col).where(F.col(item_col).isNotNull())
    if not existing_distinct:
        ex = ex.distinct()
    usize = (user_sizes if user_sizes is not None
             else ex.groupBy(user_col).agg(F.count(F.lit(1)).alias("_b")))

    # the k users smallest by (|B|, id), +1 when the basket's own id may be
    # excluded. Bounded (k rows), collected once and offered to every basket.
    n_zero = k + (1 if exclude_same_id else 0)
    zero_users = usize.orderBy("_b", user_col).limit(n_zero).collect()
    if len(zero_users) < n_zero:
        # fewer users than that: all of them are offered, and all may qualify
        b_k = max([int(r["_b"]) for r in zero_users], default=0)
    else:
        b_k = int(zero_users[-1]["_b"])

    # each basket row carries |A| (partial counts, then a join on basket that
    # AQE may broadcast or split when one basket is huge), so pairs that cannot
    # reach the basket's top-k are dropped before the aggregation shuffle
    bk = b.where(F.col(item_col).isNotNull()).join(bsize, basket_col)
    # a user can only enter a top-k when |B| - 2*overlap <= b_k, hence
    # |B| <= b_k + 2*|A|; the largest |A| is a scalar of the plan
    a_max = bsize.agg(F.coalesce(F.max("_a"), F.lit(0))).scalar()
    exs = ex.join(usize.where(F.col("_b") <= F.lit(b_k) + 2 * a_max), user_col)
    overlaps = _prefix_overlaps(b, bk, ex, exs, b_k, basket_col, user_col, item_col)
    overlaps = overlaps.where(F.col("_b") - 2 * F.col("_o") <= F.lit(b_k))
    if exclude_same_id:
        overlaps = overlaps.where(F.col(basket_col) != F.col(user_col))
    dist = F.sqrt((F.col("_a") + F.col("_b") - 2 * F.col("_o")).cast("double"))
    cand = overlaps.select(basket_col, user_col, dist.alias("distance"))
    w = Window.partitionBy(basket_col).orderBy("distance", user_col)
    top = cand.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")

    if zero_users:
        offered = F.array(*[F.struct(F.lit(r[user_col]).alias(user_col),
                                     F.lit(int(r["_b"])).alias("_b")) for r in zero_users])
        zero = bsize.select(basket_col, "_a", F.inline(offered))
        if exclude_same_id:
            zero = zero.where(F.col(basket_col) != F.col(user_col))
        top = top.unionByName(zero.select(
            basket_col, user_col, F.sqrt((F.col("_a") + F.col("_b")).cast("double")).alias("distance")))

    # <= 2k rows per basket: sort, keep the first row per user, keep k.
    merged = (top.groupBy(basket_col)
              .agg(F.array_sort(F.collect_list(F.struct("distance", user_col))).alias("_c")))
    firsts = F.filter("_c", lambda x, i: ~F.exists(F.slice("_c", 1, i),
                                                     lambda y: y[user_col] == x[user_col]))
    best = merged.select(basket_col, F.slice(firsts, 1, k).alias("_c"))
    return (best.select(basket_col, F.posexplode("_c").alias("_pos", "_n"))
            .select(basket_col, F.col(f"_n.{user_col}").alias("neighbor_id"),
                    F.round("_n.distance", 6).alias("distance"),
                    (F.col("_pos") + 1).cast("int").alias("rank")))


def _prefix_overlaps(b: DataFrame, bk: DataFrame, ex: DataFrame, exs: DataFrame, b_k: int,
                     basket_col: str, user_col: str, item_col: str) -> DataFrame:
    """Exact overlaps of every (basket, user) pair that can still qualify,
    generated from user prefixes instead of full posting lists.

    User B qualifies only with overlap o >= r_B = max(1, ceil((|B| - b_k) / 2))
    (from |B| - 2o <= b_k), independent of the basket. Order every user's items
    by (number of holders, id), rarest first: a basket sharing >= r_B items with
    B shares at least one of B's first |B| - r_B + 1 items. So candidates come
    from joining basket items with those prefixes only - a very popular item
    sits at the end of nearly every order and rarely generates a candidate -
    and each candidate's exact overlap is then counted over the basket's items.
    """
    holders = exs.groupBy(item_col).agg(F.count(F.lit(1)).alias("_f"))
    need = F.greatest(F.ceil((F.col("_b") - F.lit(b_k)) / 2), F.lit(1))
    order = Window.partitionBy(user_col).orderBy("_f", item_col)
    prefix = (exs.join(holders, item_col)
              .withColumn("_r", F.row_number().over(order))
              .where(F.col("_r") <= F.col("_b") - need + 1)
              .select(user_col, item_col, "_b"))
    cand = (bk.join(prefix, item_col)
            .where(F.col("_b") <= F.lit(b_k) + 2 * F.col("_a"))
            .select(basket_col, user_col, "_a", "_b").distinct())
    # verify: count the basket's items that the user holds
    return (cand.join(b.where(F.col(item_col).isNotNull()), basket_col)
            .join(ex, [user_col, item_col], "left_semi")
            .groupBy(basket_col, user_col, "_a", "_b")
            .agg(F.count(F.lit(1)).alias("_o")))


# --- locality-sensitive hashing ------------------------------------------------

def fit_lsh(vectors: DataFrame, bucket_length: float = LSH_BUCKET_LENGTH,
            num_tables: int = LSH_TABLES, seed: int = 7, input_col: str = "features",
            output_col: str = "hashes") -> BucketedRandomProjectionLSHModel:
    lsh = BucketedRandomProjectionLSH(inputCol=input_col, outputCol=output_col,
                                      numHashTables=num_tables, bucketLength=bucket_length,
                                      seed=seed)
    return lsh.fit(vectors)


def hash_values(model: BucketedRandomProjectionLSHModel, vectors: DataFrame,
                user_col: str = "playlist_id") -> DataFrame:
    """(user, hashes: array<double>) - one bucket number per hash table."""
    out = model.transform(vectors)
    col = model.getOutputCol()
    return out.select(user_col, F.transform(col, lambda v: vector_to_array(v)[0]).alias("hashes"))


_MATRIX = ("randUnitVectors struct<type:tinyint,numRows:int,numCols:int,colPtrs:array<int>,rowIndices:array<int>,"
           "values:array<double>,isTransposed:boolean>")


def unit_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(item, table, r): the random unit vectors of a saved model, an entry per row."""
    m = spark.read.schema(_MATRIX).parquet(f"{path.rstrip('/')}/data").select("randUnitVectors.*")
    each = m.select("numRows", "numCols", "isTransposed", F.posexplode("values").alias("_p", "r"))
    row = F.when(F.col("isTransposed"), F.floor(F.col("_p") / F.col("numCols"))).otherwise(F.col("_p") % F.col("numRows"))
    column = F.when(F.col("isTransposed"), F.col("_p") % F.col("numCols")).otherwise(F.floor(F.col("_p") / F.col("numRows")))
    return each.select(column.cast("int").alias("item"), row.cast("int").alias("table"), "r")


def projections(entries: DataFrame, units: DataFrame, bucket_length: float = LSH_BUCKET_LENGTH, id_col: str = "playlist_id",
                item_col: str = "track_uri_index", value_col: str | None = None) -> DataFrame:
    """(id, projections: array<double>) of sparse rows (id, item[, value = 1]): per hash table the
    dot product with its unit vector over the bucket length, by a join and a sum. Their
    floors are the hash values."""
    value = F.col(value_col).cast("double") if value_col else F.lit(1.0)
    sums = (entries.select(id_col, F.col(item_col).cast("int").alias("item"), value.alias("_v")).join(units, "item")
            .groupBy(id_col, "table").agg((F.sum(F.col("_v") * F.col("r")) / bucket_length).alias("_p")))
    return sums.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("table", "_p"))), lambda x: x["_p"]).alias("projections"))


def ann_single(model: BucketedRandomProjectionLSHModel, vectors: DataFrame, key,
               k: int = 1, user_col: str = "playlist_id") -> DataFrame:
    """Approximate k nearest rows of ``vectors`` to one key vector (user, distCol)."""
    return (model.approxNearestNeighbors(vectors, key, k)
            .select(user_col, F.round("distCol", 6).alias("distCol")))


def ann_tables(vectors: DataFrame, key, k: int, bucket_length: float, num_tables: int, seed: int = 7,
               user_col: str = "playlist_id") -> DataFrame:
    """``ann_single`` over many hash tables. A model holds a unit vector as long as the rows for each
    table, so the tables are fitted and searched in groups of bounded size, one after another: who
    shares a bucket in any table does so in one group's, and the nearest are among each group's k."""
    per_model = min(num_tables, max(1, MODEL_NUMBERS // key.size))
    found = {}
    for at in range(0, num_tables, per_model):
        model = fit_lsh(vectors, bucket_length, min(per_model, num_tables - at), seed + at)
        found.update((r[user_col], r["distCol"]) for r in ann_single(model, vectors, key, k, user_col).collect())
    nearest = sorted(found.items(), key=lambda r: r[1])[:k]
    return vectors.sparkSession.createDataFrame(nearest, f"{user_col} {vectors.schema[user_col].dataType.simpleString()}, distCol double")


def ann_with_fallback(model: BucketedRandomProjectionLSHModel, vectors: DataFrame, key,
                      key_items: DataFrame, existing: DataFrame, k: int = 1,
                      user_col: str = "playlist_id", item_col: str = "track_uri_index") -> DataFrame:
    """LSH neighbours of one key; when no bucket matches, the exact neighbours.

    The LSH rows (k at most) are looked at first; the exact search is only
    built and run when there are none.
    ``key_items``: (basket_id, item) rows of the key's basket.
    """
    spark = vectors.sparkSession
    near = ann_single(model, vectors, key, k, user_col)
    rows = near.select(F.col(user_col).alias("neighbor_id"), F.col("distCol").alias("distance")).collect()
    if rows:
        schema = f"neighbor_id {vectors.schema[user_col].dataType.simpleString()}, distance double"
        return spark.createDataFrame(rows, schema).withColumn("method", F.lit("lsh"))
    return knn_exact(key_items, existing, k, user_col=user_col, item_col=item_col).select(
        "neighbor_id", "distance", F.lit("exact").alias("method"))
