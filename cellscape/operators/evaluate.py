"""Cluster validity indices for every configuration at once, composite ranking, best pick.

Input: vectors ``(cell_id, v ARRAY<DOUBLE>)`` and long assignments
``(cell_id, method, cluster_key, cluster)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape.operators import labels as L
from cellscape.operators.neighbors import cluster_distance_means
from cellscape.session import cut_lineage

SQ_DIST = "aggregate(zip_with({a}, {b}, (p, q) -> (p - q) * (p - q)), 0D, (s, t) -> s + t)"


def sq_dist(a: str, b: str):
    return F.expr(SQ_DIST.format(a=a, b=b))


def silhouette_exact(vec: DataFrame, assignments: DataFrame, n_cells: int | None = None) -> DataFrame:
    """Mean silhouette per configuration, Euclidean, all cells, singletons score 0.

    a = mean distance to the other members of the own cluster, b = smallest mean
    distance to another cluster, s = (b - a) / max(a, b) (0 when both are 0).
    A configuration with fewer than 2 or as many clusters as cells gets NULL.
    """
    per_cell = cluster_distance_means(vec, assignments.select("cell_id", "cluster_key", "cluster"), n_cells)
    s = (
        F.when(F.coalesce(F.col("n_own"), F.lit(0)) == 0, F.lit(0.0))
        .when(F.greatest("a", "b") == 0, F.lit(0.0))
        .otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    )
    counts = L.cluster_counts(assignments).join(
        assignments.groupBy("cluster_key").agg(F.count(F.lit(1)).alias("_n")), "cluster_key"
    )
    score = per_cell.groupBy("cluster_key").agg(F.avg(s).alias("silhouette_score"))
    return counts.join(score, "cluster_key", "left").select(
        "cluster_key",
        F.when((F.col("n_clusters") >= 2) & (F.col("n_clusters") < F.col("_n")), F.col("silhouette_score"))
        .alias("silhouette_score"),
    )


def _spread(labelled: DataFrame, centroids: DataFrame) -> DataFrame:
    """Per row: distance and squared distance to its cluster centroid."""
    c = F.broadcast(centroids.select("cluster_key", "cluster", "centroid"))
    return labelled.join(c, ["cluster_key", "cluster"]).withColumn("_sq", sq_dist("v", "centroid")).withColumn(
        "_d", F.sqrt("_sq")
    )


def davies_bouldin_and_calinski(vec: DataFrame, assignments: DataFrame) -> DataFrame:
    """E3 + E4 for every configuration from one labelled pass.

    DBI: mean over clusters of max over others of (s_i + s_j) / d_ij, s = mean distance
    to the centroid; a zero centroid distance contributes 0; 0 when all spreads or all
    centroid distances are within 1e-8 of 0.
    CHI: [B / (k - 1)] / [W / (n - k)]; 1 when W = 0.
    The centroid table is bounded by (configurations x clusters) and is broadcast.
    """
    labelled = L.with_labels(vec, assignments)
    cents = cut_lineage(L.cluster_centroids(labelled))
    spread = _spread(labelled, cents)
    per_cluster = spread.groupBy("cluster_key", "cluster").agg(
        F.avg("_d").alias("s"), F.sum("_sq").alias("w")
    )
    overall = labelled.groupBy("cluster_key").agg(
        F.count(F.lit(1)).alias("n"),
    )
    # Global centroid = size-weighted mean of cluster centroids (bounded table).
    cl = cents.join(per_cluster, ["cluster_key", "cluster"])
    per_key = cl.groupBy("cluster_key").agg(
        F.collect_list(F.struct("cluster", "centroid", "size", "s", "w")).alias("cs"),
        F.count(F.lit(1)).alias("k"),
        F.sum("w").alias("W"),
    ).join(overall, "cluster_key")
    dim_mean = F.expr(
        "transform(cs[0].centroid, (x, i) -> aggregate(cs, 0D, (acc, c) -> acc + c.centroid[i] * c.size) / n)"
    )
    per_key = per_key.withColumn("g", dim_mean)
    b = F.expr("aggregate(cs, 0D, (acc, c) -> acc + c.size * " + SQ_DIST.format(a="c.centroid", b="g") + ")")
    dij = "sqrt(" + SQ_DIST.format(a="x.centroid", b="y.centroid") + ")"
    scores = F.expr(
        f"transform(cs, x -> aggregate(transform(cs, y -> CASE WHEN {dij} = 0 THEN 0D ELSE (x.s + y.s) / {dij} END),"
        " 0D, (a, b) -> greatest(a, b)))"
    )
    max_s = F.expr("aggregate(cs, 0D, (a, c) -> greatest(a, abs(c.s)))")
    max_d = F.expr(f"aggregate(cs, 0D, (a, x) -> greatest(a, aggregate(cs, 0D, (a2, y) -> greatest(a2, {dij}))))")
    dbi = F.when((max_s <= 1e-8) | (max_d <= 1e-8), F.lit(0.0)).otherwise(
        F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) / F.col("k")
    )
    chi = F.when(F.col("W") == 0, F.lit(1.0)).otherwise(
        (b * (F.col("n") - F.col("k"))) / (F.col("W") * (F.col("k") - F.lit(1.0)))
    )
    valid = (F.col("k") >= 2) & (F.col("k") < F.col("n"))
    return per_key.select(
        "cluster_key",
        F.col("k").alias("n_clusters"),
        F.when(valid, dbi).alias("davies_bouldin_index"),
        F.when(valid, chi).alias("calinski_harabasz_index"),
        F.col("W").alias("inertia"),
    )


def silhouette_scalable(vec: DataFrame, assignments: DataFrame) -> DataFrame:
    """Mean silhouette per configuration on squared Euclidean distances, all cells, no pairs.

    The mean squared distance of x to a cluster is |x - centroid|^2 plus the cluster's mean
    squared spread, so one linear pass per configuration gives a and b; the own cluster
    leaves x itself out (factor n / (n - 1)).  Singletons score 0, and a configuration with
    fewer than 2 or as many clusters as cells gets NULL.
    """
    labelled = L.with_labels(vec, assignments)
    cents = cut_lineage(L.cluster_centroids(labelled))
    spread = (labelled.join(cents.select("cluster_key", "cluster", "centroid"), ["cluster_key", "cluster"])
              .groupBy("cluster_key", "cluster").agg(F.avg(sq_dist("v", "centroid")).alias("spread")))
    per_key = cut_lineage(cents.join(spread, ["cluster_key", "cluster"]).groupBy("cluster_key").agg(
        F.collect_list(F.struct("cluster", "centroid", "size", "spread")).alias("cs"), F.sum("size").alias("n")))
    away = F.expr(f"transform(cs, c -> struct(c.cluster AS cluster, c.size AS size, "
                  f"{SQ_DIST.format(a='v', b='c.centroid')} + c.spread AS d))")
    ds = labelled.join(per_key, "cluster_key").select(
        "cluster_key", F.col("cluster").alias("own_cluster"), "n", away.alias("ds"))
    own = F.expr("filter(ds, c -> c.cluster = own_cluster)[0]")
    a = own["d"] * own["size"] / F.nullif(own["size"] - 1, F.lit(0))
    b = F.expr("array_min(transform(filter(ds, c -> c.cluster <> own_cluster), c -> c.d))")
    scored = ds.select("cluster_key", "n", F.size("ds").alias("k"), a.alias("a"), b.alias("b"))
    s = F.when(F.col("a").isNull() | (F.greatest("a", "b") == 0), F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest("a", "b"))
    valid = (F.col("k") >= 2) & (F.col("k") < F.col("n"))
    return scored.groupBy("cluster_key").agg(F.avg(F.when(valid, s)).alias("silhouette_score"))


def kmeans_inertia(vec: DataFrame, assignments: DataFrame) -> DataFrame:
    """Within-cluster sum of squared distances to the centroids, per configuration."""
    labelled = L.with_labels(vec, assignments)
    cents = L.cluster_centroids(labelled)
    return _spread(labelled, cents).groupBy("cluster_key").agg(F.sum("_sq").alias("inertia"))


def evaluate_all(vec: DataFrame, assignments: DataFrame, n_cells: int | None = None) -> DataFrame:
    """E5: n_clusters, silhouette, DBI, CHI per configuration; fewer than 2 clusters skipped.

    The result is bounded by the number of configurations and is written to the
    checkpoint folder so that ranking reads it, not the whole computation again.
    """
    methods = assignments.select("cluster_key", "method").distinct()
    dc = davies_bouldin_and_calinski(vec, assignments)
    sil = silhouette_exact(vec, assignments, n_cells)
    out = (
        dc.join(sil, "cluster_key").join(methods, "cluster_key")
        .where(F.col("n_clusters") >= 2)
        .select(
            "method", "cluster_key", F.col("n_clusters").cast("bigint").alias("n_clusters"),
            "silhouette_score", "davies_bouldin_index", "calinski_harabasz_index",
        )
    )
    return cut_lineage(out)


#: Indices of the composite score; for the last one smaller is better.
_INDICES = ("silhouette_score", "calinski_harabasz_index", "davies_bouldin_index")


def composite_score(ev: DataFrame) -> DataFrame:
    """Min-max each index across configurations (constant -> 0.5, DBI inverted), mean
    of the three; a missing index leaves the score missing.  Sorted by score descending,
    missing last, ties by cluster_key.  All ranges come from one aggregate of the table."""
    ranges = ev.agg(*(F.struct(F.min(c).alias("lo"), (F.max(c) - F.min(c)).alias("width")).alias(f"_{c}") for c in _INDICES))

    def place(c: str):
        share = (F.col(c) - F.col(f"_{c}.lo")) / F.nullif(F.col(f"_{c}.width"), F.lit(0.0))
        share = F.lit(1.0) - share if c == _INDICES[-1] else share
        return F.when(F.col(f"_{c}.width") == 0, F.lit(0.5)).otherwise(share)

    score = (place("silhouette_score") + place("davies_bouldin_index") + place("calinski_harabasz_index")) / F.lit(3.0)
    return (ev.join(F.broadcast(ranges))  # one row
            .withColumn("composite_score", score).drop(*(f"_{c}" for c in _INDICES))
            .orderBy(F.desc_nulls_last("composite_score"), "cluster_key"))


def recommend_best(ranked: DataFrame) -> DataFrame:
    """The first row of the ranking (empty when nothing was evaluable)."""
    return ranked.orderBy(F.desc_nulls_last("composite_score"), "cluster_key").limit(1)


def silhouette_bars(ranked: DataFrame) -> DataFrame:
    """Silhouette per configuration in ranked order, with a colour index per method."""
    from pyspark.sql import Window

    w_rank = Window.orderBy(F.desc_nulls_last("composite_score"), "cluster_key")
    w_col = Window.orderBy("method")
    return ranked.select(
        F.row_number().over(w_rank).alias("position"), "method", "cluster_key", "silhouette_score",
        (F.dense_rank().over(w_col) - 1).alias("color_index"),
    )
