"""Operators over cluster assignments kept long: (cell_id, method, cluster_key, cluster).

A sweep of many configurations is a set of rows, not of columns, so every
per-configuration statistic is one grouped job over all configurations at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer


def attach_labels(cells: DataFrame, assignments: DataFrame) -> DataFrame:
    """Labels aligned to cells by ``cell_id`` (inner equi-join; AQE picks the strategy)."""
    return cells.join(assignments, "cell_id")


def labels_by_cell(assignments: DataFrame) -> DataFrame:
    """One row per cell with a map cluster_key -> cluster (bounded by the number of configurations)."""
    return assignments.groupBy("cell_id").agg(
        F.map_from_entries(F.collect_list(F.struct("cluster_key", "cluster"))).alias("labs")
    )


def with_labels(vec: DataFrame, assignments: DataFrame) -> DataFrame:
    """(cell_id, cluster_key, cluster, v): each vector joined once to its cell's label map and
    exploded after the join, so the shuffle moves one row per cell, not one per configuration."""
    return vec.select("cell_id", "v").join(labels_by_cell(assignments), "cell_id").select(
        "cell_id", "v", F.explode("labs").alias("cluster_key", "cluster")
    )


def cluster_counts(assignments: DataFrame) -> DataFrame:
    """A3: number of distinct clusters per configuration."""
    return assignments.groupBy("cluster_key").agg(F.countDistinct("cluster").alias("n_clusters"))


def cluster_sizes(assignments: DataFrame) -> DataFrame:
    """A4: cells per cluster per configuration."""
    return assignments.groupBy("cluster_key", "cluster").agg(F.count(F.lit(1)).alias("size"))


def cluster_centroids(labelled: DataFrame) -> DataFrame:
    """A5: mean vector and size per (cluster_key, cluster), partially aggregated map-side."""
    return labelled.groupBy("cluster_key", "cluster").agg(
        vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("centroid"),
        F.count(F.lit(1)).alias("size"),
    )


def relabel_by_size(assignments: DataFrame) -> DataFrame:
    """Clusters renumbered 0.. by decreasing size (ties by smallest member id).

    Returns the mapping (cluster_key, cluster, size, new_cluster); the mapping has one
    row per cluster, so ranking it per configuration is a bounded window.
    """
    sizes = assignments.groupBy("cluster_key", "cluster").agg(
        F.count(F.lit(1)).alias("size"), F.min("cell_id").alias("_first")
    )
    w = Window.partitionBy("cluster_key").orderBy(F.desc("size"), "_first")
    return sizes.withColumn("new_cluster", (F.row_number().over(w) - 1).cast("int")).drop("_first")


def confusion_counts(truth: DataFrame, pred: DataFrame) -> DataFrame:
    """Crosstab truth x predicted over the full label grid (missing pairs are 0).

    ``truth`` and ``pred`` are (cell_id, label STRING).  The grid is every distinct truth
    label times every distinct predicted label; the predicted label list is bounded by
    the number of clusters and is expanded per truth label without a join.
    """
    pairs = truth.select("cell_id", F.col("label").alias("truth")).join(
        pred.select("cell_id", F.col("label").alias("pred")), "cell_id"
    )
    counts = pairs.groupBy("truth", "pred").agg(F.count(F.lit(1)).alias("n"))
    pred_list = pred.select(F.array_sort(F.collect_set("label")).alias("p")).scalar()
    grid = truth.select(F.col("label").alias("truth")).distinct().select(
        "truth", F.explode(pred_list).alias("pred")
    )
    return grid.join(counts, ["truth", "pred"], "left").select(
        "truth", "pred", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def cluster_purity(confusion: DataFrame) -> DataFrame:
    """Confusion counts divided by the truth-row total (an empty row divides by 1)."""
    totals = confusion.groupBy("truth").agg(F.sum("n").alias("_tot"))
    return confusion.join(totals, "truth").select(
        "truth", "pred", "n", (F.col("n") / F.greatest(F.col("_tot"), F.lit(1))).alias("fraction")
    )


#: The cell columns that may hold a true label, in order of preference.
TRUTH_COLUMNS = ["cell_type", "celltype", "label", "labels", "ground_truth"]


def config_key(method: str, kind: str, parameter: Column) -> Column:
    """P10: the name of a configuration: method, ``res`` or ``k``, and the parameter's value."""
    return F.concat(F.lit(f"{method}_{kind}"), parameter.cast("string"))


def parsed_parameter(key: Column, kind: str = "res") -> Column:
    """P10: the parameter behind the first ``kind`` of a configuration's name as a double, null if it is none."""
    return F.split_part(key, F.lit(kind), F.lit(2)).try_cast("double")


def truth_labels(cells: DataFrame) -> DataFrame | None:
    """(truth_column, cell_id, truth) from the first of TRUTH_COLUMNS that the cells have, None without any."""
    column = next((c for c in TRUTH_COLUMNS if c in cells.columns), None)
    if column is None:
        return None
    return cells.select(F.lit(column).alias("truth_column"), "cell_id", F.col(column).cast("string").alias("truth"))


def method_counts(assignments: DataFrame) -> DataFrame:
    """Configurations per method, and over all methods under the name ``total``."""
    per = assignments.groupBy("method").agg(F.countDistinct("cluster_key").alias("n_configurations"))
    return per.unionByName(per.select(F.lit("total").alias("method"), F.coalesce(F.sum("n_configurations"), F.lit(0)).alias("n_configurations")))
