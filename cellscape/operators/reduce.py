"""Dimension reduction: PCA scores, variance ratios, component slicing.

Vectors are ``(cell_id, v ARRAY<DOUBLE>)``; MLlib vectors appear only at the MLlib
boundary.  MLlib's PCA builds the d x d covariance with a distributed tree
aggregate (d = genes kept, bounded), so the cost per pass is linear in cells.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def center(vec: DataFrame) -> DataFrame:
    """Subtract the column means (one aggregate; the mean vector is bounded by d)."""
    mu = vec.select(vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("mu")).scalar()
    return vec.withColumn("_mu", mu).withColumn("v", F.zip_with("v", "_mu", lambda a, b: a - b)).drop("_mu")


def pca(vec: DataFrame, n_comps: int = 50, n_cells: int | None = None, dim: int | None = None):
    """D1 + D2: principal-component scores of the centred vectors.

    ``n_comps`` is clamped to min(cells - 1, d).  Each component's sign is fixed so that
    its largest-magnitude loading is positive.  Returns
    (scores(cell_id, v), variance(pc, variance_ratio), loadings(pc, loading ARRAY)).
    """
    if n_cells is None:
        n_cells = vec.count()
    if dim is None:
        dim = len(vec.select("v").first()[0])
    k = max(1, min(n_comps, n_cells - 1, dim))
    c = center(vec).select("cell_id", array_to_vector("v").alias("features"))
    model = PCA(k=k, inputCol="features", outputCol="pcs").fit(c)
    comps = model.pc.toArray()  # d x k, bounded by genes kept x components
    idx = np.argmax(np.abs(comps), axis=0)
    signs = np.sign(comps[idx, np.arange(k)])
    signs[signs == 0] = 1.0
    comps = comps * signs
    spark = vec.sparkSession
    loads = spark.createDataFrame(
        [(i, [float(x) for x in comps[:, i]]) for i in range(k)], "pc int, loading array<double>")
    ratios = spark.createDataFrame(
        [(i, float(r)) for i, r in enumerate(model.explainedVariance.toArray())], "pc int, variance_ratio double")
    # Scores: MLlib's projection (JVM BLAS) of the centred vectors, then the sign fix.
    sign_arr = F.array(*[F.lit(float(x)) for x in signs])
    scores = model.transform(c).select(
        "cell_id", F.zip_with(vector_to_array("pcs"), sign_arr, lambda a, b: a * b).alias("v"))
    return scores, ratios, loads


def total_variance(vec: DataFrame) -> DataFrame:
    """Sum over dimensions of the sample variance (the denominator of every variance ratio)."""
    return vec.select(
        F.aggregate(vector_to_array(Summarizer.variance(array_to_vector("v"))), F.lit(0.0),
                    lambda a, x: a + x).alias("total_variance"))


def slice_pcs(vec: DataFrame, n: int = 30) -> DataFrame:
    """Keep the first ``n`` components."""
    return vec.withColumn("v", F.slice("v", 1, n))


def scree_table(ratios: DataFrame) -> DataFrame:
    """(pc 1-based, variance ratio, cumulative ratio) - bounded by the component count."""
    from pyspark.sql import Window

    w = Window.orderBy("pc").rowsBetween(Window.unboundedPreceding, 0)
    return ratios.select((F.col("pc") + 1).alias("pc"), "variance_ratio",
                         F.sum("variance_ratio").over(w).alias("cumulative_ratio"))
