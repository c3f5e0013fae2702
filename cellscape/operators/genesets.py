"""Gene-set scores and cell-cycle phase (T6, T7) and gene-list overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellscape.functions.windows import count_below_by_value
from cellscape.matrix import CountMatrix
from cellscape.session import cut_lineage


def gene_set_overlap(genes: DataFrame, gene_sets: dict[str, list[str]], name_col: str = "gene_name") -> DataFrame:
    """(gene_set, gene_name, present) - list genes found among the matrix genes
    (semi join) and missing ones (anti join).  The lists are bounded driver-side values."""
    spark = genes.sparkSession
    lists = spark.createDataFrame([(s, g) for s, gs in gene_sets.items() for g in gs], "gene_set string, gene_name string")
    names = genes.select(F.col(name_col).alias("gene_name"))
    present = lists.join(names, "gene_name", "left_semi").withColumn("present", F.lit(True))
    missing = lists.join(names, "gene_name", "left_anti").withColumn("present", F.lit(False))
    return present.unionByName(missing).select("gene_set", "gene_name", "present")


def gene_set_score(m: CountMatrix, gene_list: list[str], ctrl_size: int = 50, n_bins: int = 25, seed: str = "0",
                   name_col: str = "gene_name") -> tuple[DataFrame, DataFrame]:
    """Per cell, mean of the list genes minus mean of expression-matched controls.

    Genes are ranked by their average over all cells (zeros included); bin =
    floor(min-rank / round_half_even(G / (n_bins - 1))).  In every bin that holds a
    list gene, the first ``ctrl_size`` genes by md5(name || seed) are controls (this
    replaces the random shuffle and is reproducible in SQL); list genes are then
    removed from the controls.  Returns (scores(cell_id, score), weights(gene_id, w)).
    """
    spark = m.expr.sparkSession
    n = m.n_cells()
    avg = m.genes.select("gene_id", F.col(name_col).alias("name")).join(
        m.expr.groupBy("gene_id").agg(F.sum("value").alias("s")), "gene_id", "left"
    ).select("gene_id", "name", (F.coalesce("s", F.lit(0.0)) / n).alias("avg"))
    g = avg.select(F.count(F.lit(1))).scalar()
    n_items = F.bround(g / F.lit(float(n_bins - 1)), 0)
    avg = cut_lineage(avg)
    values = avg.groupBy("avg").agg(F.count(F.lit(1)).alias("c")).withColumn("all", F.lit(1))
    ranks = count_below_by_value(values, "all", "avg", "c").select("avg", (F.col("below") + 1).alias("rk"))
    ranked = cut_lineage(avg.join(ranks, "avg").withColumn("bin", F.floor(F.col("rk") / n_items)))
    lst = spark.createDataFrame([(x,) for x in gene_list], "name string")
    in_list = ranked.join(lst, "name", "left_semi")
    bins = in_list.select("bin").distinct()
    pick = ranked.join(bins, "bin", "left_semi").withColumn(
        "o", F.row_number().over(Window.partitionBy("bin").orderBy(F.md5(F.concat("name", F.lit(seed))), "gene_id")))
    ctrl = pick.where(F.col("o") <= ctrl_size).join(lst, "name", "left_anti").select("gene_id")
    n_list = in_list.select(F.count(F.lit(1))).scalar()
    n_ctrl = ctrl.select(F.count(F.lit(1))).scalar()
    weights = in_list.select("gene_id", (F.lit(1.0) / n_list).alias("w")).unionByName(
        ctrl.select("gene_id", (F.lit(-1.0) / n_ctrl).alias("w")))
    # Per-cell sums over a bounded gene -> weight table (list + controls).
    s = m.expr.join(F.broadcast(weights), "gene_id").groupBy("cell_id").agg(F.sum(F.col("w") * F.col("value")).alias("s"))
    scores = m.cells.select("cell_id").join(s, "cell_id", "left").select(
        "cell_id", F.coalesce("s", F.lit(0.0)).alias("score"))
    return scores, weights


def cell_cycle_phase(m: CountMatrix, s_genes: list[str], g2m_genes: list[str], seed: str = "0") -> DataFrame:
    """S and G2M scores (controls per bin = size of the shorter list) and the phase:
    G2M when G2M > S, else S; G1 when both are negative."""
    size = min(len(s_genes), len(g2m_genes))
    s, _ = gene_set_score(m, s_genes, ctrl_size=size, seed=seed)
    g2m, _ = gene_set_score(m, g2m_genes, ctrl_size=size, seed=seed)
    j = s.select("cell_id", F.col("score").alias("S_score")).join(
        g2m.select("cell_id", F.col("score").alias("G2M_score")), "cell_id")
    phase = (F.when((F.col("S_score") < 0) & (F.col("G2M_score") < 0), F.lit("G1"))
             .when(F.col("G2M_score") > F.col("S_score"), F.lit("G2M")).otherwise(F.lit("S")))
    return j.withColumn("phase", phase)


def regress_out(vec: DataFrame, covariates: DataFrame, names=("S_score", "G2M_score")) -> DataFrame:
    """Per gene OLS residual of the dense per-cell vectors on [1, covariates].

    X'X (3 x 3) and X'y (3 x genes) come from one pass of vector sums (partially
    aggregated); the solve is done on the bounded 3 x genes table; residuals are
    computed per cell with ``zip_with``.  Returns (cell_id, v)."""
    import numpy as np
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    a, b = names
    d = vec.join(covariates.select("cell_id", a, b), "cell_id")
    sums = d.select(
        F.count(F.lit(1)).alias("n"), F.sum(a).alias("sa"), F.sum(b).alias("sb"),
        F.sum(F.col(a) * F.col(a)).alias("saa"), F.sum(F.col(a) * F.col(b)).alias("sab"),
        F.sum(F.col(b) * F.col(b)).alias("sbb"),
        vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("y1"),
        vector_to_array(Summarizer.sum(array_to_vector(F.transform("v", lambda x: x * F.col(a))))).alias("ya"),
        vector_to_array(Summarizer.sum(array_to_vector(F.transform("v", lambda x: x * F.col(b))))).alias("yb"),
    ).first()
    xtx = np.array([[sums.n, sums.sa, sums.sb], [sums.sa, sums.saa, sums.sab], [sums.sb, sums.sab, sums.sbb]], float)
    xty = np.vstack([sums.y1, sums.ya, sums.yb])
    beta = np.linalg.lstsq(xtx, xty, rcond=None)[0]  # 3 x genes; collinear scores share their effect
    b0, b1, b2 = ([float(x) for x in row] for row in beta)
    out = d.withColumn("_b", F.arrays_zip(F.lit(b0).alias("c0"), F.lit(b1).alias("c1"), F.lit(b2).alias("c2")))
    res = F.zip_with("v", "_b", lambda y, c: y - (c["c0"] + c["c1"] * F.col(a) + c["c2"] * F.col(b)))
    return out.select("cell_id", res.alias("v"))
