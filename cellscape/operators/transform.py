"""Matrix transforms: library-size normalisation, log, variable genes, scaling.

All per-gene statistics are zero-aware: only non-zero entries are stored, and the
implicit zeros are merged in closed form from the number of cells (parallel
variance merge), so no operator ever densifies the matrix except ``scale_clip``,
which by definition produces dense values and does so as one vector per cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscape.functions.windows import count_below_by_value
from cellscape.matrix import CountMatrix
from cellscape.session import cut_lineage


def normalize_total(m: CountMatrix, target_sum: float = 1e4) -> CountMatrix:
    """Scale each cell to ``target_sum``; cells with total 0 are left unchanged.

    Per-cell totals come from a partial + final aggregate and are joined back on
    ``cell_id`` (AQE splits a skewed cell partition; a window would not).
    """
    totals = m.expr.groupBy("cell_id").agg(F.sum("value").alias("_total"))
    e = m.expr.join(totals, "cell_id").select(
        "cell_id", "gene_id",
        F.when(F.col("_total") == 0, F.col("value"))
        .otherwise(F.col("value") * F.lit(float(target_sum)) / F.col("_total")).alias("value"),
    )
    return m.with_expr(e)


def log1p_transform(m: CountMatrix) -> CountMatrix:
    """Natural log(1 + x); zeros stay zero so the sparse form stays exact."""
    return m.with_expr(m.expr.withColumn("value", F.log1p("value")))


def normalize_log(m: CountMatrix, target_sum: float = 1e4) -> CountMatrix:
    return log1p_transform(normalize_total(m, target_sum))


def zero_aware_gene_stats(expr: DataFrame, n_cells: Column, value: Column | None = None) -> DataFrame:
    """Per gene: nnz, mean and sample variance over all ``n_cells`` cells (zeros implicit).

    Non-zero moments use Spark's stable central-moment aggregates; the zeros are
    merged as a second group with mean 0 and no spread:
    M2 = M2_nz + mean_nz^2 * nnz * n0 / N.
    """
    v = value if value is not None else F.col("value")
    g = expr.groupBy("gene_id").agg(
        F.count(F.lit(1)).alias("nnz"),
        F.avg(v).alias("_mean_nz"),
        F.var_pop(v).alias("_var_nz"),
    )
    n = n_cells.cast("double")
    n0 = n - F.col("nnz")
    m2 = F.col("_var_nz") * F.col("nnz") + F.col("_mean_nz") * F.col("_mean_nz") * F.col("nnz") * n0 / n
    return g.select(
        "gene_id", "nnz",
        (F.col("_mean_nz") * F.col("nnz") / n).alias("mean"),
        F.try_divide(m2, n - F.lit(1.0)).alias("var"),
    )


def _with_all_genes(genes: DataFrame, stats: DataFrame, n_cells: Column) -> DataFrame:
    """Genes with no entry get nnz 0, mean 0 and variance 0."""
    return (
        genes.select("gene_id").join(stats, "gene_id", "left")
        .fillna({"nnz": 0, "mean": 0.0})
        .withColumn("var", F.when(F.col("var").isNull() & (n_cells > 1), F.lit(0.0)).otherwise(F.col("var")))
    )


def hvg_dispersion(m: CountMatrix, n_top_genes: int = 2000, n_bins: int = 20, tie_digits: int = 9) -> DataFrame:
    """Highly variable genes, dispersion ("seurat") flavour, on log-normalised input.

    Per gene over all cells of expm1(x): mean and sample variance; mean 0 -> 1e-12;
    dispersion = var / mean with 0 -> missing; log dispersion and log1p mean; 20
    equal-width right-closed mean bins (pandas ``cut`` semantics); z-score inside the
    bin (a bin with one non-missing gene gets z = 1); flag z >= the ``n_top_genes``-th
    highest z (ties kept, missing never flagged).  z is rounded to ``tie_digits``
    decimals before the cut so that ties do not depend on summation order.

    Returns genes with means, dispersions, mean_bin, dispersions_norm, highly_variable.
    """
    n = m.n_cells()
    stats = _with_all_genes(m.genes, zero_aware_gene_stats(m.expr, n, F.expm1("value")), n)
    mean0 = F.when(F.col("mean") == 0, F.lit(1e-12)).otherwise(F.col("mean"))
    disp = F.col("var") / mean0
    # Pipeline break: the per-gene table (one row per gene) is written once to the
    # checkpoint folder, so the min/max/cut-off subqueries below read it, not the matrix.
    g = cut_lineage(stats.select(
        "gene_id",
        F.log1p(mean0).alias("means"),
        F.when(disp == 0, F.lit(None).cast("double")).otherwise(F.log(disp)).alias("dispersions"),
    ))
    lo = g.select(F.min("means")).scalar()
    hi = g.select(F.max("means")).scalar()
    width = (hi - lo) / F.lit(float(n_bins))
    g = g.withColumn(
        "mean_bin",
        F.when(width == 0, F.lit(1)).otherwise(
            F.greatest(F.lit(1), F.ceil((F.col("means") - lo) / width)).cast("int")
        ),
    )
    bins = g.groupBy("mean_bin").agg(
        F.avg("dispersions").alias("_avg"), F.stddev_samp("dispersions").alias("_dev"),
        F.count("dispersions").alias("_nd"),
    )
    # One non-missing gene in the bin: centre 0, spread = its own value, hence z = 1.
    bins = bins.select(
        "mean_bin",
        F.when(F.col("_nd") == 1, F.lit(0.0)).otherwise(F.col("_avg")).alias("_avg"),
        F.when(F.col("_nd") == 1, F.col("_avg")).otherwise(F.col("_dev")).alias("_dev"),
    )
    scale = float(10 ** tie_digits)
    z = F.try_divide(F.col("dispersions") - F.col("_avg"), F.col("_dev"))
    g = g.join(F.broadcast(bins), "mean_bin").withColumn(
        "dispersions_norm", F.round(z * F.lit(scale)) / F.lit(scale)
    ).drop("_avg", "_dev")
    g = g.withColumn("dispersions_norm", F.when(F.isnan("dispersions_norm"), None).otherwise(F.col("dispersions_norm")))
    # n-th highest z without a global window: a distributed top-n, then its minimum.
    top = g.where(F.col("dispersions_norm").isNotNull()).orderBy(F.desc("dispersions_norm")).limit(n_top_genes)
    cut = top.select(F.min("dispersions_norm")).scalar()
    return cut_lineage(g.withColumn("highly_variable", F.coalesce(F.col("dispersions_norm") >= cut, F.lit(False))))


def _nearest_span(points: DataFrame, anchors: DataFrame, share: float) -> DataFrame:
    """(anchor, at, span): distance from each anchor to its q-th nearest point, q = floor(share x points), 1 at least.

    The q nearest points are neighbours in the order of x, so the distance is the least, over all runs of q points, of that
    to the farther end.  Points are numbered by a bucketed rank; the runs are an equi-join of the numbers.
    """
    values = points.groupBy("x").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit(1))
    ranked = count_below_by_value(values, "all", "x", "n", "below")
    ordered = cut_lineage(ranked.select("x", F.explode(F.sequence(F.col("below"), F.col("below") + F.col("n") - 1)).alias("rank")))
    q = ordered.select(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) * F.lit(share) + F.lit(1e-5)))).scalar()
    runs = ordered.withColumn("last", F.col("rank") + q - 1).join(
        ordered.select(F.col("rank").alias("last"), F.col("x").alias("end")), "last").select("x", "end")
    farther = F.greatest(F.col("at") - F.col("x"), F.col("end") - F.col("at"), F.lit(0.0))
    return runs.join(F.broadcast(anchors)).groupBy("anchor", "at").agg(F.min(farther).alias("span"))


def local_quadratic(points: DataFrame, share: float = 0.3, n_anchors: int = 100) -> DataFrame:
    """``points(x, y, ...)`` with ``fitted``: a local quadratic regression of y on x.

    At ``n_anchors`` evenly spaced anchors, a quadratic is fitted to the nearest ``share`` of all points with tricube weights; its
    normal equations are partially aggregated sums and are solved in closed form.  Where they are singular (fewer
    than three distinct x carry weight) a line or the mean takes over.  Between anchors the fit is linear.
    """
    bounds = points.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    steps = F.lit(float(n_anchors - 1))
    anchors = bounds.where("lo is not null").select(F.explode(F.sequence(F.lit(0), F.lit(n_anchors - 1))).alias("anchor"), "lo", "hi").select(
        "anchor", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("anchor") / steps).alias("at"))
    spans = cut_lineage(_nearest_span(points, anchors, share))
    t = F.when(F.col("span") > 0, (F.col("x") - F.col("at")) / F.col("span")).otherwise(F.col("x") - F.col("at"))
    weight = F.when((F.col("span") == 0) & (t == 0), 1.0).when((F.col("span") > 0) & (F.abs(t) < 1), F.pow(1 - F.pow(F.abs(t), 3), 3))
    terms = points.join(F.broadcast(spans)).select("anchor", "y", t.alias("t"), weight.alias("w")).where("w > 0")
    power = lambda i: F.pow("t", F.lit(float(i)))
    sums = terms.groupBy("anchor").agg(*(F.sum(F.col("w") * power(i)).alias(f"s{i}") for i in range(5)),
                                       *(F.sum(F.col("w") * F.col("y") * power(i)).alias(f"r{i}") for i in range(3)))
    s = [F.col(f"s{i}") for i in range(5)]
    r = [F.col(f"r{i}") for i in range(3)]
    quadratic = s[0] * (s[2] * s[4] - s[3] * s[3]) - s[1] * (s[1] * s[4] - s[2] * s[3]) + s[2] * (s[1] * s[3] - s[2] * s[2])
    solved = r[0] * (s[2] * s[4] - s[3] * s[3]) - s[1] * (r[1] * s[4] - s[3] * r[2]) + s[2] * (r[1] * s[3] - s[2] * r[2])
    line = s[0] * s[2] - s[1] * s[1]
    value = (F.when(quadratic > 1e-9 * s[0] * s[2] * s[4], solved / quadratic)
             .when(line > 1e-9 * s[0] * s[2], (r[0] * s[2] - s[1] * r[1]) / line).otherwise(r[0] / s[0]))
    fits = cut_lineage(sums.select("anchor", value.alias("value")))
    lo, width = bounds.select("lo").scalar(), bounds.select((F.col("hi") - F.col("lo")) / steps).scalar()
    place = F.when(width > 0, (F.col("x") - lo) / width).otherwise(F.lit(0.0))
    left = F.least(F.floor(place), F.lit(n_anchors - 2)).cast("int")
    placed = points.withColumn("_p", place).withColumn("anchor", left)
    ends = fits.select((F.col("anchor") - 1).alias("anchor"), F.col("value").alias("_next"))
    return (placed.join(F.broadcast(fits), "anchor").join(F.broadcast(ends), "anchor")
            .withColumn("fitted", F.col("value") + (F.col("_p") - F.col("anchor")) * (F.col("_next") - F.col("value")))
            .drop("anchor", "_p", "value", "_next"))


def hvg_vst(m: CountMatrix, n_top_genes: int = 2000, span: float = 0.3, tie_digits: int = 9) -> DataFrame:
    """T4: highly variable genes, variance-stabilised ("seurat_v3") flavour, on counts.

    log10 variance is regressed on log10 mean over the genes that vary (``local_quadratic``); counts are clipped at
    mean + sqrt(N) x the expected deviation and standardised with it; genes are ranked by the variance of that, which
    is rounded to ``tie_digits`` decimals (ties: the smaller gene id).  Genes that don't vary get 0.

    Returns gene_id, means, variances, variances_norm, highly_variable_rank (from 0, null beyond
    ``n_top_genes``) and highly_variable.
    """
    n = m.n_cells()
    stats = cut_lineage(_with_all_genes(m.genes, zero_aware_gene_stats(m.expr, n), n))
    varying = stats.where("var > 0 and mean > 0").select(
        "gene_id", "mean", F.log10("mean").alias("x"), F.log10("var").alias("y"))
    cells = n.cast("double")
    expected = local_quadratic(varying, span).select("gene_id", "mean", F.sqrt(F.pow(F.lit(10.0), F.col("fitted"))).alias("dev"))
    expected = cut_lineage(expected.withColumn("clip", F.col("dev") * F.sqrt(cells) + F.col("mean")))
    clipped = (m.expr.join(expected.select("gene_id", "clip"), "gene_id").withColumn("value", F.least("value", "clip"))
               .groupBy("gene_id").agg(F.sum("value").alias("total"), F.sum(F.col("value") * F.col("value")).alias("squares")))
    spread = cells * F.col("mean") * F.col("mean") + F.col("squares") - 2 * F.col("mean") * F.col("total")
    scale = float(10 ** tie_digits)
    norm = expected.join(clipped, "gene_id").select("gene_id", (F.round(
        spread / ((cells - 1) * F.col("dev") * F.col("dev")) * F.lit(scale)) / F.lit(scale)).alias("variances_norm"))
    genes = cut_lineage(stats.join(norm, "gene_id", "left").select(
        "gene_id", F.col("mean").alias("means"), F.col("var").alias("variances"), F.coalesce("variances_norm", F.lit(0.0)).alias("variances_norm")))
    best = genes.orderBy(F.desc("variances_norm"), "gene_id").limit(n_top_genes)
    order = Window.orderBy(F.desc("variances_norm"), "gene_id")  # at most n_top_genes rows
    ranks = best.select("gene_id", (F.row_number().over(order) - 1).alias("highly_variable_rank"))
    return genes.join(ranks, "gene_id", "left").withColumn("highly_variable", F.col("highly_variable_rank").isNotNull())


def subset_hvg(m: CountMatrix, hvg: DataFrame) -> CountMatrix:
    """Keep only highly variable genes (the flagged set is bounded by n_top_genes)."""
    keep = hvg.where("highly_variable").select("gene_id")
    return m.restrict_genes(F.broadcast(keep))


def gene_mean_sd(m: CountMatrix) -> DataFrame:
    """Per gene mean and sample standard deviation over all cells; sd 0 -> 1."""
    n = m.n_cells()
    s = _with_all_genes(m.genes, zero_aware_gene_stats(m.expr, n), n)
    sd = F.sqrt(F.coalesce(F.col("var"), F.lit(0.0)))
    return s.select("gene_id", "mean", F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias("sd"))


def scale_clip(m: CountMatrix, max_value: float | None = 10.0, clip_low: bool = True, rows: int = 1000) -> DataFrame:
    """T5: per gene (x - mean) / sd, clipped at +-``max_value``, as one dense vector per cell.

    Returns ``(cell_id, v ARRAY<DOUBLE>)``; position i of ``v`` is the i-th gene in
    ascending ``gene_id`` order (see :func:`gene_order`).  The mean and sd of the genes kept (the
    HVG set) travel to the tasks, which fill blocks of ``rows`` cells from the vector of a cell without
    entries and the cells' own entries.  ``clip_low=False`` clips the upper side only, as older library versions did.
    """
    stats = gene_mean_sd(m).orderBy("gene_id").toPandas()  # one row per gene kept
    ids, mean, sd = (stats[c].to_numpy() for c in ("gene_id", "mean", "sd"))

    def clipped(z: np.ndarray) -> np.ndarray:
        if max_value is None:
            return z
        return np.clip(z, -max_value if clip_low else None, max_value)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        empty = clipped((0.0 - mean) / sd)
        for batch in batches:
            for at in range(0, len(batch), rows):
                pdf = batch.iloc[at:at + rows]
                block = np.tile(empty, (len(pdf), 1))
                for row, genes, values in zip(block, pdf["genes"], pdf["values"]):
                    if genes is not None:
                        place = np.searchsorted(ids, genes)
                        row[place] = clipped((values - mean[place]) / sd[place])
                yield pd.DataFrame({"cell_id": pdf["cell_id"].to_numpy(), "v": list(block)})

    own = m.expr.join(m.genes.select("gene_id"), "gene_id", "left_semi").groupBy("cell_id").agg(
        F.collect_list("gene_id").alias("genes"), F.collect_list("value").alias("values"))
    return m.cells.select("cell_id").join(own, "cell_id", "left").mapInPandas(fill, "cell_id long, v array<double>")


def gene_order(genes: DataFrame) -> DataFrame:
    """(pos, gene_id): 0-based position of each gene in a per-cell vector."""
    ids = genes.select(F.array_sort(F.collect_list("gene_id")).alias("ids"))
    return ids.select(F.posexplode("ids").alias("pos", "gene_id"))


def vectors_to_long(vec: DataFrame, order: DataFrame, col: str = "v") -> DataFrame:
    """Dense vectors back to long (cell_id, gene_id, value) rows; for checks on small data."""
    return (
        vec.select("cell_id", F.posexplode(col).alias("pos", "value"))
        .join(F.broadcast(order), "pos")
        .select("cell_id", "gene_id", "value")
    )
