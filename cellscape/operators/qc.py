"""Quality control: gene flags, unique names, per-cell and per-gene metrics, cell filters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape.functions.numeric import safe_div
from cellscape.functions.windows import row_number_by_unique_key, sum_below_int_key
from cellscape.matrix import CountMatrix

# Fixed value: mitochondrial gene name prefix, compared on the upper-cased name.
MITO_PREFIX = "MT-"


def flag_mito_genes(genes: DataFrame, prefix: str = MITO_PREFIX, name_col: str = "gene_name") -> DataFrame:
    """``mt`` = upper(name) starts with ``prefix``."""
    return genes.withColumn("mt", F.upper(F.col(name_col)).startswith(prefix))


def unique_gene_names(genes: DataFrame, sep: str = "-", name_col: str = "gene_name") -> DataFrame:
    """Make names unique in gene-id order.

    The first occurrence keeps its name.  The j-th repeat of a name gets the j-th
    number n >= 1 such that ``name + sep + n`` is not already an original name.
    Collisions are the original names that parse as ``base-sep-n``; with them sorted
    per base as c_1 < c_2 < ..., the answer is n = j + #{i : c_i - i < j}.
    The occurrence number comes from a bucketed row number, so a name shared by a
    large share of all genes is still split over many tasks.
    """
    occ = row_number_by_unique_key(genes.select("gene_id", name_col), [name_col], "gene_id", out="occ")
    occ = occ.withColumn("j", F.col("occ") - 1)
    esc = sep.replace("\\", "\\\\")
    pattern = f"^(.*){esc}([1-9][0-9]*)$"
    collisions = (
        genes.select(name_col)
        .where(F.col(name_col).rlike(pattern))
        .select(
            F.regexp_extract(name_col, pattern, 1).alias("base"),
            F.regexp_extract(name_col, pattern, 2).cast("bigint").alias("c"),
        )
        .distinct()
    )
    # c_i - i is non-decreasing in i; a bucketed row number keeps hot bases spread out.
    collisions = row_number_by_unique_key(collisions, ["base"], "c", out="i").select(
        "base", (F.col("c") - F.col("i")).alias("free_below")
    )
    dups = occ.where(F.col("j") > 0)
    # k = #{collisions with free_below < j}: collisions are pre-counted per distinct
    # free_below, then one bucketed "sum over smaller keys" pass over both row kinds.
    coll_w = collisions.groupBy("base", F.col("free_below").alias("key")).agg(
        F.count(F.lit(1)).alias("w")
    ).withColumn("gene_id", F.lit(None).cast("bigint"))
    dup_rows = dups.select(
        F.col(name_col).alias("base"), F.col("j").alias("key"), F.lit(0).cast("bigint").alias("w"), "gene_id"
    )
    counted = sum_below_int_key(dup_rows.unionByName(coll_w), ["base"], "key", "w", "k")
    renamed = counted.where(F.col("gene_id").isNotNull()).select(
        "gene_id", (F.col("key") + F.col("k")).alias("suffix")
    )
    return (
        genes.join(renamed, "gene_id", "left")
        .withColumn(
            "gene_unique",
            F.when(F.col("suffix").isNull(), F.col(name_col)).otherwise(
                F.concat(F.col(name_col), F.lit(sep), F.col("suffix").cast("string"))
            ),
        )
        .drop("suffix")
    )


def attach_gene_flags(expr: DataFrame, genes: DataFrame, flags: list[str]) -> DataFrame:
    """Expression entries joined to per-gene flags (dimension side; AQE picks broadcast)."""
    return expr.join(genes.select("gene_id", *flags), "gene_id")


def cell_qc_metrics(m: CountMatrix, qc_var: str = "mt") -> DataFrame:
    """A1: per cell n_genes_by_counts, total_counts, total_counts_<qc>, pct_counts_<qc>.

    One partial + final hash aggregate over ``expr``; cells without entries get zeros
    (and a NULL percentage, since 0/0 is undefined).
    """
    e = attach_gene_flags(m.expr, m.genes, [qc_var])
    agg = e.groupBy("cell_id").agg(
        F.count_if(F.col("value") != 0).alias("n_genes_by_counts"),
        F.sum("value").alias("total_counts"),
        F.sum(F.when(F.col(qc_var), F.col("value")).otherwise(F.lit(0.0))).alias(f"total_counts_{qc_var}"),
    )
    out = m.cells.join(agg, "cell_id", "left").fillna(
        {"n_genes_by_counts": 0, "total_counts": 0.0, f"total_counts_{qc_var}": 0.0}
    )
    return out.withColumn(
        f"pct_counts_{qc_var}",
        safe_div(F.col(f"total_counts_{qc_var}") * F.lit(100.0), F.col("total_counts")),
    )


def gene_qc_metrics(m: CountMatrix) -> DataFrame:
    """A2: per gene n_cells_by_counts, mean_counts, total_counts, pct_dropout_by_counts."""
    n = m.n_cells()
    agg = m.expr.groupBy("gene_id").agg(
        F.count_if(F.col("value") != 0).alias("n_cells_by_counts"),
        F.sum("value").alias("total_counts"),
    )
    return (
        m.genes.join(agg, "gene_id", "left")
        .fillna({"n_cells_by_counts": 0, "total_counts": 0.0})
        .withColumn("mean_counts", F.col("total_counts") / n)
        .withColumn("pct_dropout_by_counts", (F.lit(1.0) - F.col("n_cells_by_counts") / n) * F.lit(100.0))
    )


@dataclass(frozen=True)
class QCThresholds:
    min_genes: int = 200
    max_genes: int = 5000
    max_pct_mito: float = 20.0


def qc_keep_condition(t: QCThresholds, qc_var: str = "mt"):
    """P3 & P4 & P5 as one predicate; NULL percentage (empty cell) drops the cell."""
    return (
        (F.col("n_genes_by_counts") >= t.min_genes)
        & (F.col("n_genes_by_counts") <= t.max_genes)
        & F.coalesce(F.col(f"pct_counts_{qc_var}") <= F.lit(float(t.max_pct_mito)), F.lit(False))
    )


def filter_min_genes(qc: DataFrame, min_genes: int) -> DataFrame:
    """n_genes_by_counts >= min_genes (inclusive)."""
    return qc.where(F.col("n_genes_by_counts") >= min_genes)


def filter_max_genes(qc: DataFrame, max_genes: int) -> DataFrame:
    """n_genes_by_counts <= max_genes (inclusive)."""
    return qc.where(F.col("n_genes_by_counts") <= max_genes)


def filter_max_pct_mito(qc: DataFrame, max_pct: float, qc_var: str = "mt") -> DataFrame:
    """P5: pct_counts_mt <= max_pct (inclusive); an empty cell (NULL %) is dropped."""
    return qc.where(F.col(f"pct_counts_{qc_var}") <= F.lit(float(max_pct)))


def quality_control(m: CountMatrix, t: QCThresholds, prefix: str = MITO_PREFIX) -> tuple[CountMatrix, DataFrame]:
    """Unique names, mito flag, cell metrics, then the three filters in one predicate.

    Returns the filtered matrix (cells carry their QC columns) and the metrics of all cells.
    Gene metrics (A2) are taken before filtering, as the workload does.
    """
    genes = flag_mito_genes(unique_gene_names(m.genes), prefix)
    m = m.with_genes(genes)
    qc = cell_qc_metrics(m)
    kept = qc.where(qc_keep_condition(t))
    return CountMatrix(cells=kept, genes=genes, expr=m.expr.join(kept.select("cell_id"), "cell_id", "left_semi")), qc


def qc_filter_report(qc: DataFrame, t: QCThresholds) -> DataFrame:
    """Cells before, after and removed, in one conditional aggregate."""
    keep = qc_keep_condition(t)
    return qc.agg(
        F.count(F.lit(1)).alias("n_before"),
        F.count_if(keep).alias("n_after"),
    ).withColumn("n_removed", F.col("n_before") - F.col("n_after"))
