"""The sparse matrix contract shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CountMatrix:
    """A cells x genes matrix in long sparse form.

    cells: ``cell_id BIGINT`` plus any per-cell columns (group, truth label, QC metrics).
    genes: ``gene_id BIGINT, gene_name STRING`` plus per-gene columns.
    expr:  ``cell_id BIGINT, gene_id BIGINT, value DOUBLE``; only non-zero entries.

    Zeros are never materialised: operators that need them (means, variances,
    ranks) add their contribution in closed form from the cell count.
    """

    cells: DataFrame
    genes: DataFrame
    expr: DataFrame

    def with_expr(self, expr: DataFrame) -> "CountMatrix":
        return replace(self, expr=expr)

    def with_cells(self, cells: DataFrame) -> "CountMatrix":
        return replace(self, cells=cells)

    def with_genes(self, genes: DataFrame) -> "CountMatrix":
        return replace(self, genes=genes)

    def n_cells(self):
        """Number of cells as a scalar-subquery column (stays lazy, no driver round trip)."""
        return self.cells.select(F.count(F.lit(1))).scalar()

    def n_genes(self):
        return self.genes.select(F.count(F.lit(1))).scalar()

    def restrict_cells(self, keep: DataFrame) -> "CountMatrix":
        """Keep only cells whose id appears in ``keep`` (semi-joins, no column carry-over)."""
        ids = keep.select("cell_id")
        return CountMatrix(
            cells=self.cells.join(ids, "cell_id", "left_semi"),
            genes=self.genes,
            expr=self.expr.join(ids, "cell_id", "left_semi"),
        )

    def restrict_genes(self, keep: DataFrame) -> "CountMatrix":
        ids = keep.select("gene_id")
        return CountMatrix(
            cells=self.cells,
            genes=self.genes.join(ids, "gene_id", "left_semi"),
            expr=self.expr.join(ids, "gene_id", "left_semi"),
        )
