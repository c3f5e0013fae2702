import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cellscape.session import local_session

    s = local_session("*", shuffle_partitions=8, app="cellscape-tests")
    yield s


def matrix(spark, triples, n_cells, n_genes, names=None, groups=None):
    """A tiny CountMatrix from (cell, gene, value) triples; zeros are dropped."""
    from cellscape.matrix import CountMatrix

    names = names or [f"g{i}" for i in range(n_genes)]
    groups = groups or ["a"] * n_cells
    cells = spark.createDataFrame([(i, groups[i]) for i in range(n_cells)], "cell_id long, group string")
    genes = spark.createDataFrame([(i, names[i]) for i in range(n_genes)], "gene_id long, gene_name string")
    expr = spark.createDataFrame([(c, g, float(v)) for c, g, v in triples if v != 0],
                                 "cell_id long, gene_id long, value double")
    return CountMatrix(cells=cells, genes=genes, expr=expr)


def dense_to_triples(X):
    return [(i, j, float(X[i][j])) for i in range(len(X)) for j in range(len(X[0])) if X[i][j] != 0]
