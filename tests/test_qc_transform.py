import math

import numpy as np
from pyspark.sql import functions as F

from conftest import dense_to_triples, matrix
from cellscape.operators import qc
from cellscape.operators import transform as T


def test_unique_names_with_colliding_suffix(spark):
    # m4: names A, A, A-1, A -> the first repeat skips A-1 (an existing name)
    genes = spark.createDataFrame([(0, "A"), (1, "A"), (2, "A-1"), (3, "A")], "gene_id long, gene_name string")
    got = {r.gene_id: r.gene_unique for r in qc.unique_gene_names(genes).collect()}
    assert got == {0: "A", 1: "A-2", 2: "A-1", 3: "A-3"}


def test_unique_names_many_collisions(spark):
    names = ["B", "B-1", "B-2", "B", "B-4", "B", "B", "C"]
    genes = spark.createDataFrame(list(enumerate(names)), "gene_id long, gene_name string")
    got = {r.gene_id: r.gene_unique for r in qc.unique_gene_names(genes).collect()}
    # reference rule, step by step: repeats of B get 3, 5, 6 (1, 2, 4 are taken)
    assert [got[i] for i in range(8)] == ["B", "B-1", "B-2", "B-3", "B-4", "B-5", "B-6", "C"]


def test_cell_qc_zero_cell_and_mito(spark):
    # m1: 4 cells x 3 genes, cell 3 empty; gene 0 is mitochondrial
    X = [[1, 2, 0], [0, 0, 5], [4, 0, 4], [0, 0, 0]]
    m = matrix(spark, dense_to_triples(X), 4, 3, names=["MT-CO1", "ACTB", "mt-nd2"])
    m = m.with_genes(qc.flag_mito_genes(m.genes))
    got = {r.cell_id: r for r in qc.cell_qc_metrics(m).collect()}
    assert got[0].n_genes_by_counts == 2 and got[0].total_counts == 3.0
    assert abs(got[0].pct_counts_mt - 100 / 3) < 1e-12
    assert abs(got[1].pct_counts_mt - 100.0) < 1e-12  # mt-nd2 is mitochondrial (upper-cased)
    assert got[3].n_genes_by_counts == 0 and got[3].pct_counts_mt is None
    kept = qc.qc_filter_report(qc.cell_qc_metrics(m), qc.QCThresholds(1, 5, 60.0)).first()
    # cell 2 is all mitochondrial (genes 0 and 2), cell 1 too, cell 3 is empty
    assert (kept.n_before, kept.n_after, kept.n_removed) == (4, 1, 3)


def test_normalize_zero_total_unchanged(spark):
    m = matrix(spark, [(0, 0, 2.0), (0, 1, 2.0), (1, 1, 3.0)], 3, 2)
    got = {(r.cell_id, r.gene_id): r.value for r in T.normalize_total(m, 10.0).expr.collect()}
    assert got == {(0, 0): 5.0, (0, 1): 5.0, (1, 1): 10.0}


def _dense(m, n_cells, n_genes):
    X = np.zeros((n_cells, n_genes))
    for r in m.expr.collect():
        X[r.cell_id, r.gene_id] = r.value
    return X


def test_scale_constant_gene_sd_one_and_clip(spark):
    # m2: 5 cells x 3 genes, gene 2 constant
    X = np.array([[1, 0, 2], [3, 1, 2], [0, 0, 2], [50, 2, 2], [1, 0, 2]], dtype=float)
    m = matrix(spark, dense_to_triples(X.tolist()), 5, 3)
    vec = {r.cell_id: r.v for r in T.scale_clip(m, max_value=1.5).collect()}
    mu, sd = X.mean(0), X.std(0, ddof=1)
    sd[sd == 0] = 1
    Z = np.clip((X - mu) / sd, -1.5, 1.5)
    for i in range(5):
        assert np.allclose(vec[i], Z[i], atol=1e-12)
    assert all(v[2] == 0.0 for v in vec.values())


def test_hvg_dispersion_against_numpy(spark):
    rng = np.random.default_rng(3)
    n_cells, n_genes = 40, 30
    X = rng.poisson(rng.uniform(0.05, 3, size=n_genes), size=(n_cells, n_genes)).astype(float)
    X[:, 5] = 0.0           # all-zero gene -> missing dispersion
    X[:, 6] = 1.0           # constant gene -> dispersion 0 -> missing
    m = T.log1p_transform(T.normalize_total(matrix(spark, dense_to_triples(X.tolist()), n_cells, n_genes), 1e4))
    Xl = _dense(m, n_cells, n_genes)
    h = {r.gene_id: r for r in T.hvg_dispersion(m, n_top_genes=8).collect()}
    # numpy restatement of the dispersion flavour
    Y = np.expm1(Xl)
    mean = Y.mean(0)
    var = Y.var(0, ddof=1)
    mean[mean == 0] = 1e-12
    disp = var / mean
    disp[disp == 0] = np.nan
    disp = np.log(disp)
    means = np.log1p(mean)
    lo, hi = means.min(), means.max()
    edges = np.linspace(lo, hi, 21)
    edges[0] -= (hi - lo) * 0.001
    b = np.searchsorted(edges, means, side="left")
    b[b == 0] = 1
    z = np.full(n_genes, np.nan)
    for k in np.unique(b):
        idx = np.where(b == k)[0]
        d = disp[idx]
        ok = ~np.isnan(d)
        if ok.sum() == 1:
            avg, dev = 0.0, d[ok].mean()
        else:
            avg, dev = np.nanmean(d), np.nanstd(d, ddof=1) if ok.sum() > 1 else np.nan
        z[idx] = (d - avg) / dev
    zs = np.where(np.isnan(z), -np.inf, z)
    cut = np.sort(zs[~np.isnan(z)])[::-1][7]
    for g in range(n_genes):
        assert h[g].mean_bin == b[g]
        if np.isnan(z[g]):
            assert h[g].dispersions_norm is None and not h[g].highly_variable
        else:
            assert abs(h[g].dispersions_norm - z[g]) < 1e-8
            assert h[g].highly_variable == (zs[g] >= cut - 1e-9)
    assert sum(r.highly_variable for r in h.values()) >= 8


def test_hvg_single_gene_bin_gets_z_one(spark):
    # m3: one gene far above the rest sits alone in the top mean bin
    X = np.array([[1, 2, 1, 0, 0, 900], [0, 1, 2, 1, 0, 1000], [2, 0, 1, 1, 1, 800], [1, 1, 0, 2, 1, 950]], float)
    m = T.log1p_transform(matrix(spark, dense_to_triples(X.tolist()), 4, 6))
    h = {r.gene_id: r for r in T.hvg_dispersion(m, n_top_genes=2).collect()}
    assert h[5].mean_bin == 20 and abs(h[5].dispersions_norm - 1.0) < 1e-9


def test_regress_out_reads_its_entries_from_one_written_table(spark, tmp_path):
    # Every reader of the matrix derived it from lineitem again.
    from cellscape.plans import registry as R

    names = [*R.S_LIST, *R.G2M_LIST, "other a", "other b"]
    tables = {
        "customer": ([(i, "m") for i in range(12)], "c_custkey long, c_mktsegment string"),
        "part": (list(enumerate(names)), "p_partkey long, p_name string"),
        "orders": ([(i, i % 12) for i in range(60)], "o_orderkey long, o_custkey long"),
        "lineitem": ([(i, (i * 7 + j) % len(names), float(j + 1)) for i in range(60) for j in range(4)], "l_orderkey long, l_partkey long, l_quantity double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    m = R.f2(spark, str(tmp_path))
    assert any("lineitem" in f for f in m.expr.inputFiles())
    sub, _ = R.f2_preprocessed(spark, str(tmp_path))
    assert not any("lineitem" in f for f in sub.expr.inputFiles())
    assert sorted(map(tuple, R.f2_written(spark, str(tmp_path)).expr.collect())) == sorted(map(tuple, m.expr.collect()))
