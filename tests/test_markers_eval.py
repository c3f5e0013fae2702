import math

import numpy as np

from conftest import dense_to_triples, matrix
from cellscape.operators import evaluate as EV
from cellscape.operators import markers as MK


def _avg_ranks(x):
    order = np.argsort(x, kind="mergesort")
    ranks = np.empty(len(x))
    xs = x[order]
    i = 0
    while i < len(x):
        j = i
        while j + 1 < len(x) and xs[j + 1] == xs[i]:
            j += 1
        ranks[order[i:j + 1]] = (i + j) / 2 + 1
        i = j + 1
    return ranks


def test_wilcoxon_ties_and_zeros_against_numpy(spark):
    # m5: 6 cells, 2 clusters, tied values and zeros
    X = np.array([[0, 1, 3], [2, 1, 0], [2, 0, 0], [0, 1, 5], [2, 4, 0], [0, 0, 1]], dtype=float)
    groups = ["a", "a", "a", "b", "b", "b"]
    m = matrix(spark, dense_to_triples(X.tolist()), 6, 3, groups=groups)
    res = {(r.cluster, r.gene_id): r for r in MK.markers_wilcoxon(m, tie_digits=12).collect()}
    n = 6
    for c in ("a", "b"):
        mask = np.array([g == c for g in groups])
        n1, n2 = mask.sum(), (~mask).sum()
        for g in range(3):
            r = _avg_ranks(X[:, g])
            z = (r[mask].sum() - n1 * (n + 1) / 2) / math.sqrt(n1 * n2 * (n + 1) / 12)
            assert abs(res[(c, g)].score - z) < 1e-9
            lfc = math.log2((math.expm1(X[mask, g].mean()) + 1e-9) / (math.expm1(X[~mask, g].mean()) + 1e-9))
            assert abs(res[(c, g)].logfoldchange - lfc) < 1e-9
            assert abs(res[(c, g)].pval - math.erfc(abs(z) / math.sqrt(2))) < 1e-12


def test_bh_running_minimum_with_tie(spark):
    # m10: p = .01 .02 .02 .04 .05, m = 5: raw m*p/rank = .05 .05 .0333 .05 .05;
    # running minimum from the largest p down -> .0333 .0333 .0333 .05 .05
    df = spark.createDataFrame([("c", i, p) for i, p in enumerate([0.01, 0.02, 0.02, 0.04, 0.05])],
                               "cluster string, gene_id long, pval double")
    got = [r.pval_adj for r in MK.bh_adjust(df).orderBy("gene_id").collect()]
    assert np.allclose(got, [0.1 / 3, 0.1 / 3, 0.1 / 3, 0.05, 0.05])


def _np_silhouette(X, lab):
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    s = []
    for i in range(len(X)):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def _np_dbi_chi(X, lab):
    ks = sorted(set(lab))
    C = np.array([X[lab == k].mean(0) for k in ks])
    S = np.array([np.linalg.norm(X[lab == k] - C[i], axis=1).mean() for i, k in enumerate(ks)])
    Dc = np.linalg.norm(C[:, None] - C[None], axis=-1)
    Dc[Dc == 0] = np.inf
    dbi = np.mean(np.max((S[:, None] + S[None]) / Dc, axis=1))
    W = sum(((X[lab == k] - C[i]) ** 2).sum() for i, k in enumerate(ks))
    B = sum((lab == k).sum() * ((C[i] - X.mean(0)) ** 2).sum() for i, k in enumerate(ks))
    n, k = len(X), len(ks)
    return dbi, B * (n - k) / (W * (k - 1))


def test_indices_with_singleton_cluster(spark):
    # m6: 5 points, one singleton cluster
    X = np.array([[0, 0], [0, 1], [1, 0], [5, 5], [9, 0.5]], dtype=float)
    lab = np.array([0, 0, 0, 1, 1])
    lab2 = np.array([0, 0, 1, 1, 2])  # cluster 2 is a singleton
    vec = spark.createDataFrame([(i, X[i].tolist()) for i in range(5)], "cell_id long, v array<double>")
    asg = spark.createDataFrame(
        [(i, "m", "k2", int(lab[i])) for i in range(5)] + [(i, "m", "k3", int(lab2[i])) for i in range(5)],
        "cell_id long, method string, cluster_key string, cluster int")
    ev = {r.cluster_key: r for r in EV.evaluate_all(vec, asg, n_cells=5).collect()}
    for key, L in (("k2", lab), ("k3", lab2)):
        assert abs(ev[key].silhouette_score - _np_silhouette(X, L)) < 1e-12
        dbi, chi = _np_dbi_chi(X, L)
        assert abs(ev[key].davies_bouldin_index - dbi) < 1e-12
        assert abs(ev[key].calinski_harabasz_index - chi) < 1e-9


def test_composite_constant_and_missing(spark):
    # m7: three configurations, silhouette constant (-> 0.5), one CHI missing
    ev = spark.createDataFrame([
        ("m", "a", 2, 0.3, 1.0, 10.0), ("m", "b", 3, 0.3, 2.0, 20.0), ("m", "c", 4, 0.3, 1.5, None)],
        "method string, cluster_key string, n_clusters long, silhouette_score double, "
        "davies_bouldin_index double, calinski_harabasz_index double")
    got = [(r.cluster_key, r.composite_score) for r in EV.composite_score(ev).collect()]
    assert got[0][0] == "a" and abs(got[0][1] - (0.5 + 1.0 + 0.0) / 3) < 1e-12
    assert got[1][0] == "b" and abs(got[1][1] - (0.5 + 0.0 + 1.0) / 3) < 1e-12
    assert got[2] == ("c", None)
    best = EV.recommend_best(EV.composite_score(ev)).collect()
    assert len(best) == 1 and best[0].cluster_key == "a"
