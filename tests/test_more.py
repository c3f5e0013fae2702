import numpy as np
import pytest

from cellscape.operators import genesets as GS
from cellscape.operators.markers_ttest import student_t_two_sided


def test_student_t_tail_at_known_critical_values():
    got = student_t_two_sided(np.array([2.228138851986274, 1.959963984540054, 0.0]), np.array([10.0, 1e9, 3.0]))
    assert abs(got[0] - 0.05) < 1e-9 and abs(got[1] - 0.05) < 1e-6 and got[2] == 1.0


def test_regress_out_matches_least_squares(spark):
    rng = np.random.default_rng(5)
    n, g = 40, 4
    s, g2m = rng.normal(size=n), rng.normal(size=n)
    Y = rng.normal(size=(n, g)) + np.outer(s, [1, 0, 2, -1]) + np.outer(g2m, [0.5, 1, 0, 3])
    vec = spark.createDataFrame([(i, Y[i].tolist()) for i in range(n)], "cell_id long, v array<double>")
    cov = spark.createDataFrame([(i, float(s[i]), float(g2m[i])) for i in range(n)],
                                "cell_id long, S_score double, G2M_score double")
    got = {r.cell_id: r.v for r in GS.regress_out(vec, cov).collect()}
    X = np.column_stack([np.ones(n), s, g2m])
    beta, *_ = np.linalg.lstsq(X, Y, rcond=None)
    R = Y - X @ beta
    for i in range(n):
        assert np.allclose(got[i], R[i], atol=1e-9)


def test_louvain_two_cliques(spark):
    # m8: two 5-cliques joined by one weak edge -> two communities at resolution 1
    from cellscape.operators import graph as GR

    edges = []
    for base in (0, 5):
        for i in range(5):
            for j in range(5):
                if i != j:
                    edges.append((base + i, base + j, 1.0))
    edges += [(4, 5, 0.1), (5, 4, 0.1)]
    e = spark.createDataFrame(edges, "src long, dst long, w double")
    for refine in (False, True):
        lab = {r.cell_id: r.cluster for r in GR.community_sweep(e, [1.0], refine=refine).collect()}
        assert len(set(lab.values())) == 2
        assert len({lab[i] for i in range(5)}) == 1 and len({lab[i] for i in range(5, 10)}) == 1


def test_tsne_affinities_against_numpy(spark):
    from cellscape.operators import graph as GR
    from cellscape.operators import neighbors as NB

    rng = np.random.default_rng(9)
    X = rng.normal(size=(30, 3))
    vec = spark.createDataFrame([(i, X[i].tolist()) for i in range(30)], "cell_id long, v array<double>")
    k = 13
    P = {(r.src, r.dst): r.p for r in GR.tsne_affinities(NB.knn_exact(vec, k, n_cells=30), 4.0).collect()}
    D = ((X[:, None] - X[None]) ** 2).sum(-1)
    C = np.zeros((30, 30))
    for i in range(30):
        nb = [j for j in np.argsort(D[i], kind="stable")[:k] if j != i][: k - 1]
        lo, hi, beta = 0.0, np.inf, 1.0
        for _ in range(200):
            p = np.exp(-D[i, nb] * beta)
            p /= p.sum()
            H = -(p * np.log(np.maximum(p, 1e-300))).sum()
            if abs(H - np.log(4.0)) < 1e-10:
                break
            if H > np.log(4.0):
                lo, beta = beta, beta * 2 if np.isinf(hi) else (beta + hi) / 2
            else:
                hi, beta = beta, (beta + lo) / 2
        C[i, nb] = p
    S = C + C.T
    S /= S.sum()
    assert abs(sum(P.values()) - 1.0) < 1e-9
    for (i, j), p in P.items():
        assert abs(p - S[i, j]) < 1e-5


def test_ward_line_and_nested_cuts(spark):
    # m9: 5 points on a line; Ward merges the two closest pairs first, cuts are nested
    from cellscape.operators import ward as WD

    X = np.array([[0.0], [1.0], [5.0], [6.0], [20.0]])
    vec = spark.createDataFrame([(i, X[i].tolist()) for i in range(5)], "cell_id long, v array<double>")
    out, tree = WD.ward_sweep(vec, [2, 3, 4])
    merges = [(r.left, r.right, r.cost) for r in tree.orderBy("height", "round", "left").collect()]
    assert len(merges) == 4
    assert merges[0][:2] == (0, 1) and abs(merges[0][2] - 0.5) < 1e-12
    assert merges[1][:2] == (2, 3) and abs(merges[1][2] - 0.5) < 1e-12
    # {0,1} + {2,3}: 2*2/4 * 5^2 = 25 < {2,3} + {4}: 2/3 * 14.5^2
    assert merges[2][:2] == (0, 2) and abs(merges[2][2] - 25.0) < 1e-12
    lab = {}
    for r in out.collect():
        lab.setdefault(r.cluster_key, {})[r.cell_id] = r.cluster
    assert len(set(lab["hierarchical_k2"].values())) == 2
    for fine, coarse in (("hierarchical_k4", "hierarchical_k3"), ("hierarchical_k3", "hierarchical_k2")):
        groups = {}
        for c, f in lab[fine].items():
            groups.setdefault(f, set()).add(lab[coarse][c])
        assert all(len(v) == 1 for v in groups.values())


def test_graph_queries_search_neighbours_on_principal_components(spark, tmp_path):
    # cells differ only behind the first 30 coordinates
    from cellscape.plans import registry

    rng = np.random.default_rng(4)
    X = rng.normal(scale=0.01, size=(200, 64))
    X[:, 30:] *= np.linspace(100, 20, 34)
    X[100:, 40:] += 10.0
    rows = [(i, X[i].tolist(), 0) for i in range(200)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    Z = X - X.mean(0)
    Z = Z @ np.linalg.svd(Z, full_matrices=False)[2][:30].T
    D = np.sqrt(((Z[:, None] - Z[None]) ** 2).sum(-1))
    got = {}
    for r in registry.f3_knn(spark, str(tmp_path)).collect():
        got.setdefault(r.src, {})[r.rank] = r.dist
    for i in range(200):
        assert np.allclose([got[i][k] for k in range(1, 16)], np.sort(D[i])[:15], atol=1e-4)
    for name in ("fuzzy_graph", "knn_approx", "tsne_affinities"):
        pairs = registry.QUERIES[name](spark, str(tmp_path)).collect()
        assert pairs and all((r.src < 100) == (r.dst < 100) for r in pairs)
    for name in ("leiden_sweep", "louvain_sweep"):
        sides = {}
        for r in registry.QUERIES[name](spark, str(tmp_path)).collect():
            sides.setdefault((r.cluster_key, r.cluster), set()).add(r.cell_id < 100)
        assert sides and all(len(s) == 1 for s in sides.values())
    assert registry.QUERIES["knn_recall"](spark, str(tmp_path)).first().recall > 0.9


def test_marker_report_compares_the_default_methods(spark, monkeypatch):
    from cellscape.plans import registry

    class Seen(Exception):
        pass

    def seen(scores, cfg):
        raise Seen(cfg.methods)

    monkeypatch.setattr(registry.WF, "run_clustering", seen)
    with pytest.raises(Seen) as caught:
        registry.QUERIES["marker_report"](spark, "/root/testdata/sf0.001")
    assert caught.value.args[0] == ["leiden", "kmeans"]


def test_ward_sweep_names_a_k_that_it_cannot_cut(spark):
    from cellscape.operators import ward as WD

    vec = spark.createDataFrame([(i, [float(i)]) for i in range(3)], "cell_id long, v array<double>")
    with pytest.raises(ValueError, match="4 clusters"):
        WD.ward_sweep(vec, [2, 4])
