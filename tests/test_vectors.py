import numpy as np
import pytest

from cellscape.operators import kmeans as KM
from cellscape.operators import neighbors as NB
from cellscape.operators import reduce as RD


def _vec(spark, X):
    return spark.createDataFrame([(i, [float(x) for x in X[i]]) for i in range(len(X))], "cell_id long, v array<double>")


def test_pca_against_numpy(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(60, 6)) @ rng.normal(size=(6, 6))
    scores, ratios, loads = RD.pca(_vec(spark, X), n_comps=4)
    Xc = X - X.mean(0)
    evals, evecs = np.linalg.eigh(np.cov(Xc, rowvar=False))
    order = np.argsort(evals)[::-1]
    evals, evecs = evals[order], evecs[:, order]
    r = sorted((row.pc, row.variance_ratio) for row in ratios.collect())
    assert np.allclose([x for _, x in r], evals[:4] / evals.sum(), atol=1e-9)
    got = {row.cell_id: row.v for row in scores.collect()}
    for j in range(4):
        v = evecs[:, j] * np.sign(evecs[np.argmax(np.abs(evecs[:, j])), j])
        expect = Xc @ v
        assert np.allclose([got[i][j] for i in range(60)], expect, atol=1e-8)


def test_knn_exact_against_bruteforce(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(70, 5))
    got = NB.knn_exact(_vec(spark, X), k=6, n_cells=70, block_size=16).collect()
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    by = {}
    for r in got:
        by.setdefault(r.src, []).append((r.rank, r.dst))
    for i in range(70):
        exp = list(np.lexsort((np.arange(70), np.round(D[i], 9)))[:6])
        assert [d for _, d in sorted(by[i])] == exp


def test_kmeans_cost_never_rises_and_labels_nearest(spark):
    rng = np.random.default_rng(2)
    X = np.concatenate([rng.normal(c, 0.3, size=(30, 3)) for c in (0, 3, 6)])
    trace = KM.kmeans_cost_trace(_vec(spark, X), k=3, steps=6)
    assert all(b <= a + 1e-9 for a, b in zip(trace, trace[1:]))
    asg, inertia, _ = KM.kmeans_sweep(_vec(spark, X), [2, 3], n_init=3, seed=7)
    lab = {r.cell_id: r.cluster for r in asg.where("cluster_key = 'kmeans_k3'").collect()}
    C = np.array([X[[i for i in lab if lab[i] == c]].mean(0) for c in range(3)])
    d = ((X[:, None] - C[None]) ** 2).sum(-1)
    assert all(np.argmin(d[i]) == lab[i] for i in range(len(X)))
    ine = {r.k: r.inertia for r in inertia.collect()}
    assert ine[3] < ine[2]


def test_pairs_by_products_equal_differences():
    rng = np.random.default_rng(5)
    X = rng.normal(size=(300, 8))
    X[:40] = X[0]  # copies
    X[40:80] = X[40] + 1e-7 * rng.normal(size=(40, 8))  # far below what a product of the vectors resolves
    Y = np.concatenate([X[::3], rng.normal(size=(50, 8))]) + 0.0
    for shift in (0.0, 1e4):
        left, right = X + shift, Y + shift
        want = np.sqrt(((left[:, None] - right[None]) ** 2).sum(-1))
        pairs = NB.Pairs(left, right)
        got = np.concatenate([d for _, d in pairs.strips()])
        assert np.allclose(got, want, rtol=1e-11, atol=1e-13)
        assert (got[want == 0] == 0).all()
        i, j, dist = pairs.nearest(7, 1e9)
        order = np.argsort(np.rint(want * 1e9) / 1e9, axis=1, kind="stable")[:, :7]
        assert (j.reshape(300, 7) == order).all() and (i == np.repeat(np.arange(300), 7)).all()
        assert np.allclose(dist.reshape(300, 7), np.take_along_axis(want, order, axis=1), rtol=0, atol=1e-9)
    bad = X.copy()
    bad[3, 2] = np.nan
    got = np.concatenate([d for _, d in NB.Pairs(bad, Y).strips()])
    assert np.isnan(got[3]).all() and np.isfinite(np.delete(got, 3, axis=0)).all()


def test_blocks_grow_with_the_cells():
    # Copies of a cell, one for every block, grew with the cells: 352 at 720,000.
    assert [NB.n_blocks(n) for n in (1, 2000, 20_000, 120_000, 720_000)] == [1, 1, 10, 16, 22]


def test_strips_of_a_tile(spark, monkeypatch):
    rng = np.random.default_rng(6)
    X = rng.normal(size=(90, 4))
    monkeypatch.setattr(NB, "STRIP_CELLS", 100)
    vec = _vec(spark, X)
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    labels = spark.createDataFrame([(i, "a", i % 3) for i in range(90)] + [(i, "b", i % 2) for i in range(60)],
                                   "cell_id long, cluster_key string, cluster int")
    for r in NB.cluster_distance_sums(vec, labels, block_size=32).collect():
        mine = [j for j in range(90 if r.cluster_key == "a" else 60) if j % (3 if r.cluster_key == "a" else 2) == r.cluster and j != r.cell_id]
        assert r.cnt == len(mine) and abs(r.dsum - D[r.cell_id, mine].sum()) < 1e-9


@pytest.mark.parametrize("block", [16, 2048])
def test_finished_means_leave_a_task(spark, block):
    # A row for every cell, cluster and tile left the tasks.
    rng = np.random.default_rng(21)
    X = rng.normal(size=(150, 4))
    X[140:] = X[:10]  # copies
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    label = {"many": np.arange(150) % 50, "few": np.arange(150) % 3 - 1, "alone": np.minimum(np.arange(150), 1)}
    rows = [(i, key, int(c)) for key, of in label.items() for i, c in enumerate(of) if key != "few" or i >= 5]  # five have none
    rows = [(i, key, None if (i, key) == (9, "many") else c) for i, key, c in rows]  # and one is missing
    labels = spark.createDataFrame(rows, "cell_id long, cluster_key string, cluster int")
    got = NB.cluster_distance_means(_vec(spark, X), labels, block_size=block).collect()
    assert len(got) == len(rows) == len({(r.cell_id, r.cluster_key) for r in got})
    of = {(i, key): c for i, key, c in rows}
    for r in got:
        mean = {}
        for c in set(label[r.cluster_key].tolist()):
            mates = [j for j in range(150) if of.get((j, r.cluster_key)) == c and j != r.cell_id]
            if mates:
                mean[c] = (len(mates), D[r.cell_id, mates].mean())
        n, a = mean.pop(of[r.cell_id, r.cluster_key], (0, None))
        assert r.n_own == n and (r.a is None if a is None else abs(r.a - a) < 1e-9)
        assert abs(r.b - min(m for _, m in mean.values())) < 1e-9


def test_kmeans_step_holds_all_configurations_at_once(spark, monkeypatch):
    X = np.random.default_rng(8).normal(size=(70, 3))
    centres = {c: X[5 * c:5 * c + k].tolist() for c, k in enumerate((2, 3, 7))}
    monkeypatch.setattr(KM, "STRIP", 16)
    stats = KM._lloyd_step(_vec(spark, X).coalesce(1), centres)
    assert sum(n for n, _, _ in stats.values()) == 3 * 70
    for c, C in centres.items():
        D = ((X[:, None] - np.array(C)) ** 2).sum(-1)
        for cl in np.unique(D.argmin(1)):
            mine = D.argmin(1) == cl
            n, sse, total = stats[(c, cl)]
            assert n == mine.sum() and np.isclose(sse, D[mine].min(1).sum()) and np.allclose(total, X[mine].sum(0))


def test_a_tile_takes_every_distance_once(spark, monkeypatch):
    # The product of two blocks was computed for each direction, and every row was partitioned at its full width.
    rng = np.random.default_rng(11)
    X = rng.normal(size=(120, 5))
    X[60:70] = X[:10]  # copies, where the product cancels
    X[70] = 1e6  # far out: its norm must not hide that others cancel
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    seen = np.zeros(D.shape, dtype=int)
    monkeypatch.setattr(NB, "STRIP_CELLS", 400)
    for at, to, d in NB.Pairs(X, X).squares():
        assert d.shape[0] <= 20 and d.shape[1] <= 20
        seen[at, to] += 1
        assert np.allclose(d, D[at, to], rtol=1e-9, atol=1e-9)
    assert (seen == 1).all()
    monkeypatch.setattr(NB, "GROUPS", 4)
    for m in (1, 3, 40, 120):
        i, j, dist = NB.Pairs(X, X).nearest(m, 1e9)
        order = np.argsort(np.rint(D * 1e9) / 1e9, axis=1, kind="stable")[:, :m]
        assert (j.reshape(120, m) == order).all()
    for r in NB.distance_summary(_vec(spark, X), block_size=32).collect():
        assert r.n_others == 119 and np.isclose(r.mean_distance, D[r.cell_id].sum() / 119) and np.isclose(r.max_distance, D[r.cell_id].max())


def test_searches_return_few_candidates(spark):
    # 70 cells in blocks of 16: 5 blocks of rows, each against 2 blocks of others, so at most 2 x k candidates for a cell (5 x k before).
    X = np.random.default_rng(12).normal(size=(70, 5))
    tiles = NB.search_blocks(_vec(spark, X), lambda a, b, pairs: a[["cell_id"]].assign(n=len(b)), "cell_id long, n long", (), 70, 16)
    per = {r.cell_id: (r["count(1)"], r.n) for r in tiles.groupBy("cell_id").agg(NB.F.count(NB.F.lit(1)), NB.F.sum("n").alias("n")).collect()}
    assert len(per) == 70 and set(per.values()) == {(2, 70)}


def test_cheapest_partner_against_all_pairs():
    rng = np.random.default_rng(13)
    X, Y = rng.normal(size=(90, 4)) + 1e3, rng.normal(size=(70, 4)) + 1e3
    Y[10:20] = X[10:20]
    n, m = rng.integers(1, 9, 90).astype(float), rng.integers(1, 2000, 70).astype(float)
    skip = (np.arange(0, 20), np.arange(0, 20))
    cost = n[:, None] * m / (n[:, None] + m) * ((X[:, None] - Y[None]) ** 2).sum(-1)
    cost[skip] = np.inf
    i, j, c = NB.Pairs(X, Y).cheapest(n, m, skip)
    assert (i == np.arange(90)).all() and (j == cost.argmin(1)).all() and np.allclose(c, cost.min(1))
