"""Leiden and Louvain to their fixed point, the distributed Ward tree, neighbours by a recall target."""

import collections

import numpy as np
import pytest

from cellscape.operators import graph as GR
from cellscape.operators import neighbors as NB
from cellscape.operators import ward as WD


def planted(n=220, groups=6, seed=1):
    """Edges (both directions) of a graph with weak links between dense groups."""
    rng = np.random.default_rng(seed)
    group = np.arange(n) % groups
    edges = {}
    for i in range(n):
        mates = rng.choice(np.flatnonzero(group == group[i]), 6)
        for j in [*mates, rng.integers(n)]:
            if i != j:
                edges[(min(i, int(j)), max(i, int(j)))] = float(rng.uniform(0.2, 1))
    return group, [e for (i, j), w in edges.items() for e in ((i, j, w), (j, i, w))]


def modularity(edges, label, resolution):
    m2 = sum(w for *_, w in edges)
    degree, inside = collections.Counter(), 0.0
    for i, j, w in edges:
        degree[label[i]] += w
        inside += w * (label[i] == label[j])
    return inside / m2 - resolution * sum(k * k for k in degree.values()) / m2 ** 2


def connected(edges, members):
    members, seen = set(members), set()
    near = collections.defaultdict(set)
    for i, j, _ in edges:
        if i in members and j in members:
            near[i].add(j)
    todo = [next(iter(members))]
    while todo:
        x = todo.pop()
        if x not in seen:
            seen.add(x)
            todo.extend(near[x])
    return seen == members


@pytest.mark.parametrize("refine", [True, False])
def test_communities_at_a_fixed_point(spark, refine):
    check_fixed_point(spark, refine)


@pytest.mark.parametrize("refine, large", [(True, 1 << 20), (True, 60), (False, 60)])
def test_communities_from_many_groups(spark, monkeypatch, refine, large):
    monkeypatch.setattr(GR, "GROUP_EDGES", 700)
    monkeypatch.setattr(GR, "LARGE_COMMUNITY", large)
    check_fixed_point(spark, refine)


def test_few_rounds_to_the_fixed_point(spark, monkeypatch):
    rounds = []
    put = GR.Scratch.put
    monkeypatch.setattr(GR.Scratch, "put", lambda self, name, *a: rounds.append(name) or put(self, name, *a))
    _, edges = planted(120, 4, 3)
    found = GR.community_sweep(spark.createDataFrame(edges, "src long, dst long, w double"), [1.0], True)
    assert found.count() == 120
    assert sum(name.startswith("moves-") for name in rounds) <= 20 and not any(name.startswith("chances-") for name in rounds)


@pytest.mark.parametrize("refine, bound", [(True, None), (False, None), (True, 700)])
def test_one_task_takes_a_small_graph_through_all_levels(spark, monkeypatch, refine, bound):
    # Every round of every level was a job that wrote its tables.
    written, settled = [], []
    put, communities = GR.Scratch.put, GR._communities
    monkeypatch.setattr(GR.Scratch, "put", lambda self, name, *a: written.append(name) or put(self, name, *a))
    monkeypatch.setattr(GR, "_communities", lambda graph, start, *a: settled.append(start is not None) or communities(graph, start, *a))
    if bound:
        monkeypatch.setattr(GR, "GROUP_EDGES", bound)
    check_fixed_point(spark, refine)
    if bound:  # groups of nodes at first, then each resolution as soon as its graph is small
        assert "moves-0" in written and settled and all(settled)
    else:
        assert settled == [False] and written == ["cut"] * 3


def test_levels_in_one_task(spark):
    # Two triangles and a far pair, from communities that are names of other nodes.
    pairs = [(10, 20), (10, 30), (20, 30), (40, 50), (40, 60), (50, 60), (70, 80), (30, 40)]
    src, dst = np.array([*pairs, *((b, a) for a, b in pairs)]).T
    w = np.where((src + dst) == 70, 0.1, 1.0)
    w[(src == 30) & (dst == 40) | (src == 40) & (dst == 30)] = 0.1
    for comm in (None, (np.array([10, 20, 30, 40, 50, 60, 70, 80]), np.array([10, 10, 30, 60, 50, 60, 70, 80]))):
        for refine in (True, False):
            node, to = GR._settled(src, dst, w, comm, 1.0, w.sum(), refine)
            assert dict(zip(node.tolist(), to.tolist())) == {10: 10, 20: 10, 30: 10, 40: 40, 50: 40, 60: 40, 70: 70, 80: 70}


def check_fixed_point(spark, refine):
    group, edges = planted()
    table = spark.createDataFrame(edges, "src long, dst long, w double")
    cells = spark.createDataFrame([(i,) for i in range(223)], "cell_id long")  # three without edges
    rows = GR.community_sweep(table, [0.5, 1.0, 2.0], refine, cells).collect()
    by_key = collections.defaultdict(dict)
    for r in rows:
        by_key[r.cluster_key][r.cell_id] = r.cluster
    for resolution, label in zip([0.5, 1.0, 2.0], (by_key[k] for k in sorted(by_key))):
        assert set(label) == set(range(223))
        assert all(sum(c == label[i] for c in label.values()) == 1 for i in (220, 221, 222))
        reached = modularity(edges, label, resolution)
        assert reached > modularity(edges, list(range(223)), resolution)
        # At least about as good as the planted groups, which are no optimum themselves.
        assert reached > modularity(edges, [*group, 90, 91, 92], resolution) - 0.02
        for c in set(label.values()):
            members = [i for i, x in label.items() if x == c]
            assert not refine or connected(edges, members)
        sizes = collections.Counter(label.values())
        assert [sizes[c] for c in range(len(sizes))] == sorted(sizes.values(), reverse=True)


def test_no_single_move_helps(spark):
    _, edges = planted(120, 4, 3)
    nodes = spark.createDataFrame(edges, "src long, dst long, w double").withColumn("res", NB.F.lit(1.0))
    m2 = sum(w for *_, w in edges)
    start = nodes.groupBy("res", NB.F.col("src").alias("node")).agg(NB.F.sum("w").alias("k")).withColumn("comm", NB.F.col("node"))
    moved, quality = GR._local_moving(nodes.select("res", "src", "dst", "w"), start, {}, m2, 0)
    label = {r.node: r.comm for r in moved.collect()}
    best = modularity(edges, label, 1.0)
    assert quality[1.0] == pytest.approx(best)
    for i in label:
        for c in {label[j] for a, j, _ in edges if a == i}:
            assert modularity(edges, {**label, i: c}, 1.0) <= best + 1e-9


def greedy_ward(X):
    alive = {i: (x, 1) for i, x in enumerate(X)}
    merges = []
    while len(alive) > 1:
        cost, a, b = min((na * nb / (na + nb) * ((ca - cb) ** 2).sum(), a, b)
                         for a, (ca, na) in alive.items() for b, (cb, nb) in alive.items() if a < b)
        (ca, na), (cb, nb) = alive[a], alive.pop(b)
        alive[a] = ((na * ca + nb * cb) / (na + nb), na + nb)
        merges.append((a, b, cost))
    return merges


def greedy_labels(n, merges, k):
    label = list(range(n))
    for a, b, _ in merges[:n - k]:
        label = [label[a] if x == label[b] else x for x in label]
    return label


@pytest.mark.parametrize("n, block", [(5, 2048), (60, 16)])
def test_ward_equals_greedy(spark, n, block):
    X = np.random.default_rng(n).normal(size=(n, 3))
    vec = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "cell_id long, v array<double>")
    ks = [1, 2, 3, 4, 5]
    out, tree = WD.ward_sweep(vec, ks, block_size=block)
    merges = greedy_ward(X)
    got = sorted((r.left, r.right) for r in tree.collect())
    assert got == sorted(m[:2] for m in merges)
    assert np.allclose(sorted(r.cost for r in tree.collect()), sorted(m[2] for m in merges))
    for k in ks:
        label = greedy_labels(n, merges, k)
        first = {c: i for i, c in enumerate(sorted(set(label)))}
        mine = {r.cell_id: r.cluster for r in out.where(f"cluster_key = 'hierarchical_k{k}'").collect()}
        assert mine == {i: first[c] for i, c in enumerate(label)}


def test_ward_with_equal_cells(spark):
    vec = spark.createDataFrame([(i, [float(i // 4)]) for i in range(16)], "cell_id long, v array<double>")
    out, tree = WD.ward_sweep(vec, [4])
    assert tree.count() == 15
    assert all(r.cluster == r.cell_id // 4 for r in out.collect())


def test_ward_searches_only_where_something_merged(spark, monkeypatch):
    # Every round searched all clusters again, and copies merged one pair a round.
    searched = []

    def search(vec, kernel, schema, cols, n_cells, block_size, searching):
        searched.append((n_cells, vec.where(searching).count()))
        return NB.search_blocks(vec, kernel, schema, cols, n_cells, block_size, searching)

    monkeypatch.setattr(WD, "search_blocks", search)
    rng = np.random.default_rng(14)
    X = rng.normal(size=(70, 3))
    X[50:] = X[3]  # 21 copies
    vec = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "cell_id long, v array<double>")
    tree = WD.ward_tree(vec, 16).collect()
    assert searched[0] == (50, 50) and sum(few for _, few in searched) < 0.85 * sum(n for n, _ in searched)
    assert sorted(r.cost for r in tree) == pytest.approx(sorted(m[2] for m in greedy_ward(X)), abs=1e-9)
    zero = [r for r in tree if r.right >= 50]
    assert len(tree) == 69 and all(r.left == 3 and r.round == 0 and r.n == r.right - 48 for r in zero) and len(zero) == 20
    assert len({r.right for r in tree}) == 69 and max(r.n for r in tree) == 70
    assert all(r.height >= r.cost for r in tree)
    labels = WD.cut_tree(spark.createDataFrame(tree), vec.select("cell_id"), [4])
    mine = {r.cell_id: r.cluster for r in labels.collect()}
    want = greedy_labels(70, sorted(greedy_ward(X), key=lambda m: m[2]), 4)
    first = {c: i for i, c in enumerate(sorted(set(want)))}
    assert mine == {i: first[c] for i, c in enumerate(want)}


def test_approximate_neighbours_reach_their_recall(spark):
    X = np.random.default_rng(5).normal(size=(1500, 30))  # no structure: the hardest case
    vec = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "cell_id long, v array<double>")
    for chunk in (2048, 40):
        found = NB.knn_approx(vec, 15, chunk_rows=chunk)
        r = NB.knn_recall(found, NB.knn_exact(vec, 15, block_size=512)).first()
        assert r.recall >= 0.9
        assert found.count() == 1500 * 15
    assert NB.knn_approx(vec.limit(0), 15).count() == 0
    assert NB.knn_approx(vec.limit(3), 15).count() == 9


def test_distance_summary(spark):
    X = np.random.default_rng(6).normal(size=(50, 4))
    vec = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "cell_id long, v array<double>")
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    for r in NB.distance_summary(vec, block_size=16).collect():
        assert r.n_others == 49 and np.isclose(r.mean_distance, D[r.cell_id].sum() / 49) and np.isclose(r.max_distance, D[r.cell_id].max())


def test_a_cell_visits_a_group_of_lists_once(spark):
    # A cell's vector was copied for every list that it probes.
    X = np.random.default_rng(15).normal(size=(40, 6))
    centres = X[:12]
    groups = NB._groups_of_lists(centres, 3)
    assert sorted(np.bincount(groups)) == [4, 4, 4]
    import pandas as pd
    home = ((X[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
    residents = pd.DataFrame({"cell_id": np.arange(40), "v": list(X), "lists": [np.array([h]) for h in home]})
    probes = [np.array([1, 4, 7])] * 40
    got = NB._lists_nearest(residents.assign(lists=probes), residents, 3)
    inside = np.flatnonzero(np.isin(home, (1, 4, 7)))
    D = np.sqrt(((X[:, None] - X[None, inside]) ** 2).sum(-1))
    assert (got["dst"].to_numpy().reshape(40, 3) == inside[np.argsort(np.rint(D * 1e9), axis=1, kind="stable")[:, :3]]).all()
    vec = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "cell_id long, v array<double>")
    found = NB.knn_approx(vec, 4, recall=1.0, n_lists=12, n_probe=2, chunk_rows=7)  # all lists in the end: exact
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, NB.knn_exact(vec, 4).collect()))
