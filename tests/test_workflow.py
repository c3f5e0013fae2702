"""The flows on planted groups: every clustering method, the recommendation, its markers."""

import collections

import numpy as np
import pytest

from cellscape.operators import markers as MK
from cellscape.plans import workflow as WF
from cellscape.session import cut_lineage
from conftest import dense_to_triples, matrix

GROUPS, CELLS = 3, 75


@pytest.fixture(scope="module")
def planted(spark):
    """Cells of three groups; genes 2g and 2g + 1 are high in group g, the last two nowhere."""
    rng = np.random.default_rng(11)
    group = np.arange(CELLS) % GROUPS
    X = np.abs(rng.normal(0.3, 0.1, size=(CELLS, 2 * GROUPS + 2)))
    for i, g in enumerate(group):
        X[i, 2 * g:2 * g + 2] += 4 + rng.normal(0, 0.3, 2)
    m = matrix(spark, dense_to_triples(X), CELLS, X.shape[1], groups=[f"g{g}" for g in group])
    vec = cut_lineage(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "cell_id long, v array<double>"))
    return m, vec, group


def partition(rows):
    parts = collections.defaultdict(set)
    for r in rows:
        parts[r.cluster].add(r.cell_id)
    return sorted(map(sorted, parts.values()))


def test_flow_finds_the_groups_and_their_markers(spark, planted):
    m, vec, group = planted
    cfg = WF.ClusteringConfig(methods=[*WF.ALL_METHODS, "unknown"], leiden_resolutions=[0.3], louvain_resolutions=[0.3],
                              kmeans_k_range=(2, 4), hierarchical_k_range=(2, 4), n_neighbors=10)
    assignments, inertia = WF.run_clustering(vec, cfg)
    by_key = collections.defaultdict(list)
    for r in assignments.collect():
        by_key[r.cluster_key].append(r)
    assert set(by_key) == {"leiden_res0.3", "louvain_res0.3", *(f"{x}_k{k}" for x in ("kmeans", "hierarchical") for k in (2, 3, 4))}
    truth = sorted(np.flatnonzero(group == g).tolist() for g in range(GROUPS))
    for key in ("kmeans_k3", "hierarchical_k3"):
        assert partition(by_key[key]) == truth
    for key in ("leiden_res0.3", "louvain_res0.3"):
        assert sorted(i for part in partition(by_key[key]) for i in part) == list(range(CELLS))
        assert all(len({group[i] for i in part}) == 1 for part in partition(by_key[key]))
    assert [r.k for r in inertia.orderBy("k").collect()] == [2, 3, 4]

    ranked, best = WF.run_evaluation(vec, assignments)
    top = best.first()
    assert top.n_clusters == 3 and partition(by_key[top.cluster_key]) == truth
    assert ranked.count() == len(by_key)

    found = collections.defaultdict(set)
    for r in WF.marker_report(m, assignments, best, n_top=2).collect():
        found[r.cluster].add(r.gene)
    cluster_of = {r.cell_id: r.cluster for r in by_key[top.cluster_key]}
    assert {str(cluster_of[g]): {f"g{2 * g}", f"g{2 * g + 1}"} for g in range(GROUPS)} == dict(found)


def test_no_method_gives_no_assignments(planted):
    assert WF.run_clustering(planted[1], WF.ClusteringConfig(methods=["unknown"])) == (None, None)


def test_logistic_regression_markers(planted):
    m, _, _ = planted
    best = collections.defaultdict(list)
    for r in MK.markers_logreg(m).collect():
        best[r.cluster].append((r.score, r.gene_id))
    for g in range(GROUPS):
        assert {i for _, i in sorted(best[f"g{g}"])[-2:]} == {2 * g, 2 * g + 1}


def test_marker_report_covers_the_whole_matrix(spark, tmp_path):
    # Customers with more than 40 part names, fewer than 20, and all but 20 names were left out.
    from cellscape.plans import registry as R

    rng = np.random.default_rng(5)
    names = [f"{'red' if p in (1, 4) else 'blue'} thing {p}" for p in range(1, 49)]
    rows = {"customer": [(c, f"s{c % 2}") for c in range(1, 42)],  # 41 bought nothing
            "part": [(p, n) for p, n in enumerate(names, 1)],
            "orders": [(100 + c, c) for c in range(1, 41)],
            "lineitem": [(100 + c, p, float(rng.integers(1, 4) + 45 * (p % 4 == c % 2 + 2))) for c in range(1, 41)
                         for p in range(1, (49 if c > 4 else 13))]}
    schemas = {"customer": "c_custkey long, c_mktsegment string", "part": "p_partkey long, p_name string",
               "orders": "o_orderkey long, o_custkey long", "lineitem": "l_orderkey long, l_partkey long, l_quantity double"}
    for name, schema in schemas.items():
        spark.createDataFrame(rows[name], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    raw, vec = R.report_matrix(spark, str(tmp_path))
    assert sorted(r.cell_id for r in vec.collect()) == list(range(1, 41))
    assert {len(r.v) for r in vec.collect()} == {48} and raw.expr.select("gene_id").distinct().count() == 48
    assert raw.expr.count() == len(rows["lineitem"])
    found = collections.defaultdict(set)
    for r in R.QUERIES["marker_report"](spark, str(tmp_path)).collect():
        found[r.cluster].add(r.gene)
    high = [{names[p - 1] for p in range(1, 49) if p % 4 == g} for g in (2, 3)]
    assert len(found) >= 2 and all(any(len(genes & h) >= 8 for genes in found.values()) for h in high)
