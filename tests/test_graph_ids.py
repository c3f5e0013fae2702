from cellscape.operators import graph


def test_community_sweep_keeps_large_ids(spark):
    base = 3_000_000_000
    edges = [(a, b) for c in (0, 10) for a in range(c, c + 5) for b in range(c, c + 5) if a != b] + [(0, 10), (10, 0)]
    df = spark.createDataFrame([(base + a, base + b, 1.0) for a, b in edges], "src long, dst long, w double")
    rows = graph.community_sweep(df, [1.0], method="louvain").collect()
    assert {r.cell_id for r in rows} == {base + a for a, _ in edges}
    assert len({r.cluster for r in rows}) == 2
