"""SQL text fragments for the oracle queries (DuckDB dialect, also plain ANSI where possible).

They restate the fixture definitions of ``cellscape.sources.tables`` independently,
so that an oracle shares no code path with the Spark plan it checks.
"""

from cellscape.functions.numeric import sql_normal_two_sided_p, sql_r6

R = sql_r6
P2 = sql_normal_two_sided_p

# suppliers x parts; mito stand-in prefix 'RED ' on the upper-cased part name.
F1 = """
f1_expr AS (
  SELECT l_suppkey AS cell_id, l_partkey AS gene_id, CAST(sum(l_quantity) AS DOUBLE) AS value
  FROM lineitem GROUP BY l_suppkey, l_partkey HAVING sum(l_quantity) <> 0),
f1_genes AS (
  SELECT p_partkey AS gene_id, p_name AS gene_name, starts_with(upper(p_name), 'RED ') AS mt FROM part),
f1_cells AS (SELECT s_suppkey AS cell_id, CAST(s_nationkey AS VARCHAR) AS grp FROM supplier)
"""

# customers x part names (gene id = smallest part key of the name).
F2 = """
f2_genes AS (
  SELECT min(p_partkey) AS gene_id, p_name AS gene_name, starts_with(upper(p_name), 'RED ') AS mt
  FROM part GROUP BY p_name),
f2_expr AS (
  SELECT o.o_custkey AS cell_id, g.gene_id AS gene_id, CAST(sum(l.l_quantity) AS DOUBLE) AS value
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN f2_genes g ON g.gene_name = p.p_name
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  GROUP BY o.o_custkey, g.gene_id HAVING sum(l.l_quantity) <> 0),
f2_cells AS (SELECT c_custkey AS cell_id, c_mktsegment AS grp FROM customer)
"""

# A1 on a fixture: per-cell QC metrics for every cell of the cell table.
def cell_qc(prefix: str) -> str:
    return f"""
{prefix}_qc AS (
  SELECT c.cell_id,
         CAST(coalesce(a.n_genes, 0) AS BIGINT) AS n_genes_by_counts,
         coalesce(a.total, 0.0) AS total_counts,
         coalesce(a.total_mt, 0.0) AS total_counts_mt,
         100.0 * coalesce(a.total_mt, 0.0) / nullif(coalesce(a.total, 0.0), 0.0) AS pct_counts_mt
  FROM {prefix}_cells c LEFT JOIN (
    SELECT e.cell_id, count_if(e.value <> 0) AS n_genes, sum(e.value) AS total,
           sum(CASE WHEN g.mt THEN e.value ELSE 0.0 END) AS total_mt
    FROM {prefix}_expr e JOIN {prefix}_genes g ON e.gene_id = g.gene_id
    GROUP BY e.cell_id) a ON a.cell_id = c.cell_id)
"""


def lognorm(prefix: str, target: float = 1e4) -> str:
    """T1 + T2 over a fixture: ``{prefix}_ln(cell_id, gene_id, x)``."""
    return f"""
{prefix}_tot AS (SELECT cell_id, sum(value) AS tot FROM {prefix}_expr GROUP BY cell_id),
{prefix}_norm AS (
  SELECT e.cell_id, e.gene_id,
         CASE WHEN t.tot = 0 THEN e.value ELSE e.value * {target!r} / t.tot END AS y
  FROM {prefix}_expr e JOIN {prefix}_tot t ON t.cell_id = e.cell_id),
{prefix}_ln AS (SELECT cell_id, gene_id, ln(1 + y) AS x FROM {prefix}_norm),
{prefix}_n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM {prefix}_cells)
"""


def zero_aware_stats(prefix: str, src: str, val: str, out: str) -> str:
    """Per gene nnz, mean, sample variance over all cells (zeros implicit), all genes."""
    return f"""
{out}_nz AS (SELECT gene_id, count(*) AS nnz, avg({val}) AS mnz, var_pop({val}) AS vnz FROM {src} GROUP BY gene_id),
{out} AS (
  SELECT g.gene_id, coalesce(s.nnz, 0) AS nnz,
         coalesce(s.mnz * s.nnz / n.n, 0.0) AS mean,
         coalesce((s.vnz * s.nnz + s.mnz * s.mnz * s.nnz * (n.n - s.nnz) / n.n) / (n.n - 1.0), 0.0) AS var
  FROM {prefix}_genes g CROSS JOIN {prefix}_n n LEFT JOIN {out}_nz s ON s.gene_id = g.gene_id)
"""


def hvg(prefix: str, n_top: int, n_bins: int = 20) -> str:
    """T3 over ``{prefix}_ln``: ``{prefix}_hvg(gene_id, means, dispersions, mean_bin, zn, highly_variable)``."""
    return f"""
{zero_aware_stats(prefix, prefix + '_ln', 'exp(x) - 1', prefix + '_hst')},
{prefix}_h1 AS (
  SELECT gene_id, ln(1 + CASE WHEN mean = 0 THEN 1e-12 ELSE mean END) AS means,
         CASE WHEN var / (CASE WHEN mean = 0 THEN 1e-12 ELSE mean END) = 0 THEN NULL
              ELSE ln(var / (CASE WHEN mean = 0 THEN 1e-12 ELSE mean END)) END AS dispersions
  FROM {prefix}_hst),
{prefix}_hmm AS (SELECT min(means) AS lo, max(means) AS hi FROM {prefix}_h1),
{prefix}_h2 AS (
  SELECT h.*, CASE WHEN m.hi = m.lo THEN 1
                   ELSE greatest(1, CAST(ceil((h.means - m.lo) / ((m.hi - m.lo) / {float(n_bins)!r})) AS INTEGER)) END AS mean_bin
  FROM {prefix}_h1 h CROSS JOIN {prefix}_hmm m),
{prefix}_hb AS (
  SELECT mean_bin, avg(dispersions) AS a, stddev_samp(dispersions) AS d, count(dispersions) AS nd
  FROM {prefix}_h2 GROUP BY mean_bin),
{prefix}_hz AS (
  SELECT h.*, round((h.dispersions - CASE WHEN b.nd = 1 THEN 0.0 ELSE b.a END)
                    / nullif(CASE WHEN b.nd = 1 THEN b.a ELSE b.d END, 0.0) * 1e9) / 1e9 AS zn
  FROM {prefix}_h2 h JOIN {prefix}_hb b ON b.mean_bin = h.mean_bin),
{prefix}_hcut AS (SELECT min(zn) AS c FROM (SELECT zn FROM {prefix}_hz WHERE zn IS NOT NULL ORDER BY zn DESC LIMIT {n_top})),
{prefix}_hvg AS (
  SELECT z.gene_id, z.means, z.dispersions, z.mean_bin, z.zn, coalesce(z.zn >= c.c, false) AS highly_variable
  FROM {prefix}_hz z CROSS JOIN {prefix}_hcut c)
"""


def scaled(prefix: str, max_value: float = 10.0) -> str:
    """T5 over HVGs of ``{prefix}_ln``: ``{prefix}_sc(cell_id, gene_id, z)`` for every cell x HVG."""
    return f"""
{prefix}_hv AS (SELECT gene_id FROM {prefix}_hvg WHERE highly_variable),
{prefix}_lnh AS (SELECT l.* FROM {prefix}_ln l JOIN {prefix}_hv h ON h.gene_id = l.gene_id),
{prefix}_msd0_nz AS (SELECT gene_id, count(*) AS nnz, avg(x) AS mnz, var_pop(x) AS vnz FROM {prefix}_lnh GROUP BY gene_id),
{prefix}_msd AS (
  SELECT h.gene_id, coalesce(s.mnz * s.nnz / n.n, 0.0) AS mean,
         CASE WHEN coalesce(sqrt((s.vnz * s.nnz + s.mnz * s.mnz * s.nnz * (n.n - s.nnz) / n.n) / (n.n - 1.0)), 0.0) = 0 THEN 1.0
              ELSE sqrt((s.vnz * s.nnz + s.mnz * s.mnz * s.nnz * (n.n - s.nnz) / n.n) / (n.n - 1.0)) END AS sd
  FROM {prefix}_hv h CROSS JOIN {prefix}_n n LEFT JOIN {prefix}_msd0_nz s ON s.gene_id = h.gene_id),
{prefix}_sc AS (
  SELECT c.cell_id, m.gene_id,
         greatest(-{max_value!r}, least({max_value!r}, (coalesce(l.x, 0.0) - m.mean) / m.sd)) AS z
  FROM {prefix}_cells c CROSS JOIN {prefix}_msd m
  LEFT JOIN {prefix}_lnh l ON l.cell_id = c.cell_id AND l.gene_id = m.gene_id)
"""


# embedding vectors with four fixed labellings as "configurations".
F3 = """
f3 AS (SELECT vec_id AS cell_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings),
f3_asg AS (
  SELECT cell_id, 'label' AS method, 'label' AS cluster_key, CAST(label AS INTEGER) AS cluster FROM f3
  UNION ALL SELECT cell_id, 'label', 'label_mod5', CAST(label % 5 AS INTEGER) FROM f3
  UNION ALL SELECT cell_id, 'label', 'label_mod3', CAST(label % 3 AS INTEGER) FROM f3
  UNION ALL SELECT cell_id, 'id', 'vec_id_mod4', CAST(cell_id % 4 AS INTEGER) FROM f3),
f3_long AS (
  SELECT a.cluster_key, a.cluster, a.cell_id, u.i, u.x
  FROM f3_asg a JOIN (SELECT cell_id, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM f3) u
  ON u.cell_id = a.cell_id),
f3_cen AS (SELECT cluster_key, cluster, i, avg(x) AS c FROM f3_long GROUP BY cluster_key, cluster, i),
f3_sz AS (SELECT cluster_key, cluster, count(*) AS size FROM f3_asg GROUP BY cluster_key, cluster),
f3_dc AS (
  SELECT l.cluster_key, l.cluster, l.cell_id, sum((l.x - c.c) * (l.x - c.c)) AS sq
  FROM f3_long l JOIN f3_cen c ON c.cluster_key = l.cluster_key AND c.cluster = l.cluster AND c.i = l.i
  GROUP BY l.cluster_key, l.cluster, l.cell_id),
f3_pcl AS (SELECT cluster_key, cluster, avg(sqrt(sq)) AS s, sum(sq) AS w FROM f3_dc GROUP BY cluster_key, cluster)
"""

F3_EVAL = """
f3_cd AS (
  SELECT a.cluster_key, a.cluster AS ci, b.cluster AS cj, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS d
  FROM f3_cen a JOIN f3_cen b ON a.cluster_key = b.cluster_key AND a.i = b.i
  GROUP BY a.cluster_key, a.cluster, b.cluster),
f3_r AS (
  SELECT cd.cluster_key, cd.ci, max(CASE WHEN cd.d = 0 THEN 0.0 ELSE (pa.s + pb.s) / cd.d END) AS r
  FROM f3_cd cd
  JOIN f3_pcl pa ON pa.cluster_key = cd.cluster_key AND pa.cluster = cd.ci
  JOIN f3_pcl pb ON pb.cluster_key = cd.cluster_key AND pb.cluster = cd.cj
  GROUP BY cd.cluster_key, cd.ci),
f3_k AS (
  SELECT cluster_key, count(*) AS k, sum(w) AS w, max(abs(s)) AS max_s FROM f3_pcl GROUP BY cluster_key),
f3_n AS (SELECT cluster_key, count(*) AS n FROM f3_asg GROUP BY cluster_key),
f3_maxd AS (SELECT cluster_key, max(d) AS max_d FROM f3_cd GROUP BY cluster_key),
f3_g AS (SELECT i, avg(x) AS g FROM (SELECT generate_subscripts(v, 1) AS i, unnest(v) AS x FROM f3) GROUP BY i),
f3_b AS (
  SELECT c.cluster_key, sum(z.size * c.sq) AS b FROM (
    SELECT cen.cluster_key, cen.cluster, sum((cen.c - g.g) * (cen.c - g.g)) AS sq
    FROM f3_cen cen JOIN f3_g g ON g.i = cen.i GROUP BY cen.cluster_key, cen.cluster) c
  JOIN f3_sz z ON z.cluster_key = c.cluster_key AND z.cluster = c.cluster
  GROUP BY c.cluster_key),
f3_dbchi AS (
  SELECT k.cluster_key, k.k AS n_clusters,
    CASE WHEN k.k < 2 OR k.k >= n.n THEN NULL
         WHEN k.max_s <= 1e-8 OR m.max_d <= 1e-8 THEN 0.0
         ELSE (SELECT avg(r) FROM f3_r WHERE f3_r.cluster_key = k.cluster_key) END AS davies_bouldin_index,
    CASE WHEN k.k < 2 OR k.k >= n.n THEN NULL
         WHEN k.w = 0 THEN 1.0
         ELSE (b.b * (n.n - k.k)) / (k.w * (k.k - 1.0)) END AS calinski_harabasz_index,
    k.w AS inertia
  FROM f3_k k JOIN f3_n n ON n.cluster_key = k.cluster_key JOIN f3_maxd m ON m.cluster_key = k.cluster_key
  JOIN f3_b b ON b.cluster_key = k.cluster_key),
f3_pd AS (
  SELECT a.cell_id AS i, b.cell_id AS j, list_distance(a.v, b.v) AS d
  FROM f3 a JOIN f3 b ON a.cell_id <> b.cell_id),
f3_pk AS (
  SELECT la.cluster_key, pd.i, la.cluster AS own, lb.cluster AS c, sum(pd.d) AS dsum, count(*) AS cnt
  FROM f3_pd pd JOIN f3_asg la ON la.cell_id = pd.i
  JOIN f3_asg lb ON lb.cell_id = pd.j AND lb.cluster_key = la.cluster_key
  GROUP BY la.cluster_key, pd.i, la.cluster, lb.cluster),
f3_pc AS (
  SELECT cluster_key, i, max(CASE WHEN c = own THEN cnt END) AS n_own,
         max(CASE WHEN c = own THEN dsum / cnt END) AS a, min(CASE WHEN c <> own THEN dsum / cnt END) AS b
  FROM f3_pk GROUP BY cluster_key, i),
f3_sil AS (
  SELECT p.cluster_key,
    CASE WHEN k.k < 2 OR k.k >= n.n THEN NULL ELSE
    avg(CASE WHEN coalesce(p.n_own, 0) = 0 THEN 0.0 WHEN greatest(p.a, p.b) = 0 THEN 0.0
             ELSE (p.b - p.a) / greatest(p.a, p.b) END) END AS silhouette_score
  FROM f3_pc p JOIN f3_k k ON k.cluster_key = p.cluster_key JOIN f3_n n ON n.cluster_key = p.cluster_key
  GROUP BY p.cluster_key, k.k, n.n),
f3_ev AS (
  SELECT DISTINCT a.method, d.cluster_key, CAST(d.n_clusters AS BIGINT) AS n_clusters, s.silhouette_score,
         d.davies_bouldin_index, d.calinski_harabasz_index
  FROM f3_dbchi d JOIN f3_sil s ON s.cluster_key = d.cluster_key JOIN f3_asg a ON a.cluster_key = d.cluster_key
  WHERE d.n_clusters >= 2),
f3_mm AS (
  SELECT min(silhouette_score) AS s0, max(silhouette_score) AS s1, min(davies_bouldin_index) AS d0,
         max(davies_bouldin_index) AS d1, min(calinski_harabasz_index) AS c0, max(calinski_harabasz_index) AS c1
  FROM f3_ev),
f3_rank AS (
  SELECT e.*, ((CASE WHEN m.s1 = m.s0 THEN 0.5 ELSE (e.silhouette_score - m.s0) / (m.s1 - m.s0) END)
             + (CASE WHEN m.d1 = m.d0 THEN 0.5 ELSE 1.0 - (e.davies_bouldin_index - m.d0) / (m.d1 - m.d0) END)
             + (CASE WHEN m.c1 = m.c0 THEN 0.5 ELSE (e.calinski_harabasz_index - m.c0) / (m.c1 - m.c0) END)) / 3.0
             AS composite_score
  FROM f3_ev e CROSS JOIN f3_mm m)
"""


def wilcoxon(prefix: str) -> str:
    """M1 + M5-M7 over ``{prefix}_ln`` grouped by ``{prefix}_cells.grp``, densified in SQL."""
    return f"""
{prefix}_cl AS (SELECT cell_id, grp AS cluster FROM {prefix}_cells),
{prefix}_sz AS (SELECT cluster, count(*) AS n_c FROM {prefix}_cl GROUP BY cluster),
{prefix}_dense AS (
  SELECT c.cell_id, c.cluster, g.gene_id, coalesce(l.x, 0.0) AS x
  FROM {prefix}_cl c CROSS JOIN {prefix}_genes g
  LEFT JOIN {prefix}_ln l ON l.cell_id = c.cell_id AND l.gene_id = g.gene_id),
{prefix}_rk AS (
  SELECT *, rank() OVER (PARTITION BY gene_id ORDER BY x)
            + (count(*) OVER (PARTITION BY gene_id, x) - 1) / 2.0 AS r
  FROM {prefix}_dense),
{prefix}_agg AS (SELECT gene_id, cluster, sum(r) AS rs, sum(x) AS s_c FROM {prefix}_rk GROUP BY gene_id, cluster),
{prefix}_gt AS (SELECT gene_id, sum(x) AS s_all FROM {prefix}_dense GROUP BY gene_id),
{prefix}_res AS (
  SELECT a.cluster, a.gene_id,
         round(((a.rs - z.n_c * (n.n + 1) / 2) / sqrt(z.n_c * (n.n - z.n_c) * (n.n + 1) / 12)) * 1e9) / 1e9 AS score,
         log2(((exp(a.s_c / z.n_c) - 1) + 1e-9) / ((exp((t.s_all - a.s_c) / (n.n - z.n_c)) - 1) + 1e-9)) AS logfoldchange
  FROM {prefix}_agg a JOIN {prefix}_sz z ON z.cluster = a.cluster JOIN {prefix}_gt t ON t.gene_id = a.gene_id
  CROSS JOIN {prefix}_n n),
{prefix}_p AS (SELECT *, {P2('score')} AS pval FROM {prefix}_res),
{prefix}_o AS (
  SELECT *, count(*) OVER (PARTITION BY cluster) AS m,
            row_number() OVER (PARTITION BY cluster ORDER BY pval, gene_id) AS prk
  FROM {prefix}_p),
{prefix}_mk AS (
  SELECT cluster, gene_id, score, logfoldchange, pval,
         least(1.0, min(pval * m / prk) OVER (PARTITION BY cluster ORDER BY prk DESC
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS pval_adj
  FROM {prefix}_o)
"""


def top_markers(prefix: str, n_top: int) -> str:
    return f"""
{prefix}_top AS (
  SELECT * FROM (
    SELECT m.cluster, CAST(row_number() OVER (PARTITION BY m.cluster ORDER BY m.score DESC, g.gene_name, m.gene_id) AS INTEGER) AS rank,
           g.gene_name AS gene, m.gene_id, m.score, m.logfoldchange, m.pval, m.pval_adj
    FROM {prefix}_mk m JOIN {prefix}_genes g ON g.gene_id = m.gene_id)
  WHERE rank <= {n_top})
"""
