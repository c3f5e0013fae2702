"""Registered queries: one Spark plan per operator, each paired with an oracle SQL.

Every query reads the warehouse tables of one scale-factor folder (through the
fixture builders of :mod:`cellscape.sources.tables`) and runs over the whole tables.
Float outputs are rounded with ``r6`` in Spark and ``sql_r6`` in the oracle so that
both engines produce identical values.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscape.functions.numeric import r6
from cellscape.operators import qc
from cellscape.plans import sqlparts as S
from cellscape.session import cut_lineage
from cellscape.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

F1_PREFIX = "RED "
F2_QC = qc.QCThresholds(min_genes=20, max_genes=40, max_pct_mito=20.0)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def f1(spark, sf_dir):
    m = tables.supplier_part(spark, sf_dir)
    return m.with_genes(qc.flag_mito_genes(m.genes, F1_PREFIX))


def f2(spark, sf_dir):
    m = tables.customer_partname(spark, sf_dir)
    return m.with_genes(qc.flag_mito_genes(m.genes, F1_PREFIX))


# ----------------------------------------------------------------------------- QC slice

@register("unique_gene_names", f"""
WITH g AS (SELECT p_partkey AS gene_id, p_name AS name FROM part),
occ AS (SELECT gene_id, name, row_number() OVER (PARTITION BY name ORDER BY gene_id) - 1 AS j FROM g),
coll AS (SELECT DISTINCT regexp_extract(name, '^(.*)-([1-9][0-9]*)$', 1) AS base,
                CAST(regexp_extract(name, '^(.*)-([1-9][0-9]*)$', 2) AS BIGINT) AS c
         FROM g WHERE regexp_matches(name, '^(.*)-([1-9][0-9]*)$')),
coll2 AS (SELECT base, c - row_number() OVER (PARTITION BY base ORDER BY c) AS free_below FROM coll),
dups AS (SELECT o.gene_id, o.j + (SELECT count(*) FROM coll2 WHERE coll2.base = o.name AND coll2.free_below < o.j) AS suffix
         FROM occ o WHERE o.j > 0)
SELECT g.gene_id, g.name AS gene_name,
       CASE WHEN d.gene_id IS NULL THEN g.name ELSE g.name || '-' || CAST(d.suffix AS VARCHAR) END AS gene_unique
FROM g LEFT JOIN dups d ON d.gene_id = g.gene_id
""")
def q_unique_gene_names(spark, sf_dir):
    genes = tables.supplier_part(spark, sf_dir).genes
    return qc.unique_gene_names(genes).select("gene_id", "gene_name", "gene_unique")


@register("flag_mito_genes", f"""
WITH {S.F1} SELECT gene_id, gene_name, mt FROM f1_genes
""")
def q_flag_mito_genes(spark, sf_dir):
    return f1(spark, sf_dir).genes.select("gene_id", "gene_name", "mt")


@register("attach_gene_flags", f"""
WITH {S.F1} SELECT e.cell_id, e.gene_id, e.value, g.mt FROM f1_expr e JOIN f1_genes g ON e.gene_id = g.gene_id
""")
def q_attach_gene_flags(spark, sf_dir):
    m = f1(spark, sf_dir)
    return qc.attach_gene_flags(m.expr, m.genes, ["mt"]).select("cell_id", "gene_id", "value", "mt")


@register("cell_qc_metrics", f"""
WITH {S.F1}, {S.cell_qc('f1')}
SELECT cell_id, n_genes_by_counts, {S.R('total_counts')} AS total_counts,
       {S.R('total_counts_mt')} AS total_counts_mt, {S.R('pct_counts_mt')} AS pct_counts_mt
FROM f1_qc
""")
def q_cell_qc_metrics(spark, sf_dir):
    out = qc.cell_qc_metrics(f1(spark, sf_dir))
    return out.select(
        "cell_id", "n_genes_by_counts", r6("total_counts").alias("total_counts"),
        r6("total_counts_mt").alias("total_counts_mt"), r6("pct_counts_mt").alias("pct_counts_mt"),
    )


@register("gene_qc_metrics", f"""
WITH {S.F1},
n AS (SELECT count(*) AS n FROM f1_cells),
a AS (SELECT gene_id, count_if(value <> 0) AS nc, sum(value) AS tot FROM f1_expr GROUP BY gene_id)
SELECT g.gene_id, CAST(coalesce(a.nc, 0) AS BIGINT) AS n_cells_by_counts,
       {S.R('coalesce(a.tot, 0.0)')} AS total_counts,
       {S.R('coalesce(a.tot, 0.0) / n.n')} AS mean_counts,
       {S.R('(1.0 - coalesce(a.nc, 0) / n.n) * 100.0')} AS pct_dropout_by_counts
FROM f1_genes g CROSS JOIN n LEFT JOIN a ON a.gene_id = g.gene_id
""")
def q_gene_qc_metrics(spark, sf_dir):
    out = qc.gene_qc_metrics(f1(spark, sf_dir))
    return out.select(
        "gene_id", "n_cells_by_counts", r6("total_counts").alias("total_counts"),
        r6("mean_counts").alias("mean_counts"), r6("pct_dropout_by_counts").alias("pct_dropout_by_counts"),
    )


@register("filter_min_genes", f"""
WITH {S.F2}, {S.cell_qc('f2')}
SELECT cell_id, n_genes_by_counts FROM f2_qc WHERE n_genes_by_counts >= {F2_QC.min_genes}
""")
def q_filter_min_genes(spark, sf_dir):
    cq = qc.cell_qc_metrics(f2(spark, sf_dir))
    return qc.filter_min_genes(cq, F2_QC.min_genes).select("cell_id", "n_genes_by_counts")


@register("filter_max_genes", f"""
WITH {S.F2}, {S.cell_qc('f2')}
SELECT cell_id, n_genes_by_counts FROM f2_qc WHERE n_genes_by_counts <= {F2_QC.max_genes}
""")
def q_filter_max_genes(spark, sf_dir):
    cq = qc.cell_qc_metrics(f2(spark, sf_dir))
    return qc.filter_max_genes(cq, F2_QC.max_genes).select("cell_id", "n_genes_by_counts")


@register("filter_max_pct_mito", f"""
WITH {S.F2}, {S.cell_qc('f2')}
SELECT cell_id, {S.R('pct_counts_mt')} AS pct_counts_mt FROM f2_qc WHERE pct_counts_mt <= {F2_QC.max_pct_mito}
""")
def q_filter_max_pct_mito(spark, sf_dir):
    cq = qc.cell_qc_metrics(f2(spark, sf_dir))
    return qc.filter_max_pct_mito(cq, F2_QC.max_pct_mito).select("cell_id", r6("pct_counts_mt").alias("pct_counts_mt"))


@register("qc_filter_report", f"""
WITH {S.F2}, {S.cell_qc('f2')}
SELECT n_before, n_after, n_before - n_after AS n_removed FROM (
  SELECT CAST(count(*) AS BIGINT) AS n_before,
         CAST(sum(CASE WHEN n_genes_by_counts >= {F2_QC.min_genes} AND n_genes_by_counts <= {F2_QC.max_genes}
                  AND coalesce(pct_counts_mt <= {F2_QC.max_pct_mito}, false) THEN 1 ELSE 0 END) AS BIGINT) AS n_after
  FROM f2_qc)
""")
def q_qc_filter_report(spark, sf_dir):
    cq = qc.cell_qc_metrics(f2(spark, sf_dir))
    return qc.qc_filter_report(cq, F2_QC)


# ----------------------------------------------------------------------------- transforms (F1)

from cellscape.operators import transform as T  # noqa: E402

F1_TOP = 50


def f1_lognorm(spark, sf_dir):
    return T.normalize_log(f1(spark, sf_dir))


def f1_hvg(spark, sf_dir):
    m = f1_lognorm(spark, sf_dir)
    return m, T.hvg_dispersion(m, n_top_genes=F1_TOP)


@register("normalize_total", f"""
WITH {S.F1}, {S.lognorm('f1')}
SELECT cell_id, gene_id, {S.R('y')} AS value FROM f1_norm
""")
def q_normalize_total(spark, sf_dir):
    e = T.normalize_total(f1(spark, sf_dir)).expr
    return e.select("cell_id", "gene_id", r6("value").alias("value"))


@register("log1p_transform", f"""
WITH {S.F1}, {S.lognorm('f1')}
SELECT cell_id, gene_id, {S.R('x')} AS value FROM f1_ln
""")
def q_log1p_transform(spark, sf_dir):
    e = f1_lognorm(spark, sf_dir).expr
    return e.select("cell_id", "gene_id", r6("value").alias("value"))


@register("hvg_dispersion", f"""
WITH {S.F1}, {S.lognorm('f1')}, {S.hvg('f1', F1_TOP)}
SELECT gene_id, {S.R('means')} AS means, {S.R('dispersions')} AS dispersions, mean_bin,
       {S.R('zn')} AS dispersions_norm, highly_variable
FROM f1_hvg
""")
def q_hvg_dispersion(spark, sf_dir):
    _, h = f1_hvg(spark, sf_dir)
    return h.select(
        "gene_id", r6("means").alias("means"), r6("dispersions").alias("dispersions"), "mean_bin",
        r6("dispersions_norm").alias("dispersions_norm"), "highly_variable",
    )


@register("hvg_scatter", f"""
WITH {S.F1}, {S.lognorm('f1')}, {S.hvg('f1', F1_TOP)}
SELECT h.gene_id, p.p_name AS gene_name, {S.R('h.means')} AS mean, {S.R('h.dispersions')} AS dispersion,
       {S.R('h.zn')} AS dispersion_norm, h.highly_variable
FROM f1_hvg h JOIN part p ON p.p_partkey = h.gene_id
""")
def q_hvg_scatter(spark, sf_dir):
    m, h = f1_hvg(spark, sf_dir)
    return h.join(m.genes.select("gene_id", "gene_name"), "gene_id").select(
        "gene_id", "gene_name", r6("means").alias("mean"), r6("dispersions").alias("dispersion"),
        r6("dispersions_norm").alias("dispersion_norm"), "highly_variable",
    )


@register("hvg_vst", f"""
WITH {S.F1}, f1_n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM f1_cells),
{S.zero_aware_stats('f1', 'f1_expr', 'value', 'st')},
v AS (SELECT gene_id, mean, log10(mean) AS x, log10(var) AS y FROM st WHERE var > 0 AND mean > 0),
b AS (SELECT min(x) AS lo, max(x) AS hi, greatest(1, floor(count(*) * 0.3 + 1e-5)) AS q FROM v),
a AS (SELECT i, lo + (hi - lo) * i / 99.0 AS pos, q FROM b, range(100) r(i)),
h AS (SELECT i, pos, d AS h FROM (SELECT i, pos, q, abs(x - pos) AS d, row_number() OVER (PARTITION BY i ORDER BY abs(x - pos)) AS rn
                                FROM a, v) WHERE rn = q),
w AS (SELECT i, y, (x - pos) / h AS t, pow(1 - pow(abs((x - pos) / h), 3), 3) AS w FROM h, v WHERE abs(x - pos) < h),
s AS (SELECT i, sum(w) AS s0, sum(w * t) AS s1, sum(w * t * t) AS s2, sum(w * pow(t, 3)) AS s3, sum(w * pow(t, 4)) AS s4,
             sum(w * y) AS r0, sum(w * y * t) AS r1, sum(w * y * t * t) AS r2 FROM w GROUP BY i),
dt AS (SELECT *, s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2) AS det FROM s),
f AS (SELECT i, CASE WHEN det > 1e-9 * s0 * s2 * s4
                     THEN (r0 * (s2 * s4 - s3 * s3) - s1 * (r1 * s4 - s3 * r2) + s2 * (r1 * s3 - s2 * r2)) / det
                     WHEN s0 * s2 - s1 * s1 > 1e-9 * s0 * s2 THEN (r0 * s2 - s1 * r1) / (s0 * s2 - s1 * s1) ELSE r0 / s0 END AS v FROM dt),
p AS (SELECT gene_id, mean, (x - lo) / ((hi - lo) / 99.0) AS p FROM v, b),
e AS (SELECT gene_id, mean, sqrt(pow(10, l.v + (p - l.i) * (u.v - l.v))) AS dev
      FROM p JOIN f l ON l.i = least(floor(p), 98) JOIN f u ON u.i = l.i + 1),
c AS (SELECT gene_id, sum(least(value, dev * sqrt(n) + mean)) AS total, sum(pow(least(value, dev * sqrt(n) + mean), 2)) AS sq
      FROM f1_expr JOIN e USING (gene_id), f1_n GROUP BY gene_id),
z AS (SELECT st.gene_id, st.mean, st.var, coalesce(round((n * e.mean * e.mean + sq - 2 * e.mean * total) / ((n - 1) * dev * dev) * 1e9) / 1e9, 0) AS vn
      FROM st CROSS JOIN f1_n LEFT JOIN e USING (gene_id) LEFT JOIN c USING (gene_id)),
k AS (SELECT *, row_number() OVER (ORDER BY vn DESC, gene_id) - 1 AS rk FROM z)
SELECT gene_id, {S.R('mean')} AS means, {S.R('var')} AS variances, {S.R('vn')} AS variances_norm,
       CAST(CASE WHEN rk < {F1_TOP} THEN rk END AS DOUBLE) AS highly_variable_rank, rk < {F1_TOP} AS highly_variable FROM k
""")
def q_hvg_vst(spark, sf_dir):
    h = T.hvg_vst(f1(spark, sf_dir), n_top_genes=F1_TOP)
    return h.select("gene_id", *(r6(c).alias(c) for c in ("means", "variances", "variances_norm")),
                    F.col("highly_variable_rank").cast("double").alias("highly_variable_rank"), "highly_variable")


@register("subset_hvg", f"""
WITH {S.F1}, {S.lognorm('f1')}, {S.hvg('f1', F1_TOP)}
SELECT l.cell_id, l.gene_id, {S.R('l.x')} AS value
FROM f1_ln l JOIN f1_hvg h ON h.gene_id = l.gene_id WHERE h.highly_variable
""")
def q_subset_hvg(spark, sf_dir):
    m, h = f1_hvg(spark, sf_dir)
    e = T.subset_hvg(m, h).expr
    return e.select("cell_id", "gene_id", r6("value").alias("value"))


@register("scale_clip", f"""
WITH {S.F1}, {S.lognorm('f1')}, {S.hvg('f1', F1_TOP)}, {S.scaled('f1')}
SELECT cell_id, gene_id, {S.R('z')} AS value FROM f1_sc
""")
def q_scale_clip(spark, sf_dir):
    m, h = f1_hvg(spark, sf_dir)
    sub = T.subset_hvg(m, h)
    vec = T.scale_clip(sub)
    out = T.vectors_to_long(vec, T.gene_order(sub.genes))
    return out.select("cell_id", "gene_id", r6("value").alias("value"))


# ----------------------------------------------------------------------------- labels & evaluation

from cellscape.operators import evaluate as EV  # noqa: E402
from cellscape.operators import labels as LB  # noqa: E402
from cellscape.operators import neighbors as NB  # noqa: E402

# Four fixed labellings of the vectors act as clustering configurations.
F3_LABELLINGS = [
    ("label", "label", "label"),
    ("label", "label_mod5", "label % 5"),
    ("label", "label_mod3", "label % 3"),
    ("id", "vec_id_mod4", "cell_id % 4"),
]


def f3_vectors(spark, sf_dir):
    return tables.vectors(spark, sf_dir)


def f3_assignments(spark, sf_dir):
    """One scan of the vectors, every labelling produced by one explode."""
    v = tables.vectors(spark, sf_dir)
    cfg = F.array(*[
        F.struct(F.lit(m).alias("method"), F.lit(k).alias("cluster_key"), F.expr(e).cast("int").alias("cluster"))
        for m, k, e in F3_LABELLINGS
    ])
    return v.select("cell_id", F.explode(cfg).alias("a")).select("cell_id", "a.method", "a.cluster_key", "a.cluster")


def f3_ranked(spark, sf_dir):
    ev = EV.evaluate_all(f3_vectors(spark, sf_dir), f3_assignments(spark, sf_dir))
    return EV.composite_score(ev)


EVAL_COLS = ["method", "cluster_key", "n_clusters", "silhouette_score", "davies_bouldin_index",
             "calinski_harabasz_index"]


def _eval_select(df, with_composite=True):
    cols = ["method", "cluster_key", "n_clusters"] + [
        r6(c).alias(c) for c in EVAL_COLS[3:] + (["composite_score"] if with_composite else [])
    ]
    return df.select(*cols)


def _eval_sql(src, with_composite=True):
    extra = f", {S.R('composite_score')} AS composite_score" if with_composite else ""
    return (f"SELECT method, cluster_key, n_clusters, {S.R('silhouette_score')} AS silhouette_score, "
            f"{S.R('davies_bouldin_index')} AS davies_bouldin_index, "
            f"{S.R('calinski_harabasz_index')} AS calinski_harabasz_index{extra} FROM {src}")


@register("attach_labels", f"""
WITH {S.F3} SELECT a.cell_id, a.cluster_key, a.cluster, f3.label FROM f3_asg a JOIN f3 ON f3.cell_id = a.cell_id
""")
def q_attach_labels(spark, sf_dir):
    cells = f3_vectors(spark, sf_dir).select("cell_id", "label")
    return LB.attach_labels(cells, f3_assignments(spark, sf_dir)).select("cell_id", "cluster_key", "cluster", "label")


@register("cluster_counts", f"""
WITH {S.F3} SELECT cluster_key, count(DISTINCT cluster) AS n_clusters FROM f3_asg GROUP BY cluster_key
""")
def q_cluster_counts(spark, sf_dir):
    return LB.cluster_counts(f3_assignments(spark, sf_dir))


@register("cluster_sizes", f"""
WITH {S.F3} SELECT cluster_key, cluster, count(*) AS size FROM f3_asg GROUP BY cluster_key, cluster
""")
def q_cluster_sizes(spark, sf_dir):
    return LB.cluster_sizes(f3_assignments(spark, sf_dir))


@register("cluster_centroids", f"""
WITH {S.F3}
SELECT c.cluster_key, c.cluster, CAST(c.i - 1 AS INTEGER) AS dim, {S.R('c.c')} AS value, z.size
FROM f3_cen c JOIN f3_sz z ON z.cluster_key = c.cluster_key AND z.cluster = c.cluster
""")
def q_cluster_centroids(spark, sf_dir):
    lab = LB.with_labels(f3_vectors(spark, sf_dir), f3_assignments(spark, sf_dir))
    c = LB.cluster_centroids(lab)
    return c.select("cluster_key", "cluster", "size", F.posexplode("centroid").alias("dim", "value")).select(
        "cluster_key", "cluster", F.col("dim").cast("int").alias("dim"), r6("value").alias("value"), "size"
    )


@register("relabel_by_size", f"""
WITH {S.F3}
SELECT cluster_key, cluster, size,
       CAST(row_number() OVER (PARTITION BY cluster_key ORDER BY size DESC, first_id) - 1 AS INTEGER) AS new_cluster
FROM (SELECT cluster_key, cluster, count(*) AS size, min(cell_id) AS first_id FROM f3_asg GROUP BY cluster_key, cluster)
""")
def q_relabel_by_size(spark, sf_dir):
    return LB.relabel_by_size(f3_assignments(spark, sf_dir))


def _truth_pred(spark, sf_dir):
    v = f3_vectors(spark, sf_dir)
    truth = v.select("cell_id", F.col("label").cast("string").alias("label"))
    pred = v.select("cell_id", (F.col("cell_id") % 4).cast("string").alias("label"))
    return truth, pred


CONF_SQL = """
tp AS (SELECT vec_id AS cell_id, CAST(label AS VARCHAR) AS truth, CAST(vec_id % 4 AS VARCHAR) AS pred FROM embeddings),
cnt AS (SELECT truth, pred, count(*) AS n FROM tp GROUP BY truth, pred),
grid AS (SELECT t.truth, p.pred FROM (SELECT DISTINCT truth FROM tp) t CROSS JOIN (SELECT DISTINCT pred FROM tp) p),
conf AS (SELECT g.truth, g.pred, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM grid g LEFT JOIN cnt c
         ON c.truth = g.truth AND c.pred = g.pred)
"""


@register("confusion_counts", f"WITH {CONF_SQL} SELECT truth, pred, n FROM conf")
def q_confusion_counts(spark, sf_dir):
    return LB.confusion_counts(*_truth_pred(spark, sf_dir))


@register("cluster_purity", f"""
WITH {CONF_SQL}
SELECT c.truth, c.pred, c.n, {S.R('c.n / greatest(t.tot, 1)')} AS fraction
FROM conf c JOIN (SELECT truth, sum(n) AS tot FROM conf GROUP BY truth) t ON t.truth = c.truth
""")
def q_cluster_purity(spark, sf_dir):
    p = LB.cluster_purity(LB.confusion_counts(*_truth_pred(spark, sf_dir)))
    return p.select("truth", "pred", "n", r6("fraction").alias("fraction"))


@register("kmeans_inertia", f"""
WITH {S.F3} SELECT cluster_key, {S.R('sum(w)')} AS inertia FROM f3_pcl GROUP BY cluster_key
""")
def q_kmeans_inertia(spark, sf_dir):
    out = EV.kmeans_inertia(f3_vectors(spark, sf_dir), f3_assignments(spark, sf_dir))
    return out.select("cluster_key", r6("inertia").alias("inertia"))


@register("kmeans_elbow", f"""
WITH {S.F3}
SELECT CAST(count(*) AS BIGINT) AS k, {S.R('sum(w)')} AS inertia FROM f3_pcl GROUP BY cluster_key
""")
def q_kmeans_elbow(spark, sf_dir):
    """C8 on fixed labellings: (k, inertia) with k = number of clusters of the labelling."""
    a = f3_assignments(spark, sf_dir)
    out = EV.kmeans_inertia(f3_vectors(spark, sf_dir), a).join(LB.cluster_counts(a), "cluster_key")
    return out.select(F.col("n_clusters").cast("bigint").alias("k"), r6("inertia").alias("inertia")).orderBy("k")


@register("davies_bouldin", f"""
WITH {S.F3}, {S.F3_EVAL} SELECT cluster_key, {S.R('davies_bouldin_index')} AS davies_bouldin_index FROM f3_dbchi
""")
def q_davies_bouldin(spark, sf_dir):
    d = EV.davies_bouldin_and_calinski(f3_vectors(spark, sf_dir), f3_assignments(spark, sf_dir))
    return d.select("cluster_key", r6("davies_bouldin_index").alias("davies_bouldin_index"))


@register("calinski_harabasz", f"""
WITH {S.F3}, {S.F3_EVAL} SELECT cluster_key, {S.R('calinski_harabasz_index')} AS calinski_harabasz_index FROM f3_dbchi
""")
def q_calinski_harabasz(spark, sf_dir):
    d = EV.davies_bouldin_and_calinski(f3_vectors(spark, sf_dir), f3_assignments(spark, sf_dir))
    return d.select("cluster_key", r6("calinski_harabasz_index").alias("calinski_harabasz_index"))


@register("silhouette_exact", f"""
WITH {S.F3}, {S.F3_EVAL} SELECT cluster_key, {S.R('silhouette_score')} AS silhouette_score FROM f3_sil
""")
def q_silhouette_exact(spark, sf_dir):
    s = EV.silhouette_exact(f3_vectors(spark, sf_dir), f3_assignments(spark, sf_dir))
    return s.select("cluster_key", r6("silhouette_score").alias("silhouette_score"))


@register("silhouette_scalable", f"""
WITH {S.F3},
vv AS (SELECT vec_id AS cell_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pd AS (SELECT x.cell_id AS i, y.cell_id AS j, list_distance(x.v, y.v) ** 2 AS d FROM vv x JOIN vv y ON x.cell_id <> y.cell_id),
md AS (SELECT la.cluster_key, pd.i, la.cluster AS own, lb.cluster AS other, avg(pd.d) AS d
       FROM pd JOIN f3_asg la ON la.cell_id = pd.i JOIN f3_asg lb ON lb.cell_id = pd.j AND lb.cluster_key = la.cluster_key
       GROUP BY ALL),
ab AS (SELECT cluster_key, i, max(d) FILTER (WHERE own = other) AS a, min(d) FILTER (WHERE own <> other) AS b
       FROM md GROUP BY ALL),
kn AS (SELECT cluster_key, count(DISTINCT cluster) AS k, count(*) AS n FROM f3_asg GROUP BY 1)
SELECT cluster_key, {S.R("avg(CASE WHEN k < 2 OR k >= n THEN NULL WHEN a IS NULL OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END)")} AS silhouette_score
FROM ab JOIN kn USING (cluster_key) GROUP BY cluster_key
""")
def q_silhouette_scalable(spark, sf_dir):
    s = EV.silhouette_scalable(f3_vectors(spark, sf_dir), f3_assignments(spark, sf_dir))
    return s.select("cluster_key", r6("silhouette_score").alias("silhouette_score"))


@register("evaluate_all", f"WITH {S.F3}, {S.F3_EVAL} {_eval_sql('f3_ev', False)}")
def q_evaluate_all(spark, sf_dir):
    ev = EV.evaluate_all(f3_vectors(spark, sf_dir), f3_assignments(spark, sf_dir))
    return _eval_select(ev, with_composite=False)


@register("composite_score", f"WITH {S.F3}, {S.F3_EVAL} {_eval_sql('f3_rank')}")
def q_composite_score(spark, sf_dir):
    return _eval_select(f3_ranked(spark, sf_dir))


@register("recommend_best", f"""
WITH {S.F3}, {S.F3_EVAL} {_eval_sql('f3_rank')} ORDER BY composite_score DESC NULLS LAST, cluster_key LIMIT 1
""")
def q_recommend_best(spark, sf_dir):
    return _eval_select(EV.recommend_best(f3_ranked(spark, sf_dir)))


@register("silhouette_bars", f"""
WITH {S.F3}, {S.F3_EVAL}
SELECT CAST(row_number() OVER (ORDER BY composite_score DESC NULLS LAST, cluster_key) AS INTEGER) AS position,
       method, cluster_key, {S.R('silhouette_score')} AS silhouette_score,
       CAST(dense_rank() OVER (ORDER BY method) - 1 AS INTEGER) AS color_index
FROM f3_rank
""")
def q_silhouette_bars(spark, sf_dir):
    b = EV.silhouette_bars(f3_ranked(spark, sf_dir))
    return b.select(F.col("position").cast("int").alias("position"), "method", "cluster_key",
                    r6("silhouette_score").alias("silhouette_score"),
                    F.col("color_index").cast("int").alias("color_index"))


# ----------------------------------------------------------------------------- markers (F2, group = market segment)

from cellscape.operators import markers as MK  # noqa: E402

F2_TOP = 5


def f2_lognorm(spark, sf_dir):
    return T.normalize_log(f2(spark, sf_dir))


def f2_markers(spark, sf_dir):
    m = f2_lognorm(spark, sf_dir)
    return m, MK.markers_wilcoxon(m)


def f2_top(spark, sf_dir, n_top=F2_TOP):
    m, res = f2_markers(spark, sf_dir)
    return m, MK.top_markers(res, m.genes, n_top)


MARKER_COLS_SQL = (f"cluster, rank, gene, {S.R('score')} AS score, {S.R('logfoldchange')} AS logfoldchange, "
                   f"{S.R('pval')} AS pval, {S.R('pval_adj')} AS pval_adj")


def _marker_cols(df):
    return df.select("cluster", "rank", "gene", r6("score").alias("score"), r6("logfoldchange").alias("logfoldchange"),
                     r6("pval").alias("pval"), r6("pval_adj").alias("pval_adj"))


@register("markers_wilcoxon", f"""
WITH {S.F2}, {S.lognorm('f2')}, {S.wilcoxon('f2')}, {S.top_markers('f2', F2_TOP)}
SELECT {MARKER_COLS_SQL} FROM f2_top
""")
def q_markers_wilcoxon(spark, sf_dir):
    _, top = f2_top(spark, sf_dir)
    return _marker_cols(top)


@register("top_markers", f"""
WITH {S.F2}, {S.lognorm('f2')}, {S.wilcoxon('f2')}, {S.top_markers('f2', 10)}
SELECT cluster, rank, gene, {S.R('score')} AS score FROM f2_top
""")
def q_top_markers(spark, sf_dir):
    _, top = f2_top(spark, sf_dir, 10)
    return top.select("cluster", "rank", "gene", r6("score").alias("score"))


@register("log_fold_change", f"""
WITH {S.F2}, {S.lognorm('f2')}, {S.wilcoxon('f2')}
SELECT cluster, gene_id, {S.R('logfoldchange')} AS logfoldchange FROM f2_mk
""")
def q_log_fold_change(spark, sf_dir):
    _, res = f2_markers(spark, sf_dir)
    return res.select("cluster", "gene_id", r6("logfoldchange").alias("logfoldchange"))


@register("normal_pvalue", f"""
WITH {S.F2}, {S.lognorm('f2')}, {S.wilcoxon('f2')}
SELECT cluster, gene_id, {S.R('score')} AS score, {S.R('pval')} AS pval FROM f2_mk
""")
def q_normal_pvalue(spark, sf_dir):
    _, res = f2_markers(spark, sf_dir)
    return res.select("cluster", "gene_id", r6("score").alias("score"), r6("pval").alias("pval"))


@register("bh_adjust", f"""
WITH {S.F2}, {S.lognorm('f2')}, {S.wilcoxon('f2')}
SELECT cluster, gene_id, {S.R('pval_adj')} AS pval_adj FROM f2_mk
""")
def q_bh_adjust(spark, sf_dir):
    _, res = f2_markers(spark, sf_dir)
    return res.select("cluster", "gene_id", r6("pval_adj").alias("pval_adj"))


@register("markers_to_expression", f"""
WITH {S.F2}, {S.lognorm('f2')}, {S.wilcoxon('f2')}, {S.top_markers('f2', F2_TOP)}
SELECT DISTINCT l.cell_id, c.grp AS cluster, l.gene_id, t.gene, {S.R('l.x')} AS value
FROM f2_ln l JOIN (SELECT DISTINCT gene_id, gene FROM f2_top) t ON t.gene_id = l.gene_id
JOIN f2_cells c ON c.cell_id = l.cell_id
""")
def q_markers_to_expression(spark, sf_dir):
    m, top = f2_top(spark, sf_dir)
    e = MK.markers_to_expression(m, top)
    return e.select("cell_id", "cluster", "gene_id", "gene", r6("value").alias("value"))


@register("marker_dotplot", f"""
WITH {S.F2}, {S.lognorm('f2')}, {S.wilcoxon('f2')}, {S.top_markers('f2', F2_TOP)},
tg AS (SELECT DISTINCT gene_id, gene FROM f2_top)
SELECT z.cluster, tg.gene, tg.gene_id,
       {S.R('coalesce(sum(l.x), 0.0) / z.n_c')} AS mean_expression,
       {S.R('count(l.x) FILTER (WHERE l.x > 0) / z.n_c')} AS fraction_expressing
FROM f2_sz z CROSS JOIN tg
LEFT JOIN (SELECT l.*, c.cluster FROM f2_ln l JOIN f2_cl c ON c.cell_id = l.cell_id) l
  ON l.cluster = z.cluster AND l.gene_id = tg.gene_id
GROUP BY z.cluster, tg.gene, tg.gene_id, z.n_c
""")
def q_marker_dotplot(spark, sf_dir):
    m, top = f2_top(spark, sf_dir)
    d = MK.marker_dotplot(m, top)
    return d.select("cluster", "gene", "gene_id", r6("mean_expression").alias("mean_expression"),
                    r6("fraction_expressing").alias("fraction_expressing"))


@register("marker_heatmap", f"""
WITH {S.F2}, {S.lognorm('f2')}, {S.wilcoxon('f2')}, {S.top_markers('f2', F2_TOP)},
tg AS (SELECT DISTINCT gene_id, gene FROM f2_top)
SELECT c.cell_id, c.cluster, tg.gene, tg.gene_id, {S.R('coalesce(l.x, 0.0)')} AS value
FROM f2_cl c CROSS JOIN tg LEFT JOIN f2_ln l ON l.cell_id = c.cell_id AND l.gene_id = tg.gene_id
""")
def q_marker_heatmap(spark, sf_dir):
    m, top = f2_top(spark, sf_dir)
    h = MK.marker_heatmap(m, top)
    return h.select("cell_id", "cluster", "gene", "gene_id", r6("value").alias("value"))


@register("group_correlation", f"""
WITH {S.F2}, {S.lognorm('f2')}, {S.wilcoxon('f2')},
mu AS (SELECT a.gene_id, a.cluster, a.s_c / z.n_c AS mu FROM f2_agg a JOIN f2_sz z ON z.cluster = a.cluster)
SELECT a.cluster AS cluster_a, b.cluster AS cluster_b, {S.R('corr(a.mu, b.mu)')} AS correlation
FROM mu a JOIN mu b ON a.gene_id = b.gene_id GROUP BY a.cluster, b.cluster
""")
def q_group_correlation(spark, sf_dir):
    c = MK.group_correlation(f2_lognorm(spark, sf_dir))
    return c.select("cluster_a", "cluster_b", r6("correlation").alias("correlation"))


# ----------------------------------------------------------------------------- sources and sinks

from cellscape.sources import matrix_io as IO  # noqa: E402

F1_TRIPLES_SQL = f"""
WITH {S.F1}
SELECT CAST(cell_id AS VARCHAR) AS cell, CAST(gene_id AS VARCHAR) AS gene, {S.R('value')} AS value FROM f1_expr
"""


def f1_named(spark, sf_dir):
    """F1 with string names: cell = supplier key, gene = part key (unique column names)."""
    m = tables.supplier_part(spark, sf_dir)
    return m.with_cells(m.cells.withColumn("cell_name", F.col("cell_id").cast("string"))).with_genes(
        m.genes.withColumn("gene_name", F.col("gene_id").cast("string")))


def _named_triples(m):
    return (m.expr.join(m.cells.select("cell_id", "cell_name"), "cell_id")
            .join(m.genes.select("gene_id", "gene_name"), "gene_id")
            .select(F.col("cell_name").alias("cell"), F.col("gene_name").alias("gene"), r6("value").alias("value")))


@register("read_counts_csv", F1_TRIPLES_SQL)
def q_read_counts_csv(spark, sf_dir):
    path = IO.write_counts_csv(f1_named(spark, sf_dir), IO.scratch_path(spark, "f1-csv"), codec="lz4")
    return _named_triples(IO.read_counts_csv(spark, path))


@register("orient_matrix", f"""
WITH {S.F1}
SELECT CAST(gene_id AS VARCHAR) AS cell, CAST(cell_id AS VARCHAR) AS gene, {S.R('value')} AS value FROM f1_expr
""")
def q_orient_matrix(spark, sf_dir):
    """F1 has more genes (columns) than cells (rows): the file is kept as cells x genes.
    Its transpose (genes as rows) has fewer columns than rows and is flipped back."""
    m = f1_named(spark, sf_dir)
    flipped = IO.orient_matrix(m, layout="genes_x_cells")
    path = IO.write_counts_csv(flipped, IO.scratch_path(spark, "f1t-csv"), codec="lz4")
    back = IO.orient_matrix(IO.read_counts_csv(spark, path))   # auto rule: columns < rows -> transpose
    return _named_triples(IO.orient_matrix(back, layout="genes_x_cells"))


@register("read_counts_mtx", F1_TRIPLES_SQL)
def q_read_counts_mtx(spark, sf_dir):
    folder = IO.write_counts_mtx(f1_named(spark, sf_dir), IO.scratch_path(spark, "f1-mtx"))
    return _named_triples(IO.read_counts_mtx(spark, folder))


@register("matrix_bundle_roundtrip", f"""
WITH {S.F1} SELECT cell_id, gene_id, {S.R('value')} AS value FROM f1_expr
""")
def q_matrix_bundle_roundtrip(spark, sf_dir):
    path = IO.write_bundle(f1(spark, sf_dir), IO.scratch_path(spark, "f1") + ".bundle")
    return IO.load_counts(spark, path).expr.select("cell_id", "gene_id", r6("value").alias("value"))


@register("default_dataset", f"""
WITH {S.F2} SELECT cell_id, gene_id, {S.R('value')} AS value FROM f2_expr
""")
def q_default_dataset(spark, sf_dir):
    return IO.load_counts(spark, None, sf_dir=sf_dir).expr.select("cell_id", "gene_id", r6("value").alias("value"))


@register("matrix_summary", f"""
WITH {S.F1}
SELECT (SELECT count(*) FROM f1_cells) AS n_cells, (SELECT count(*) FROM f1_genes) AS n_genes,
       (SELECT count(*) FROM f1_expr) AS nnz
""")
def q_matrix_summary(spark, sf_dir):
    m = f1(spark, sf_dir)
    return m.cells.agg(F.count(F.lit(1)).alias("n_cells")).select(
        "n_cells", m.n_genes().alias("n_genes"), m.expr.select(F.count(F.lit(1))).scalar().alias("nnz"))


EVAL_SCHEMA = ("method string, cluster_key string, n_clusters long, silhouette_score double, "
               "davies_bouldin_index double, calinski_harabasz_index double, composite_score double")


@register("write_evaluation", f"WITH {S.F3}, {S.F3_EVAL} {_eval_sql('f3_rank')}")
def q_write_evaluation(spark, sf_dir):
    path = IO.write_table_csv(f3_ranked(spark, sf_dir), IO.scratch_path(spark, "evaluation-csv"))
    return _eval_select(IO.read_table_csv(spark, path, EVAL_SCHEMA))


MARKER_SCHEMA = "cluster string, rank int, gene string, score double, logfoldchange double, pval double, pval_adj double"


@register("write_markers", f"""
WITH {S.F2}, {S.lognorm('f2')}, {S.wilcoxon('f2')}, {S.top_markers('f2', F2_TOP)}
SELECT {MARKER_COLS_SQL} FROM f2_top
""")
def q_write_markers(spark, sf_dir):
    _, top = f2_top(spark, sf_dir)
    path = IO.write_table_csv(top.drop("gene_id"), IO.scratch_path(spark, "markers-csv"))
    return _marker_cols(IO.read_table_csv(spark, path, MARKER_SCHEMA))


# ----------------------------------------------------------------------------- PCA and neighbours

from cellscape.operators import reduce as RD  # noqa: E402

N_PCS, N_PCS_USE, N_NEIGHBORS = 50, 30, 15


def f3_pca(spark, sf_dir):
    return RD.pca(f3_vectors(spark, sf_dir).select("cell_id", "v"), N_PCS)


def f3_pcs(spark, sf_dir):
    """The first principal components, on which neighbours are searched."""
    scores, _, _ = f3_pca(spark, sf_dir)
    return cut_lineage(RD.slice_pcs(scores, N_PCS_USE))


@register("pca")
def q_pca(spark, sf_dir):
    scores, _, _ = f3_pca(spark, sf_dir)
    return scores.select("cell_id", F.posexplode("v").alias("pc", "score"))


@register("pca_variance")
def q_pca_variance(spark, sf_dir):
    _, ratios, _ = f3_pca(spark, sf_dir)
    return ratios


@register("scree_table")
def q_scree_table(spark, sf_dir):
    _, ratios, _ = f3_pca(spark, sf_dir)
    return RD.scree_table(ratios)


@register("pca_total_variance", """
WITH d AS (SELECT generate_subscripts(CAST(embedding AS DOUBLE[]), 1) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x
           FROM embeddings)
SELECT """ + S.R("sum(v)") + """ AS total_variance FROM (SELECT i, var_samp(x) AS v FROM d GROUP BY i)
""")
def q_pca_total_variance(spark, sf_dir):
    return RD.total_variance(f3_vectors(spark, sf_dir)).select(r6("total_variance").alias("total_variance"))


@register("slice_pcs", """
SELECT vec_id AS cell_id, CAST(u.i - 1 AS INTEGER) AS dim, """ + S.R("u.x") + """ AS value
FROM (SELECT vec_id, generate_subscripts(CAST(embedding AS DOUBLE[]), 1) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x
      FROM embeddings) u WHERE u.i <= 30
""")
def q_slice_pcs(spark, sf_dir):
    v = RD.slice_pcs(f3_vectors(spark, sf_dir), N_PCS_USE)
    return v.select("cell_id", F.posexplode("v").alias("dim", "value")).select(
        "cell_id", F.col("dim").cast("int").alias("dim"), r6("value").alias("value"))


@register("pairwise_distance", f"""
WITH f3 AS (SELECT vec_id AS cell_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pd AS (SELECT a.cell_id, list_distance(a.v, b.v) AS d FROM f3 a JOIN f3 b ON a.cell_id <> b.cell_id)
SELECT cell_id, count(*) AS n_others, {S.R('avg(d)')} AS mean_distance, {S.R('max(d)')} AS max_distance FROM pd GROUP BY cell_id
""")
def q_pairwise_distance(spark, sf_dir):
    """Every cell against every other, summed up per cell."""
    d = NB.distance_summary(f3_vectors(spark, sf_dir))
    return d.select("cell_id", "n_others", r6("mean_distance").alias("mean_distance"), r6("max_distance").alias("max_distance"))


@register("knn_exact", f"""
WITH f3 AS (SELECT vec_id AS cell_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pd AS (SELECT a.cell_id AS src, b.cell_id AS dst, round(list_distance(a.v, b.v) * 1e9) / 1e9 AS dist
       FROM f3 a JOIN f3 b ON true),
rk AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM pd)
SELECT src, dst, CAST(rank AS INTEGER) AS rank, {S.R('dist')} AS dist FROM rk WHERE rank <= {N_NEIGHBORS}
""")
def q_knn_exact(spark, sf_dir):
    k = NB.knn_exact(f3_vectors(spark, sf_dir), N_NEIGHBORS)
    return k.select("src", "dst", "rank", r6("dist").alias("dist"))


# ----------------------------------------------------------------------------- k-means sweep (F3 PCA scores)

from cellscape.operators import kmeans as KM  # noqa: E402

K_RANGE = list(range(2, 11))


def f3_kmeans(spark, sf_dir):
    scores, _, _ = f3_pca(spark, sf_dir)
    return KM.kmeans_sweep(scores, K_RANGE, n_init=10, seed=42)


@register("kmeans_sweep")
def q_kmeans_sweep(spark, sf_dir):
    assignments, _, _ = f3_kmeans(spark, sf_dir)
    return assignments


@register("kmeans_elbow_sweep")
def q_kmeans_elbow_sweep(spark, sf_dir):
    """C8 on the sweep itself: (k, inertia of the best run) ordered by k."""
    _, inertia, _ = f3_kmeans(spark, sf_dir)
    return inertia.select("k", "inertia").orderBy("k")


# ----------------------------------------------------------------------------- graphs and communities

from cellscape.operators import graph as GR  # noqa: E402
from cellscape.operators import layout as LY  # noqa: E402

RESOLUTIONS = [0.3, 0.5, 0.8, 1.0, 1.5]


def f3_knn(spark, sf_dir):
    return NB.knn_exact(f3_pcs(spark, sf_dir), N_NEIGHBORS)


def f3_fuzzy(spark, sf_dir):
    return GR.fuzzy_graph(f3_knn(spark, sf_dir), N_NEIGHBORS)


def _knn_sql(k: int) -> str:
    """knn(src, dst, rank, dist) of the vectors on all coordinates."""
    return f"""f3 AS (SELECT vec_id AS cell_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pd AS (SELECT a.cell_id AS src, b.cell_id AS dst, round(list_distance(a.v, b.v) * 1e9) / 1e9 AS dist FROM f3 a JOIN f3 b ON true),
knn AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM pd) WHERE rank <= {k})"""


def _bisection_sql(high: str) -> str:
    """r(src, i, lo, hi, mid): the steps of the bisection over the lists of b; ``high`` tells whether mid is too high."""
    return f"""r AS (SELECT src, 0 AS i, 0.0::DOUBLE AS lo, NULL::DOUBLE AS hi, 1.0::DOUBLE AS mid FROM b
UNION ALL SELECT src, i + 1, CASE WHEN high THEN lo ELSE mid END, CASE WHEN high THEN mid ELSE hi END,
                 CASE WHEN high THEN (lo + mid) / 2 WHEN hi IS NULL THEN mid * 2 ELSE (mid + hi) / 2 END
          FROM (SELECT r.*, {high} AS high FROM r JOIN b USING (src) WHERE i < {GR.STEPS}))"""


@register("fuzzy_graph", f"""
WITH RECURSIVE {_knn_sql(N_NEIGHBORS)},
b AS (SELECT src, list(dist ORDER BY rank) AS d, list(dist ORDER BY rank) FILTER (WHERE rank > 1) AS o,
             coalesce(min(dist) FILTER (WHERE dist > 0), 0) AS rho, log2(count(*)) AS target FROM knn GROUP BY src),
{_bisection_sql("list_sum(list_transform(o, lambda x: CASE WHEN x > rho THEN exp((rho - x) / mid) ELSE 1 END)) > target")},
s AS (SELECT b.src, rho, greatest(mid, 1e-3 * CASE WHEN rho > 0 THEN list_avg(d) ELSE (SELECT avg(dist) FROM knn) END) AS sigma
      FROM r JOIN b ON b.src = r.src AND r.i = {GR.STEPS}),
a AS (SELECT src, dst, CASE WHEN dist <= rho OR sigma = 0 THEN 1 ELSE exp((rho - dist) / sigma) END AS a FROM knn JOIN s USING (src) WHERE src <> dst)
SELECT coalesce(x.src, y.dst) AS src, coalesce(x.dst, y.src) AS dst,
       {S.R('coalesce(x.a, 0) + coalesce(y.a, 0) - coalesce(x.a, 0) * coalesce(y.a, 0)')} AS w
FROM a x FULL JOIN a y ON x.src = y.dst AND x.dst = y.src
""")
def q_fuzzy_graph(spark, sf_dir):
    """D5 on the 15 nearest vectors by all coordinates; the flows use the principal components."""
    knn = cut_lineage(NB.knn_exact(f3_vectors(spark, sf_dir), N_NEIGHBORS))
    return GR.fuzzy_graph(knn, N_NEIGHBORS).select("src", "dst", r6("w").alias("w"))


@register("graph_modularity", f"""
WITH {S.F3},
v AS (SELECT vec_id AS cell_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pd AS (SELECT a.cell_id AS src, b.cell_id AS dst, round(list_distance(a.v, b.v) * 1e9) / 1e9 AS dist
       FROM v a JOIN v b ON true),
knn AS (SELECT src, dst FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM pd)
        WHERE rank <= {N_NEIGHBORS} AND src <> dst),
e AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM knn UNION ALL SELECT dst AS src, src AS dst FROM knn)),
m2 AS (SELECT CAST(count(*) AS DOUBLE) AS m2 FROM e),
deg AS (SELECT src AS cell_id, CAST(count(*) AS DOUBLE) AS k FROM e GROUP BY src),
tot AS (SELECT a.cluster_key, a.cluster, sum(d.k) AS tot FROM f3_asg a JOIN deg d ON d.cell_id = a.cell_id
        GROUP BY a.cluster_key, a.cluster),
pen AS (SELECT cluster_key, sum(tot * tot) AS sq FROM tot GROUP BY cluster_key),
ins AS (SELECT la.cluster_key, CAST(count(*) AS DOUBLE) AS inside FROM e
        JOIN f3_asg la ON la.cell_id = e.src
        JOIN f3_asg lb ON lb.cell_id = e.dst AND lb.cluster_key = la.cluster_key AND lb.cluster = la.cluster
        GROUP BY la.cluster_key)
SELECT p.cluster_key, {S.R('coalesce(i.inside, 0.0) / m2.m2 - p.sq / (m2.m2 * m2.m2)')} AS modularity
FROM pen p CROSS JOIN m2 LEFT JOIN ins i ON i.cluster_key = p.cluster_key
""")
def q_graph_modularity(spark, sf_dir):
    edges = cut_lineage(GR.knn_graph(NB.knn_exact(f3_vectors(spark, sf_dir), N_NEIGHBORS)))
    q = GR.modularity(edges, f3_assignments(spark, sf_dir), 1.0)
    return q.select("cluster_key", r6("modularity").alias("modularity"))


def f3_louvain(spark, sf_dir, refine=False):
    pcs = cut_lineage(f3_pcs(spark, sf_dir))
    graph = GR.fuzzy_graph(cut_lineage(NB.knn_exact(pcs, N_NEIGHBORS)), N_NEIGHBORS)
    return GR.community_sweep(cut_lineage(graph), RESOLUTIONS, refine, pcs)


@register("louvain_sweep")
def q_louvain_sweep(spark, sf_dir):
    return f3_louvain(spark, sf_dir, refine=False)


@register("leiden_sweep")
def q_leiden_sweep(spark, sf_dir):
    return f3_louvain(spark, sf_dir, refine=True)


@register("cluster_stability")
def q_cluster_stability(spark, sf_dir):
    return GR.cluster_stability(f3_louvain(spark, sf_dir, refine=True))


# ----------------------------------------------------------------------------- gene sets, t-test, QC boxes (F2)

from cellscape.operators import charts as CH  # noqa: E402
from cellscape.operators import genesets as GS  # noqa: E402
from cellscape.operators import markers_ttest as TT  # noqa: E402

# Stand-in gene lists (part names present at every scale) for the S and
# G2M phase lists, and one name that is absent on purpose.
S_LIST = ["blue bolt", "cold gear", "hot rod", "large plate"]
G2M_LIST = ["new anvil", "old widget", "small ring", "red gizmo"]
ABSENT = "green sprocket"


def _sql_list(names):
    return ", ".join("('" + n.replace("'", "''") + "')" for n in names)


def _score_sql(tag: str, names: list[str], ctrl: int) -> str:
    return f"""
{tag}_avg AS (
  SELECT g.gene_id, g.gene_name AS name, coalesce(s.s, 0.0) / n.n AS avg
  FROM f2_genes g CROSS JOIN f2_n n LEFT JOIN (SELECT gene_id, sum(x) AS s FROM f2_ln GROUP BY gene_id) s
  ON s.gene_id = g.gene_id),
{tag}_rk AS (
  SELECT a.*, floor(rank() OVER (ORDER BY a.avg) / round_even((SELECT count(*) FROM {tag}_avg) / 24.0, 0)) AS bin
  FROM {tag}_avg a),
{tag}_lst AS (SELECT * FROM (VALUES {_sql_list(names)}) t(name)),
{tag}_in AS (SELECT r.* FROM {tag}_rk r WHERE r.name IN (SELECT name FROM {tag}_lst)),
{tag}_pick AS (
  SELECT r.*, row_number() OVER (PARTITION BY r.bin ORDER BY md5(r.name || '0'), r.gene_id) AS o
  FROM {tag}_rk r WHERE r.bin IN (SELECT bin FROM {tag}_in)),
{tag}_ctrl AS (SELECT gene_id FROM {tag}_pick WHERE o <= {ctrl} AND name NOT IN (SELECT name FROM {tag}_lst)),
{tag}_w AS (
  SELECT gene_id, 1.0 / (SELECT count(*) FROM {tag}_in) AS w FROM {tag}_in
  UNION ALL SELECT gene_id, -1.0 / (SELECT count(*) FROM {tag}_ctrl) AS w FROM {tag}_ctrl),
{tag}_s AS (SELECT l.cell_id, sum(w.w * l.x) AS s FROM f2_ln l JOIN {tag}_w w ON w.gene_id = l.gene_id GROUP BY l.cell_id),
{tag}_score AS (SELECT c.cell_id, coalesce(s.s, 0.0) AS score FROM f2_cells c LEFT JOIN {tag}_s s ON s.cell_id = c.cell_id)
"""


@register("gene_set_overlap", f"""
WITH lists AS (SELECT 'S' AS gene_set, name AS gene_name FROM (VALUES {_sql_list(S_LIST + [ABSENT])}) t(name)
               UNION ALL SELECT 'G2M', name FROM (VALUES {_sql_list(G2M_LIST)}) t(name)),
names AS (SELECT DISTINCT p_name FROM part)
SELECT l.gene_set, l.gene_name, l.gene_name IN (SELECT p_name FROM names) AS present FROM lists l
""")
def q_gene_set_overlap(spark, sf_dir):
    return GS.gene_set_overlap(tables.part_name_genes(spark, sf_dir), {"S": S_LIST + [ABSENT], "G2M": G2M_LIST})


@register("gene_set_score", f"""
WITH {S.F2}, {S.lognorm('f2')}, {_score_sql('s', S_LIST, len(S_LIST))}
SELECT cell_id, {S.R('score')} AS score FROM s_score
""")
def q_gene_set_score(spark, sf_dir):
    scores, _ = GS.gene_set_score(f2_lognorm(spark, sf_dir), S_LIST, ctrl_size=len(S_LIST))
    return scores.select("cell_id", r6("score").alias("score"))


@register("cell_cycle_phase", f"""
WITH {S.F2}, {S.lognorm('f2')}, {_score_sql('s', S_LIST, 4)}, {_score_sql('g', G2M_LIST, 4)}
SELECT a.cell_id, {S.R('a.score')} AS S_score, {S.R('b.score')} AS G2M_score,
       CASE WHEN a.score < 0 AND b.score < 0 THEN 'G1' WHEN b.score > a.score THEN 'G2M' ELSE 'S' END AS phase
FROM s_score a JOIN g_score b ON b.cell_id = a.cell_id
""")
def q_cell_cycle_phase(spark, sf_dir):
    p = GS.cell_cycle_phase(f2_lognorm(spark, sf_dir), S_LIST, G2M_LIST)
    return p.select("cell_id", r6("S_score").alias("S_score"), r6("G2M_score").alias("G2M_score"), "phase")


def _ttest_sql(overestim: bool) -> str:
    n2se = "z.n_c" if overestim else "(n.n - z.n_c)"
    return f"""
WITH {S.F2}, {S.lognorm('f2')},
cl AS (SELECT cell_id, grp AS cluster FROM f2_cells),
sz AS (SELECT cluster, CAST(count(*) AS DOUBLE) AS n_c FROM cl GROUP BY cluster),
grid AS (SELECT g.gene_id, z.cluster, z.n_c FROM f2_genes g CROSS JOIN sz z),
pc AS (SELECT l.gene_id, c.cluster, sum(l.x) AS s, sum(l.x * l.x) AS q FROM f2_ln l JOIN cl c ON c.cell_id = l.cell_id
       GROUP BY l.gene_id, c.cluster),
tot AS (SELECT gene_id, sum(s) AS s_all, sum(q) AS q_all FROM pc GROUP BY gene_id),
st AS (SELECT g.gene_id, g.cluster, g.n_c AS n1, n.n - g.n_c AS n2, {('g.n_c' if overestim else 'n.n - g.n_c')} AS n2se,
              coalesce(p.s, 0.0) / g.n_c AS mu1, (coalesce(t.s_all, 0.0) - coalesce(p.s, 0.0)) / (n.n - g.n_c) AS mu2,
              coalesce(p.q, 0.0) AS q1, coalesce(t.q_all, 0.0) - coalesce(p.q, 0.0) AS q2
       FROM grid g CROSS JOIN f2_n n LEFT JOIN pc p ON p.gene_id = g.gene_id AND p.cluster = g.cluster
       LEFT JOIN tot t ON t.gene_id = g.gene_id),
v AS (SELECT *, (q1 - n1 * mu1 * mu1) / (n1 - 1) AS v1, (q2 - n2 * mu2 * mu2) / (n2 - 1) AS v2 FROM st),
t AS (SELECT *, (mu1 - mu2) / nullif(sqrt(v1 / n1 + v2 / n2se), 0.0) AS t FROM v)
SELECT cluster, gene_id, {S.R('coalesce(CASE WHEN isnan(t) THEN NULL ELSE t END, 0.0)')} AS score,
       {S.R('log2(((exp(mu1) - 1) + 1e-9) / ((exp(mu2) - 1) + 1e-9))')} AS logfoldchange
FROM t
"""


@register("markers_ttest", _ttest_sql(False))
def q_markers_ttest(spark, sf_dir):
    r = TT.markers_ttest(f2_lognorm(spark, sf_dir))
    return r.select("cluster", "gene_id", r6("score").alias("score"), r6("logfoldchange").alias("logfoldchange"))


@register("markers_ttest_overestim", _ttest_sql(True))
def q_markers_ttest_overestim(spark, sf_dir):
    r = TT.markers_ttest(f2_lognorm(spark, sf_dir), overestim_var=True)
    return r.select("cluster", "gene_id", r6("score").alias("score"), r6("logfoldchange").alias("logfoldchange"))


@register("markers_ttest_pvalues")
def q_markers_ttest_pvalues(spark, sf_dir):
    """Welch p-values and BH adjustment (Student-t tail in a pandas UDF; property-checked)."""
    r = TT.markers_ttest(f2_lognorm(spark, sf_dir))
    return r.select("cluster", "gene_id", r6("pval").alias("pval"), r6("pval_adj").alias("pval_adj"))


@register("violin_box", f"""
WITH {S.F2}, {S.cell_qc('f2')},
after AS (SELECT * FROM f2_qc WHERE n_genes_by_counts >= {F2_QC.min_genes} AND n_genes_by_counts <= {F2_QC.max_genes}
          AND coalesce(pct_counts_mt <= {F2_QC.max_pct_mito}, false)),
long AS (
  SELECT 'before' AS stage, 'n_genes_by_counts' AS metric, CAST(n_genes_by_counts AS DOUBLE) AS v FROM f2_qc
  UNION ALL SELECT 'before', 'total_counts', total_counts FROM f2_qc
  UNION ALL SELECT 'before', 'pct_counts_mt', pct_counts_mt FROM f2_qc WHERE pct_counts_mt IS NOT NULL
  UNION ALL SELECT 'after', 'n_genes_by_counts', CAST(n_genes_by_counts AS DOUBLE) FROM after
  UNION ALL SELECT 'after', 'total_counts', total_counts FROM after
  UNION ALL SELECT 'after', 'pct_counts_mt', pct_counts_mt FROM after WHERE pct_counts_mt IS NOT NULL),
q AS (SELECT stage, metric, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med,
             quantile_cont(v, 0.75) AS q3 FROM long GROUP BY stage, metric)
SELECT q.stage, q.metric, q.n, {S.R('q.q1')} AS q1, {S.R('q.med')} AS median, {S.R('q.q3')} AS q3,
       {S.R('min(l.v) FILTER (WHERE l.v >= q.q1 - 1.5 * (q.q3 - q.q1))')} AS whisker_low,
       {S.R('max(l.v) FILTER (WHERE l.v <= q.q3 + 1.5 * (q.q3 - q.q1))')} AS whisker_high
FROM q JOIN long l ON l.stage = q.stage AND l.metric = q.metric
GROUP BY q.stage, q.metric, q.n, q.q1, q.med, q.q3
""")
def q_violin_box(spark, sf_dir):
    cq = qc.cell_qc_metrics(f2(spark, sf_dir))
    after = cq.where(qc.qc_keep_condition(F2_QC))
    b = CH.violin_box(cq, after)
    return b.select("stage", "metric", "n", *[r6(c).alias(c) for c in ["q1", "median", "q3", "whisker_low", "whisker_high"]])


# ----------------------------------------------------------------------------- embeddings, compositions, logreg

@register("embedding_colors", """
SELECT 'label' AS color_key, vec_id AS cell_id, CAST(label AS VARCHAR) AS value FROM embeddings
UNION ALL
SELECT 'label_mod3', vec_id, CAST(label % 3 AS VARCHAR) FROM embeddings
""")
def q_embedding_colors(spark, sf_dir):
    """J5 (cell columns): the colour side of C5, which SQL can express; the layouts are in embedding_scatter."""
    v = f3_vectors(spark, sf_dir)
    return _scatter(v, v.select("cell_id", F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))).select("color_key", "cell_id", "value")


def _scatter(v, basis):
    cells = v.select("cell_id", "label", (F.col("label") % 3).alias("label_mod3"))
    return CH.embedding_scatter(basis, {"label": CH.color_by_cell_column(basis, cells, "label"),
                                        "label_mod3": CH.color_by_cell_column(basis, cells, "label_mod3")})


@register("embedding_scatter")
def q_embedding_scatter(spark, sf_dir):
    """The PCA, UMAP and t-SNE layouts, each coloured by two cell columns."""
    v = f3_vectors(spark, sf_dir)
    d = WF.run_dimension_reduction(v.select("cell_id", "v"))
    bases = {"pca": d.scores.select("cell_id", F.col("v")[0].alias("x"), F.col("v")[1].alias("y")),
             "umap": d.umap.positions, "tsne": d.tsne.positions}
    parts = [_scatter(v, b).withColumn("basis", F.lit(name)) for name, b in bases.items()]
    return functools.reduce(DataFrame.unionByName, parts).withColumns({c: r6(c) for c in "xy"})


@register("color_embedding", f"""
WITH {S.F2}, {S.lognorm('f2')}, {S.cell_qc('f2')},
g AS (SELECT min(p_partkey) AS gene_id FROM part WHERE p_name = '{S_LIST[0]}')
SELECT q.cell_id, CAST(q.n_genes_by_counts AS DOUBLE) AS x, {S.R('q.total_counts')} AS y,
       {S.R('coalesce(l.x, 0.0)')} AS color
FROM f2_qc q LEFT JOIN (SELECT l.* FROM f2_ln l JOIN g ON g.gene_id = l.gene_id) l ON l.cell_id = q.cell_id
""")
def q_color_embedding(spark, sf_dir):
    """J5 (gene): the QC basis (genes, total counts) coloured by one gene's log-normalised value."""
    m = f2(spark, sf_dir)
    basis = qc.cell_qc_metrics(m).select("cell_id", F.col("n_genes_by_counts").cast("double").alias("x"),
                                         r6("total_counts").alias("y"))
    gid = m.genes.where(F.col("gene_name") == S_LIST[0]).select(F.min("gene_id")).first()[0]
    out = CH.color_by_gene(basis, T.normalize_log(m).expr, gid)
    return out.select("cell_id", "x", "y", r6("color").alias("color"))


F2_PRE = qc.QCThresholds(min_genes=F2_QC.min_genes, max_genes=F2_QC.max_genes, max_pct_mito=F2_QC.max_pct_mito)
F2_PRE_TOP = 20


def f2_written(spark, sf_dir):
    """The matrix with its entries written once, for flows that read them many times."""
    m = f2(spark, sf_dir)
    return m.with_expr(cut_lineage(m.expr))


def preprocessed(m, thresholds, n_top):
    """QC filter -> normalise -> log -> dispersion HVG -> subset -> scale (vectors); with the logged matrix of all genes (P8) first."""
    kept = cut_lineage(qc.cell_qc_metrics(m).where(qc.qc_keep_condition(thresholds)).select("cell_id"))
    ln = T.normalize_log(m.restrict_cells(kept))
    sub = T.subset_hvg(ln, T.hvg_dispersion(ln, n_top_genes=n_top))
    return ln, sub, T.scale_clip(sub)


def f2_preprocessed(spark, sf_dir, m=None):
    """T10 of ``m``, which is the F2 matrix if it is not given, with the thresholds of the filter queries."""
    return preprocessed(m or f2_written(spark, sf_dir), F2_PRE, F2_PRE_TOP)[1:]


@register("preprocess_full", f"""
WITH {S.F2.replace('f2_cells AS (SELECT c_custkey AS cell_id, c_mktsegment AS grp FROM customer)', 'f2_cells0 AS (SELECT c_custkey AS cell_id, c_mktsegment AS grp FROM customer)').replace('f2_expr AS (', 'f2_expr0 AS (')},
f2_cells_q AS (SELECT * FROM f2_cells0),
{S.cell_qc('f2').replace('f2_cells c', 'f2_cells0 c').replace('f2_expr e', 'f2_expr0 e')},
f2_cells AS (SELECT c.* FROM f2_cells0 c JOIN f2_qc q ON q.cell_id = c.cell_id
             WHERE q.n_genes_by_counts >= {F2_PRE.min_genes} AND q.n_genes_by_counts <= {F2_PRE.max_genes}
             AND coalesce(q.pct_counts_mt <= {F2_PRE.max_pct_mito}, false)),
f2_expr AS (SELECT e.* FROM f2_expr0 e WHERE e.cell_id IN (SELECT cell_id FROM f2_cells)),
{S.lognorm('f2')}, {S.hvg('f2', F2_PRE_TOP)}, {S.scaled('f2')}
SELECT cell_id, gene_id, {S.R('z')} AS value FROM f2_sc
""")
def q_preprocess_full(spark, sf_dir):
    sub, vec = f2_preprocessed(spark, sf_dir)
    out = T.vectors_to_long(vec, T.gene_order(sub.genes))
    return out.select("cell_id", "gene_id", r6("value").alias("value"))


@register("markers_logreg")
def q_markers_logreg(spark, sf_dir):
    r = MK.markers_logreg(f2_lognorm(spark, sf_dir))
    w = __import__("pyspark.sql.window", fromlist=["Window"]).Window.partitionBy("cluster").orderBy(F.desc("score"), "gene_id")
    return r.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F2_TOP).select(
        "cluster", F.col("rank").cast("int").alias("rank"), "gene_id", r6("score").alias("score"))


@register("violin_density", f"""
WITH {S.F2}, {S.cell_qc('f2')},
after AS (SELECT * FROM f2_qc WHERE n_genes_by_counts >= {F2_QC.min_genes} AND n_genes_by_counts <= {F2_QC.max_genes}
          AND coalesce(pct_counts_mt <= {F2_QC.max_pct_mito}, false)),
long AS (
  SELECT 'before' AS stage, 'n_genes_by_counts' AS metric, CAST(n_genes_by_counts AS DOUBLE) AS v FROM f2_qc
  UNION ALL SELECT 'before', 'total_counts', total_counts FROM f2_qc
  UNION ALL SELECT 'before', 'pct_counts_mt', pct_counts_mt FROM f2_qc WHERE pct_counts_mt IS NOT NULL
  UNION ALL SELECT 'after', 'n_genes_by_counts', CAST(n_genes_by_counts AS DOUBLE) FROM after
  UNION ALL SELECT 'after', 'total_counts', total_counts FROM after
  UNION ALL SELECT 'after', 'pct_counts_mt', pct_counts_mt FROM after WHERE pct_counts_mt IS NOT NULL),
st AS (SELECT stage, metric, count(*) AS n, stddev_samp(v) * pow(CAST(count(*) AS DOUBLE), -0.2) AS bw,
              min(v) AS lo, max(v) AS hi FROM long GROUP BY stage, metric),
grid AS (SELECT s.*, i, (s.lo - 2.0 * s.bw) + i * ((s.hi - s.lo + 4.0 * s.bw) / 99.0) AS x
         FROM st s CROSS JOIN range(0, 100) r(i) WHERE s.bw > 0),
dv AS (SELECT stage, metric, v, count(*) AS c FROM long GROUP BY stage, metric, v)
SELECT g.stage, g.metric, CAST(g.i AS INTEGER) AS i, {S.R('g.x')} AS x,
       {S.R('sum(d.c * exp(-pow(g.x - d.v, 2) / (2 * g.bw * g.bw))) / (g.n * g.bw * sqrt(2 * pi()))')} AS density
FROM grid g JOIN dv d ON d.stage = g.stage AND d.metric = g.metric
GROUP BY g.stage, g.metric, g.i, g.x, g.n, g.bw
""")
def q_violin_density(spark, sf_dir):
    cq = qc.cell_qc_metrics(f2(spark, sf_dir))
    d = CH.violin_density(cq, cq.where(qc.qc_keep_condition(F2_QC)))
    return d.select("stage", "metric", "i", r6("x").alias("x"), r6("density").alias("density"))


@register("regress_out")
def q_regress_out(spark, sf_dir):
    """T8 + T9: cell-cycle scores regressed out of the scaled matrix, then scaled again."""
    m = f2_written(spark, sf_dir)
    sub, vec = f2_preprocessed(spark, sf_dir, m)
    kept = cut_lineage(qc.cell_qc_metrics(m).where(qc.qc_keep_condition(F2_PRE)).select("cell_id"))
    logged = T.normalize_log(m.restrict_cells(kept))
    phase = GS.cell_cycle_phase(logged.with_expr(cut_lineage(logged.expr)), S_LIST, G2M_LIST)
    res = cut_lineage(GS.regress_out(cut_lineage(vec), cut_lineage(phase)))
    # Scale + clip again, on the residual vectors (dense): mean / sd per position.
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    st = res.select(vector_to_array(Summarizer.mean(array_to_vector("v"))).alias("mu"),
                    vector_to_array(Summarizer.variance(array_to_vector("v"))).alias("var")).first()
    mu = F.lit([float(x) for x in st.mu])
    sd = F.lit([float(x) ** 0.5 if x > 0 else 1.0 for x in st.var])
    z = F.zip_with(F.zip_with("v", mu, lambda a, b: a - b), sd, lambda a, b: F.greatest(F.least(a / b, F.lit(10.0)), F.lit(-10.0)))
    out = T.vectors_to_long(res.select("cell_id", z.alias("v")), T.gene_order(sub.genes))
    return out.select("cell_id", "gene_id", r6("value").alias("value"))


@register("tsne_affinities", f"""
WITH RECURSIVE {_knn_sql(91)},
e AS (SELECT src, dst, dist * dist - min(dist * dist) OVER (PARTITION BY src) AS d2 FROM knn WHERE src <> dst),
b AS (SELECT src, list(d2) AS d2 FROM e GROUP BY src),
{_bisection_sql("ln(list_sum(list_transform(d2, lambda x: exp(-mid * x)))) + mid * list_sum(list_transform(d2, lambda x: x * exp(-mid * x)))"
                " / list_sum(list_transform(d2, lambda x: exp(-mid * x))) < ln(30)")},
c AS (SELECT src, dst, exp(-mid * e.d2) / sum(exp(-mid * e.d2)) OVER (PARTITION BY src) AS p
      FROM e JOIN (SELECT src, mid FROM r WHERE i = {GR.STEPS}) USING (src)),
j AS (SELECT coalesce(x.src, y.dst) AS src, coalesce(x.dst, y.src) AS dst, coalesce(x.p, 0) + coalesce(y.p, 0) AS p
      FROM c x FULL JOIN c y ON x.src = y.dst AND x.dst = y.src)
SELECT src, dst, {S.R('1e6 * p / (SELECT sum(p) FROM j)')} AS p_ppm FROM j
""")
def q_tsne_affinities(spark, sf_dir):
    """Perplexity 30 on the 91 nearest vectors (self + 3 x 30) by all coordinates; the flows use the components."""
    knn = cut_lineage(NB.knn_exact(f3_vectors(spark, sf_dir), 91))
    return GR.tsne_affinities(knn, 30.0).select("src", "dst", r6(F.col("p") * 1e6).alias("p_ppm"))


@register("knn_approx")
def q_knn_approx(spark, sf_dir):
    v = f3_pcs(spark, sf_dir)
    return NB.knn_approx(v, N_NEIGHBORS).select("src", "dst", "rank", r6("dist").alias("dist"))


@register("knn_recall")
def q_knn_recall(spark, sf_dir):
    """Recall of the inverted-file search, whose target is 0.95 on its sample, against the exact search."""
    v = f3_pcs(spark, sf_dir)
    return NB.knn_recall(NB.knn_approx(v, N_NEIGHBORS), NB.knn_exact(v, N_NEIGHBORS))


from cellscape.operators import ward as WD  # noqa: E402


@register("hierarchical_sweep")
def q_hierarchical_sweep(spark, sf_dir):
    """G7 on the PCA scores, k = 2..10, one Ward tree cut at every k."""
    scores, _, _ = f3_pca(spark, sf_dir)
    out, _ = WD.ward_sweep(scores, K_RANGE)
    return out


from cellscape.plans import workflow as WF  # noqa: E402


@register("clustering_evaluation")
def q_clustering_evaluation(spark, sf_dir):
    """G8 + E5-E7 with the default methods (Leiden at 5 resolutions, k-means k = 2..10)
    on the PCA scores of the vectors: the ranked evaluation table."""
    scores, _, _ = f3_pca(spark, sf_dir)
    scores = cut_lineage(scores)
    asg, _ = WF.run_clustering(scores, WF.ClusteringConfig())
    ranked, _ = WF.run_evaluation(scores, asg)
    return _eval_select(ranked)


#: The workload's defaults, so that the report covers the matrix: 2,000 variable genes, at most 5,000 genes and 20 % a cell.  Its least
#: number of genes, 200, is beyond what F2 has names; 1 leaves out the empty cells.
REPORT_QC, REPORT_TOP = qc.QCThresholds(min_genes=1, max_genes=5000, max_pct_mito=20.0), 2000


def report_matrix(spark, sf_dir):
    """T10 for the marker report: the logged matrix of all genes and the scaled vectors of the variable ones."""
    ln, _, vec = preprocessed(f2_written(spark, sf_dir), REPORT_QC, REPORT_TOP)
    return ln, vec


@register("marker_report")
def q_marker_report(spark, sf_dir):
    """T10 -> D1 -> G3 -> E5-E7 -> M9 on customers x part names: markers (top 10, Wilcoxon)
    of the best configuration of the default methods, computed on the log-normalised all-gene matrix."""
    raw, vec = report_matrix(spark, sf_dir)
    scores, _, _ = RD.pca(cut_lineage(vec), N_PCS)
    scores = cut_lineage(scores)
    asg, _ = WF.run_clustering(scores, WF.ClusteringConfig())
    _, best = WF.run_evaluation(scores, asg)
    top = WF.marker_report(raw, asg, best, 10)
    return _marker_cols(top)


@register("resolve_color_keys", f"""
WITH {S.F3}, {S.F3_EVAL},
best AS (SELECT cluster_key FROM f3_rank ORDER BY composite_score DESC NULLS LAST, cluster_key LIMIT 1),
cand AS (SELECT 0 AS pos, cluster_key AS color_key FROM best UNION ALL SELECT 1, 'label' UNION ALL SELECT 2, 'vec_id_mod4'),
d AS (SELECT color_key, min(pos) AS pos FROM cand GROUP BY color_key)
SELECT CAST(row_number() OVER (ORDER BY pos) AS INTEGER) AS position, color_key, 'obs' AS source FROM d
""")
def q_resolve_color_keys(spark, sf_dir):
    """P13 on the vectors' evaluation: recommended key, first key per method, QC columns
    (absent on these cells, hence dropped), resolved against cell columns and gene names."""
    best = EV.recommend_best(f3_ranked(spark, sf_dir))
    firsts = []
    for method in dict.fromkeys(m for m, _, _ in F3_LABELLINGS):
        firsts.append(next(k for m, k, _ in F3_LABELLINGS if m == method))
    obs_cols = f3_vectors(spark, sf_dir).columns + [k for _, k, _ in F3_LABELLINGS]
    genes = tables.part_name_genes(spark, sf_dir)
    return CH.resolve_color_keys(best, firsts, obs_cols, raw_genes=genes, genes=genes)


@register("dimension_reduction")
def q_dimension_reduction(spark, sf_dir):
    """Per cell its fuzzy-graph degree, its t-SNE affinity mass and both layouts, on one neighbour table."""
    d = WF.run_dimension_reduction(f3_vectors(spark, sf_dir).select("cell_id", "v"))
    deg = d.graph.groupBy(F.col("src").alias("cell_id")).agg(F.sum("w").alias("graph_degree"))
    mass = d.affinities.groupBy(F.col("src").alias("cell_id")).agg((F.sum("p") * 1e6).alias("affinity_mass_ppm"))
    out = d.umap.positions.toDF("cell_id", "umap_x", "umap_y").join(d.tsne.positions.toDF("cell_id", "tsne_x", "tsne_y"), "cell_id")
    out = out.join(deg, "cell_id", "left").join(mass, "cell_id", "left")
    return out.select("cell_id", *(r6(c).alias(c) for c in out.columns[1:]))


@register("tsne_layout")
def q_tsne_layout(spark, sf_dir):
    """T-SNE of the vectors, perplexity 30 on the first 30 components."""
    v = cut_lineage(f3_pcs(spark, sf_dir))
    return LY.tsne_layout(GR.tsne_affinities(cut_lineage(NB.knn_exact(v, 91)), 30.0), v).positions.withColumns({c: r6(c) for c in "xy"})


@register("umap_layout")
def q_umap_layout(spark, sf_dir):
    """UMAP of the vectors, min_dist 0.1 on the connectivities of 15 neighbours."""
    v = cut_lineage(f3_pcs(spark, sf_dir))
    graph = GR.fuzzy_graph(cut_lineage(NB.knn_exact(v, N_NEIGHBORS)), N_NEIGHBORS)
    return LY.umap_layout(cut_lineage(graph), v).positions.withColumns({c: r6(c) for c in "xy"})


@register("config_key", f"""
WITH {S.F3},
k AS (SELECT DISTINCT cell_id, 'leiden' AS method, 'leiden_res' || CAST(r AS VARCHAR) AS cluster_key, CAST(label % CAST(round(r * 10) AS INTEGER) AS INTEGER) AS cluster
      FROM f3, (VALUES (0.3::DOUBLE), (0.5::DOUBLE), (0.8::DOUBLE)) v(r)
      UNION ALL SELECT cell_id, 'kmeans', 'kmeans_k4', CAST(cell_id % 4 AS INTEGER) FROM f3)
SELECT method, TRY_CAST(split_part(cluster_key, 'res', 2) AS DOUBLE) AS resolution, count(DISTINCT cluster) AS n_clusters
FROM k WHERE TRY_CAST(split_part(cluster_key, 'res', 2) AS DOUBLE) IS NOT NULL GROUP BY method, cluster_key
""")
def q_config_key(spark, sf_dir):
    """P10 + C7 on labellings of the vectors: names from parameters, parsed back; the k-means name has none and is left out."""
    v = f3_vectors(spark, sf_dir)
    keyed = [v.select("cell_id", F.lit("leiden").alias("method"), LB.config_key("leiden", "res", F.lit(r)).alias("cluster_key"),
                      (F.col("label") % F.lit(round(r * 10))).cast("int").alias("cluster")) for r in (0.3, 0.5, 0.8)]
    keyed.append(v.select("cell_id", F.lit("kmeans").alias("method"), LB.config_key("kmeans", "k", F.lit(4)).alias("cluster_key"),
                          (F.col("cell_id") % 4).cast("int").alias("cluster")))
    return GR.cluster_stability(functools.reduce(DataFrame.unionByName, keyed)).select("method", "resolution", "n_clusters")


@register("truth_labels", """
SELECT 'label' AS truth_column, vec_id AS cell_id, CAST(label AS VARCHAR) AS truth FROM embeddings
""")
def q_truth_labels(spark, sf_dir):
    """The true labels of the vectors, found by the name of their column."""
    return LB.truth_labels(f3_vectors(spark, sf_dir))


@register("method_counts", f"""
WITH {S.F3}, c AS (SELECT method, count(DISTINCT cluster_key) AS n_configurations FROM f3_asg GROUP BY method)
SELECT method, n_configurations FROM c UNION ALL SELECT 'total', CAST(sum(n_configurations) AS BIGINT) FROM c
""")
def q_method_counts(spark, sf_dir):
    """A7 on the labellings of the vectors."""
    return LB.method_counts(f3_assignments(spark, sf_dir))
