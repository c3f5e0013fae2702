"""Neighbour graphs and community detection.

fuzzy_graph (D5)   UMAP-style connectivities from the kNN table: rho = nearest non-zero
                   distance, sigma by bisection so that sum exp(-(d - rho)/sigma) = log2 k,
                   symmetrised as a + b - ab.
knn_graph          binary symmetric kNN graph (an edge when either side lists the other).
modularity (G5)    Q = sum_c [in_c / 2m - gamma (tot_c / 2m)^2] for every labelling at once.
louvain (G2)       local moving as DataFrame rounds to a fixed point of the modularity, then contraction,
                   for every resolution in one plan keyed by (resolution, node).
leiden (G1)        the same moves plus the refinement phase: singletons merge only inside their community and only
                   where both are well connected; the refined parts are contracted and start in the unrefined communities.
                   Where a graph has at most ``GROUP_EDGES`` edges, one task per resolution takes it through all levels.

Edges are ``(src, dst, w)`` with both directions present and no self loops.  The
iterative jobs write their small per-node state to the checkpoint folder every round.
"""

from __future__ import annotations

import functools
import math
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscape.session import Scratch, cut_lineage

#: A move counts when it gains more than this.
EPSILON = 1e-12


# --------------------------------------------------------------------------- D5

#: Halvings of a bisection: enough for all digits of a double.
STEPS = 64


def _bisected(too_high: Callable[[Column], Column]) -> Column:
    """The positive number at which ``too_high`` turns from false to true: doubled from 1 until it is, then halved between
    the bounds, ``STEPS`` steps in all."""
    start = F.struct(F.lit(0.0).alias("lo"), F.lit(None).cast("double").alias("hi"), F.lit(1.0).alias("mid"))

    def step(state: Column, _: Column) -> Column:
        lo, hi, mid = state["lo"], state["hi"], state["mid"]
        high = too_high(mid)
        return F.struct(F.when(high, lo).otherwise(mid).alias("lo"), F.when(high, mid).otherwise(hi).alias("hi"),
                        F.when(high, (lo + mid) / 2).when(hi.isNull(), mid * 2).otherwise((mid + hi) / 2).alias("mid"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step, lambda state: state["mid"])


def _total(values: Column, term: Callable[[Column], Column]) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + term(x))


def fuzzy_graph(knn: DataFrame, k: int, min_scale: float = 1e-3) -> DataFrame:
    """Connectivities (src, dst, w) from ``knn(src, dst, rank, dist)`` (self at rank 1).

    rho is the nearest distance above zero; sigma makes the weights exp(-(d - rho) / sigma) of the others sum to log2 of the
    list's length (bisection as a column expression over the list, which holds at most k neighbours), and is at least
    ``min_scale`` x the mean distance.  Symmetrisation is a full outer join.
    """
    mean_all = knn.select(F.avg("dist")).scalar()
    lists = cut_lineage(knn.where(F.col("rank") <= k).groupBy("src").agg(F.array_sort(F.collect_list(F.struct("rank", "dst", "dist"))).alias("nb")))
    lists = lists.withColumn("d", F.transform("nb", lambda x: x["dist"]))
    lists = lists.withColumn("rho", F.coalesce(F.array_min(F.filter("d", lambda x: x > 0)), F.lit(0.0)))
    lists = lists.withColumn("target", F.log2(F.size("d").cast("double"))).withColumn("others", F.slice("d", F.lit(2), F.size("d")))

    def too_high(sigma: Column) -> Column:
        return _total(F.col("others"), lambda x: F.when(x > F.col("rho"), F.exp((F.col("rho") - x) / sigma)).otherwise(1.0)) > F.col("target")

    mean = F.when(F.col("rho") > 0, _total(F.col("d"), lambda x: x) / F.size("d")).otherwise(F.coalesce(mean_all, F.lit(1.0)))
    scaled = lists.withColumn("sigma", F.greatest(_bisected(too_high), F.lit(min_scale) * mean))
    a = scaled.select("src", "rho", "sigma", F.inline("nb")).where(F.col("src") != F.col("dst")).select(
        "src", "dst", F.when((F.col("dist") <= F.col("rho")) | (F.col("sigma") == 0), F.lit(1.0))
        .otherwise(F.exp((F.col("rho") - F.col("dist")) / F.col("sigma"))).alias("a"))
    a = cut_lineage(a)
    b = a.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("a").alias("b"))
    j = a.join(b, ["src", "dst"], "full_outer").fillna({"a": 0.0, "b": 0.0})
    return j.select("src", "dst", (F.col("a") + F.col("b") - F.col("a") * F.col("b")).alias("w")).where("w > 0")


def knn_graph(knn: DataFrame) -> DataFrame:
    """Binary symmetric kNN graph: weight 1 when either cell lists the other."""
    e = knn.where(F.col("src") != F.col("dst")).select("src", "dst")
    both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    return both.withColumn("w", F.lit(1.0))


# --------------------------------------------------------------------------- G5

def modularity(edges: DataFrame, assignments: DataFrame, resolution: float = 1.0) -> DataFrame:
    """Modularity of every labelling (cluster_key) on one weighted graph."""
    m2 = edges.select(F.sum("w")).scalar()
    deg = edges.groupBy(F.col("src").alias("cell_id")).agg(F.sum("w").alias("k"))
    lab = assignments.select("cell_id", "cluster_key", "cluster")
    tot = lab.join(deg, "cell_id").groupBy("cluster_key", "cluster").agg(F.sum("k").alias("tot"))
    ls = lab.select(F.col("cell_id").alias("src"), "cluster_key", F.col("cluster").alias("cs"))
    ld = lab.select(F.col("cell_id").alias("dst"), "cluster_key", F.col("cluster").alias("cd"))
    inside = (edges.join(ls, "src").join(ld, ["dst", "cluster_key"]).where(F.col("cs") == F.col("cd"))
              .groupBy("cluster_key").agg(F.sum("w").alias("inside")))
    penalty = tot.groupBy("cluster_key").agg(F.sum(F.col("tot") * F.col("tot")).alias("sq"))
    return penalty.join(inside, "cluster_key", "left").select(
        "cluster_key",
        (F.coalesce("inside", F.lit(0.0)) / m2 - F.lit(resolution) * F.col("sq") / (m2 * m2)).alias("modularity"))


# --------------------------------------------------------------------------- G2 / G1

#: Edges of a graph, or of a group of its nodes, that one task moves and refines; more edges make more groups.
GROUP_EDGES = 1 << 22
#: A community with more inner edges is refined by DataFrame rounds, not in one task.
LARGE_COMMUNITY = 1 << 20


def _moved(starts: list[int], ends: np.ndarray, w: np.ndarray, k: list[float], label: list[int], total: list[float], res: float, m2: float) -> list[float]:
    """Moves nodes one after the other, each to the community where it gains most, until none that is told of a move gains; returns their gains.

    The edges of node i are at starts[i] to starts[i + 1].  ``label`` and the communities' degrees ``total`` are brought up to
    date.  Ends from len(k) up are outside: they have a label, but do not move.
    """
    n = len(k)
    gained, queue = [0.0] * n, deque(range(n))
    waiting = bytearray([1]) * len(label)
    while queue:
        i = queue.popleft()
        waiting[i] = 0
        at = slice(starts[i], starts[i + 1])
        near, here, ki = ends[at].tolist(), label[i], k[i]
        around: dict[int, float] = {}
        for j, x in zip(near, w[at].tolist()):
            c = label[j]
            around[c] = around.get(c, 0.0) + x
        total[here] -= ki
        share = res * ki / m2
        stay = around.get(here, 0.0) - share * total[here]
        top, best = -math.inf, here
        for c, x in around.items():
            gain = x - share * total[c]
            if gain > top or (gain == top and c < best):
                top, best = gain, c
        if top > stay + EPSILON:
            label[i] = best
            gained[i] += top - stay
            for j in near:
                if not waiting[j] and label[j] != best:
                    waiting[j] = 1
                    queue.append(j)
        total[label[i]] += ki
    return gained


def _parts(starts: list[int], ends: np.ndarray, w: np.ndarray, k: list[float], whole: list[float], reach: list[float], res: float, m2: float) -> list[int]:
    """The part of every node (``_refined``) from the edges inside communities, their degrees ``whole`` and the nodes' weights inside them."""
    n = len(k)
    part, size, degree, away = list(range(n)), [1] * n, list(k), list(reach)
    alone = [i for i in range(n) if reach[i] >= res * k[i] * (whole[i] - k[i]) / m2]
    changed = True
    while changed:
        changed = False
        alone = [i for i in alone if part[i] == i and size[i] == 1]
        for i in alone:
            if size[i] != 1:
                continue
            at = slice(starts[i], starts[i + 1])
            around: dict[int, float] = {}
            for j, x in zip(ends[at].tolist(), w[at].tolist()):
                q = part[j]
                around[q] = around.get(q, 0.0) + x
            all_k, top, best, weight = whole[i], -math.inf, i, 0.0
            for q, x in around.items():
                if q != i and away[q] >= res * degree[q] * (all_k - degree[q]) / m2:
                    gain = x - res * k[i] * degree[q] / m2
                    if gain > top or (gain == top and q < best):
                        top, best, weight = gain, q, x
            if top > EPSILON:
                changed = True
                part[i], size[i] = best, 0
                size[best], degree[best], away[best] = size[best] + 1, degree[best] + k[i], away[best] + reach[i] - 2 * weight
    return part


def _settled(src: np.ndarray, dst: np.ndarray, w: np.ndarray, comm: tuple[np.ndarray, np.ndarray] | None, res: float, m2: float,
             refine: bool) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, their communities) of one resolution's graph after all levels of ``community_sweep``, in this process.

    ``comm``: nodes and the communities in which they start; each on its own without it.  A community has the id of its first node.
    """
    ids, s = np.unique(src, return_inverse=True)
    t = np.searchsorted(ids, dst)
    label = np.arange(len(ids))
    if comm is not None:
        label[np.searchsorted(ids, comm[0])] = np.searchsorted(ids, comm[1])
    level = np.arange(len(ids))  # the node of this level in which a node lies
    while True:
        n = len(label)
        k = np.bincount(s, w, n)
        own = s == t
        loops = w[own].sum()
        order = np.lexsort((w[~own], t[~own], s[~own]))
        a, b, weight = s[~own][order], t[~own][order], w[~own][order]
        starts = np.searchsorted(a, np.arange(n + 1)).tolist()
        quality = -math.inf
        while True:
            total = np.bincount(label, k, n)
            reached = (loops + weight[label[a] == label[b]].sum()) / m2 - res * (k * total[label]).sum() / (m2 * m2)
            if reached <= quality:  # moves that do not help, beyond rounding, are taken back
                label = held
                break
            quality, held, new = reached, label, label.tolist()
            _moved(starts, b, weight, k.tolist(), new, total.tolist(), res, m2)
            label = np.array(new, dtype=np.int64)
            if (label == held).all():
                break
        part = label
        if refine:
            inner = label[a] == label[b]
            a, b, weight = a[inner], b[inner], weight[inner]
            starts = np.searchsorted(a, np.arange(n + 1)).tolist()
            whole = np.bincount(label, k, n)[label]
            part = np.array(_parts(starts, b, weight, k.tolist(), whole.tolist(), np.bincount(a, weight, n).tolist(), res, m2), dtype=np.int64)
        names, at = np.unique(part, return_inverse=True)
        if len(names) == n:
            last = label[level]
            return ids, ids[np.unique(last, return_index=True)[1][np.unique(last, return_inverse=True)[1]]]
        # A community keeps the name of its smallest part, so that it is a node of the next level.
        name = np.full(n, len(names))
        np.minimum.at(name, label, at)
        start = np.empty(len(names), dtype=np.int64)
        start[at] = name[label]
        label, level = start, at[level]
        ends, place = np.unique(at[s] * len(names) + at[t], return_inverse=True)
        w = np.bincount(place, w, len(ends))
        s, t = np.divmod(ends, len(names))


def _communities(graph: DataFrame, start: DataFrame | None, resolutions: list[float], m2: float, refine: bool) -> DataFrame:
    """(res, node, to): ``_settled`` for the graphs (res, src, dst, w) of these resolutions, a task each.  ``start`` is (res, node, comm)."""
    rows = graph.select("res", "src", "dst", "w", F.lit(True).alias("edge"))
    if start is not None:
        rows = rows.unionByName(start.select("res", F.col("node").alias("src"), F.col("comm").alias("dst"), F.lit(0.0).alias("w"), F.lit(False).alias("edge")))
    slot = F.array_position(F.array(*map(F.lit, resolutions)), F.col("res")) - 1

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [[pdf[c].to_numpy() for c in ("src", "dst", "w", "edge", "res")] for pdf in batches if len(pdf)]
        if parts:
            src, dst, w, edge, res = (np.concatenate(x) for x in zip(*parts))
            parts.clear()
            comm = None if edge.all() else (src[~edge], dst[~edge])
            node, to = _settled(src[edge], dst[edge], w[edge], comm, float(res[0]), m2, refine)
            yield pd.DataFrame({"res": res[0], "node": node, "to": to})

    return rows.repartitionById(len(resolutions), slot.cast("int")).mapInPandas(settle, "res double, node long, to long")


@dataclass
class _Group:
    """Nodes of one resolution with all their edges; numbers stand for ids and for communities, in the order of the ids."""

    res: float
    ids: np.ndarray  #: of the nodes, ascending
    k: list[float]
    rows: pd.DataFrame  #: one for every node
    starts: list[int]  #: the edges of node i are at starts[i] to starts[i + 1]
    sources: np.ndarray  #: numbers of the edges' nodes
    ends: np.ndarray  #: numbers of the edges' other ends; below len(ids): nodes of the group
    w: np.ndarray
    others: pd.DataFrame  #: one row for every other end outside, number len(ids) and up

    @classmethod
    def of(cls, pdf: pd.DataFrame) -> _Group:
        """From rows (res, src, dst, w, ...) of edges and one row with src = dst for every node."""
        own = (pdf["src"] == pdf["dst"]).to_numpy()
        rows = pdf[own].sort_values("src", kind="stable").reset_index(drop=True)
        edges = pdf[~own].sort_values(["src", "dst", "w"], kind="stable")
        ids, dst = rows["src"].to_numpy(), edges["dst"].to_numpy()
        others = edges[~np.isin(dst, ids)].drop_duplicates("dst").sort_values("dst", kind="stable")
        names = np.concatenate([ids, others["dst"].to_numpy()])
        order = np.argsort(names, kind="stable")
        ends = order[np.searchsorted(names, dst, sorter=order)]
        starts = np.searchsorted(edges["src"].to_numpy(), ids)
        return cls(float(pdf["res"].iloc[0]), ids, rows["k"].tolist(), rows, [*starts.tolist(), len(edges)],
                   np.repeat(np.arange(len(ids)), np.diff(starts, append=len(edges))), ends, edges["w"].to_numpy(), others)


_MOVED = "res double, node long, k double, comm long, best long, inside double, spread double, gain double, part int"


def _moved_group(pdf: pd.DataFrame, m2: float) -> pd.DataFrame:
    """Moves the nodes of a group (``_moved``).

    The rows have the community ``c`` of dst and its total degree ``tot``.  Nodes outside the group stay where they are.  ``inside``
    and ``spread`` are the node's part of the modularity before the moves, ``gain`` is what its moves gain.
    """
    g = _Group.of(pdf)
    n = len(g.ids)
    every = pd.concat([g.rows[["c", "tot"]], g.others[["c", "tot"]]])
    names, first, label = np.unique(every["c"].to_numpy(), return_index=True, return_inverse=True)
    total, start = every["tot"].to_numpy()[first], label[:n].copy()
    inside = np.bincount(g.sources, np.where(label[g.sources] == label[g.ends], g.w, 0.0), n)
    spread, new = np.array(g.k) * total[start], label.tolist()
    gained = _moved(g.starts, g.ends, g.w, g.k, new, total.tolist(), g.res, m2)
    return pd.DataFrame({"res": g.res, "node": g.ids, "k": g.k, "comm": names[start], "best": names[new[:n]], "inside": inside,
                         "spread": spread, "gain": gained, "part": g.rows["part"]})


def _moves(edges: DataFrame, nodes: DataFrame, m2: float, groups: int, *salt: int) -> DataFrame:
    """The rows of ``_moved_group`` for all nodes (res, node, k, comm), which a hash puts into ``groups`` groups per resolution."""
    totals = nodes.groupBy("res", "comm").agg(F.sum("k").alias("tot"))
    told = nodes.join(totals, ["res", "comm"]).select("res", F.col("node").alias("dst"), F.col("comm").alias("c"), "tot", "k")
    around = edges.join(told.drop("k"), ["res", "dst"]).select("res", "src", "dst", "w", "c", "tot", F.lit(0.0).alias("k"))
    own = told.select("res", F.col("dst").alias("src"), "dst", F.lit(0.0).alias("w"), "c", "tot", "k")
    part = F.pmod(F.xxhash64("src", *map(F.lit, salt)), F.lit(groups)).cast("int")
    return around.unionByName(own).withColumn("part", part).groupBy("res", "part").applyInPandas(lambda pdf: _moved_group(pdf, m2), _MOVED)


def _local_moving(edges: DataFrame, nodes: DataFrame, loops: dict[float, float], m2: float, level: int) -> tuple[DataFrame, dict]:
    """Moves nodes between communities until none gains by it; returns the nodes and the modularity per resolution.

    edges: (res, src, dst, w) without self loops; nodes: (res, node, k, comm).  In a round, groups of nodes, drawn anew by a
    hash, move at once, each of them node by node.  Groups can get in each other's way, so a round counts for a
    resolution only if its modularity rises; otherwise the half of the groups that gain less is left out, down to the one
    group that gains most, whose moves alone always help.  A resolution is done when no group finds a move.
    """
    scratch = Scratch(nodes.sparkSession)
    most = edges.groupBy("res").count().agg(F.max("count")).first()[0] or 0
    groups = math.ceil(most / GROUP_EDGES) or 1

    def tried(name: str, state: DataFrame, salt: int) -> tuple[DataFrame, dict, dict]:
        """The groups' moves, per resolution the modularity before them and the groups that move, most gain first."""
        table = scratch.put(name, _moves(edges, state, m2, groups, salt, level))
        sums = table.groupBy("res", "part").agg(F.sum("inside").alias("inside"), F.sum("spread").alias("spread"), F.sum("gain").alias("gain"),
                                                F.count_if(F.col("best") != F.col("comm")).alias("n")).collect()
        reached, moving = {}, {}
        for r in sorted(sums):
            reached[r.res] = reached.get(r.res, loops.get(r.res, 0.0) / m2) + r.inside / m2 - r.res * r.spread / (m2 * m2)
            moving.setdefault(r.res, []).extend([(r.gain, r.part)] if r.n else [])
        return table, reached, {res: [part for _, part in sorted(found, reverse=True)] for res, found in moving.items()}

    table, quality, active = tried("moves-0", nodes, 0)
    held = dict.fromkeys(quality, "moves-0")  # the table with the state of a resolution
    tables, rounds = {"moves-0": table}, 0
    while open_ := [res for res, parts in active.items() if parts]:
        rounds += 1
        state = None
        for name in sorted({held[res] for res in open_}):
            on = F.lit(False)
            for res in open_:
                if held[res] == name:
                    on = on | ((F.col("res") == res) & F.col("part").isin(active[res]))
            some = tables[name].where(F.col("res").isin([res for res in open_ if held[res] == name])).select(
                "res", "node", "k", F.when(on, F.col("best")).otherwise(F.col("comm")).alias("comm"))
            state = some if state is None else state.unionByName(some)
        name = f"moves-{rounds}"
        tables[name], reached, moving = tried(name, state, rounds)
        for res in open_:
            if reached[res] > quality[res]:
                quality[res], held[res], active[res] = reached[res], name, moving[res]
            else:  # a group whose moves alone do not help, beyond rounding, ends it
                active[res] = active[res][:len(active[res]) // 2]
        gone = [x for x in tables if x not in held.values()]
        scratch.drop(*gone)
        tables = {x: t for x, t in tables.items() if x not in gone}
    parts = [t.where(F.col("res").isin([res for res, at in held.items() if at == name])) for name, t in tables.items()]
    return functools.reduce(DataFrame.unionByName, parts).select("res", "node", "k", "comm"), quality


def _refined_group(pdf: pd.DataFrame, m2: float) -> pd.DataFrame:
    """The parts of whole communities (``_refined``), from rows with k, ``all_k`` and ``reach`` of the nodes; one node moves at a time."""
    g = _Group.of(pdf)
    part = _parts(g.starts, g.ends, g.w, g.k, g.rows["all_k"].tolist(), g.rows["reach"].tolist(), g.res, m2)
    return pd.DataFrame({"res": g.res, "node": g.ids, "k": g.k, "comm": g.rows["comm"], "part": g.ids[part]})


def _refined(edges: DataFrame, nodes: DataFrame, m2: float, level: int) -> DataFrame:
    """``nodes`` with ``part``: Leiden's refinement of every community.

    All nodes start alone.  A node that is alone and well connected to the rest of its community joins the part of its
    community where it gains most, if that part is well connected too: its weight to the rest of the community is at least
    resolution x (its degree) x (degree of the rest) / 2m.  In a round, a hash tells the nodes that may move from those that may
    be joined, so no two exchange places; rounds go on until no node could gain.  These rounds are for communities with more than
    ``LARGE_COMMUNITY`` edges; smaller ones lie in one group of a task, which takes their nodes one after the other.
    """
    scratch = Scratch(nodes.sparkSession)
    label = nodes.select("res", "node", "comm")
    inner = scratch.put("inner", edges.join(label.toDF("res", "src", "comm"), ["res", "src"])
                        .join(label.toDF("res", "dst", "comm"), ["res", "dst", "comm"]).select("res", "comm", "src", "dst", "w"))
    totals = nodes.groupBy("res", "comm").agg(F.sum("k").alias("all_k"))
    reach = inner.groupBy("res", F.col("src").alias("node")).agg(F.sum("w").alias("reach"))
    base = (nodes.join(totals, ["res", "comm"]).join(reach, ["res", "node"], "left")
            .withColumn("reach", F.coalesce("reach", F.lit(0.0))).withColumn("part", F.col("node")))
    base = scratch.put("base", base.select("res", "node", "k", "comm", "all_k", "reach", "part"))
    sizes = scratch.put("sizes", inner.groupBy("res", "comm").count())
    groups = math.ceil((sizes.groupBy("res").agg(F.sum("count").alias("n")).agg(F.max("n")).first()[0] or 0) / GROUP_EDGES) or 1
    large = sizes.where(F.col("count") > LARGE_COMMUNITY).select("res", "comm")
    rows = base.select("res", "comm", F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(0.0).alias("w"), "k", "all_k", "reach")
    rows = rows.unionByName(inner.select("res", "comm", "src", "dst", "w", *(F.lit(0.0).alias(c) for c in ("k", "all_k", "reach"))))
    hashed = F.pmod(F.xxhash64("comm"), F.lit(groups)).alias("_group")
    done = rows.join(large, ["res", "comm"], "left_anti").groupBy("res", hashed).applyInPandas(
        lambda pdf: _refined_group(pdf, m2), "res double, node long, k double, comm long, part long")
    if large.isEmpty():
        return done
    done = scratch.put("done", done)
    inner = scratch.put("large", inner.join(large, ["res", "comm"], "left_semi"))
    state = scratch.put("state-0", base.join(large, ["res", "comm"], "left_semi"))
    rounds = 0
    while True:
        ends = (inner.join(state.select("res", F.col("node").alias("src"), F.col("part").alias("p")), ["res", "src"])
                .join(state.select("res", F.col("node").alias("dst"), F.col("part").alias("q")), ["res", "dst"]))
        ends = scratch.put(f"ends-{rounds}", ends.where("p <> q").groupBy("res", "src", "p", "q").agg(F.sum("w").alias("w")))
        away = ends.groupBy("res", F.col("p").alias("part")).agg(F.sum("w").alias("away"))
        parts = (state.groupBy("res", "part").agg(F.sum("k").alias("part_k"), F.count(F.lit(1)).alias("size"), F.first("all_k").alias("part_all"))
                 .join(away, ["res", "part"], "left"))
        loose = F.col("res") * F.col("part_k") * (F.col("part_all") - F.col("part_k")) / F.lit(m2)
        parts = scratch.put(f"parts-{rounds}", parts.select("res", "part", "part_k", "size", (F.coalesce("away", F.lit(0.0)) >= loose).alias("tied")))
        alone = (state.join(parts.where("size = 1").select("res", "part"), ["res", "part"], "left_semi")
                 .where(F.col("reach") >= F.col("res") * F.col("k") * (F.col("all_k") - F.col("k")) / F.lit(m2)).select("res", F.col("node").alias("src"), "k"))
        gain = F.col("w") - F.col("res") * F.col("k") * F.col("part_k") / F.lit(m2)
        chances = scratch.put(f"chances-{rounds}", ends.join(alone, ["res", "src"])
                              .join(parts.where("tied").select("res", F.col("part").alias("q"), "part_k", "size"), ["res", "q"])
                              .withColumn("gain", gain).where(F.col("gain") > EPSILON).select("res", "src", "q", "size", "gain"))
        if chances.isEmpty():
            return done.unionByName(state.select("res", "node", "k", "comm", "part"))
        mover = lambda c: F.pmod(F.xxhash64(c, F.lit(rounds), F.lit(level), F.lit("part")), F.lit(2)) == 0
        joined = (chances.where(mover("src") & ((F.col("size") > 1) | ~mover("q"))).groupBy("res", F.col("src").alias("node"))
                  .agg(F.max_by("q", F.struct("gain", -F.col("q"))).alias("to")))
        new = scratch.put(f"state-{rounds + 1}", state.join(joined, ["res", "node"], "left").withColumn("part", F.coalesce("to", "part")).drop("to"))
        scratch.drop(f"state-{rounds}", f"ends-{rounds}", f"parts-{rounds}", f"chances-{rounds}")
        state, rounds = new, rounds + 1


def _contracted(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The graph of the parts; the weight inside a part becomes its self loop."""
    part = nodes.select("res", "node", "part")
    return cut_lineage(edges.join(part.toDF("res", "src", "p"), ["res", "src"]).join(part.toDF("res", "dst", "q"), ["res", "dst"])
                       .groupBy("res", F.col("p").alias("src"), F.col("q").alias("dst")).agg(F.sum("w").alias("w")))


def community_sweep(edges: DataFrame, resolutions: list[float], refine: bool = False, cells: DataFrame | None = None,
                    method: str | None = None) -> DataFrame:
    """G1 Leiden (``refine``) or G2 Louvain for every resolution: long assignments (cell_id, method, cluster_key, cluster).

    Nodes move until the modularity is at a fixed point; communities (Louvain) or the parts of their refinement (Leiden)
    become the nodes of the next level, which for Leiden start in the unrefined communities; levels go on until none
    shrinks the graph.  A resolution whose graph has at most ``GROUP_EDGES`` edges, at first or after some levels, is brought to
    its end by one task.  Cells of ``cells`` without edges are communities of their own.  Clusters are numbered by size (G6).
    """
    from cellscape.operators.labels import relabel_by_size

    method = method or ("leiden" if refine else "louvain")
    every = F.explode(F.array(*(F.lit(float(r)) for r in resolutions)))
    ids = edges.select(F.col("src").alias("cell_id")).distinct()
    if cells is not None:
        ids = ids.unionByName(cells.select("cell_id")).distinct()
    member = cut_lineage(ids.withColumn("res", every).select("res", "cell_id", F.col("cell_id").alias("node")))
    edges = cut_lineage(edges.select("src", "dst", "w"))
    graph = edges.withColumn("res", every).select("res", "src", "dst", "w")
    m2 = edges.agg(F.sum("w")).first()[0]
    start, level = None, 0
    while m2:
        sizes = {r.res: r["count"] for r in graph.groupBy("res").count().collect()}
        small = sorted(res for res, n in sizes.items() if n <= GROUP_EDGES)
        if small:
            some = F.col("res").isin(small)
            ends = _communities(graph.where(some), start if start is None else start.where(some), small, m2, refine)
            member = cut_lineage(member.join(ends, ["res", "node"], "left").select("res", "cell_id", F.coalesce("to", "node").alias("node")))
            if len(small) == len(sizes):
                break
            graph, start = graph.where(~some), start if start is None else start.where(~some)
        moving = graph.where("src <> dst")
        degree = graph.groupBy("res", F.col("src").alias("node")).agg(F.sum("w").alias("k"))
        nodes = degree.withColumn("comm", F.col("node")) if start is None else degree.join(start, ["res", "node"])
        loops = {r.res: r.w for r in graph.where("src = dst").groupBy("res").agg(F.sum("w").alias("w")).collect()}
        nodes, _ = _local_moving(moving, nodes, loops, m2, level)
        nodes = cut_lineage(_refined(moving, nodes, m2, level) if refine else nodes.withColumn("part", F.col("comm")))
        counts = nodes.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("res", "part").alias("parts")).first()
        kept = F.col("comm") if counts.parts == counts.n else F.col("part")
        member = cut_lineage(member.join(nodes.select("res", "node", kept.alias("to")), ["res", "node"], "left")
                             .select("res", "cell_id", F.coalesce("to", "node").alias("node")))
        if counts.parts == counts.n:
            break
        # A community keeps the name of its smallest part, so that it is a node of the next level.
        names = nodes.groupBy("res", "comm").agg(F.min("part").alias("name"))
        start = cut_lineage(nodes.join(names, ["res", "comm"]).select("res", F.col("part").alias("node"), F.col("name").alias("comm")).distinct())
        graph, level = _contracted(graph, nodes), level + 1
    labels = member.select(
        "cell_id", F.lit(method).alias("method"),
        F.concat(F.lit(f"{method}_res"), F.col("res").cast("string")).alias("cluster_key"),
        F.col("node").alias("cluster"))
    mapping = relabel_by_size(labels)
    return labels.join(mapping.select("cluster_key", "cluster", "new_cluster"), ["cluster_key", "cluster"]).select(
        "cell_id", "method", "cluster_key", F.col("new_cluster").alias("cluster"))


def cluster_stability(assignments: DataFrame) -> DataFrame:
    """Cluster count against resolution for graph methods; the resolution is parsed
    back from the key (text after 'res'); keys that do not parse are skipped."""
    from cellscape.operators.labels import cluster_counts, parsed_parameter

    c = cluster_counts(assignments).join(assignments.select("cluster_key", "method").distinct(), "cluster_key")
    return c.withColumn("resolution", parsed_parameter(F.col("cluster_key"))).where(F.col("resolution").isNotNull()).select(
        "method", "resolution", "n_clusters")


# --------------------------------------------------------------------------- D7

def tsne_affinities(knn: DataFrame, perplexity: float = 30.0) -> DataFrame:
    """Symmetric t-SNE input probabilities from a kNN table built with about
    3 x perplexity neighbours (self excluded): p = (p_{j|i} + p_{i|j}) / sum over all.

    p_{j|i} falls as exp(-beta d^2) with the beta at which the entropy is log(perplexity) (bisection as a column expression over
    the list, which is bounded by the neighbour count); the normaliser is one global sum.
    """
    lists = cut_lineage(knn.where(F.col("src") != F.col("dst")).groupBy("src").agg(
        F.array_sort(F.collect_list(F.struct("rank", "dst", "dist"))).alias("nb")))
    lists = lists.withColumn("d2", F.transform("nb", lambda x: x["dist"] * x["dist"]))
    # Distances are taken from the nearest one, which changes no probability and keeps exp from vanishing.
    lists = lists.withColumn("near", F.array_min("d2")).withColumn("d2", F.transform("d2", lambda x: x - F.col("near")))

    def too_high(beta: Column) -> Column:
        sums = F.aggregate("d2", F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("t")), lambda acc, x: F.struct(
            (acc["s"] + F.exp(-beta * x)).alias("s"), (acc["t"] + x * F.exp(-beta * x)).alias("t")),
            lambda acc: F.log(acc["s"]) + beta * acc["t"] / acc["s"])
        return sums < F.lit(math.log(perplexity))

    c = (lists.withColumn("beta", _bisected(too_high)).withColumn("s", _total(F.col("d2"), lambda x: F.exp(-F.col("beta") * x)))
         .select("src", "near", "beta", "s", F.inline("nb")).select(
             "src", "dst", (F.exp(F.col("beta") * (F.col("near") - F.col("dist") * F.col("dist"))) / F.col("s")).alias("p")))
    c = cut_lineage(c)
    r = c.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("p").alias("q"))
    j = cut_lineage(c.join(r, ["src", "dst"], "full_outer").fillna({"p": 0.0, "q": 0.0}).select(
        "src", "dst", (F.col("p") + F.col("q")).alias("p")))
    return j.select("src", "dst", (F.col("p") / j.select(F.sum("p")).scalar()).alias("p"))
