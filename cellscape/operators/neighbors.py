"""Pairwise distances in bounded blocks: exact kNN and exact silhouette sums.

J4 (pairwise_blocks): cells are hashed into B blocks; every unordered pair of blocks
is a tile, one grouped pandas task that holds at most two blocks of vectors and
computes their distances once, a square at a time, for both directions.  Searches
(search_blocks) hold one block of rows and a wider one of others.  Only per-cell aggregates
(top-k lists, per-cluster distance sums) leave a task; the pairs themselves are
never emitted.  Work is quadratic by nature; ``knn_approx``
is the sub-quadratic alternative.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscape.session import Scratch

DEFAULT_BLOCK = 2048
#: Blocks grow with the table, so that cells are copied about BLOCKS times, up to this size.
BLOCKS, MOST_BLOCK = 16, 32768
#: Row blocks that a search sets against one block of others, which is that much wider.
WIDER = 4
#: Distances held at once, and vectors subtracted at once.
STRIP_CELLS, EXACT_ROWS = 1 << 19, 1 << 15
#: A squared distance below this share of the squared norms is taken from differences, as the product of the vectors cancels there.
CANCELS = 1e-3
#: Labels of a cell that has none in a configuration, and of one whose label there is missing.
ABSENT, UNKNOWN = -(1 << 62), 1 - (1 << 62)
#: Distances to at most this many clusters are summed up by a matrix product, to more of them in the order of the clusters.
FEW = 32
#: Columns of a strip are taken in about this many groups, whose least distances bound the nearest ones.
GROUPS = 512


def n_blocks(n_cells: int, block_size: int | None = None) -> int:
    size = block_size or min(MOST_BLOCK, max(DEFAULT_BLOCK, math.ceil(n_cells / BLOCKS)))
    return max(1, math.ceil(n_cells / size))


class Pairs:
    """Distances between the rows of two matrices, never all at once."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.left, self.right = left, right

    def exact(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Distances of the pairs (i, j) by differences."""
        out = np.empty(len(i))
        for s in range(0, len(i), EXACT_ROWS):
            d = self.left[i[s:s + EXACT_ROWS]] - self.right[j[s:s + EXACT_ROWS]]
            out[s:s + EXACT_ROWS] = np.sqrt(np.einsum("ij,ij->i", d, d))
        return out

    def _step(self) -> int:
        return max(1, STRIP_CELLS // max(1, len(self.right)))

    def _products(self, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Two matrices whose product is the squared distances, and the squared norms, of the vectors less the right ones' mean."""
        centre = self.right.mean(axis=0)
        left, right = self.left - centre, self.right - centre
        a, b = np.einsum("ij,ij->i", left, left), np.einsum("ij,ij->i", right, right)
        one = lambda x: np.ones((len(x), 1))
        return (np.hstack([left, a[:, None], one(left)]).astype(kind),
                np.hstack([-2 * right, one(right), b[:, None]]).astype(kind).T, a, b)

    def squares(self, rows: int | None = None, columns: int | None = None) -> Iterator[tuple[slice, slice, np.ndarray]]:
        """(rows, columns, distances of these rows to these of ``right``), by the product of the vectors and, where that cancels
        or is not finite, by differences."""
        side = max(1, math.isqrt(STRIP_CELLS))
        rows, columns = rows or side, columns or side
        with np.errstate(over="ignore", invalid="ignore"):
            left, right, a, b = self._products(float)
            finite = a.max(initial=0.0) + b.max(initial=0.0) < 1e300
            for s in range(0, len(self.left), rows):
                at = slice(s, min(s + rows, len(self.left)))
                for t in range(0, len(self.right), columns):
                    to = slice(t, min(t + columns, len(self.right)))
                    d = left[at] @ right[:, to]
                    # Most rows have no pair that cancels, which their least value tells.
                    odd = np.flatnonzero(~(d.min(axis=1) >= CANCELS * (a[at] + b[to].max()))) if finite else np.arange(len(d))
                    few = d[odd]
                    i, j = np.nonzero(~((few >= CANCELS * (a[at][odd, None] + b[to])) & (few < np.inf)))
                    i = odd[i]
                    d[i, j] = 0.0
                    np.sqrt(d, out=d)
                    d[i, j] = self.exact(i + s, j + t)
                    yield at, to, d

    def strips(self) -> Iterator[tuple[slice, np.ndarray]]:
        """(rows, distances of these rows to all of ``right``)."""
        for at, _, d in self.squares(self._step(), max(1, len(self.right))):
            yield at, d

    def _rounded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """The two matrices in single precision and a bound on the error of a squared distance, by row; None where that is not finite."""
        with np.errstate(over="ignore", invalid="ignore"):
            left, right, a, b = self._products(np.float32)
            error = (left.shape[1] + 8) * 2.0 ** -23 * (a + b.max())
            if np.isfinite(left).all() and np.isfinite(right).all() and error.max() < 1e30:
                return left, right, error
        return None

    def _near(self, m: int, slack: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i, j) strip by strip that hold for every row all pairs up to its m-th smallest distance plus ``slack``.

        Single precision with a bound on its error; double precision where that is not finite.  The m-th least of the groups'
        least values is at least the m-th least of all, and only pairs up to it are looked at.
        """
        rounded = self._rounded()
        if rounded is None:
            for at, d in self.strips():
                far = np.partition(d, m - 1, axis=1)[:, m - 1:m]
                i, j = np.nonzero(~(d > np.where(np.isfinite(far), far * (1 + 1e-9) + slack, np.inf)))
                yield i + at.start, j
            return
        left, right, error = rounded
        n, groups = len(self.right), max(GROUPS, 4 * m)
        wide = min(n, 16 * groups)
        step = max(1, STRIP_CELLS // wide)
        for s in range(0, len(left), step):
            rows, e = left[s:s + step], error[s:s + step]
            best, kept = np.empty((len(rows), 0), dtype=np.float32), []
            for t in range(0, n, wide):
                d = rows @ right[:, t:t + wide]
                low = d[:, :d.shape[1] // groups * groups].reshape(len(d), -1, groups).min(axis=1) if d.shape[1] >= 2 * groups else d
                best = np.concatenate([best, low], axis=1)
                if best.shape[1] > m:
                    best = np.partition(best, m - 1, axis=1)[:, :m]
                far = best.max(axis=1).astype(float) if best.shape[1] == m else np.full(len(d), np.inf)
                far = (np.sqrt(np.maximum(far + e, 0.0)) + slack) ** 2 + e
                far = np.nextafter(far.astype(np.float32), np.float32(np.inf))
                found = np.flatnonzero(d <= far[:, None])
                i, j = np.divmod(found, d.shape[1])
                kept.append((i, j + t, d.ravel()[found]))
            i, j, d = (np.concatenate(x) for x in zip(*kept))
            near = d <= far[i]
            yield i[near] + s, j[near]

    def cheapest(self, n: np.ndarray, m: np.ndarray, skip: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(i, j, cost) with the least cost n_i m_j / (n_i + m_j) x the squared distance for every row, ties to the smaller j; the
        pairs ``skip``, in order of i, don't count.

        Costs near the least are compared by exact differences, which both sides of a pair see alike.
        """
        found = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0))]
        for s, cost, limit in self._costs(n, m, skip):
            i, j = np.divmod(np.flatnonzero((cost <= limit[:, None]) & (cost < np.inf)), len(self.right))
            i = i + s
            d = self.exact(i, j)
            c = n[i] * m[j] / (n[i] + m[j]) * d * d
            order = np.lexsort((j, c, i))
            order = order[np.unique(i[order], return_index=True)[1]]
            found.append((i[order], j[order], c[order]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _costs(self, n: np.ndarray, m: np.ndarray, skip: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, costs of a strip, by row the limit up to which a cost may be the least)."""
        def skipped(cost: np.ndarray, s: int) -> np.ndarray:
            low, high = np.searchsorted(skip[0], (s, s + len(cost)))
            cost[skip[0][low:high] - s, skip[1][low:high]] = np.inf
            return cost

        rounded = self._rounded()
        most = m.max() * n / (n + m.max())
        if rounded is None or not most.max() * (rounded[2].max() + 1) < 1e30:
            for at, d in self.strips():
                cost = skipped(n[at, None] * m / (n[at, None] + m) * d * d, at.start)
                yield at.start, cost, cost.min(axis=1) * (1 + 1e-9)
            return
        left, right, error = rounded
        left[:, -2] += error.astype(np.float32)  # squared distances plus their error, so that none is below the true one
        one, other = (1 / n).astype(np.float32), (1 / m).astype(np.float32)
        for s in range(0, len(left), self._step()):
            cost = left[s:s + self._step()] @ right
            at = slice(s, s + len(cost))
            cost /= one[at, None] + other
            cost = skipped(cost, s)
            least = cost.min(axis=1).astype(float)
            limit = least * (1 + 1e-5) + 3 * error[at] * most[at]
            yield s, cost, np.nextafter(limit.astype(np.float32), np.float32(np.inf))

    def nearest(self, m: int, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(i, j, distance) of the ``m`` nearest on the right for every row on the left, nearest first.

        Distances are exact and ranked in units of 1 / ``scale``, so near-ties do not depend on summation order; ties go to
        the smaller j.
        """
        m = min(m, len(self.right))
        found = []
        for i, j in self._near(m, 2 / scale):
            dist = np.rint(self.exact(i, j) * scale) / scale
            order = np.lexsort((j, dist, i))
            i, j, dist = i[order], j[order], dist[order]
            first = np.searchsorted(i, i)  # where the row of each pair begins
            near = np.arange(len(i)) - first < m
            found.append((i[near], j[near], dist[near]))
        return tuple(np.concatenate(x) for x in zip(*found))


def same_cells(ids: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places (i, j) of equal ids; ``others`` are in order.  A missing id equals none."""
    low, high = np.searchsorted(others, ids, "left"), np.searchsorted(others, ids, "right")
    n = np.where(ids == ids, high - low, 0)
    i = np.repeat(np.arange(len(ids)), n)
    return i, low[i] + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)


Kernel = Callable[[pd.DataFrame, pd.DataFrame, Pairs], pd.DataFrame]


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.stack(pdf["v"].to_numpy()).astype(float)


def pairwise_blocks(vec: DataFrame, kernel: Kernel, schema: str, cols: Sequence[str] = (), n_cells: int | None = None,
                    block_size: int | None = None) -> DataFrame:
    """``kernel(rows, others, pairs)`` for all cells against all cells, block by block, every distance once.

    Cells are hashed into B blocks; every unordered pair of blocks is one tile and one group, so each cell is copied B times.
    Without a ``block_size``, B is about ``BLOCKS`` until a block has ``MOST_BLOCK`` cells.  ``rows`` and ``others`` are frames of
    (cell_id, v, *cols) ordered by cell_id, ``pairs`` has their distances.  The kernel returns what ``schema`` says for both
    sides, or for the rows if ``others`` are the same frame; pairs themselves need not leave the task.
    """
    if n_cells is None:
        n_cells = vec.count()
    nb = n_blocks(n_cells, block_size)
    block = F.pmod(F.xxhash64("cell_id"), F.lit(nb)).cast("int")
    low, high = F.least("_block", "_other"), F.greatest("_block", "_other")
    tiles = (vec.select("cell_id", "v", *cols, block.alias("_block"), F.explode(F.sequence(F.lit(0), F.lit(nb - 1))).alias("_other"))
             .withColumn("_tile", (high * (high + 1) / 2 + low).cast("int")).drop("_other"))

    def tile(key, pdf: pd.DataFrame) -> pd.DataFrame:
        high = (math.isqrt(8 * key[0] + 1) - 1) // 2
        low = key[0] - high * (high + 1) // 2
        pdf = pdf.sort_values("cell_id", kind="stable")
        a = pdf[pdf["_block"] == low].reset_index(drop=True)
        b = a if low == high else pdf[pdf["_block"] == high].reset_index(drop=True)
        if a.empty or b.empty:
            return empty
        left = _matrix(a)
        return kernel(a, b, Pairs(left, left if low == high else _matrix(b)))

    empty = pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})
    return tiles.groupBy("_tile").applyInPandas(tile, schema)


def search_blocks(vec: DataFrame, kernel: Kernel, schema: str, cols: Sequence[str] = (), n_cells: int | None = None,
                  block_size: int | None = None, searching: Column | None = None) -> DataFrame:
    """J4 in one direction: ``kernel(rows, others, pairs)`` for the cells that are ``searching`` (all by default) against all cells.

    A tile has one block of rows, as in ``pairwise_blocks``, and one of others that is ``WIDER`` times as wide, so that few tiles
    return candidates for the same cell.  ``others`` are ordered by cell_id.
    """
    if n_cells is None:
        n_cells = vec.count()
    narrow = n_blocks(n_cells, block_size)
    wide = math.ceil(narrow / WIDER)
    part = lambda n: F.pmod(F.xxhash64("cell_id"), F.lit(n)).cast("int")
    every = lambda n, f: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), f)
    tile_of = lambda own, row, other: F.struct(F.lit(own).alias("_row"), (row * wide + other).alias("_tile"))
    as_row = every(wide, lambda other: tile_of(True, part(narrow), other))
    as_other = every(narrow, lambda row: tile_of(False, row, part(wide)))
    if searching is not None:
        as_row = F.when(searching, as_row).otherwise(F.slice(as_row, 1, 0))
    tiles = vec.select("cell_id", "v", *cols, F.explode(F.concat(as_row, as_other)).alias("_in")).select("cell_id", "v", *cols, "_in.*")

    def tile(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cell_id", kind="stable")
        a, b = (pdf[pdf["_row"] == own].reset_index(drop=True) for own in (True, False))
        if a.empty or b.empty:
            return empty
        return kernel(a, b, Pairs(_matrix(a), _matrix(b)))

    empty = pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})
    return tiles.groupBy("_tile").applyInPandas(tile, schema)


def distance_summary(vec: DataFrame, n_cells: int | None = None, block_size: int | None = None) -> DataFrame:
    """Per cell over all other cells: (cell_id, n_others, mean_distance, max_distance)."""

    def kernel(rows: pd.DataFrame, others: pd.DataFrame, pairs: Pairs) -> pd.DataFrame:
        i, j = same_cells(rows["cell_id"].to_numpy(), others["cell_id"].to_numpy())
        sides = [(f["cell_id"].to_numpy(), len(o) - np.bincount(x, minlength=len(f)), np.zeros(len(f)), np.full(len(f), -np.inf))
                 for f, o, x in ((rows, others, i), (others, rows, j))]
        for at, to, D in pairs.squares():
            _blank(D, i, j, at, to)
            for (_, _, total, far), here, axis in zip(sides[:1 if rows is others else 2], (at, to), (1, 0)):
                total[here] += D.sum(axis=axis)
                far[here] = np.maximum(far[here], D.max(axis=axis))
        return pd.concat([pd.DataFrame(dict(zip(("cell_id", "n", "total", "far"), side)))
                          for side in sides[:1 if rows is others else 2]], ignore_index=True)

    parts = pairwise_blocks(vec, kernel, "cell_id long, n long, total double, far double", (), n_cells, block_size)
    return parts.groupBy("cell_id").agg(F.sum("n").alias("n_others"), (F.sum("total") / F.sum("n")).alias("mean_distance"),
                                        F.max("far").alias("max_distance"))


def _blank(D: np.ndarray, i: np.ndarray, j: np.ndarray, at: slice, to: slice) -> None:
    """Puts 0 where a square has a cell against itself; the pairs (i, j) are in order of i."""
    low, high = np.searchsorted(i, (at.start, at.stop))
    mine = slice(low, high)
    inside = (j[mine] >= to.start) & (j[mine] < to.stop)
    D[i[mine][inside] - at.start, j[mine][inside] - to.start] = 0.0


def knn_exact(vec: DataFrame, k: int = 15, n_cells: int | None = None, block_size: int | None = None,
              include_self: bool = True, tie_digits: int = 9) -> DataFrame:
    """D3: k nearest cells by Euclidean distance; ``k`` counts the cell itself.

    Returns ``knn(src, dst, rank, dist)``; ties broken by the smaller ``dst`` id.
    Each tile yields at most k candidates per cell; a bounded ``row_number`` per cell
    (k x B / WIDER rows) merges them.
    """
    most = k if include_self else k + 1
    scale = float(10 ** tie_digits)

    def kernel(rows: pd.DataFrame, others: pd.DataFrame, pairs: Pairs) -> pd.DataFrame:
        return _nearest_pairs(rows, others, pairs, most, scale)

    cand = search_blocks(vec, kernel, "src long, dst long, dist double", (), n_cells, block_size)
    return _nearest_of(cand if include_self else cand.where("src <> dst"), k)


def _nearest_pairs(rows: pd.DataFrame, others: pd.DataFrame, pairs: Pairs, k: int, scale: float) -> pd.DataFrame:
    """The k nearest of ``others``, which are in id order, for every row; ties to the smaller id."""
    i, j, dist = pairs.nearest(k, scale)
    return pd.DataFrame({"src": rows["cell_id"].to_numpy()[i], "dst": others["cell_id"].to_numpy()[j], "dist": dist})


def _nearest_of(candidates: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("src").orderBy("dist", "dst")
    return candidates.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "src", "dst", F.col("rank").cast("int").alias("rank"), "dist")


class ClusterSums:
    """Sums of the distances from a block of rows, ordered by cell_id, to the members of every cluster of every configuration.

    ``labs`` of a cell has its cluster for each configuration, ``UNKNOWN`` for a missing label and ``ABSENT`` without one.  Others
    are added batch by batch; only the sums are kept.
    """

    def __init__(self, rows: pd.DataFrame, n_keys: int):
        self.ids, self.labs, self.v = rows["cell_id"].to_numpy(), np.stack(rows["labs"].to_numpy()), _matrix(rows)
        self.names = [np.empty(0, dtype=np.int64) for _ in range(n_keys)]
        self.sizes = [np.empty(0, dtype=np.int64) for _ in range(n_keys)]
        self.sums = [np.empty((0, len(rows))) for _ in range(n_keys)]
        self.same = np.zeros(len(rows), dtype=np.int64)  # others that are the row's own cell

    def _numbers(self, key: int, labels: np.ndarray) -> np.ndarray:
        """The place of every label's cluster in ``names``, which learns new ones; -1 for none."""
        found, at = np.unique(labels, return_inverse=True)
        known = found > UNKNOWN
        new = np.setdiff1d(found[known], self.names[key])
        if len(new):
            self.names[key] = np.concatenate([self.names[key], new])
            self.sizes[key] = np.concatenate([self.sizes[key], np.zeros(len(new), dtype=np.int64)])
            self.sums[key] = np.concatenate([self.sums[key], np.zeros((len(new), len(self.ids)))])
        order = np.argsort(self.names[key])
        numbers = np.full(len(found), -1)
        numbers[known] = order[np.searchsorted(self.names[key], found[known], sorter=order)]
        return numbers[at]

    def add(self, others: pd.DataFrame) -> None:
        others = others.sort_values("cell_id", kind="stable")
        labs = np.stack(others["labs"].to_numpy())
        numbers = [self._numbers(key, labs[:, key]) for key in range(len(self.names))]
        for key, number in enumerate(numbers):
            self.sizes[key] += np.bincount(number[number >= 0], minlength=len(self.sizes[key]))
        i, j = same_cells(others["cell_id"].to_numpy(), self.ids)
        self.same += np.bincount(j, minlength=len(self.same))
        for at, to, D in Pairs(_matrix(others), self.v).squares():
            _blank(D, i, j, at, to)  # the cell itself does not count
            finite, few = np.isfinite(D.sum()), []
            for key, number in enumerate(numbers):
                order = np.argsort(number[at], kind="stable")
                order = order[number[at][order] >= 0]
                clusters, first = np.unique(number[at][order], return_index=True)
                if len(clusters) > FEW or (len(clusters) and not finite):
                    self.sums[key][clusters, to] += np.add.reduceat(D[order], first, axis=0)
                elif len(clusters):  # one matrix product for all configurations
                    few.append((key, clusters, (number[at] == clusters[:, None]).astype(float)))
            if few:
                found, place = np.concatenate([member for _, _, member in few]) @ D, 0
                for key, clusters, _ in few:
                    self.sums[key][clusters, to] += found[place:place + len(clusters)]
                    place += len(clusters)

    def of_cells(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(configuration, cell ids, labels, place of the own cluster or -1, sums and counts by cluster and cell), rows of one id as one cell."""
        ids, first, copies = np.unique(self.ids, return_index=True, return_counts=True)
        for key, sums in enumerate(self.sums):
            labels = self.labs[first, key]
            if len(ids) < len(self.ids):
                sums = np.add.reduceat(sums, first, axis=1) if len(sums) else sums[:, first]
            own = self._numbers(key, labels)
            counts = self.sizes[key][:, None] * copies
            mine = np.flatnonzero(own >= 0)
            counts[own[mine], mine] -= np.add.reduceat(self.same, first)[mine]
            yield key, ids, labels, own, sums, counts


def _against_all(vec: DataFrame, labels: DataFrame, told: Callable[[list[str], ClusterSums], Iterator[pd.DataFrame]], schema: str,
                 n_cells: int | None, block_size: int | None) -> DataFrame:
    """J4 for sums by cluster: a task per block of rows, past which all cells stream, so that only finished sums leave it.

    A task holds its rows, their sums and one batch of others.  Every cell is copied once per block.
    """
    if n_cells is None:
        n_cells = vec.count()
    nb = n_blocks(n_cells, block_size)
    keys = sorted(r[0] for r in labels.select("cluster_key").where("cluster_key is not null").distinct().collect())  # one per configuration
    lab = labels.groupBy("cell_id").agg(F.map_from_entries(F.collect_list(F.struct("cluster_key", "cluster"))).alias("m"))
    label = lambda key: F.when(F.map_contains_key("m", key), F.coalesce(F.col("m")[key].cast("long"), F.lit(UNKNOWN))).otherwise(F.lit(ABSENT))
    cells = vec.select("cell_id", "v").join(lab, "cell_id").select("cell_id", "v", F.array(*map(label, keys)).cast("array<long>").alias("labs"))
    block = F.pmod(F.xxhash64("cell_id"), F.lit(nb)).cast("int")
    copies = cells.withColumn("_row", F.explode(F.sequence(F.lit(0), F.lit(nb - 1)))).withColumn("_own", F.col("_row") == block)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, sums = [], None
        for pdf in batches:
            if not len(pdf):
                continue
            if sums is None:  # a block's own cells come first
                rows.append(pdf)
                if pdf["_own"].all():
                    continue
                sums = begun(rows)
            else:
                sums.add(pdf)
        sums = sums or (begun(rows) if rows else None)
        if sums is not None:
            yield from told(keys, sums)

    def begun(held: list[pd.DataFrame]) -> ClusterSums | None:
        every = pd.concat(held, ignore_index=True)
        held.clear()
        own = every[every["_own"]].sort_values("cell_id", kind="stable").reset_index(drop=True)
        sums = ClusterSums(own, len(keys)) if len(own) else _NoRows()
        sums.add(every)
        return sums

    return copies.repartitionById(nb, F.col("_row")).sortWithinPartitions(F.desc("_own"), "cell_id").mapInPandas(task, schema)


class _NoRows:
    """A block without cells."""

    def add(self, others: pd.DataFrame) -> None:
        pass

    def of_cells(self) -> Iterator:
        return iter(())


def cluster_distance_sums(vec: DataFrame, labels: DataFrame, n_cells: int | None = None,
                          block_size: int | None = None) -> DataFrame:
    """For every cell, configuration and cluster: sum of distances from the cell to the
    cluster's members (self excluded) and the member count.

    ``labels`` is long: (cell_id, cluster_key, cluster).  All configurations share
    one distance computation: each cell carries its label for every configuration.
    Returns (cell_id, cluster_key, cluster, dsum, cnt).
    """
    def told(keys: list[str], found: ClusterSums) -> Iterator[pd.DataFrame]:
        for key, ids, _, _, sums, counts in found.of_cells():
            for cluster, dsum, cnt in zip(found.names[key].tolist(), sums, counts):
                yield pd.DataFrame({"cell_id": ids, "cluster_key": keys[key], "cluster": cluster, "dsum": dsum, "cnt": cnt})

    return _against_all(vec, labels, told, "cell_id long, cluster_key string, cluster int, dsum double, cnt long", n_cells, block_size)


def cluster_distance_means(vec: DataFrame, labels: DataFrame, n_cells: int | None = None, block_size: int | None = None) -> DataFrame:
    """For every cell and configuration in which it is: the number of other cells in its cluster, the mean distance to them and the
    least mean distance to another cluster, as (cell_id, cluster_key, n_own, a, b), from the sums of ``cluster_distance_sums``."""
    def told(keys: list[str], found: ClusterSums) -> Iterator[pd.DataFrame]:
        for key, ids, labels, own, sums, counts in found.of_cells():
            cells = np.arange(len(ids))
            if not len(sums):
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                means = np.where(counts > 0, sums / counts, np.nan)
            a = np.where(own >= 0, means[own, cells], np.nan)
            n_own = np.where(own >= 0, counts[own, cells], 0)
            means[own[own >= 0], cells[own >= 0]] = np.nan
            there = labels > ABSENT
            yield pd.DataFrame({"cell_id": ids, "cluster_key": keys[key], "n_own": n_own, "a": a, "b": np.fmin.reduce(means, axis=0)})[there]

    return _against_all(vec, labels, told, "cell_id long, cluster_key string, n_own long, a double, b double", n_cells, block_size)


def _block_nearest(lp: pd.DataFrame, rp: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows of ``rp`` for every row of ``lp``, ties to the smaller id."""
    if lp.empty or rp.empty:
        return pd.DataFrame({"src": [], "dst": [], "dist": []})
    rp = rp.sort_values("cell_id", kind="stable")
    return _nearest_pairs(lp, rp, Pairs(_matrix(lp), _matrix(rp)), k, 1e9)


_CANDIDATES = "src long, dst long, dist double"


def knn_of_sample(vec: DataFrame, k: int, size: int) -> DataFrame:
    """Exact neighbours of at most ``size`` cells, chosen by a hash of their id, against all cells.

    The sample travels to the tasks, each of which returns the k nearest cells of its batches.
    """
    chosen = vec.orderBy(F.xxhash64("cell_id"), "cell_id").limit(size).select("cell_id", "v").toPandas()  # at most ``size`` rows

    def search(batches):
        for pdf in batches:
            yield _block_nearest(chosen, pdf, k)

    return _nearest_of(vec.select("cell_id", "v").mapInPandas(search, _CANDIDATES), k)


def _groups_of_lists(centres: np.ndarray, n_groups: int) -> np.ndarray:
    """A group for every list: lists that follow each other along the centres' widest direction, equally many a group."""
    centred = centres - centres.mean(axis=0)
    along = centred @ np.linalg.eigh(centred.T @ centred)[1][:, -1]
    groups = np.empty(len(centres), dtype=np.int32)
    groups[np.argsort(along, kind="stable")] = np.arange(len(centres)) * min(n_groups, len(centres)) // len(centres)
    return groups


def _lists_nearest(lp: pd.DataFrame, rp: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows of ``rp`` for every row of ``lp``, among those in one of its lists; ties to the smaller id."""
    if lp.empty or rp.empty:
        return pd.DataFrame({"src": [], "dst": [], "dist": []})
    rp = rp.sort_values("cell_id", kind="stable")
    left, right, ids, far_ids = _matrix(lp), _matrix(rp), lp["cell_id"].to_numpy(), rp["cell_id"].to_numpy()
    rows, wanted = np.repeat(np.arange(len(lp)), lp["lists"].map(len)), np.concatenate(lp["lists"].to_numpy())
    home = np.concatenate(rp["lists"].to_numpy())
    found = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0))]
    for number in np.intersect1d(wanted, home):
        here, there = rows[wanted == number], np.flatnonzero(home == number)
        i, j, dist = Pairs(left[here], right[there]).nearest(k, 1e9)
        found.append((here[i], there[j], dist))
    i, j, dist = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((j, dist, i))
    i, j, dist = i[order], j[order], dist[order]
    near = np.arange(len(i)) - np.searchsorted(i, i) < k
    return pd.DataFrame({"src": ids[i[near]], "dst": far_ids[j[near]], "dist": dist[near]})


def knn_approx(vec: DataFrame, k: int = 15, recall: float = 0.95, sample: int = 500, n_lists: int | None = None,
               n_probe: int = 8, chunk_rows: int | None = None, seed: int = 42) -> DataFrame:
    """Approximate kNN by an inverted file, with as many probes as a wanted ``recall`` needs.

    Lists come from MLlib k-means (``n_lists`` ~ sqrt(N)); every cell searches the residents of its nearest lists.  The
    probes start at ``n_probe`` and are doubled, searching the new lists only, until the recall on ``sample`` exactly
    searched cells reaches the target; with all lists probed the search is exact.  A cell visits a group of lists once, with the
    numbers of those that it probes, so its copies are bounded by the groups and not by the probes.  Residents and visitors
    of a group are cut into hash chunks of about ``chunk_rows`` (by default a block of the exact search), so a crowded
    group is spread over many tasks.
    Returns knn(src, dst, rank, dist).
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    scratch = Scratch(vec.sparkSession)
    vec = scratch.put("vectors", vec.select("cell_id", F.col("v").cast("array<double>").alias("v")))
    n = vec.count()
    n_lists = min(n_lists or max(1, int(math.sqrt(n))), max(n, 1))
    if n_lists > 1:
        model = KMeans(k=n_lists, seed=seed, maxIter=20).fit(vec.select(array_to_vector("v").alias("features")))
        centres = np.array(model.clusterCenters())
    else:
        centres = np.zeros((1, len(vec.first().v) if n else 1))
    n_groups = n_blocks(n)
    chunk_rows = chunk_rows or max(1, math.ceil(n / n_groups))
    groups = _groups_of_lists(centres, n_groups)

    def visits(low: int, high: int) -> DataFrame:
        """(cell_id, v, group, lists) for the lists that are the low-th to high-th nearest of a cell, a row for each of their groups."""
        def near(batches):
            for pdf in batches:
                if len(pdf):
                    d = np.concatenate([d for _, d in Pairs(_matrix(pdf), centres).strips()])
                    lists = np.argsort(d, axis=1, kind="stable")[:, low:high].astype(np.int32)
                    lists = np.take_along_axis(lists, np.argsort(groups[lists], axis=1, kind="stable"), axis=1)
                    row, group = np.repeat(np.arange(len(pdf)), lists.shape[1]), groups[lists].ravel()
                    first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(group, prepend=-1) != 0))
                    yield pd.DataFrame({"cell_id": pdf["cell_id"].to_numpy()[row[first]], "v": pdf["v"].to_numpy()[row[first]],
                                        "group": group[first], "lists": np.array([*np.split(lists.ravel(), first[1:]), None], dtype=object)[:-1]})
        return vec.mapInPandas(near, "cell_id long, v array<double>, group int, lists array<int>")

    home = scratch.put("home", visits(0, 1))

    def chunked(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        sizes = rows.groupBy("group").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(chunk_rows))).alias(f"{name}s"))
        sizes = scratch.put(f"sizes-{name}", sizes)
        return rows.join(F.broadcast(sizes), "group").withColumn(name, F.pmod(F.xxhash64("cell_id", F.lit(name)), F.col(f"{name}s"))).drop(f"{name}s"), sizes

    residents, resident_chunks = chunked(home, "r")
    known = scratch.put("sample", knn_of_sample(vec, k, sample))
    found, low, high = None, 0, min(n_probe, len(centres))
    while True:
        visitors, visitor_chunks = chunked(visits(low, high), "l")
        left = visitors.join(F.broadcast(resident_chunks), "group").withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rs") - 1)))
        right = residents.join(F.broadcast(visitor_chunks), "group").withColumn("l", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ls") - 1)))
        cand = left.groupBy("group", "l", "r").cogroup(right.groupBy("group", "l", "r")).applyInPandas(
            lambda lp, rp: _lists_nearest(lp, rp, k), _CANDIDATES)
        if found is not None:
            cand = cand.unionByName(found.drop("rank"))
        found = scratch.put(f"found-{high}", _nearest_of(cand, k))
        reached = knn_recall(found, known).first().recall
        if high >= len(centres) or reached is None or reached >= recall:
            return found
        low, high = high, min(2 * high, len(centres))


def knn_recall(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Fraction of the exact neighbours that the approximate search found (overall and per cell mean)."""
    hit = exact.select("src", "dst").join(approx.select("src", "dst"), ["src", "dst"], "left_semi")
    per = exact.groupBy("src").agg(F.count(F.lit(1)).alias("k")).join(
        hit.groupBy("src").agg(F.count(F.lit(1)).alias("h")), "src", "left").fillna({"h": 0})
    return per.agg((F.sum("h") / F.sum("k")).alias("recall"), F.min(F.col("h") / F.col("k")).alias("min_cell_recall"))
