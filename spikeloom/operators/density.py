"""Density clustering of bins: core distances, a minimum spanning tree of mutual reachability, its condensed tree, excess of mass.

Rows are (by, id, x): an integer id and an array of numbers, alike long in a group. The reachability of two rows is the largest of their
distance and both core distances (to the min_samples-th nearest other row).

Distances are made block by block: a group's rows are dealt over blocks of BLOCK, and each cell of two blocks is a task's work. A row's nearest
neighbours are merged from its cells. In a cell, squares by matrix products tell which pairs may count, with a margin for their rounding; only
these get their exact distance.

A guide is made before the tree: the spanning tree of the pairs of nearest rows and of each block's own tree. Its rows are laid out so that the longest
edge of the guide's path between two rows is the largest gap between their places; a pair farther apart than that is no edge of the whole tree. Cells are
then made of blocks of places. An edge of the whole tree is an edge of the tree of any two blocks that hold its ends, so each cell
returns its own spanning forest, and FAN of these at a time are merged into one until a group has one. Edges are ordered by
(weight, smaller id, larger id), so the tree is one and the same however rows are dealt. The guide is laid out from a group's min_samples + 1 edges a row,
and the condensed tree made from its n - 1 edges, in one task. Groups with fewer than two rows have no edges; their rows are noise.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikeloom.functions.lineage import stored

from . import models

BLOCK, FAN = 1024, 8


def _blocked(rows: DataFrame, by: list[str]) -> tuple[DataFrame, int]:
    """`rows` with a block each and the number of blocks of their group; the largest such number."""
    n = rows.groupBy(*by).agg(F.ceil(F.count("*") / BLOCK).alias("_blocks"))
    dealt = rows.join(n, by).withColumn("_block", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int")).withColumn("_blocks", F.col("_blocks").cast("int"))
    return dealt, n.agg(F.max("_blocks")).first()[0] or 0


def _cells(dealt: DataFrame, with_itself: Column) -> DataFrame:
    """Each row in every cell of its block: _i <= _j."""
    met = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).where((F.col("_other") != F.col("_block")) | with_itself)
    return met.withColumn("_i", F.least("_block", "_other")).withColumn("_j", F.greatest("_block", "_other"))


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances; a pair's is the same number whichever rows are beside it."""
    total = np.zeros((len(x), len(y)))
    for k in range(x.shape[1]):
        total += (x[:, k, None] - y[None, :, k]) ** 2
    return np.sqrt(total)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances by a matrix product, at most half of `_margin` off."""
    return (x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1)[None] - 2 * (x @ y.T)


def _margin(x: np.ndarray, y: np.ndarray) -> float:
    top = np.sqrt((x**2).sum(axis=1).max(initial=0)) + np.sqrt((y**2).sum(axis=1).max(initial=0))
    return 4 * (x.shape[1] + 8) * np.finfo(float).eps * top**2


def _of_pairs(x: np.ndarray, y: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """`_distances` of some pairs, the same numbers."""
    if 4 * len(p) > len(x) * len(y):
        return _distances(x, y)[p, q]
    total, x, y = np.zeros(len(p)), np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
    for k in range(len(x)):
        total += (x[k][p] - y[k][q]) ** 2
    return np.sqrt(total)


def closest(x: np.ndarray, y: np.ndarray, ids: np.ndarray, k: int, squares: np.ndarray, itself: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of y, distance) of the k nearest rows of y, ordered by row and distance, ties by id. Pairs at no finite distance are left out."""
    squares = np.where(np.eye(len(x), dtype=bool), np.inf, squares) if itself else squares
    far = np.partition(squares, k - 1, axis=1)[:, k - 1, None] + 2 * _margin(x, y) if squares.shape[1] > k else np.inf
    p, q = np.nonzero(~(squares > far))  # what isn't a number is kept
    p, q = (p[p != q], q[p != q]) if itself else (p, q)
    d = _of_pairs(x, y, p, q)
    p, q, d = p[np.isfinite(d)], q[np.isfinite(d)], d[np.isfinite(d)]
    order = np.lexsort((ids[q], d, p))
    p, q, d = p[order], q[order], d[order]
    first = np.arange(len(p)) - np.searchsorted(p, p) < k
    return p[first], q[first], d[first]


def within(x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of y, distance) of all pairs within their limits; a few others may be among them."""
    p, q = np.nonzero(~(_squares(x, y) > limit**2 + _margin(x, y)))
    return p, q, _of_pairs(x, y, p, q)


def _kinds(rows: DataFrame, by: list[str]) -> str:
    return ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in by)


def nearest_rows(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """(by, id, near): the k nearest other rows of the group (all, if fewer), as structs (d, other) by distance, ties by id."""

    def nearest(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf._block.to_numpy() == pdf._i.iloc[0]
        one = pdf._i.iloc[0] == pdf._j.iloc[0]
        x, ids = np.stack(pdf.x.to_numpy()), pdf.id.to_numpy(np.int64)
        mine, others = np.flatnonzero(first), np.flatnonzero(first if one else ~first)
        squares, out = _squares(x[mine], x[others]), []
        for which, to, own in [(mine, others, squares)] if one else [(mine, others, squares), (others, mine, squares.T)]:
            if len(which):
                p, q, d = closest(x[which], x[to], ids[to], k, own, one)
                cuts = np.searchsorted(p, np.arange(1, len(which)))
                out.append(pdf.iloc[which][[*by, "id"]].assign(d=np.split(d, cuts), other=np.split(ids[to][q], cuts)))
        return pd.concat(out)

    dealt, _ = _blocked(rows.select(*by, "id", F.col("x").cast("array<double>").alias("x")), by)
    near = _cells(dealt, F.lit(True)).groupBy(*by, "_i", "_j").applyInPandas(nearest, f"{_kinds(rows, by)}, id long, d array<double>, other array<long>")
    return near.groupBy(*by, "id").agg(F.slice(F.array_sort(F.flatten(F.collect_list(F.arrays_zip("d", "other")))), 1, k).alias("near"))


def _core() -> Column:
    return F.coalesce(F.array_max("near")["d"], F.lit(0.0)).alias("core")


def core_distances(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """(by, id, core): distance to the k-th nearest other row of the group, or to the farthest if there are fewer."""
    return nearest_rows(rows, by, k).select(*by, "id", _core())


def _leading(a: np.ndarray, b: np.ndarray, w: np.ndarray, n: int, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a sparse symmetric matrix (entries w at a, b; sorted by a), and their vectors."""
    if n <= 256:
        dense = np.zeros((n, n))
        dense[a, b] = w
        values, vectors = np.linalg.eigh(dense)
    else:  # Rayleigh-Ritz in the space of a block and its first products with the matrix
        begin = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))  # every row has entries
        part, wide = 4096, k + 2

        def times(v: np.ndarray) -> np.ndarray:
            """The product with some vectors, part by part: no more than a part's entries are spread out at a time."""
            out = np.empty_like(v)
            for r in range(0, n, part):
                own = slice(begin[r], begin[r + part] if r + part < n else len(a))
                out[r : r + part] = np.add.reduceat(w[own, None] * v[b[own]], begin[r : r + part] - begin[r], axis=0)
            return out

        basis = np.empty((n, 25 * wide))
        basis[:, :wide] = block = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, wide)))[0]
        for m in range(wide, 25 * wide, wide):
            block = times(block)
            for _ in range(2):
                block = block - basis[:, :m] @ (basis[:, :m].T @ block)
            basis[:, m : m + wide] = block = np.linalg.qr(block)[0]
        values, vectors = np.linalg.eigh(np.concatenate([basis.T @ times(basis[:, m : m + wide]) for m in range(0, 25 * wide, wide)], axis=1))
        return values[::-1][:k], basis @ vectors[:, ::-1][:, :k]
    return values[::-1][:k], vectors[:, ::-1][:, :k]


def spectral_clusters(rows: DataFrame, by: list[str], neighbours: int = 30, choices: tuple[int, ...] = (2, 3, 4, 5, 6, 7, 8), seed: int = 42) -> DataFrame:
    """(by, id, label, k): spectral clusters over the graph of nearest rows, k being the choice with the largest gap between eigenvalues.

    The graph is an edge table, made block by block; each pair weighs a half for each side that has the other among its nearest. A group's graph, at most
    2 * neighbours edges a row, is one task's work: leading vectors of its normalised matrix, then k-means on them. It comes with a row for each of its rows; the task holds
    about 16 bytes for each edge and 8 * 25 * (max(choices) + 3) for each row. Labels are numbered by their first id.
    """
    near = nearest_rows(rows, by, neighbours).select(*by, F.col("id").alias("p"), F.explode_outer("near").alias("x")).select(*by, "p", F.col("x.other").alias("q"))
    side = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    both = near.select(*by, F.explode(F.when(F.col("q").isNull(), F.array(side("p", "q"))).otherwise(F.array(side("p", "q"), side("q", "p")))).alias("e")).select(*by, "e.*")
    edges = both.repartition(*by, "a").groupBy(*by, "a", "b").agg((F.count("*") / 2).alias("w"))
    sides = edges.groupBy(*by, "a").agg(F.array_sort(F.collect_list(F.when(F.col("b").isNotNull(), F.struct("b", "w")))).alias("e")).select(*by, "a", F.col("e.b").alias("b"), F.col("e.w").alias("w"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("a")
        ids, keys = pdf.a.to_numpy(np.int64), {c: pdf[c].iloc[0] for c in by}
        n, label, k = len(ids), np.zeros(len(ids), np.int64), 1
        if n > 2:
            a, b, w = np.repeat(np.arange(n, dtype=np.int32), pdf.b.map(len)), np.searchsorted(ids, np.concatenate(pdf.b.to_list())).astype(np.int32), np.concatenate(pdf.w.to_list())
            degree = np.bincount(a, w, n)
            w /= np.sqrt(degree[a] * degree[b])
            values, vectors = _leading(a, b, w, n, min(max(choices) + 1, n), seed)
            open_ = [c for c in choices if c < len(values)]
            k = max(open_, key=lambda c: values[c - 1] - values[c]) if open_ else 1
            found = models._lloyd(vectors[:, :k] / np.sqrt(degree)[:, None], k, seed)
            _, first, label = np.unique(found, return_index=True, return_inverse=True)
            label = np.argsort(np.argsort(first))[label]
        return pd.DataFrame({**keys, "id": ids, "label": label.astype(np.int32), "k": np.int32(k)}, index=range(n))

    return sides.groupBy(*by).applyInPandas(one, f"{_kinds(rows, by)}, id long, label int, k int")


def _prim(ids: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spanning tree of a complete graph, by ids and a matrix of weights."""
    n = len(ids)
    pair = lambda k: (np.minimum(ids[k], ids), np.maximum(ids[k], ids))
    best, (low, high), out = weight[0].copy(), pair(0), []
    waiting = np.arange(1, n)
    while len(waiting):
        tied = waiting[best[waiting] == best[waiting].min()]
        k = tied[np.lexsort((high[tied], low[tied]))[0]] if len(tied) > 1 else tied[0]
        out.append((low[k], high[k], best[k]))
        waiting = waiting[waiting != k]
        a, b = pair(k)
        better = (weight[k] < best) | ((weight[k] == best) & ((a < low) | ((a == low) & (b < high))))
        best, low, high = np.where(better, weight[k], best), np.where(better, a, low), np.where(better, b, high)
    a, b, w = zip(*out) if out else ((), (), ())
    return np.array(a, np.int64), np.array(b, np.int64), np.array(w, float)


def spanning(a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The places of the edges of a minimum spanning forest, by rounds in which every component takes its first edge outwards."""
    order = np.lexsort((b, a, w))
    _, ends = np.unique(np.concatenate([a[order], b[order]]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    part, taken, left = np.arange(ends.max(initial=-1) + 1), np.zeros(len(a), bool), np.arange(len(a))
    while True:
        p, q = part[x[left]], part[y[left]]
        left, p, q = left[p != q], p[p != q], q[p != q]
        if not len(left):
            return order[taken]
        first = np.full(len(part), len(a))
        np.minimum.at(first, p, left)
        np.minimum.at(first, q, left)
        roots = np.flatnonzero(first < len(a))
        edge = first[roots]
        taken[edge] = True
        up = np.arange(len(part))
        up[roots] = np.where(part[x[edge]] == roots, part[y[edge]], part[x[edge]])
        both = up[up[roots]] == roots  # two that took the same edge: the smaller one is their root
        up[roots[both & (roots < up[roots])]] = roots[both & (roots < up[roots])]
        while not np.array_equal(up, up[up]):
            up = up[up]
        part = up[part]


def laid_out(a: np.ndarray, b: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a forest (of `spanning`) in an order in which the longest edge between two of them is the largest gap between their places, and the gap after each place (infinite between trees)."""
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    n, order = len(ids), np.lexsort((b, a, w))
    top, last, after, gap, count = list(range(n)), list(range(n)), [-1] * n, [np.inf] * n, [1] * n
    x, y, w = ends[: len(a)][order].tolist(), ends[len(a) :][order].tolist(), w[order].tolist()

    def root(k: int) -> int:
        while top[k] != k:
            top[k] = top[top[k]]
            k = top[k]
        return k

    for p, q, v in zip(x, y, w):  # the smaller part is put behind the larger one; a part's root is its first place
        p, q = root(p), root(q)
        p, q = (p, q) if count[p] >= count[q] else (q, p)
        after[last[p]], gap[last[p]] = q, v
        top[q], last[p], count[p] = p, last[q], count[p] + count[q]
    places = []
    for k in (k for k in range(n) if top[k] == k):
        while k >= 0:
            places.append(k)
            k = after[k]
    return ids[places], np.array(gap)[places]


def spanning_tree(rows: DataFrame, by: list[str], min_samples: int = 5) -> DataFrame:
    """(by, a, b, w): the n - 1 edges of each group's minimum spanning tree of mutual reachability, a < b."""
    size, edge = BLOCK, f"{_kinds(rows, by)}, _i int, a long, b long, w double"

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        core, x = pdf.core.to_numpy(), np.stack(pdf.x.to_numpy())
        a, b, w = _prim(pdf.id.to_numpy(), np.maximum(_distances(x, x), np.maximum(core[:, None], core[None])))
        return pd.DataFrame({**{c: pdf[c].iloc[0] for c in by}, "_i": np.int32(0), "a": a, "b": b, "w": w}, index=range(len(a)))

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.iloc[spanning(pdf.a.to_numpy(), pdf.b.to_numpy(), pdf.w.to_numpy())]

    def guide(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = merged(pdf)
        ids, gap = laid_out(tree.a.to_numpy(), tree.b.to_numpy(), tree.w.to_numpy())
        n = len(ids)
        of_block = np.zeros((-(-n // size), size))
        of_block.ravel()[:n] = gap
        ahead = np.maximum.accumulate(of_block[:, ::-1], axis=1)[:, ::-1]
        behind = np.maximum.accumulate(np.pad(of_block, ((0, 0), (1, 0)))[:, :-1], axis=1)
        return pd.DataFrame({**{c: pdf[c].iloc[0] for c in by}, "id": ids, "_place": np.arange(n), "_block": (np.arange(n) // size).astype(np.int32), "_gap": gap, "_ahead": ahead.ravel()[:n], "_behind": behind.ravel()[:n]}, index=range(n))

    def cell(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_place")
        i, j = pdf._i.iloc[0], pdf._j.iloc[0]
        one, two = (pdf, pdf) if i == j else (pdf[pdf._block == i], pdf[pdf._block == j])
        if i == j:
            gap, limit = pdf._gap.to_numpy(), np.zeros((len(pdf), len(pdf)))
            for k in range(len(pdf) - 1):
                limit[k, k + 1 :] = np.maximum.accumulate(gap[k:-1])
        else:
            limit = np.maximum(np.maximum(one._ahead.to_numpy()[:, None], two._behind.to_numpy()[None]), pdf._over.iloc[0])
        p, q, w = within(np.stack(one.x.to_numpy()), np.stack(two.x.to_numpy()), limit)
        p, q, w = (p[p < q], q[p < q], w[p < q]) if i == j else (p, q, w)
        w = np.maximum(w, np.maximum(one.core.to_numpy()[p], two.core.to_numpy()[q]))
        a, b = one.id.to_numpy()[p], two.id.to_numpy()[q]
        a, b = np.minimum(a, b), np.maximum(a, b)
        own = spanning(a, b, w)
        return pd.DataFrame({**{c: pdf[c].iloc[0] for c in by}, "_i": np.int32(i), "a": a[own], "b": b[own], "w": w[own]}, index=range(len(own)))

    near = stored(nearest_rows(rows, by, min_samples))
    core = near.select(*by, "id", _core())
    own = rows.select(*by, "id", F.col("x").cast("array<double>").alias("x")).join(core, [*by, "id"])
    blocks = _blocked(own, by)[0].groupBy(*by, "_block").applyInPandas(block, edge)
    pairs = near.select(*by, "id", _core(), F.explode("near").alias("_n")).select(*by, "id", "core", F.col("_n.other").alias("_other"), F.col("_n.d").alias("_d")).join(core.select(*by, F.col("id").alias("_other"), F.col("core").alias("_core")), [*by, "_other"])
    pairs = pairs.select(*by, F.lit(0).alias("_i"), F.least("id", "_other").alias("a"), F.greatest("id", "_other").alias("b"), F.greatest("_d", "core", "_core").alias("w"))
    places = stored(blocks.unionByName(pairs).groupBy(*by).applyInPandas(guide, f"{_kinds(rows, by)}, id long, _place long, _block int, _gap double, _ahead double, _behind double"))
    gaps = places.groupBy(*by, "_block").agg(F.max("_gap").alias("top")).groupBy(*by).agg(F.count("*").cast("int").alias("_blocks"), F.array_sort(F.collect_list(F.struct("_block", "top")))["top"].alias("_tops"))
    most = gaps.agg(F.max("_blocks")).first()[0] or 0
    over = F.coalesce(F.array_max(F.slice("_tops", F.col("_i") + 2, F.greatest(F.col("_j") - F.col("_i") - 1, F.lit(0)))), F.lit(0.0))
    cells = _cells(own.join(places, [*by, "id"]).join(gaps, by), F.lit(True)).withColumn("_over", over).drop("_tops", "_other", "_blocks")
    edges = cells.groupBy(*by, "_i", "_j").applyInPandas(cell, edge)
    fan = 1
    while most > 1:  # the trees of the cells of one block, then of FAN blocks, and so on
        edges = edges.withColumn("_i", F.floor(F.col("_i") / fan).cast("int")).groupBy(*by, "_i").applyInPandas(merged, edge)
        most, fan = (-(-most // fan) if fan > 1 else most), FAN
    return edges.select(*by, "a", "b", "w")


def condensed(ids: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Labels (-1: noise) and membership of the rows of one tree: clusters of at least `size` rows that have the largest excess of mass.

    Clusters are numbered from the widest split downwards. A row's membership is its own density level over its cluster's last one.
    """
    n = len(ids)
    labels, member = np.full(n, -1), np.zeros(n)
    if n < 2 or not len(a):
        return labels, member
    order = np.lexsort((b, a, w))
    place = {int(i): k for k, i in enumerate(ids)}
    top, made, count, child, level = list(range(n)), list(range(n)), [1] * n, [], []

    def root(k: int) -> int:
        while top[k] != k:
            top[k] = top[top[k]]
            k = top[k]
        return k

    for e in order.tolist():  # merges, n and upwards; `made` is the merge that a component comes from
        x, y = root(place[int(a[e])]), root(place[int(b[e])])
        top[y] = x
        child.append((made[x], made[y]))
        level.append(1 / w[e] if w[e] > 0 else np.inf)
        made[x] = n + len(child) - 1
        count.append(count[child[-1][0]] + count[child[-1][1]])

    def rows_below(node: int) -> list[int]:
        out, todo = [], [node]
        while todo:
            k = todo.pop()
            if k < n:
                out.append(k)
            else:
                todo += child[k - n]
        return out

    parent, birth, mass, last, leaves_at, of_row = [-1], [0.0], [0.0], [0.0], np.zeros(n), np.zeros(n, int)
    excess = lambda now, born: 0.0 if now == born else now - born
    todo = [(n + len(child) - 1, 0)]
    for node, cluster in todo:  # from the top; the list grows
        if node < n:
            continue
        now, parts = level[node - n], child[node - n]
        big = [k for k in parts if count[k] >= size]
        for k in parts:
            if len(big) == 2:
                parent.append(cluster)
                birth.append(now)
                mass.append(0.0)
                last.append(0.0)
                mass[cluster] += excess(now, birth[cluster]) * count[k]
                last[cluster] = max(last[cluster], now)
                todo.append((k, len(parent) - 1))
            elif k in big:
                todo.append((k, cluster))
            else:
                own = rows_below(k)
                leaves_at[own], of_row[own] = now, cluster
                mass[cluster] += excess(now, birth[cluster]) * len(own)
                last[cluster] = max(last[cluster], now)
    chosen, below = [False] * len(parent), [0.0] * len(parent)
    for c in range(len(parent) - 1, 0, -1):  # children come after their parents
        chosen[c] = mass[c] >= below[c]
        below[parent[c]] += max(mass[c], below[c])
    owner = [-1] * len(parent)
    for c in range(1, len(parent)):
        owner[c] = owner[parent[c]] if owner[parent[c]] >= 0 else (c if chosen[c] else -1)
    number = {c: k for k, c in enumerate(sorted({c for c in owner if c >= 0}))}
    for k in range(n):
        c = owner[of_row[k]]
        if c >= 0:
            labels[k] = number[c]
            member[k] = 1.0 if last[c] == 0 or not np.isfinite(leaves_at[k]) else min(leaves_at[k], last[c]) / last[c]
    return labels, member


def clusters(rows: DataFrame, by: list[str], min_cluster_size: int = 30, min_samples: int = 5) -> DataFrame:
    """(by, id, label, probability) of every row; label -1 is noise."""
    tree = spanning_tree(rows, by, min_samples).select(*by, "a", "b", "w", F.lit(None).cast("long").alias("id"))
    every = rows.select(*by, F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(None).cast("double").alias("w"), F.col("id").cast("long").alias("id"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = np.sort(pdf.id.dropna().to_numpy(np.int64))
        edges = pdf[pdf.id.isna()]
        labels, member = condensed(ids, edges.a.to_numpy(np.int64), edges.b.to_numpy(np.int64), edges.w.to_numpy(float), min_cluster_size)
        return pd.DataFrame({**{c: pdf[c].iloc[0] for c in by}, "id": ids, "label": labels.astype(np.int32), "probability": member}, index=range(len(ids)))

    return tree.unionByName(every).groupBy(*by).applyInPandas(one, f"{_kinds(rows, by)}, id long, label int, probability double")


def principal_axes(rows: DataFrame, by: list[str], k: int) -> tuple[DataFrame, DataFrame]:
    """`rows` with `axes`, their first k principal components within the group, and (by, mean, components, shares).

    Each batch of rows gives a group's count, mean and centred product matrix; these are merged for each group, where the eigenvectors are taken (the largest entry of
    each is positive).
    """
    kinds = _kinds(rows, by)

    def partial(batches):
        for pdf in batches:
            for keys, own in pdf.groupby(by, dropna=False):
                x = np.stack(own.x.to_numpy())
                mean = x.mean(axis=0)
                yield pd.DataFrame([[*keys, float(len(x)), mean, ((x - mean).T @ (x - mean)).ravel()]], columns=[*by, "n", "mean", "product"])

    def axes(pdf: pd.DataFrame) -> pd.DataFrame:
        n, means, products = pdf.n.to_numpy(), np.stack(pdf["mean"].to_numpy()), np.stack(pdf["product"].to_numpy())
        mean = (n[:, None] * means).sum(axis=0) / n.sum()
        total = products.sum(axis=0).reshape(len(mean), -1) + ((means - mean) * n[:, None]).T @ (means - mean)
        values, vectors = np.linalg.eigh(total)
        values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1].T
        vectors = vectors * np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])[:, None]
        share = values / values.sum() if values.sum() > 0 else values
        return pd.DataFrame([{**{c: pdf[c].iloc[0] for c in by}, "mean": mean, "components": [v.tolist() for v in vectors[:k]], "shares": share[:k]}])

    sums = rows.select(*by, F.col("x").cast("array<double>").alias("x")).mapInPandas(partial, f"{kinds}, n double, mean array<double>, product array<double>")
    fitted = stored(sums.groupBy(*by).applyInPandas(axes, f"{kinds}, mean array<double>, components array<array<double>>, shares array<double>"))
    product = lambda c: F.aggregate(F.zip_with(c, F.zip_with("x", "mean", lambda p, q: p - q), lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return rows.join(fitted.drop("shares"), by).withColumn("axes", F.transform("components", product)).drop("mean", "components"), fitted
