"""Density clustering against plain versions over whole distance matrices."""

import tracemalloc

import numpy as np
import pytest

from spikeloom.operators import density


def plain_tree(x, k):
    """Kruskal's algorithm over all pairs."""
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    core = np.array([np.sort(np.delete(row, i))[min(k, len(x) - 1) - 1] for i, row in enumerate(d)])
    reach = np.maximum(d, np.maximum(core[:, None], core[None]))
    top, out = list(range(len(x))), []

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for w, a, b in sorted((reach[a, b], a, b) for a in range(len(x)) for b in range(a + 1, len(x))):
        if root(a) != root(b):
            top[root(b)] = root(a)
            out.append((a, b, w))
    return out


def plain_labels(n, edges, size):
    """Excess of mass by splitting sets: remove the longest edge first."""
    chosen = []

    def pieces(rows, tree):
        """Split at the longest edge: (level, two parts with their edges)."""
        e = max(tree, key=lambda x: (x[2], x[0], x[1]))
        rest = [x for x in tree if x is not e]
        side = {e[0]}
        grown = True
        while grown:
            more = {v for x in rest for v in x[:2] if (x[0] in side) != (x[1] in side)}
            grown = bool(more - side)
            side |= more
        parts = [side, set(rows) - side]
        return 1 / e[2], [(p, [x for x in rest if x[0] in p]) for p in parts]

    def grow(rows, tree, born):
        """(mass of this cluster, best mass, clusters chosen below or itself)."""
        every, mass = rows, 0.0
        while tree:
            level, parts = pieces(rows, tree)
            big = [p for p in parts if len(p[0]) >= size]
            if len(big) == 2:
                mass += (level - born) * len(rows)
                below = [grow(p, t, level) for p, t in big]
                total = sum(x[0] for x in below)
                return (mass, [every]) if mass >= total else (total, [c for x in below for c in x[1]])
            gone = len(rows) - (len(big[0][0]) if big else 0)
            mass += (level - born) * gone
            if not big:
                return mass, [every]
            rows, tree = big[0]
        return mass, [every]

    rows, tree = set(range(n)), edges
    while tree:  # the whole is no cluster
        level, parts = pieces(rows, tree)
        big = [p for p in parts if len(p[0]) >= size]
        if len(big) == 2:
            chosen = [c for p, t in big for c in grow(p, t, level)[1]]
            break
        if not big:
            break
        rows, tree = big[0]
    return {frozenset(c) for c in chosen}


def regimes(seed, n, m, d=10):
    """Two regimes of bins: background, and a burst in the middle."""
    rng = np.random.default_rng(seed)
    x = rng.normal(0.05, 0.05, (n + m, d))
    x[n // 2 : n // 2 + m] = rng.normal(0.8, 0.05, (m, d))
    return x


@pytest.fixture(scope="module")
def wells():
    rng = np.random.default_rng(4)
    return {"two": regimes(0, 160, 40), "noise": rng.uniform(0, 1, (60, 3)), "four": np.concatenate([rng.normal(c, 0.1 + 0.1 * c, (30, 2)) for c in (0, 2, 5, 5.9)]), "ties": rng.integers(0, 4, (50, 2)).astype(float) + np.arange(50)[:, None] * 1e-3, "one": np.zeros((1, 2)), "pair": np.array([[0.0, 1.0], [2.0, 3.0]])}


def frame(spark, wells):
    return spark.createDataFrame([(w, i, [float(v) for v in row]) for w, x in wells.items() for i, row in enumerate(x)], "well string, id long, x array<double>").repartition(3)


@pytest.mark.parametrize("block", [1024, 10])
def test_spanning_tree_is_that_of_all_pairs(spark, monkeypatch, wells, block):
    monkeypatch.setattr(density, "BLOCK", block)
    monkeypatch.setattr(density, "FAN", 3)
    got = {}
    for r in density.spanning_tree(frame(spark, wells), ["well"], 5).collect():
        got.setdefault(r.well, []).append((r.a, r.b, r.w))
    for w, x in wells.items():
        want = plain_tree(x, 5) if len(x) > 1 else []
        assert [e[:2] for e in sorted(got.get(w, []))] == [e[:2] for e in sorted(want)]
        assert np.allclose([e[2] for e in sorted(got.get(w, []))], [e[2] for e in sorted(want)])


def test_clusters_have_the_largest_excess_of_mass(spark, wells):
    for size in (5, 10, 30):
        got = {}
        for r in density.clusters(frame(spark, wells), ["well"], size, 5).collect():
            assert 0 <= r.probability <= 1 and (r.label >= 0 or r.probability == 0)
            got.setdefault(r.well, {}).setdefault(r.label, set()).add(r.id)
        for w, x in wells.items():
            want = plain_labels(len(x), plain_tree(x, 5), size) if len(x) > 1 else set()
            assert sum(map(len, got[w].values())) == len(x)
            assert {frozenset(v) for k, v in got[w].items() if k >= 0} == want


def test_burst_bins_are_one_cluster(spark):
    x = regimes(42, 800, 200)
    labels = {r.id: r.label for r in density.clusters(frame(spark, {"w": x}), ["well"], 30, 5).collect()}
    burst = {labels[i] for i in range(400, 600)}
    assert len(burst - {-1}) == 1 and not burst & {labels[i] for i in range(400)} - {-1}
    assert sum(labels[i] == -1 for i in range(400, 600)) < 60


def test_spanning_forest_of_sparse_edges():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n, m = rng.integers(2, 12), rng.integers(1, 30)
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        a, b, w = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b], rng.integers(0, 4, m).astype(float)[a != b]
        top, want = list(range(n)), set()
        root = lambda i: i if top[i] == i else root(top[i])
        for k in np.lexsort((b, a, w)):
            if root(a[k]) != root(b[k]):
                top[root(b[k])] = root(a[k])
                want.add((a[k], b[k], w[k]))
        got = density.spanning(a, b, w)
        assert {(a[k], b[k], w[k]) for k in got} == want and len(got) == len(want)


def test_principal_axes_of_each_well(spark):
    rng = np.random.default_rng(1)
    wells = {w: rng.normal(size=(n, 6)) @ rng.normal(size=(6, 6)) + 5 for w, n in (("a", 200), ("b", 40), ("c", 7))}
    out, fitted = density.principal_axes(frame(spark, wells), ["well"], 3)
    shares = {r.well: r.shares for r in fitted.collect()}
    axes = {}
    for r in out.collect():
        axes.setdefault(r.well, {})[r.id] = r.axes
    for w, x in wells.items():
        centred = x - x.mean(axis=0)
        _, s, v = np.linalg.svd(centred, full_matrices=False)
        assert np.allclose(shares[w], (s**2 / (s**2).sum())[:3])
        own = np.array([axes[w][i] for i in range(len(x))])
        assert np.allclose(np.abs(own), np.abs(centred @ v[:3].T), atol=1e-8)


def test_spectral_clusters_follow_moons_and_gaps(spark):
    rng = np.random.default_rng(9)
    t = rng.uniform(0, np.pi, 400)
    moon = np.stack([np.cos(t), np.sin(t)], axis=1)
    moons = np.concatenate([moon[:200], [1, 0.5] - moon[200:]]) + rng.normal(0, 0.04, (400, 2))
    blobs = np.concatenate([rng.normal(c, 0.3, (30, 2)) for c in ((0, 0), (6, 0), (0, 6), (7, 7))])
    got = {}
    for wells, choices in (({"moons": moons}, (2,)), ({"blobs": blobs, "two": np.zeros((2, 2))}, (2, 3, 4, 5, 6, 7, 8))):
        for r in density.spectral_clusters(frame(spark, wells), ["well"], 10, choices).collect():
            got.setdefault(r.well, {})[r.id] = (r.label, r.k)
    assert [got["moons"][i] for i in range(400)] == [(int(i >= 200), 2) for i in range(400)]
    assert [got["blobs"][i] for i in range(120)] == [(i // 30, 4) for i in range(120)]
    assert got["two"] == {0: (0, 1), 1: (0, 1)}


def test_leading_vectors_are_those_of_the_whole_matrix():
    rng = np.random.default_rng(2)
    n = 500
    a, b = rng.integers(0, n, 4000), rng.integers(0, n, 4000)
    dense = np.zeros((n, n))
    dense[a, b] = 1.0
    dense = np.maximum(dense, dense.T) + np.eye(n)
    dense /= np.sqrt(np.outer(dense.sum(axis=0), dense.sum(axis=0)))
    a, b = np.nonzero(dense)
    values, vectors = density._leading(a, b, dense[a, b], n, 5, 1)
    assert np.allclose(values, np.linalg.eigvalsh(dense)[::-1][:5], atol=1e-6) and np.allclose(dense @ vectors, vectors * values, atol=1e-3)


def test_few_pairs_get_exact_distances():
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(300, 64)), rng.normal(size=(200, 64))
    d = density._distances(x, y)
    limit = np.full(d.shape, np.quantile(d, 0.01))
    p, q, got = density.within(x, y, limit)
    assert len(p) == 600 and (d <= limit).sum() == 600 and np.array_equal(got, d[p, q])
    for x, scale in ((rng.integers(0, 3, (120, 2)).astype(float), 1.0), (rng.normal(size=(120, 2)), 1e200), (np.zeros((5, 2)), 1.0)):
        ids, x = rng.permutation(len(x)), x * scale
        p, q, got = density.closest(x, x, ids, 5, density._squares(x, x), True)
        d = density._distances(x, x)
        np.fill_diagonal(d, np.inf)
        want = [sorted((d[i, j], ids[j]) for j in range(len(x)) if np.isfinite(d[i, j]))[:5] for i in range(len(x))]
        assert [list(zip(got[p == i], ids[q[p == i]])) for i in range(len(x))] == want


def test_longest_edge_of_a_path_is_the_largest_gap():
    rng = np.random.default_rng(5)
    n = 40
    tree = [(i, int(rng.integers(0, i)), float(rng.integers(0, 9))) for i in range(1, n) if i not in (7, 20)]  # three trees
    longest = np.full((n, n), np.inf)
    np.fill_diagonal(longest, 0)
    for a, b, w in tree:
        longest[a, b] = longest[b, a] = w
    for k in range(n):
        longest = np.minimum(longest, np.maximum(longest[:, k, None], longest[None, k]))
    ids, gap = density.laid_out(*(np.array(v) for v in zip(*tree)))
    place = {int(i): k for k, i in enumerate(ids)}
    assert all(gap[min(place[a], place[b]) : max(place[a], place[b])].max() == longest[a, b] for a in place for b in place if a != b)


def test_leading_vectors_take_few_bytes_a_row():
    rng = np.random.default_rng(8)
    n, k = 6000, 40
    a, b = np.repeat(np.arange(n), k), rng.integers(0, n, n * k)
    tracemalloc.start()
    density._leading(a, b, np.full(n * k, 1 / k), n, 9, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12_000 * n  # with all edges times all vectors: more than 170,000
