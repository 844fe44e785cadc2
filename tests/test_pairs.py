"""Correlograms and merging of units against plain loops over all pairs of spikes."""

from collections import Counter

import numpy as np
import pytest

from spikeloom.operators import pairs

WINDOW, STEP, NEAR, DEAD = 50, 5, 10, 2


def trains(seed):
    """One unit split in three, a unit of its own, a rare one, and another well."""
    rng = np.random.default_rng(seed)
    out = []
    whole = np.cumsum(rng.integers(12, 40, 900))
    for t in whole:
        out.append(("a", int(rng.choice([1, 4, 7])), int(t)))
    out += [("a", 2, int(t)) for t in np.sort(rng.choice(np.arange(1, whole[-1]), 1500, replace=False))]
    out += [("a", 9, int(t)) for t in rng.choice(whole, 20, replace=False) + 1] + [("b", 1, 5), ("b", 1, 5), ("b", 2, 7)]
    return out


def plain_lags(rows):
    out = Counter()
    for i, (w, u, t) in enumerate(rows):
        for j, (x, v, s) in enumerate(rows):
            if w == x and i != j and u <= v and abs(s - t) <= WINDOW and -WINDOW // STEP <= (s - t) // STEP < WINDOW // STEP:
                out[w, u, v, (s - t) // STEP] += 1
    return out


def plain_merge(rows):
    """The same rounds, by arrays of lags."""
    while True:
        lags, n = plain_lags(rows), Counter((w, u) for w, u, _ in rows)
        curve = lambda w, u, v: np.array([lags[w, u, v, k] for k in range(-WINDOW // STEP, WINDOW // STEP)], float)
        close = lambda c: c[len(c) // 2 - NEAR // STEP : len(c) // 2 + NEAR // STEP].sum()
        links = []
        for w, u in n:
            for x, v in n:
                if w == x and u < v and min(n[w, u], n[w, v]) >= 30 and curve(w, u, v).sum():
                    c, a, b = curve(w, u, v), curve(w, u, u), curve(w, v, v)
                    far = [np.abs(c / c.mean() - (y / y.mean() if y.sum() else y)).mean() for y in (a, b)]
                    total, spans = n[w, u] + n[w, v], [t for y, _, t in rows if y == w]
                    share = 1 - (close(c) + close(a) / 2 + close(b) / 2) * (max(spans) - min(spans) - 2 * total * DEAD) / (total**2 * (NEAR - DEAD))
                    if (n[w, u] * far[0] + n[w, v] * far[1]) / total <= 0.5 and (1 - share**0.5 if share >= 0 else 1) <= 0.2:
                        links.append((w, u, v))
        if not links:
            return sorted(rows)
        to = {k: k[1] for k in n}
        for _ in n:
            for w, u, v in links:
                to[w, u] = to[w, v] = min(to[w, u], to[w, v])
        joined = {(w, to[w, u]) for w, u, v in links}
        named = sorted((w, to[w, u], t) for w, u, t in rows)
        rows = [r for k, r in enumerate(named) if r[:2] not in joined or not k or named[k - 1][:2] != r[:2] or r[2] - named[k - 1][2] > DEAD]


@pytest.mark.parametrize("block", [1 << 16, 20])
def test_lags_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(pairs, "BLOCK", block)
    rows = trains(1)[:1200] + trains(1)[-30:]
    got = {(r.well, r.unit_a, r.unit_b, r.lag): r.n for r in pairs.correlograms(spark.createDataFrame(rows, "well string, unit_id int, t long"), WINDOW, STEP).collect()}
    assert got == dict(plain_lags(rows))


def test_merging_in_rounds(spark):
    rows = trains(2)
    spikes = spark.createDataFrame(rows, "well string, unit_id int, t long")
    options = {"min_spikes": 30, "most_different": 0.5}
    want = plain_merge(rows)
    got = sorted(tuple(r) for r in pairs.auto_merge(spikes, WINDOW, STEP, NEAR, DEAD, **options).collect())
    assert got == want and len({u for w, u, _ in got if w == "a"}) == 3
    assert sorted(tuple(r) for r in pairs.auto_merge(spikes, WINDOW, STEP, NEAR, DEAD, enabled=False).collect()) == sorted(rows)
    once = pairs.auto_merge(spikes, WINDOW, STEP, NEAR, DEAD, recursive=False, **options)
    assert set(once.toPandas().unit_id) <= {1, 2, 4, 7, 9}
    assert pairs.auto_merge(spikes.limit(0), WINDOW, STEP, NEAR, DEAD).count() == 0


def test_groups_of_chains(spark):
    links = [("w", k, k + 1) for k in range(1, 12)] + [("w", 20, 30), ("v", 3, 4)]
    got = {(r.well, r.unit_id): r.merged for r in pairs.groups(spark.createDataFrame(links, "well string, unit_a int, unit_b int")).collect()}
    assert got == {("w", k): 1 for k in range(1, 13)} | {("w", 20): 20, ("w", 30): 20, ("v", 3): 3, ("v", 4): 3}


def test_running_counts_are_the_counts_of_pairs(monkeypatch):
    rng = np.random.default_rng(8)
    for trial in range(30):
        n, units, half = int(rng.integers(2, 120)), int(rng.integers(1, 40)), int(rng.integers(1, 6))
        t = np.sort(np.round(rng.uniform(0, 2, n), 1)) if trial % 2 else np.sort(rng.integers(0, 30, n) * 7)  # many ties and lags on edges
        step = 0.1 if trial % 2 else 7
        unit, own = rng.integers(0, units, n), rng.random(n) < 0.8
        own[0] = True
        every = -int(-(step * half) // step)
        for x, y in zip(pairs._enumerated(t, unit, own, units, step * half, step, every), pairs._counted(t, unit, own, units, step * half, step, every)):
            assert np.array_equal(x, y)


def test_dense_blocks_are_not_counted_pair_by_pair(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(pairs, "_enumerated", None)
    pdf = pd.DataFrame({"well": "a", "unit_id": np.arange(200_000) % 7, "t": np.arange(200_000), "_own": np.arange(200_000) < 100_000})
    got = pairs._lags(pdf, 100_000, 10_000)
    assert got[(got.unit_a == 0) & (got.unit_b == 0)].n.sum() == 2 * sum(100_000 // 7 for k in range(0, 100_000, 7))
