"""Pairs of units: correlograms, contamination after a merge, and merging of units in rounds.

Spikes are (well, unit_id, t). Lags are counted in blocks of time that also hold the spikes of one window behind them (a halo): each
pair of spikes is counted in the block of its earlier spike. Sparse blocks are counted place by place of the sorted block, dense ones by
running counts of each unit at the edges of the lags, so work grows with the spikes and not with their pairs. No row is made for a pair of
spikes, and a task holds one block, of about BLOCK spikes at a well's mean rate and never shorter than the window.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spikeloom.functions.lineage import stored

BLOCK = 1 << 16
#: Largest difference of correlograms and largest contamination of a merged unit.
MOST_DIFFERENT, MOST_CONTAMINATED = 0.16, 0.2


#: Columns of running counts that are held at a time, and what a pair costs next to a running count of one unit.
COLUMNS, PAIR_COST = 32, 20


def _enumerated(t: np.ndarray, unit: np.ndarray, own: np.ndarray, n_units: int, window: float, step: float, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of (unit_a, unit_b, lag) and their counts, pair by pair."""
    width, found, at = 2 * half, [], np.flatnonzero(own)
    k = 1
    while len(at := at[at + k < len(t)]):
        at = at[t[at + k] - t[at] <= window]
        later, lag = at + k, t[at + k] - t[at]
        a, b, swapped = np.minimum(unit[at], unit[later]), np.maximum(unit[at], unit[later]), unit[at] > unit[later]
        for sign, rows in ((1, ~swapped), (-1, swapped | (unit[at] == unit[later]))):  # a unit's own pairs count on both sides
            bin_ = np.floor(sign * lag[rows] / step).astype(np.int64)
            code = ((a[rows] * n_units + b[rows]) * width + bin_ + half)[(bin_ >= -half) & (bin_ < half)]
            found.append(np.unique(code, return_counts=True))
        k += 1
    codes, n = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2
    codes, same = np.unique(codes, return_inverse=True)
    return codes, np.bincount(same, n, len(codes)).astype(np.int64)


def _edge(t: np.ndarray, at: np.ndarray, lag: float, before) -> np.ndarray:
    """For each place of `at` the first place whose lag isn't `before` an edge; lags only grow along t, and rounding moves a place by a few at most."""
    place = np.searchsorted(t, t[at] + lag)
    while True:
        back = (place > 0) & ~before(t[np.maximum(place, 1) - 1] - t[at])
        on = ~back & (place < len(t)) & before(t[np.minimum(place, len(t) - 1)] - t[at])
        if not (back.any() or on.any()):
            return place
        place[back] = np.searchsorted(t, t[place[back] - 1], "left")  # equal times go together
        place[on] = np.searchsorted(t, t[place[on]], "right")


def _counted(t: np.ndarray, unit: np.ndarray, own: np.ndarray, n_units: int, window: float, step: float, half: int) -> tuple[np.ndarray, np.ndarray]:
    """The same by running counts: spikes times units times lags, however many pairs there are.

    How many spikes of a unit come after a spike and before an edge is a difference of two running counts of that unit; what lies between edges is a lag.
    """
    at = np.flatnonzero(own)
    at = at[np.argsort(unit[at], kind="stable")]
    begin = np.flatnonzero(np.concatenate([[True], unit[at][1:] != unit[at][:-1]]))
    first = unit[at][begin]
    near = lambda lag: lag <= window
    least = at + 1
    last = np.maximum(_edge(t, at, window, near), least)
    floors = [np.clip(_edge(t, at, k * step, lambda lag, k=k: near(lag) & (np.floor(lag / step) < k)), least, last) for k in range(1, half + 1)]
    ceils = [np.clip(_edge(t, at, k * step, lambda lag, k=k: near(lag) & (np.floor(-lag / step) >= -k)), least, last) for k in range(half + 1)]
    codes, counts = [], []
    for low in range(0, n_units, COLUMNS):
        names = np.arange(low, min(low + COLUMNS, n_units))
        running = np.zeros((len(t) + 1, len(names)), np.int32)
        np.cumsum(unit[:, None] == names[None], axis=0, out=running[1:])
        upto = lambda place: np.add.reduceat(running[place], begin, axis=0, dtype=np.int64)
        none = upto(least)
        for places, lags, later in ((floors, range(half), True), (ceils, range(0, -half - 1, -1), False)):
            before = none
            for place, lag in zip(places, lags):
                total = upto(place)
                n, before = total - before, total
                u, v = np.nonzero(n)
                p, q = first[u], names[v]
                keep = (p <= q) if later else (p >= q)
                a, b = (p, q) if later else (q, p)
                codes.append(((a * n_units + b) * 2 * half + lag + half)[keep])
                counts.append(n[u, v][keep])
    codes, same = np.unique(np.concatenate(codes), return_inverse=True)
    return codes, np.bincount(same, np.concatenate(counts), len(codes)).astype(np.int64)


def _lags(pdf: pd.DataFrame, window: float, step: float) -> pd.DataFrame:
    """Counts of (unit_a, unit_b, lag) in one block; unit_b is not below unit_a. Pairs are counted one by one where there are few."""
    pdf = pdf.sort_values("t", kind="stable")
    t, own = pdf.t.to_numpy(), pdf._own.to_numpy(bool)
    names, unit = np.unique(pdf.unit_id.to_numpy(), return_inverse=True)
    half = -int(-window // step)
    at = np.flatnonzero(own)
    pairs = np.maximum(np.searchsorted(t, t[at] + window, "right") - at - 1, 0).sum()
    few = pairs * PAIR_COST <= len(at) * 2 * half * (len(names) + PAIR_COST)
    codes, n = (_enumerated if few else _counted)(t, unit, own, len(names), window, step, half)
    pair, lag = codes // (2 * half), codes % (2 * half) - half
    return pd.DataFrame({"well": pd.Series([pdf.well.iloc[0]] * len(codes)), "unit_a": names[pair // len(names)], "unit_b": names[pair % len(names)], "lag": lag, "n": n})


def correlograms(spikes: DataFrame, window: float, step: float) -> DataFrame:
    """(well, unit_a, unit_b, lag, n): pairs of spikes with floor((t of b - t of a) / step) = lag, within -window <= lag * step < window.

    unit_a <= unit_b. A unit's own pairs count once on either side, no spike with itself. Lags without a pair have no row. `window` is a multiple of `step`.
    """
    spikes = spikes.select("well", "unit_id", "t")
    kinds = dict(spikes.dtypes)
    size = spikes.groupBy("well").agg(F.greatest((F.max("t") - F.min("t")) / F.count("*") * BLOCK, F.lit(float(window))).alias("_w"))
    sized = spikes.join(size, "well").withColumn("_b", F.floor(F.col("t") / F.col("_w")))
    halo = F.when(F.col("t") - F.col("_b") * F.col("_w") <= window, F.array(F.struct("_b", F.lit(True).alias("_own")), F.struct((F.col("_b") - 1).alias("_b"), F.lit(False).alias("_own"))))
    shown = sized.select("well", "unit_id", "t", F.explode(F.coalesce(halo, F.array(F.struct("_b", F.lit(True).alias("_own"))))).alias("x")).select("well", "unit_id", "t", "x._b", "x._own")
    schema = f"well {kinds['well']}, unit_a {kinds['unit_id']}, unit_b {kinds['unit_id']}, lag long, n long"

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        return _lags(pdf, window, step)

    counts = shown.groupBy("well", "_b").applyInPandas(count, schema)
    return counts.groupBy("well", "unit_a", "unit_b", "lag").agg(F.sum("n").alias("n"))


def contamination(n: Column, close: Column, duration: Column, refractory: float, censored: float) -> Column:
    """Share of foreign spikes in a train of n spikes with `close` pairs within the refractory period; 1 if there are more pairs than any share explains."""
    share = 1 - close * (duration - 2 * n * censored) / (n * n * (refractory - censored))
    return F.when(n > 0, F.when(share >= 0, 1 - F.sqrt(F.greatest(share, F.lit(0.0)))).otherwise(1.0))


def merge_candidates(spikes: DataFrame, window: float, step: float, refractory: float, censored: float = 0.0, min_spikes: int = 100, most_different: float = MOST_DIFFERENT, most_contaminated: float = MOST_CONTAMINATED) -> DataFrame:
    """(well, unit_a, unit_b, difference, contamination, accepted) of pairs of units with min_spikes and at least one pair of spikes within the window.

    difference: mean over the lags of |cross - auto| for each unit's own correlogram, each over its mean, weighted by the units' spikes.
    contamination: that of both units' spikes as one train; `refractory` is a multiple of `step`.
    """
    counts = stored(correlograms(spikes, window, step))
    n = spikes.groupBy("well", "unit_id").agg(F.count("*").alias("n_spikes")).where(F.col("n_spikes") >= min_spikes)
    spans = spikes.groupBy("well").agg((F.max("t") - F.min("t")).alias("duration"))
    half, near = -int(-window // step), round(refractory / step)
    auto = counts.where("unit_a = unit_b").select("well", F.col("unit_a").alias("unit_id"), "lag", "n")
    auto = auto.join(auto.groupBy("well", "unit_id").agg((F.sum("n") / (2 * half)).alias("_m")), ["well", "unit_id"]).select("well", "unit_id", "lag", "n", (F.col("n") / F.col("_m")).alias("auto"))
    cross = counts.where("unit_a < unit_b")
    side = lambda p: n.select("well", F.col("unit_id").alias(f"unit_{p}"), F.col("n_spikes").alias(f"n_{p}"))
    close = F.sum(F.when((F.col("lag") >= -near) & (F.col("lag") < near), F.col("n")).otherwise(0))
    own = auto.groupBy("well", "unit_id").agg((close / 2).alias("close"))
    pairs = cross.groupBy("well", "unit_a", "unit_b").agg((F.sum("n") / (2 * half)).alias("_m"), close.alias("_close")).join(side("a"), ["well", "unit_a"]).join(side("b"), ["well", "unit_b"])
    pairs = stored(pairs)
    # differences are summed over the lags that one of both has
    lags = cross.join(pairs.select("well", "unit_a", "unit_b", "_m"), ["well", "unit_a", "unit_b"]).select("well", "unit_a", "unit_b", "lag", (F.col("n") / F.col("_m")).alias("cross"))
    parts = []
    for p in "ab":
        mine = pairs.select("well", "unit_a", "unit_b").join(auto.withColumnRenamed("unit_id", f"unit_{p}").drop("n"), ["well", f"unit_{p}"])
        both = lags.join(mine, ["well", "unit_a", "unit_b", "lag"], "full")
        parts.append(both.groupBy("well", "unit_a", "unit_b").agg((F.sum(F.abs(F.coalesce("cross", F.lit(0.0)) - F.coalesce("auto", F.lit(0.0)))) / (2 * half)).alias(f"_d{p}")))
    both = pairs.join(parts[0], ["well", "unit_a", "unit_b"]).join(parts[1], ["well", "unit_a", "unit_b"]).join(spans, "well")
    for p in "ab":
        both = both.join(own.select("well", F.col("unit_id").alias(f"unit_{p}"), F.col("close").alias(f"_c{p}")), ["well", f"unit_{p}"], "left")
    total = F.col("n_a") + F.col("n_b")
    every = F.col("_close") + F.coalesce("_ca", F.lit(0.0)) + F.coalesce("_cb", F.lit(0.0))
    out = both.select("well", "unit_a", "unit_b", ((F.col("n_a") * F.col("_da") + F.col("n_b") * F.col("_db")) / total).alias("difference"), contamination(total.cast("double"), every, F.col("duration").cast("double"), refractory, censored).alias("contamination"))
    return out.withColumn("accepted", (F.col("difference") <= most_different) & (F.col("contamination") <= most_contaminated))


def groups(pairs: DataFrame) -> DataFrame:
    """(well, unit_id, merged): the smallest unit of each connected group of pairs (well, unit_a, unit_b), for its members."""
    ends = [pairs.select("well", F.col(a).alias("unit_id"), F.col(b).alias("other")) for a, b in (("unit_a", "unit_b"), ("unit_b", "unit_a"))]
    both = stored(ends[0].unionByName(ends[1]).distinct())
    label = stored(both.groupBy("well", "unit_id").agg(F.least(F.min("other"), F.first("unit_id")).alias("merged")))
    while True:
        beside = both.join(label.select("well", F.col("unit_id").alias("other"), F.col("merged").alias("_m")), ["well", "other"]).groupBy("well", "unit_id").agg(F.min("_m").alias("_m"))
        nearer = label.join(beside, ["well", "unit_id"]).select("well", "unit_id", "merged", F.least("merged", "_m").alias("_m"))
        jump = label.select("well", F.col("unit_id").alias("_m"), F.col("merged").alias("_top"))
        after = stored(nearer.join(jump, ["well", "_m"]).select("well", "unit_id", F.col("merged").alias("_before"), F.least("_m", "_top").alias("merged")))
        if after.where("_before <> merged").isEmpty():
            return after.drop("_before")
        label = after.drop("_before")


def merge_units(spikes: DataFrame, pairs: DataFrame, censored: float = 0.0) -> DataFrame:
    """`spikes` with the units of each group of pairs as one, the smallest; its spikes that follow another one within `censored` are left out."""
    named = spikes.join(groups(pairs), ["well", "unit_id"], "left")
    w = Window.partitionBy("well", "unit_id").orderBy("t", "_from")
    rows = named.select("well", F.coalesce("merged", "unit_id").alias("unit_id"), "t", F.col("merged").isNotNull().alias("_merged"), F.col("unit_id").alias("_from"))
    return rows.withColumn("_gap", F.col("t") - F.lag("t").over(w)).where("NOT _merged OR _gap IS NULL OR _gap > " + repr(float(censored))).select("well", "unit_id", "t")


def auto_merge(spikes: DataFrame, window: float, step: float, refractory: float, censored: float = 0.0, *, enabled: bool = True, recursive: bool = True, rounds: int = 20, **options) -> DataFrame:
    """(well, unit_id, t) with units merged, round by round until no pair is accepted (or one round); unchanged if not enabled."""
    spikes = spikes.select("well", "unit_id", "t")
    for _ in range(rounds if recursive else 1) if enabled else ():
        accepted = stored(merge_candidates(spikes, window, step, refractory, censored, **options).where("accepted"))
        if accepted.isEmpty():
            break
        spikes = stored(merge_units(spikes, accepted, censored))
    return spikes
