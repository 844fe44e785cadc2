"""Per-unit hidden Markov fits, bin features, clustering and burst typing.

Fits are grouped-map kernels over one unit's counts; features are aggregates over (well, bin).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spikeloom.functions import order
from spikeloom.functions.lineage import stored

from . import binning, smoothing
from . import spikes as trains

#: The features' names in their order.
FEATURES = (
    "post_frac_gt_0_5 post_mean post_std post_q90 post_entropy PFR participation FF0 FF1 FF2 FF3 llr_hmm_mean llr_hmm_std llr_hmm_q90 inv_isi_mean "
    "inv_isi_std cv_isi_mean lv_mean dfr_unit_mean dfr_unit_std dPFR_short dPFR_long dParticipation_short dParticipation_long dLLR_short dLLR_long"
).split()
#: Fixed starting values of a unit's chain.
TRANSITION = [[0.95, 0.05], [0.30, 0.70]]
START = [0.9, 0.1]
FIT = "well string, unit_id string, skipped string, lambda_bg double, lambda_burst double, iterations int, log_likelihood double, bin array<long>, p array<double>"


def _smooth_chain(emission: np.ndarray, move: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """State probabilities, summed transition probabilities and log likelihood of a two-state chain, by scaled recursions in blocks.

    The chain is cut into about sqrt(n) blocks. A block's steps are one 2 x 2 matrix, so a scan over the blocks gives the vector that
    each begins (or ends) with, and the recursions run in all blocks at once. Neutral steps fill the last block up.
    """
    n = len(emission)
    long = max(1, math.isqrt(n))
    blocks = -(-n // long)
    top = emission.max(axis=1)
    like = np.ones((blocks * long, 2))
    like[:n] = np.exp(emission - top[:, None])
    like = like.reshape(blocks, long, 2)
    # each block's product of move and likelihoods; the first one begins without a move
    whole = np.where(np.arange(blocks)[:, None, None] > 0, move, np.eye(2)) * like[:, 0, None, :]
    for t in range(1, long):
        whole = (whole @ move) * like[:, t, None, :]
        whole /= whole.max(axis=(1, 2), keepdims=True)
    a = np.empty((blocks, 2))
    a[0] = start
    for k in range(1, blocks):
        v = a[k - 1] @ whole[k - 1]
        a[k] = v / v.sum()
    ahead, scale = np.empty_like(like), np.empty((blocks, long))
    for t in range(long):
        step = a @ move
        if t == 0:
            step[0] = start
        a = step * like[:, t]
        scale[:, t] = a.sum(axis=1)
        a = a / scale[:, t, None]
        ahead[:, t] = a
    # backwards: what stands before a bin is move times what it weighs and what stands behind it
    weight = like / scale[:, :, None]
    whole = np.broadcast_to(np.eye(2), (blocks, 2, 2))
    for t in range(long - 1, -1, -1):
        whole = move @ (weight[:, t, :, None] * whole)
    v, behind = np.empty((blocks, 2)), np.empty_like(like)
    v[-1] = 1
    for k in range(blocks - 2, -1, -1):
        v[k] = whole[k + 1] @ v[k + 1]
    for t in range(long - 1, -1, -1):
        behind[:, t] = v
        v = (weight[:, t] * v) @ move.T
    ahead, behind, weight, scale = (x.reshape(blocks * long, -1)[:n] for x in (ahead, behind, weight, scale))
    gamma = ahead * behind
    moved = (ahead[:-1].T @ (weight[1:] * behind[1:])) * move
    return gamma / gamma.sum(axis=1, keepdims=True), moved, float(np.log(scale).sum() + top.sum())


def quantile_start(n: np.ndarray) -> tuple[float, float]:
    """Rates to start from: low and high quantiles, kept apart."""
    slow = max(float(np.quantile(n, 0.25)), 0.01)
    return slow, max(float(np.quantile(n, 0.95)), 2 * slow, slow + 0.5)


def two_means(n: np.ndarray, steps: int = 20) -> tuple[float, float]:
    """Rates to start from: means of two clusters of counts, begun a quarter within their range; quantiles if they are no two clusters."""
    low, high = float(n.min()), float(n.max())
    a, b = low + 0.25 * (high - low), low + 0.75 * (high - low)
    for _ in range(steps):
        upper = np.abs(n - b) < np.abs(n - a)
        c, d = float(n[~upper].mean()) if (~upper).any() else a, float(n[upper].mean()) if upper.any() else b
        done, a, b = np.allclose((c, d), (a, b)), c, d
        if done:
            break
    a, b = min(a, b), max(a, b)
    return quantile_start(n) if high <= low or b < 2 * max(a, 1e-3) else (max(a, 1e-3), b)


def fit_counts(n: np.ndarray, step: float, *, max_iter: int = 100, tol: float = 1e-3, min_spikes: int = 50, min_ratio: float = 1.5, start_from: str = "quantile") -> dict:
    """A two-state Poisson chain fitted to one unit's counts; rates are per second, state 1 is the faster one.

    A unit without a fit has a reason: `low_spike_count`, `low_rate_ratio` (with the rates, and what was reached) or `numerical_failure`.
    """
    none = {"skipped": None, "lambda_bg": None, "lambda_burst": None, "iterations": 0, "log_likelihood": None, "p": None}
    if n.sum() < min_spikes or len(n) < 4:
        return none | {"skipped": "low_spike_count"}
    slow, fast = two_means(n) if start_from == "two_means" else quantile_start(n)
    if fast / max(slow, 1e-6) < min_ratio:
        return none | {"skipped": "low_rate_ratio", "lambda_bg": slow / step, "lambda_burst": fast / step}
    factorial = np.array([math.lgamma(k + 1) for k in range(int(n.max()) + 1)])[n.astype(int)]
    rates, move, start, last, done = np.array([slow, fast]), np.array(TRANSITION), np.array(START), -np.inf, 0

    def emission() -> np.ndarray:
        r = np.maximum(rates, 1e-12)
        return n[:, None] * np.log(r) - r - factorial[:, None]

    for done in range(1, max_iter + 1):
        gamma, moved, ll = _smooth_chain(emission(), move, start)
        if not (np.isfinite(ll) and np.isfinite(gamma).all()):
            return none | {"skipped": "numerical_failure", "iterations": done}
        weight, out = gamma.sum(axis=0), moved.sum(axis=1, keepdims=True)
        rates = np.maximum(np.where(weight > 1e-12, (gamma * n[:, None]).sum(axis=0) / np.maximum(weight, 1e-12), rates), 1e-6)  # a state that nothing is in stays as it was
        move = np.where(out > 1e-12, moved / np.maximum(out, 1e-12), move)
        start = gamma[0]
        if abs(ll - last) < tol:
            break
        last = ll
    if rates[0] > rates[1]:
        rates, move, start = rates[::-1], move[::-1, ::-1], start[::-1]
    if rates[1] / step / max(rates[0] / step, 1e-6) < min_ratio:
        return none | {"skipped": "low_rate_ratio", "lambda_bg": rates[0] / step, "lambda_burst": rates[1] / step, "iterations": done, "log_likelihood": ll}
    gamma, _, _ = _smooth_chain(emission(), move, start)
    return {"skipped": None, "lambda_bg": rates[0] / step, "lambda_burst": rates[1] / step, "iterations": done, "log_likelihood": ll, "p": gamma[:, 1]}


def fit_units(counts: DataFrame, grids: DataFrame, scale: float = 1.0, **options) -> DataFrame:
    """A fit for each unit, with posteriors on every bin; skipped units have a reason and null arrays. Units are tasks' groups."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        n_bins, step = int(pdf.n_bins.iloc[0]), float(pdf.step.iloc[0]) * scale
        n = np.zeros(n_bins)
        n[pdf.bin.to_numpy()] = pdf.n.to_numpy()
        fit = fit_counts(n, step, **options)
        p = fit.pop("p")
        return pd.DataFrame([{"well": pdf.well.iloc[0], "unit_id": str(pdf.unit_id.iloc[0]), **fit, "bin": None if p is None else np.arange(n_bins), "p": p}])

    return counts.join(grids.select("well", "step", "n_bins"), "well").groupBy("well", "unit_id").applyInPandas(one, FIT)


def posteriors(fits: DataFrame) -> DataFrame:
    """(well, unit_id, bin, p) of fitted units."""
    return fits.where("skipped IS NULL").select("well", "unit_id", F.explode(F.arrays_zip("bin", "p")).alias("x")).select("well", "unit_id", "x.bin", "x.p")


def llr(n: Column, bg: Column, burst: Column, seconds: Column) -> Column:
    """Two-rate Poisson log-likelihood ratio of a count; null where the burst rate isn't the larger one."""
    b, s = F.greatest(bg, F.lit(1e-9)), F.greatest(burst, F.lit(1e-9))
    return F.when(s > b, 2 * (n * F.log(s / b) - (s - b) * seconds))


def delta_rate(n: Column, bg: Column, seconds: Column) -> Column:
    """(n / seconds - bg) / bg."""
    b = F.greatest(bg, F.lit(1e-6))
    return (n / F.greatest(seconds, F.lit(1e-12)) - b) / b


def entropy(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return -(q * F.log(q) + (1 - q) * F.log(1 - q))


def posterior_aggregates(post: DataFrame, quantile: float = 0.9) -> DataFrame:
    """Five statistics over the fitted units of each bin; NaN counts as missing, a bin without values gets zeros."""
    p = F.nanvl(F.col("p"), F.lit(None))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return post.groupBy("well", "bin").agg(
        zero(F.avg((p > 0.5).cast("double"))).alias("post_frac_gt_0_5"), zero(F.avg(p)).alias("post_mean"), zero(F.stddev_pop(p)).alias("post_std"), zero(F.percentile(p, quantile)).alias("post_q90"), zero(F.avg(entropy(p))).alias("post_entropy")
    )


def unit_statistics(rows: DataFrame, value: str, prefix: str, quantile: float = 0.9) -> DataFrame:
    """Mean, deviation and upper quantile over the units of each bin; NaN counts as missing."""
    x = F.nanvl(F.col(value).cast("double"), F.lit(None))
    return rows.groupBy("well", "bin").agg(F.avg(x).alias(f"{prefix}mean"), F.stddev_pop(x).alias(f"{prefix}std"), F.percentile(x, quantile).alias(f"{prefix}q{round(quantile * 100)}"))


def standardised(rows: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """`rows` with each column less its group's mean over its population deviation, which is 1 where there is none."""
    stats = rows.groupBy(*by).agg(*[F.avg(c).alias(f"_m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns])
    out = rows.join(stats, by)
    scaled = {c: (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") < 1e-12, 1.0).otherwise(F.col(f"_s_{c}")) for c in columns}
    return out.withColumns(scaled).drop(*[f"_{k}_{c}" for k in "ms" for c in columns])


def features(spikes: DataFrame, counts: DataFrame, grids: DataFrame, n_units: DataFrame, fits: DataFrame, scale: float = 1.0, ff_factors: tuple = (0.5, 1.0, 2.0, 5.0), ff_low: float = 0.005, ff_high: float = 0.1, isi_window: int = 25) -> DataFrame:
    """(well, bin, t_low, t_high, t_center, 26 features); quantities that don't exist are 0. unit_id must be a string."""
    seconds = F.col("step") * F.lit(scale)
    base = binning.signals(counts, grids, n_units, scale)
    fitted = fits.where("skipped IS NULL").select("well", "unit_id", "lambda_bg", "lambda_burst")
    n_fit = fitted.groupBy("well").agg(F.count("*").alias("n_fit"))
    dense = fitted.join(grids, "well").select("well", "unit_id", "lambda_bg", "lambda_burst", "step", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_bins") - 1)).alias("bin"))
    rated = dense.join(counts, ["well", "unit_id", "bin"], "left").na.fill(0, ["n"])
    ratio, change = llr(F.col("n"), F.col("lambda_bg"), F.col("lambda_burst"), seconds), delta_rate(F.col("n"), F.col("lambda_bg"), seconds)
    rated = rated.groupBy("well", "bin").agg(F.avg(ratio).alias("llr_hmm_mean"), F.stddev_pop(ratio).alias("llr_hmm_std"), F.percentile(ratio, 0.9).alias("llr_hmm_q90"), F.avg(change).alias("dfr_unit_mean"), F.stddev_pop(change).alias("dfr_unit_std"))
    rated = stored(rated)
    # over all units, those without a value counting as 0
    over_all = lambda df, v, mean, sd=None: df.groupBy("well", "bin").agg(F.sum(v).alias("_s"), F.sum(F.col(v) * F.col(v)).alias("_q")).join(n_units.select("well", "n_units"), "well").select("well", "bin", (F.col("_s") / F.col("n_units")).alias(mean), *([F.sqrt(F.greatest(F.col("_q") / F.col("n_units") - F.pow(F.col("_s") / F.col("n_units"), 2), F.lit(0.0))).alias(sd)] if sd else []))
    inverse = over_all(trains.inverse_intervals(spikes, grids, scale), "rate", "inv_isi_mean", "inv_isi_std")
    uneven = trains.irregularity(spikes, grids, isi_window)
    both = uneven.groupBy("well", "bin").agg(F.sum("cv").alias("_cv"), F.sum("lv").alias("_lv")).join(n_units.select("well", "n_units"), "well").select("well", "bin", (F.col("_cv") / F.col("n_units")).alias("cv_isi_mean"), (F.col("_lv") / F.col("n_units")).alias("lv_mean"))
    parts = [posterior_aggregates(posteriors(fits)), rated, inverse, both]
    parts += [binning.fano(counts, grids, n_units, f, ff_low, ff_high).withColumnRenamed("ff", f"_ff{k}") for k, f in enumerate(ff_factors)]
    every = base.join(n_fit, "well", "left").withColumnRenamed("pfr", "PFR").drop("step", "rate")
    every = every.withColumn("participation", F.col("active") / F.greatest(F.coalesce("n_fit", F.col("n_units")), F.lit(1))).drop("n_fit", "n_units")
    for part in parts:
        every = every.unionByName(part, allowMissingColumns=True)
    # one row of each part for a bin at most: one shuffle puts them together
    out = every.groupBy("well", "bin").agg(*[F.max(c).alias(c) for c in every.columns if c not in ("well", "bin")]).where("t_low IS NOT NULL")
    out = stored(out.na.fill(0.0, [c for c in out.columns if c in FEATURES or c.startswith("_ff")]))
    narrow = out.select("well", "bin", "PFR", "participation", "llr_hmm_mean", *[f"_ff{k}" for k in range(len(ff_factors))])
    for name, value in (("dPFR", "PFR"), ("dParticipation", "participation"), ("dLLR", "llr_hmm_mean")):
        narrow = smoothing.difference(narrow, f"_{name}", value)
    narrow = stored(narrow.drop("PFR", "participation", "llr_hmm_mean"))
    changes = ("dPFR", "dParticipation", "dLLR")
    short = smoothing.gaussian(narrow, {**{f"FF{k}": f"_ff{k}" for k in range(len(ff_factors))}, **{f"{n}_short": f"_{n}" for n in changes}}, 1.5)
    slow = smoothing.gaussian(narrow.select("well", "bin", *[f"_{n}" for n in changes]), {f"{n}_long": f"_{n}" for n in changes}, 8.0)
    out = out.join(short.drop(*narrow.columns[2:]), ["well", "bin"]).join(slow.drop(*[f"_{n}" for n in changes]), ["well", "bin"])
    return out.select("well", "bin", "t_low", "t_high", "t_center", "total", "active", *FEATURES)


def threshold_clusters(rows: DataFrame, value: str = "post_frac_gt_0_5", threshold: float = 0.3) -> DataFrame:
    """The fallback decision: label 1 above the threshold, else -1; the probability is the clipped value."""
    return rows.withColumn("label", F.when(F.col(value) > threshold, 1).otherwise(-1)).withColumn("probability", F.least(F.greatest(F.col(value), F.lit(0.0)), F.lit(1.0)))


def background_normalised(rows: DataFrame, columns: list[str], rank: str, quantile: float = 0.5, by: list[str] | None = None) -> DataFrame:
    """`rows` with z_<column>: mean and deviation are those of rows whose rank is at most the group's quantile."""
    by = by or ["well"]
    cutoff = order.quantile(rows, F.col(rank), quantile, by, "_cut").join(order.quantile(rows, F.col(rank), max(quantile, 0.5), by, "_cut5"), by).join(rows.groupBy(*by).agg(F.count("*").alias("_n")), by)
    few = rows.join(cutoff, by).groupBy(*by).agg(F.count_if(F.col(rank) <= F.col("_cut")).alias("_k"))
    cutoff = cutoff.join(few, by).select(*by, F.when(F.col("_k") < F.greatest(F.lit(2), F.floor(0.05 * F.col("_n"))), F.col("_cut5")).otherwise(F.col("_cut")).alias("_cut"))
    inside = rows.join(cutoff, by).where(F.col(rank) <= F.col("_cut"))
    stats = inside.groupBy(*by).agg(*[F.avg(c).alias(f"_m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns])
    out = rows.join(stats, by)
    for c in columns:
        out = out.withColumn(f"z_{c}", (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") < 1e-6, 1.0).otherwise(F.col(f"_s_{c}")))
    return out.drop(*[f"_m_{c}" for c in columns], *[f"_s_{c}" for c in columns])


def principal_axes(rows: DataFrame, column: str, k: int) -> tuple[DataFrame, list[float]]:
    """`rows` with `axes`, their first k principal components, and the components' shares of the variance. column: arrays of numbers."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    vectors = rows.withColumn("_v", array_to_vector(F.col(column).cast("array<double>")))
    centred = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False).fit(vectors).transform(vectors)
    model = PCA(k=k, inputCol="_c", outputCol="_p").fit(centred)
    return model.transform(centred).withColumn("axes", vector_to_array("_p")).drop("_v", "_c", "_p"), [float(x) for x in model.explainedVariance.toArray()]


def cluster_ranks(rows: DataFrame, label: str, value: str, by: list[str] | None = None) -> DataFrame:
    """(by, label, score, n, position): mean value of each cluster (label >= 0), the largest first, ties by label."""
    by = by or ["well"]
    ranks = rows.where(F.col(label) >= 0).groupBy(*by, label).agg(F.avg(value).alias("score"), F.count("*").alias("n"))
    return ranks.withColumn("position", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), label)))


def burst_clusters(rows: DataFrame, label: str, value: str, mad_scale: float = 3.0, by: list[str] | None = None) -> DataFrame:
    """The top cluster of each group, and those whose score exceeds an adaptive threshold of the lower half."""
    by = by or ["well"]
    ranks = cluster_ranks(rows, label, value, by)
    lower = rows.join(order.quantile(rows, F.col(value), 0.5, by, "_half"), by).where(F.col(value) <= F.col("_half"))
    spread = binning.median_and_mad(lower, value, by)
    top = ranks.where("position = 1").select(*by, F.col("score").alias("top"))
    limit = F.greatest(F.col("baseline") + mad_scale * F.greatest(F.col("mad"), F.lit(1e-6)), F.col("baseline") + 0.25 * (F.col("top") - F.col("baseline")))
    return ranks.join(spread, by).join(top, by).withColumn("limit", limit).where((F.col("position") == 1) | (F.col("score") > F.col("limit"))).select(*by, label, "score", "limit", "position")


def composition(events: DataFrame, bins: DataFrame, by: list[str], width: float) -> DataFrame:
    """Share of each label among the bins with start <= t_center < end: (by, start, end, label, share); 0 for the group's other labels.

    Events and bins meet by blocks of time of `width`.
    """
    blocks = events.select(*by, "start", "end").distinct().withColumn("_b", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))))
    inside = blocks.join(bins.select(*by, "t_center", "label", F.floor(F.col("t_center") / width).alias("_b")), [*by, "_b"]).where("t_center >= start AND t_center < end")
    counts = inside.groupBy(*by, "start", "end", "label").agg(F.count("*").alias("k"))
    total = counts.groupBy(*by, "start", "end").agg(F.sum("k").alias("total"))
    labels = bins.select(*by, "label").distinct()
    return events.select(*by, "start", "end").distinct().join(labels, by).join(counts, [*by, "start", "end", "label"], "left").join(total, [*by, "start", "end"], "left").select(*by, "start", "end", "label", F.coalesce(F.try_divide("k", "total"), F.lit(0.0)).alias("share"))


def _lloyd(x: np.ndarray, k: int, seed: int, starts: int = 10) -> np.ndarray:
    best, best_cost = None, np.inf
    for s in range(starts):
        rng = np.random.default_rng(seed + s)
        centers = [x[rng.integers(len(x))]]
        while len(centers) < k:
            d = np.min([((x - c) ** 2).sum(axis=1) for c in centers], axis=0)
            centers.append(x[rng.choice(len(x), p=d / d.sum())] if d.sum() > 0 else x[rng.integers(len(x))])
        c = np.array(centers)
        for _ in range(100):
            label = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
            fresh = np.array([x[label == j].mean(axis=0) if (label == j).any() else c[j] for j in range(k)])
            if np.allclose(fresh, c):
                break
            c = fresh
        cost = ((x - c[label]) ** 2).sum()
        if cost < best_cost - 1e-12:
            best, best_cost = label, cost
    return best


def _silhouette(x: np.ndarray, label: np.ndarray) -> float:
    names, out = np.unique(label), []
    if len(names) < 2:
        return -1.0
    mean = np.empty((len(x), len(names)))
    for k in range(0, len(x), 256):  # sums of distances to each cluster, some rows at a time
        distance = np.sqrt(np.maximum((x[k : k + 256] ** 2).sum(axis=1)[:, None] + (x**2).sum(axis=1)[None] - 2 * x[k : k + 256] @ x.T, 0.0))
        mean[k : k + 256] = np.array([distance[:, label == c].sum(axis=1) for c in names]).T
    size = np.array([(label == c).sum() for c in names])
    for i, c in enumerate(np.searchsorted(names, label)):
        if size[c] == 1:
            out.append(0.0)
            continue
        a = mean[i, c] / (size[c] - 1)
        b = min(mean[i, j] / size[j] for j in range(len(names)) if j != c)
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def _mixture(x: np.ndarray, k: int, seed: int, steps: int = 100) -> tuple[np.ndarray, float]:
    """Labels and BIC of a mixture of k Gaussians with diagonal covariances."""
    label = _lloyd(x, k, seed, 1)
    n, d = x.shape
    r = np.eye(k)[label]
    last = -np.inf
    for _ in range(steps):
        size = r.sum(axis=0) + 1e-10
        mean = (r.T @ x) / size[:, None]
        var = (r.T @ (x**2)) / size[:, None] - mean**2 + 1e-6
        logp = np.log(size / n) - 0.5 * (np.log(2 * np.pi * var).sum(axis=1) + (((x[:, None] - mean[None]) ** 2) / var[None]).sum(axis=2))
        total = np.logaddexp.reduce(logp, axis=1)
        r = np.exp(logp - total[:, None])
        if abs(total.sum() - last) < 1e-6:
            break
        last = total.sum()
    return r.argmax(axis=1), -2 * float(total.sum()) + (k * 2 * d + k - 1) * math.log(n)


def burst_types(events: DataFrame, columns: list[str], *, method: str = "kmeans", max_k: int = 6, k: int = 0, min_bursts: int = 8, seed: int = 42, by: list[str] | None = None) -> DataFrame:
    """`events` keys with burst_type, k, score and decision: typed by k-means and silhouette, or a mixture and BIC.

    Columns are standardised over the group. Fewer than min_bursts events, or no variation, give type 0 or null with the reason.
    A group is a well's events, of which there are tens to hundreds.
    """
    by = by or ["well"]
    kinds = ", ".join(f"{c} {events.schema[c].dataType.simpleString()}" for c in [*by, "start", "end"])

    def typed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["start", "end"])
        out = pdf[[*by, "start", "end"]].assign(burst_type=None, k=0, score=None, decision="too_few_bursts")
        if len(pdf) >= min_bursts:
            x = np.nan_to_num(pdf[columns].to_numpy(float))
            sd = x.std(axis=0)
            x = (x - x.mean(axis=0)) / np.where(sd < 1e-12, 1.0, sd)
            if len(np.unique(x.round(9), axis=0)) < 2:
                return out.assign(burst_type=0, k=1, decision="degenerate")
            tries = []
            for n in [k] if k else range(2, min(max_k, len(pdf) - 1, len(np.unique(x.round(9), axis=0))) + 1):
                label, score = (lambda v: (v, _silhouette(x, v)))(_lloyd(x, n, seed)) if method == "kmeans" else (lambda v: (v[0], -v[1]))(_mixture(x, n, seed))
                tries.append((score, -n, label))
            if not tries:
                return out.assign(burst_type=0, k=1, decision="degenerate")
            score, n, label = max(tries, key=lambda v: v[:2])
            out = out.assign(burst_type=label.astype("int64"), k=-n, score=score if method == "kmeans" else -score, decision=method)
        return out.astype({"burst_type": "Int64"})

    return events.select(*by, "start", "end", *columns).groupBy(*by).applyInPandas(typed, f"{kinds}, burst_type long, k int, score double, decision string")


