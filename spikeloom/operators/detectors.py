"""Network-burst detectors as compositions of the other operators.

`population_bursts` thresholds smoothed participation, grows bursts around peaks and merges them twice; `model_bursts` scores
bins by per-unit hidden Markov fits, clusters them by density, closes and merges the mask of the burst clusters, gates and types the events.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikeloom.functions.lineage import stored

from . import binning, density, intervals, models, smoothing
from . import spikes as trains

VALUES = ["duration", "synchrony_energy", "participation", "total_spikes", "burst_peak", "peak_synchrony"]


class _Extremes:
    """Largest (or smallest) values of all stretches of a series whose length is a power of two."""

    def __init__(self, x: np.ndarray, pick=np.maximum):
        self.pick, self.levels = pick, [x]
        while 2 << (len(self.levels) - 1) <= len(x):
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(pick(last[:-half], last[half:]))

    def over(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The extremes of x[low:high], none empty."""
        level = np.frexp((high - low).astype(float))[1] - 1
        out = np.empty(len(low))
        for k in np.unique(level):
            at = level == k
            out[at] = self.pick(self.levels[k][low[at]], self.levels[k][high[at] - (1 << k)])
        return out

    def run(self, start: np.ndarray, limit: np.ndarray, step: int) -> np.ndarray:
        """How many places from `start` on, upwards or downwards, have no value beyond `limit`."""
        n, at = len(self.levels[0]), start.copy()
        for k in reversed(range(len(self.levels))):
            size = 1 << k
            for _ in range(2 if k == len(self.levels) - 1 else 1):
                first = at if step > 0 else at - size + 1
                inside = np.flatnonzero((first >= 0) & (first + size <= n))
                value = self.levels[k][first[inside]]
                fits = inside[value <= limit[inside] if self.pick is np.maximum else value >= limit[inside]]
                at[fits] += step * size
        return (at - start) * step


def find_peaks(x: np.ndarray, height: float, prominence: float) -> list[int]:
    """Strict local maxima (the middle of flat tops) that reach a height and a prominence; the ends aren't peaks.

    The next higher places on both sides and the lowest ones before them are looked up for all maxima at once, in n log n steps.
    """
    change = np.flatnonzero(np.diff(x)) + 1
    begin = np.concatenate([[0], change])
    end = np.concatenate([change, [len(x)]]) - 1
    level = x[begin]
    top = np.zeros(len(level), bool)
    top[1:-1] = (level[1:-1] > level[:-2]) & (level[1:-1] > level[2:]) & (level[1:-1] >= height)
    at = np.flatnonzero(top)
    if not len(at):
        return []
    high, low = _Extremes(level), _Extremes(level, np.minimum)
    left, right = high.run(at - 1, level[at], -1), high.run(at + 1, level[at], 1)
    base = np.maximum(low.over(at - left, at), low.over(at + 1, at + 1 + right))
    return ((begin[at] + end[at]) // 2)[level[at] - base >= prominence].tolist()


def peaks(signal: DataFrame, limits: DataFrame, value: str, extent_frac: float = 0.30) -> DataFrame:
    """(well, peak, start_idx, end_idx): peaks of a well's series and the runs around them that stay above the larger of the threshold
    and extent_frac of the peak. limits: (well, threshold, mad)."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        x, threshold, mad = pdf[value].to_numpy(float), float(pdf.threshold.iloc[0]), float(pdf.mad.iloc[0])
        found = np.array(find_peaks(x, threshold, max(0.5 * mad, 0.02)), np.int64)
        if not len(found):
            return pd.DataFrame(columns=["well", "peak", "start_idx", "end_idx"])
        lowest, limit = _Extremes(x, np.minimum), np.maximum(threshold, extent_frac * x[found])
        return pd.DataFrame({"well": pdf.well.iloc[0], "peak": found, "start_idx": found - lowest.run(found - 1, limit, -1), "end_idx": found + lowest.run(found + 1, limit, 1)})

    return signal.select("well", "bin", value).join(limits.select("well", "threshold", "mad"), "well").groupBy("well").applyInPandas(one, "well string, peak long, start_idx long, end_idx long")


def _over(events: DataFrame, signal: DataFrame, aggregates: list[Column]) -> DataFrame:
    """Aggregates of the bins start_idx..end_idx of each event."""
    keys = ["well", "start_idx", "end_idx"]
    bins = events.select(*keys).distinct().withColumn("bin", F.explode(F.sequence("start_idx", "end_idx")))
    return events.join(bins.join(signal, ["well", "bin"]).groupBy(*keys).agg(*aggregates), keys)


def population_signals(spikes: DataFrame, calibration: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(grid, n_units, smoothed signals) at each well's adaptive bin size."""
    grids = calibration.select("well", F.col("rec_start").alias("start"), F.col("bin_size").alias("step"), F.ceil((F.col("rec_end") - F.col("rec_start")) / F.col("bin_size")).cast("long").alias("n_bins")).where("n_bins > 0")
    n_units = calibration.select("well", "n_units")
    raw = binning.signals(binning.unit_bins(spikes, grids), grids, n_units).join(calibration.select("well", "sigma_fast", "sigma_slow"), "well")
    fast = smoothing.gaussian(raw, {"ws_sharp": "participation"}, F.col("sigma_fast"))
    return grids, n_units, smoothing.gaussian(fast, {"ws_slow": "participation", "ws_rate": "rate"}, F.col("sigma_slow"))


def population_bursts(spikes: DataFrame, extent_frac: float = 0.30, gap_min: float = 0.75, min_network: float = 0.0, min_super: float = 0.0) -> dict[str, DataFrame]:
    """burstlets, network_bursts, superbursts and metrics of each well; spikes(well, unit_id, t in seconds). Merged events shorter than min_network or
    min_super seconds are left out; superbursts are made from the network bursts that stay."""
    cal = stored(trains.calibration(spikes, gap_min=gap_min))
    grids, n_units, signal = population_signals(spikes, cal)
    signal = stored(signal)  # every later step reads it
    limits = stored(binning.thresholds(signal, "ws_sharp", n_units))
    found = stored(peaks(signal, limits, "ws_sharp", extent_frac))
    at = signal.select("well", F.col("bin").alias("peak"), F.col("ws_sharp").alias("peak_synchrony"), F.col("t_center").alias("peak_time"))
    edges = grids.select("well", F.col("start").alias("rec_start"), "step")
    burstlets = (
        _over(found, signal, [F.sum("ws_rate").alias("_e"), F.sum("total").alias("total_spikes"), F.max("pfr").alias("burst_peak")])
        .join(at, ["well", "peak"])
        .join(edges, "well")
        .withColumn("start", F.col("rec_start") + F.col("start_idx") * F.col("step"))
        .withColumn("end", F.col("rec_start") + (F.col("end_idx") + 1) * F.col("step"))
        .withColumn("synchrony_energy", F.col("_e") * F.col("step"))
        .withColumn("duration", F.col("end") - F.col("start"))
        .withColumn("fragment_count", F.lit(1).cast("long"))
        .drop("_e", "rec_start", "step")
    )
    constants = cal.select("well", "bin_size", "burstlet_gap", "network_gap").join(limits.select("well", "baseline", "threshold"), "well")

    def level(events: DataFrame) -> DataFrame:
        active = intervals.participants(events, spikes, ["well"], 1.0)
        return events.join(active, ["well", "start", "end"]).join(n_units, "well").withColumn("participation", F.col("n_active") / F.col("n_units")).drop("n_active", "n_units")

    def merged(events: DataFrame, gap: str, least: float, accept: Column) -> DataFrame:
        gated = intervals.merge(events.join(constants, "well"), signal, "ws_sharp", ["well"], gap=F.col(gap), step=F.col("bin_size"), accept=accept)
        return level(stored(intervals.roll_up(gated, ["well"]).drop("merged").where(F.col("duration") >= least)))

    burstlets = stored(level(stored(burstlets)))
    network = stored(merged(burstlets, "burstlet_gap", min_network, F.col("valley") >= F.col("threshold")))
    superb = merged(network, "network_gap", min_super, (F.col("valley") > F.col("baseline")) & (F.col("valley") < F.col("threshold"))).where("n_sub_events >= 2")
    superb = stored(superb)
    total = cal.select("well", (F.col("rec_end") - F.col("rec_start")).alias("total_duration"))
    metrics = None
    for name, events in (("burstlets", burstlets), ("network_bursts", network), ("superbursts", superb)):
        own = intervals.level_metrics(events, total, VALUES, ["well"]).withColumn("level", F.lit(name))
        metrics = own if metrics is None else metrics.unionByName(own)
    return {"burstlets": burstlets, "network_bursts": network, "superbursts": superb, "metrics": metrics, "signals": signal, "limits": limits.join(cal.drop("n_units"), "well")}


RANK = "post_frac_gt_0_5"


def cluster_bins(bins: DataFrame, *, clustering: str = "density", min_cluster_size: int = 30, min_samples: int = 5, axes: int = 0, background: float = 0.5, mad_scale: float = 3.0, threshold: float = 0.3) -> DataFrame:
    """`bins` with label, probability, decision and `on`: whether the bin belongs to a burst cluster of its well.

    Features are normalised on background bins, optionally reduced to principal axes, and clustered by density. Burst clusters are
    those that rank high by RANK. A well whose bins are all noise, or any with clustering "threshold", is labelled by a threshold on RANK.
    """
    if clustering == "threshold":
        return models.threshold_clusters(bins, RANK, threshold).withColumn("decision", F.lit("threshold")).withColumn("on", F.col("label") == 1)
    scaled = models.background_normalised(bins, models.FEATURES, RANK, background)
    rows = scaled.select("well", F.col("bin").alias("id"), F.array(*[f"z_{c}" for c in models.FEATURES]).alias("x"))
    if axes:
        rows = density.principal_axes(rows, ["well"], axes)[0].select("well", "id", F.col("axes").alias("x"))
    found = density.clusters(stored(rows), ["well"], min_cluster_size, min_samples).withColumnRenamed("id", "bin")
    labelled = stored(bins.join(found, ["well", "bin"]))
    n = labelled.where("label >= 0").groupBy("well").agg(F.countDistinct("label").alias("_clusters"))
    burst = models.burst_clusters(labelled, "label", RANK, mad_scale).select("well", "label", F.lit(True).alias("_burst"))
    known = labelled.join(n, "well", "left").join(burst, ["well", "label"], "left")
    noise, high = F.col("_clusters").isNull(), F.col(RANK) > threshold
    return known.withColumns(
        {
            "label": F.when(~noise, F.col("label")).when(high, 1).otherwise(-1),
            "probability": F.when(~noise, F.col("probability")).otherwise(F.least(F.greatest(F.col(RANK), F.lit(0.0)), F.lit(1.0))),
            "decision": F.when(noise, "all_noise").when(F.col("_clusters") == 1, "density_single").otherwise("density"),
            "on": F.when(noise, high).otherwise(F.col("_burst").isNotNull()),
        }
    ).drop("_clusters", "_burst")


def model_bursts(spikes: DataFrame, *, min_modulation: float = 0.1, closing_bins: int = 3, mad_scale: float = 0.75, floor_frac: float = 0.70, gap_min: float = 0.75, typing: str = "kmeans", fit_options: dict | None = None, **clustering) -> dict[str, DataFrame]:
    """network_bursts (typed), features, fits and metrics of each well; `clustering` are options of `cluster_bins`."""
    spikes = spikes.withColumn("unit_id", F.col("unit_id").cast("string"))
    cal = stored(trains.calibration(spikes, gap_min=gap_min))
    grids = cal.select("well", F.col("rec_start").alias("start"), F.col("bin_size").alias("step"), F.ceil((F.col("rec_end") - F.col("rec_start")) / F.col("bin_size")).cast("long").alias("n_bins")).where("n_bins >= 8")
    n_units = cal.select("well", "n_units")
    counts = stored(binning.unit_bins(spikes, grids))
    fits = stored(models.fit_units(counts, grids, **(fit_options or {})))
    bins = stored(cluster_bins(stored(models.features(spikes, counts, grids, n_units, fits)), **clustering))
    masked = stored(intervals.closing(bins, "on", ["well"], closing_bins))
    runs = stored(intervals.islands(masked, "closed", ["well"]))
    spread = binning.median_and_mad(masked.where("NOT closed"), "post_frac_gt_0_5").withColumn("threshold", F.col("baseline") + mad_scale * F.greatest(F.col("mad"), F.lit(1e-6)))
    edges = grids.select("well", F.col("start").alias("rec_start"), F.col("step").alias("bin_size")).join(cal.select("well", "network_gap"), "well").join(spread, "well", "left")
    runs = runs.join(edges, "well").withColumn("start", F.col("rec_start") + F.col("start_idx") * F.col("bin_size")).withColumn("end", F.col("rec_start") + (F.col("end_idx") + 1) * F.col("bin_size"))
    gated = intervals.merge(runs, masked, "post_frac_gt_0_5", ["well"], gap=F.col("network_gap"), step=F.col("bin_size"), accept=F.col("valley") >= floor_frac * F.coalesce(F.col("threshold"), F.lit(0.0)))
    events = stored(gated).groupBy("well", "merged", "bin_size").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("start_idx").alias("start_idx"), F.max("end_idx").alias("end_idx"), F.count("*").alias("fragment_count"))
    top = F.struct("post_frac_gt_0_5", -F.col("bin"))
    events = _over(
        events,
        masked,
        [
            F.sum("total").alias("total_spikes"), F.max("PFR").alias("burst_peak"), F.avg("PFR").alias("within_burst_fr"), F.max("post_frac_gt_0_5").alias("peak_synchrony"), F.max_by("t_center", top).alias("peak_time"), F.sum("post_frac_gt_0_5").alias("_e"),
            F.max("llr_hmm_mean").alias("llr_aggregate"), F.max("post_mean").alias("posterior_peak"), F.avg("post_mean").alias("posterior_mean"), F.max("FF1").alias("ff_peak"), F.array_sort(F.collect_set("label")).alias("cluster_ids"), F.countDistinct("label").alias("n_distinct_clusters"),
        ],
    )
    events = stored(events)
    active = intervals.participants(events, spikes, ["well"], 1.0)
    events = events.join(active, ["well", "start", "end"]).join(n_units, "well").withColumn("participation", F.col("n_active") / F.col("n_units")).withColumn("synchrony_energy", F.col("_e") * F.col("bin_size")).withColumn("duration", F.col("end") - F.col("start")).drop("_e", "n_active", "n_units", "merged")
    if min_modulation > 0:
        events = events.where(F.col("llr_aggregate") >= min_modulation)
    events = stored(events)
    types = models.burst_types(events, ["duration", "within_burst_fr", "participation", "llr_aggregate", "posterior_peak", "posterior_mean", "ff_peak", "n_distinct_clusters"], method=typing)
    total = cal.select("well", (F.col("rec_end") - F.col("rec_start")).alias("total_duration"))
    return {"network_bursts": events.join(types.withColumnRenamed("decision", "typing_decision"), ["well", "start", "end"], "left"), "features": bins, "fits": fits, "metrics": intervals.level_metrics(events, total, VALUES, ["well"])}
