"""Spike-train and population-signal queries over events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from spikeloom.functions.lineage import stored
from spikeloom.operators import binning, detectors, intervals, models, smoothing
from spikeloom.operators import spikes as trains

from .common import HOUR, SECONDS, grid_chain, signal_chain, smooth_sql, spikes, with_sql, SPIKES_SQL, EXTENT_SQL, COUNTS_SQL, SPINE_SQL

QUERIES, ORACLES = {}, {}


def register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _grid(s, step=HOUR):
    return binning.grid(trains.extents(s), F.lit(step).cast("long"))


def _signals(spark, d):
    s = spikes(spark, d)
    e, g = trains.extents(s), _grid(s)
    return s, e, g, binning.signals(binning.unit_bins(s, g), g, e, SECONDS)


@register(with_sql(SPIKES_SQL, EXTENT_SQL) + "SELECT * FROM ext")
def recording_extents(spark, d):
    return trains.extents(spikes(spark, d))


@register(with_sql(*grid_chain(), COUNTS_SQL) + "SELECT * FROM ub")
def spike_bin_counts(spark, d):
    s = spikes(spark, d)
    return binning.unit_bins(s, _grid(s)).select("well", "unit_id", "bin", "n")


@register(with_sql(*signal_chain()) + "SELECT well, bin, total, active, round(pfr, 9) AS pfr, round(rate, 12) AS rate FROM sig")
def population_rate(spark, d):
    return _signals(spark, d)[3].select("well", "bin", "total", "active", F.round("pfr", 9).alias("pfr"), F.round("rate", 12).alias("rate"))


@register(with_sql(*signal_chain()) + "SELECT well, bin, round(participation, 9) AS participation FROM sig")
def participation_signal(spark, d):
    return _signals(spark, d)[3].select("well", "bin", F.round("participation", 9).alias("participation"))


_ISI = "isi AS (SELECT well, unit_id, t, t - lag(t) OVER (PARTITION BY well, unit_id ORDER BY t) AS isi FROM (SELECT DISTINCT well, unit_id, t FROM spk) QUALIFY isi > 0)"


@register(with_sql(SPIKES_SQL, _ISI) + "SELECT well, unit_id, count(*) AS n, round(avg(isi * 1e-6), 4) AS mean_s, round(stddev_pop(isi * 1e-6), 3) AS std_s, CASE WHEN abs(avg(isi)) > 1e-6 THEN round(stddev_pop(isi) / avg(isi), 6) END AS cv FROM isi GROUP BY ALL")
def isi_stats(spark, d):
    i = trains.intervals(spikes(spark, d)).withColumn("s", F.col("isi") * SECONDS)
    cv = F.when(F.abs(F.avg("isi")) > 1e-6, F.round(F.stddev_pop("isi") / F.avg("isi"), 6))
    return i.groupBy("well", "unit_id").agg(F.count("*").alias("n"), F.round(F.avg("s"), 4).alias("mean_s"), F.round(F.stddev_pop("s"), 3).alias("std_s"), cv.alias("cv"))


@register(with_sql(SPIKES_SQL, _ISI) + "SELECT well, round(quantile_cont(log10(isi * 1e-6), 0.5), 9) AS median_log_isi FROM isi GROUP BY well")
def log_isi_median(spark, d):
    return trains.median_log_interval(spikes(spark, d), SECONDS).select("well", F.round(F.log10("isi"), 9).alias("median_log_isi"))


@register(
    with_sql(SPIKES_SQL, EXTENT_SQL, _ISI, "c AS (SELECT well, 10 ** quantile_cont(log10(isi * 1e-6), 0.5) AS isi FROM isi GROUP BY well)")
    + """SELECT well, round(coalesce(isi, 0.1), 4) AS isi, round(least(greatest(coalesce(isi, 0.1), 0.01), 0.03), 9) AS bin_size,
 round(least(greatest(coalesce(isi, 0.1) / least(greatest(coalesce(isi, 0.1), 0.01), 0.03), 1), 2), 6) AS sigma_fast,
 round(least(greatest(5 * coalesce(isi, 0.1) / least(greatest(coalesce(isi, 0.1), 0.01), 0.03), 3), 8), 6) AS sigma_slow,
 round(3 * coalesce(isi, 0.1), 3) AS burstlet_gap, round(greatest(10 * coalesce(isi, 0.1), 0.75), 3) AS network_gap FROM ext LEFT JOIN c USING (well)"""
)
def adaptive_bin_size(spark, d):
    c = trains.calibration(spikes(spark, d), scale=SECONDS)
    digits = {"isi": 4, "bin_size": 9, "sigma_fast": 6, "sigma_slow": 6, "burstlet_gap": 3, "network_gap": 3}
    return c.select("well", *[F.round(k, v).alias(k) for k, v in digits.items()])


_LOWER = "CAST(least(greatest(ceil(({t} - start) / CAST(step AS DOUBLE)) - 1, 0), n_bins - 1) AS BIGINT)"


@register(
    with_sql(*grid_chain(), "p AS (SELECT well, unit_id, t, lag(t) OVER (PARTITION BY well, unit_id ORDER BY t) AS b FROM spk QUALIFY b IS NOT NULL)")
    + f"SELECT well, unit_id, {_LOWER.format(t='((t + b) / 2.0)')} AS bin, round(avg(1 / greatest((t - b) * 1e-6, 1e-6)), 6) AS rate FROM p JOIN grid USING (well) GROUP BY ALL"
)
def inverse_isi(spark, d):
    s = spikes(spark, d)
    return trains.inverse_intervals(s, _grid(s), SECONDS).withColumn("rate", F.round("rate", 6))


_UNEVEN = with_sql(
    *grid_chain(6 * HOUR),
    "i AS (SELECT well, unit_id, t, CAST(t - lag(t) OVER w AS DOUBLE) AS isi, count(*) OVER (PARTITION BY well, unit_id) AS c FROM spk WINDOW w AS (PARTITION BY well, unit_id ORDER BY t))",
    "j AS (SELECT *, lag(isi) OVER (PARTITION BY well, unit_id ORDER BY t) AS l FROM i)",
    f"s AS (SELECT well, unit_id, {_LOWER.format(t='t')} AS bin, count(*) AS n, sum(isi) AS s, sum(isi * isi) AS q, count(l) AS m, sum(3 * (l - isi) ** 2 / greatest((l + isi) ** 2, 1e-12)) AS v FROM j JOIN grid USING (well) WHERE c >= 3 AND isi IS NOT NULL GROUP BY ALL)",
    "u AS (SELECT DISTINCT well, unit_id FROM spk)",
    "b AS (SELECT u.well, u.unit_id, unnest(range(0, n_bins)) AS bin FROM u JOIN grid USING (well))",
    "f AS (SELECT b.well, b.unit_id, b.bin, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(q) OVER w AS q, sum(m) OVER w AS m, sum(v) OVER w AS v FROM b LEFT JOIN s USING (well, unit_id, bin) WINDOW w AS (PARTITION BY b.well, b.unit_id ORDER BY b.bin RANGE BETWEEN 12 PRECEDING AND 12 FOLLOWING))",
)


@register(_UNEVEN + "SELECT well, unit_id, bin, round(CASE WHEN coalesce(n, 0) >= 2 AND s / n > 1e-9 THEN sqrt(greatest(q / n - (s / n) ** 2, 0)) / (s / n) ELSE 0 END, 4) AS cv FROM f WHERE n > 0")
def sliding_cv_isi(spark, d):
    s = spikes(spark, d)
    return trains.irregularity(s, _grid(s, 6 * HOUR)).select("well", "unit_id", "bin", F.round("cv", 4).alias("cv"))


@register(_UNEVEN + "SELECT well, unit_id, bin, round(CASE WHEN coalesce(m, 0) > 0 THEN v / m ELSE 0 END, 5) AS lv FROM f WHERE n > 0")
def sliding_lv(spark, d):
    s = spikes(spark, d)
    return trains.irregularity(s, _grid(s, 6 * HOUR)).select("well", "unit_id", "bin", F.round("lv", 5).alias("lv"))


@register(with_sql(*signal_chain()) + "SELECT well, bin, round(pfr - coalesce(lag(pfr) OVER (PARTITION BY well ORDER BY bin), pfr), 9) AS change FROM sig")
def rate_derivative(spark, d):
    return smoothing.difference(_signals(spark, d)[3], "change", "pfr").select("well", "bin", F.round("change", 9).alias("change"))


@register(with_sql(*signal_chain(), smooth_sql("sig", "participation", 2.0, "g")) + "SELECT well, bin, round(participation_s, 8) AS smooth FROM g")
def gaussian_rate(spark, d):
    return smoothing.gaussian(_signals(spark, d)[3], {"smooth": "participation"}, 2.0).select("well", "bin", F.round("smooth", 8).alias("smooth"))


_FANO = (
    with_sql(*grid_chain(), COUNTS_SQL, SPINE_SQL)
    + """, c AS (SELECT well, unit_id, CAST(least(floor((bin + 0.5) * step / (4.0 * step)), ceil(n_bins * step / (4.0 * step)) - 1) AS BIGINT) AS coarse, sum(n) AS n FROM ub JOIN grid USING (well) GROUP BY ALL),
m AS (SELECT well, coarse, sum(n) / CAST(any_value(n_units) AS DOUBLE) AS mean, sum(n * n) / CAST(any_value(n_units) AS DOUBLE) AS sq FROM c JOIN grid USING (well) GROUP BY well, coarse)
SELECT s.well, s.bin, round(coalesce(CASE WHEN mean > 1e-9 THEN (sq - mean * mean) / mean ELSE 0 END, 0), 6) AS ff FROM spine s LEFT JOIN m ON m.well = s.well AND m.coarse = CAST(least(floor((bin + 0.5) * step / (4.0 * step)), ceil(n_bins * step / (4.0 * step)) - 1) AS BIGINT)"""
)


@register(_FANO.replace("\n, c AS", ",\nc AS"))
def fano_multiscale(spark, d):
    s = spikes(spark, d)
    e, g = trains.extents(s), _grid(s)
    return binning.fano(binning.unit_bins(s, g), g, e, 4.0, HOUR, 24 * HOUR).select("well", "bin", F.round("ff", 6).alias("ff"))


_LIMITS = [*signal_chain(), "b AS (SELECT well, any_value(n_units) AS n_units, quantile_cont(participation, 0.5) AS baseline FROM sig GROUP BY well)", "l AS (SELECT b.well, any_value(b.baseline) AS baseline, any_value(b.n_units) AS n_units, quantile_cont(abs(participation - baseline), 0.5) AS mad FROM sig JOIN b USING (well) GROUP BY b.well)"]
_FLOOR = "(CASE WHEN n_units < 50 THEN greatest(5.0, 0.15 * n_units) ELSE greatest(10.0, 0.05 * n_units) END / greatest(n_units, 1))"
_MASK = [*_LIMITS, "m AS (SELECT sig.*, participation > baseline + 0.75 * mad + 1e-9 AS hot FROM sig JOIN l USING (well))"]


@register(with_sql(*_LIMITS) + f"SELECT well, round(baseline, 9) AS baseline, round(mad, 9) AS mad, round(greatest({_FLOOR}, baseline + 0.75 * mad), 9) AS threshold FROM l")
def baseline_mad(spark, d):
    _, e, _, sig = _signals(spark, d)
    return binning.thresholds(stored(sig), "participation", e).select("well", *[F.round(c, 9).alias(c) for c in ("baseline", "mad", "threshold")])


def _mask(spark, d):
    """Bins above baseline and spread; without the floor, which chance firing rarely reaches. The signals are stored, as all that follows reads them."""
    _, _, g, sig = _signals(spark, d)
    sig = stored(sig)
    limits = stored(binning.median_and_mad(sig, "participation"))
    return g, sig.join(F.broadcast(limits), "well").withColumn("hot", F.col("participation") > F.col("baseline") + 0.75 * F.col("mad") + 1e-9)


@register(with_sql(*_MASK) + "SELECT well, bin, hot FROM m")
def burst_mask(spark, d):
    return _mask(spark, d)[1].select("well", "bin", "hot")


_ISLANDS = "isl AS (SELECT well, min(bin) AS start_idx, max(bin) AS end_idx, count(*) AS n, sum(total) AS total_spikes, max(participation) AS peak FROM (SELECT *, bin - row_number() OVER (PARTITION BY well ORDER BY bin) AS run FROM m WHERE hot) GROUP BY well, run)"


@register(with_sql(*_MASK, _ISLANDS) + "SELECT well, start_idx, end_idx, n, CAST(total_spikes AS BIGINT) AS total_spikes, round(peak, 9) AS peak FROM isl")
def burst_islands(spark, d):
    _, m = _mask(spark, d)
    runs = intervals.islands(m, "hot", ["well"])
    return detectors._over(runs, m, [F.sum("total").alias("total_spikes"), F.round(F.max("participation"), 9).alias("peak")])


_CLOSE = "c AS (SELECT well, bin, hot, sum(grown) OVER (PARTITION BY well ORDER BY bin ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) = 3 AS closed FROM (SELECT *, max(CAST(hot AS INT)) OVER (PARTITION BY well ORDER BY bin ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS grown FROM m))"


@register(with_sql(*_MASK, _CLOSE) + "SELECT well, bin, hot, closed FROM c")
def morph_closing(spark, d):
    return intervals.closing(_mask(spark, d)[1], "hot", ["well"], 3).select("well", "bin", "hot", "closed")


def _events(spark, d):
    """Islands as intervals in microseconds."""
    g, m = _mask(spark, d)
    runs = intervals.islands(m, "hot", ["well"]).join(g, "well")
    return g, m, stored(runs.select("well", "start_idx", "end_idx", (F.col("start") + F.col("start_idx") * F.col("step")).alias("start"), (F.col("start") + (F.col("end_idx") + 1) * F.col("step")).alias("end")))


_EVENTS = [*_MASK, _ISLANDS, "ev AS (SELECT isl.well, start_idx, end_idx, start + start_idx * step AS s, start + (end_idx + 1) * step AS e FROM isl JOIN grid USING (well))"]
_VALLEY = [
    *_EVENTS,
    "v AS (SELECT well, s, e, lag(e) OVER (PARTITION BY well ORDER BY s) AS pe FROM ev)",
    "w AS (SELECT v.well, v.s, min(m.participation) AS valley FROM v JOIN m ON m.well = v.well AND m.start + m.bin * m.step + m.step / 2.0 BETWEEN v.pe AND v.s GROUP BY v.well, v.s)",
]


@register(with_sql(*_VALLEY) + 'SELECT v.well, v.s AS start, v.e AS "end", v.pe AS prev_end, round(valley, 9) AS valley FROM v LEFT JOIN w USING (well, s)')
def event_valleys(spark, d):
    _, m, ev = _events(spark, d)
    return intervals.valleys(ev, m, "participation", ["well"]).select("well", "start", "end", "prev_end", F.round("valley", 9).alias("valley"))


_MERGED = [*_VALLEY, f"f AS (SELECT v.*, sum(CASE WHEN pe IS NULL OR s - pe > {4 * HOUR} OR NOT coalesce(valley >= 0.05, s - pe <= {HOUR}) THEN 1 ELSE 0 END) OVER (PARTITION BY well ORDER BY s) AS merged FROM v LEFT JOIN w USING (well, s))"]


def _merged(spark, d):
    g, m, ev = _events(spark, d)
    return g, m, stored(intervals.merge(ev, m, "participation", ["well"], gap=F.lit(4 * HOUR), step=F.lit(HOUR), accept=F.col("valley") >= 0.05))


@register(with_sql(*_MERGED) + 'SELECT well, CAST(merged AS BIGINT) AS merged, min(s) AS start, max(e) AS "end", count(*) AS n_sub_events FROM f GROUP BY well, merged')
def valley_merge(spark, d):
    return _merged(spark, d)[2].groupBy("well", "merged").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_sub_events"))


@register(
    with_sql(*_MERGED, "r AS (SELECT well, merged, min(s) AS s, max(e) AS e, count(*) AS k FROM f GROUP BY ALL)")
    + """SELECT r.well, r.s AS start, r.e AS "end", any_value(r.k) AS n_sub_events, CAST(sum(m.total) AS BIGINT) AS total_spikes, round(max(m.participation), 9) AS peak_synchrony,
 CAST(arg_max(m.bin, m.participation * 1e6 - m.bin / 1e4) AS BIGINT) AS peak_bin, round(sum(m.rate) * 3600, 6) AS energy FROM r JOIN m ON m.well = r.well AND m.start + m.bin * m.step >= r.s AND m.start + m.bin * m.step < r.e GROUP BY r.well, r.s, r.e"""
)
def event_rollup(spark, d):
    g, m, f = _merged(spark, d)
    r = f.groupBy("well", "merged").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("start_idx").alias("start_idx"), F.max("end_idx").alias("end_idx"), F.count("*").alias("n_sub_events"))
    top = F.max_by("bin", F.struct(F.col("participation"), -F.col("bin")))
    out = detectors._over(r, m, [F.sum("total").alias("total_spikes"), F.round(F.max("participation"), 9).alias("peak_synchrony"), top.alias("peak_bin"), F.round(F.sum("rate") * 3600, 6).alias("energy")])
    return out.select("well", "start", "end", "n_sub_events", "total_spikes", "peak_synchrony", "peak_bin", "energy")


_PARTS = [
    *_MERGED,
    "x AS (SELECT f.well, f.merged, f.s, f.e, sum(m.total) AS total, max(m.participation) AS peak, arg_max(m.start + m.bin * m.step, m.participation * 1e6 - m.bin / 1e4) AS pt, sum(m.rate) AS energy, max(m.pfr) AS burst_peak FROM f JOIN m ON m.well = f.well AND m.start + m.bin * m.step >= f.s AND m.start + m.bin * m.step < f.e GROUP BY ALL)",
]


@register(
    with_sql(*_PARTS)
    + """SELECT well, min(s) AS start, max(e) AS "end", max(e) - min(s) AS duration, round(max(peak), 9) AS peak_synchrony, arg_max(pt, peak * 1e12 - s / 1e9) AS peak_time, round(sum(energy), 6) AS synchrony_energy,
 CAST(count(*) AS BIGINT) AS fragment_count, CAST(sum(total) AS BIGINT) AS total_spikes, round(max(burst_peak), 6) AS burst_peak, count(*) AS n_sub_events FROM x GROUP BY well, merged"""
)
def rolled_events(spark, d):
    """Merged events from the events that they are made of."""
    g, m, f = _merged(spark, d)
    top = F.max_by((F.col("start") + F.col("bin") * F.col("step")), F.struct(F.col("participation"), -F.col("bin")))
    own = detectors._over(f, m.select("well", "bin", "total", "participation", "rate", "pfr").join(g, "well"), [F.sum("total").alias("total_spikes"), F.max("participation").alias("peak_synchrony"), top.alias("peak_time"), F.sum("rate").alias("synchrony_energy"), F.max("pfr").alias("burst_peak")])
    out = intervals.roll_up(own.withColumn("fragment_count", F.lit(1).cast("long")), ["well"]).drop("merged")
    return out.withColumns({c: F.round(c, k) for c, k in (("peak_synchrony", 9), ("synchrony_energy", 6), ("burst_peak", 6))})


@register(with_sql(*_EVENTS) + 'SELECT ev.well, s AS start, e AS "end", count(DISTINCT unit_id) AS n_active FROM ev LEFT JOIN spk ON spk.well = ev.well AND t >= s AND t < e GROUP BY ev.well, s, e')
def event_participation(spark, d):
    _, _, ev = _events(spark, d)
    return intervals.participants(ev, spikes(spark, d), ["well"], 4 * HOUR)


@register(
    with_sql(*_EVENTS, "x AS (SELECT ev.well, s, (e - s) * 1e-6 AS duration, (s - lag(s) OVER (PARTITION BY ev.well ORDER BY s)) * 1e-6 AS gap FROM ev)")
    + """SELECT x.well, count(*) AS count, round(avg(duration), 4) AS duration_mean, round(stddev_pop(duration), 4) AS duration_std, round(stddev_pop(duration) / avg(duration), 6) AS duration_cv,
 round(coalesce(avg(gap), 0), 3) AS inter_event_interval_mean, round(coalesce(stddev_pop(gap), 0), 3) AS inter_event_interval_std, round(CASE WHEN count(gap) = 0 THEN 0 ELSE stddev_pop(gap) / avg(gap) END, 6) AS inter_event_interval_cv,
 round(count(*) / ((any_value(rec_end) - any_value(rec_start)) * 1e-6), 12) AS rate FROM x JOIN ext USING (well) GROUP BY x.well"""
)
def level_metrics(spark, d):
    _, _, ev = _events(spark, d)
    seconds = ev.select("well", (F.col("start") * SECONDS).alias("start"), ((F.col("end") - F.col("start")) * SECONDS).alias("duration"))
    total = trains.extents(spikes(spark, d)).select("well", ((F.col("rec_end") - F.col("rec_start")) * SECONDS).alias("total_duration"))
    out = intervals.level_metrics(seconds, total, ["duration"], ["well"])
    digits = {"duration_mean": 4, "duration_std": 4, "duration_cv": 6, "inter_event_interval_mean": 3, "inter_event_interval_std": 3, "inter_event_interval_cv": 6, "rate": 12}
    return out.select("well", "count", *[F.round(k, v).alias(k) for k, v in digits.items()])


_RATES = "r AS (SELECT well, unit_id, count(*) / 2592000.0 AS bg, 4 * count(*) / 2592000.0 AS burst FROM spk GROUP BY ALL)"


def _rates(spark, d):
    s = spikes(spark, d)
    n = F.count("*") / 2592000.0
    counts = binning.unit_bins(s, _grid(s))
    return counts.join(s.groupBy("well", "unit_id").agg(n.alias("bg"), (4 * n).alias("burst")), ["well", "unit_id"])


@register(with_sql(*grid_chain(), COUNTS_SQL, _RATES) + "SELECT well, unit_id, bin, round((n / 3600.0 - greatest(bg, 1e-6)) / greatest(bg, 1e-6), 6) AS dfr FROM ub JOIN r USING (well, unit_id)")
def delta_fr(spark, d):
    return _rates(spark, d).select("well", "unit_id", "bin", F.round(models.delta_rate(F.col("n"), F.col("bg"), F.lit(3600.0)), 6).alias("dfr"))


@register(with_sql(*grid_chain(), COUNTS_SQL, _RATES) + "SELECT well, unit_id, bin, round(2 * (n * ln(burst / bg) - (burst - bg) * 3600), 6) AS llr FROM ub JOIN r USING (well, unit_id)")
def two_rate_llr(spark, d):
    return _rates(spark, d).select("well", "unit_id", "bin", F.round(models.llr(F.col("n"), F.col("bg"), F.col("burst"), F.lit(3600.0)), 6).alias("llr"))


@register(with_sql(*signal_chain()) + "SELECT well, bin, round(-(q * ln(q) + (1 - q) * ln(1 - q)), 9) AS entropy FROM (SELECT well, bin, least(greatest(participation, 1e-9), 1 - 1e-9) AS q FROM sig)")
def bernoulli_entropy(spark, d):
    return _signals(spark, d)[3].select("well", "bin", F.round(models.entropy(F.col("participation")), 9).alias("entropy"))


@register(
    with_sql(SPIKES_SQL, "n AS (SELECT well, unit_id, count(*) AS n_spikes FROM spk GROUP BY ALL)") + "SELECT well, unit_id, n_spikes, row_number() OVER (PARTITION BY well ORDER BY n_spikes DESC, unit_id) - 1 AS rank FROM n"
)
def raster_rank(spark, d):
    return trains.unit_ranks(spikes(spark, d)).withColumn("rank", F.col("rank").cast("long"))


@register(
    with_sql(SPIKES_SQL)
    + "SELECT well, unit_id, t FROM (SELECT well, unit_id, t, row_number() OVER (PARTITION BY well ORDER BY t, unit_id) - 1 AS k, count(*) OVER (PARTITION BY well) AS n FROM spk) WHERE k % CAST(ceil(n / 500.0) AS BIGINT) = 0"
)
def stride_sample(spark, d):
    return trains.strided(spikes(spark, d).select("well", "unit_id", "t"), ["well"], ["t", "unit_id"], 500)


@register(
    with_sql(*grid_chain(24 * HOUR), _ISI)
    + """SELECT a.well, a.unit_id, a.n_spikes, round(a.n_spikes / 2592000.0, 9) AS firing_rate, round(a.present / CAST(a.n_bins AS DOUBLE), 6) AS presence_ratio, round(coalesce(b.v, 0) / CAST(a.n_spikes AS DOUBLE), 6) AS rp_violations FROM
 (SELECT spk.well, unit_id, count(*) AS n_spikes, count(DISTINCT least(floor((t - start) / CAST(step AS DOUBLE)), n_bins - 1)) AS present, any_value(n_bins) AS n_bins FROM spk JOIN grid USING (well) GROUP BY ALL) a
 LEFT JOIN (SELECT well, unit_id, count(*) FILTER (isi < 3600000000) AS v FROM isi GROUP BY ALL) b USING (well, unit_id)"""
)
def unit_quality(spark, d):
    s = spikes(spark, d)
    q = trains.refractory(s, _grid(s, 24 * HOUR), HOUR, F.lit(2592000.0))
    return q.select("well", "unit_id", "n_spikes", F.round("firing_rate", 9).alias("firing_rate"), F.round("presence_ratio", 6).alias("presence_ratio"), F.round("rp_violations", 6).alias("rp_violations"))


@register(with_sql(*_MASK, "t AS (SELECT well, hot AS a, lead(hot) OVER (PARTITION BY well ORDER BY bin) AS b FROM m)") + "SELECT well, a, b, n, round(n / CAST(sum(n) OVER (PARTITION BY well, a) AS DOUBLE), 9) AS share FROM (SELECT well, a, b, count(*) AS n FROM t WHERE b IS NOT NULL GROUP BY ALL)")
def transition_matrix(spark, d):
    m = _mask(spark, d)[1].select("well", F.col("hot").alias("a"), F.lead("hot").over(Window.partitionBy("well").orderBy("bin")).alias("b"))
    n = m.where("b IS NOT NULL").groupBy("well", "a", "b").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("well", "a")), 9))


@register(
    with_sql(*signal_chain(), "b AS (SELECT well, min(participation) AS lo, max(participation) AS hi FROM sig GROUP BY well)")
    + "SELECT well, CAST(least(floor((participation - lo) / ((hi - lo) / 40)), 39) AS BIGINT) AS bucket, count(*) AS n FROM sig JOIN b USING (well) WHERE hi > lo GROUP BY ALL"
)
def rank_histogram(spark, d):
    sig = _signals(spark, d)[3]
    b = sig.groupBy("well").agg(F.min("participation").alias("lo"), F.max("participation").alias("hi")).where("hi > lo")
    k = F.least(F.floor((F.col("participation") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / 40)), F.lit(39))
    return sig.join(b, "well").groupBy("well", k.alias("bucket")).agg(F.count("*").alias("n"))


def _wells(spark, d):
    """Events at six-hour bins with ten units a well, as strings, and all that model queries need."""
    s = spikes(spark, d).withColumn("unit_id", F.concat(F.lit("u"), (F.col("unit_id") % 10).cast("string")))
    g = _grid(s, 6 * HOUR)
    return s, trains.extents(s), g, binning.unit_bins(s, g)


@register()
def hmm_posterior(spark, d):
    """Per-unit two-state fits over six-hour bins of the event stream."""
    s, e, g, counts = _wells(spark, d)
    fits = models.fit_units(counts, g, SECONDS)
    rates = fits.select("well", "unit_id", "skipped", F.round("lambda_bg", 9).alias("lambda_bg"), F.round("lambda_burst", 9).alias("lambda_burst"), "iterations")
    return rates.join(models.posteriors(fits), ["well", "unit_id"], "left").withColumn("p", F.round("p", 6))


@register()
def bin_features(spark, d):
    """The 26 features of every six-hour bin."""
    s, e, g, counts = _wells(spark, d)
    fits = stored(models.fit_units(counts, g, SECONDS))
    return models.features(s, counts, g, e, fits, SECONDS, ff_low=float(HOUR), ff_high=24.0 * HOUR)


_PEAKS = [
    *_LIMITS,
    "lim AS (SELECT well, baseline + 0.75 * mad + 1e-9 AS threshold, greatest(0.5 * mad, 0.02) AS least FROM l)",
    "lev AS (SELECT well, r, any_value(x) AS x, min(bin) AS a, max(bin) AS b FROM (SELECT well, bin, participation AS x, sum(step) OVER (PARTITION BY well ORDER BY bin) AS r FROM (SELECT well, bin, participation, CASE WHEN participation = lag(participation) OVER (PARTITION BY well ORDER BY bin) THEN 0 ELSE 1 END AS step FROM sig)) GROUP BY well, r)",
    "cand AS (SELECT * FROM (SELECT *, lag(x) OVER w AS lx, lead(x) OVER w AS rx FROM lev WINDOW w AS (PARTITION BY well ORDER BY r)) JOIN lim USING (well) WHERE x > lx AND x > rx AND x >= threshold)",
    "base AS (SELECT c.well, c.r, c.x, c.a, c.b, c.threshold, c.least, (SELECT max(h.r) FROM lev h WHERE h.well = c.well AND h.r < c.r AND h.x > c.x) AS lr, (SELECT min(h.r) FROM lev h WHERE h.well = c.well AND h.r > c.r AND h.x > c.x) AS rr FROM cand c)",
    "prom AS (SELECT *, (SELECT min(h.x) FROM lev h WHERE h.well = base.well AND h.r < base.r AND h.r >= coalesce(base.lr, 0)) AS lmin, (SELECT min(h.x) FROM lev h WHERE h.well = base.well AND h.r > base.r AND (base.rr IS NULL OR h.r <= base.rr)) AS rmin FROM base)",
    "pk AS (SELECT well, (a + b) // 2 AS peak, greatest(threshold, 0.3 * x) AS floor FROM prom WHERE x - greatest(lmin, rmin) >= least)",
]


@register(
    with_sql(*_PEAKS)
    + "SELECT well, peak, coalesce((SELECT max(s.bin) FROM sig s WHERE s.well = pk.well AND s.bin < pk.peak AND s.participation < pk.floor) + 1, 0) AS start_idx, coalesce((SELECT min(s.bin) FROM sig s WHERE s.well = pk.well AND s.bin > pk.peak AND s.participation < pk.floor), (SELECT max(s.bin) + 1 FROM sig s WHERE s.well = pk.well)) - 1 AS end_idx FROM pk"
)
def peak_find(spark, d):
    """Peaks of participation by height and prominence, and how far they reach."""
    sig = stored(_signals(spark, d)[3])
    limits = binning.median_and_mad(sig, "participation").withColumn("threshold", F.col("baseline") + 0.75 * F.col("mad") + 1e-9)
    return detectors.peaks(sig, limits, "participation")


@register()
def kmeans_typing(spark, d):
    """Types of the event stream's bursts by k-means over their size, length and height."""
    g, m, ev = _events(spark, d)
    sized = detectors._over(ev, m, [F.sum("total").cast("double").alias("total_spikes"), F.max("participation").alias("peak"), F.avg("rate").alias("rate")])
    return models.burst_types(sized.withColumn("length", (F.col("end_idx") - F.col("start_idx") + 1).cast("double")), ["total_spikes", "peak", "rate", "length"])
