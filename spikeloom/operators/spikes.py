"""Spike-train operators on `spikes(well, unit_id, t)`; t is numeric, in any unit, and kept exact if it is integer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spikeloom.functions import order
from spikeloom.functions.lineage import dealt

UNIT = ["well", "unit_id"]


def clean(spikes: DataFrame) -> DataFrame:
    """Finite, non-negative times only; NaN counts as missing."""
    t = F.nanvl(F.col("t").cast("double"), F.lit(None))
    return spikes.where(t.isNotNull() & (t >= 0) & (t < float("inf")))


def extents(spikes: DataFrame) -> DataFrame:
    """rec_start, rec_end, n_units, n_spikes of each well."""
    return spikes.groupBy("well").agg(F.min("t").alias("rec_start"), F.max("t").alias("rec_end"), F.countDistinct("unit_id").alias("n_units"), F.count("*").alias("n_spikes"))


def intervals(spikes: DataFrame) -> DataFrame:
    """Positive inter-spike intervals: (well, unit_id, t, isi), t being the later spike; equal times count once."""
    w = Window.partitionBy(*UNIT).orderBy("t")
    return spikes.select(*UNIT, "t").distinct().withColumn("isi", F.col("t") - F.lag("t").over(w)).where("isi > 0")


def median_log_interval(spikes: DataFrame, scale: float = 1.0) -> DataFrame:
    """`isi`: ten to the median of the pooled log10 intervals of each well (times `scale`, for units of time)."""
    return order.quantile(intervals(spikes), F.log10(F.col("isi") * scale), 0.5, ["well"], "_m").select("well", F.pow(F.lit(10.0), "_m").alias("isi"))


def calibration(spikes: DataFrame, *, scale: float = 1.0, low: float = 0.010, high: float = 0.030, gap_min: float = 0.75) -> DataFrame:
    """Adaptive bin size, smoothing widths in bins and merge gaps of each well, in seconds; 0.1 s stands for a missing interval."""
    isi = F.coalesce("isi", F.lit(0.1))
    size = F.least(F.greatest(isi, F.lit(low)), F.lit(high))
    return (
        extents(spikes)
        .join(median_log_interval(spikes, scale), "well", "left")
        .withColumn("isi", isi)
        .withColumn("bin_size", size)
        .withColumn("sigma_fast", F.least(F.greatest(F.col("isi") / F.col("bin_size"), F.lit(1.0)), F.lit(2.0)))
        .withColumn("sigma_slow", F.least(F.greatest(5 * F.col("isi") / F.col("bin_size"), F.lit(3.0)), F.lit(8.0)))
        .withColumn("burstlet_gap", 3 * F.col("isi"))
        .withColumn("network_gap", F.greatest(10 * F.col("isi"), F.lit(gap_min)))
    )


def lower_bin(t: Column, start: Column, step: Column, n_bins: Column) -> Column:
    """The bin of a time where an edge belongs to the bin below it, clipped to the grid."""
    return F.least(F.greatest(F.ceil((t - start) / step) - 1, F.lit(0)), n_bins - 1).cast("long")


def inverse_intervals(spikes: DataFrame, grid: DataFrame, scale: float = 1.0) -> DataFrame:
    """Mean of 1/interval over the intervals whose midpoint lies in a bin: (well, unit_id, bin, rate); bins without are absent."""
    w = Window.partitionBy(*UNIT).orderBy("t")
    pairs = spikes.select(*UNIT, "t").withColumn("before", F.lag("t").over(w)).where("before IS NOT NULL").join(grid, "well")
    bin_ = lower_bin((F.col("t") + F.col("before")) / 2, F.col("start"), F.col("step"), F.col("n_bins"))
    rate = 1 / F.greatest((F.col("t") - F.col("before")) * scale, F.lit(1e-6))
    return pairs.groupBy(*UNIT, bin_.alias("bin")).agg(F.avg(rate).alias("rate"))


def irregularity(spikes: DataFrame, grid: DataFrame, window_bins: int = 25) -> DataFrame:
    """(well, unit_id, bin, cv, lv): CV of intervals and local variation in a centred window of bins, 0 where undefined.

    An interval belongs to the bin of its later spike, a pair of intervals to that of the last one. Bins whose window holds no interval
    have no row. Windows are summed where their contents change; bins are written out last, so neither silent nor equal stretches are summed.
    Units are dealt over tasks by the number of spikes and stay where they are; grid has a row for each well and is broadcast.
    """
    half = max(1, window_bins // 2)
    w = Window.partitionBy(*UNIT).orderBy("t")
    grid = F.broadcast(grid)  # a row for each well
    rows = (
        dealt(spikes.select(*UNIT, "t"), spikes, *UNIT)
        .withColumn("isi", (F.col("t") - F.lag("t").over(w)).cast("double"))
        .withColumn("last_isi", F.lag("isi").over(w))
        .withColumn("n", F.count("*").over(Window.partitionBy(*UNIT)))
        .where("n >= 3 AND isi IS NOT NULL")
        .join(grid, "well")
        .withColumn("bin", lower_bin(F.col("t"), F.col("start"), F.col("step"), F.col("n_bins")))
    )
    pair = 3 * F.pow(F.col("last_isi") - F.col("isi"), 2) / F.greatest(F.pow(F.col("last_isi") + F.col("isi"), 2), F.lit(1e-12))
    sums = rows.groupBy(*UNIT, "bin").agg(F.count("*").alias("n"), F.sum("isi").alias("s"), F.sum(F.col("isi") * F.col("isi")).alias("q"), F.count("last_isi").alias("m"), F.sum(pair).alias("v"))
    # what a window holds changes only where a bin with intervals enters or leaves it
    marks = sums.select(*UNIT, F.explode(F.array(F.greatest(F.col("bin") - half, F.lit(0)), F.col("bin") + half + 1)).alias("bin")).distinct()
    frame = Window.partitionBy(*UNIT).orderBy("bin").rangeBetween(-half, half)
    both = sums.withColumn("_mark", F.lit(False)).unionByName(marks.withColumn("_mark", F.lit(True)), allowMissingColumns=True)
    n, s, q, m, v = (F.coalesce(F.sum(c).over(frame), F.lit(0)) for c in ("n", "s", "q", "m", "v"))
    mean = F.try_divide(s, n)
    cv = F.when((n >= 2) & (mean > 1e-9), F.sqrt(F.greatest(F.try_divide(q, n) - mean * mean, F.lit(0.0))) / mean).otherwise(0.0)
    lv = F.when(m > 0, F.try_divide(v, m)).otherwise(0.0)
    held = both.select(*UNIT, "bin", "_mark", n.alias("_n"), cv.alias("cv"), lv.alias("lv")).where("_mark")
    spans = held.withColumn("_next", F.lead("bin").over(Window.partitionBy(*UNIT).orderBy("bin"))).where("_n > 0").join(grid.select("well", "n_bins"), "well")
    upto = F.least(F.col("_next"), F.col("n_bins")) - 1
    return spans.where(F.col("bin") <= upto).select(*UNIT, F.explode(F.sequence("bin", upto)).alias("bin"), "cv", "lv")


def unit_ranks(spikes: DataFrame) -> DataFrame:
    """Rank of each unit in its well by spike count, ties by id: (well, unit_id, n_spikes, rank) from 0."""
    n = spikes.groupBy(*UNIT).agg(F.count("*").alias("n_spikes"))
    return n.withColumn("rank", F.row_number().over(Window.partitionBy("well").orderBy(F.desc("n_spikes"), "unit_id")) - 1)


def strided(rows: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    """Every ceil(n / most)-th row of each group, in order: a display sample."""
    n = F.count("*").over(Window.partitionBy(*by))
    k = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    return rows.withColumn("_n", n).withColumn("_k", k).where(F.col("_k") % F.ceil(F.col("_n") / most) == 0).drop("_n", "_k")


def refractory(spikes: DataFrame, grid: DataFrame, period: float, duration: Column) -> DataFrame:
    """Unit quality from spikes alone: firing rate, presence ratio over the grid's bins, share of intervals below `period`."""
    counts = spikes.join(grid, "well").groupBy(*UNIT).agg(
        F.count("*").alias("n_spikes"), F.countDistinct(F.least(F.floor((F.col("t") - F.col("start")) / F.col("step")), F.col("n_bins") - 1)).alias("present"), F.first("n_bins").alias("n_bins"), F.first(duration).alias("duration")
    )
    short = intervals(spikes).groupBy(*UNIT).agg(F.count_if(F.col("isi") < period).alias("violations"))
    return counts.join(short, UNIT, "left").select(
        *UNIT,
        "n_spikes",
        F.try_divide(F.col("n_spikes"), F.col("duration")).alias("firing_rate"),
        F.try_divide(F.col("present"), F.col("n_bins")).alias("presence_ratio"),
        F.try_divide(F.coalesce("violations", F.lit(0)), F.col("n_spikes")).alias("rp_violations"),
    )
