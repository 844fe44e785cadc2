"""Time grids and population signals: `grid(well, start, step, n_bins)`, `unit_bins(well, unit_id, bin, n)`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikeloom.functions import order


def grid(extents: DataFrame, step: Column | float | int) -> DataFrame:
    """Bins of width `step` from the first spike; the last spike lies in the last bin (whose right edge is closed)."""
    step = step if isinstance(step, Column) else F.lit(step)
    n = F.ceil((F.col("rec_end") - F.col("rec_start")) / step).cast("long")
    return extents.select("well", F.col("rec_start").alias("start"), step.alias("step"), n.alias("n_bins")).where("n_bins > 0")


def spine(grids: DataFrame) -> DataFrame:
    """One row for each bin: (well, bin, t_low, t_high, t_center)."""
    bins = grids.select("well", "start", "step", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_bins") - 1)).alias("bin"))
    low = F.col("start") + F.col("bin") * F.col("step")
    return bins.select("well", "bin", low.alias("t_low"), (low + F.col("step")).alias("t_high"), ((low + low + F.col("step")) / 2).alias("t_center"))


def unit_bins(spikes: DataFrame, grids: DataFrame) -> DataFrame:
    """Spike counts of units in bins; only bins with spikes have a row."""
    bin_ = F.least(F.floor((F.col("t") - F.col("start")) / F.col("step")), F.col("n_bins") - 1)
    return spikes.join(grids, "well").groupBy("well", "unit_id", bin_.alias("bin")).agg(F.count("*").alias("n"))


def signals(counts: DataFrame, grids: DataFrame, n_units: DataFrame, scale: float = 1.0) -> DataFrame:
    """Population signals on every bin: total, active, pfr (per second), participation, rate (per unit and second).

    n_units(well, n_units) also counts silent units; `scale` converts steps to seconds.
    """
    sums = counts.groupBy("well", "bin").agg(F.sum("n").alias("total"), F.count("unit_id").alias("active"))
    seconds = F.col("step") * F.lit(scale)
    return (
        spine(grids)
        .join(grids.select("well", "step"), "well")
        .join(n_units.select("well", "n_units"), "well")
        .join(sums, ["well", "bin"], "left")
        .na.fill(0, ["total", "active"])
        .withColumn("pfr", F.col("total") / seconds)
        .withColumn("participation", F.col("active") / F.greatest(F.col("n_units"), F.lit(1)))
        .withColumn("rate", F.col("total") / seconds / F.greatest(F.col("n_units"), F.lit(1)))
    )


def median_and_mad(rows: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """`baseline` (median) and `mad` (unscaled median absolute deviation) of each group; NaN counts as missing."""
    by = by or ["well"]
    x = F.nanvl(F.col(value).cast("double"), F.lit(None))
    middle = order.quantile(rows, x, 0.5, by, "baseline")
    return middle.join(order.quantile(rows.join(middle, by), F.abs(x - F.col("baseline")), 0.5, by, "mad"), by)


def participation_floor(n_units: Column) -> Column:
    """The least share of units that counts as a burst."""
    few = F.greatest(F.lit(5.0), 0.15 * n_units)
    many = F.greatest(F.lit(10.0), 0.05 * n_units)
    return F.when(n_units < 50, few).otherwise(many) / F.greatest(n_units, F.lit(1))


def thresholds(smooth: DataFrame, value: str, n_units: DataFrame, mad_scale: float = 0.75) -> DataFrame:
    """(well, baseline, mad, threshold): threshold is the larger of the floor and baseline + mad_scale * mad."""
    return median_and_mad(smooth, value).join(n_units.select("well", "n_units"), "well").withColumn("threshold", F.greatest(participation_floor(F.col("n_units")), F.col("baseline") + mad_scale * F.col("mad")))


def fano(counts: DataFrame, grids: DataFrame, n_units: DataFrame, factor: float, low: float, high: float) -> DataFrame:
    """Variance over mean of the units' counts in windows of clip(factor * step, low, high): (well, bin, ff), 0 without spikes.

    Sums of n and n*n over the units with spikes give the variance over all of them, so silent units need no rows.
    """
    wide = F.least(F.greatest(F.col("step") * factor, F.lit(low)), F.lit(high))
    n_wide = F.ceil((F.col("n_bins") * F.col("step")) / F.col("wide"))
    coarse = F.least(F.floor((F.col("bin") + 0.5) * F.col("step") / F.col("wide")), n_wide - 1)
    sized = grids.withColumn("wide", wide)
    units = counts.join(sized, "well").groupBy("well", "unit_id", coarse.alias("coarse")).agg(F.sum("n").alias("n"))
    moments = units.groupBy("well", "coarse").agg(F.sum("n").alias("s"), F.sum(F.col("n") * F.col("n")).alias("q")).join(n_units.select("well", "n_units"), "well")
    mean = F.col("s") / F.col("n_units")
    moments = moments.select("well", "coarse", F.when(mean > 1e-9, (F.col("q") / F.col("n_units") - mean * mean) / mean).otherwise(0.0).alias("ff"))
    return spine(grids).select("well", "bin").join(sized, "well").withColumn("coarse", coarse).join(moments, ["well", "coarse"], "left").select("well", "bin", F.coalesce("ff", F.lit(0.0)).alias("ff"))
