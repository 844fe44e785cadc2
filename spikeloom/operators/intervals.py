"""Interval algebra: islands of a mask, closing, unions and complements, gated merges, overlaps and scoring.

Sequences are `(group, bin)` rows, intervals `(group, start, end)` rows; `by` names the grouping columns.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 64


def islands(rows: DataFrame, mask: str, by: list[str]) -> DataFrame:
    """(by, start_idx, end_idx, n) of maximal runs of consecutive bins whose mask is true."""
    on = rows.where(F.col(mask))
    run = F.col("bin") - F.row_number().over(Window.partitionBy(*by).orderBy("bin"))
    return on.withColumn("_run", run).groupBy(*by, "_run").agg(F.min("bin").alias("start_idx"), F.max("bin").alias("end_idx"), F.count("*").alias("n")).drop("_run")


def closing(rows: DataFrame, mask: str, by: list[str], size: int = 3) -> DataFrame:
    """`rows` with `closed`: dilation, then erosion by a flat window of `size` bins; outside the series counts as false."""
    left, right = (size - 1) // 2, size // 2
    w = Window.partitionBy(*by).orderBy("bin")
    grown = F.max(F.col(mask).cast("int")).over(w.rowsBetween(-left, right))
    full = F.sum("_grown").over(w.rowsBetween(-right, left)) == size
    return rows.withColumn("_grown", grown).withColumn("closed", full).drop("_grown")


def union(intervals: DataFrame, by: list[str], low: Column | None = None, high: Column | None = None) -> DataFrame:
    """Disjoint intervals that cover the same points; touching ones merge. Clipped to [low, high], empty ones dropped."""
    s = F.greatest(F.col("start"), low) if low is not None else F.col("start")
    e = F.least(F.col("end"), high) if high is not None else F.col("end")
    w = Window.partitionBy(*by).orderBy("start", "end")
    cut = intervals.select(*by, s.alias("start"), e.alias("end")).where("end > start")
    fresh = F.coalesce((F.col("start") > F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(1))
    return cut.withColumn("_f", fresh).withColumn("_g", F.sum("_f").over(w)).groupBy(*by, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_g")


def complement(intervals: DataFrame, by: list[str], bounds: DataFrame) -> DataFrame:
    """The gaps between intervals within bounds(by, low, high); a group without intervals is one gap."""
    inside = union(intervals.join(bounds, by), by, F.col("low"), F.col("high"))
    marks = inside.select(*by, F.col("start"), F.col("end")).unionByName(bounds.select(*by, F.col("low").alias("start"), F.col("low").alias("end")))
    w = Window.partitionBy(*by).orderBy("end")
    gaps = marks.withColumn("_next", F.lead("start").over(w)).join(bounds, by).select(*by, F.col("end").alias("start"), F.coalesce("_next", "high").alias("end"))
    return gaps.where("end > start")


def valleys(events: DataFrame, signal: DataFrame, value: str, by: list[str]) -> DataFrame:
    """`events` with `prev_end` and `valley`: the least signal with prev_end <= t_center <= start, null without bins there.

    events: (by, start, end), signal: (by, t_center, value). Running maximum of ends is the earlier end. Gaps and bins meet by blocks of
    time that hold about BLOCK bins, so a gap is compared with the bins around it alone.
    """
    w = Window.partitionBy(*by).orderBy("start", "end")
    known = events.withColumn("prev_end", F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("last_end", F.lag("end").over(w))
    own = [*by, "start", "end"]
    blocks = signal.groupBy(*by).agg(F.greatest((F.max("t_center") - F.min("t_center")) / F.greatest(F.count("*") - 1, F.lit(1)) * BLOCK, F.lit(1e-12)).alias("_w"))
    block = lambda t: F.floor(F.col(t) / F.col("_w"))
    gaps = known.where("last_end <= start").select(*own, "last_end").join(blocks, by).withColumn("_b", F.explode(F.sequence(block("last_end"), block("start"))))
    bins = signal.select(*by, "t_center", value).join(blocks, by).withColumn("_b", block("t_center")).drop("_w")
    low = gaps.join(bins, [*by, "_b"]).where("t_center >= last_end AND t_center <= start").groupBy(*own).agg(F.min(value).alias("valley"))
    return known.join(low, own, "left")


def merge(events: DataFrame, signal: DataFrame, value: str, by: list[str], *, gap: Column, step: Column, accept: Column) -> DataFrame:
    """`events` with `merged`, the number of the merged event from 1: an event joins the one before it if their gap is at most
    `gap` and the valley between them is accepted; without bins between them, if the gap is at most `step`.

    `accept` is a condition on the column `valley`; gap, step and accept may use columns of `events`.
    """
    w = Window.partitionBy(*by).orderBy("start", "end")
    distance = F.col("start") - F.col("prev_end")
    joined = (distance <= gap) & F.when(F.col("valley").isNull(), distance <= step).otherwise(accept)
    fresh = F.when(F.col("prev_end").isNull() | ~F.coalesce(joined, F.lit(False)), 1).otherwise(0)
    return valleys(events, signal, value, by).withColumn("_f", fresh).withColumn("merged", F.sum("_f").over(w)).drop("_f")


def roll_up(events: DataFrame, by: list[str]) -> DataFrame:
    """One row for each `merged` event: extent, its strongest member's peak (the first on ties), sums and counts."""
    best = F.struct("peak_synchrony", -F.col("start"), -F.col("end"))
    return events.groupBy(*by, "merged").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        (F.max("end") - F.min("start")).alias("duration"),
        F.max("peak_synchrony").alias("peak_synchrony"),
        F.max_by("peak_time", best).alias("peak_time"),
        F.sum("synchrony_energy").alias("synchrony_energy"),
        F.sum("fragment_count").alias("fragment_count"),
        F.sum("total_spikes").alias("total_spikes"),
        F.max("burst_peak").alias("burst_peak"),
        F.count("*").alias("n_sub_events"),
    )


def participants(events: DataFrame, spikes: DataFrame, by: list[str], width: Column | float | int) -> DataFrame:
    """Distinct units with a spike in start <= t < end of each event: (by, start, end, n_active).

    Both sides are keyed by blocks of time of `width`, so that the join is an equality with a residual range.
    """
    width = width if isinstance(width, Column) else F.lit(width)
    blocks = events.select(*by, "start", "end").distinct().withColumn("_b", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))))
    keyed = spikes.select(*by, "unit_id", "t").withColumn("_b", F.floor(F.col("t") / width))
    hit = blocks.join(keyed, [*by, "_b"]).where((F.col("t") >= F.col("start")) & (F.col("t") < F.col("end")))
    counts = hit.groupBy(*by, "start", "end").agg(F.countDistinct("unit_id").alias("n_active"))
    return events.select(*by, "start", "end").distinct().join(counts, [*by, "start", "end"], "left").na.fill(0, ["n_active"])


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.least(e1, e2) - F.greatest(s1, s2), F.lit(0))


def hull(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(F.greatest(e1, e2) - F.least(s1, s2), F.lit(0))


def overlaps(a: DataFrame, b: DataFrame, by: list[str], least: float, width: float | int) -> DataFrame:
    """Pairs of rows of a and b with an overlap of `least` or more: a_start, a_end, a_copy, b_start, b_end, b_copy, overlap, iou (by hull).

    Equal intervals are rows of their own, told apart by their copy's number from 1.
    """

    def blocks(df: DataFrame, p: str) -> DataFrame:
        copy = F.row_number().over(Window.partitionBy(*by, "start", "end").orderBy("start"))
        own = df.select(*by, F.col("start").alias(f"{p}_start"), F.col("end").alias(f"{p}_end"), copy.alias(f"{p}_copy"))
        return own.withColumn("_b", F.explode(F.sequence(F.floor(F.col(f"{p}_start") / width), F.floor(F.col(f"{p}_end") / width))))

    sides = [F.col(c) for c in ("a_start", "a_end", "b_start", "b_end")]
    pairs = blocks(a, "a").join(blocks(b, "b"), [*by, "_b"]).drop("_b").distinct()
    return pairs.withColumn("overlap", overlap(*sides)).where(F.col("overlap") >= least).withColumn("iou", F.try_divide("overlap", hull(*sides)))


def greedy_matches(detected: DataFrame, truth: DataFrame, by: list[str], least: float, order: str, width: float = 60.0) -> DataFrame:
    """One-to-one matches (by, start, end, truth_start, truth_end, overlap); every row of either side is one of its own.

    order "largest": pairs by overlap, the largest first. order "earliest": detections in turn take their first free truth. Ties go by start, end and copy.
    A group's overlapping pairs are scanned once, in one task; groups are dealt over slots.
    """
    pairs = overlaps(detected, truth, by, least, width)
    sides = ["a_start", "a_end", "a_copy", "b_start", "b_end", "b_copy"]
    keys = ["overlap", *sides] if order == "largest" else sides
    kinds = ", ".join(f"{c} {detected.schema[c].dataType.simpleString()}" for c in by)

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*by, *keys], ascending=[True] * len(by) + [c != "overlap" for c in keys], kind="stable")
        last, used_a, used_b, kept = None, set(), set(), []
        for k, (own, a, b) in enumerate(zip(zip(*(pdf[c] for c in by)), zip(pdf.a_start, pdf.a_end, pdf.a_copy), zip(pdf.b_start, pdf.b_end, pdf.b_copy))):
            if own != last:
                last, used_a, used_b = own, set(), set()
            if a not in used_a and b not in used_b:
                used_a.add(a)
                used_b.add(b)
                kept.append(k)
        return pdf.iloc[kept].rename(columns={"a_start": "start", "a_end": "end", "b_start": "truth_start", "b_end": "truth_end"})[[*by, "start", "end", "truth_start", "truth_end", "overlap"]]

    slots = 4 * int(detected.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # many small groups in one call
    slot = F.pmod(F.xxhash64(*by), F.lit(slots)).alias("_slot")
    return pairs.select("*", slot).groupBy("_slot").applyInPandas(scan, f"{kinds}, start double, end double, truth_start double, truth_end double, overlap double")


def detection_scores(detected: DataFrame, truth: DataFrame, by: list[str], least: float = 0.03, empty: str = "nan") -> DataFrame:
    """tp, fp, fn, precision, recall, f1 of each group that has detections or truths.

    empty "nan": without detections (truths) precision (recall) is NaN; empty "one": it is 1 if there are no truths (detections) either, else 0.
    """
    matches = greedy_matches(detected, truth, by, least, "earliest" if empty == "nan" else "largest").groupBy(*by).agg(F.count("*").alias("tp"))
    n = lambda df, name: df.groupBy(*by).agg(F.count("*").alias(name))
    both = n(detected, "n_det").join(n(truth, "n_truth"), by, "full").join(matches, by, "left").na.fill(0, ["n_det", "n_truth", "tp"])
    missing = (lambda other: F.lit(float("nan"))) if empty == "nan" else (lambda other: F.when(F.col(other) == 0, 1.0).otherwise(0.0))
    p = F.when(F.col("n_det") > 0, F.col("tp") / F.greatest("n_det", F.lit(1))).otherwise(missing("n_truth"))
    r = F.when(F.col("n_truth") > 0, F.col("tp") / F.greatest("n_truth", F.lit(1))).otherwise(missing("n_det"))
    scored = both.withColumn("precision", p).withColumn("recall", r).withColumn("fp", F.col("n_det") - F.col("tp")).withColumn("fn", F.col("n_truth") - F.col("tp"))
    both_known = ~F.isnan("precision") & ~F.isnan("recall")
    f1 = F.when(both_known & (F.col("precision") + F.col("recall") > 0), 2 * F.col("precision") * F.col("recall") / F.greatest(F.col("precision") + F.col("recall"), F.lit(1e-300)))
    return scored.withColumn("f1", f1.otherwise(F.when(both_known, 0.0).otherwise(F.lit(float("nan")))))


def level_metrics(events: DataFrame, duration: DataFrame, values: list[str], by: list[str]) -> DataFrame:
    """count, rate, and mean, population std and CV of the values and of intervals between starts, for each group."""
    w = Window.partitionBy(*by).orderBy("start")
    named = [*values, "inter_event_interval"]
    stats = []
    for v in named:
        mean, sd = F.coalesce(F.avg(v), F.lit(0.0)), F.coalesce(F.stddev_pop(v), F.lit(0.0))
        stats += [mean.alias(f"{v}_mean"), sd.alias(f"{v}_std"), F.when(F.count(v) == 0, 0.0).when(F.abs(mean) > 1e-12, F.try_divide(sd, mean)).alias(f"{v}_cv")]
    gaps = events.withColumn("inter_event_interval", F.col("start") - F.lag("start").over(w))
    return gaps.groupBy(*by).agg(F.count("*").alias("count"), *stats).join(duration, by).withColumn("rate", F.try_divide("count", "total_duration")).drop("total_duration")
