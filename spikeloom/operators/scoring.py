"""Scoring of detected events against truth, comparison of methods, tiers of datasets, and tables about clusters of bins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import intervals

#: The columns that a quality summary is about, and the least overlap of a match in seconds.
QUALITY = "duration peak_synchrony participation total_spikes llr_aggregate composite_peak composite_mean ff_peak".split()
MIN_OVERLAP = 0.03
#: Upper limits of tiers and their names.
UNIT_TIERS = [(40, "small (<=40)"), (100, "medium (41-100)"), (None, "large (101-150)")]
RATE_TIERS = [(0.35, "low"), (1.2, "medium"), (None, "high")]
DURATION_TIERS = [(0.75, "medium-short (0.5-0.75s)"), (1.25, "medium (0.75-1.25s)"), (None, "long (1.25-2.0s)")]
RECRUITMENT_TIERS = [(0.55, "weak"), (0.78, "moderate"), (None, "strong")]
SPREAD_MIXED, SPREAD_VARIABLE = 20, 0.75
#: Parts of dataset names and what they say about the bursts' form.
MORPHOLOGY = [
    ("clustered", "clustered"), ("irregular", "irregular"), ("weak-recruitment", "weak recruitment"), ("silence", "post-burst silence"),
    ("variable-duration", "variable duration"), ("long-duration", "long duration"), ("short-duration", "short duration"),
]
CULTURES = [("independent_poisson", "independent"), ("composite_connected", "composite")]


def ladder(steps: list[tuple[Column, str]], otherwise: str) -> Column:
    """The name of the first condition that holds."""
    return F.coalesce(*[F.when(c, name) for c, name in steps], F.lit(otherwise))


def tier(x: Column, limits: list[tuple], closed: bool = False) -> Column:
    """The name of the first tier whose limit lies above x (or is x, if closed)."""
    return ladder([(x <= limit if closed else x < limit, name) for limit, name in limits[:-1]], limits[-1][1])


def unit_tier(n_units: Column) -> Column:
    return tier(n_units, UNIT_TIERS, closed=True)


def rate_tier(low: Column, median: Column, high: Column) -> Column:
    mixed = high / F.greatest(low, F.lit(1e-12)) >= SPREAD_MIXED
    return F.when(median.isNull(), "unknown").when(mixed, "mixed").otherwise(tier(median, RATE_TIERS))


def duration_tier(low: Column, median: Column, high: Column) -> Column:
    return F.when(median.isNull(), "none").when(high - low >= SPREAD_VARIABLE, "variable").otherwise(tier(median, DURATION_TIERS))


def recruitment_tier(p: Column) -> Column:
    return F.when(F.nanvl(p.cast("double"), F.lit(None)).isNull(), "none").otherwise(tier(p, RECRUITMENT_TIERS))


def morphology(name: Column, culture: Column, is_real: Column) -> Column:
    steps = [(is_real, "real spikesorted"), *((culture == k, v) for k, v in CULTURES), *((name.contains(k), v) for k, v in MORPHOLOGY)]
    return ladder(steps, "cascade")


def categories(datasets: DataFrame) -> DataFrame:
    """`datasets` with their tiers and benchmark group. datasets: (name, culture, is_real, n_units, n_truth, rate_low, rate_median, rate_high, duration_low, duration_median, duration_high, recruitment)."""
    three = lambda p: [F.col(f"{p}_{k}") for k in ("low", "median", "high")]
    expected = F.when(F.col("is_real"), "real data (unlabeled)").when(F.col("n_truth") == 0, "negative control").otherwise("burst-positive")
    out = datasets.withColumns({
        "expected": expected, "unit_count_tier": unit_tier(F.col("n_units")), "baseline_rate_tier": rate_tier(*three("rate")), "burst_duration_tier": duration_tier(*three("duration")),
        "morphology": morphology(F.col("name"), F.col("culture"), F.col("is_real")), "recruitment_tier": recruitment_tier(F.col("recruitment")),
    })
    return out.withColumn("benchmark_group", F.concat_ws(" | ", "expected", "unit_count_tier", F.concat("baseline_rate_tier", F.lit(" rate")), "morphology"))


def _ratio(a: Column, b: Column, otherwise: Column | float) -> Column:
    return F.when(b > 0, a / b).otherwise(otherwise)


def _harmonic(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)


def score_events(detected: DataFrame, truth: DataFrame, durations: DataFrame, by: list[str], least: float = MIN_OVERLAP) -> DataFrame:
    """The thirty scores of each group of durations(by, duration) or of the events: counts, precision and recall of events and of their time, errors of matched ends,
    rates per minute and flags. A group without a duration, or with one of 0, has events but rates of 0. Matches are one to one, the largest overlap first; a side without events has 1 where the other has none either, else 0."""
    size = F.greatest(F.col("end") - F.col("start"), F.lit(0.0))
    side = lambda df, n: df.groupBy(*by).agg(F.count("*").alias(n), F.sum(size).alias(f"{n}_s"))
    m = intervals.greedy_matches(detected, truth, by, least, "largest")
    onset, offset = F.col("start") - F.col("truth_start"), F.col("end") - F.col("truth_end")
    length, truth_length = F.col("end") - F.col("start"), F.col("truth_end") - F.col("truth_start")
    hull = intervals.hull(*[F.col(c) for c in ("start", "end", "truth_start", "truth_end")])
    matched = m.groupBy(*by).agg(
        F.count("*").alias("tp"), F.sum("overlap").alias("overlap"), F.avg(F.try_divide("overlap", hull)).alias("iou"), F.percentile(F.abs(onset), 0.5).alias("onset"), F.percentile(F.abs(offset), 0.5).alias("offset"),
        F.percentile(F.abs(length - truth_length), 0.5).alias("length"), F.sum(length).alias("hit_s"), F.sum(truth_length).alias("found_s"), F.bool_or(length - truth_length > 0.5).alias("merged"),
    )
    unknown = detected.select(*by).unionByName(truth.select(*by)).distinct().join(durations, by, "left_anti").withColumn("duration", F.lit(None).cast("double"))
    x = durations.select(*by, F.col("duration").cast("double").alias("duration")).unionByName(unknown).join(side(detected, "n"), by, "left").join(side(truth, "k"), by, "left").join(matched, by, "left").na.fill(0, ["n", "n_s", "k", "k_s", "tp", "overlap", "iou", "onset", "offset", "length", "hit_s", "found_s"])
    n, k, tp, c = F.col("n"), F.col("k"), F.col("tp"), F.col
    one = lambda other: F.when(other == 0, 1.0).otherwise(0.0)
    precision, recall = _ratio(tp, n, one(k)), _ratio(tp, k, one(n))
    cover_r, cover_p = _ratio(c("overlap"), c("k_s"), one(c("n_s"))), _ratio(c("overlap"), c("n_s"), one(c("k_s")))
    minutes = F.coalesce(c("duration"), F.lit(0.0)) / 60
    fragments = _ratio(n, tp, 0.0)
    return x.select(
        *by, k.alias("truth_bursts"), n.alias("detected_network_bursts"), tp.alias("true_positive_events"), (n - tp).alias("false_positive_events"), (k - tp).alias("false_negative_events"),
        precision.alias("precision"), recall.alias("recall"), _harmonic(precision, recall).alias("f1"), c("iou").alias("mean_iou"), c("onset").alias("median_abs_onset_error_s"), c("offset").alias("median_abs_offset_error_s"),
        c("length").alias("median_abs_duration_error_s"), c("k_s").alias("truth_time_s"), c("n_s").alias("predicted_time_s"), c("overlap").alias("matched_overlap_s"),
        cover_p.alias("coverage_precision"), cover_r.alias("coverage_recall"), _harmonic(cover_p, cover_r).alias("coverage_f1"), (c("n_s") - c("hit_s")).alias("false_positive_time_s"), (c("k_s") - c("found_s")).alias("missed_truth_time_s"),
        (n - k).alias("count_error"), F.abs(n - k).alias("count_abs_error"), _ratio(n, k, F.when(n > 0, float("inf")).otherwise(0.0)).alias("count_ratio"),
        _ratio(k, minutes, 0.0).alias("truth_rate_per_min"), _ratio(n, minutes, 0.0).alias("event_rate_per_min"), _ratio(n - tp, minutes, 0.0).alias("false_positive_rate_per_min"),
        _ratio(k - tp, k, 0.0).alias("missed_rate"), fragments.alias("fragmentation_index"), F.coalesce(c("merged"), F.lit(False)).alias("merge_flag"), ((k - tp > 0) | (fragments > 1.5)).alias("split_or_miss_flag"),
    )


def quality_summary(events: DataFrame, groups: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Median and mean of the columns for each of the groups; one without events has zeros."""
    stats = [f(c).alias(f"{c}_{name}") for c in columns for name, f in (("median", lambda c: F.percentile(c, 0.5)), ("mean", F.avg))]
    return groups.select(*by).join(events.groupBy(*by).agg(*stats), by, "left").na.fill(0.0)


def event_table(tables: dict[str, DataFrame], name: str = "method") -> DataFrame:
    """All tables as one, with their name in a column; columns that a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [t.withColumn(name, F.lit(k)) for k, t in tables.items()])


def compare_methods(outputs: dict[str, DataFrame | Exception], truth: DataFrame, durations: DataFrame, by: list[str]) -> DataFrame:
    """A row of scores for each method and group; a method that failed has a row for each group with its error."""
    parts = []
    for method, found in outputs.items():
        failed = isinstance(found, Exception)
        rows = durations.select(*by) if failed else score_events(found, truth, durations, by)
        parts.append(rows.withColumn("method", F.lit(method)).withColumn("error", F.lit(str(found) if failed else None).cast("string")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def dataset_summary(datasets: DataFrame, spikes: DataFrame, truth: DataFrame, by: list[str]) -> DataFrame:
    """Units, mean spikes of a unit, and number, mean, shortest and longest of the true events of each dataset."""
    units = spikes.groupBy(*by, "unit_id").agg(F.count("*").alias("n")).groupBy(*by).agg(F.count("*").alias("units"), F.avg("n").alias("mean_spikes_per_unit"))
    size = F.col("end") - F.col("start")
    events = truth.groupBy(*by).agg(F.count("*").alias("truth_bursts"), *[f(size).alias(f"{name}_truth_duration_s") for name, f in (("mean", F.avg), ("min", F.min), ("max", F.max))])
    return datasets.select(*by).join(units, by, "left").join(events, by, "left").na.fill(0)


def sweep(rows: DataFrame, dims: DataFrame, means: dict[str, str]) -> DataFrame:
    """Counts, means and wells with bursts of each of dims(dim), whether it has rows or not. rows: (dim, well, active, ...)."""
    agg = rows.groupBy("dim").agg(F.count("well").alias("wells"), *[F.avg(c).alias(name) for name, c in means.items()], F.count_if("active").alias("n_wells_with_bursts"))
    return agg.join(dims.select("dim"), "dim", "right")


# --- clusters of bins: bins(well, bin, label, ...) ------------------------------------------------------------------
def cluster_table(bins: DataFrame, ranks: DataFrame, burst: DataFrame) -> DataFrame:
    """(well, label, n_bins, score, is_burst) of ranked clusters. ranks: (well, label, score), burst: (well, label)."""
    n = bins.groupBy("well", "label").agg(F.count("*").alias("n_bins"))
    mark = burst.select("well", "label").distinct().withColumn("is_burst", F.lit(True))
    return ranks.join(n, ["well", "label"], "left").join(mark, ["well", "label"], "left").na.fill(0, ["n_bins"]).withColumn("is_burst", F.coalesce("is_burst", F.lit(False)))


def runs(bins: DataFrame, mask: Column, by: list[str], order: str = "bin") -> DataFrame:
    """Contiguous runs of a mask in each group: rising edges."""
    before = F.lag(mask.cast("int")).over(Window.partitionBy(*by).orderBy(order))
    return bins.withColumn("_up", mask & (F.coalesce(before, F.lit(0)) == 0)).groupBy(*by).agg(F.count_if("_up").alias("runs"))


def method_stats(bins: DataFrame, mask: Column, rank: str, by: list[str], high: float = 0.5, low: float = 0.1) -> DataFrame:
    """Burst bins, their share of the bins with a high and a low rank (null without any), and runs."""
    share = lambda test: F.avg(F.when(test, mask.cast("double")))
    stats = bins.groupBy(*by).agg(F.count_if(mask).alias("n_burst"), share(F.col(rank) > high).alias("recall_hi"), share(F.col(rank) < low).alias("fp_resting"), F.countDistinct("label").alias("n_clusters"))
    return stats.join(runs(bins, mask, by), by)


def trajectories(bins: DataFrame, activity: str, features: list[str], most_to_rest: float = 0.5, least_amplitude: float = 1.3) -> DataFrame:
    """How each cluster of a well travels: occupancy, mean run, share of steps that go to rest, share of bins in excursions through several
    clusters, and distance from rest over the median distance of all bins; `picked` are far clusters that seldom go straight to rest.

    Rest is the cluster with the least mean activity. features: standardised columns.
    """
    own, w = Window.partitionBy("well"), Window.partitionBy("well").orderBy("bin")
    rest = bins.where("label >= 0").groupBy("well", "label").agg(F.avg(activity).alias("a")).groupBy("well").agg(F.min_by("label", F.struct("a", "label")).alias("rest"))
    center = bins.join(rest, "well").where("label = rest").groupBy("well", "rest").agg(*[F.avg(f).alias(f"_c{k}") for k, f in enumerate(features)])
    distance = F.sqrt(reduce(lambda a, b: a + b, [F.pow(F.col(f) - F.col(f"_c{k}"), 2) for k, f in enumerate(features)]))
    rows = bins.join(center, "well").withColumn("far", distance).withColumn("next", F.lead("label").over(w)).withColumn("fresh", (F.coalesce(F.lag("label").over(w) != F.col("label"), F.lit(True))).cast("int"))
    away = (F.col("label") != F.col("rest")).cast("int")
    rows = rows.withColumn("trip", F.when(away == 1, F.sum(1 - away).over(w.rowsBetween(Window.unboundedPreceding, 0)))).withColumn("n_all", F.count("*").over(own))
    trips = rows.where("trip IS NOT NULL").groupBy("well", "trip").agg(F.countDistinct(F.when(F.col("label") >= 0, F.col("label"))).alias("kinds"))
    spread = rows.groupBy("well").agg(F.percentile("far", 0.5).alias("spread"))
    out = rows.join(trips, ["well", "trip"], "left").where("label >= 0").groupBy("well", "label", "rest").agg(
        (F.count("*") / F.first("n_all")).alias("occupancy"), (F.count("*") / F.greatest(F.sum("fresh"), F.lit(1))).alias("mean_run"),
        F.coalesce(F.try_divide(F.count_if(F.col("next") == F.col("rest")), F.count("next")), F.lit(0.0)).alias("to_rest"), F.avg(F.when(F.col("kinds") >= 2, 1.0).otherwise(0.0)).alias("cotravel"), F.avg("far").alias("_far"),
    )
    out = out.join(spread, "well").withColumn("amplitude", F.when(F.col("spread") > 0, F.col("_far") / F.col("spread")).otherwise(0.0))
    return out.withColumn("picked", (F.col("label") != F.col("rest")) & (F.col("to_rest") < most_to_rest) & (F.col("amplitude") >= least_amplitude)).drop("_far", "spread")


def label_mask(bins: DataFrame, burst: DataFrame) -> DataFrame:
    """`bins` with `on`: whether their label is among the well's burst clusters. burst: (well, label)."""
    chosen = burst.select("well", "label").distinct().withColumn("on", F.lit(True))
    return bins.join(F.broadcast(chosen), ["well", "label"], "left").withColumn("on", F.coalesce("on", F.lit(False)))  # a few clusters a well


def against_known(picks: DataFrame, known: DataFrame) -> DataFrame:
    """(well, hit, missed, false_pick): sorted labels that are both picked and really bursts, really but not picked, picked but junk. known: (well, real array, junk array)."""
    chosen = picks.groupBy("well").agg(F.collect_set(F.when(F.col("picked"), F.col("label"))).alias("p"))
    return known.join(chosen, "well", "left").select("well", *[F.array_sort(c).alias(n) for n, c in (("hit", F.array_intersect("real", "p")), ("missed", F.array_except("real", "p")), ("false_pick", F.array_intersect("junk", "p")))])


def label_union(ranks: DataFrame, burst: DataFrame) -> DataFrame:
    """(well, labels): the top cluster of each well and the burst clusters, sorted."""
    top = ranks.where("position = 1").select("well", "label")
    return top.unionByName(burst.select("well", "label")).groupBy("well").agg(F.array_sort(F.collect_set("label")).alias("labels"))


def fit_summary(fits: DataFrame) -> DataFrame:
    """Fitted and skipped units of each well, and the reasons by unit."""
    pairs = F.collect_list(F.when(F.col("skipped").isNotNull(), F.struct("unit_id", "skipped")))
    return fits.groupBy("well").agg(F.count_if(F.col("skipped").isNull()).alias("n_fit"), F.count_if(F.col("skipped").isNotNull()).alias("n_skipped"), F.map_from_entries(F.array_sort(pairs)).alias("reasons"))


def top_loadings(loadings: DataFrame, n: int = 3) -> DataFrame:
    """The n features with the largest absolute loading of each axis. loadings: (axis, feature, loading)."""
    k = F.row_number().over(Window.partitionBy("axis").orderBy(F.desc(F.abs("loading")), "feature"))
    return loadings.withColumn("position", k).where(F.col("position") <= n)


# --- display ranges and rasters -------------------------------------------------------------------------------------
def time_end(spikes: DataFrame, signal: DataFrame) -> DataFrame:
    """The last time of any spike or signal, one row."""
    return spikes.agg(F.max("t").alias("a")).crossJoin(F.broadcast(signal.agg(F.max("t").alias("b")))).select(F.greatest("a", "b").alias("t_max"))  # single rows


def padded_range(rows: DataFrame, value: str, by: list[str], share: float = 0.08, least: float = 0.02) -> DataFrame:
    """(by, low, high): the finite values' range with 0 in it, and a margin on either side."""
    x = F.when(F.abs(F.col(value)) < float("inf"), F.nanvl(F.col(value).cast("double"), F.lit(None)))
    ends = rows.groupBy(*by).agg(F.least(F.min(x), F.lit(0.0)).alias("a"), F.greatest(F.max(x), F.lit(0.0)).alias("b"), F.count(x).alias("n")).where("n > 0")
    pad = F.greatest((F.col("b") - F.col("a")) * share, F.lit(least))
    return ends.select(*by, (F.col("a") - pad).alias("low"), (F.col("b") + pad).alias("high"))


def capped_raster(spikes: DataFrame, points: int = 12_000, least: int = 40) -> DataFrame:
    """Every s-th spike of each unit, s by unit so that a well shows about `points`; (well, unit_id, t, rate): the rate is that of what is shown."""
    n_units = spikes.groupBy("well").agg(F.countDistinct("unit_id").alias("u"), F.max("t").alias("end"))
    unit = Window.partitionBy("well", "unit_id")
    cap = F.greatest(F.lit(least), F.floor(points / F.col("u")))
    rows = spikes.join(n_units, "well").withColumn("n", F.count("*").over(unit)).withColumn("k", F.row_number().over(unit.orderBy("t")) - 1).withColumn("step", F.when(F.col("n") > cap, F.ceil(F.col("n") / cap)).otherwise(1))
    shown = rows.where("k % step = 0")
    return shown.withColumn("rate", F.when(F.col("end") > 0, F.count("*").over(unit) / F.col("end")).otherwise(0.0)).select("well", "unit_id", "t", "rate")


def interval_pairs(spikes: DataFrame) -> DataFrame:
    """(well, unit_id, t, isi, last_isi, lv): consecutive intervals of a unit; a pair belongs to the time of its later spike."""
    w = Window.partitionBy("well", "unit_id").orderBy("t")
    isi = spikes.select("well", "unit_id", "t").withColumn("isi", F.col("t") - F.lag("t").over(w)).withColumn("last_isi", F.lag("isi").over(w))
    x, y = F.col("last_isi").cast("double"), F.col("isi").cast("double")
    return isi.where("last_isi IS NOT NULL").withColumn("lv", 3 * F.pow(x - y, 2) / F.greatest(F.pow(x + y, 2), F.lit(1e-12)))


def summary_card(spikes: DataFrame, levels: dict[str, DataFrame], facts: DataFrame) -> DataFrame:
    """Counts of units and of each level's events, with the facts that are known of a well."""
    out = spikes.groupBy("well").agg(F.countDistinct("unit_id").alias("n_units"))
    for name, events in levels.items():
        out = out.join(events.groupBy("well").agg(F.count("*").alias(f"n_{name}")), "well", "left").na.fill(0, [f"n_{name}"])
    return out.join(facts, "well", "left")


def common_reference(frames: DataFrame, value: str, neighbours: list[list[int]] | None = None, operator: str = "median") -> DataFrame:
    """`frames` with each channel of an array column less the median (or mean) of all channels, or of its own neighbours; without any neighbour, of all."""

    def middle(x: Column) -> Column:
        if operator == "mean":
            return F.aggregate(x, F.lit(0.0), lambda a, b: a + b) / F.size(x)
        s, n = F.array_sort(x), F.size(x)
        return (F.get(s, F.expr("0") + F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2

    x = F.col(value).cast("array<double>")
    if neighbours is None:
        return frames.withColumn("_m", middle(x)).withColumn(value, F.transform(x, lambda v: v - F.col("_m"))).drop("_m")
    near = F.array(*[F.array(*[F.get(x, F.lit(k)) for k in own]) if own else x for own in neighbours])
    return frames.withColumn(value, F.zip_with(x, F.transform(near, middle), lambda v, m: v - m))
