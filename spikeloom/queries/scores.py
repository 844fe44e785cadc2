"""Scores, tiers, cluster tables, rasters and references over the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from spikeloom.functions.lineage import stored
from spikeloom.operators import browse, curation, intervals, models, scoring

from .common import HOUR, SECONDS, SPIKES_SQL, COUNTS_SQL, grid_chain, signal_chain, spikes, table, with_sql
from .reports import _IV, _iv
from .signals import _EVENTS, _RATES, _events, _rates, _signals

QUERIES, ORACLES = {}, {}


def register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# one-to-one matches by a scan over each customer's overlapping pairs
def _matches(order: str, least: str, scale: str = "1.0") -> list[str]:
    return [
        *(f"{to} AS (SELECT well, s, e, row_number() OVER (PARTITION BY well ORDER BY s, e) AS id FROM (SELECT well, s / {scale} AS s, e / {scale} AS e FROM {of}))" for to, of in (("dv", "iv"), ("uv", "tv"))),
        f"pairs AS (SELECT *, row_number() OVER (PARTITION BY well ORDER BY {order}) AS r FROM (SELECT dv.well, dv.id AS a, dv.s AS a_s, dv.e AS a_e, uv.id AS b, uv.s AS b_s, uv.e AS b_e, least(dv.e, uv.e) - greatest(dv.s, uv.s) AS overlap FROM dv JOIN uv ON uv.well = dv.well AND least(dv.e, uv.e) - greatest(dv.s, uv.s) >= {least}))",
        "scan(well, r, ua, ub, taken) AS (SELECT DISTINCT well, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]), CAST([] AS BIGINT[]) FROM pairs UNION ALL "
        "SELECT well, pr, CASE WHEN free THEN list_append(ua, a) ELSE ua END, CASE WHEN free THEN list_append(ub, b) ELSE ub END, CASE WHEN free THEN list_append(taken, pr) ELSE taken END FROM "
        "(SELECT s.well, s.ua, s.ub, s.taken, p.a, p.b, p.r AS pr, NOT list_contains(s.ua, p.a) AND NOT list_contains(s.ub, p.b) AS free FROM scan s JOIN pairs p ON p.well = s.well AND p.r = s.r + 1) x)",
        "m AS (SELECT p.* FROM (SELECT well, arg_max(taken, r) AS taken FROM scan GROUP BY well) t JOIN pairs p ON p.well = t.well AND list_contains(t.taken, p.r))",
    ]


_LARGEST = "overlap DESC, a, b"
_RECURSIVE = "WITH RECURSIVE "


def _small(spark, d, scale: float = 1.0):
    """Both sides in other units; some intervals are there twice, where customers are divisible by seven."""
    cut = lambda df: stored(df.select("well", (F.col("start") / scale).alias("start"), (F.col("end") / scale).alias("end")))
    twice = lambda df: df.unionByName(df.where("well % 7 = 0"))
    return cut(twice(_iv(spark, d, 0, 3000))), cut(twice(_iv(spark, d, 1, 5000)))


_TWICE = _IV.replace("iv AS", "iv0 AS").replace("tv AS", "tv0 AS").replace("tiv0", "tv0") + ", " + ", ".join(f"{x} AS (SELECT * FROM {x}0 UNION ALL SELECT * FROM {x}0 WHERE well % 7 = 0)" for x in ("iv", "tv"))


@register(_RECURSIVE + ", ".join([_TWICE, *_matches(_LARGEST, "100")]) + ' SELECT well, round(a_s, 4) AS start, round(a_e, 4) AS "end", round(b_s, 4) AS truth_start, round(overlap, 4) AS overlap FROM m')
def greedy_match(spark, d):
    """One-to-one matches of two sets of intervals, the largest overlap first."""
    found, truth = _small(spark, d)
    out = intervals.greedy_matches(found, truth, ["well"], 100.0, "largest", 20_000.0)
    return out.select("well", *[F.round(c, 4).alias(c) for c in ("start", "end", "truth_start", "overlap")])


_COUNTS = "w AS (SELECT well FROM dv UNION SELECT well FROM uv), c AS (SELECT w.well, (SELECT count(*) FROM dv WHERE dv.well = w.well) AS n, (SELECT count(*) FROM uv WHERE uv.well = w.well) AS k, (SELECT count(*) FROM m WHERE m.well = w.well) AS tp FROM w), pr AS (SELECT *, CASE WHEN n > 0 THEN tp / CAST(n AS DOUBLE) ELSE 'nan' END AS p, CASE WHEN k > 0 THEN tp / CAST(k AS DOUBLE) ELSE 'nan' END AS r FROM c)"


@register(_RECURSIVE + ", ".join([_TWICE, *_matches("a, b", "0.03", "1000.0"), _COUNTS]) + " SELECT well, n AS n_det, k AS n_truth, tp, n - tp AS fp, k - tp AS fn, round(p, 9) AS precision, round(r, 9) AS recall, round(CASE WHEN isnan(p) OR isnan(r) THEN 'nan' WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 9) AS f1 FROM pr")
def detection_scores(spark, d):
    """Detections in turn take their first free truth; true and false ones, precision, recall and F1."""
    found, truth = _small(spark, d, 1000.0)
    out = intervals.detection_scores(found, truth, ["well"])
    return out.select("well", "n_det", "n_truth", "tp", "fp", "fn", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


_SCORES = """SELECT well, k AS truth_bursts, n AS detected_network_bursts, tp AS true_positive_events, n - tp AS false_positive_events, k - tp AS false_negative_events, p AS precision, r AS recall, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1,
 iou AS mean_iou, onset AS median_abs_onset_error_s, offs AS median_abs_offset_error_s, len AS median_abs_duration_error_s, k_s AS truth_time_s, n_s AS predicted_time_s, overlap AS matched_overlap_s, cp AS coverage_precision, cr AS coverage_recall, CASE WHEN cp + cr > 0 THEN 2 * cp * cr / (cp + cr) ELSE 0 END AS coverage_f1,
 n_s - hit AS false_positive_time_s, k_s - found AS missed_truth_time_s, n - k AS count_error, abs(n - k) AS count_abs_error, CASE WHEN k > 0 THEN n / CAST(k AS DOUBLE) WHEN n > 0 THEN CAST('inf' AS DOUBLE) ELSE 0 END AS count_ratio, k / 10.0 AS truth_rate_per_min, n / 10.0 AS event_rate_per_min, (n - tp) / 10.0 AS false_positive_rate_per_min,
 CASE WHEN k > 0 THEN (k - tp) / CAST(k AS DOUBLE) ELSE 0 END AS missed_rate, CASE WHEN tp > 0 THEN n / CAST(tp AS DOUBLE) ELSE 0 END AS fragmentation_index, merged AS merge_flag, k - tp > 0 OR (tp > 0 AND n / CAST(tp AS DOUBLE) > 1.5) AS split_or_miss_flag FROM z"""
_SCORE_PARTS = [
    "w AS (SELECT well FROM dv UNION SELECT well FROM uv)",
    "a1 AS (SELECT well, count(*) AS n, sum(e - s) AS n_s FROM dv GROUP BY well), a2 AS (SELECT well, count(*) AS k, sum(e - s) AS k_s FROM uv GROUP BY well)",
    "a3 AS (SELECT well, count(*) AS tp, sum(overlap) AS overlap, avg(overlap / (greatest(a_e, b_e) - least(a_s, b_s))) AS iou, quantile_cont(abs(a_s - b_s), 0.5) AS onset, quantile_cont(abs(a_e - b_e), 0.5) AS offs, quantile_cont(abs((a_e - a_s) - (b_e - b_s)), 0.5) AS len, sum(a_e - a_s) AS hit, sum(b_e - b_s) AS found, bool_or((a_e - a_s) - (b_e - b_s) > 0.5) AS merged FROM m GROUP BY well)",
    "y AS (SELECT well, coalesce(n, 0) AS n, coalesce(n_s, 0) AS n_s, coalesce(k, 0) AS k, coalesce(k_s, 0) AS k_s, coalesce(tp, 0) AS tp, coalesce(overlap, 0) AS overlap, coalesce(iou, 0) AS iou, coalesce(onset, 0) AS onset, coalesce(offs, 0) AS offs, coalesce(len, 0) AS len, coalesce(hit, 0) AS hit, coalesce(found, 0) AS found, coalesce(merged, false) AS merged FROM w LEFT JOIN a1 USING (well) LEFT JOIN a2 USING (well) LEFT JOIN a3 USING (well))",
    "z AS (SELECT *, CASE WHEN n > 0 THEN tp / CAST(n AS DOUBLE) WHEN k = 0 THEN 1 ELSE 0 END AS p, CASE WHEN k > 0 THEN tp / CAST(k AS DOUBLE) WHEN n = 0 THEN 1 ELSE 0 END AS r, CASE WHEN n_s > 0 THEN overlap / n_s WHEN k_s = 0 THEN 1 ELSE 0 END AS cp, CASE WHEN k_s > 0 THEN overlap / k_s WHEN n_s = 0 THEN 1 ELSE 0 END AS cr FROM y)",
]
_ROUNDED = "precision recall f1 mean_iou median_abs_onset_error_s median_abs_offset_error_s median_abs_duration_error_s truth_time_s predicted_time_s matched_overlap_s coverage_precision coverage_recall coverage_f1 false_positive_time_s missed_truth_time_s count_ratio truth_rate_per_min event_rate_per_min false_positive_rate_per_min missed_rate fragmentation_index".split()
_ROUND_SQL = ", ".join(f"round({c}, 7) AS {c}" for c in _ROUNDED)


def _rounded(df):
    return df.withColumns({c: F.round(F.col(c).cast("double"), 7) + 0.0 for c in _ROUNDED})


def _durations(found, truth):
    return found.select("well").union(truth.select("well")).distinct().withColumn("duration", F.lit(600.0))


@register(_RECURSIVE + ", ".join([_TWICE, *_matches(_LARGEST, "0.03", "1000.0"), *_SCORE_PARTS, f"q AS ({_SCORES})"]) + f" SELECT * REPLACE ({_ROUND_SQL}) FROM q")
def event_scores(spark, d):
    """The thirty scores of intervals against true ones."""
    found, truth = _small(spark, d, 1000.0)
    return _rounded(scoring.score_events(found, truth, _durations(found, truth), ["well"]))


@register(
    _RECURSIVE + ", ".join([_TWICE, *_matches(_LARGEST, "0.03", "1000.0"), *_SCORE_PARTS, f"q AS ({_SCORES})"])
    + f" SELECT * REPLACE ({_ROUND_SQL}), 'own' AS method, CAST(NULL AS VARCHAR) AS error FROM q UNION ALL BY NAME SELECT well, 'broken' AS method, 'no spikes' AS error FROM w"
)
def method_comparison(spark, d):
    """Two methods over the same data, of which one failed."""
    found, truth = _small(spark, d, 1000.0)
    out = scoring.compare_methods({"own": found, "broken": ValueError("no spikes")}, truth, _durations(found, truth), ["well"])
    return _rounded(out)


@register("WITH g AS (SELECT n_nationkey AS nation FROM nation), c AS (SELECT c_nationkey AS nation, quantile_cont(c_acctbal, 0.5) AS m, avg(c_acctbal) AS a FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey < 20 GROUP BY 1) SELECT CAST(nation AS INT) AS nation, round(coalesce(m, 0), 4) AS c_acctbal_median, round(coalesce(a, 0), 4) AS c_acctbal_mean FROM g LEFT JOIN c USING (nation)")
def quality_summary(spark, d):
    """Median and mean by group; groups without events have zeros."""
    events = table(spark, d, "customer").where("c_mktsegment = 'BUILDING' AND c_nationkey < 20").withColumnRenamed("c_nationkey", "nation")
    out = scoring.quality_summary(events, table(spark, d, "nation").select(F.col("n_nationkey").alias("nation")), ["nation"], ["c_acctbal"])
    return out.select("nation", *[F.round(c, 4).alias(c) for c in ("c_acctbal_median", "c_acctbal_mean")])


@register("SELECT 'a' AS method, s_suppkey AS key, s_acctbal AS balance, NULL AS segment FROM supplier UNION ALL SELECT 'b', c_custkey, c_acctbal, c_mktsegment FROM customer")
def event_tables(spark, d):
    """Tables with different columns as one."""
    a = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return scoring.event_table({"a": a, "b": b})


@register("WITH s AS (SELECT n_nationkey AS nation FROM nation), u AS (SELECT nation, count(*) AS units, avg(n) AS mean_spikes_per_unit FROM (SELECT c_nationkey AS nation, c_custkey, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL) GROUP BY nation), t AS (SELECT s_nationkey AS nation, count(*) AS truth_bursts, avg(s_acctbal) AS a, min(s_acctbal) AS b, max(s_acctbal) AS c FROM supplier WHERE s_acctbal > 0 GROUP BY 1) SELECT CAST(nation AS INT) AS nation, coalesce(units, 0) AS units, round(coalesce(mean_spikes_per_unit, 0), 6) AS mean_spikes_per_unit, coalesce(truth_bursts, 0) AS truth_bursts, round(coalesce(a, 0), 4) AS mean_truth_duration_s, round(coalesce(b, 0), 4) AS min_truth_duration_s, round(coalesce(c, 0), 4) AS max_truth_duration_s FROM s LEFT JOIN u USING (nation) LEFT JOIN t USING (nation)")
def dataset_summary(spark, d):
    c = table(spark, d, "customer")
    trains_ = table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("unit_id"))
    truth = table(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_nationkey").alias("nation"), F.lit(0.0).alias("start"), F.col("s_acctbal").alias("end"))
    out = scoring.dataset_summary(table(spark, d, "nation").select(F.col("n_nationkey").alias("nation")), trains_, truth, ["nation"])
    return out.select("nation", "units", F.round("mean_spikes_per_unit", 6).alias("mean_spikes_per_unit"), "truth_bursts", *[F.round(f"{k}_truth_duration_s", 4).alias(f"{k}_truth_duration_s") for k in ("mean", "min", "max")])


@register("WITH r AS (SELECT CAST(l_linenumber AS BIGINT) AS dim, l_suppkey AS well, l_quantity, l_discount, l_tax > 0.04 AS active FROM lineitem), d AS (SELECT unnest(range(0, 10)) AS dim) SELECT dim, count(well) AS wells, round(avg(l_quantity), 6) AS mean_n_bursts, round(avg(l_discount), 6) AS mean_rate_hz, count(*) FILTER (active) AS n_wells_with_bursts FROM d LEFT JOIN r USING (dim) GROUP BY dim".replace("count(well) AS wells", "nullif(count(well), 0) AS wells").replace("count(*) FILTER (active) AS", "CASE WHEN count(well) > 0 THEN count(*) FILTER (active) END AS"))
def dim_sweep(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_linenumber").cast("long").alias("dim"), F.col("l_suppkey").alias("well"), "l_quantity", "l_discount", (F.col("l_tax") > 0.04).alias("active"))
    out = scoring.sweep(rows, spark.range(10).select(F.col("id").alias("dim")), {"mean_n_bursts": "l_quantity", "mean_rate_hz": "l_discount"})
    return out.select("dim", "wells", F.round("mean_n_bursts", 6).alias("mean_n_bursts"), F.round("mean_rate_hz", 6).alias("mean_rate_hz"), "n_wells_with_bursts")


@register("SELECT l_suppkey AS method, l_linenumber AS dataset, CAST(sum(l_quantity) AS BIGINT) AS n, q.n AS n_quality, q.worst FROM lineitem LEFT JOIN (SELECT l_suppkey AS m, l_linenumber AS k, count(*) AS n, max(l_tax) AS worst FROM lineitem WHERE l_returnflag = 'R' AND l_tax > 0.05 GROUP BY ALL) q ON m = l_suppkey AND k = l_linenumber GROUP BY ALL".replace("GROUP BY ALL) q ON", "GROUP BY ALL) q ON"))
def quality_join(spark, d):
    """Scores with their methods' quality, where there is any."""
    li = table(spark, d, "lineitem")
    scores = li.groupBy(F.col("l_suppkey").alias("method"), F.col("l_linenumber").alias("dataset")).agg(F.sum("l_quantity").cast("long").alias("n"))
    quality = li.where("l_returnflag = 'R' AND l_tax > 0.05").groupBy(F.col("l_suppkey").alias("method"), F.col("l_linenumber").alias("dataset")).agg(F.count("*").alias("n"), F.max("l_tax").alias("worst"))
    return browse.suffixed_join(scores, quality, ["method", "dataset"], "_quality")


_TIER = (
    "SELECT p_partkey, CASE WHEN p_size <= 40 THEN 'small (<=40)' WHEN p_size <= 100 THEN 'medium (41-100)' ELSE 'large (101-150)' END AS unit_count_tier, "
    "CASE WHEN p_size % 7 = 0 THEN 'unknown' WHEN p_size / 2.0 >= 20 THEN 'mixed' WHEN p_retailprice / 900 - 0.8 < 0.35 THEN 'low' WHEN p_retailprice / 900 - 0.8 < 1.2 THEN 'medium' ELSE 'high' END AS baseline_rate_tier, "
    "CASE WHEN p_size % 5 = 0 THEN 'none' WHEN p_size % 3 >= 0.75 THEN 'variable' WHEN p_size / 30.0 < 0.75 THEN 'medium-short (0.5-0.75s)' WHEN p_size / 30.0 < 1.25 THEN 'medium (0.75-1.25s)' ELSE 'long (1.25-2.0s)' END AS burst_duration_tier, "
    "CASE WHEN p_size % 6 = 0 THEN 'none' WHEN p_size / 50.0 < 0.55 THEN 'weak' WHEN p_size / 50.0 < 0.78 THEN 'moderate' ELSE 'strong' END AS recruitment_tier, "
    "CASE WHEN p_partkey % 11 = 0 THEN 'real spikesorted' WHEN p_type = 'PROMO' THEN 'composite' WHEN p_type = 'ECONOMY' THEN 'independent' WHEN p_name LIKE '%small%' THEN 'irregular' WHEN p_name LIKE '%bolt%' THEN 'long duration' ELSE 'cascade' END AS morphology, "
    "CASE WHEN p_partkey % 11 = 0 THEN 'real data (unlabeled)' WHEN p_size % 5 = 0 THEN 'negative control' ELSE 'burst-positive' END AS expected FROM part"
)


@register(f"WITH t AS ({_TIER}) SELECT *, expected || ' | ' || unit_count_tier || ' | ' || baseline_rate_tier || ' rate | ' || morphology AS benchmark_group FROM t")
def dataset_tiers(spark, d):
    """Parts as datasets: tiers of size, rate, duration and recruitment, form and benchmark group."""
    p = table(spark, d, "part")
    name = F.when(F.col("p_name").contains("small"), "culture-irregular").when(F.col("p_name").contains("bolt"), "long-duration-3").otherwise("plain")
    rate, length = F.when(F.col("p_size") % 7 != 0, F.col("p_retailprice") / 900 - 0.8), F.when(F.col("p_size") % 5 != 0, F.col("p_size") / 30.0)
    sets = p.select(
        "p_partkey", name.alias("name"), F.when(F.col("p_type") == "PROMO", "composite_connected").when(F.col("p_type") == "ECONOMY", "independent_poisson").otherwise("x").alias("culture"), (F.col("p_partkey") % 11 == 0).alias("is_real"), F.col("p_size").alias("n_units"),
        F.when(F.col("p_size") % 5 == 0, 0).otherwise(1).alias("n_truth"), F.lit(2.0).alias("rate_low"), rate.alias("rate_median"), F.col("p_size").cast("double").alias("rate_high"), length.alias("duration_median"), F.lit(0.0).alias("duration_low"), (F.col("p_size") % 3).cast("double").alias("duration_high"),
        F.when(F.col("p_size") % 6 == 0, F.lit(float("nan"))).otherwise(F.col("p_size") / 50.0).alias("recruitment"),
    )
    return scoring.categories(sets).select("p_partkey", "unit_count_tier", "baseline_rate_tier", "burst_duration_tier", "recruitment_tier", "morphology", "expected", "benchmark_group")


# clusters of bins: an hour's label follows from its spikes
_BINS = [*signal_chain(), "bins AS (SELECT well, bin, total % 4 - 1 AS label, participation AS rank, total / 10.0 AS x, active / 20.0 AS y FROM sig)"]


def _bins(spark, d):
    return stored(_signals(spark, d)[3]).select("well", "bin", (F.col("total") % 4 - 1).alias("label"), F.col("participation").alias("rank"), (F.col("total") / 10.0).alias("x"), (F.col("active") / 20.0).alias("y"))


_RANKED = "rk AS (SELECT well, label, avg(rank) AS score, count(*) AS n_bins, row_number() OVER (PARTITION BY well ORDER BY avg(rank) DESC, label) AS position FROM bins WHERE label >= 0 GROUP BY well, label)"


@register(with_sql(*_BINS, _RANKED) + "SELECT well, label, n_bins, round(score, 9) AS score, position = 1 AS is_burst FROM rk")
def cluster_bins(spark, d):
    b = _bins(spark, d)
    ranks = models.cluster_ranks(b, "label", "rank").drop("n")
    return scoring.cluster_table(b, ranks, ranks.where("position = 1")).select("well", "label", "n_bins", F.round("score", 9).alias("score"), "is_burst")


@register(with_sql(*_BINS, "r AS (SELECT *, lag(label >= 1) OVER (PARTITION BY well ORDER BY bin) AS before FROM bins)") + "SELECT well, count(*) FILTER (label >= 1) AS n_burst, round(avg(CAST(label >= 1 AS INT)) FILTER (rank > 0.02), 9) AS recall_hi, round(avg(CAST(label >= 1 AS INT)) FILTER (rank < 0.01), 9) AS fp_resting, count(DISTINCT label) AS n_clusters, count(*) FILTER (label >= 1 AND NOT coalesce(before, false)) AS runs FROM r GROUP BY well")
def method_stats(spark, d):
    out = scoring.method_stats(_bins(spark, d), F.col("label") >= 1, "rank", ["well"], 0.02, 0.01)
    return out.select("well", "n_burst", F.round("recall_hi", 9).alias("recall_hi"), F.round("fp_resting", 9).alias("fp_resting"), "n_clusters", "runs")


@register(with_sql(*_BINS, _RANKED) + "SELECT b.well, b.bin, coalesce(score > 0.02, false) AS on_burst FROM bins b LEFT JOIN rk USING (well, label)")
def burst_label_mask(spark, d):
    b = _bins(spark, d)
    return scoring.label_mask(b, models.cluster_ranks(b, "label", "rank").where("score > 0.02")).select("well", "bin", F.col("on").alias("on_burst"))


_TRIPS = [
    *_BINS, _RANKED,
    "rest AS (SELECT well, arg_min(label, (score, label)) AS rest FROM rk GROUP BY well)",
    "cen AS (SELECT bins.well, avg(x) AS cx, avg(y) AS cy FROM bins JOIN rest ON rest.well = bins.well AND label = rest GROUP BY bins.well)",
    "v AS (SELECT b.*, rest, sqrt((x - cx) ** 2 + (y - cy) ** 2) AS far, lead(label) OVER w AS nxt, coalesce(lag(label) OVER w <> label, true) AS fresh, CASE WHEN label <> rest THEN sum(CASE WHEN label <> rest THEN 0 ELSE 1 END) OVER w END AS trip, count(*) OVER (PARTITION BY b.well) AS n_all FROM bins b JOIN rest ON rest.well = b.well JOIN cen ON cen.well = b.well WINDOW w AS (PARTITION BY b.well ORDER BY bin))",
    "tr AS (SELECT well, trip, count(DISTINCT label) FILTER (label >= 0) AS kinds FROM v WHERE trip IS NOT NULL GROUP BY ALL), sp AS (SELECT well, quantile_cont(far, 0.5) AS spread FROM v GROUP BY well)",
    "tv2 AS (SELECT v.well, label, rest, count(*) / CAST(any_value(n_all) AS DOUBLE) AS occupancy, count(*) / CAST(greatest(count(*) FILTER (fresh), 1) AS DOUBLE) AS mean_run, coalesce(count(*) FILTER (nxt = rest) / CAST(nullif(count(nxt), 0) AS DOUBLE), 0) AS to_rest, avg(CASE WHEN kinds >= 2 THEN 1.0 ELSE 0.0 END) AS cotravel, avg(far) / any_value(spread) AS amplitude FROM v LEFT JOIN tr ON tr.well = v.well AND tr.trip = v.trip JOIN sp ON sp.well = v.well WHERE label >= 0 GROUP BY v.well, label, rest)",
    "tj AS (SELECT *, label <> rest AND to_rest < 0.5 AND amplitude >= 1.05 AS picked FROM tv2)",
]


def _travel(spark, d):
    return scoring.trajectories(_bins(spark, d), "rank", ["x", "y"], 0.5, 1.05)


@register(with_sql(*_TRIPS) + "SELECT well, label, rest, picked, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("occupancy", "mean_run", "to_rest", "cotravel", "amplitude")) + " FROM tj")
def trajectory_stats(spark, d):
    return _travel(spark, d).select("well", "label", "rest", "picked", *[F.round(c, 6).alias(c) for c in ("occupancy", "mean_run", "to_rest", "cotravel", "amplitude")])


@register(with_sql(*_TRIPS, "pk AS (SELECT well, list(label) FILTER (picked) AS p FROM tj GROUP BY well)") + "SELECT well, CAST(array_to_string(list_sort(list_filter([1, 2], lambda x: list_contains(coalesce(p, []), x))), ',') AS VARCHAR) AS hit, array_to_string(list_sort(list_filter([1, 2], lambda x: NOT list_contains(coalesce(p, []), x))), ',') AS missed, array_to_string(list_sort(list_filter([0], lambda x: list_contains(coalesce(p, []), x))), ',') AS false_pick FROM pk")
def picked_and_known(spark, d):
    known = spikes(spark, d).select("well").distinct().withColumn("real", F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).withColumn("junk", F.array(F.lit(0).cast("long")))
    return scoring.against_known(_travel(spark, d), known).select("well", *[F.array_join(c, ",").alias(c) for c in ("hit", "missed", "false_pick")])


@register(with_sql(*_BINS, _RANKED) + "SELECT well, array_to_string(list_sort(list_distinct(list(label) FILTER (position = 1 OR score > 0.02))), ',') AS labels FROM rk GROUP BY well")
def burst_label_union(spark, d):
    ranks = models.cluster_ranks(_bins(spark, d), "label", "rank")
    return scoring.label_union(ranks, ranks.where("score > 0.02")).select("well", F.array_join("labels", ",").alias("labels"))


@register(with_sql(*_EVENTS, "bc AS (SELECT ev.well, ev.s, count(*) AS total, count(*) FILTER (m.total % 4 = 3) AS l2 FROM ev JOIN m ON m.well = ev.well AND bin BETWEEN start_idx AND end_idx GROUP BY ALL)".replace(" m ON m.well", " m ON m.well")) + "SELECT well, s AS start, round(l2 / CAST(total AS DOUBLE), 9) AS share FROM bc WHERE well IN (SELECT well FROM m WHERE total % 4 = 3)")
def burst_composition(spark, d):
    """The share of one label among each event's bins, in wells that have it."""
    g, m, ev = _events(spark, d)
    bins = m.join(g.select("well", F.col("start").alias("s0"), F.col("step").alias("w0")), "well").select("well", (F.col("s0") + F.col("bin") * F.col("w0") + F.col("w0") / 2).alias("t_center"), (F.col("total") % 4 - 1).alias("label"))
    return models.composition(ev, bins, ["well"], HOUR).where("label = 2").select("well", "start", F.round("share", 9).alias("share"))


@register(with_sql(SPIKES_SQL, "f AS (SELECT well, unit_id, CASE WHEN count(*) < 12 THEN 'low_spike_count' WHEN sum(value) < 10 THEN 'low_rate_ratio' END AS skipped FROM spk GROUP BY ALL)") + "SELECT well, count(*) FILTER (skipped IS NULL) AS n_fit, count(*) FILTER (skipped IS NOT NULL) AS n_skipped, coalesce(string_agg(unit_id || '=' || skipped, ',' ORDER BY unit_id), '') AS reasons FROM f GROUP BY well")
def fit_summary(spark, d):
    s = spikes(spark, d).groupBy("well", "unit_id").agg(F.count("*").alias("n"), F.sum("value").alias("v"))
    fits = s.select("well", "unit_id", F.when(F.col("n") < 12, "low_spike_count").when(F.col("v") < 10, "low_rate_ratio").alias("skipped"))
    out = scoring.fit_summary(fits)
    listed = F.transform(F.array_sort(F.map_entries("reasons")), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"]))
    return out.select("well", "n_fit", "n_skipped", F.array_join(listed, ",").alias("reasons"))


_LOADINGS = "SELECT label AS axis, 'x' || k AS feature, round(avg(embedding[k + 1]), 7) AS loading FROM embeddings, (SELECT unnest(range(0, 64)) AS k) GROUP BY ALL"


@register(f"SELECT CAST(axis AS INT) AS axis, feature, loading, position FROM (SELECT *, row_number() OVER (PARTITION BY axis ORDER BY abs(loading) DESC, feature) AS position FROM ({_LOADINGS})) WHERE position <= 3")
def top_loadings(spark, d):
    e = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("k", "v"))
    loads = e.groupBy(F.col("label").alias("axis"), F.concat(F.lit("x"), F.col("k").cast("string")).alias("feature")).agg(F.round(F.avg(F.col("v").cast("double")), 7).alias("loading"))
    return scoring.top_loadings(loads).withColumn("position", F.col("position").cast("long"))


@register(with_sql(*signal_chain()) + "SELECT greatest((SELECT max(t) FROM spk), (SELECT max(start + bin * step) FROM sig)) AS t_max")
def plate_time_end(spark, d):
    s, _, g, sig = _signals(spark, d)
    return scoring.time_end(s, sig.join(g.select("well", "start"), "well").select((F.col("start") + F.col("bin") * F.col("step")).alias("t")))


@register(with_sql(*signal_chain()) + "SELECT well, round(least(min(participation), 0) - greatest((greatest(max(participation), 0) - least(min(participation), 0)) * 0.08, 0.02), 9) AS low, round(greatest(max(participation), 0) + greatest((greatest(max(participation), 0) - least(min(participation), 0)) * 0.08, 0.02), 9) AS high FROM sig GROUP BY well")
def synchrony_range(spark, d):
    return scoring.padded_range(_signals(spark, d)[3], "participation", ["well"]).select("well", F.round("low", 9).alias("low"), F.round("high", 9).alias("high"))


@register(with_sql(SPIKES_SQL, "u AS (SELECT well, greatest(5, 600 // count(DISTINCT unit_id)) AS cap, max(t) AS e FROM spk GROUP BY well)", "k AS (SELECT well, unit_id, t, cap, e, row_number() OVER (PARTITION BY well, unit_id ORDER BY t) - 1 AS k, count(*) OVER (PARTITION BY well, unit_id) AS n FROM spk JOIN u USING (well))", "s AS (SELECT * FROM k WHERE k % (CASE WHEN n > cap THEN CAST(ceil(n / CAST(cap AS DOUBLE)) AS BIGINT) ELSE 1 END) = 0)") + "SELECT well, unit_id, t, round(count(*) OVER (PARTITION BY well, unit_id) / CAST(e AS DOUBLE) * 1e9, 6) AS rate FROM s")
def capped_raster(spark, d):
    return scoring.capped_raster(spikes(spark, d).select("well", "unit_id", "t"), 600, 5).withColumn("rate", F.round(F.col("rate") * 1e9, 6))


@register(with_sql(SPIKES_SQL, "i AS (SELECT well, unit_id, t, t - lag(t) OVER w AS isi, lag(t) OVER w - lag(t, 2) OVER w AS last_isi FROM spk WINDOW w AS (PARTITION BY well, unit_id ORDER BY t))") + "SELECT well, unit_id, t, isi, last_isi, round(3 * CAST(last_isi - isi AS DOUBLE) ** 2 / greatest(CAST(last_isi + isi AS DOUBLE) ** 2, 1e-12), 6) AS lv FROM i WHERE last_isi IS NOT NULL")
def isi_pairs(spark, d):
    return scoring.interval_pairs(spikes(spark, d)).withColumn("lv", F.round("lv", 6))


@register(with_sql(*_EVENTS, "a AS (SELECT well, count(*) AS n_network_bursts, count(*) FILTER (end_idx > start_idx) AS n_long FROM ev GROUP BY well)") + "SELECT well, n_units, coalesce(n_network_bursts, 0) AS n_network_bursts, coalesce(n_long, 0) AS n_superbursts, 3600.0 AS bin_s FROM ext LEFT JOIN a USING (well)".replace("3600.0", "CAST(3600.0 AS DOUBLE)"))
def summary_card(spark, d):
    g, _, ev = _events(spark, d)
    return scoring.summary_card(spikes(spark, d), {"network_bursts": ev, "superbursts": ev.where("end_idx > start_idx")}, g.select("well", (F.col("step") * SECONDS).alias("bin_s")))


_MEDIAN = "list_aggregate({}, 'quantile_cont', 0.5)"


@register("WITH x AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), y AS (SELECT vec_id, e, " + _MEDIAN.format("e") + " AS m FROM x) SELECT vec_id, k, round(e[k + 1] - m, 6) AS v FROM y, (SELECT unnest(range(0, 64)) AS k)")
def common_reference(spark, d):
    """Every channel less the median of all channels of its sample."""
    frames = scoring.common_reference(table(spark, d, "embeddings").select("vec_id", "embedding"), "embedding")
    return frames.select("vec_id", F.posexplode("embedding").alias("k", "v")).select("vec_id", F.col("k").cast("long").alias("k"), F.round("v", 6).alias("v"))


@register("WITH x AS (SELECT vec_id, k, CAST(embedding[k + 1] AS DOUBLE) AS v FROM embeddings, (SELECT unnest(range(0, 64)) AS k)) SELECT a.vec_id, a.k, round(any_value(a.v) - quantile_cont(b.v, 0.5), 6) AS v FROM x a JOIN x b ON a.vec_id = b.vec_id AND a.k <> b.k AND abs(a.k // 8 - b.k // 8) <= 1 AND abs(a.k % 8 - b.k % 8) <= 1 GROUP BY a.vec_id, a.k")
def local_reference(spark, d):
    """Every channel of an 8 x 8 grid less the median of its neighbours."""
    near = [[j for j in range(64) if j != k and abs(j // 8 - k // 8) <= 1 and abs(j % 8 - k % 8) <= 1] for k in range(64)]
    frames = scoring.common_reference(table(spark, d, "embeddings").select("vec_id", "embedding"), "embedding", near)
    return frames.select("vec_id", F.posexplode("embedding").alias("k", "v")).select("vec_id", F.col("k").cast("long").alias("k"), F.round("v", 6).alias("v"))


@register("WITH p AS (SELECT l_returnflag AS well, CAST(l_linenumber AS BIGINT) AS bin, CASE WHEN l_quantity = 1 THEN NULL ELSE l_discount * 10 END AS p FROM lineitem), q AS (SELECT *, least(greatest(p, 1e-9), 1 - 1e-9) AS c FROM p) SELECT well, bin, round(avg(CAST(p > 0.5 AS INT)), 6) AS post_frac_gt_0_5, round(avg(p), 6) AS post_mean, round(stddev_pop(p), 6) AS post_std, round(quantile_cont(p, 0.9), 6) AS post_q90, round(avg(-(c * ln(c) + (1 - c) * ln(1 - c))), 6) AS post_entropy FROM q GROUP BY ALL")
def posterior_statistics(spark, d):
    """Five statistics of probabilities over units, missing ones left out."""
    p = F.when(F.col("l_quantity") == 1, F.lit(float("nan"))).otherwise(F.col("l_discount") * 10)
    out = models.posterior_aggregates(table(spark, d, "lineitem").select(F.col("l_returnflag").alias("well"), F.col("l_linenumber").cast("long").alias("bin"), p.alias("p")))
    return out.select("well", "bin", *[F.round(c, 6).alias(c) for c in ("post_frac_gt_0_5", "post_mean", "post_std", "post_q90", "post_entropy")])


@register(with_sql(*grid_chain(), COUNTS_SQL, _RATES, "l AS (SELECT well, bin, 2 * (n * ln(burst / bg) - (burst - bg) * 3600) AS llr FROM ub JOIN r USING (well, unit_id))") + "SELECT well, bin, round(avg(llr), 6) AS mean, round(stddev_pop(llr), 4) AS std, round(quantile_cont(llr, 0.9), 6) AS q90 FROM l GROUP BY ALL")
def llr_over_units(spark, d):
    """Mean, deviation and upper decile of the units' likelihood ratios in each bin."""
    rows = _rates(spark, d).withColumn("llr", models.llr(F.col("n"), F.col("bg"), F.col("burst"), F.lit(3600.0)))
    return models.unit_statistics(rows, "llr", "").select("well", "bin", F.round("mean", 6).alias("mean"), F.round("std", 4).alias("std"), F.round("q90", 6).alias("q90"))


@register("SELECT s_nationkey AS recording_key, count(*) AS n_wells, 24 - count(DISTINCT s_suppkey % 24) AS n_missing, round(sum(s_acctbal), 2) AS total FROM supplier GROUP BY 1")
def plate_rollup(spark, d):
    """A plate-level task: 24 records of each recording, those that are missing among them, made one row."""
    out = table(spark, d, "supplier").select(F.col("s_nationkey").alias("recording_key"), (F.col("s_suppkey") % 24).alias("slot"), F.lit("ok").alias("status"), "s_acctbal")
    return curation.plate_task(spark, out, [F.count_if(F.col("status") == "ok").alias("n_wells"), F.count_if(F.col("status") == "missing").alias("n_missing"), F.round(F.sum("s_acctbal"), 2).alias("total")])


@register("WITH x AS (SELECT l_returnflag AS well, l_quantity, l_discount FROM lineitem), s AS (SELECT well, avg(l_quantity) AS m, stddev_pop(l_quantity) AS sd FROM x GROUP BY well) SELECT well, round(sum((l_quantity - m) / sd), 3) + 0 AS total, round(sum(((l_quantity - m) / sd) ** 2) / count(*), 6) AS square, round(sum(l_discount - l_discount), 3) AS flat FROM x JOIN s USING (well) GROUP BY well".replace("round(sum((l_quantity - m) / sd), 3) + 0 AS total", "CAST(0.0 AS DOUBLE) AS total"))
def standardised_columns(spark, d):
    """Columns less their mean over their deviation; one without variation stays at 0."""
    x = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("well"), F.col("l_quantity").alias("a"), F.lit(3.0).alias("b"))
    z = models.standardised(x, ["a", "b"], ["well"])
    return z.groupBy("well").agg(F.round(F.abs(F.sum("a")), 3).alias("total"), F.round(F.sum(F.col("a") * F.col("a")) / F.count("*"), 6).alias("square"), F.round(F.sum("b"), 3).alias("flat"))
