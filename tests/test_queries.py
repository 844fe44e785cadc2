"""Registered queries against their SQL on the smallest tables, and the pieces that SQL doesn't reach."""

import glob
import math
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from spikeloom import queries
from spikeloom.functions import order, scalars
from spikeloom.operators import browse, catalog, curation, intervals, models, scoring, smoothing, statuslog
from spikeloom.operators import spikes as trains
from spikeloom.plans import waves
from spikeloom.sources import files, metadata, stores
from spikeloom.streaming import incremental

DATA = "/root/testdata/sf0.001"
QUICK = sorted(set(queries.ORACLES) - {"gaussian_rate", "morph_closing", "local_reference", "common_reference", "corr_matrix", "stream_late_counts"})[::3] + ["valley_merge", "peak_find", "greedy_match", "event_scores", "well_metadata", "status_log", "catalog_append", "ready_topn", "trajectory_stats"]


def value(v):
    if isinstance(v, float) and (math.isnan(v) or v == 0):
        return None if math.isnan(v) else 0.0
    return v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(set(QUICK)))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = queries.QUERIES[name](spark, DATA)
    cur = con.execute(queries.ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted(str([value(v[names.index(c)]) for c in sorted(names)]) for v in cur.fetchall())
    assert sorted(str([value(r[c]) for c in sorted(names)]) for r in df.collect()) == want


def test_smoothing_reflects_as_often_as_needed():
    x = np.array([1.0, 5.0, 2.0])
    y = smoothing.smooth(x, 3.0)
    weights = np.exp(-0.5 * (np.arange(-12, 13) / 3.0) ** 2)
    place = lambda p: (lambda m: m if m < 3 else 5 - m)(p % 6)
    assert np.allclose(y, [sum(w * x[place(k + d)] for w, d in zip(weights / weights.sum(), range(-12, 13))) for k in range(3)])


def test_curation_treats_missing_values_as_passing(spark):
    rows = [(1, 0.9, 0.1, 1.0, -40.0), (2, 0.5, 0.3, 0.01, -5.0), (3, float("nan"), None, 1.0, -40.0)]
    units = spark.createDataFrame(rows, "unit_id int, presence_ratio double, rp_contamination double, firing_rate double, amplitude_median double")
    got = {r.unit_id: r.reasons for r in curation.curate(units).collect()}
    assert got == {1: "", 2: "low_presence_ratio; high_rp_contamination; low_firing_rate; low_amplitude", 3: ""}
    assert {r.reasons for r in curation.curate(units.drop("firing_rate")).where("unit_id = 1").collect()} == {"low_firing_rate"}
    assert curation.curate(units, enabled=False).where("curated").count() == 3


def test_scores_of_empty_sides(spark):
    iv = lambda rows: spark.createDataFrame(rows, "well string, start double, end double")
    truth, found = iv([("a", 0.0, 1.0), ("b", 0.0, 1.0), ("b", 2.0, 3.0)]), iv([("b", 0.2, 0.8), ("b", 0.9, 2.5), ("c", 0.0, 1.0)])
    nan = {r.well: r for r in intervals.detection_scores(found, truth, ["well"]).collect()}
    one = {r.well: r for r in intervals.detection_scores(found, truth, ["well"], empty="one").collect()}
    assert math.isnan(nan["a"].precision) and nan["a"].recall == 0 and math.isnan(nan["c"].recall) and nan["b"].f1 == 1.0
    assert one["a"].precision == 0.0 and one["c"].recall == 0.0 and one["b"].tp == 2


def test_waves_run_every_task_once(spark):
    registry = waves.Registry()
    for name, needs in catalog.TASKS.items():
        fails = "FAILED" if name == "burst_detection" else "COMPLETE"
        registry.add(name, needs, lambda ready, s=fails: ready.select("recording_key", "well_id").withColumn("status", F.lit(s)))
    with pytest.raises(ValueError):
        registry.add("sorting", [], lambda ready: ready)
    wells = spark.createDataFrame([("r", "rec0/well0"), ("r", "rec0/well1")], "recording_key string, well_id string")
    none = spark.createDataFrame([], "recording_key string, well_id string, task string, status string")
    keep = lambda df: spark.createDataFrame(df.collect(), df.schema)
    done = waves.drain(keep(catalog.add_wells(none, wells, list(catalog.TASKS)).select(none.columns)), registry, keep)
    assert {(r.task, r.status) for r in done.collect()} == {(t, "FAILED" if t == "burst_detection" else "COMPLETE") for t in catalog.TASKS}


def test_sources(spark, tmp_path):
    run = tmp_path / "sampleA" / "240131" / "P1" / "Network" / "000012"
    run.mkdir(parents=True)
    (run / "data.raw.h5").write_bytes(b"x" * 10)
    (tmp_path / "sampleA" / "notadate" / "P1" / "Network" / "7").mkdir(parents=True)
    (tmp_path / "sampleA" / "notadate" / "P1" / "Network" / "7" / "data.raw.h5").write_bytes(b"")
    found = files.scan_recordings(spark, str(tmp_path)).collect()
    assert [(r.cache_key, r.file_size) for r in found] == [("sampleA/240131/P1/Network/000012", 10)]
    folder = tmp_path / "ks"
    folder.mkdir()
    np.save(folder / "spike_times.npy", np.array([100, 200, 300]))
    np.save(folder / "spike_clusters.npy", np.array([1, 2, 1]))
    (folder / "params.py").write_text("dat_path = 'x'\nsample_rate = 1000.\n")
    (folder / "cluster_group.tsv").write_text("cluster_id\tgroup\n1\tGood\n2\tnoise\n")
    got = files.read_sorted_folder(spark, str(folder)).collect()
    assert sorted((r.unit_id, r.t) for r in got) == [("cluster_001", 0.1), ("cluster_001", 0.3)]
    (tmp_path / "c.json").write_text('{"k": {"sample_id": "s", "metadata": {"a": "1"}}, "bad": 3}')
    assert [(r.cache_key, r.sample_id) for r in files.read_catalog(spark, str(tmp_path / "c.json")).collect() if r.sample_id] == [("k", "s")]


def test_scalars(spark):
    df = spark.createDataFrame([("rec0000/well007/x", "well007", "007", "1.50", "TRUE", 946684800)], "w string, id string, a string, b string, c string, t long")
    rec, well = scalars.split_well(F.col("w"))
    r = df.select(rec.alias("rec"), well.alias("well"), scalars.well_name(scalars.well_number(F.col("id"))).alias("name"), scalars.coerced(F.col("a")).alias("a"), scalars.coerced(F.col("b")).alias("b"), scalars.coerced(F.col("c")).alias("c"), scalars.unix_iso(F.col("t")).alias("iso"), scalars.split_list(F.lit(" a, ,b")).alias("l")).first()
    assert (r.rec, r.well, r.name, r.a.s, r.b.f, r.c.b, r.iso, r.l) == ("rec0000", "well007/x", "B2", "007", 1.5, True, "2000-01-01T00:00:00Z", ["a", "b"])


def test_quantiles_are_exact(spark):
    r = np.random.default_rng(1)
    groups = {"a": r.normal(size=30_000), "b": np.repeat(r.integers(0, 5, 200), 100).astype(float), "c": np.array([3.0]), "d": np.array([1.0, 2.0]), "e": np.array([np.nan])}
    rows = spark.createDataFrame([(g, float(x)) for g, own in groups.items() for x in own], "well string, x double").repartition(5)
    for q in (0.0, 0.1, 0.5, 0.9, 1.0):
        got = {x.well: x.m for x in order.quantile(rows, F.col("x"), q, ["well"], "m").collect()}
        assert set(got) == set("abcd") and all(math.isclose(got[g], np.quantile(groups[g], q), rel_tol=1e-12, abs_tol=1e-12) for g in got)


def test_smoothing_in_parts(spark, monkeypatch):
    r = np.random.default_rng(2)
    series = {"a": r.normal(size=300), "b": r.normal(size=17), "c": r.normal(size=64), "d": r.normal(size=129)}
    rows = spark.createDataFrame([(w, k, float(v)) for w, own in series.items() for k, v in enumerate(own)], "well string, bin long, x double").repartition(3)
    monkeypatch.setattr(smoothing, "PART", 64)
    got = {(x.well, x.bin): x.y for x in smoothing.gaussian(rows, {"y": "x"}, 4.0).collect()}
    want = {(w, k): v for w, own in series.items() for k, v in enumerate(smoothing.smooth(own, 4.0))}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_valleys_of_long_gaps(spark):
    r = np.random.default_rng(3)
    signal = [("a", k + 0.5, float(v)) for k, v in enumerate(r.random(3000))]
    events = [("a", 0.0, 3.0), ("a", 10.0, 12.0), ("a", 1500.0, 1501.0), ("a", 1501.0, 1502.0), ("a", 2999.0, 3000.0)]
    got = {x.start: x.valley for x in intervals.valleys(spark.createDataFrame(events, "well string, start double, end double"), spark.createDataFrame(signal, "well string, t_center double, x double"), "x", ["well"]).collect()}
    for (_, _, before), (_, start, _) in zip(events, events[1:]):
        inside = [v for _, t, v in signal if before <= t <= start]
        assert got[start] == (min(inside) if inside else None)


def test_irregularity_has_rows_around_intervals_only(spark):
    times = [0.0, 1.0, 3.0, 4.0, 500.0, 501.5]
    grid = spark.createDataFrame([("a", 0.0, 1.0, 1000)], "well string, start double, step double, n_bins long")
    got = {x.bin: (x.cv, x.lv) for x in trains.irregularity(spark.createDataFrame([("a", "u", t) for t in times], "well string, unit_id string, t double"), grid, 5).collect()}
    isi = {math.ceil(b) - 1: b - a for a, b in zip(times, times[1:])}
    want = {k for b in isi for k in range(max(0, b - 2), min(999, b + 2) + 1)}
    assert set(got) == want
    for k in want:
        own = [v for b, v in isi.items() if abs(b - k) <= 2]
        assert abs(got[k][0] - (np.std(own) / np.mean(own) if len(own) > 1 else 0.0)) < 1e-9


def test_chain_starts_and_reasons():
    n = np.array([0, 0, 1, 0, 9, 10, 11, 0, 0, 1] * 20, float)
    slow, fast = models.two_means(n)
    assert abs(slow - 2 / 7) < 1e-9 and abs(fast - 10) < 1e-9 and models.two_means(np.ones(8)) == models.quantile_start(np.ones(8))
    fit = models.fit_counts(n, 0.5, start_from="two_means")
    assert fit["skipped"] is None and fit["lambda_burst"] > 15 and fit["p"][4] > 0.99
    flat = models.fit_counts(np.full(200, 5.0), 0.5, min_ratio=50)
    assert flat["skipped"] == "low_rate_ratio" and flat["lambda_bg"] == 10.0
    assert models.fit_counts(np.zeros(200), 0.5)["skipped"] == "low_spike_count"


def test_waves_that_leave_work_are_errors(spark):
    registry = waves.Registry()
    registry.add("a", [], lambda ready: ready.select("recording_key", "well_id").limit(0).withColumn("status", F.lit("COMPLETE")))
    status = spark.createDataFrame([("r", "w", "a", "NOT_RUN")], "recording_key string, well_id string, task string, status string")
    with pytest.raises(RuntimeError):
        waves.drain(status, registry, lambda df: df)
    registry = waves.Registry()
    registry.add("a", [], lambda ready: ready.select("recording_key", "well_id", F.lit("FAILED").alias("status"), F.lit("why").alias("error")))
    assert [(r.status, r.error) for r in waves.drain(status, registry, lambda df: df).collect()] == [("FAILED", "why")]


def test_binary_settings():
    assert metadata.variant(r"@Variant(\0\0\0\x81\0\0\0\0i\xc5\xe1\xd6)") == str(0x69C5E1D6)
    assert metadata.variant(r"@Variant(\0\0\0\x2\xff\xff\xff\xfe)") == "-2" and metadata.variant("plain") == "plain" and metadata.variant(None) is None
    assert metadata.variant(r"@Variant(\0\0\0\t\0\0\0\x2\0\0\0\x2\0\0\0\x7\0\0\0\x81\0\0\0\0\0\0\0\n)") == "[7,10]"
    assert metadata.variant(r"@Variant(\0\0\0\x43\x1)") == '{"_qt_variant_type":"QColor","raw_hex":"0000004301"}'
    assert metadata.variant(r"@Variant(\0\0\0\t\0\0\0\x1\0\0\0\x05ab)") == '[{"_qt_variant_type":5,"remaining_raw_hex":"6162"}]'
    assert metadata.variant("@Variant(ab)") == '{"_qt_variant_type":null,"raw_hex":"6162"}' and metadata.unescaped(r"\q\x") == b"qx"


def test_status_updates_are_checked(spark):
    wells = spark.createDataFrame([("r", "w")], "recording_key string, well_id string")
    none = spark.createDataFrame([], "seq long, recording_key string, well_id string, task string, status string, config string, output_path string, error string")
    log = statuslog.registered(none, wells, ["a", "b"], 0)
    row = lambda seq, task, status, config=None, path=None, error=None: spark.createDataFrame([(seq, "r", "w", task, status, config, path, error)], none.schema)
    with pytest.raises(ValueError):
        statuslog.updated(log, row(1, "a", "NOT_RUN"))
    with pytest.raises(KeyError):
        statuslog.updated(log, row(1, "c", "RUNNING"))
    for change in (row(1, "a", "RUNNING", "c1", "/early", "x"), row(2, "a", "COMPLETE", "c2", "/out", "x"), row(3, "a", "RUNNING", "c3"), row(4, "a", "FAILED", "c4", "/late", "bad")):
        log = log.unionByName(statuslog.updated(log, change))
    got = {r.task: (r.status, r.config, r.output_path, r.error) for r in statuslog.state(log).collect()}
    assert got == {"a": ("FAILED", "c3", "/out", "bad"), "b": ("NOT_RUN", None, None, None)}
    closure = catalog.cascade(catalog.dag(spark, {"a": [], "b": ["a"]}), spark.sql("SELECT 'a' AS task"))
    assert [r.task for r in statuslog.reset(log, closure, 5, ["FAILED"], ["r"], ["w"]).collect()] == ["a"]
    assert statuslog.reset(log, closure, 5, None, ["other"]).count() == 0 and statuslog.registered(log, wells, ["a", "b", "c"], 6).count() == 1


def test_stores_keep_the_last_whole_version(spark, tmp_path):
    store = stores.ParquetStore(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        store.load()
    store.save(spark.range(3))
    store.append(spark.range(3, 5))
    assert store.load().count() == 5
    (tmp_path / "t" / "v000001" / "p000000").mkdir(parents=True)  # what a failed job leaves
    assert store.load().count() == 5
    store.save(spark.range(1))
    assert store.load().count() == 1


def test_lookups_and_listings(spark):
    recordings = spark.createDataFrame([("k", "s", "240101")], "cache_key string, sample_id string, date string")
    assert browse.one_recording(recordings, "k").count() == 1
    with pytest.raises(KeyError):
        browse.one_recording(recordings, "other")
    with pytest.raises(KeyError):
        metadata.register_wells(spark.createDataFrame([], "cache_key string, well_id string, metadata map<string,string>"), recordings, spark.createDataFrame([("x", "w", {})], "cache_key string, well_id string, metadata map<string,string>"))
    empty = spark.createDataFrame([], "path string")
    assert browse.root_layout(empty, "/r").first().layout == "root" and browse.sorted_folders(empty).count() == 0


def test_scores_without_events(spark):
    none = spark.createDataFrame([], "well string, start double, end double")
    truth = spark.createDataFrame([("b", 0.0, 1.0)], none.schema)
    durations = spark.createDataFrame([("a", 60.0), ("b", 60.0)], "well string, duration double")
    got = {r.well: r for r in scoring.score_events(none, truth, durations, ["well"]).collect()}
    assert (got["a"].precision, got["a"].recall, got["a"].f1, got["a"].coverage_f1, got["a"].split_or_miss_flag) == (1.0, 1.0, 1.0, 1.0, False)
    assert (got["b"].precision, got["b"].recall, got["b"].count_error, got["b"].missed_rate, got["b"].split_or_miss_flag) == (0.0, 0.0, -1, 1.0, True)


def test_late_rows_are_dropped(spark, tmp_path):
    for k, hours in enumerate([[0, 1, 50], [2, 51]]):
        spark.createDataFrame([(h,) for h in hours], "h int").selectExpr("timestamp_seconds(h * 3600) AS t", "'x' AS k").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("t timestamp, k string").parquet(str(tmp_path / "in"))
        assert k or incremental.drain(incremental.window_counts(stream, "t", ["k"], "1 hour", "10 hours")).count() >= 0
    seen = []
    incremental.new_files(spark, "t timestamp, k string", str(tmp_path / "in"), str(tmp_path / "state"), lambda batch, _: seen.append(batch.count()))
    incremental.new_files(spark, "t timestamp, k string", str(tmp_path / "in"), str(tmp_path / "state"), lambda batch, _: seen.append(batch.count()))
    assert sum(seen) == 5


def test_tasks_with_settings_run_serially(spark):
    registry, seen = waves.Registry(), []
    run = lambda ready, word: (seen.append(word), ready.select("recording_key", "well_id").withColumn("status", F.lit("COMPLETE")))[1]
    registry.add("a", [], run, {"word": "x"})
    registry.add("b", [], run, {"word": "x"}, {"word": "y"})
    with pytest.raises(ValueError):
        registry.add("c", [], run, {"word": "x"}, {"other": 1})
    status = spark.createDataFrame([("r", "w", t, "NOT_RUN") for t in "ab"], "recording_key string, well_id string, task string, status string")
    done = waves.drain(status, registry, lambda df: spark.createDataFrame(df.collect(), df.schema), serial=True)
    assert seen == ["x", "y"] and {r.status for r in done.collect()} == {"COMPLETE"}


def test_curated_files_and_tables(spark, tmp_path):
    (tmp_path / "w1").mkdir()
    np.savez(tmp_path / "w1" / "curated.npz", u1=np.array([2.0, -1.0, np.nan, 1.0]), u2=np.array([]))
    assert sorted((r.unit_id, r.t) for r in files.read_curated(spark, str(tmp_path / "w1")).collect()) == [("u1", 1.0), ("u1", 2.0)]
    stores.write_tables({"a": spark.range(2), "b": spark.range(3)}, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "b")).count() == 3


def test_mixture_typing(spark):
    r = np.random.default_rng(4)
    rows = [("w", float(k), k + 0.5, float(v), float(u)) for k, (v, u) in enumerate(np.concatenate([r.normal(0, 0.1, (20, 2)), r.normal(5, 0.1, (20, 2))]))]
    events = spark.createDataFrame(rows, "well string, start double, end double, x double, y double")
    for method in ("kmeans", "mixture"):
        got = models.burst_types(events, ["x", "y"], method=method, max_k=3).toPandas().sort_values("start")
        assert got.burst_type[:20].nunique() == 1 and got.burst_type.iloc[0] != got.burst_type.iloc[-1] or method == "mixture" and got.k.iloc[0] >= 2


def test_repeated_intervals_match_one_by_one(spark):
    found = spark.createDataFrame([("w", 0.0, 1.0), ("w", 0.0, 1.0), ("w", 5.0, 6.0)], "well string, start double, end double")
    truth = spark.createDataFrame([("w", 0.0, 1.1), ("w", 0.0, 1.2), ("v", 0.0, 1.0), ("v", 0.0, 1.0)], "well string, start double, end double")
    for order in ("largest", "earliest"):
        assert intervals.greedy_matches(found, truth, ["well"], 0.03, order).count() == 2
    scores = {r.well: r for r in scoring.score_events(found, truth, spark.createDataFrame([("w", 0.0)], "well string, duration double"), ["well"]).collect()}
    assert (scores["w"].true_positive_events, scores["w"].false_positive_events, scores["w"].event_rate_per_min) == (2, 1, 0.0)
    assert (scores["v"].truth_bursts, scores["v"].recall, scores["v"].truth_rate_per_min) == (2, 0.0, 0.0)


def test_levels_that_are_left_out_are_gone(spark, tmp_path):
    events = spark.createDataFrame([(0.0, 1.0)], "start double, end double")
    folder = f"file://{tmp_path}/events"
    files.write_events({"network_bursts": events, "superbursts": events}, folder, {"metrics": events.withColumn("n", F.lit(3))})
    files.write_events({"network_bursts": events.union(events)}, folder)
    assert [(r.level, r.n) for r in files.read_events(spark, folder).groupBy("level").agg(F.count("*").alias("n")).collect()] == [("network_bursts", 2)]
    assert files.read_extra(spark, folder, "metrics").first().n == 3


def test_well_names_past_the_alphabet(spark):
    rows = spark.createDataFrame([(0,), (7,), (155,), (156,), (26 * 6 + 6 * 27,), (None,)], "n int")
    assert [r.name for r in rows.select(scalars.well_name(F.col("n")).alias("name")).collect()] == ["A1", "B2", "Z6", "AA1", "BB1", "?"]


def test_iso_times_without_an_end(spark):
    rows = spark.createDataFrame([(946684799,), (946684800,), (4102444801,), (946684800 + 9_000_000 * 86400,)], "t long")
    got = rows.select(scalars.unix_iso(F.col("t")).alias("a"), scalars.unix_iso(F.col("t"), None).alias("b")).collect()
    assert [tuple(r) for r in got] == [(None, None), ("2000-01-01T00:00:00Z",) * 2, (None, "2100-01-01T00:00:01Z"), (None, "26641-03-01T00:00:00Z")]


def test_units_on_a_limit_pass_in_any_order(spark, tmp_path):
    taxes = np.random.default_rng(0).integers(0, 9, 42)
    while taxes.sum() != 180:  # a mean of exactly 0.15 / 3.5
        k = np.random.default_rng(int(taxes.sum())).integers(42)
        taxes[k] = min(8, taxes[k] + 1) if taxes.sum() < 180 else max(0, taxes[k] - 1)
        taxes = np.roll(taxes, 1)
    orders = [np.random.default_rng(seed).permutation(taxes) / 100 for seed in range(200)]
    assert any(np.cumsum(x)[-1] / 42 * 3.5 > 0.15 for x in orders)  # summed as they come
    rows = [("A", 1 + seed, 30.0, 50_000.0, float(v), 1) for seed, x in enumerate(orders) for v in x]
    spark.createDataFrame(rows, "l_returnflag string, l_suppkey long, l_quantity double, l_extendedprice double, l_tax double, n int").coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r.reasons.replace("low_firing_rate", "").strip("; ") for r in queries.QUERIES["curation_flags"](spark, str(tmp_path)).collect()}
    assert got == {""}
    assert {r.reason for r in queries.QUERIES["rejection_reasons"](spark, str(tmp_path)).collect()} <= {"low_firing_rate"}
    assert all(r.n_total == 200 and r.n_curated in (0, 20) for r in queries.QUERIES["curation_summary"](spark, str(tmp_path)).collect())
    odd = spark.createDataFrame([(1, 0.1), (1, 0.2), (1, None), (2, None), (3, float("nan")), (3, 1.0), (4, 1e300), (4, 1e300), (5, 1 / 3)], "k int, x double")
    means = {r.k: r.m for r in odd.groupBy("k").agg(scalars.exact_avg(F.col("x")).alias("m")).collect()}
    assert abs(means[1] - 0.15) < 1e-15 and means[2] is None and math.isnan(means[3]) and means[4] == 1e300 and means[5] == 1 / 3


def test_wells_of_one_id_keep_their_own_fields(spark, tmp_path):
    rows = [(2, "one", 7, 1.5), (99, "two", 7, 2.5), (3, "odd", 7, 3.5)]  # 99 % 97 is 2 as well
    spark.createDataFrame(rows, "s_suppkey long, s_name string, s_nationkey long, s_acctbal double").write.parquet(str(tmp_path / "supplier.parquet"))
    got = sorted((r.well_id, r.value) for r in queries.QUERIES["well_metadata"](spark, str(tmp_path)).collect() if r.key in ("groupname", "Media"))
    assert got == [("well002", "1.5"), ("well002", "2.5"), ("well002", "one"), ("well002", "two")]


def test_status_rows_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    from spikeloom.functions import lineage

    rows = [(k // 3, k % 3, k, 11.0, "A", "O") for k in range(900)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_returnflag string, l_linestatus string").write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(lineage, "ROWS", 50)
    for name in ("matrix_filter", "ready_counts", "progress_bar", "status_pivot", "completed_wells", "well_rec_names"):
        plan = queries.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY_NUM") == 1 and ", 18), REPARTITION_BY_NUM" in plan, name
        assert plan.count("Exchange hashpartitioning(") == (2 if name == "ready_counts" else 1), name


def test_queue_and_totals_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    from spikeloom.functions import lineage

    rows = [(k // 3, k % 3, k, 11.0, "A", "O") for k in range(900)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_returnflag string, l_linestatus string").write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = spark.createDataFrame([(k, k % 7, 1.0, "1-URGENT") for k in range(300)], "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string")
    orders.withColumn("o_orderdate", F.lit("1996-01-01").cast("timestamp_ntz")).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(lineage, "ROWS", 50)
    for name, by_samples in (("ready_queue", 0), ("kpi_totals", 1)):
        df = queries.QUERIES[name](spark, str(tmp_path))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("REPARTITION_BY_NUM") == 1 and ", 18), REPARTITION_BY_NUM" in plan, name
        assert plan.count("Exchange hashpartitioning(") == 1 + by_samples, name  # wells are sorted and counted where they are dealt
    got = df.first()
    assert (got.n_recordings, got.n_samples, got.n_wells, got.n_tasks) == (300, 7, 900, 6300)


def test_updates_meet_the_log_in_one_shuffle(spark):
    schema = "seq long, recording_key string, well_id string, task string, status string, config string, output_path string, error string"
    log = spark.createDataFrame([(0, "r", "w", "a", "NOT_RUN", None, None, None), (1, "r", "w", "a", "RUNNING", "c1", "/p", None), (0, "r", "v", "a", "NOT_RUN", None, None, None)], schema)
    out = statuslog.updated(log, spark.createDataFrame([(2, "r", "w", "a", "FAILED", "c2", None, "bad")], schema))
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(")
    assert exchanges(out) == 1 and exchanges(statuslog.state(log)) == 1
    assert [tuple(r) for r in out.collect()] == [(2, "r", "w", "a", "FAILED", "c1", "/p", "bad")]
    fresh = statuslog.registered(log, spark.createDataFrame([("q", "w")], "recording_key string, well_id string"), ["a", "b"], 3)
    assert exchanges(fresh) == 1 and sorted((r.recording_key, r.well_id, r.task) for r in fresh.collect()) == [("q", "w", "a"), ("q", "w", "b"), ("r", "v", "b"), ("r", "w", "b")]


def test_units_stay_in_their_tasks(spark):
    rows = spark.createDataFrame([("a", f"u{k % 5}", float(k)) for k in range(200)], "well string, unit_id string, t double")
    grid = spark.createDataFrame([("a", 0.0, 1.0, 200)], "well string, start double, step double, n_bins long")
    plan = trains.irregularity(rows, grid, 5)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "REPARTITION_BY_NUM" in plan and "hashpartitioning(well#" in plan
    assert not any("hashpartitioning(well" in line and "unit_id" not in line for line in plan.splitlines())  # never by well alone


def test_appended_rows_are_made_once(spark, tmp_path):
    schema = "seq long, recording_key string, well_id string, task string, status string, config string, output_path string, error string"
    log = spark.createDataFrame([(0, "r", "w", "a", "NOT_RUN", None, None, None), (1, "r", "w", "a", "RUNNING", "c1", "/p", None)], schema)
    change = lambda task, status: spark.createDataFrame([(2, "r", "w", task, status, "c2", None, "bad")], schema)
    out = statuslog.appended(log, change("a", "FAILED"), str(tmp_path / "one"))
    assert [tuple(r) for r in out.collect()] == [(2, "r", "w", "a", "FAILED", "c1", "/p", "bad")] == [tuple(r) for r in statuslog.updated(log, change("a", "FAILED")).collect()]
    assert out.columns == log.columns and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(KeyError):
        statuslog.appended(log, change("b", "FAILED"), str(tmp_path / "two"))
    with pytest.raises(ValueError):
        statuslog.appended(log, change("a", "NOT_RUN"), str(tmp_path / "three"))
