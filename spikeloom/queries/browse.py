"""Catalog and status views over the star schema: orders are recordings, order lines wells with tasks; listings are made of their keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from spikeloom.functions.lineage import dealt
from spikeloom.operators import browse, catalog
from spikeloom.sources import files, stores
from spikeloom.streaming import incremental

from .common import table
from .reports import _DAG, _REC, _STATUS, _recordings, _status

QUERIES, ORACLES = {}, {}
_TASKS = list(catalog.TASKS)


def register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@register(f"WITH {_REC} SELECT * FROM rec WHERE sample_id >= 100 AND scan_type LIKE '%LOW%'")
def select_by(spark, d):
    """The older one-filter call, twice, with its arguments in either order."""
    return browse.select_by(browse.select_by(_recordings(spark, d), ">=", "sample_id", 100), "scan_type", "contain", "LOW")


@register(f"WITH {_REC} SELECT * FROM rec WHERE cache_key = (SELECT max(o_orderkey) FROM orders)")
def recording_lookup(spark, d):
    recordings = _recordings(spark, d)
    return browse.one_recording(recordings, recordings.agg(F.max("cache_key")).first()[0])


@register(f"WITH {_STATUS} SELECT recording_key, well_id, task, status FROM st WHERE recording_key IN (1, 2, 3, 5, 8) AND well_id IN (1, 2, 3, 4)")
def entry_filter(spark, d):
    return browse.entries(browse.entries(_status(spark, d), [1, 2, 3, 5, 8], [1, 2, 3, 4]), [], None).select("recording_key", "well_id", "task", "status")


@register(f"WITH {_STATUS} SELECT which, recording_key, well_id FROM (SELECT 'incomplete' AS which, recording_key, well_id FROM st WHERE status <> 'COMPLETE' UNION SELECT 'running', recording_key, well_id FROM st WHERE status = 'RUNNING' UNION SELECT 'failed', recording_key, well_id FROM st WHERE status = 'FAILED')")
def matrix_filter(spark, d):
    return browse.matrix_rows(_status(spark, d), "incomplete", "running", "failed")


@register(f"WITH {_STATUS} SELECT recording_key, well_id FROM st WHERE task IN ('auto_curation', 'ml_burst_detection') AND status = 'COMPLETE' GROUP BY ALL HAVING count(DISTINCT task) = 2")
def completed_wells(spark, d):
    return browse.complete_wells(_status(spark, d), ["auto_curation", "ml_burst_detection"])


_PATH = "'/out/' || recording_key || '/rec0000/' || well_id || '/auto_curation'"


@register(
    f"WITH {_STATUS}, f AS (SELECT DISTINCT '/out/' || l_orderkey || '/rec0000/' || l_linenumber || '/auto_curation' AS path FROM lineitem WHERE l_quantity > 10), m AS (SELECT recording_key, well_id, {_PATH} AS path FROM st WHERE task = 'auto_curation' AND status = 'COMPLETE') "
    "SELECT recording_key, count(*) FILTER (f.path IS NOT NULL) AS n_files, count(*) FILTER (f.path IS NULL) AS n_skipped, min(m.path) FILTER (f.path IS NOT NULL) AS first_path FROM m LEFT JOIN f USING (path) GROUP BY recording_key"
)
def input_manifest(spark, d):
    """Paths of complete wells whose file is there, by recording, with those that are skipped counted."""
    li = table(spark, d, "lineitem").where("l_quantity > 10")
    there = li.select(browse.output_path("/out", F.col("l_orderkey"), F.lit("rec0000"), F.col("l_linenumber"), F.lit("auto_curation")).alias("path"))
    rows = browse.manifest(_status(spark, d), there, "auto_curation", browse.output_path("/out", F.col("recording_key"), F.lit("rec0000"), F.col("well_id"), F.lit("auto_curation")))
    return rows.groupBy("recording_key").agg(F.count_if("exists").alias("n_files"), F.count_if(~F.col("exists")).alias("n_skipped"), F.min(F.when(F.col("exists"), F.col("path"))).alias("first_path"))


@register(f"WITH {_REC}, {_STATUS} SELECT r.*, s.*, CAST(floor(100.0 * n_complete / n_tasks) AS BIGINT) AS pct FROM (SELECT count(*) AS n_recordings, count(DISTINCT sample_id) AS n_samples FROM rec) r, (SELECT count(DISTINCT (recording_key, well_id)) AS n_wells, count(*) AS n_tasks, count(*) FILTER (status = 'COMPLETE') AS n_complete FROM st) s")
def kpi_totals(spark, d):
    return browse.totals(_recordings(spark, d), _status(spark, d))


@register(f"WITH {_STATUS} SELECT task, " + ", ".join(f"count(*) FILTER (status = '{s}') AS {s.lower()}" for s in catalog.STATES) + " FROM st GROUP BY task")
def task_status_counts(spark, d):
    return browse.task_counts(_status(spark, d))


@register(f"WITH {_REC} SELECT sample_id, count(*) AS n, min((date, cache_key))[1] AS first_date, min((date, cache_key))[2] AS first_cache_key FROM rec GROUP BY sample_id".replace("min((date, cache_key))[1]", "min(date)").replace("min((date, cache_key))[2]", "arg_min(cache_key, (date, cache_key))"))
def recordings_per_sample(spark, d):
    return browse.per_sample(_recordings(spark, d), ["date", "cache_key"])


@register(f"WITH {_STATUS} SELECT recording_key, " + ", ".join(f"round(count(*) FILTER (status = '{s}') / CAST(count(DISTINCT well_id) * 7 AS DOUBLE), 9) AS {n}" for s, n in (("COMPLETE", "done"), ("RUNNING", "running"), ("FAILED", "failed"))) + " FROM st GROUP BY recording_key")
def progress_bar(spark, d):
    return browse.progress(_status(spark, d), len(_TASKS)).select("recording_key", *[F.round(c, 9).alias(c) for c in ("done", "running", "failed")])


@register(f"WITH {_REC} SELECT *, (SELECT count(*) FROM rec) AS total FROM rec ORDER BY sample_id, date, cache_key LIMIT 25")
def recordings_preview(spark, d):
    return browse.preview(_recordings(spark, d), ["sample_id", "date", "cache_key"])


@register(f"WITH {_STATUS}, m AS (SELECT recording_key, well_id, " + ", ".join(f"coalesce(max(status) FILTER (task = '{t}'), '—') AS {t}" for t in _TASKS) + " FROM st GROUP BY ALL) SELECT *, (SELECT count(*) FROM m) AS total FROM m ORDER BY recording_key, well_id LIMIT 25")
def matrix_preview(spark, d):
    return browse.preview(catalog.matrix(_status(spark, d), _TASKS), ["recording_key", "well_id"])


@register(f"WITH {_REC} SELECT 'scan_type' AS name, scan_type AS value FROM rec UNION SELECT 'date', date FROM rec")
def distinct_options(spark, d):
    return browse.options(_recordings(spark, d), "scan_type", "date")


_QUEUED = "k AS (SELECT DISTINCT l_orderkey AS recording_key, l_linenumber AS well_id FROM lineitem WHERE l_quantity < 40), w AS (SELECT DISTINCT l_orderkey AS recording_key, l_linenumber AS well_id FROM lineitem), f AS (SELECT * FROM w EXCEPT SELECT * FROM k)"


def _queued(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("recording_key"), F.col("l_linenumber").alias("well_id"), "l_quantity")
    return li.where("l_quantity < 40").select("recording_key", "well_id", F.lit("sorting").alias("task")), li.drop("l_quantity")


@register(f"WITH {_QUEUED} SELECT count(*) AS n_wells, count(DISTINCT recording_key) AS n_recordings, count(DISTINCT recording_key) FILTER (recording_key NOT IN (SELECT recording_key FROM k)) AS n_new_recordings FROM f")
def queue_counts(spark, d):
    return browse.queue(*_queued(spark, d), _TASKS)[1]


@register(f"WITH {_QUEUED} SELECT recording_key, well_id, task, 'NOT_RUN' AS status FROM f, (VALUES {', '.join(f"('{t}')" for t in _TASKS)}) t(task)")
def queue_insert(spark, d):
    return browse.queue(*_queued(spark, d), _TASKS)[0]


@register(f"WITH {_QUEUED} SELECT recording_key, well_id, task, 'NOT_RUN' AS status FROM w, (VALUES {', '.join(f"('{t}')" for t in _TASKS)}) t(task) WHERE recording_key NOT IN (SELECT recording_key FROM k)")
def auto_queue(spark, d):
    return browse.auto_queue(*_queued(spark, d), _TASKS)


@register(f"WITH RECURSIVE {_STATUS}, {_DAG}, r(task) AS (SELECT 'sorting' UNION SELECT dag.task FROM r JOIN dag ON dag.dep = r.task) SELECT task, count(*) AS n FROM st WHERE task IN (SELECT task FROM r) AND status IN ('FAILED', 'RUNNING') GROUP BY task")
def would_reset(spark, d):
    closure = catalog.cascade(catalog.dag(spark), spark.sql("SELECT 'sorting' AS task"))
    return browse.would_reset(_status(spark, d), closure, ["FAILED", "RUNNING"])


# listings
_LIST = "l AS (SELECT DISTINCT '/data/' || CASE WHEN l_orderkey % 50 = 0 THEN 'out' ELSE 'curated' END || '/k' || l_orderkey || '/rec' || l_linenumber % 2 || '/well' || l_linenumber || '/' || CASE l_returnflag WHEN 'A' THEN 'burst_detection' WHEN 'N' THEN 'auto_curation' ELSE 'logs' END || '/x.parquet' AS path FROM lineitem)"


def _paths(spark, d):
    kind = F.when(F.col("l_returnflag") == "A", "burst_detection").when(F.col("l_returnflag") == "N", "auto_curation").otherwise("logs")
    top = F.when(F.col("l_orderkey") % 50 == 0, "out").otherwise("curated")
    text = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    return table(spark, d, "lineitem").select(F.concat_ws("/", F.lit("/data"), top, text("k", F.col("l_orderkey")), text("rec", F.col("l_linenumber") % 2), text("well", F.col("l_linenumber")), kind, F.lit("x.parquet")).alias("path"))


def _listing(spark, d):
    return _paths(spark, d).distinct()


_WELLS = "split_part(path, '/', 4) AS recording_key, split_part(path, '/', 5) AS rec_name, split_part(path, '/', 6) AS well_id"


@register(f"WITH {_LIST} SELECT DISTINCT {_WELLS} FROM l WHERE split_part(path, '/', 7) = 'burst_detection'")
def tree_wells(spark, d):
    return browse.tree_wells(_listing(spark, d), "burst_detection")


@register(
    f"WITH {_LIST}, t AS (SELECT DISTINCT {_WELLS}, split_part(path, '/', 7) AS source FROM l) SELECT recording_key, well_id, rec_name, source FROM (SELECT *, row_number() OVER (PARTITION BY recording_key, well_id ORDER BY CASE source WHEN 'burst_detection' THEN 1 ELSE 2 END, rec_name) AS r FROM t WHERE source IN ('burst_detection', 'auto_curation')) WHERE r = 1"
)
def well_rec_names(spark, d):
    """Repeated paths of the listing are left in: the first recording of a well is the same."""
    sources = ["burst_detection", "auto_curation"]
    trees = browse.tree_parts(_paths(spark, d), sources)
    return browse.first_recording(dealt(trees, table(spark, d, "lineitem"), "recording_key", "well_id"), sources)


_KS = "k AS (SELECT DISTINCT '/ks/' || l_suppkey || '/s' || l_linenumber || '/' || CASE l_partkey % 4 WHEN 0 THEN 'spike_times.npy' WHEN 1 THEN 'spike_clusters.npy' WHEN 2 THEN 'params.py' ELSE 'cur/curated_spike_times.npy' END AS path FROM lineitem)"
_KS_DIRS = "f AS (SELECT regexp_replace(path, '/[^/]*$', '') AS folder FROM k WHERE path NOT LIKE '%curated%' GROUP BY 1 HAVING count(DISTINCT path) = 3)"


def _sorted_listing(spark, d):
    r = F.col("l_partkey") % 4
    name = F.when(r == 0, "spike_times.npy").when(r == 1, "spike_clusters.npy").when(r == 2, "params.py").otherwise("cur/curated_spike_times.npy")
    return table(spark, d, "lineitem").select(F.concat(F.lit("/ks/"), F.col("l_suppkey").cast("string"), F.lit("/s"), F.col("l_linenumber").cast("string"), F.lit("/"), name).alias("path")).distinct()


@register(f"WITH {_KS}, {_KS_DIRS} SELECT folder FROM f")
def sorted_folders(spark, d):
    return browse.sorted_folders(_sorted_listing(spark, d))


@register(f"WITH {_KS}, {_KS_DIRS}, c AS (SELECT path FROM k WHERE path LIKE '%/curated_spike_times.npy') SELECT path, 'curated' AS kind FROM c UNION SELECT folder, 'sorted' FROM f WHERE regexp_replace(folder, '/[^/]*$', '') NOT IN (SELECT regexp_replace(path, '/[^/]*/[^/]*$', '') FROM c)")
def spike_sources(spark, d):
    return browse.spike_sources(_sorted_listing(spark, d))


@register("WITH p AS (SELECT '/r/' || strftime(o_orderdate, '%y%m%d') || '/x' AS path FROM orders UNION ALL SELECT '/s/S' || o_custkey || '/' || strftime(o_orderdate, '%y%m%d') FROM orders) SELECT 'r' AS root, 'sample' AS layout WHERE EXISTS (SELECT 1 FROM p) UNION ALL SELECT 's', 'root'")
def root_layout(spark, d):
    o = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyMMdd").alias("date"), F.col("o_custkey").cast("string").alias("c"))
    paths = o.select(F.concat(F.lit("/r/"), "date", F.lit("/x")).alias("path")).unionAll(o.select(F.concat(F.lit("/s/S"), "c", F.lit("/"), "date")))
    return browse.root_layout(paths, "/r").withColumn("root", F.lit("r")).unionByName(browse.root_layout(paths, "/s").withColumn("root", F.lit("s")))


@register(f"WITH {_STATUS}, e AS (SELECT recording_key, well_id, '/mnt/' || well_id % 3 || '/' || recording_key || '/' || well_id || CASE WHEN recording_key % 2 = 0 THEN '/tmp' ELSE '' END AS output_path FROM st WHERE task = 'sorting' AND status = 'COMPLETE') SELECT rtrim(left(output_path, length(output_path) - length(recording_key || '/' || well_id)), '/') AS root FROM e WHERE ends_with(output_path, recording_key || '/' || well_id) ORDER BY recording_key, well_id LIMIT 1")
def output_root(spark, d):
    done = _status(spark, d).where("task = 'sorting' AND status = 'COMPLETE'").selectExpr("recording_key", "well_id", "concat('/mnt/', well_id % 3, '/', recording_key, '/', well_id, if(recording_key % 2 = 0, '/tmp', '')) AS output_path")
    return browse.output_root(done, F.concat_ws("/", F.col("recording_key").cast("string"), F.col("well_id").cast("string")))


@register("SELECT s_suppkey, s_nationkey, CASE WHEN s_acctbal > 5000 OR s_nationkey > 20 THEN 'ok' WHEN s_suppkey % 3 = 0 OR s_suppkey % 5 = 0 THEN concat_ws('; ', CASE WHEN s_suppkey % 3 = 0 THEN 'bad signal file' END, CASE WHEN s_suppkey % 5 = 0 THEN 'bad spike file' END) ELSE 'missing' END AS status FROM supplier")
def well_record_status(spark, d):
    s = table(spark, d, "supplier").selectExpr("*", "s_acctbal > 5000 AS has_signal", "s_nationkey > 20 AS has_spikes", "if(s_suppkey % 3 = 0, 'bad signal file', null) AS signal_error", "if(s_suppkey % 5 = 0, 'bad spike file', null) AS spike_error")
    return browse.record_status(s).select("s_suppkey", "s_nationkey", "status")


@register(f"WITH {_REC} SELECT DISTINCT sample_id, date, 'missing' AS side FROM rec WHERE scan_type < '3' AND (sample_id, date) NOT IN (SELECT (sample_id, date) FROM rec WHERE scan_type > '2') UNION ALL SELECT DISTINCT sample_id, date, 'new' FROM rec WHERE scan_type > '2' AND (sample_id, date) NOT IN (SELECT (sample_id, date) FROM rec WHERE scan_type < '3')")
def partition_differences(spark, d):
    """Catalog partitions that are gone from disk, and those on disk that the catalog lacks."""
    rec = _recordings(spark, d)
    known, found = rec.where("scan_type < '3'"), rec.where("scan_type > '2'")
    fresh = files.new_partitions(found, known).select("sample_id", "date").distinct().withColumn("side", F.lit("new"))
    return browse.missing_partitions(known, found).withColumn("side", F.lit("missing")).unionByName(fresh)


@register(f"WITH {_REC} SELECT scan_type, count(*) AS n, count(DISTINCT sample_id) AS n_samples, round(sum(size), 2) AS size FROM rec WHERE cache_key % 2 = 0 OR (sample_id, date) NOT IN (SELECT (sample_id, date) FROM rec WHERE cache_key % 2 = 0) GROUP BY scan_type")
def catalog_append(spark, d):
    """A stored catalog of the even recordings, to which the partitions that it lacks are appended from all."""
    store = stores.ParquetStore(spark, incremental.shared_folder(spark, "catalog"))
    rec = _recordings(spark, d)
    store.save(rec.where("cache_key % 2 = 0"))
    store.append(files.new_partitions(rec, store.load()))
    return store.load().groupBy("scan_type").agg(F.count("*").alias("n"), F.countDistinct("sample_id").alias("n_samples"), F.round(F.sum("size"), 2).alias("size"))


@register("SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 4) AS price FROM part GROUP BY p_brand")
def csv_report(spark, d):
    """A report written as CSV and read back."""
    report = table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"), F.round(F.avg("p_retailprice"), 4).alias("price"))
    folder = incremental.shared_folder(spark, "report")
    stores.write_report(report, folder)
    return stores.read_report(spark, folder, report.schema)


@register("SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY ALL")
def cached_batch(spark, d):
    """Built once and stored under a key of source, method and settings; the second call reads what the first one stored."""
    folder, built = incremental.shared_folder(spark, "results"), []

    def build():
        built.append(1)
        return table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n"))

    for _ in range(2):
        out = stores.load_or_build(spark, folder, d, "counts", {"low": 1}, build)
    if len(built) != 1:
        raise RuntimeError("the stored result was not used")
    return out


@register("SELECT l_partkey AS unit_id, l_suppkey, round(l_extendedprice, 2) AS price, p.p_size AS size_tm, p.p_name, CAST(p_partkey % 7 AS INT) AS loc_x FROM lineitem LEFT JOIN part p ON p_partkey = l_partkey AND p_size > 10".replace("p.p_size AS size_tm", "l_linenumber AS size, p.p_size AS size_tm"))
def metrics_left_join(spark, d):
    """Quality metrics left-joined with template metrics and locations by unit; clashing names get a suffix."""
    quality = table(spark, d, "lineitem").select(F.col("l_partkey").alias("unit_id"), "l_suppkey", F.round("l_extendedprice", 2).alias("price"), F.col("l_linenumber").alias("size"))
    part = table(spark, d, "part").where("p_size > 10")
    template = part.select(F.col("p_partkey").alias("unit_id"), F.col("p_size").alias("size"), "p_name")
    places = part.select(F.col("p_partkey").alias("unit_id"), (F.col("p_partkey") % 7).cast("int").alias("loc_x"))
    return browse.suffixed_join(browse.suffixed_join(quality, template, ["unit_id"], "_tm"), places, ["unit_id"], "_loc")


@register("WITH u AS (SELECT event_type AS well, user_id AS unit_id, count(*) AS n_spikes FROM events GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY well ORDER BY unit_id) - 1 AS k, greatest(count(*) OVER (PARTITION BY well) // 64, 1) AS step FROM u) SELECT well, unit_id, n_spikes FROM k WHERE k % step = 0 AND k / step < 64")
def raster_units(spark, d):
    return browse.ranked_units(table(spark, d, "events").select(F.col("event_type").alias("well"), F.col("user_id").alias("unit_id")), 64)
