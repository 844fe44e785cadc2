"""Catalog, task-status, curation, plate and diagnostic queries over the star schema."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from spikeloom.functions import scalars
from spikeloom.functions.lineage import dealt
from spikeloom.operators import catalog, curation, intervals, models

from .common import table

QUERIES, ORACLES = {}, {}


def register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# orders are recordings, their lines wells, line status and return flag the state of tasks
def _recordings(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("cache_key"), F.col("o_custkey").alias("sample_id"), F.date_format("o_orderdate", "yyMMdd").alias("date"), F.col("o_orderpriority").alias("scan_type"), F.col("o_totalprice").alias("size"))


_REC = "rec AS (SELECT o_orderkey AS cache_key, o_custkey AS sample_id, strftime(o_orderdate, '%y%m%d') AS date, o_orderpriority AS scan_type, o_totalprice AS size FROM orders)"


def _wells(spark, d):
    meta = F.create_map(F.lit("flag"), F.col("l_returnflag"), F.lit("mode"), F.col("l_linestatus"))
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("cache_key"), F.col("l_linenumber").alias("well_id"), meta.alias("metadata"))


_STATE = "CASE (l_partkey + l_linenumber + k * 7) % 5 WHEN 0 THEN 'NOT_RUN' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'RUNNING' ELSE 'COMPLETE' END"
_STATUS = f"st AS (SELECT DISTINCT l_orderkey AS recording_key, l_linenumber AS well_id, k, task, {_STATE} AS status FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL), (VALUES {', '.join(f"({k}, '{t}')" for k, t in enumerate(catalog.TASKS))}) x(k, task))"
_DAG = "dag(task, dep) AS (VALUES " + ", ".join(f"('{t}', '{x}')" for t, deps in catalog.TASKS.items() for x in deps) + ")"


def _status(spark, d):
    """The tasks of every line; a recording's rows are in one partition."""
    li = table(spark, d, "lineitem")
    one = dealt(li.select("l_orderkey", "l_linenumber", "l_partkey"), li, "l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
    tasks = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(t).alias("task")) for k, t in enumerate(catalog.TASKS)]))
    return one.withColumn("x", tasks).selectExpr("l_orderkey", "l_linenumber", "l_partkey", "x.k", "x.task").selectExpr("l_orderkey AS recording_key", "l_linenumber AS well_id", "k", "task", f"{_STATE} AS status")


@register(f"WITH {_REC} SELECT * FROM rec WHERE scan_type = '1-URGENT' AND date >= '960101' AND sample_id <> 7")
def catalog_filter(spark, d):
    return catalog.select_recordings(_recordings(spark, d), [("scan_type", "==", "1-URGENT"), ("date", ">=", "960101"), ("sample_id", "!=", 7)])


@register(f"WITH {_REC} SELECT * FROM rec WHERE scan_type LIKE '%HIGH%' AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = cache_key AND l_returnflag = 'A' AND l_linestatus <> 'O')")
def same_well_exists(spark, d):
    return catalog.select_recordings(_recordings(spark, d), [("scan_type", "contain", "HIGH"), ("wells.flag", "==", "A"), ("wells.mode", "!=", "O")], _wells(spark, d))


@register(f"WITH {_REC} SELECT * FROM rec WHERE cache_key IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def queued_semi(spark, d):
    return catalog.queued(_recordings(spark, d), table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("recording_key")), True)


@register(f"WITH {_REC} SELECT * FROM rec WHERE cache_key NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def queued_anti(spark, d):
    return catalog.queued(_recordings(spark, d), table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("recording_key")), False)


@register(f"WITH {_STATUS} SELECT recording_key, well_id, " + ", ".join(f"coalesce(max(status) FILTER (task = '{t}'), '—') AS {t}" for t in catalog.TASKS) + " FROM st GROUP BY ALL")
def status_pivot(spark, d):
    return catalog.matrix(_status(spark, d), list(catalog.TASKS))


_READY = f"WITH {_STATUS}, {_DAG}, rdy AS (SELECT * FROM st o WHERE status IN ('NOT_RUN') AND NOT EXISTS (SELECT 1 FROM dag LEFT JOIN st p ON p.recording_key = o.recording_key AND p.well_id = o.well_id AND p.task = dag.dep WHERE dag.task = o.task AND coalesce(p.status, '') <> 'COMPLETE'))"


@register(_READY + " SELECT recording_key, well_id, task FROM rdy ORDER BY recording_key, well_id, k LIMIT 100")
def ready_topn(spark, d):
    return catalog.ready_top(_status(spark, d), catalog.dag(spark), ["recording_key", "well_id", "k"], 100).select("recording_key", "well_id", "task")


@register(_READY + " SELECT task, count(*) AS n FROM rdy GROUP BY task")
def ready_counts(spark, d):
    return catalog.ready(_status(spark, d), catalog.dag(spark)).groupBy("task").agg(F.count("*").alias("n"))


@register(f"WITH {_STATUS}, {_DAG} SELECT recording_key, well_id, task FROM (SELECT *, row_number() OVER (PARTITION BY recording_key, well_id ORDER BY k) AS r FROM ({_READY} SELECT * FROM rdy)) WHERE r = 1 ORDER BY recording_key, well_id LIMIT 8")
def ready_queue(spark, d):
    return catalog.first_ready(_status(spark, d), catalog.dag(spark), ["k"], 8).select("recording_key", "well_id", "task")


@register(f"WITH RECURSIVE {_STATUS}, {_DAG}, r(root, task) AS (SELECT task, task FROM (SELECT DISTINCT task FROM st) UNION SELECT r.root, dag.task FROM r JOIN dag ON dag.dep = r.task), c AS (SELECT root, st.task, count(*) FILTER (status <> 'NOT_RUN') AS n FROM r JOIN st ON st.task = r.task GROUP BY ALL) SELECT * FROM c")
def dag_cascade(spark, d):
    st = _status(spark, d)
    closure = catalog.cascade(catalog.dag(spark), spark.createDataFrame([(t,) for t in catalog.TASKS], "task string"))
    counts = st.groupBy("task").agg(F.count_if(F.col("status") != "NOT_RUN").alias("n"))
    return closure.join(counts, "task").select("root", "task", "n")


@register(f"WITH {_STATUS} SELECT task, CASE WHEN task IN ('analyzer', 'auto_curation', 'burst_detection', 'ml_burst_detection') AND status = 'FAILED' THEN 'NOT_RUN' ELSE status END AS status, task IN ('analyzer', 'auto_curation', 'burst_detection', 'ml_burst_detection') AND status = 'FAILED' AS was_reset, count(*) AS n FROM st GROUP BY ALL")
def reset_failed(spark, d):
    closure = catalog.cascade(catalog.dag(spark), spark.sql("SELECT 'analyzer' AS task"))
    return catalog.reset(_status(spark, d), closure, F.col("status") == "FAILED").groupBy("task", "status", "was_reset").agg(F.count("*").alias("n"))


@register(f"WITH {_STATUS} SELECT task, CASE WHEN status = 'COMPLETE' THEN status ELSE 'NOT_RUN' END AS status, count(*) AS n FROM st GROUP BY ALL")
def crash_recovery(spark, d):
    return catalog.recover(_status(spark, d)).groupBy("task", "status").agg(F.count("*").alias("n"))


@register(f"WITH {_STATUS} SELECT recording_key, bool_and(status = 'COMPLETE') AS all_complete, " + ", ".join(f"count(*) FILTER (status = '{s}') AS {s.lower()}" for s in catalog.STATES) + " FROM st GROUP BY ALL")
def recording_progress(spark, d):
    return catalog.completion(_status(spark, d))


@register(f"WITH {_STATUS} SELECT l_orderkey AS recording_key, l_linenumber AS well_id, task, 'NOT_RUN' AS status FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), (SELECT DISTINCT task FROM st) WHERE NOT EXISTS (SELECT 1 FROM st x WHERE x.recording_key = l_orderkey AND x.well_id = l_linenumber AND x.task = st.task AND x.status <> 'FAILED')".replace("(SELECT DISTINCT task FROM st)", "(SELECT DISTINCT task FROM st) st"))
def insert_missing(spark, d):
    have = _status(spark, d).where("status <> 'FAILED'")
    wells = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("recording_key"), F.col("l_linenumber").alias("well_id"))
    return catalog.add_wells(have, wells, list(catalog.TASKS))


@register("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(event_id) FILTER (ts = mts) AS event_id FROM (SELECT *, max(ts) OVER (PARTITION BY user_id) AS mts FROM events) GROUP BY user_id")
def latest_status(spark, d):
    log = table(spark, d, "events").select("user_id", "event_type", "event_id", F.struct("ts", "event_id").alias("seq"))
    return catalog.latest(log, ["user_id"]).select("user_id", "event_type", "event_id")


def _units(spark, d):
    """Suppliers' shipments stand for units, with metrics of like ranges; some values are NaN or null. A metric on its limit passes in whatever order rows are summed."""
    li = table(spark, d, "lineitem")
    return li.groupBy(F.col("l_returnflag").alias("well"), F.col("l_suppkey").alias("unit_id")).agg(
        (scalars.exact_avg(F.col("l_quantity")) / 34).alias("presence_ratio"),
        F.when(F.max("l_tax") > 0, scalars.exact_avg(F.col("l_tax")) * 3.5).alias("rp_contamination"),
        F.when(F.col("l_suppkey") % 10 == 0, F.lit(float("nan"))).otherwise(F.count("*") / 4000.0).alias("firing_rate"),
        (-scalars.exact_avg(F.col("l_extendedprice")) / 1800).alias("amplitude_median"),
    )


_UNITS = "u AS (SELECT l_returnflag AS well, l_suppkey AS unit_id, avg(l_quantity) / 34 AS presence_ratio, avg(l_tax) * 3.5 AS rp_contamination, CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE count(*) / 4000.0 END AS firing_rate, -avg(l_extendedprice) / 1800 AS amplitude_median FROM lineitem GROUP BY l_returnflag, l_suppkey), c AS (SELECT *, concat_ws('; ', CASE WHEN presence_ratio < 0.75 THEN 'low_presence_ratio' END, CASE WHEN rp_contamination > 0.15 THEN 'high_rp_contamination' END, CASE WHEN firing_rate < 0.05 THEN 'low_firing_rate' END, CASE WHEN amplitude_median > -20 THEN 'low_amplitude' END) AS reasons FROM u)"


@register(f"WITH {_UNITS} SELECT well, unit_id, reasons, reasons = '' AS curated FROM c")
def curation_flags(spark, d):
    return curation.curate(_units(spark, d)).select("well", "unit_id", "reasons", "curated")


@register(f"WITH {_UNITS} SELECT well, count(*) AS n_total, count(*) FILTER (reasons = '') AS n_curated, round_even(100.0 * count(*) FILTER (reasons = '') / count(*), 1) AS pct_curated FROM c GROUP BY well")
def curation_summary(spark, d):
    return curation.summary(curation.curate(_units(spark, d)), ["well"])


@register(f"WITH {_UNITS} SELECT well, reason, count(*) AS n FROM (SELECT well, unnest(string_split(reasons, '; ')) AS reason FROM c WHERE reasons <> '') GROUP BY ALL")
def rejection_reasons(spark, d):
    return curation.reason_counts(curation.curate(_units(spark, d)), ["well"])


@register("SELECT l_returnflag AS well, metric, count(x) AS count, round(avg(x), 5) AS mean, round(stddev_samp(x), 5) AS std, min(x) AS min, round(quantile_cont(x, 0.25), 5) AS q25, round(quantile_cont(x, 0.5), 5) AS q50, round(quantile_cont(x, 0.75), 5) AS q75, max(x) AS max FROM (SELECT l_returnflag, 'l_quantity' AS metric, l_quantity AS x FROM lineitem UNION ALL SELECT l_returnflag, 'l_discount', l_discount FROM lineitem) GROUP BY ALL")
def describe_metrics(spark, d):
    out = curation.describe(table(spark, d, "lineitem").withColumnRenamed("l_returnflag", "well"), ["l_quantity", "l_discount"], ["well"])
    return out.select("well", "metric", "count", *[F.round(c, 5).alias(c) for c in ("mean", "std")], "min", *[F.round(c, 5).alias(c) for c in ("q25", "q50", "q75")], "max")


@register("WITH s AS (SELECT s_nationkey AS recording_key, s_suppkey % 24 AS slot, count(*) AS n FROM supplier GROUP BY ALL) SELECT r.recording_key, k.slot, coalesce(CASE WHEN n IS NULL THEN NULL ELSE 'ok' END, 'missing') AS status, n, k.slot // 6 AS row, k.slot % 6 AS col, chr(CAST(65 + k.slot // 6 AS INT)) || CAST(k.slot % 6 + 1 AS VARCHAR) AS name FROM (SELECT DISTINCT recording_key FROM s) r CROSS JOIN (SELECT unnest(range(0, 24)) AS slot) k LEFT JOIN s ON s.recording_key = r.recording_key AND s.slot = k.slot")
def plate_spine(spark, d):
    out = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("recording_key"), (F.col("s_suppkey") % 24).alias("slot")).agg(F.count("*").alias("n"), F.lit("ok").alias("status"))
    return curation.plate(spark, out).select("recording_key", "slot", "status", "n", "row", "col", "name")


@register("SELECT c_mktsegment, (dense_rank() OVER (ORDER BY c_mktsegment) - 1) % 6 AS colour FROM (SELECT DISTINCT c_mktsegment FROM customer)")
def group_colours(spark, d):
    return curation.group_colours(table(spark, d, "customer"), "c_mktsegment").withColumn("colour", F.col("colour").cast("long"))


@register("SELECT c_mktsegment, n_name, count(*) AS n, round(avg(c_acctbal), 4) AS mean FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 2 GROUP BY ALL")
def category_rollup(spark, d):
    nation = table(spark, d, "nation").where("n_regionkey <> 2")
    c = table(spark, d, "customer")
    return c.join(nation, c.c_nationkey == nation.n_nationkey, "left").groupBy("c_mktsegment", "n_name").agg(F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 4).alias("mean"))


def _coordinates(spark, d):
    """All coordinates as an array, and their mean, by which rows are ranked."""
    v = F.col("embedding").cast("array<double>")
    return table(spark, d, "embeddings").select("vec_id", F.col("label").cast("long").alias("label"), v.alias("v"), (F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v)).alias("r"))


_X = "x AS (SELECT vec_id, CAST(label AS BIGINT) AS label, CAST(embedding AS DOUBLE[]) AS v, list_avg(CAST(embedding AS DOUBLE[])) AS r FROM embeddings)"
_LONG = "k AS (SELECT vec_id, r, unnest(range(0, 64)) AS k, unnest(v) AS y FROM x)"


@register(f"WITH {_X}, {_LONG} SELECT 'x' || a.k AS a, 'x' || b.k AS b, round(abs(coalesce(corr(a.y, b.y), 0)), 6) AS r FROM k a JOIN k b ON a.vec_id = b.vec_id AND a.k < b.k GROUP BY a.k, b.k")
def corr_matrix(spark, d):
    """Absolute correlations of all pairs of coordinates, from one pass over the rows."""
    from pyspark.ml.stat import Correlation

    rows = _coordinates(spark, d).select(array_to_vector("v").alias("v"))
    matrix = Correlation.corr(rows, "v").first()[0]  # as many numbers as pairs of coordinates
    cells = [(f"x{i}", f"x{j}", float(matrix[i, j])) for i in range(matrix.numRows) for j in range(i + 1, matrix.numCols)]
    return spark.createDataFrame(cells, "a string, b string, r double").withColumn("r", F.round(F.abs(F.coalesce(F.nanvl("r", F.lit(None)), F.lit(0.0))), 6))


@register(f"WITH {_X}, {_LONG} SELECT 'x' || k AS feature, round(stddev_pop(y), 6) AS spread FROM k GROUP BY k")
def feature_spread(spark, d):
    cells = _coordinates(spark, d).select(F.posexplode("v").alias("k", "y"))
    return cells.groupBy(F.concat(F.lit("x"), F.col("k").cast("string")).alias("feature")).agg(F.round(F.stddev_pop("y"), 6).alias("spread"))


_BG = "q AS (SELECT quantile_cont(r, 0.5) AS cut FROM x), m AS (SELECT k, avg(y) AS m0, stddev_pop(y) AS s0 FROM k, q WHERE r <= cut GROUP BY k)"


@register(f"WITH {_X}, {_LONG}, {_BG} SELECT vec_id, 'x' || k.k AS feature, round((y - m0) / CASE WHEN s0 < 1e-6 THEN 1 ELSE s0 END, 6) AS z FROM k JOIN m USING (k)")
def zscore_background(spark, d):
    """Every coordinate against the rows of the lower half."""
    cells = _coordinates(spark, d).withColumn("well", F.lit(0)).select("well", "vec_id", "r", F.posexplode("v").alias("k", "y"))
    return models.background_normalised(cells, ["y"], "r", by=["k"]).select("vec_id", F.concat(F.lit("x"), F.col("k").cast("string")).alias("feature"), F.round("z_y", 6).alias("z"))


@register(f"WITH {_X}, r AS (SELECT label, avg(r) AS score, count(*) AS n FROM x WHERE label >= 0 GROUP BY label) SELECT label, round(score, 6) AS score, n, row_number() OVER (ORDER BY score DESC, label) AS position FROM r")
def cluster_rank(spark, d):
    out = models.cluster_ranks(_coordinates(spark, d).withColumn("well", F.lit(0)), "label", "r")
    return out.select("label", F.round("score", 6).alias("score"), "n", F.col("position").cast("long").alias("position"))


@register(
    f"WITH {_X}, r AS (SELECT label, avg(r) AS score FROM x WHERE label >= 0 GROUP BY label), h AS (SELECT r FROM x WHERE r <= (SELECT quantile_cont(r, 0.5) FROM x)), b AS (SELECT quantile_cont(r, 0.5) AS med FROM h), s AS (SELECT quantile_cont(abs(r - med), 0.5) AS mad FROM h, b), t AS (SELECT max(score) AS top FROM r) SELECT label, round(score, 6) AS score FROM r, b, s, t WHERE score = top OR score > greatest(med + 3 * greatest(mad, 1e-6), med + 0.25 * (top - med))"
)
def burst_clusters(spark, d):
    return models.burst_clusters(_coordinates(spark, d).withColumn("well", F.lit(0)), "label", "r").select("label", F.round("score", 6).alias("score"))


@register(f"WITH {_X} SELECT vec_id, CASE WHEN r > 0.01 THEN 1 ELSE -1 END AS label, round(least(greatest(r, 0), 1), 6) AS probability FROM x")
def threshold_cluster(spark, d):
    return models.threshold_clusters(_coordinates(spark, d).drop("label"), "r", 0.01).select("vec_id", "label", F.round("probability", 6).alias("probability"))


# orders' price ranges stand for intervals, by customer
_IV = "iv AS (SELECT o_custkey AS well, o_totalprice AS s, o_totalprice + 3000 AS e FROM orders WHERE o_orderkey % 2 = 0), tv AS (SELECT o_custkey AS well, o_totalprice AS s, o_totalprice + 5000 AS e FROM orders WHERE o_orderkey % 2 = 1)"


_ALL = "iv AS (SELECT o_custkey AS well, o_totalprice AS s, o_totalprice + 3000 AS e FROM orders)"


def _iv(spark, d, odd: int | None, width: int):
    """All orders' intervals, or those of one of two sides that are compared."""
    o = table(spark, d, "orders")
    o = o if odd is None else o.where(F.col("o_orderkey") % 2 == odd)
    return o.select(F.col("o_custkey").alias("well"), F.col("o_totalprice").alias("start"), (F.col("o_totalprice") + width).alias("end"))


_UNION = "c AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY well ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS f FROM iv), u AS (SELECT well, min(s) AS s, max(e) AS e FROM (SELECT *, sum(f) OVER (PARTITION BY well ORDER BY s, e) AS g FROM c) GROUP BY well, g)"


@register(f'WITH {_ALL}, {_UNION} SELECT well, round(s, 4) AS start, round(e, 4) AS "end" FROM u')
def interval_union(spark, d):
    return intervals.union(_iv(spark, d, None, 3000), ["well"]).select("well", F.round("start", 4).alias("start"), F.round("end", 4).alias("end"))


@register(f'WITH {_ALL}, {_UNION}, x AS (SELECT well, greatest(s, 0) AS s, least(e, 300000) AS e FROM u WHERE least(e, 300000) > greatest(s, 0) UNION ALL SELECT DISTINCT well, 0, 0 FROM iv), y AS (SELECT well, e AS a, coalesce(lead(s) OVER (PARTITION BY well ORDER BY e), 300000) AS b FROM x) SELECT well, round(a, 4) AS start, round(b, 4) AS "end" FROM y WHERE b > a')
def interval_complement(spark, d):
    iv = _iv(spark, d, None, 3000)
    bounds = iv.select("well").distinct().withColumn("low", F.lit(0.0)).withColumn("high", F.lit(300000.0))
    return intervals.complement(iv, ["well"], bounds).select("well", F.round("start", 4).alias("start"), F.round("end", 4).alias("end"))


@register(f"WITH {_IV} SELECT DISTINCT iv.well, round(iv.s, 4) AS a_start, round(tv.s, 4) AS b_start, round(least(iv.e, tv.e) - greatest(iv.s, tv.s), 4) AS overlap, round((least(iv.e, tv.e) - greatest(iv.s, tv.s)) / (greatest(iv.e, tv.e) - least(iv.s, tv.s)), 6) AS iou FROM iv JOIN tv ON iv.well = tv.well AND least(iv.e, tv.e) - greatest(iv.s, tv.s) >= 100")
def overlap_join_iou(spark, d):
    out = intervals.overlaps(_iv(spark, d, 0, 3000), _iv(spark, d, 1, 5000), ["well"], 100.0, 20_000).drop("a_copy", "b_copy").distinct()
    return out.select("well", F.round("a_start", 4).alias("a_start"), F.round("b_start", 4).alias("b_start"), F.round("overlap", 4).alias("overlap"), F.round("iou", 6).alias("iou"))


@register("SELECT p_partkey, regexp_extract(p_brand, '(\\d+)$', 1) AS digits, CAST(nullif(regexp_extract(p_brand, '(\\d+)$', 1), '') AS INT) AS number, substr(sha1(p_name), 1, 16) AS hash, 'unit_' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') AS padded, least(greatest(p_retailprice, 950.0), 1100.0) AS clamped, split_part(p_type, ' ', 1) || '/' || p_brand AS compound FROM part")
def scalar_functions(spark, d):
    p = table(spark, d, "part")
    return p.select(
        "p_partkey", F.regexp_extract("p_brand", r"(\d+)$", 1).alias("digits"), scalars.well_number(F.col("p_brand")).alias("number"), scalars.short_hash(F.col("p_name")).alias("hash"),
        scalars.padded_id("unit_", F.col("p_partkey") % 1000).alias("padded"), scalars.clamp(F.col("p_retailprice"), 950.0, 1100.0).alias("clamped"), scalars.compound_key(F.split_part("p_type", F.lit(" "), F.lit(1)), F.col("p_brand")).alias("compound"),
    )


@register("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def dotted_path(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@register()
def pca_axes(spark, d):
    """Share of variance of the first two principal axes of centred embeddings, and each row's place along them."""
    rows, share = models.principal_axes(table(spark, d, "embeddings"), "embedding", 2)
    return rows.select("vec_id", *[F.col("axes")[k].alias(f"pc{k + 1}") for k in range(2)], *[F.lit(x).alias(f"share{k + 1}") for k, x in enumerate(share)])


@register("SELECT l_shipdate::DATE AS day, count(*) AS n, round(sum(count(*)) OVER (ORDER BY l_shipdate::DATE) / (SELECT count(*) FROM lineitem), 9) AS cumulative FROM lineitem GROUP BY 1")
def cumulative_share(spark, d):
    n = table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("n"))
    return n.withColumn("cumulative", F.round(F.sum("n").over(Window.orderBy("day")) / F.sum("n").over(Window.partitionBy()), 9))
