"""Queries that stream, scan listings and write and read tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spikeloom.operators import detectors
from spikeloom.sources import files
from spikeloom.streaming import incremental

from .common import table

QUERIES, ORACLES = {}, {}


def register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@register("SELECT event_type, time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '2024-01-01') AS start, count(*) AS n FROM events GROUP BY ALL")
def stream_window_counts(spark, d):
    schema = table(spark, d, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events*").parquet(d) if not _is_folder(spark, f"{d}/events.parquet") else spark.readStream.schema(schema).parquet(f"{d}/events.parquet")
    rows = rows.withColumn("ts", F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp"))
    counts = rows.groupBy("event_type", F.window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n"))
    folder = incremental.shared_folder(spark, "counts")

    def keep(batch, number):
        batch.select("event_type", F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("w.start").cast("timestamp_ntz")).alias("start"), "n").write.mode("overwrite").parquet(f"{folder}/rows")

    counts.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/rows")


def _is_folder(spark, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(found).isDirectory()


@register("SELECT o_orderpriority AS level, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL")
def event_table_round_trip(spark, d):
    """Writes every level as one partitioned table and reads them back."""
    folder, o = incremental.shared_folder(spark, "events"), table(spark, d, "orders")
    names = [r.p for r in o.select(F.col("o_orderpriority").alias("p")).distinct().collect()]  # five levels
    levels = {p: o.where(F.col("o_orderpriority") == p).select("o_orderkey", "o_totalprice") for p in names}
    files.write_events(levels, folder)
    return files.read_events(spark, folder).groupBy("level").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@register("SELECT p_type, part AS word, count(*) AS n FROM (SELECT p_type, unnest(string_split(p_type, ' ')) AS part FROM part) GROUP BY ALL")
def reason_split(spark, d):
    return table(spark, d, "part").select("p_type", F.explode(F.split("p_type", " ")).alias("word")).groupBy("p_type", "word").agg(F.count("*").alias("n"))


@register()
def settings_table(spark, d):
    """Parts as INI texts, parsed back into (path, section, key, value)."""
    text = F.concat(F.lit("# a comment\n["), "p_brand", F.lit("]\nname = "), "p_name", F.lit("\nsize=1\nsize="), F.col("p_size").cast("string"), F.lit("\n; end\n"))
    return files.ini_settings(table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("path"), text.alias("value")))


ORACLES["settings_table"] = "SELECT CAST(p_partkey AS VARCHAR) AS path, p_brand AS section, 'name' AS key, trim(p_name) AS value FROM part UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_brand, 'size', CAST(p_size AS VARCHAR) FROM part"


@register()
def network_bursts(spark, d):
    """The population detector over the event stream of each well, at six seconds for thirty days, so that bins hold enough units for bursts."""
    return detectors.population_bursts(_quick_spikes(spark, d, F.col("user_id").cast("string")))["network_bursts"]


def _quick_spikes(spark, d, unit):
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)")
    return table(spark, d, "events").select(F.col("event_type").alias("well"), unit.alias("unit_id"), (micros / (30 * 86400e6 / 6)).alias("t"))


@register()
def model_bursts(spark, d):
    """The model detector over the same stream, with ten units a well, so that they have enough spikes to be fitted."""
    unit = F.concat(F.lit("u"), (F.col("user_id") % 10).cast("string"))
    return detectors.model_bursts(_quick_spikes(spark, d, unit))["network_bursts"]
