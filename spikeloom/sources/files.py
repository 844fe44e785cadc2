"""Sources: recording trees, INI-like metadata, JSON catalogs, spike folders and event tables, all read by Spark."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORDING = "map<string,struct<sample_id:string,date:string,plate_id:string,scan_type:string,run_id:string,data_path:string,file_size:bigint,mtime:double,discovered_at:double,metadata:map<string,string>>>"
PIPELINE = "map<string,struct<recording_key:string,well_id:string,created_at:double,tasks:map<string,struct<status:string,dependencies:array<string>,output_path:string,last_updated:double,error:string,config:string>>>>"


def scan_recordings(spark: SparkSession, root: str, name: str = "data.raw.h5") -> DataFrame:
    """Recordings below `root`, from paths sample/date/plate/scan/run/name; only listings are read. Others are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", name).load(root)
    return parsed_paths(files.select("path", F.col("path").alias("data_path"), F.col("length").alias("file_size"), F.unix_micros("modificationTime").alias("mtime_us")))


def parsed_paths(files: DataFrame) -> DataFrame:
    """`files` with the parts of their `path`, sample/date/plate/scan/run/name, in place of it; paths without a six-digit date and a numeric run are left out."""
    names = ["sample_id", "date", "plate_id", "scan_type", "run_id"]
    rows = files.withColumns({n: F.try_element_at(F.split("path", "/"), F.lit(k)) for n, k in zip(names, range(-6, -1), strict=True)})
    return rows.where(F.col("date").rlike("^[0-9]{6}$") & F.col("run_id").rlike("^[0-9]+$")).withColumn("cache_key", F.concat_ws("/", *names)).drop("path")


def new_partitions(found: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of (sample_id, date) pairs that the catalog doesn't have."""
    return found.join(known.select("sample_id", "date").distinct(), ["sample_id", "date"], "left_anti")


def ini_settings(texts: DataFrame) -> DataFrame:
    """(path, section, key, value) of INI-like texts (path, value): comments and blanks skipped, the first = splits, the last of equal keys wins."""
    lines = texts.select("path", F.posexplode(F.split("value", r"\r?\n")).alias("k", "line")).withColumn("line", F.trim("line"))
    marked = lines.where(~F.col("line").rlike("^([#;]|$)")).withColumn("head", F.nullif(F.regexp_extract("line", r"^\[(.*)\]$", 1), F.lit("")))
    own = Window.partitionBy("path").orderBy("k")
    kept = marked.withColumn("section", F.last("head", ignorenulls=True).over(own)).where(F.col("head").isNull() & F.col("line").contains("="))
    pair = F.split("line", "=", 2)
    keyed = kept.select("path", F.coalesce("section", F.lit("")).alias("section"), F.trim(pair[0]).alias("key"), F.trim(pair[1]).alias("value"), "k")
    return keyed.groupBy("path", "section", "key").agg(F.max_by("value", "k").alias("value"))


def read_settings(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.format("binaryFile").load(path).select("path", F.decode(F.col("content"), "UTF-8").alias("value"))
    return ini_settings(text)


def read_catalog(spark: SparkSession, path: str, schema: str = RECORDING) -> DataFrame:
    """One row for each entry of a JSON catalog file; missing fields are null, and entries that aren't objects are left out."""
    text = spark.read.option("wholetext", True).text(path)
    entries = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("cache_key", "e")).where(F.col("e").startswith("{"))
    return entries.select("cache_key", F.from_json("e", schema.removeprefix("map<string,").removesuffix(">")).alias("e")).select("cache_key", "e.*")


def read_pipeline(spark: SparkSession, path: str) -> DataFrame:
    """One row for each entry and task of a pipeline-state file."""
    return read_catalog(spark, path, PIPELINE).select("recording_key", "well_id", "created_at", F.explode("tasks").alias("task", "t")).select("recording_key", "well_id", "created_at", "task", "t.*")


def npy_values(content: Column) -> Column:
    """The numbers of a plain .npy file as doubles; arrays of objects are refused, never unpickled."""

    def parsed(files: pd.Series) -> pd.Series:
        return pd.Series([np.load(io.BytesIO(x), allow_pickle=False).astype(float).ravel() for x in files])

    return F.pandas_udf(parsed, "array<double>")(content)


def read_curated(spark: SparkSession, root: str) -> DataFrame:
    """(well, unit_id, t in seconds) of .npz files of spike times by unit, the file's folder being the well; times that aren't finite or are negative are left out."""
    cell = "array<struct<unit_id:string,times:array<double>>>"

    def parsed(contents: pd.Series) -> pd.Series:
        return pd.Series([[{"unit_id": k, "times": np.asarray(v, float).ravel()} for k, v in np.load(io.BytesIO(x), allow_pickle=False).items()] for x in contents])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.npz").load(root)
    units = files.select(F.regexp_replace("path", "/[^/]*$", "").alias("well"), F.explode(F.pandas_udf(parsed, cell)("content")).alias("u"))
    t = F.nanvl("t", F.lit(None))
    return units.select("well", "u.unit_id", F.explode("u.times").alias("t")).where((t >= 0) & (t < float("inf")))


def read_sorted_folder(spark: SparkSession, root: str, keep: tuple[str, ...] = ("good",)) -> DataFrame:
    """(well, unit_id, t in seconds) of folders with spike_times.npy, spike_clusters.npy, params.py and cluster label tables.

    The rate is read from the settings text by a pattern; nothing is executed. A folder without labels keeps all its clusters.
    """
    parent = F.regexp_replace("path", "/[^/]*$", "")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(parent.alias("well"), F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    numbers = lambda name, out: files.where(F.col("name") == name).select("well", F.posexplode(npy_values(F.col("content"))).alias("k", out))
    rate = files.where("name = 'params.py'").select("well", F.regexp_extract(F.decode("content", "UTF-8"), r"(?m)^\s*(?:sample_rate|fs|sampling_rate)\s*=\s*([0-9.]+)", 1).cast("double").alias("rate"))
    spikes = numbers("spike_times.npy", "sample").join(numbers("spike_clusters.npy", "cluster"), ["well", "k"]).join(F.broadcast(rate), "well")
    lines = files.where("name IN ('cluster_group.tsv', 'cluster_KSLabel.tsv')").select("well", "name", F.explode(F.split(F.decode("content", "UTF-8"), r"\r?\n")).alias("line"))
    labels = lines.select("well", "name", F.split("line", "\t").alias("f")).where("size(f) >= 2").select("well", "name", F.expr("try_cast(f[0] AS double)").alias("cluster"), F.lower(F.expr("f[1]")).alias("label")).where("cluster IS NOT NULL")
    chosen = labels.join(labels.groupBy("well").agg(F.min("name").alias("name")), ["well", "name"])
    kept = spikes.join(chosen.where(F.col("label").isin(*keep)).select("well", "cluster"), ["well", "cluster"], "left_semi")
    unlabelled = spikes.join(chosen.select("well").distinct(), "well", "left_anti")
    t = F.col("sample") / F.col("rate")
    return kept.unionByName(unlabelled.select(kept.columns)).where(t >= 0).select("well", F.format_string("cluster_%03d", F.col("cluster").cast("long")).alias("unit_id"), t.alias("t"))


def curated_or_all(curated: DataFrame, every: DataFrame) -> DataFrame:
    """Curated spikes where a well has any, else all of its spikes."""
    return curated.unionByName(every.join(curated.select("well").distinct(), "well", "left_anti"))


def clean_events(events: DataFrame) -> DataFrame:
    """Events with finite ends and a positive length; NaN and infinite values are null."""
    numbers = [c for c, kind in events.dtypes if kind in ("double", "float")]
    finite = {c: F.when(F.abs(c) < float("inf"), F.nanvl(F.col(c), F.lit(None))) for c in numbers}
    return events.withColumns(finite).where("start IS NOT NULL AND end IS NOT NULL AND end > start")


def write_events(levels: dict[str, DataFrame], folder: str, extra: dict[str, DataFrame] | None = None) -> None:
    """Burst tables by level, as one partitioned Parquet table: the set of levels is what the folder holds afterwards.

    Levels of an earlier run that aren't given are removed, so that no reader sees them beside this run's. `extra` tables (metrics, diagnostics)
    are written under their names beside the levels, in folders that a reader of the levels passes over.
    """
    names = {f"level={name}": events for name, events in levels.items()} | {f"_{name}": rows for name, rows in (extra or {}).items()}
    for name, rows in names.items():
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
    if names:
        spark = next(iter(names.values())).sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for entry in system.listStatus(path):
            if entry.getPath().getName().startswith("level=") and entry.getPath().getName() not in names:
                system.delete(entry.getPath(), True)


def read_extra(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table that was written beside the levels."""
    return spark.read.parquet(f"{folder}/_{name}")


def read_events(spark: SparkSession, folder: str, level: str | None = None) -> DataFrame:
    rows = spark.read.option("mergeSchema", "true").parquet(folder)
    return rows if level is None else rows.where(F.col("level") == level)
