"""Views of the catalog and the task status: lookups, filters, previews, totals, progress, queue inserts and listings of files.

recordings(cache_key, sample_id, date, ...), status(recording_key, well_id, task, status), listings(path).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import catalog


def select_by(recordings: DataFrame, key: str, op: str, value) -> DataFrame:
    """One filter; key and operator may come in either order."""
    if key in catalog.COMPARE and op not in catalog.COMPARE:
        key, op = op, key
    return catalog.select_recordings(recordings, [(key, op, value)])


def one_recording(recordings: DataFrame, cache_key) -> DataFrame:
    """The recording of a key; no such recording is a KeyError."""
    found = recordings.where(F.col("cache_key") == F.lit(cache_key))
    if found.isEmpty():
        raise KeyError(cache_key)
    return found


def entries(status: DataFrame, recordings: list | None = None, wells: list | None = None) -> DataFrame:
    """Rows of the given recordings and wells; an empty list asks for all."""
    for name, wanted in (("recording_key", recordings), ("well_id", wells)):
        status = status.where(F.col(name).isin(wanted)) if wanted else status
    return status


def matrix_rows(status: DataFrame, *which: str) -> DataFrame:
    """(which, recording_key, well_id) of wells with any task that is incomplete, running or failed, for each of the kinds asked for; wells are gathered once."""
    tests = {"incomplete": F.col("status") != "COMPLETE", "running": F.col("status") == "RUNNING", "failed": F.col("status") == "FAILED"}
    wells = status.groupBy("recording_key", "well_id").agg(*[F.bool_or(tests[w]).alias(w) for w in which])
    hit = F.explode(F.array_compact(F.array(*[F.when(F.col(w), w) for w in which])))
    return wells.select(hit.alias("which"), "recording_key", "well_id")


def complete_wells(status: DataFrame, tasks: list[str]) -> DataFrame:
    """Wells in which all of the given tasks are complete."""
    done = status.where(F.col("task").isin(tasks) & (F.col("status") == "COMPLETE"))
    return done.groupBy("recording_key", "well_id").agg(F.countDistinct("task").alias("n")).where(F.col("n") == len(tasks)).drop("n")


def output_path(root: str, *parts: Column) -> Column:
    return F.concat_ws("/", F.lit(root.rstrip("/")), *[p.cast("string") for p in parts])


def manifest(status: DataFrame, files: DataFrame, task: str, path: Column) -> DataFrame:
    """(recording_key, well_id, path, exists) of the wells whose task is complete; `exists` tells whether files(path) lists its output."""
    wanted = complete_wells(status, [task]).withColumn("path", path)
    return wanted.join(files.select("path").distinct().withColumn("exists", F.lit(True)), "path", "left").withColumn("exists", F.coalesce("exists", F.lit(False))).select("recording_key", "well_id", "path", "exists")


def totals(recordings: DataFrame, status: DataFrame) -> DataFrame:
    """One row: recordings, samples, wells, tasks, complete tasks and their floored percentage."""
    r = recordings.agg(F.count("*").alias("n_recordings"), F.countDistinct("sample_id").alias("n_samples"))
    s = status.agg(F.countDistinct("recording_key", "well_id").alias("n_wells"), F.count("*").alias("n_tasks"), F.count_if(F.col("status") == "COMPLETE").alias("n_complete"))
    return r.crossJoin(F.broadcast(s)).withColumn("pct", F.floor(F.try_divide(100 * F.col("n_complete"), F.col("n_tasks"))))  # two single rows


def task_counts(status: DataFrame) -> DataFrame:
    """A row for each task, a column for each known status."""
    return status.groupBy("task").agg(*[F.count_if(F.col("status") == s).alias(s.lower()) for s in catalog.STATES])


def per_sample(recordings: DataFrame, order: list[str]) -> DataFrame:
    """Recordings of each sample, with the first recording in `order`, by which samples are listed."""
    return recordings.groupBy("sample_id").agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("first")).orderBy("first").select("sample_id", "n", *[F.col(f"first.{c}").alias(f"first_{c}") for c in order])


def progress(status: DataFrame, n_tasks: int) -> DataFrame:
    """Shares of done, running and failed tasks of each recording, of its wells times all tasks."""
    n = F.countDistinct("well_id") * n_tasks
    return status.groupBy("recording_key").agg(*[(F.count_if(F.col("status") == s) / n).alias(name) for s, name in (("COMPLETE", "done"), ("RUNNING", "running"), ("FAILED", "failed"))])


def preview(rows: DataFrame, order: list[str], n: int = 25) -> DataFrame:
    """The first n rows, with the number of all rows."""
    return rows.orderBy(*order).limit(n).crossJoin(F.broadcast(rows.agg(F.count("*").alias("total"))))  # a single row


def options(rows: DataFrame, *columns: str) -> DataFrame:
    """(name, value): the distinct values of each column."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]))
    return rows.select(cells.alias("x")).select("x.*").where("value IS NOT NULL").distinct()


def queue(status: DataFrame, wells: DataFrame, tasks: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to append, one row with the wells and recordings that are new): wells without any entry get all tasks."""
    fresh = wells.select("recording_key", "well_id").distinct().join(status.select("recording_key", "well_id").distinct(), ["recording_key", "well_id"], "left_anti")
    known = status.select("recording_key").distinct().withColumn("known", F.lit(True))
    counts = fresh.join(known, "recording_key", "left").agg(F.count("*").alias("n_wells"), F.countDistinct("recording_key").alias("n_recordings"), F.countDistinct(F.when(F.col("known").isNull(), F.col("recording_key"))).alias("n_new_recordings"))
    return catalog.add_wells(status, fresh, tasks), counts


def auto_queue(status: DataFrame, wells: DataFrame, tasks: list[str]) -> DataFrame:
    """Rows to append for the wells of recordings that have no entry at all."""
    return catalog.add_wells(status.limit(0), wells.join(status.select("recording_key").distinct(), "recording_key", "left_anti"), tasks)


def would_reset(status: DataFrame, closure: DataFrame, statuses: list[str] | None = None) -> DataFrame:
    """How many rows of each task of a cascade a reset would touch; nothing is written."""
    rows = status.where(F.col("status").isin(statuses)) if statuses else status
    return rows.join(F.broadcast(closure.select("task").distinct()), "task", "left_semi").groupBy("task").agg(F.count("*").alias("n"))


# --- listings of files ----------------------------------------------------------------------------------------------
def _name(path: Column, k: int) -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(k))


def root_layout(paths: DataFrame, root: str) -> DataFrame:
    """`sample` if any of the first ten folders below `root` is a six-digit date, else `root`."""
    below = F.regexp_extract("path", f"^{root.rstrip('/')}/([^/]+)", 1)
    first = paths.select(below.alias("name")).where("name <> ''").distinct().orderBy("name").limit(10)
    return first.agg(F.when(F.bool_or(F.col("name").rlike("^[0-9]{6}$")), "sample").otherwise("root").alias("layout"))


def sorted_folders(paths: DataFrame, files: tuple[str, ...] = ("spike_times.npy", "spike_clusters.npy", "params.py")) -> DataFrame:
    """Folders that hold all of the files that mark a sorting result."""
    parts = paths.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), _name(F.col("path"), -1).alias("name")).where(F.col("name").isin(*files))
    return parts.groupBy("folder").agg(F.countDistinct("name").alias("n")).where(F.col("n") == len(files)).select("folder")


def spike_sources(paths: DataFrame) -> DataFrame:
    """(path, kind): curated files, and sorting folders whose parent has no curated file."""
    curated = paths.where(_name(F.col("path"), -1) == "curated_spike_times.npy").select("path", F.lit("curated").alias("kind"))
    covered = curated.select(F.regexp_replace("path", "/[^/]*/[^/]*$", "").alias("parent")).distinct()
    folders = sorted_folders(paths).select(F.col("folder").alias("path"), F.lit("sorted").alias("kind"), F.regexp_replace("folder", "/[^/]*$", "").alias("parent"))
    return curated.unionByName(folders.join(covered, "parent", "left_anti").drop("parent")).distinct()


def tree_wells(paths: DataFrame, terminal: str) -> DataFrame:
    """(recording_key, rec_name, well_id) of an output tree's paths .../key/rec/well/terminal/file."""
    at = F.array_position(F.split("path", "/"), terminal)
    part = lambda k: F.try_element_at(F.split("path", "/"), (at - k).cast("int"))
    return paths.where(at > 3).select(part(3).alias("recording_key"), part(2).alias("rec_name"), part(1).alias("well_id")).distinct()


def tree_parts(paths: DataFrame, terminals: list[str]) -> DataFrame:
    """(recording_key, rec_name, well_id, source) of the paths below each of the terminals as `tree_wells` has them, from one pass; a row for each path, repeated wells included."""
    parts = F.split("path", "/")
    rows = paths.select(parts.alias("k"), F.explode(F.array(*map(F.lit, terminals))).alias("source")).withColumn("at", F.array_position("k", F.col("source"))).where("at > 3")
    part = lambda n: F.try_element_at("k", (F.col("at") - n).cast("int"))
    return rows.select(part(3).alias("recording_key"), part(2).alias("rec_name"), part(1).alias("well_id"), "source")


def first_recording(trees: DataFrame, order: list[str]) -> DataFrame:
    """(recording_key, well_id, rec_name, source) of each well: the first source in `order`, then the smallest rec_name. trees: (source, recording_key, rec_name, well_id)."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("source"))
    best = F.min(F.struct(place.alias("place"), "rec_name", "source"))
    return trees.groupBy("recording_key", "well_id").agg(best.alias("b")).select("recording_key", "well_id", "b.rec_name", "b.source")


def output_root(done: DataFrame, suffix: Column) -> DataFrame:
    """One row: the output root, from the first complete entry whose path ends with what it should. done: (recording_key, well_id, output_path)."""
    fits = done.withColumn("suffix", suffix).where("endswith(output_path, suffix)").orderBy("recording_key", "well_id").limit(1)
    return fits.select(F.expr("rtrim('/', substring(output_path, 1, length(output_path) - length(suffix)))").alias("root"))


def record_status(wells: DataFrame) -> DataFrame:
    """`wells` with `status`: ok with signals or spikes, else the errors of its files, else missing."""
    errors = F.concat_ws("; ", "signal_error", "spike_error")
    return wells.withColumn("status", F.when(F.col("has_signal") | F.col("has_spikes"), "ok").when(errors != "", errors).otherwise("missing"))


def missing_partitions(known: DataFrame, found: DataFrame) -> DataFrame:
    """(sample_id, date) pairs of the catalog that are no longer found."""
    return known.select("sample_id", "date").distinct().join(found.select("sample_id", "date").distinct(), ["sample_id", "date"], "left_anti")


def suffixed_join(left: DataFrame, right: DataFrame, on: list[str], suffix: str) -> DataFrame:
    """Left join; columns that both sides have get a suffix on the right."""
    again = [c for c in right.columns if c in left.columns and c not in on]
    return left.join(right.withColumnsRenamed({c: c + suffix for c in again}), on, "left")


def ranked_units(spikes: DataFrame, most: int) -> DataFrame:
    """A display sample of units: every ceil(n / most)-th of a well's units by rank, at most `most` of them. spikes: (well, unit_id, ...)."""
    n = spikes.groupBy("well", "unit_id").agg(F.count("*").alias("n_spikes"))
    own = Window.partitionBy("well")
    k = F.row_number().over(own.orderBy("unit_id")) - 1
    step = F.greatest(F.floor(F.count("*").over(own) / most), F.lit(1))
    return n.withColumn("k", k).withColumn("step", step).where("k % step = 0 AND k / step < " + str(most)).select("well", "unit_id", "n_spikes")
