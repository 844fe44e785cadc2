"""The task status as an append-only log: updates, registrations and the state that follows from them.

log(seq, recording_key, well_id, task, status, config, output_path, error). The latest row of a (recording_key, well_id, task) is its
state; what an update doesn't set is carried over from the state before, so readers need no more than the latest rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from . import catalog

KEYS = ["recording_key", "well_id", "task"]
COLUMNS = ["seq", *KEYS, "status", "config", "output_path", "error"]
UPDATES = ["RUNNING", "COMPLETE", "FAILED"]


def _together(rows: DataFrame) -> GroupedData:
    """`rows` grouped by their keys. They are dealt first, so that keys, of which few repeat, are gathered and sorted once and not on both sides of the shuffle."""
    return rows.repartition(*KEYS).groupBy(*KEYS)


def state(log: DataFrame) -> DataFrame:
    return catalog.latest(log.select(*COLUMNS).repartition(*KEYS), KEYS)


def _check(updates: DataFrame) -> None:
    bad = [r.status for r in updates.select("status").distinct().collect() if r.status not in UPDATES]  # at most a few states
    if bad:
        raise ValueError(f"no status to set: {bad}; known: {UPDATES}")


def _refuse(unknown: DataFrame) -> None:
    if lost := unknown.select(*KEYS).limit(5).collect():
        raise KeyError(f"no such entries: {[tuple(r) for r in lost]}")


def _met(log: DataFrame, updates: DataFrame) -> DataFrame:
    """The rows to append, with `_known`: updates and the log meet in one shuffle, of a key's old rows the latest counts."""
    old = log.select(*KEYS, F.struct("seq", "config", "output_path").alias("_old"))
    both = updates.select(*KEYS, F.struct("seq", "status", "config", "output_path", "error").alias("_new")).unionByName(old, allowMissingColumns=True)
    met = _together(both).agg(F.first("_new", ignorenulls=True).alias("_new"), F.max_by(F.col("_old"), F.col("_old.seq")).alias("_old")).where("_new IS NOT NULL")
    rows = met.select(*KEYS, "_new.*", F.col("_old.config").alias("_config"), F.col("_old.output_path").alias("_path"), F.col("_old").isNotNull().alias("_known"))
    is_ = lambda s: F.col("status") == s
    return rows.select(
        "seq", *KEYS, "status", F.when(is_("RUNNING"), F.col("config")).otherwise(F.col("_config")).alias("config"), F.when(is_("COMPLETE"), F.coalesce("output_path", "_path")).otherwise(F.col("_path")).alias("output_path"), F.when(is_("FAILED"), F.col("error")).alias("error"), "_known"
    )


def updated(log: DataFrame, updates: DataFrame) -> DataFrame:
    """Rows to append for updates(seq, recording_key, well_id, task, status, config, output_path, error), at most one for each key.

    The configuration is taken when a task starts to run and kept otherwise; an output path when it is complete, and the old one kept
    otherwise; an error only when it fails. An unknown status is a ValueError, an unknown entry a KeyError.
    """
    _check(updates)
    keys = updates.select(*KEYS, F.lit(False).alias("_known")).unionByName(log.select(*KEYS, F.lit(True).alias("_known")))
    _refuse(_together(keys).agg(F.bool_or("_known").alias("_known")).where("NOT _known"))
    return _met(log, updates).drop("_known")


def appended(log: DataFrame, updates: DataFrame, folder: str) -> DataFrame:
    """`updated` with its rows written to a new folder, where unknown entries are looked for: the log is shuffled once, not twice. After an error the folder is no part of the log."""
    _check(updates)
    _met(log, updates).write.parquet(folder)
    rows = log.sparkSession.read.parquet(folder)
    _refuse(rows.where("NOT _known"))
    return rows.drop("_known")


def registered(log: DataFrame, wells: DataFrame, tasks: list[str], seq: int) -> DataFrame:
    """Rows to append so that all wells, known ones and new ones, have all tasks."""
    none = F.lit(None).cast("string")
    rows = wells.select("recording_key", "well_id", none.alias("task")).unionByName(log.select(*KEYS)).repartition("recording_key", "well_id")
    have = rows.groupBy("recording_key", "well_id").agg(*[F.bool_or(F.coalesce(F.col("task") == t, F.lit(False))).alias(f"_{k}") for k, t in enumerate(tasks)])
    lacks = F.explode(F.array_compact(F.array(*[F.when(~F.col(f"_{k}"), t) for k, t in enumerate(tasks)])))
    fresh = have.select("recording_key", "well_id", lacks.alias("task"), F.lit("NOT_RUN").alias("status"))
    return fresh.select(F.lit(seq).cast("long").alias("seq"), *KEYS, "status", none.alias("config"), none.alias("output_path"), none.alias("error"))


def reset(log: DataFrame, closure: DataFrame, seq: int, statuses: list[str] | None = None, recordings: list | None = None, wells: list | None = None) -> DataFrame:
    """Rows to append that put a cascade's tasks back to NOT_RUN, for the recordings, wells and states asked for; their number is what was reset."""
    rows = state(log).join(F.broadcast(closure.select("task").distinct()), "task", "left_semi")
    for name, wanted in (("status", statuses), ("recording_key", recordings), ("well_id", wells)):
        rows = rows.where(F.col(name).isin(wanted)) if wanted else rows
    none = F.lit(None).cast("string")
    return rows.select(F.lit(seq).cast("long").alias("seq"), *KEYS, F.lit("NOT_RUN").alias("status"), none.alias("config"), none.alias("output_path"), none.alias("error"))


def complete_with(log: DataFrame, config: str) -> DataFrame:
    """(recording_key, well_id, task) that are complete under this configuration."""
    return state(log).where((F.col("status") == "COMPLETE") & (F.col("config") == config)).select(*KEYS)
