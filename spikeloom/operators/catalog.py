"""Catalog filters and the task DAG: status tables, ready work, cascades, resets.

Tables: recordings(cache_key, ...), wells(cache_key, well_id, metadata map), task_status(recording_key, well_id, task, status, ...),
task_dag(task, dep). Status changes are appended with a sequence number; the latest row of a key counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATES = ["NOT_RUN", "RUNNING", "COMPLETE", "FAILED"]
#: The tasks in order, and what each needs.
TASKS = {
    "preprocessing": [], "sorting": ["preprocessing"], "auto_merge": ["sorting"], "analyzer": ["auto_merge"], "auto_curation": ["analyzer"],
    "burst_detection": ["analyzer"], "ml_burst_detection": ["auto_curation"],
}
COMPARE = {
    "==": lambda c, v: c == v, "!=": lambda c, v: c != v, "<": lambda c, v: c < v, "<=": lambda c, v: c <= v, ">": lambda c, v: c > v, ">=": lambda c, v: c >= v,
    "contain": lambda c, v: c.contains(v), "not contain": lambda c, v: ~c.contains(v),
}


def condition(column: Column, op: str, value) -> Column:
    if op not in COMPARE:
        raise ValueError(f"unknown operator {op!r}; known: {', '.join(COMPARE)}")
    return COMPARE[op](column, value)


def select_recordings(recordings: DataFrame, filters: list[tuple], wells: DataFrame | None = None) -> DataFrame:
    """Recordings that meet all filters (key, op, value); keys `wells.x` ask for one well whose metadata meets all of them.

    A well without the key never matches, whatever the operator.
    """
    plain = [f for f in filters if not f[0].startswith("wells.")]
    if unknown := [k for k, _, _ in plain if k not in recordings.columns]:
        raise ValueError(f"unknown keys {unknown}; known: {', '.join(recordings.columns)}")
    tests = [condition(F.col(k), op, v) for k, op, v in plain]
    out = recordings.where(reduce(lambda a, b: a & b, tests)) if tests else recordings
    inner = [(k.removeprefix("wells."), op, v) for k, op, v in filters if k.startswith("wells.")]
    if inner:
        meets = reduce(lambda a, b: a & b, [F.coalesce(condition(F.col("metadata")[k], op, v), F.lit(False)) for k, op, v in inner])
        out = out.join(wells.where(meets).select("cache_key"), "cache_key", "left_semi")
    return out


def queued(recordings: DataFrame, status: DataFrame, is_queued: bool) -> DataFrame:
    keys = status.select(F.col("recording_key").alias("cache_key")).distinct()
    return recordings.join(keys, "cache_key", "left_semi" if is_queued else "left_anti")


def latest(log: DataFrame, keys: list[str], sequence: str = "seq") -> DataFrame:
    """The last row of each key of an append-only log."""
    others = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*others), sequence).alias("_r")).select(*keys, "_r.*")


def add_wells(status: DataFrame, wells: DataFrame, tasks: list[str]) -> DataFrame:
    """Rows to append so that every well has every task: those that are missing, as NOT_RUN."""
    wanted = wells.select("recording_key", "well_id").distinct().withColumn("task", F.explode(F.array(*map(F.lit, tasks))))
    return wanted.join(status, ["recording_key", "well_id", "task"], "left_anti").withColumn("status", F.lit("NOT_RUN"))


def dag(spark, tasks: dict[str, list[str]] = TASKS) -> DataFrame:
    return spark.createDataFrame([(t, d) for t, deps in tasks.items() for d in deps], "task string, dep string")


def cascade(dag: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, task): each root and all tasks that depend on it, directly or not. roots: (task)."""
    recursive = "WITH RECURSIVE r(root, task) AS (SELECT task, task FROM {roots} UNION ALL SELECT r.root, d.task FROM r JOIN {dag} d ON d.dep = r.task) SELECT DISTINCT root, task FROM r"
    return dag.sparkSession.sql(recursive, roots=roots, dag=dag)


def ready(status: DataFrame, dag: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Tasks that may run: not run yet (or failed, if asked), all their dependencies complete; a missing one isn't.

    A well's complete tasks are the bits of one number, made in one shuffle by well; the DAG is a handful of rows.
    """
    edges = [(r.task, r.dep) for r in dag.select("task", "dep").collect()]
    bit = {t: 1 << k for k, t in enumerate(sorted({x for e in edges for x in e}))}
    if len(bit) > 62:
        raise ValueError(f"too many tasks: {len(bit)}")
    needs = {t: sum({bit[d] for s, d in edges if s == t}) for t in bit}
    of_task = lambda numbers: F.coalesce(*[F.when(F.col("task") == t, F.lit(n).cast("long")) for t, n in numbers.items()], F.lit(0).cast("long"))
    done = F.bit_or(F.when(F.col("status") == "COMPLETE", of_task(bit)).otherwise(F.lit(0).cast("long"))).over(Window.partitionBy("recording_key", "well_id"))
    rows = status.withColumn("_done", done).where(F.col("status").isin(["NOT_RUN", "FAILED"] if retry_failed else ["NOT_RUN"]))
    return rows.where(F.col("_done").bitwiseAND(of_task(needs)) == of_task(needs)).drop("_done")


def ready_top(status: DataFrame, dag: DataFrame, order: list[str], n: int, retry_failed: bool = False) -> DataFrame:
    return ready(status, dag, retry_failed).orderBy(*order).limit(n)


def reset(status: DataFrame, closure: DataFrame, where: Column | None = None) -> DataFrame:
    """`status` with the closure's tasks NOT_RUN where the condition on a row holds; `was_reset` marks them."""
    hit = status.join(F.broadcast(closure.select("task").distinct().withColumn("_in", F.lit(True))), "task", "left")
    touched = F.coalesce(F.col("_in"), F.lit(False)) & (F.col("status") != "NOT_RUN") & (where if where is not None else F.lit(True))
    return hit.withColumn("was_reset", touched).withColumn("status", F.when(touched, "NOT_RUN").otherwise(F.col("status"))).drop("_in")


def recover(status: DataFrame) -> DataFrame:
    """After a crash everything that isn't complete may run again."""
    return status.withColumn("status", F.when(F.col("status") == "COMPLETE", F.col("status")).otherwise("NOT_RUN"))


def matrix(status: DataFrame, tasks: list[str], missing: str = "—") -> DataFrame:
    """One row for each well, a column for each task."""
    return status.groupBy("recording_key", "well_id").pivot("task", tasks).agg(F.first("status")).na.fill(missing, tasks)


def completion(status: DataFrame) -> DataFrame:
    return status.groupBy("recording_key").agg(F.bool_and(F.col("status") == "COMPLETE").alias("all_complete"), *[F.count_if(F.col("status") == s).alias(s.lower()) for s in STATES])


def first_ready(status: DataFrame, dag: DataFrame, order: list[str], n: int = 8) -> DataFrame:
    """The first ready task of each well, at most n wells."""
    k = F.row_number().over(Window.partitionBy("recording_key", "well_id").orderBy(*order))
    return ready(status, dag).withColumn("_k", k).where("_k = 1").drop("_k").orderBy("recording_key", "well_id").limit(n)
