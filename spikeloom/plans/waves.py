"""Running the task DAG in waves: every eligible well of a task is one Spark job's work."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spikeloom.operators import catalog


class Registry:
    """Tasks by name: what they need, and a function from their ready wells to (recording_key, well_id, status, error)."""

    def __init__(self) -> None:
        self.needs: dict[str, list[str]] = {}
        self.runs: dict[str, Callable[[DataFrame], DataFrame]] = {}

    def add(self, name: str, needs: list[str], run: Callable[..., DataFrame], defaults: dict | None = None, settings: dict | None = None) -> None:
        """`run` gets the ready wells and, if the task has defaults, these with the settings over them; unknown settings are a ValueError."""
        if name in self.needs or any(n not in self.needs for n in needs):
            raise ValueError(f"{name}: already there, or needs an unknown task")
        if unknown := sorted(set(settings or {}) - set(defaults or {})):
            raise ValueError(f"{name}: unknown settings {unknown}")
        both = {**(defaults or {}), **(settings or {})}
        self.needs[name], self.runs[name] = needs, functools.partial(run, **both) if both else run


def drain(status: DataFrame, registry: Registry, keep: Callable[[DataFrame], DataFrame], serial: bool = False) -> DataFrame:
    """Runs ready tasks until none is left; each well's task runs once at most. `keep` stores a status table and returns what it stored.

    A wave that leaves any of its tasks NOT_RUN is a RuntimeError, so the number of waves is at most that of the tasks. Errors go
    into the column `error`. `serial` runs one task at a time, in the registry's order.
    """
    dag = catalog.dag(status.sparkSession, registry.needs)
    keys = ["recording_key", "well_id", "task"]
    status = status if "error" in status.columns else status.withColumn("error", F.lit(None).cast("string"))
    while True:
        todo = catalog.ready(status, dag)
        found = {r.task for r in todo.select("task").distinct().collect()}  # at most the number of tasks
        names = [n for n in registry.runs if n in found][: 1 if serial else None]
        if not names:
            break
        done = None
        for name in names:
            own = registry.runs[name](todo.where(F.col("task") == name))
            error = F.col("error") if "error" in own.columns else F.lit(None).cast("string")
            own = own.select("recording_key", "well_id", F.lit(name).alias("task"), F.col("status").alias("_new"), error.alias("_error"))
            done = own if done is None else done.unionByName(own)
        before = status
        status = keep(before.join(done, keys, "left").withColumn("error", F.when(F.col("_new").isNotNull(), F.col("_error")).otherwise(F.col("error"))).withColumn("status", F.coalesce("_new", "status")).drop("_new", "_error"))
        if not status.where(F.col("task").isin(names) & (F.col("status") == "NOT_RUN")).join(todo.select(*keys), keys, "left_semi").isEmpty():
            raise RuntimeError(f"tasks that were to run have not: {names}")
    return status
