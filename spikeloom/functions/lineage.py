"""Cutting long plans: intermediate tables go to the cluster's checkpoint folder. Dealing rows over as many tasks as their number asks for."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a temporary folder if driver and executors are one local process."""
    root, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if root is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = _local[context.applicationId] = _local.get(context.applicationId) or tempfile.mkdtemp(prefix="spark-")
    return root


def stored(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read from there, with a short plan."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


#: Rows of a table that one task is dealt.
ROWS = 250_000


def dealt(df: DataFrame, source: DataFrame, *keys: str) -> DataFrame:
    """`df` with the rows of a key together, in a task for every ROWS rows of `source`, the table that `df` is made of (which is counted).

    What is grouped by these keys, or by these and more, is then grouped where it is: no task first gathers the groups of its part of the
    files, and tasks don't grow with the table, whatever the number of shuffle partitions is.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-source.count() // ROWS)), *keys)
