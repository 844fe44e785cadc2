"""Exact order statistics of large groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranks of the approximate bracket are off by at most n / ACCURACY.
ACCURACY = 10_000


def quantile(rows: DataFrame, value: Column, q: float, by: list[str], name: str) -> DataFrame:
    """(by, name): the exact quantile of each group, linear between neighbours; nulls and NaN don't count.

    An approximate sketch brackets the two neighbours first. Only the values within the bracket are then counted one by one, so no
    task holds a group's values, however many there are.
    """
    x = rows.select(*by, F.nanvl(value.cast("double"), F.lit(None)).alias("_x")).where("_x IS NOT NULL")
    low, high = max(0.0, q - 2 / ACCURACY), min(1.0, q + 2 / ACCURACY)
    ends = F.percentile_approx("_x", F.array(F.lit(low), F.lit(high)), ACCURACY)
    bracket = x.groupBy(*by).agg(ends.alias("_e"), F.min("_x").alias("_min"), F.max("_x").alias("_max"), F.count("*").alias("_n"))
    at = q * (F.col("_n") - 1)
    bracket = bracket.select(*by, F.when(F.floor(low * F.col("_n")) <= 2, F.col("_min")).otherwise(F.col("_e")[0]).alias("_low"), F.when(F.ceil(high * F.col("_n")) >= F.col("_n") - 2, F.col("_max")).otherwise(F.col("_e")[1]).alias("_high"), F.floor(at).alias("_k"), (at - F.floor(at)).alias("_f"))
    inside = x.join(bracket, by).where("_x <= _high").groupBy(*by, "_low", "_k", "_f", F.when(F.col("_x") >= F.col("_low"), F.col("_x")).alias("_x")).agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*by).orderBy(F.asc_nulls_first("_x")))
    ranked = inside.withColumn("_to", upto).where("_x IS NOT NULL")
    pick = lambda k: F.min(F.when(F.col("_to") > k, F.col("_x")))
    both = ranked.groupBy(*by, "_f").agg(pick(F.col("_k")).alias("_a"), pick(F.col("_k") + 1).alias("_b"))
    return both.select(*by, F.when(F.col("_f") == 0, F.col("_a")).otherwise((1 - F.col("_f")) * F.col("_a") + F.col("_f") * F.col("_b")).alias(name))
