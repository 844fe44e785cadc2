"""Unit curation by quality limits, its summaries, and plate views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The limits and the reasons, in the order of the reasons.
PRESENCE, CONTAMINATION, RATE, AMPLITUDE = 0.75, 0.15, 0.05, -20.0


def _value(units: DataFrame, name: str, default: float) -> Column:
    """A metric; NaN is missing, and a column that doesn't exist has its default."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None)) if name in units.columns else F.lit(default)


def curate(units: DataFrame, *, presence: float = PRESENCE, contamination: float = CONTAMINATION, rate: float = RATE, amplitude: float = AMPLITUDE, enabled: bool = True) -> DataFrame:
    """`units` with `reasons` (joined by "; ") and `curated`. A missing value passes; a missing column has a lenient default, but for the rate."""
    if not enabled:
        return units.withColumn("reasons", F.lit("")).withColumn("curated", F.lit(True))
    fails = lambda test, name: F.when(F.coalesce(test, F.lit(False)), name)
    reasons = F.concat_ws(
        "; ",
        fails(_value(units, "presence_ratio", 1.0) < presence, "low_presence_ratio"),
        fails(_value(units, "rp_contamination", 0.0) > contamination, "high_rp_contamination"),
        fails(_value(units, "firing_rate", 0.0) < rate, "low_firing_rate"),
        fails(_value(units, "amplitude_median", -1e9) > amplitude, "low_amplitude"),
    )
    return units.withColumn("reasons", reasons).withColumn("curated", F.col("reasons") == "")


def summary(units: DataFrame, by: list[str]) -> DataFrame:
    n, k = F.count("*"), F.count_if("curated")
    return units.groupBy(*by).agg(n.alias("n_total"), k.alias("n_curated"), F.bround(100.0 * k / n, 1).alias("pct_curated"))


def reason_counts(units: DataFrame, by: list[str]) -> DataFrame:
    rows = units.where("NOT curated").select(*by, F.explode(F.split("reasons", "; ")).alias("reason"))
    return rows.groupBy(*by, "reason").agg(F.count("*").alias("n"))


def describe(rows: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear) and max of each column, a row for each (by, metric)."""
    long = rows.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("x")) for c in columns])).alias("_m")).select(*by, "_m.metric", "_m.x")
    return long.groupBy(*by, "metric").agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), *[F.percentile("x", p / 100).alias(f"q{p}") for p in (25, 50, 75)], F.max("x").alias("max")
    )


def plate(spark, outputs: DataFrame, columns: int = 6, slots: int = 24) -> DataFrame:
    """One row for each slot of a plate, with the outputs of its well or status `missing`. outputs: (recording_key, slot, status, ...)."""
    spine = outputs.select("recording_key").distinct().crossJoin(F.broadcast(spark.range(slots).select(F.col("id").alias("slot"))))
    out = spine.join(outputs, ["recording_key", "slot"], "left").withColumn("status", F.coalesce("status", F.lit("missing")))
    letter = F.char(65 + F.expr(f"slot div {columns}"))
    return out.withColumn("row", F.expr(f"slot div {columns}")).withColumn("col", F.col("slot") % columns).withColumn("name", F.concat(letter, (F.col("col") + 1).cast("string")))


def plate_task(spark, outputs: DataFrame, aggregates: list[Column]) -> DataFrame:
    """A task over whole plates: its slots, those without an output too, are made one row of each recording."""
    return plate(spark, outputs).groupBy("recording_key").agg(*aggregates)


def group_colours(rows: DataFrame, group: str, colours: int = 6) -> DataFrame:
    names = rows.select(group).where(F.col(group).isNotNull()).distinct()
    return names.withColumn("colour", (F.dense_rank().over(Window.orderBy(group)) - 1) % colours)
