"""Gaussian smoothing and derivatives of series on a bin grid."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRUNCATE = 4.0
#: Bins of a series that are smoothed together; more than any radius.
PART = 8192


def smooth(x: np.ndarray, sigma: float) -> np.ndarray:
    """A series under a normalised Gaussian of int(4 * sigma + 0.5) bins on either side; ends reflect with the edge repeated."""
    radius = int(TRUNCATE * sigma + 0.5)
    weights = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return np.convolve(np.pad(x, radius, mode="symmetric"), weights / weights.sum(), mode="valid") if radius else x


def smooth_part(x: np.ndarray, sigma: float, lead: int, tail: int) -> np.ndarray:
    """A part of a series between `lead` and `tail` neighbouring values; where these are missing, the series ends and reflects."""
    radius = int(TRUNCATE * sigma + 0.5)
    if not lead and not tail:
        return smooth(x, sigma)
    weights = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return np.convolve(np.pad(x, (radius - lead, radius - tail), mode="symmetric"), weights / weights.sum(), mode="valid")


def _smoothed(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    for parts in batches:
        yield pd.Series([smooth_part(np.asarray(x, float), float(s), int(a), int(b)) for x, s, a, b in zip(*parts, strict=True)])


def gaussian(rows: DataFrame, values: dict[str, str], sigma: Column | float, by: list[str] | None = None) -> DataFrame:
    """`rows` with smoothed columns: values maps new names to columns; rows need `bin` from 0 without gaps.

    sigma is in bins and may differ by group. Series are smoothed in parts of PART bins, each with copies of the bins around it, as
    vectorised functions of arrays; all columns of a part share one shuffle.
    """
    by = by or ["well"]
    sigma = sigma if isinstance(sigma, Column) else F.lit(float(sigma))
    over_arrays = F.pandas_udf(_smoothed, "array<double>")
    kept = [c for c in rows.columns if c not in by]
    sized = rows.withColumn("_sigma", sigma.cast("double"))
    last = sized.groupBy(*by).agg(F.floor(F.max("bin") / PART).alias("_last"))
    radius = F.floor(TRUNCATE * F.col("_sigma") + 0.5).cast("long")
    part = lambda b: F.greatest(F.least(F.floor(b / PART), F.col("_last")), F.lit(0))
    copies = sized.join(last, by).withColumn("_part", F.explode(F.sequence(part(F.col("bin") - radius), part(F.col("bin") + radius)))).drop("_last")
    series = copies.groupBy(*by, "_part").agg(F.first("_sigma").alias("_sigma"), F.array_sort(F.collect_list(F.struct("bin", *[c for c in kept if c != "bin"]))).alias("_rows"))
    inside = lambda k: F.size(F.filter("_rows", lambda r: F.floor(r["bin"] / PART) == k)).cast("long")
    series = series.withColumn("_own", inside(F.col("_part"))).withColumn("_lead", F.size(F.filter("_rows", lambda r: F.floor(r["bin"] / PART) < F.col("_part"))).cast("long")).withColumn("_tail", F.size("_rows") - F.col("_own") - F.col("_lead"))
    for k, value in enumerate(values.values()):
        series = series.withColumn(f"_s{k}", over_arrays(F.transform("_rows", lambda r: r[value].cast("double")), F.col("_sigma"), F.col("_lead"), F.col("_tail")))
    arrays = F.arrays_zip(F.slice("_rows", F.col("_lead").cast("int") + 1, F.col("_own").cast("int")).alias("_rows"), *[F.col(f"_s{k}") for k in range(len(values))])
    out = series.select(*by, F.explode(arrays).alias("_x"))
    return out.select(*by, *[F.col(f"_x._rows.{c}").alias(c) for c in kept], *[F.col(f"_x._s{k}").alias(name) for k, name in enumerate(values)])


def difference(rows: DataFrame, name: str, value: str, by: list[str] | None = None) -> DataFrame:
    """First difference along `bin`; the first bin has 0."""
    x = F.col(value).cast("double")
    return rows.withColumn(name, x - F.coalesce(F.lag(x).over(Window.partitionBy(*(by or ["well"])).orderBy("bin")), x))
