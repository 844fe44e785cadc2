"""How the star-schema tables stand for recordings: events are spikes, event types wells, users units."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOUR = 3_600_000_000
SECONDS = 1e-6  # of a microsecond


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(well, unit_id, t) with t in whole microseconds since 2024-01-01."""
    t = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)")
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("well"), F.col("user_id").alias("unit_id"), t.alias("t"), "value")


#: Shared prefix of the SQL twins.
SPIKES_SQL = "spk AS (SELECT event_type AS well, user_id AS unit_id, date_diff('microsecond', TIMESTAMP '2024-01-01', ts) AS t, value FROM events)"
EXTENT_SQL = "ext AS (SELECT well, min(t) AS rec_start, max(t) AS rec_end, count(DISTINCT unit_id) AS n_units, count(*) AS n_spikes FROM spk GROUP BY well)"


def grid_sql(step: int = HOUR) -> str:
    return f"grid AS (SELECT well, rec_start AS start, CAST({step} AS BIGINT) AS step, CAST(ceil((rec_end - rec_start) / {step}.0) AS BIGINT) AS n_bins, n_units FROM ext)"


SPINE_SQL = "spine AS (SELECT well, start, step, n_bins, n_units, unnest(range(0, n_bins)) AS bin FROM grid)"
COUNTS_SQL = "ub AS (SELECT spk.well, unit_id, CAST(least(floor((t - start) / CAST(step AS DOUBLE)), n_bins - 1) AS BIGINT) AS bin, count(*) AS n FROM spk JOIN grid USING (well) GROUP BY ALL)"
SIGNALS_SQL = """sig AS (SELECT s.well, s.bin, s.n_units, s.start, s.step, coalesce(x.total, 0) AS total, coalesce(x.active, 0) AS active,
  coalesce(x.total, 0) / (s.step * 1e-6) AS pfr, coalesce(x.active, 0) / CAST(greatest(s.n_units, 1) AS DOUBLE) AS participation,
  coalesce(x.total, 0) / (s.step * 1e-6) / greatest(s.n_units, 1) AS rate
  FROM spine s LEFT JOIN (SELECT well, bin, CAST(sum(n) AS BIGINT) AS total, count(unit_id) AS active FROM ub GROUP BY ALL) x USING (well, bin))"""


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def grid_chain(step: int = HOUR) -> list[str]:
    return [SPIKES_SQL, EXTENT_SQL, grid_sql(step)]


def signal_chain(step: int = HOUR) -> list[str]:
    return [*grid_chain(step), SPINE_SQL, COUNTS_SQL, SIGNALS_SQL]


def smooth_sql(source: str, column: str, sigma: float, name: str) -> str:
    """A CTE of `source` (well, bin, column) under a reflecting Gaussian."""
    r = int(4 * sigma + 0.5)
    return f"""{name} AS (WITH n AS (SELECT well, max(bin) + 1 AS n FROM {source} GROUP BY well),
  w AS (SELECT k, exp(-0.5 * k * k / {sigma * sigma}) / (SELECT sum(exp(-0.5 * j * j / {sigma * sigma})) FROM (SELECT unnest(range(-{r}, {r + 1})) AS j)) AS weight FROM (SELECT unnest(range(-{r}, {r + 1})) AS k)),
  p AS (SELECT s.well, s.bin, weight, n.n, (((s.bin + k) % (2 * n.n)) + 2 * n.n) % (2 * n.n) AS m FROM {source} s JOIN n USING (well) CROSS JOIN w)
  SELECT p.well, p.bin, sum(weight * x.{column}) AS {column}_s FROM p JOIN {source} x ON x.well = p.well AND x.bin = CASE WHEN p.m < p.n THEN p.m ELSE 2 * p.n - 1 - p.m END GROUP BY p.well, p.bin)"""
