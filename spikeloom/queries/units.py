"""Pairs of units, density trees, channels in space and filters over the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from spikeloom.functions.lineage import stored
from spikeloom.operators import density, pairs, space

from .common import HOUR, SPIKES_SQL, signal_chain, spikes, table, with_sql
from .signals import _signals

QUERIES, ORACLES = {}, {}


def register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ten units a well, whose lags are counted in steps of ten minutes up to four hours
STEP, REACH, NEAR = HOUR // 6, 4 * HOUR, HOUR // 2
_TEN = "s AS (SELECT row_number() OVER () AS k, well, unit_id % 10 AS unit_id, t FROM spk)"
_CORR = f"""c AS (SELECT well, unit_a, unit_b, lag, count(*) AS n FROM (SELECT a.well, a.unit_id AS unit_a, b.unit_id AS unit_b, CAST(floor((b.t - a.t) / {STEP}.0) AS BIGINT) AS lag FROM s a JOIN s b ON a.well = b.well AND (a.unit_id < b.unit_id OR (a.unit_id = b.unit_id AND a.k <> b.k))
 AND b.t - a.t BETWEEN -{REACH} AND {REACH}) WHERE lag >= {-(REACH // STEP)} AND lag < {REACH // STEP} GROUP BY well, unit_a, unit_b, lag)"""


def _ten(spark, d):
    return spikes(spark, d).withColumn("unit_id", F.col("unit_id") % 10)


# both sides of a pair of one unit at the same time fall on lag 0
@register(with_sql(SPIKES_SQL, _TEN, _CORR) + "SELECT * FROM c")
def correlograms(spark, d):
    """How often units follow each other, by lag."""
    return pairs.correlograms(_ten(spark, d), REACH, STEP)


_BINS = 2 * (REACH // STEP)
_CANDIDATES = [
    SPIKES_SQL,
    _TEN,
    _CORR.replace("c AS (", "c AS MATERIALIZED (", 1),
    "u AS (SELECT well, unit_id, count(*) AS n FROM s GROUP BY ALL), sp AS (SELECT well, max(t) - min(t) AS duration FROM s GROUP BY well)",
    f"m AS (SELECT well, unit_a, unit_b, sum(n) / {_BINS}.0 AS m, sum(n) FILTER (lag >= {-(NEAR // STEP)} AND lag < {NEAR // STEP}) AS close FROM c GROUP BY ALL)",
    f"p AS (SELECT m.well, m.unit_a, m.unit_b, m.m, coalesce(m.close, 0) AS close, a.n AS na, b.n AS nb FROM m JOIN u a ON a.well = m.well AND a.unit_id = m.unit_a JOIN u b ON b.well = m.well AND b.unit_id = m.unit_b WHERE m.unit_a < m.unit_b AND a.n >= 10 AND b.n >= 10)",
    f"g AS (SELECT p.*, x.lag, coalesce(c.n, 0) / p.m AS cr, coalesce(ca.n, 0) / ma.m AS aa, coalesce(cb.n, 0) / mb.m AS ab FROM p CROSS JOIN (SELECT unnest(range({-(REACH // STEP)}, {REACH // STEP})) AS lag) x LEFT JOIN c ON c.well = p.well AND c.unit_a = p.unit_a AND c.unit_b = p.unit_b AND c.lag = x.lag"
    " LEFT JOIN c ca ON ca.well = p.well AND ca.unit_a = p.unit_a AND ca.unit_b = p.unit_a AND ca.lag = x.lag LEFT JOIN c cb ON cb.well = p.well AND cb.unit_a = p.unit_b AND cb.unit_b = p.unit_b AND cb.lag = x.lag"
    " LEFT JOIN m ma ON ma.well = p.well AND ma.unit_a = p.unit_a AND ma.unit_b = p.unit_a LEFT JOIN m mb ON mb.well = p.well AND mb.unit_a = p.unit_b AND mb.unit_b = p.unit_b)",
    f"d AS (SELECT well, unit_a, unit_b, (any_value(na) * sum(abs(cr - coalesce(aa, 0))) + any_value(nb) * sum(abs(cr - coalesce(ab, 0)))) / (any_value(na + nb) * {_BINS}.0) AS difference FROM g GROUP BY ALL)",
    f"q AS (SELECT p.well, p.unit_a, p.unit_b, d.difference, 1 - (p.close + coalesce(x.close, 0) / 2.0 + coalesce(y.close, 0) / 2.0) * sp.duration / (CAST(na + nb AS DOUBLE) * (na + nb) * {NEAR}) AS share FROM p JOIN d USING (well, unit_a, unit_b) JOIN sp USING (well) LEFT JOIN m x ON x.well = p.well AND x.unit_a = p.unit_a AND x.unit_b = p.unit_a LEFT JOIN m y ON y.well = p.well AND y.unit_a = p.unit_b AND y.unit_b = p.unit_b)",
    "z AS (SELECT well, unit_a, unit_b, difference, CASE WHEN share >= 0 THEN 1 - sqrt(share) ELSE 1 END AS contamination FROM q)",
]
_OPTIONS = {"min_spikes": 10, "most_different": 1.2, "most_contaminated": 0.9}


@register(with_sql(*_CANDIDATES) + "SELECT well, unit_a, unit_b, round(difference, 7) AS difference, round(contamination, 7) AS contamination FROM z")
def merge_candidates(spark, d):
    """Pairs of units that might be one, by their correlograms and the contamination of both as one."""
    out = pairs.merge_candidates(_ten(spark, d), REACH, STEP, NEAR, **_OPTIONS)
    return out.select("well", "unit_a", "unit_b", F.round("difference", 7).alias("difference"), F.round("contamination", 7).alias("contamination"))


@register(
    "WITH RECURSIVE " + ", ".join(_CANDIDATES)
    + """, e AS (SELECT well, unit_a AS a, unit_b AS b FROM z WHERE difference <= 1.2 AND contamination <= 0.9 UNION SELECT well, unit_b, unit_a FROM z WHERE difference <= 1.2 AND contamination <= 0.9),
 reach AS (SELECT well, a, b FROM e UNION SELECT reach.well, reach.a, e.b FROM reach JOIN e ON e.well = reach.well AND e.a = reach.b), top AS (SELECT well, a AS unit_id, least(a, min(b)) AS merged FROM reach GROUP BY well, a),
 r AS (SELECT s.well, coalesce(merged, s.unit_id) AS unit_id, t, merged IS NOT NULL AS joined, t - lag(t) OVER (PARTITION BY s.well, coalesce(merged, s.unit_id) ORDER BY t) AS gap FROM s LEFT JOIN top USING (well, unit_id))
 SELECT well, unit_id, count(*) AS n_spikes, sum(t) AS t_sum FROM r WHERE NOT joined OR gap IS NULL OR gap > 60000000 GROUP BY ALL"""
)
def merged_units(spark, d):
    """One round of merging: spikes of groups of units as one unit, without spikes a minute or less after another."""
    own = _ten(spark, d)
    accepted = pairs.merge_candidates(own, REACH, STEP, NEAR, **_OPTIONS).where("accepted")
    return pairs.merge_units(own, accepted, 60_000_000).groupBy("well", "unit_id").agg(F.count("*").alias("n_spikes"), F.sum("t").alias("t_sum"))


_VECTORS = "r AS (SELECT label AS well, vec_id AS id, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings)"


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("label").alias("well"), F.col("vec_id").alias("id"), F.col("embedding").alias("x"))


@register(
    "WITH RECURSIVE " + _VECTORS
    + """, d AS MATERIALIZED (SELECT p.well, p.id AS a, q.id AS b, sqrt(list_sum(list_transform(list_zip(p.x, q.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d FROM r p JOIN r q ON p.well = q.well AND p.id <> q.id),
 c AS (SELECT well, a AS id, max(d) AS core FROM (SELECT *, row_number() OVER (PARTITION BY well, a ORDER BY d) AS k FROM d) WHERE k <= 5 GROUP BY ALL),
 e AS MATERIALIZED (SELECT d.well, a, b, greatest(d, x.core, y.core) AS w FROM d JOIN c x ON x.well = d.well AND x.id = a JOIN c y ON y.well = d.well AND y.id = b WHERE a < b),
 t(well, inside, a, b, w) AS (SELECT well, [min(id)], CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE) FROM r GROUP BY well UNION ALL
 SELECT well, list_append(inside, CASE WHEN list_contains(inside, a) THEN b ELSE a END), a, b, w FROM (SELECT t.well, t.inside, e.a, e.b, e.w, row_number() OVER (PARTITION BY t.well ORDER BY e.w, e.a, e.b) AS k FROM t JOIN e ON e.well = t.well AND list_contains(t.inside, e.a) <> list_contains(t.inside, e.b)) WHERE k = 1)
 SELECT well, a, b, round(w, 7) AS w FROM t WHERE a IS NOT NULL"""
)
def density_tree(spark, d):
    """The spanning tree of mutual reachability of each group of vectors."""
    return density.spanning_tree(_vectors(spark, d), ["well"], 5).withColumn("w", F.round("w", 7))


@register()
def density_clusters(spark, d):
    """Density clusters of each group of vectors, on its five principal axes."""
    rows, _ = density.principal_axes(_vectors(spark, d), ["well"], 5)
    found = density.clusters(rows.select("well", "id", F.col("axes").alias("x")), ["well"], 5, 3)
    return found.withColumn("probability", F.round("probability", 6))


_PLACES = "ch AS (SELECT p_brand AS well, p_partkey AS channel, CAST(p_partkey * 37 % 1000 AS DOUBLE) AS x, p_size * 20.0 AS y FROM part)"


def _places(spark, d):
    x = (F.col("p_partkey") * 37 % 1000).cast("double")
    return table(spark, d, "part").select(F.col("p_brand").alias("well"), F.col("p_partkey").alias("channel"), x.alias("x"), (F.col("p_size") * 20.0).alias("y"))


@register(f"WITH {_PLACES} SELECT a.well, a.channel, count(*) AS n, round(max(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))), 6) AS farthest FROM ch a JOIN ch b ON a.well = b.well AND a.channel <> b.channel AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) > 20 AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 90 GROUP BY ALL")
def ring_neighbours(spark, d):
    """Channels in a ring around each channel."""
    return space.ring_sizes(_places(spark, d), 20.0, 90.0).withColumn("farthest", F.round("farthest", 6))


@register(
    f"WITH {_PLACES}, pk AS (SELECT p_brand AS well, l_suppkey AS unit_id, arg_max(l_partkey, l_extendedprice * 1e4 - l_partkey / 1e3) AS channel FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)"
    " SELECT pk.well, pk.unit_id, b.channel FROM pk JOIN ch a ON a.well = pk.well AND a.channel = pk.channel JOIN ch b ON b.well = a.well AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 60"
)
def sparse_units(spark, d):
    """The channels around each unit's strongest one."""
    li = table(spark, d, "lineitem").join(table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("well")).hint("merge"), "l_partkey")
    peaks = stored(li.groupBy("well", F.col("l_suppkey").alias("unit_id")).agg(F.max_by("l_partkey", F.col("l_extendedprice") * 1e4 - F.col("l_partkey") / 1e3).alias("channel")))
    return space.sparse_channels(peaks, _places(spark, d), 60.0)


@register(
    "WITH g AS (SELECT k, (k % 8) * 200.0 AS x, (k // 8) * 200.0 AS y FROM (SELECT unnest(range(0, 64)) AS k)), n AS (SELECT a.k, b.k AS j FROM g a JOIN g b ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) > 0 AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 250),"
    " v AS (SELECT label AS well, vec_id, n.k, any_value(CAST(embedding[n.k + 1] AS DOUBLE)) AS v, quantile_cont(CAST(embedding[n.j + 1] AS DOUBLE), 0.5) AS m FROM embeddings CROSS JOIN n GROUP BY ALL) SELECT well, vec_id, k, round(v - m, 6) AS v FROM v"
)
def ring_reference(spark, d):
    """Every channel less the median of the channels within 250 micrometres, by the channels' positions."""
    frames = table(spark, d, "embeddings").select(F.col("label").alias("well"), "vec_id", "embedding")
    k = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long")))
    channels = frames.select("well").distinct().select("well", k.alias("channel")).select("well", "channel", (F.col("channel") % 8 * 200.0).alias("x"), (F.floor(F.col("channel") / 8) * 200.0).alias("y"))
    out = space.ring_reference(frames, channels, "embedding", 0.0, 250.0)
    return out.select("well", "vec_id", F.posexplode("embedding").alias("k", "v")).select("well", "vec_id", F.col("k").cast("long").alias("k"), F.round("v", 6).alias("v"))


_BAND = space.butterworth(1, 1 / 48, 1 / 6, 1.0)[0].tolist()


@register(
    "WITH RECURSIVE " + ", ".join(signal_chain())
    + f""", r(well, bin, y, p, q) AS (SELECT well, CAST(-1 AS BIGINT), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM grid UNION ALL
 SELECT well, bin, y, {_BAND[1]} * x - {_BAND[3]} * y + q, {_BAND[2]} * x - {_BAND[4]} * y FROM (SELECT r.well, s.bin, CAST(s.total AS DOUBLE) AS x, {_BAND[0]} * s.total + r.p AS y, r.q FROM r JOIN sig s ON s.well = r.well AND s.bin = r.bin + 1))
 SELECT well, bin, round(y, 7) AS y FROM r WHERE bin >= 0"""
)
def band_passed(spark, d):
    """Hourly counts of each well between two frequencies, in blocks of a hundred bins."""
    signal = _signals(spark, d)[3]
    blocks = signal.groupBy("well", F.floor(F.col("bin") / 100).alias("block")).agg(F.transform(F.array_sort(F.collect_list(F.struct("bin", F.col("total").cast("double").alias("v")))), lambda r: r["v"]).alias("x"))
    out = space.filtered(blocks, ["well"], space.butterworth(1, 1 / 48, 1 / 6, 1.0))
    return out.select("well", "block", F.posexplode("x").alias("k", "y")).select("well", (F.col("block") * 100 + F.col("k")).alias("bin"), F.round("y", 7).alias("y"))


@register()
def spectral_clusters(spark, d):
    """Spectral clusters of each group of vectors, on its five principal axes."""
    rows, _ = density.principal_axes(_vectors(spark, d), ["well"], 5)
    return density.spectral_clusters(rows.select("well", "id", F.col("axes").alias("x")), ["well"])
