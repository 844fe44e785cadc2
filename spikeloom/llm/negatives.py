"""Hard-negative mining by slot-decomposed selection.

A score is the integer inner product of two vectors whose components are floor(256 * x). For each anchor its POSITIVES best other
rows of the same label are found, and for each of those the NEGATIVES best rows of other labels whose score lies between
80 % of the positive's score and that score. Higher scores come first, ties by smaller id.

Anchors and rows are dealt over a grid of blocks (ANCHORS and ROWS of them at most, on average); a cell of the grid scores its own anchors
against its own rows, tile by tile, so neither side is ever whole in a task or on the driver, and no pair of rows is written out.

1. Each cell keeps an anchor's best rows of its label; a ranking over the cells' few rows gives the positives.
2. The positives' scores are the upper limits of an anchor's windows, and split the scores into disjoint slots: (second limit, first
   limit], and so on. Each cell keeps the best NEGATIVES rows of each slot, and so does the ranking over all cells. Scores below the
   lowest window belong to no window.
3. A window reaches from its slot down into the slots below it. The slots of an anchor in descending order, at most
   POSITIVES * NEGATIVES rows, are one list, and a window's answer is the first NEGATIVES of the suffix that begins with its slot, cut at its lower limit: the
   best rows below a limit are among the best rows of the slots below it.

Rows with a null id, label or vector, or with a null or non-finite component take no part. Rows that repeat id, label and vector are one
row; rows that share an id only are rows of their own, and as anchors answered each for itself. Shorter vectors count as filled up with zeros. A negative
positive's window is empty, as its limits cross. Scores are exact whatever the components; one that doesn't fit 64 bits is an error. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, width

POSITIVES, NEGATIVES = 5, 5
EVERY, SCALE = 100, 256
#: Lower limit of a window in percent of the positive's score.
LEAST = 80
#: Anchors and rows in a block, and scores in a tile.
ANCHORS, ROWS, TILE = 1 << 17, 1 << 17, 1 << 21
NONE = np.iinfo(np.int64).min


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding and tag (tells rows of one id apart) of the rows that take part, each once."""
    id_, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    moved = F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = vectors.where(id_.isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & finite).select(id_.alias("vec_id"), moved.alias("label"), "embedding")
    return rows.distinct().withColumn("tag", F.xxhash64("label", "embedding"))


def _floored(column: pa.ChunkedArray, size: int) -> np.ndarray:
    """floor(SCALE * x) of a list column as a matrix with `size` columns."""
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    n = np.array(column.combine_chunks().value_lengths().fill_null(0) if len(column) else [], np.int64)
    out = np.zeros((len(n), size))
    out[np.arange(size) < n[:, None]] = np.floor(SCALE * flat.to_numpy(zero_copy_only=False).astype(np.float64))
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of two matrices' rows."""
    if len(a) and len(b) and float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] >= 1 << 53:
        whole = np.frompyfunc(int, 1, 1)
        return (whole(a) @ whole(b).T).astype(np.int64)
    return (a @ b.T).astype(np.int64)


def _first(k: int, groups: list[np.ndarray], score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The places of the first k rows of each group, by score and id."""
    order = np.lexsort((ids, ~score, *groups[::-1]))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for g in groups:
        new[1:] |= g[order][1:] != g[order][:-1]
    begin = np.flatnonzero(new)
    return order[np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order)))) < k]


def _tiles(group: pa.Table):
    """(its anchors, its rows, their scores), tile by tile, from a cell's table; anchors and rows by place in the two sides."""
    is_anchor = group["is_anchor"].combine_chunks()
    left, right = group.filter(is_anchor), group.filter(pc.invert(is_anchor))
    size = max([0, *(int(pc.max(pc.list_value_length(x["embedding"])).as_py() or 0) for x in (left, right) if len(x))])
    a, b = _floored(left["embedding"], size), _floored(right["embedding"], size)

    def tiles():
        wide = max(1, min(len(b), TILE // 64))
        high = max(1, TILE // wide)
        for i in range(0, len(a), high):
            for j in range(0, len(b), wide):
                yield slice(i, i + high), slice(j, j + wide), _scores(a[i : i + high], b[j : j + wide])

    columns = lambda x: {c: np.array(x[c], np.int64) for c in ("vec_id", "label", "tag")}
    return left, columns(left), columns(right), tiles()


def _best_alike(group: pa.Table) -> pa.Table:
    """A cell's best rows of each of its anchors' labels, itself excepted."""
    _, a, b, tiles = _tiles(group)
    found = [(np.empty(0, np.int64),) * 3]
    for i, j, score in tiles:
        same = a["label"][i, None] == b["label"][j]
        same &= (a["vec_id"][i, None] != b["vec_id"][j]) | (a["tag"][i, None] != b["tag"][j])
        score = np.where(same, score, NONE)
        if score.shape[1] > POSITIVES:
            same &= score >= np.partition(score, -POSITIVES, axis=1)[:, -POSITIVES, None]
        x, y = np.nonzero(same)
        own = x + i.start, b["vec_id"][j][y], score[x, y]
        best = _first(POSITIVES, [own[0]], own[2], own[1])
        found.append(tuple(v[best] for v in own))
    owner, ids, score = (np.concatenate(v) for v in zip(*found, strict=True))
    best = _first(POSITIVES, [owner], score, ids)
    return pa.table({"anchor_id": a["vec_id"][owner[best]], "tag": a["tag"][owner[best]], "other_id": ids[best], "score": score[best]})


def _best_of_slots(group: pa.Table) -> pa.Table:
    """A cell's best rows of other labels in each slot of its anchors."""
    left, a, b, tiles = _tiles(group)
    limits = np.full((len(left), POSITIVES), NONE)
    for k, own in enumerate(left["limits"].to_pylist()):
        limits[k, : len(own)] = own
    lowest = np.array([-((-LEAST * min(x for x in own if x != NONE)) // 100) for own in limits.tolist()], np.int64)
    found = [(np.empty(0, np.int64),) * 4]
    for i, j, score in tiles:
        other = (a["label"][i, None] != b["label"][j]) & (score <= limits[i, :1]) & (score >= lowest[i, None])
        x, y = np.nonzero(other)
        score = score[x, y]
        slot = (limits[i][x] >= score[:, None]).sum(axis=1)
        own = x + i.start, slot, b["vec_id"][j][y], score
        best = _first(NEGATIVES, [own[0], slot], score, own[2])
        found.append(tuple(v[best] for v in own))
    owner, slot, ids, score = (np.concatenate(v) for v in zip(*found, strict=True))
    best = _first(NEGATIVES, [owner, slot], score, ids)
    return pa.table({"anchor_id": a["vec_id"][owner[best]], "tag": a["tag"][owner[best]], "slot": slot[best].astype(np.int32), "other_id": ids[best], "score": score[best]})


def _cells(anchors: DataFrame, rows: DataFrame, grid: tuple[int, int]):
    """Anchors and rows, each with every cell of the grid in which it meets the other side."""
    part = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "vec_id", "tag"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["vec_id", "tag", "label", "embedding"]
    left = anchors.select(part(grid[0], 0).alias("block"), every(grid[1]).alias("part"), F.lit(True).alias("is_anchor"), *columns, "limits")
    right = rows.select(every(grid[0]).alias("block"), part(grid[1], 1).alias("part"), F.lit(False).alias("is_anchor"), *columns, F.lit(None).cast("array<long>").alias("limits"))
    return left.unionByName(right).groupBy("block", "part")


def _ranked(df: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "other_id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = cut(usable(vectors))
    chosen: Column = F.col("vec_id") % EVERY == 0
    n, m = rows.agg(F.count("*"), F.count_if(chosen)).first()
    grid = max(1, -(-m // ANCHORS)), max(1, -(-n // ROWS), 2 * width(vectors.sparkSession))
    anchors = rows.where(chosen)
    alike = _cells(anchors.withColumn("limits", F.lit(None).cast("array<long>")), rows, grid).applyInArrow(_best_alike, "anchor_id long, tag long, other_id long, score long")
    positives = cut(_ranked(alike, POSITIVES, "anchor_id", "tag").select("anchor_id", "tag", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")))
    limits = positives.where("positive_score >= 0").groupBy("anchor_id", "tag").agg(F.sort_array(F.collect_set("positive_score"), asc=False).alias("limits"))  # at most POSITIVES
    bounded = anchors.join(limits.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "tag"])
    slots = _cells(bounded, rows, grid).applyInArrow(_best_of_slots, "anchor_id long, tag long, slot int, other_id long, score long")
    best = _ranked(slots, NEGATIVES, "anchor_id", "tag", "slot")
    merged = best.groupBy("anchor_id", "tag").agg(F.sort_array(F.collect_list(F.struct("slot", "rank", "other_id", "score"))).alias("slots"))
    suffix = F.filter("slots", lambda x: (x.score <= F.col("positive_score")) & (x.score >= F.col("least")))
    answers = positives.where("positive_score >= 0").withColumn("least", F.ceil(F.col("positive_score").cast("decimal(38,0)") * LEAST / 100).cast("long")).join(merged, ["anchor_id", "tag"])
    each = answers.select("anchor_id", "positive_id", "positive_score", F.posexplode(F.slice(suffix, 1, NEGATIVES)).alias("place", "x"))
    return each.select("anchor_id", "positive_id", (F.col("place") + 1).alias("rank"), F.col("x.other_id").alias("negative_id"), "positive_score", F.col("x.score").alias("negative_score"))


ORACLE_SQL = f"""
WITH e AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS MATERIALIZED (SELECT row_number() OVER () AS k, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM e),
s AS MATERIALIZED (SELECT a.k AS anchor, a.vec_id AS anchor_id, b.k AS other, b.vec_id AS other_id, a.label = b.label AS alike, list_dot_product(a.v, b.v)::BIGINT AS score FROM r a JOIN r b ON a.vec_id % {EVERY} = 0 AND a.k <> b.k),
p AS (SELECT * FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) <= {POSITIVES})
SELECT p.anchor_id, p.other_id AS positive_id, row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other_id)::INTEGER AS rank, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.alike AND {LEAST} * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= {NEGATIVES}
"""
