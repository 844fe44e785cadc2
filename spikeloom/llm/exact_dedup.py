"""Exact dedup with built-in functions only.

Rows are grouped by a 128-bit hash of the normalised text and, inside, by its bytes, so equal hashes of different texts never
make one group; partial aggregation folds copies before the shuffle, which keeps hot groups small. The groups, a narrow
table, are stored. A hash that only one text has stands for its bytes from there on; texts that share a hash, if there are any, are joined by their
bytes as well. So bytes decide every group, and texts are shuffled once, folded.

Null and empty texts are equal to each other. Repeated ids are returned once per input row. A null id is never the one
that stays if its group has another, and `kept` is false for it; it is true for each of some rows that repeat id and
text. `keep_one` returns one row of each group, whatever its ids. An empty table gives an empty result. Columns other than
`doc_id` and `text` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

BLANKS = r"[\x20\x09-\x0D]+"


def content_hash(norm: Column) -> Column:
    return F.unhex(F.md5(norm))


def _normalised(docs: DataFrame, *columns: Column) -> DataFrame:
    """h, norm, points, and `columns` of every row."""
    original = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.regexp_replace(original, BLANKS, "").alias("norm"), F.char_length(original).cast("long").alias("points"), *columns)
    return rows.withColumn("h", content_hash(F.col("norm")))


def _groups(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(h, text_sha256, keep_id, group_size) of the hashes that one text has, and (h, norm, ...) of those that several have, if any."""
    rank = F.struct(F.col("doc_id").isNotNull(), "points", -F.col("doc_id"))
    exact = rows.groupBy("h", "norm").agg(F.max_by("doc_id", rank).alias("keep_id"), F.count("*").alias("group_size")).withColumn("text_sha256", F.sha2("norm", 256))
    named = stored(exact.select("h", "text_sha256", "keep_id", "group_size"), "exact-groups")
    shared = named.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    if shared.isEmpty():
        return named, None
    return named.join(shared, "h", "left_anti"), exact.join(shared, "h", "left_semi")


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row; the longest original text, then smallest id stays."""
    rows = _normalised(docs, F.col("doc_id"))
    named, shared = _groups(rows)
    final = ["doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "text_sha256"]
    out = rows.select("doc_id", "h").join(named, "h").select(*final)
    return out if shared is None else out.unionByName(rows.select("doc_id", "h", "norm").join(shared, ["h", "norm"]).select(*final))


def keep_one(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each group of equal texts, all columns as they are."""
    rank = F.struct(F.col("doc_id").isNotNull(), F.char_length(F.coalesce("text", F.lit(""))), -F.col("doc_id"), F.xxhash64("text"))
    rows = _normalised(docs, F.struct(*docs.columns).alias("row"), rank.alias("rank"), F.col("doc_id"))
    _, shared = _groups(rows)
    one = lambda df, by: df.groupBy(*by).agg(F.max_by("row", "rank").alias("row")).select("row.*")
    if shared is None:  # every hash stands for the bytes of one text
        return one(rows, ["h"])
    several = shared.select("h").distinct()
    return one(rows.join(several, "h", "left_anti"), ["h"]).unionByName(one(rows.join(several, "h", "left_semi"), ["h", "norm"]))


ORACLE_SQL = """
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT norm, count(*) AS group_size, arg_max(doc_id, points * 100000000000 - doc_id) AS keep_id FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, false) AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)
"""
