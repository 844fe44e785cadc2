"""Helpers shared by the training-data operators: table access, Arrow text access, hashing, lineage cuts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spikeloom.functions.lineage import shared_root
from spikeloom.functions.lineage import stored as cut

__all__ = ["cut", "shared_root"]
U64 = np.uint64
#: Bytes of text that a Python worker takes up at a time; a longer text is taken up alone.
PORTION = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """The name of a new folder that driver and executors share."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it from there; any executor may be lost afterwards."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def portions(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PORTION) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about `most` bytes of a string or binary column, without copies; at least a row each."""
    for batch in batches:
        ends = texts_of(batch[column])[1]
        at = 0
        while at < len(batch):
            upto = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield batch.slice(at, upto - at)
            at = upto


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column, without a copy of the bytes; null is empty."""
    c = column.cast(pa.large_binary())
    if not len(c):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = c.buffers()
    return np.frombuffer(data or b"", np.uint8), np.frombuffer(offsets, np.int64, len(c) + 1, 8 * c.offset)


def blobs(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary Arrow column whose values are consecutive parts of an array; ends: after how many of its items each ends."""
    raw = np.ascontiguousarray(data)
    offsets = np.concatenate([[0], ends]) * raw.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw.view(np.uint8))]).cast(pa.binary())


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def remainder(doc_id: str, by: int):
    """crc32 of the id's decimal text, modulo `by`: decides which rows are held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % by


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the public splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n).bit_length())
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """c with hash(data[i:j]) == (c[j] - c[i]) * base**-i; data: uint8."""
    c = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + U64(1)) * powers(len(data))[0], out=c[1:])
    return c


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for an undirected edge table (a, b) of longs: component is the smallest node reachable.

    Alternates large-star and small-star steps until a round leaves every edge as it was; each round is cut into the
    checkpoint folder, and only counts reach the driver. Partial aggregation folds the edges of a hub before they meet.
    Nodes without an edge to another node don't appear.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        # settled: every node has one edge, to its component's smallest node, which has none upwards
        if after.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty() and after.join(after.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
        e = after
    else:
        raise RuntimeError("components did not settle")
    return after.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
