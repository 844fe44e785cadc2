"""Table stores: catalogs that are replaced as a whole or appended to, results cached by key, and CSV reports."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Store(Protocol):
    """What the catalog and the status log need of their storage."""

    def load(self) -> DataFrame: ...

    def save(self, rows: DataFrame) -> None: ...

    def append(self, rows: DataFrame) -> None: ...


class ParquetStore:
    """A table of Parquet files in versions: a version is written whole before readers turn to it, so a failed job leaves the last one as it is.

    An append writes only its own rows, as one more folder of the newest version.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _listed(self, below: str = "") -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}{below}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [s.getPath() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(p.getName() for p in found if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def _versions(self) -> dict[int, bool]:
        """The versions' numbers, and whether they are complete."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return {int(n[1:]): bool(self._listed(f"/{n}")) for n in names if n.startswith("v")}

    def _version(self) -> int:
        return max((v for v, whole in self._versions().items() if whole), default=-1)

    def load(self) -> DataFrame:
        version = self._version()
        if version < 0:
            raise FileNotFoundError(self.folder)
        parts = [f"{self.folder}/v{version:06d}/{n}" for n in self._listed(f"/v{version:06d}")]
        return self.spark.read.option("mergeSchema", "true").parquet(*parts)

    def save(self, rows: DataFrame) -> None:
        rows.write.parquet(f"{self.folder}/v{max(self._versions(), default=-1) + 1:06d}/p000000")

    def append(self, rows: DataFrame) -> None:
        version = max(self._version(), 0)
        rows.write.mode("overwrite").parquet(f"{self.folder}/v{version:06d}/p{len(self._listed(f'/v{version:06d}')):06d}")


def result_key(source: str, method: str, settings: dict) -> str:
    """A key of a result's source, method and settings; it doesn't depend on the data."""
    short = lambda text, n: hashlib.sha1(text.encode()).hexdigest()[:n]
    return f"{short(source, 16)}-{method}-{short(json.dumps(settings, sort_keys=True), 8)}"


def load_or_build(spark: SparkSession, folder: str, source: str, method: str, settings: dict, build: Callable[[], DataFrame]) -> DataFrame:
    """A stored result; where there is none it is built and stored."""
    store = ParquetStore(spark, f"{folder}/{result_key(source, method, settings)}")
    try:
        return store.load()
    except FileNotFoundError:
        store.save(build())
        return store.load()


def write_report(rows: DataFrame, folder: str) -> None:
    rows.write.option("header", "true").csv(folder)


def read_report(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.read.option("header", "true").schema(schema).csv(folder)


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """Intermediate tables of a detector, one folder each."""
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
