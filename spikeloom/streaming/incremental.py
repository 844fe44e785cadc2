"""Streams: spike counts by unit and window with late data, and catalogs that grow by new files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spikeloom.functions.lineage import shared_root


def shared_folder(spark: SparkSession, name: str) -> str:
    """The name of a new folder that driver and executors share."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def window_counts(stream: DataFrame, time: str, keys: list[str], width: str, late: str) -> DataFrame:
    """Counts of rows by keys and tumbling windows; rows later than `late` behind the newest are dropped by the watermark."""
    return stream.withWatermark(time, late).groupBy(*keys, F.window(time, width).alias("w")).agg(F.count("*").alias("n")).select(*keys, F.col("w.start").alias("start"), "n")


def drain(result: DataFrame, mode: str = "append") -> DataFrame:
    """Runs a streaming result over all files there are, into Parquet files in the shared folder, and reads these."""
    spark, folder = result.sparkSession, shared_folder(result.sparkSession, "stream")
    if mode == "complete":
        keep = lambda batch, _: batch.write.mode("overwrite").parquet(f"{folder}/rows")
        result.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(result.schema).parquet(f"{folder}/rows")
    query = result.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/rows").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{folder}/rows")


def new_files(spark: SparkSession, schema, folder: str, state: str, handle) -> None:
    """Passes rows of files that were not seen before to handle(batch, number), once each; `state` remembers them."""
    spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(handle).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
