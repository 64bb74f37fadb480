"""Structured Streaming over growing folders: windows with late data, and upserts into a state table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curul.operators.incremental import upsert_by_status


def read_growing(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the parquet files that appear under a path."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def window_counts(stream: DataFrame, at: str, keys: list[str], value: str, window: str, late: str) -> DataFrame:
    """(start, keys..., n, total) of tumbling windows; rows later than ``late`` behind the newest are left out."""
    w = stream.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return w.select(F.col("w.start").alias("start"), *keys, "n", "total")


def session_counts(stream: DataFrame, at: str, keys: list[str], gap: str, late: str) -> DataFrame:
    """(start, stop, keys..., n) of sessions: rows of a key less than ``gap`` apart."""
    w = stream.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return w.select(F.col("w.start").alias("start"), F.col("w.end").alias("stop"), *keys, "n")


def run_to_table(stream: DataFrame, out: str, checkpoint: str, mode: str = "complete") -> None:
    """Processes all that is there, replacing the table with the newest full result (complete), or adding (append).

    What a batch adds goes to a folder of its number, so a batch that is run again after a failure replaces itself. In
    append mode windows leave the state as the watermark passes them."""

    def write(batch: DataFrame, number: int) -> None:
        if mode == "complete":
            batch.write.mode("overwrite").parquet(out)
        else:
            batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    q = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def stream_upsert(stream: DataFrame, state: str, checkpoint: str, key: str, status: str, order: list[str]) -> None:
    """Merges all that is there into a state table of one row a key; a finished entry is never replaced by a failed one.

    The table is written to a new folder by batch number, so a batch that is run again after a failure gives the same
    table; the newest is that of the highest number. A previous table that can't be read raises: only the very first
    batch begins with an empty state."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = spark.read.parquet(f"{state}/v{number - 1}") if number else batch.limit(0)
        upsert_by_status(before, batch, key, status, order).write.mode("overwrite").parquet(f"{state}/v{number}")

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
