"""Keyed state between runs, as a stream. The batch semantics are those of snapshots and ledgers; the windowed
counts go beyond what a daily batch needs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def read_runs(spark: SparkSession, path: str, schema: str, files_at_once: int = 1) -> DataFrame:
    """Rows of run folders as they land."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).option("recursiveFileLookup", True).parquet(path)


def first_seen(rows: DataFrame, key: str, at: str, horizon: str = "90 days") -> DataFrame:
    """Each key once within the horizon; the state of older keys goes."""
    return rows.withWatermark(at, horizon).dropDuplicatesWithinWatermark([key])


def append_new(path: str, key: list[str], order: list[str] | None = None, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: appends rows whose key the ledger at path does not have, so a batch can run twice.

    Of rows of one key the first by `order` (all columns, if none is given)
    counts. The ledger lies in buckets of keys, and a batch reads those alone
    that its own keys are in.
    """

    def run(batch: DataFrame, _: int) -> None:
        spark, others = batch.sparkSession, [c for c in batch.columns if c not in key]
        first = F.min_by(F.struct(*others), F.struct(*(order or others))) if others else F.lit(None)
        fresh = batch.groupBy(*key).agg(first.alias("_first")).select(*key, *(["_first.*"] if others else []))
        fresh = fresh.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            met = [r["_bucket"] for r in fresh.select("_bucket").distinct().collect()]
            known = spark.read.schema(fresh.schema).parquet(path).where(F.col("_bucket").isin(met)).select(*key)
            fresh = fresh.join(known, key, "left_anti")
        fresh.write.mode("append").partitionBy("_bucket").parquet(path)

    return run


def windowed_counts(rows: DataFrame, at: str, kind: str, late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Counts by window and kind; a window is emitted once its rows can no longer be late."""
    return rows.withWatermark(at, late).groupBy(F.window(at, size), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")


def into(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def changes(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Rows of a stream as Parquet; a batch that ran twice is there once for whoever reads the folder with Spark."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True)
