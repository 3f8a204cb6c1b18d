"""Feeds as streams: late rows, state merged batch by batch, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from debtloom.operators.state import first_by, merge_state
from debtloom.session import settle


def file_feed(spark: SparkSession, path: str, schema: T.StructType, files_a_batch: int = 100) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def windowed_counts(events: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    """Rows of each window and key; rows later than ``late`` behind the newest are left out, and the state of older windows is dropped."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def first_seen(events: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """Each key's first row within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


class StateTable:
    """A keyed table in versions: each batch merges into a new one, and the newest whole one counts.

    A batch that is run again after a failure writes the same version again, so it counts once.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key

    def _versions(self) -> list[int]:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        return sorted(int(s.getPath().getName()[1:]) for s in fs.listStatus(root) if s.getPath().getName()[1:].isdigit() and fs.exists(hadoop.Path(s.getPath(), "_SUCCESS")))

    def read(self, before: int | None = None) -> DataFrame:
        kept = [v for v in self._versions() if before is None or v < before]
        if not kept:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v{kept[-1]}")

    def merge(self, batch: DataFrame, batch_id: int, order: str, stamp: str) -> None:
        """Merge the first row of each key in the batch; known values stay."""
        found = first_by(batch.where(F.col(self.key).isNotNull()), [self.key], [F.col(order)]).drop(order)
        merged = merge_state(self.read(batch_id), found, self.key, F.lit(stamp)).drop("is_new")
        settle(merged.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]), "state").write.mode("overwrite").parquet(f"{self.path}/v{batch_id}")


def run_feed(feed: DataFrame, state: StateTable, checkpoint: str, order: str, stamp: str) -> None:
    """Take all that has arrived, in batches, and stop; a later call goes on from there."""
    query = feed.writeStream.foreachBatch(lambda batch, n: state.merge(batch, n, order, stamp)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
