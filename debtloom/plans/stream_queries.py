"""Queries that read a table as a stream, all of what is there and then stop; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debtloom.session import scratch_path, table
from debtloom.streaming.incremental import first_seen, windowed_counts


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream; its times without a zone are those of the session's."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    one_file = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isFile()
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    df = reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir) if one_file else reader.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*[F.col(c).cast("timestamp").alias(c) if kind == "timestamp_ntz" else F.col(c) for c, kind in df.dtypes])


def _drained(spark: SparkSession, df: DataFrame, mode: str) -> DataFrame:
    """All that a streaming query gives for what has come so far: each batch is written to the shared folder, the whole of it in complete mode."""
    out, schema = scratch_path(spark, "stream"), df.schema

    def keep(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(out)

    df.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", scratch_path(spark, "stream-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(out)


def stream_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by type in windows of a day, with a watermark for late ones."""
    counts = _drained(spark, windowed_counts(_stream(spark, sf_dir, "events"), "ts", "1 day", "2 days", "event_type"), "complete")
    return counts.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


def stream_first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's first event of a type once, however often it comes; state is dropped with the watermark, so the stream is taken whole."""
    return _drained(spark, first_seen(_stream(spark, sf_dir, "events").withColumn("k", F.concat_ws("|", "user_id", "event_type")), "k", "ts", "100 days"), "append").groupBy("k").agg(F.count("*").alias("n"))


def queries() -> dict:
    return {f.__name__: f for f in (stream_event_counts, stream_first_events)}


def oracle_sql() -> dict[str, str]:
    return {
        "stream_event_counts": "SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
        "stream_first_events": "SELECT user_id || '|' || event_type AS k, 1 AS n FROM events GROUP BY 1",
    }
