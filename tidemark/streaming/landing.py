"""Streams: landing of messages and windowed activity, checkpointed and replayable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import parallelism
from tidemark.sources.landing import MESSAGE_SCHEMA


def kafka_source(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None) -> DataFrame:
    """A topic from its start; lost offsets do not stop the stream."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
    )
    return (reader.option("maxOffsetsPerTrigger", max_offsets) if max_offsets else reader).load()


def file_source(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int = 500) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(fmt).load(path)


def parse_messages(records: DataFrame, now: Column | None = None) -> DataFrame:
    """Message fields, broker coordinates and partition columns out of broker records."""
    body = F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA)
    landed = records.select(
        body.alias("m"),
        F.col("key").cast("string").alias("message_key"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    ).select("m.*", "message_key", "topic", "partition", "offset", "kafka_timestamp")
    return with_partitions(landed, F.col("kafka_timestamp") if now is None else now)


def with_partitions(df: DataFrame, moment: Column) -> DataFrame:
    """Processing time with its date and hour as partition texts."""
    return df.withColumns(
        {
            "processed_at": moment,
            "processing_date": F.date_format(moment, "yyyy-MM-dd"),
            "processing_hour": F.date_format(moment, "HH"),
        }
    )


# Input tasks of a batch whose rows of one hour share an output task.
GATHERED_TASKS = 4


def land(stream: DataFrame, path: str, checkpoint: str, every: str | None = "10 seconds") -> StreamingQuery:
    """Append to Parquet by date and hour; ``every=None`` handles what is there and stops.

    Rows of one hour from ``GATHERED_TASKS`` input tasks are written by one task.  A small
    batch so writes few files, and a large one, which the source cuts in more tasks,
    is written by as many more.
    """
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    share = F.floor(F.spark_partition_id() / GATHERED_TASKS)
    gathered = stream.withColumn("__share", share).repartition(
        parallelism(stream.sparkSession), "processing_date", "processing_hour", "__share"
    )
    return (
        gathered.drop("__share")
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("processing_date", "processing_hour")
        .trigger(**trigger)
        .start()
    )


def once_per_key(stream: DataFrame, keys: list[str], moment: str, window: str = "48 hours") -> DataFrame:
    """First message of a key within the time window; older state is dropped.

    For input in time order: a row that comes later than ``window`` behind the newest is dropped, also
    when its key was never seen.
    """
    return stream.withWatermark(moment, window).dropDuplicatesWithinWatermark(keys)


def windowed_volume(stream: DataFrame, moment: str, key: str, amount: str, width: str, late: str) -> DataFrame:
    """Volume and count per key and time window, final once the watermark passed.

    Rows later than ``late`` are dropped, and windows that the watermark has not passed are not written yet.
    """
    return (
        stream.withWatermark(moment, late)
        .groupBy(F.window(moment, width).alias("w"), key)
        .agg(F.sum(amount).alias("volume"), F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), key, "volume", "n")
    )


def run_to_end(frame: DataFrame, path: str, checkpoint: str) -> None:
    """Write a streaming frame to Parquet until its present input is used up."""
    query = (
        frame.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
