"""Stream sources and sinks. Topics carry text; a log folder can stand in for a topic."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Topic names and the key of forwarded messages.
RATING_TOPIC = "recommender"
LOG_TOPIC = "log"
MESSAGE_KEY = "logProcessor"


def topic_source(spark: SparkSession, servers, topic, starting="latest", per_batch=None) -> DataFrame:
    """Stream of ``value`` strings from a Kafka topic (needs the Kafka package on the class path)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("groupIdPrefix", "recommender")
    )
    if per_batch:
        reader = reader.option("maxOffsetsPerTrigger", per_batch)
    return reader.load().select(F.col("value").cast("string"))


def log_folder_source(spark: SparkSession, folder, files_per_batch=None) -> DataFrame:
    """Stream of lines from files that appear in a folder."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def table_folder_source(spark: SparkSession, folder, schema, glob="*.parquet", files_per_batch=None):
    """Stream of rows from Parquet files that appear in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def topic_sink(messages: DataFrame, servers, checkpoint, topic=RATING_TOPIC):
    """Writer of ``value`` strings to a Kafka topic under one constant key."""
    return (
        keyed(messages)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def folder_sink(rows: DataFrame, folder, checkpoint):
    """Exactly-once Parquet writer of an append stream."""
    return rows.writeStream.format("parquet").option("path", folder).option(
        "checkpointLocation", checkpoint
    )


def run_available(writer):
    """Start a stream writer, work off all that is there, and stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def keyed(messages: DataFrame) -> DataFrame:
    """Messages under the constant key they carry in a topic."""
    return messages.select(F.lit(MESSAGE_KEY).alias("key"), "value")
