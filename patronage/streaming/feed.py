"""Click messages in, result messages out. The same code serves batch and stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import schemas
from ..functions.columns import pageview


def kafka_options(
    servers: str,
    topics: Sequence[str],
    group: str | None = None,
    offsets: str = "latest",
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": offsets,
    }
    if group is not None:
        options["kafka.group.id"] = group
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_messages(spark: SparkSession, servers: str, topics: Sequence[str], **options) -> DataFrame:
    """(value, timestamp) of a topic subscription; needs the Kafka connector on the classpath."""
    source = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **options))
    return source.load().select(F.col("value").cast("string").alias("value"), "timestamp")


def file_rows(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    pattern: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A folder of Parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def decode_events(messages: DataFrame) -> DataFrame:
    """JSON messages as (topic, data, timestamp); unreadable ones are left out."""
    event = F.from_json("value", schemas.CLICK_EVENT)
    return (
        messages.select(event.alias("e"), "timestamp")
        .where(F.col("e.data").isNotNull())
        .select("e.topic", "e.data", "timestamp")
    )


def page_views(events: DataFrame) -> DataFrame:
    """(site, visitor, pageurl, timestamp) of each click event."""
    return events.select(*pageview(F.col("data")), "timestamp")


def json_messages(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each row as one JSON message with just the given fields."""
    return df.select(F.to_json(F.struct(*columns)).alias("value"))


def write_files(
    df: DataFrame, path: str, checkpoint: str, *, drain: bool = False
) -> StreamingQuery:
    """Append finished rows as Parquet files, exactly once."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()


def write_updates(
    df: DataFrame, path: str, checkpoint: str, *, drain: bool = False
) -> StreamingQuery:
    """Changed rows of every trigger as Parquet, a folder each; a repeated trigger replaces its own.

    ``latest`` reads the newest row of each key. With a watermark on the counts, state
    and each trigger's output stay as small as the open windows.
    """

    def store(result: DataFrame, trigger: int) -> None:
        result.write.mode("overwrite").parquet(f"{path}/trigger={trigger}")

    return write_each(df, store, checkpoint, "update", drain=drain)


def latest(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key among what ``write_updates`` has stored.

    A trigger names a key once, so what a single trigger has stored is returned as it is. Otherwise
    columns are taken one by one, which lets numbers be aggregated without sorting the rows.
    """
    found = spark.read.schema(f"{schema.toDDL()}, trigger int").parquet(path)
    used = found.agg(F.min("trigger").alias("first"), F.max("trigger").alias("last")).first()
    if used["first"] == used["last"]:
        return found.select(*schema.fieldNames())
    newest = [F.max_by(f.name, "trigger").alias(f.name) for f in schema.fields if f.name not in keys]
    return found.groupBy(*keys).agg(*newest).select(*schema.fieldNames())


def write_kafka(
    df: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "update"
) -> StreamingQuery:
    """Messages to a topic; at least once, so readers may see a repeated count."""
    return (
        df.writeStream.format("kafka")
        .outputMode(mode)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def write_each(
    df: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "update",
    *,
    drain: bool = False,
) -> StreamingQuery:
    """Hand every trigger's result to ``sink`` as a batch DataFrame."""
    writer = df.writeStream.foreachBatch(sink).outputMode(mode).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()
