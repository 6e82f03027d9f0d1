"""Posting messages: the topic (or its file twin), parsing, publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsignal.schema import MESSAGE, POSTING

TOPIC = "job_postings"
CORRUPT = "_corrupt"


def message_stream(spark: SparkSession, kind: str, location: str, topic: str = TOPIC,
                   starting_offsets: str = "latest", **options: str) -> DataFrame:
    """A stream with one string column ``value``.

    ``kind="kafka"`` subscribes to the topic at the brokers in ``location``, which needs the
    Kafka connector on the class path; ``kind="files"`` follows a folder of JSON lines.
    """
    if kind == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", location)
                  .option("subscribe", topic)
                  .option("startingOffsets", starting_offsets))
        return reader.options(**options).load().select(F.col("value").cast("string"))
    if kind == "files":
        return spark.readStream.options(**options).text(location)
    raise ValueError(f"unknown message source {kind!r}")


def parse_messages(messages: DataFrame, flag_corrupt: bool = False) -> DataFrame:
    """Message text -> stream columns.  Malformed text gives a row of nulls.

    With ``flag_corrupt`` the text of such rows is kept in ``_corrupt``.
    """
    schema = MESSAGE
    if flag_corrupt:
        schema = T.StructType([*MESSAGE.fields, T.StructField(CORRUPT, T.StringType())])
    job = F.from_json(F.col("value").cast("string"), schema,
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return messages.select(job.alias("job")).select("job.*")


def with_processing_time(jobs: DataFrame) -> DataFrame:
    """Add ``processed_at`` and ``date``.

    In a stream this is the time of the micro-batch, which a repeated batch gets again.
    """
    return (jobs.withColumn("processed_at", F.current_timestamp())
            .withColumn("date", F.to_date("processed_at")))


def with_event_time(jobs: DataFrame) -> DataFrame:
    """Add ``event_time``, the posting's own timestamp; null where it cannot be read."""
    return jobs.withColumn("event_time", F.try_to_timestamp("timestamp"))


def to_messages(postings: DataFrame) -> DataFrame:
    """Postings -> JSON text in ``value``, absent fields written as null."""
    row = F.struct(*[F.col(f.name) for f in POSTING])
    return postings.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("value"))


def publish(postings: DataFrame, kind: str, location: str, topic: str = TOPIC,
            **options: str) -> int:
    """Send postings to the topic, or append them to a folder of JSON lines; how many were sent.

    The number is counted while the messages are written.  ``options`` are those of the writer.
    """
    sent = Observation()
    messages = to_messages(postings).observe(sent, F.count("*").alias("n"))
    if kind == "kafka":
        (messages.write.format("kafka").option("kafka.bootstrap.servers", location)
         .option("topic", topic).options(**options).save())
    elif kind == "files":
        messages.write.mode("append").options(**options).text(location)
    else:
        raise ValueError(f"unknown message sink {kind!r}")
    return sent.get["n"]
