"""The posting stream: parse, store raw postings, count skills per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jobsignal.dictionaries import POSTINGS, SkillDictionary
from jobsignal.operators.market import posting_demand
from jobsignal.sources.messages import parse_messages, with_processing_time
from jobsignal.sources.store import DemandStore

TRIGGER = "30 seconds"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns a checkpoint: it stays over restarts, and a new checkpoint has
    a new one."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def batch_writer(store: DemandStore, dictionary: SkillDictionary = POSTINGS,
                 fallback: bool = False,
                 checkpoint: str | None = None) -> Callable[[DataFrame, int], None]:
    """The work on one micro-batch.  Errors end the batch; the query then repeats it.

    Batches are told apart by the run that the ``checkpoint`` belongs to and their number in it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Two tables come from the batch; without this it would be read from the source twice.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            run = run_of(store.spark, checkpoint) if checkpoint else ""
            store.write_raw(batch, batch_id, run)
            demand = posting_demand(batch, dictionary, fallback)
            store.write_demand(demand, batch_id, batch_time(batch), run)
        finally:
            batch.unpersist()

    return write


def batch_time(batch: DataFrame):
    """The processing time of the batch, the same when the batch is repeated."""
    return batch.agg(F.max("processed_at")).scalar()


def start(
    messages: DataFrame,
    store: DemandStore,
    checkpoint: str,
    dictionary: SkillDictionary = POSTINGS,
    fallback: bool = False,
    trigger: str | None = TRIGGER,
    name: str = "job_postings",
) -> StreamingQuery:
    """Start the stream.

    ``checkpoint`` names the query's own folder, so a restart goes on where it stopped.
    ``trigger=None`` works off what is there and ends.
    """
    jobs = with_processing_time(parse_messages(messages))
    writer = (jobs.writeStream.queryName(name).outputMode("append")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(batch_writer(store, dictionary, fallback, checkpoint)))
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()
