"""Extensions on event time: demand per period, and de-duplication across cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignal.operators.postings import DEDUP_KEYS, dedup_keys


def skill_trend(demand: DataFrame, period: str = "1 day", late: str = "1 day",
                time: str = "timestamp") -> DataFrame:
    """(period_start, skill, count): demand per period, for a table or a stream.

    In a stream, rows later than ``late`` are dropped and a period's state is freed once the
    watermark has passed it.
    """
    rows = demand.withWatermark(time, late) if demand.isStreaming else demand
    counted = rows.groupBy(F.window(time, period), "skill").agg(F.sum("count").alias("count"))
    return counted.select(F.col("window.start").alias("period_start"), "skill", "count")


def deduplicate_stream(postings: DataFrame, within: str) -> DataFrame:
    """One posting per (title, company, location) for as long as ``within`` after the first arrived.

    Time is that of arrival, the time of the micro-batch.  A posting whose own timestamp is old is
    therefore never late: it is kept if its key is new, however late it comes.  State is kept per
    key and freed by the watermark; a key that comes again after ``within`` counts as new.
    """
    keys = [f"_{c}" for c in DEDUP_KEYS]
    keyed = postings.select("*", *dedup_keys(), F.current_timestamp().alias("_arrived")) \
        .withWatermark("_arrived", within)
    return keyed.dropDuplicatesWithinWatermark(keys).drop(*keys, "_arrived")
