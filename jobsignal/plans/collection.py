"""One collection run: landed responses -> filtered, de-duplicated postings and statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignal.functions.rules import string_array
from jobsignal.operators.postings import (
    cycle_totals, deduplicate, deduplicate_written, select_sources, union_feeds,
)
from jobsignal.operators.requests import CollectionFilters
from jobsignal.schema import CYCLE_STATS
from jobsignal.session import working_folder
from jobsignal.sources import messages
from jobsignal.sources.feeds import ADAPTERS, FEEDS, iso_now, rejected


# --- fixed values: how files of sent messages are written ------------------------------------
SENT_FILES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


@dataclass(frozen=True)
class Collection:
    """A run.  ``fetched`` are all postings, written down once; ``postings`` the distinct ones, and
    ``rejected`` the responses and entries that could not be read, with their reasons."""

    fetched: DataFrame
    postings: DataFrame
    rejected: DataFrame
    filters: CollectionFilters
    asked: tuple[str, ...]
    now: Column

    def stats(self, sent: bool = False) -> DataFrame:
        """One row per cycle; ``sent_total`` is 0 unless the postings have been sent."""
        return cycle_stats(self.fetched, self.filters, self.asked, self.now, sent, self.rejected)

    def send(self, kind: str, location: str, topic: str = messages.TOPIC) -> DataFrame:
        """Publish the distinct postings; the statistics with what was sent.

        The texts are sent from the files that they were written to; only what tells postings apart
        is shuffled.  Files of messages are compressed.  The statistics are made once, as they are
        compared with what was sent.  Raises if the sink took another number of messages than there
        are postings.
        """
        postings = deduplicate_written(self.fetched, within=("cycle",))
        options = SENT_FILES if kind == "files" else {}
        taken = messages.publish(postings, kind, location, topic, **options)
        stats = _written(self.stats(sent=True), "stats")
        due = stats.agg(F.coalesce(F.sum("sent_total"), F.lit(0))).first()[0]
        if taken != due:
            raise RuntimeError(f"{taken} messages sent of {due}")
        return stats


def collect(landed: DataFrame, filters: CollectionFilters, now: Column | None = None) -> Collection:
    """Postings of the selected feeds, the first of every (title, company, location) per cycle.

    Feeds are ranked in their fixed order, whatever the order of ``filters.sources``.  Responses are
    parsed once: the postings are written to the working folder, where all later steps read them,
    and beside them what could not be read.  A damaged response costs its own postings only.
    """
    spark = landed.sparkSession
    stamp = iso_now() if now is None else now
    asked = [f for f in FEEDS if filters.enabled and f in filters.sources]
    landed = select_sources(landed, filters.sources, filters.enabled)
    frames = {}
    for feed in asked or FEEDS:
        adapter = ADAPTERS[feed]
        limits = (filters.categories, filters.regions) if adapter.filtered else ()
        frames[feed] = adapter.read(landed, *limits, now=stamp)
    fetched = _written(union_feeds(frames), "fetched")
    return Collection(fetched, deduplicate(fetched, within=("cycle",)),
                      _written(rejected(landed), "rejected"), filters, tuple(asked), stamp)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = working_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cycle_stats(fetched: DataFrame, filters: CollectionFilters, asked: Sequence[str],
                now: Column, sent: bool, rejects: DataFrame | None = None) -> DataFrame:
    """One statistics row per cycle, also for one of which nothing but ``rejects`` is left."""
    settings = asdict(filters)
    fields = [
        (string_array(list(settings[f.name])) if f.dataType.typeName() == "array"
         else F.lit(settings[f.name]).cast(f.dataType)).alias(f.name)
        for f in CYCLE_STATS["filters"].dataType
    ]
    totals = cycle_totals(fetched, asked, by=("cycle",))
    none = F.lit(0).cast("long")
    if rejects is None:
        totals = totals.withColumn("rejected_total", none)
    else:
        counts = rejects.groupBy(F.col("cycle").alias("_cycle")).agg(F.count("*").alias("_n"))
        zeros = F.create_map(*[c for s in asked for c in (F.lit(s), none)]) if asked \
            else F.from_json(F.lit("{}"), "map<string,bigint>")
        totals = totals.join(counts, F.col("cycle").eqNullSafe(F.col("_cycle")), "full").select(
            F.coalesce("cycle", "_cycle").alias("cycle"),
            F.coalesce("fetched_total", none).alias("fetched_total"),
            F.coalesce("deduplicated_total", none).alias("deduplicated_total"),
            F.coalesce("by_source", zeros).alias("by_source"),
            F.coalesce("_n", none).alias("rejected_total"))
    return totals.select(
        "cycle",
        now.alias("timestamp"),
        F.struct(*fields).alias("filters"),
        "fetched_total",
        "deduplicated_total",
        (F.col("deduplicated_total") if sent else none).alias("sent_total"),
        "by_source",
        "rejected_total",
    )


def write_stats(stats: DataFrame, path: str) -> None:
    """Replace the stored statistics of the last run."""
    stats.write.mode("overwrite").json(path)
