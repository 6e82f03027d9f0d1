"""Operators on posting rows: caps, union, de-duplication, cycle statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsignal.functions.rules import string_array
from jobsignal.functions.text import blank_to, strip
from jobsignal.schema import FEED_ORDER

DEDUP_KEYS = ("title", "company", "location")
_COUNTS = "map<string,bigint>"


def first_k(df: DataFrame, k: int, by: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first ``k`` rows of every group.

    Spark turns "row number <= k" into a group limit ahead of the shuffle, so a task sends at
    most ``k`` rows of a group however large the group is.
    """
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def select_sources(df: DataFrame, sources: Sequence[str], enabled: bool = True) -> DataFrame:
    """Rows of the listed sources; none when collection is switched off."""
    return df.where(F.col("source").isin(list(sources)) if enabled else F.lit(False))


def union_feeds(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Feeds one after the other; the position in the mapping becomes ``source_rank``."""
    ranked = [df.withColumn("source_rank", F.lit(i)) for i, df in enumerate(feeds.values())]
    return reduce(DataFrame.unionByName, ranked)


def dedup_keys() -> list[Column]:
    """Trimmed lower-case title, company and location; null counts as empty."""
    return [F.lower(strip(blank_to(F.col(c), ""))).alias(f"_{c}") for c in DEDUP_KEYS]


def deduplicate(df: DataFrame, order: Sequence[str] = FEED_ORDER,
                within: Sequence[str] = ()) -> DataFrame:
    """First posting of every (title, company, location), by ``order``.

    ``within`` names columns, such as a cycle id, whose values are de-duplicated separately.
    A key that holds a large part of the rows is cut to one row per task before the shuffle.
    """
    keyed = df.select("*", *dedup_keys())
    keys = [f"_{c}" for c in DEDUP_KEYS]
    return first_k(keyed, 1, by=[*within, *keys], order=order).drop(*keys)


def deduplicate_written(written: DataFrame, order: Sequence[str] = FEED_ORDER,
                        within: Sequence[str] = ()) -> DataFrame:
    """Like :func:`deduplicate`, for rows as they are read from Parquet files.

    The rows stay where they are.  Only the keys and the order are shuffled, with the file and the
    number of each row; the rows taken come back as one bit per row of their file, and every task
    reads its files once more with these bits at hand.
    """
    own = written.columns
    placed = written.select("*", F.col("_metadata.file_path").alias("_file"),
                            F.col("_metadata.row_index").alias("_row"))
    keys = [f"_{c}" for c in DEDUP_KEYS]
    narrow = placed.select(*within, *order, *dedup_keys(), "_file", "_row")
    first = first_k(narrow, 1, by=[*within, *keys], order=order)
    words = first.groupBy(F.col("_file").alias("_of"), F.shiftright("_row", 6).alias("_w")).agg(
        F.bit_or(F.expr("1L << cast(_row & 63 as int)")).alias("_bits"))
    taken = words.groupBy("_of").agg(F.array_sort(F.collect_list(F.struct("_w", "_bits")))
                                     .alias("_words"))

    def from_last(s: Column, i: Column) -> Column:
        """A word after a zero for each one, since the last of the list, that has no row taken."""
        last = F.coalesce(F.get("_words", i - 1)["_w"], F.lit(-1).cast("long"))
        return F.concat(F.array_repeat(F.lit(0).cast("long"), (s["_w"] - last - 1).cast("int")),
                        F.array(s["_bits"]))

    dense = taken.select("_of", F.flatten(F.transform("_words", from_last)).alias("_words"))
    word = F.get("_words", F.shiftright("_row", 6).cast("int"))
    bit = F.bit_get(word, (F.col("_row") % 64).cast("int"))
    return placed.join(F.broadcast(dense), F.col("_file") == F.col("_of")) \
        .where(bit == 1).select(*own)


def cycle_totals(fetched: DataFrame, sources: Sequence[str],
                 by: Sequence[str] = ()) -> DataFrame:
    """fetched_total, deduplicated_total and by_source (0 for a source without rows) per ``by``.

    The first step leaves one row per distinct posting and is combined before the shuffle, so
    neither a frequent posting nor a large source meets in one task.
    """
    keys = dedup_keys()
    per_key = fetched.groupBy(*by, *keys).agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("source") == s).alias(f"_s{i}") for i, s in enumerate(sources)],
    )
    counts = [c for i, s in enumerate(sources)
              for c in (F.lit(s), F.coalesce(F.sum(f"_s{i}"), F.lit(0)))]
    by_source = F.create_map(*counts) if counts else F.from_json(F.lit("{}"), _COUNTS)
    return per_key.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("fetched_total"),
        F.count("*").alias("deduplicated_total"),
        by_source.cast(_COUNTS).alias("by_source"),
    )


def counts_by_source(fetched: DataFrame, sources: Sequence[str]) -> DataFrame:
    """(source, postings) for every requested source, 0 for those without rows."""
    found = fetched.groupBy("source").agg(F.count("*").alias("postings"))
    asked = fetched.sparkSession.range(1).select(
        F.explode(string_array(sources)).alias("source"))
    return asked.join(found, "source", "left").select(
        "source", F.coalesce("postings", F.lit(0)).cast("long").alias("postings"))
