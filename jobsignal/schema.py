"""Row types of postings, messages, demand, filters and landed feeds."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


POSTING = T.StructType([
    *_strings("title", "company", "description", "source", "location", "salary", "url"),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("is_remote", T.BooleanType()),
    *_strings("timestamp"),
])

# What stream consumers read of a posting.
MESSAGE = T.StructType(
    _strings("title", "company", "description", "source", "location", "salary", "url", "timestamp")
)

# Where a row stood in its cycle: rank of the feed, of the request, and place in the payload.
FEED_ORDER = ("source_rank", "request", "pos")

RAW_JOBS = T.StructType([
    *_strings("title", "company", "description", "location", "salary", "url", "timestamp"),
    T.StructField("processed_at", T.TimestampType()),
    *_strings("source"),
    T.StructField("date", T.DateType()),
    T.StructField("batch_id", T.LongType()),
])

SKILL_DEMAND = T.StructType([
    *_strings("skill"),
    T.StructField("count", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
])

FILTERS = T.StructType([
    T.StructField("categories", T.ArrayType(T.StringType())),
    T.StructField("regions", T.ArrayType(T.StringType())),
    T.StructField("enabled", T.BooleanType()),
    T.StructField("refresh_interval", T.IntegerType()),
    T.StructField("sources", T.ArrayType(T.StringType())),
    *_strings("last_updated"),
])

CYCLE_STATS = T.StructType([
    *_strings("timestamp"),
    T.StructField("filters", FILTERS),
    T.StructField("fetched_total", T.LongType()),
    T.StructField("deduplicated_total", T.LongType()),
    T.StructField("sent_total", T.LongType()),
    T.StructField("by_source", T.MapType(T.StringType(), T.LongType())),
    # Responses and entries that could not be read.
    T.StructField("rejected_total", T.LongType()),
])

# A landed provider response: which cycle and feed, which request of the cycle, and its text.
LANDED = T.StructType([
    *_strings("cycle", "source"),
    T.StructField("request", T.IntegerType()),
    *_strings("query", "body"),
])

# Stored account documents of earlier releases.
STORED_RESUME = T.StructType([
    *_strings("resume_id", "user_id", "filename", "file_type", "text"),
    T.StructField("skills", T.ArrayType(T.StringType())),
    T.StructField("years_experience", T.DoubleType()),
    *_strings("education_level", "current_title", "upload_timestamp"),
])
STORED_USER = T.StructType([
    *_strings("user_id", "email", "name", "created_at", "last_login"),
    T.StructField("total_uploads", T.LongType()),
    T.StructField("total_analyses", T.LongType()),
])
