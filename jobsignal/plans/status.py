"""Overviews: stored totals, active filters and the last collection run."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.operators.requests import CollectionFilters
from jobsignal.schema import CYCLE_STATS
from jobsignal.sources.store import DemandStore


def totals(raw_jobs: DataFrame, latest: DataFrame) -> DataFrame:
    """One row: stored postings, and the number of skills in the newest batch."""
    tracked = latest.agg(F.count_distinct("skill").alias("n")).scalar()
    return raw_jobs.agg(F.count("*").alias("total_jobs_processed")).select(
        "total_jobs_processed", tracked.alias("total_skills_tracked"))


def system_stats(store: DemandStore) -> DataFrame:
    """``totals`` of a store; 0 for a table that does not exist yet."""
    none = store.spark.range(0).select(F.lit("").alias("skill"), F.col("id").alias("count"))
    return totals(store.raw_jobs() if store.has_raw() else none,
                  store.latest_demand() if store.has_demand() else none)


def collection_status(spark: SparkSession, filters: CollectionFilters,
                      stats_path: str) -> DataFrame:
    """One row: the active filters and the statistics of the last run, null before the first."""
    active = filters.frame(spark)
    row = active.select(F.struct(*active.columns).alias("filters"))
    try:
        last = spark.read.schema(CYCLE_STATS).json(stats_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        last = spark.createDataFrame([], CYCLE_STATS)
    newest = last.agg(F.max_by(F.struct(*CYCLE_STATS.fieldNames()), "timestamp")).scalar()
    return row.select("filters", newest.alias("collector_metrics"))
