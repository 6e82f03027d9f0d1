"""Ranks over a whole table without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsignal.session import working_folder


def with_rank(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """Add each row's place in ``order``, from 0.

    The rows are dealt by range and written down, so that both readers see the same ranges.  Each
    range numbers its own rows, and only the sizes of the ranges are added up in one place.
    """
    path = working_folder(df.sparkSession, "ranked")
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()) \
        .write.parquet(path)
    dealt = df.sparkSession.read.schema(f"{df.schema.toDDL()}, _range int").parquet(path)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_range").agg(F.count("*").alias("_n")) \
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return dealt.withColumn("_own", own).join(starts, "_range") \
        .select(*df.columns, (F.col("_start") + F.col("_own")).cast("long").alias(out))
