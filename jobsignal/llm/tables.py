"""What several operators share: written tables, running sums, components, split groups."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from functools import cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

import jobsignal
from jobsignal.session import working_folder


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a table to the shared folder (or `folder`) and read it back: its lineage ends there."""
    spark = df.sparkSession
    path = folder or working_folder(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@cache
def _ship(context: SparkContext) -> None:
    root = os.path.dirname(os.path.dirname(os.path.abspath(jobsignal.__file__)))
    folder = tempfile.mkdtemp(prefix="jobsignal-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/jobsignal_package", "zip", root, "jobsignal"))


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, whose Python workers import it; once per application."""
    _ship(spark.sparkContext)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def running_total(df: DataFrame, order: list[str], value: str, out: str,
                  within: str | None = None) -> DataFrame:
    """Add `out`: the sum of `value` over all rows that come before, in the order of `order`.

    With `within` the sum starts anew for each value of that column (nulls last); it then leads
    the order.  Rows are dealt by range, so that no group has to fit into one task: each range
    adds up its own rows, and the totals of the ranges, one row each, are added up separately.
    Rows that tie in `order` get their sums in an unspecified order.
    """
    lead = [F.col(within).asc_nulls_last()] if within else []
    keys = [*lead, *order]
    dealt = stored(df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()),
                   "ranges")
    part = ["_range"] + ([within] if within else [])
    totals = dealt.groupBy(*part).agg(F.sum(value).alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    if within:
        before = Window.partitionBy(within).orderBy("_range") \
            .rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*[F.col(c).alias(f"{c}_") for c in part],
                          F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*part).orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_range") == F.col("_range_")
    if within:
        same = same & F.col(within).eqNullSafe(F.col(f"{within}_"))
    summed = dealt.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = summed.join(bases, same)
    return joined.withColumn(out, (F.col("_base") + F.col("_inside")).cast("long")) \
        .select(*df.columns, out)


def tiles(df: DataFrame, group: list[str], spread: str | Column, size: int) -> DataFrame:
    """Deal groups out as tiles, so that any two rows of a group meet in one of them.

    A group of up to `size` rows is one tile.  A larger one is cut into blocks by the hash of
    `spread`, and each pair of blocks becomes a tile; a row goes to as many tiles as its group has
    blocks.  Adds `tile_i`, `tile_j` (the blocks) and `block` (the row's own).
    """
    spread = F.col(spread) if isinstance(spread, str) else spread
    counts = df.groupBy(*group).agg(F.ceil(F.count("*") / size).cast("int").alias("_blocks"))
    with_blocks = df.join(counts, group)
    own = F.when(F.col("_blocks") > 1,
                 F.pmod(F.xxhash64(spread, F.lit("block")), F.col("_blocks")).cast("int")) \
        .otherwise(0)
    return (with_blocks.withColumn("block", own)
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            .withColumn("tile_i", F.least("block", "_other"))
            .withColumn("tile_j", F.greatest("block", "_other"))
            .drop("_blocks", "_other"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph: (id, component_id = its smallest id).

    `edges` has long columns src and dst.  Large-star and small-star steps (Kiveris et al., 2014)
    until no edge changes; each round is written to the shared folder.  A vertex's smallest
    neighbour is combined per task before it is shuffled, and the join back lets the runtime split
    a vertex with very many edges.
    """
    work = stored(edges.filter("src <> dst")
                  .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
                  .distinct(), "edges")
    for _ in range(max_rounds):
        both = work.union(work.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lows = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(lows, "u").select(F.col("v").alias("u"),
                                                             F.col("m").alias("v")) \
            .filter("u <> v").distinct()
        large = stored(large, "large_star")
        lows = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lows, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(lows.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        seen = Observation()
        after = stored(small.observe(seen, F.count("*").alias("n"),
                                     F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
                                     .alias("h")), "small_star")
        now = (seen.get["n"], seen.get["h"])
        before = work.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        work = after
        if now == (before[0], before[1]):
            return work.select(F.col("u").alias("id"), F.col("v").alias("component_id")) \
                .union(work.select(F.col("v").alias("id"), F.col("v").alias("component_id"))
                       .distinct())
    raise RuntimeError(f"components still change after {max_rounds} rounds")
