"""Postings across collection cycles: what is new in a cycle, and when each posting was seen.

Each cycle adds one row per distinct posting in a folder of its own and marks those that no earlier
cycle had.  So the marked rows hold every posting once, and only they are looked through for a new
cycle; of these only the ones that pass a bitmap of the cycle's own keys are joined with it, which
decides exactly.  Nothing that is stored is written again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsignal.operators.bitmap import bitmap, bits_for, hashed, may_contain
from jobsignal.operators.postings import DEDUP_KEYS, dedup_keys, first_k
from jobsignal.schema import FEED_ORDER

_KEYS = [f"_{c}" for c in DEDUP_KEYS]
SEEN = T.StructType([T.StructField(k, T.StringType()) for k in _KEYS]
                    + [T.StructField("fresh", T.BooleanType()),
                       T.StructField("cycle", T.StringType())])


@dataclass(frozen=True)
class PostingHistory:
    """Which posting, by trimmed lower-case title, company and location, was in which cycle.

    Cycles are ordered by their names.  A cycle that is added again replaces itself; as what is
    new in it follows from the cycles before, these are added first.
    """

    spark: SparkSession
    base: str

    @property
    def path(self) -> str:
        return f"{self.base.rstrip('/')}/posting_history"

    def add(self, postings: DataFrame, cycle: str, order: tuple[str, ...] = FEED_ORDER) -> DataFrame:
        """Note a cycle's postings; those that no earlier cycle had, the first one of each.

        ``postings`` is read twice, to note its keys and for the result.
        """
        rows = postings.select(*dedup_keys()).distinct()
        known = self._known(rows, cycle)
        fresh = rows.join(known.withColumn("_old", F.lit(True)), _KEYS, "left") \
            .select(*_KEYS, F.col("_old").isNull().alias("fresh"), F.lit(cycle).alias("cycle"))
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("cycle").parquet(self.path)
        new = self._rows().where((F.col("cycle") == cycle) & F.col("fresh")).select(*_KEYS)
        keyed = postings.select("*", *dedup_keys()).join(new, _KEYS, "left_semi")
        return first_k(keyed, 1, by=_KEYS, order=order).select(*postings.columns)

    def seen(self) -> DataFrame:
        """(title, company, location, first_cycle, last_cycle, cycles), a row per posting."""
        return self._rows().groupBy(*_KEYS).agg(
            F.min("cycle").alias("first_cycle"), F.max("cycle").alias("last_cycle"),
            F.count("*").alias("cycles")).withColumnsRenamed(dict(zip(_KEYS, DEDUP_KEYS)))

    def new_by_cycle(self) -> DataFrame:
        """(cycle, postings, new): distinct postings of every cycle and the new ones among them."""
        return self._rows().groupBy("cycle").agg(
            F.count("*").alias("postings"), F.count_if("fresh").alias("new"))

    def _known(self, keys: DataFrame, cycle: str) -> DataFrame:
        """Of the postings of earlier cycles those that may be among ``keys``."""
        earlier = self._rows().where((F.col("cycle") < cycle) & F.col("fresh"))
        bits = bits_for(keys.count())
        found = bitmap(keys.select(hashed(*_KEYS).alias("mark")), "mark", bits).scalar()
        return earlier.select(*_KEYS, found.alias("_bitmap")) \
            .where(may_contain(F.col("_bitmap"), hashed(*_KEYS), bits)).select(*_KEYS)

    def _rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(SEEN).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SEEN)
