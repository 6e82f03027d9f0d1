"""Parquet tables of raw postings and skill demand.

Rows lie in folders by date.  Each write of a batch adds its rows under an attempt of its own and
then, once they are all there, one commit record; readers take the rows of the latest attempt of
every run and batch.  So a batch that is repeated after a failure counts once, what a failed attempt
left behind is not seen, and runs that number their batches alike don't touch each other.

``compact`` rewrites a day to few files, without the rows that no longer count.  ``close`` does so
for all days up to one, puts one closing record per run in the place of their commits, and adds
their demand to a rollup.  So the commits that a read opens are those of the days since, and the
market is the rollup and the rows of these days, however many batches there have been.

Each step of closing leaves a store that reads the same: rewritten rows count by their old commits
until the closing records replace these, and a rollup is used once its own record is there.  A
batch that is repeated after its day was closed takes the place of what it had written; until the
day is closed again the market is then added up from the rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsignal.schema import RAW_JOBS, SKILL_DEMAND
from jobsignal.session import working_folder

_TAGS = T.StructType().add("run_id", "string").add("attempt", "string").add("closing", "string")
# The commit of a batch, or with ``closing`` the record of a closed day's batches of one run: the
# highest of their numbers, when the day was closed, and which of them was committed last.
COMMITS = T.StructType().add("run_id", "string").add("batch_id", "long") \
    .add("attempt", "string").add("committed_at", "timestamp").add("closing", "string") \
    .add("newest_at", "timestamp").add("newest_batch", "long").add("date", "date")
ROLLUPS = T.StructType().add("until", "date").add("closed_at", "timestamp").add("folder", "string")
TOTALS = T.StructType().add("skill", "string").add("count", "long")


def _partitioned(df: DataFrame, path: str, mode: str, *columns: str) -> None:
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*columns).parquet(path))


@dataclass(frozen=True)
class DemandStore:
    """``<base>/raw_jobs`` by date and source, ``<base>/skill_demand`` by date, and their commits."""

    spark: SparkSession
    base: str

    @property
    def raw_path(self) -> str:
        return f"{self.base.rstrip('/')}/raw_jobs"

    @property
    def demand_path(self) -> str:
        return f"{self.base.rstrip('/')}/skill_demand"

    def write_raw(self, jobs: DataFrame, batch_id: int | Column, run_id: str = "") -> None:
        """Add postings of one or several batches of a run.

        A source that holds most of a batch is split over several files.
        """
        batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
        rows = jobs.withColumn("batch_id", batch.cast("long"))
        self._add(rows, self.raw_path, run_id, "date", "source")

    def write_demand(self, demand: DataFrame, batch_id: int | Column,
                     timestamp: Column | None = None, run_id: str = "") -> None:
        """Add (skill, count) rows of a batch; a batch without skills adds nothing."""
        batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
        rows = demand.select(
            "skill", F.col("count").cast("long").alias("count"),
            (F.current_timestamp() if timestamp is None else timestamp).alias("timestamp"),
            batch.cast("long").alias("batch_id"),
        ).withColumn("date", F.to_date("timestamp"))
        self._add(rows, self.demand_path, run_id, "date")

    def raw_jobs(self) -> DataFrame:
        """All raw postings that count; filters on date and source prune folders."""
        return self._committed(self.raw_path, RAW_JOBS)

    def skill_demand(self) -> DataFrame:
        return self._committed(self.demand_path, SKILL_DEMAND)

    def latest_demand(self) -> DataFrame:
        """The demand of the batch that was committed last; only its date is read."""
        every = self._log(self.demand_path)
        newest = every.agg(F.max(F.struct(
            F.coalesce("newest_at", "committed_at").alias("at"),
            F.coalesce("newest_batch", "batch_id").alias("batch_id"), "run_id", "date"))).scalar()
        rows = self._tagged(self.demand_path, SKILL_DEMAND)
        return rows.where((F.col("date") == newest["date"])
                          & (F.col("run_id") == newest["run_id"])
                          & (F.col("batch_id") == newest["batch_id"])) \
            .select(*SKILL_DEMAND.fieldNames())

    def market(self) -> DataFrame:
        """(skill, count): the demand of all batches, from the rollup and the days since."""
        rollup = self._rollup()
        rows = self.skill_demand()
        if rollup is None:
            return rows.groupBy("skill").agg(F.sum("count").alias("count"))
        closed = self.spark.read.schema(TOTALS).parquet(rollup["folder"])
        since = rows.where(F.col("date") > F.lit(rollup["until"])).select("skill", "count")
        return closed.unionByName(since).groupBy("skill").agg(F.sum("count").alias("count"))

    def close(self, until: str) -> None:
        """Close all days up to ``until`` (``yyyy-MM-dd``) that have commits, and roll them up.

        Nothing may be writing to these days meanwhile.  Days that are closed already are left
        alone unless batches were added to them.
        """
        last = F.col("date") <= F.lit(until).cast("date")
        for path, schema, parts in ((self.raw_path, RAW_JOBS, ("date", "source")),
                                    (self.demand_path, SKILL_DEMAND, ("date",))):
            if not self._exists(path):
                continue
            days = [r["date"] for r in self._log(path).where(last & F.col("closing").isNull())
                    .select("date").distinct().collect()]  # a row a day
            if days:
                self._close(path, schema, parts, days)
        if self._exists(self.demand_path):
            self._roll_up(until)

    def _close(self, path: str, schema: T.StructType, parts: tuple[str, ...], days: list) -> None:
        closing = uuid.uuid4().hex
        these = F.col("date").isin(days)
        rows = self._aside(self._tagged(path, schema).where(these)
                           .withColumn("closing", F.lit(closing)))
        newest = F.max(F.struct(F.coalesce("newest_at", "committed_at").alias("at"),
                                F.coalesce("newest_batch", "batch_id").alias("batch")))
        records = self._aside(self._log(path).where(these).groupBy("run_id", "date").agg(
            F.max("batch_id").alias("batch_id"), newest.alias("_n")).select(
            "run_id", "batch_id", F.lit(None).cast("string").alias("attempt"),
            F.current_timestamp().alias("committed_at"), F.lit(closing).alias("closing"),
            F.col("_n.at").alias("newest_at"), F.col("_n.batch").alias("newest_batch"), "date"))
        _partitioned(rows.hint("rebalance", *parts), path, "overwrite", *parts)
        _partitioned(records.coalesce(1), f"{path}_commits", "overwrite", "date")

    def _roll_up(self, until: str) -> None:
        """Add the days closed since the last rollup to it, or all of them where it is stale."""
        before = self._rollup()
        rows = self.skill_demand().where(F.col("date") <= F.lit(until).cast("date"))
        totals = rows.select("skill", "count")
        if before is not None and str(before["until"]) > until:
            return
        if before is not None:
            totals = rows.where(F.col("date") > F.lit(before["until"])).select("skill", "count") \
                .unionByName(self.spark.read.schema(TOTALS).parquet(before["folder"]))
        folder = f"{self.demand_path}_rollup/{uuid.uuid4().hex}"
        totals.groupBy("skill").agg(F.sum("count").alias("count")).coalesce(1) \
            .write.parquet(folder)
        self.spark.range(1).select(
            F.lit(until).cast("date").alias("until"), F.current_timestamp().alias("closed_at"),
            F.lit(folder).alias("folder")).write.mode("append").parquet(
            f"{self.demand_path}_rollups")

    def _rollup(self) -> Row | None:
        """The record of the newest rollup, if it still holds all of its days.

        It does unless one of its days was closed again later, or a batch was added to them or
        stands in for one of their batches.
        """
        if not self._found(f"{self.demand_path}_rollups"):
            return None
        newest = self.spark.read.schema(ROLLUPS).parquet(f"{self.demand_path}_rollups") \
            .agg(F.max(F.struct("closed_at", "until", "folder")).alias("r")).first()["r"]
        log = self._log(self.demand_path)
        mine = F.col("date") <= F.lit(newest["until"])
        later = log.where(mine & ((F.col("committed_at") > F.lit(newest["closed_at"]))
                                  | F.col("closing").isNull()))
        highest = log.where(mine & F.col("closing").isNotNull()).groupBy("run_id").agg(
            F.max("batch_id").alias("highest"))
        again = log.where(F.col("closing").isNull()).join(highest, "run_id") \
            .where(F.col("batch_id") <= F.col("highest"))
        stale = not later.isEmpty() or not again.isEmpty()
        return None if stale else newest

    def has_demand(self) -> bool:
        return self._exists(self.demand_path)

    def has_raw(self) -> bool:
        return self._exists(self.raw_path)

    def compact(self, date: str) -> None:
        """Rewrite a day (``yyyy-MM-dd``) that nothing writes to: its rows that count, in few files.

        The new files are written aside first, and replace the day's folders in one commit each.
        """
        for path, schema, parts in ((self.raw_path, RAW_JOBS, ("date", "source")),
                                    (self.demand_path, SKILL_DEMAND, ("date",))):
            if not self._exists(path):
                continue
            day = F.col("date") == F.lit(date).cast("date")
            commits = self._aside(self._log(path).where(day))
            rows = self._aside(self._tagged(path, schema).where(day))
            _partitioned(rows.hint("rebalance", *parts), path, "overwrite", *parts)
            _partitioned(commits.coalesce(1), f"{path}_commits", "overwrite", "date")

    def _add(self, rows: DataFrame, path: str, run_id: str, *parts: str) -> None:
        """Write the rows, then a commit for each batch and date among them.

        The dates are noted while the rows are written, so that the commits are made from the files
        of those days and nothing is computed twice.
        """
        attempt = uuid.uuid4().hex
        seen = Observation()
        tagged = rows.withColumns({"run_id": F.lit(run_id), "attempt": F.lit(attempt),
                                   "closing": F.lit(None).cast("string")}) \
            .observe(seen, F.min("date").alias("first"), F.max("date").alias("last"))
        _partitioned(tagged.hint("rebalance", *parts), path, "append", *parts)
        days = seen.get
        written = self.spark.read.schema(self._stored(rows.schema)).parquet(path).where(
            F.col("date").between(F.lit(days["first"]), F.lit(days["last"]))
            & (F.col("attempt") == attempt))
        done = written.groupBy("batch_id", "date").agg(F.count("*").alias("n")).select(
            F.lit(run_id).alias("run_id"), "batch_id", F.lit(attempt).alias("attempt"),
            F.current_timestamp().alias("committed_at"), *[
                F.lit(None).cast(COMMITS[c].dataType).alias(c)
                for c in ("closing", "newest_at", "newest_batch")], "date")
        _partitioned(done.coalesce(1), f"{path}_commits", "append", "date")

    def _stored(self, schema: T.StructType) -> T.StructType:
        names = set(schema.fieldNames())
        return T.StructType([*schema.fields, *[f for f in _TAGS if f.name not in names],
                             *([] if "date" in names else [T.StructField("date", T.DateType())])])

    def _rows(self, path: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(self._stored(schema)).parquet(path)

    def _log(self, path: str) -> DataFrame:
        """The latest attempt of every open batch, once for each date it has rows of, and the
        records of closed days."""
        every = self.spark.read.schema(COMMITS).parquet(f"{path}_commits")
        opened = every.where(F.col("closing").isNull())
        latest = opened.groupBy("run_id", "batch_id").agg(
            F.max(F.struct("committed_at", "attempt")).alias("m"))
        latest = latest.select("run_id", "batch_id", "m.attempt")
        return opened.join(latest, ["run_id", "batch_id", "attempt"], "left_semi") \
            .select(*every.columns).unionByName(every.where(F.col("closing").isNotNull()))

    def _tagged(self, path: str, schema: T.StructType) -> DataFrame:
        """The rows that count: of the latest attempt of an open batch, or of a closed day and of a
        batch that no open one stands in for."""
        log = self._log(path)
        opened = log.where(F.col("closing").isNull()).select(
            F.col("run_id").alias("_run"), F.col("batch_id").alias("_batch"),
            F.col("attempt").alias("_attempt")).distinct()
        closed = log.where(F.col("closing").isNotNull()).select(
            F.col("closing").alias("_closing")).distinct()
        rows = self._rows(path, schema)
        met = rows.join(opened, (F.col("run_id") == F.col("_run"))
                        & (F.col("batch_id") == F.col("_batch")), "left") \
            .join(closed, F.col("closing") == F.col("_closing"), "left")
        counts = F.when(F.col("_attempt").isNotNull(), F.col("attempt") == F.col("_attempt")) \
            .otherwise(F.col("_closing").isNotNull())
        return met.where(counts).select(*rows.columns)

    def _committed(self, path: str, schema: T.StructType) -> DataFrame:
        return self._tagged(path, schema).select(*schema.fieldNames())

    def _aside(self, df: DataFrame) -> DataFrame:
        path = working_folder(self.spark, "compact")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _exists(self, path: str) -> bool:
        return self._found(f"{path}_commits")

    def _found(self, folder: str) -> bool:
        try:
            self.spark.read.schema(COMMITS).parquet(folder)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True
