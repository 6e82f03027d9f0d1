"""The registered queries: every operator run over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import views as V
from catalog.oracles import MARKUP_TERMS, PHRASE_TERMS
from jobsignal.dictionaries import BASIC, POSTINGS, SkillDictionary, all_skills
from jobsignal.functions import rules
from jobsignal.functions import skills as S
from jobsignal.functions.text import html_to_text, word_count
from jobsignal.operators import (
    distinct, extraction, gap, market, postings, requests, similarity,
)
from jobsignal.operators.history import PostingHistory
from jobsignal.operators.needle_table import category_needles, met_needles, region_needles
from jobsignal.operators.requests import CollectionFilters
from jobsignal.operators.term_table import table_mentions as dictionary_mentions
from jobsignal.operators.term_table import term_table
from jobsignal.plans.collection import collect, cycle_stats, write_stats
from jobsignal.plans.resume_gap import gap_bundle as bundle
from jobsignal.plans.resume_gap import resume_report as report
from jobsignal.plans.status import collection_status, system_stats
from jobsignal.schema import LANDED
from jobsignal.session import working_folder
from jobsignal.sources import feeds, messages
from jobsignal.sources.resumes import accepted_uploads
from jobsignal.sources.store import DemandStore
from jobsignal.streaming import processor, trends

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def joined(array: str | Column) -> Column:
    return F.array_join(array, "|")


# Extraction ---------------------------------------------------------------------------------


@query
def skill_demand_topk(spark, sf):
    return market.top_n(market.posting_demand(V.postings(spark, sf), V.VOCABULARY), 20)


@query
def demand_of_all_skills(spark, sf):
    """Every posting skill, also those that no posting names."""
    names = spark.createDataFrame([(n,) for n in all_skills(distinct=True)], "skill string")
    found = market.posting_demand(V.postings(spark, sf), POSTINGS)
    return names.join(found, "skill", "left").select(
        "skill", F.coalesce("count", F.lit(0)).cast("long").alias("count"))


@query
def skill_demand_by_source(spark, sf):
    return market.posting_demand(V.postings(spark, sf), V.VOCABULARY, by=["source"])


@query
def skill_mentions(spark, sf):
    return extraction.skill_mentions(V.documents(spark, sf), ["doc_id"], F.col("text"),
                                     V.TEXT_TERMS)


@query
def full_dictionary_mentions(spark, sf):
    return extraction.skill_mentions(V.documents(spark, sf), ["doc_id"], F.col("text"),
                                     V.VOCABULARY)


@query
def page_mentions(spark, sf):
    return extraction.skill_mentions(_pages(spark, sf), ["page_id"], F.col("html"), POSTINGS)


@query
def phrase_mentions(spark, sf):
    return extraction.skill_mentions(V.documents(spark, sf), ["doc_id"], F.col("text"),
                                     SkillDictionary.titled(PHRASE_TERMS))


@query
def token_boundary_mentions(spark, sf):
    terms = SkillDictionary.titled(MARKUP_TERMS, boundary="token")
    return extraction.skill_mentions(_pages(spark, sf), ["page_id"], F.col("html"), terms)


@query
def skill_list_per_doc(spark, sf):
    listed = V.documents(spark, sf).select(
        "doc_id", S.skill_list(F.col("text"), V.VOCABULARY).alias("s"))
    return listed.select("doc_id", joined("s").alias("skills"), F.size("s").alias("skill_count"))


@query
def top_skills_per_doc(spark, sf):
    return extraction.top_skills_per_text(V.documents(spark, sf), ["doc_id"], F.col("text"),
                                          V.TEXT_TERMS, 3)


@query
def match_required_skills(spark, sf):
    found = S.match_skills(F.col("text"), ["That", "OF THE", "Rest", "nowhere", "t"])
    return V.documents(spark, sf).select("doc_id", F.explode_outer(found)
                                         .alias("required", "found"))


@query
def match_own_skills(spark, sf):
    """Which of its own words a text is asked for it has: the skills are a column."""
    asked = F.array(F.col("lang"), F.lit("That"), F.lit("of the"), F.col("source"))
    return V.documents(spark, sf).select("doc_id", F.explode_outer(
        S.match_skills(F.col("text"), asked)).alias("required", "found"))


@query
def skill_similarity(spark, sf):
    """Skills the two sides of every conversation have in common."""
    rows = V.turns(spark, sf).select(
        "conv_id", "role",
        F.explode_outer(S.skill_list(F.col("text"), V.RESUME_TERMS)).alias("skill"))

    def side(role: str) -> Column:
        return F.collect_set(F.when(F.col("role") == role, F.col("skill")))

    pairs = rows.groupBy("conv_id").agg(side("user").alias("a"), side("assistant").alias("b"))
    return pairs.select("conv_id", S.jaccard(F.col("a"), F.col("b")).alias("similarity"))


@query
def table_mentions(spark, sf):
    """Two dictionaries of a table looked up in all texts at once."""
    terms = term_table(spark, {"text": V.TEXT_TERMS, "resume": V.RESUME_TERMS})
    return dictionary_mentions(V.documents(spark, sf), ["doc_id"], F.col("text"), terms) \
        .drop("term")


@query
def opening_mentions(spark, sf):
    """Where the openings of all texts, their first two words, occur in any text."""
    words = F.split("text", " ", 3)  # the rest of the text stays uncut
    pair = F.array_join(F.slice(words, 1, 2), " ")
    plain = F.rlike(F.get(words, F.lit(0)), F.lit(r"^[A-Za-z]+$")) \
        & F.rlike(F.get(words, F.lit(1)), F.lit(r"^[A-Za-z]+$"))
    terms = V.documents(spark, sf).where(plain).select(
        F.col("lang").alias("dict_id"), F.lower(pair).alias("term"), pair.alias("skill"))
    return dictionary_mentions(V.documents(spark, sf), ["doc_id"], F.col("text"), terms) \
        .drop("skill")


def _title_sets(spark: SparkSession, sf: str) -> DataFrame:
    return V.documents(spark, sf).select(
        F.col("doc_id").alias("resume_id"), F.split(F.lower(V.first_line()), " ").alias("skills"))


@query
def similar_titles(spark, sf):
    """All pairs of postings whose titles share most of their words."""
    return similarity.similar_sets(_title_sets(spark, sf), 0.7)


@query
def similar_resumes(spark, sf):
    """All pairs of skill sets that turns of conversations name and that are half alike."""
    return similarity.similar_sets(_turn_sets(spark, sf), 0.5)


def _turn_sets(spark: SparkSession, sf: str) -> DataFrame:
    return V.turns(spark, sf).select((F.col("conv_id") * 10000 + F.col("turn")).alias("resume_id"),
                                     S.skill_list(F.col("text"), V.RESUME_TERMS).alias("skills"))


@query
def skill_set_classes(spark, sf):
    """Which turns name the same skills."""
    return similarity.skill_sets(_turn_sets(spark, sf))


@query
def fallback_demand(spark, sf):
    return market.posting_demand(V.postings(spark, sf), BASIC, fallback=True)


@query
def word_count_per_doc(spark, sf):
    return V.documents(spark, sf).select("doc_id", word_count(F.col("text")).alias("words"))


QUERIES["word_count"] = QUERIES.pop("word_count_per_doc")


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "pages")


@query
def page_text(spark, sf):
    return _pages(spark, sf).select("page_id", html_to_text(F.col("html")).alias("text"))


QUERIES["html_to_text"] = QUERIES.pop("page_text")


# Filters, caps, de-duplication --------------------------------------------------------------


@query
def category_filter(spark, sf):
    own = F.array("lang", F.lit("rest of"))
    return V.documents(spark, sf).select(
        "doc_id",
        rules.contains_category(F.col("text"), V.CATEGORIES, V.CATEGORY_PHRASES)
        .alias("in_category"),
        rules.contains_category(F.col("text"), own, V.CATEGORY_PHRASES).alias("in_own_category"),
    )


@query
def region_filter(spark, sf):
    asked = {"us": ["us"], "uk": ["uk"], "eu": ["eu"], "canada": ["canada"],
             "remote": ["remote"], "us remote": ["us", "remote"], "au": ["au"],
             "global": ["global"], "any": []}
    names = F.array(*[F.when(rules.matches_region(F.col("title"), r), F.lit(n))
                      for n, r in asked.items()])
    rows = V.postings(spark, sf).select("doc_id", F.explode_outer(names).alias("asked"))
    return rows.where(F.col("asked").isNotNull())


@query
def category_dimension(spark, sf):
    """The categories of a table that each posting's text meets."""
    needles = category_needles(spark, {**rules.CATEGORY_QUERIES, **V.CATEGORY_PHRASES, "that": "that"})
    return met_needles(V.documents(spark, sf), ["doc_id"], F.col("text"), needles)


@query
def region_dimension(spark, sf):
    """The regions of a table that each posting's title meets."""
    return met_needles(V.postings(spark, sf), ["doc_id"], F.col("title"), region_needles(spark))


@query
def source_selection(spark, sf):
    rows = postings.select_sources(V.table(spark, sf, "documents"), ["src1", "src7", "src19"])
    return rows.groupBy("source").agg(F.count("*").alias("postings"))


@query
def source_caps(spark, sf):
    rows = V.table(spark, sf, "documents").select("source", "doc_id")
    return postings.first_k(rows, 5, by=["source"], order=["doc_id"])


@query
def dedup_postings(spark, sf):
    rows = V.postings(spark, sf).select("doc_id", "title", "company", "location")
    return postings.deduplicate(rows, order=["doc_id"])


def _cycles(spark: SparkSession, sf: str) -> DataFrame:
    """Postings of three cycles: every fifth one is in all of them, the others in one."""
    names = F.array(F.lit("c0"), F.lit("c1"), F.lit("c2"))
    own = F.when(F.col("doc_id") % 5 == 0, names).otherwise(
        F.slice(names, (F.col("doc_id") % 3 + 1).cast("int"), F.lit(1)))
    return V.postings(spark, sf).withColumn("cycle", F.explode(own))


def _history(spark: SparkSession, sf: str) -> PostingHistory:
    history = PostingHistory(spark, working_folder(spark, "history"))
    for cycle in ("c0", "c1", "c2"):
        history.add(_cycles(spark, sf).where(F.col("cycle") == cycle), cycle, ("doc_id",))
    return history


@query
def postings_seen(spark, sf):
    """When each posting of three cycles was seen first and last."""
    return _history(spark, sf).seen()


@query
def new_postings_by_cycle(spark, sf):
    return _history(spark, sf).new_by_cycle()


@query
def last_cycle_new_postings(spark, sf):
    """What the third cycle has that the first two had not, each posting once."""
    history = PostingHistory(spark, working_folder(spark, "history"))
    for cycle in ("c0", "c1"):
        history.add(_cycles(spark, sf).where(F.col("cycle") == cycle), cycle, ("doc_id",))
    new = history.add(_cycles(spark, sf).where(F.col("cycle") == "c2"), "c2", ("doc_id",))
    return new.select("doc_id", "title", "company", "location")


@query
def distinct_by_sketch(spark, sf):
    """Distinct postings per source from sketches of four batches, beside the exact numbers.

    ``close`` says whether an estimate is within three standard errors, or one posting, of them.
    """
    rows = V.postings(spark, sf).withColumn("batch_id", F.col("doc_id") % 4)
    sketches = distinct.posting_sketches(rows, ["source", "batch_id"])
    estimates = distinct.merged(sketches, ["source"]).select(
        F.col("source").alias("_source"), "rows", distinct.estimate().alias("estimate"))
    exact = distinct.distinct_postings(rows, ["source"])
    off = F.abs(F.col("estimate") - F.col("distinct"))
    return exact.join(estimates, F.col("source").eqNullSafe(F.col("_source"))).select(
        "source", "rows", "distinct",
        (off <= F.greatest(F.lit(1.0), 3 * distinct.STANDARD_ERROR * F.col("distinct"))).alias("close"))


@query
def cycle_totals(spark, sf):
    rows = V.postings(spark, sf).withColumn("cycle", F.concat(F.lit("c"), F.col("doc_id") % 3))
    totals = postings.cycle_totals(rows, ["src0", "elsewhere"], by=["cycle"])
    return totals.select("cycle", "fetched_total", "deduplicated_total", "by_source.src0",
                         "by_source.elsewhere")


@query
def counts_by_source(spark, sf):
    return postings.counts_by_source(V.table(spark, sf, "documents"),
                                     ["src0", "src3", "elsewhere"])


# Feeds and the collection cycle -------------------------------------------------------------


def _posting_row(df: DataFrame) -> DataFrame:
    return df.select("cycle", "source", "request", "pos", "title", "company", "location",
                     "salary", "url", joined("tags").alias("tags"), "is_remote", "description")


_NOW = "2024-01-01T00:00:00+00:00"


def _feed(name: str, regions: tuple[str, ...] = V.REGIONS) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        adapter = feeds.ADAPTERS[name]
        limits = (V.CATEGORIES, regions) if adapter.filtered else ()
        return _posting_row(adapter.read(V.landed(spark, sf, name), *limits, now=F.lit(_NOW)))

    return run


for _name in feeds.FEEDS:
    QUERIES[f"feed_{_name}"] = _feed(_name)
QUERIES["feed_hackernews"] = _feed("hackernews", ("global",))


@query
def feed_sparse_fields(spark, sf):
    """Entries whose fields are absent, null or given: only absent ones get the defaults."""
    frames = []
    for name in ("remoteok", "arbeitnow", "adzuna", "jsearch"):
        adapter = feeds.ADAPTERS[name]
        limits = (V.CATEGORIES, ("global", "remote")) if adapter.filtered else ()
        frames.append(_posting_row(adapter.read(V.sparse_landed(spark, sf, name), *limits,
                                                now=F.lit(_NOW))))
    return reduce(DataFrame.unionByName, frames)


@query
def rejected_responses(spark, sf):
    """What could not be read of responses that were damaged on the way, and why."""
    return feeds.rejected(V.damaged_landed(spark, sf)).select(
        "cycle", "source", "request", "query", "pos", "reason", F.left("body", F.lit(1))
        .alias("begins"))


@query
def damaged_collection(spark, sf):
    """Statistics of a run over damaged responses: all that is whole is kept."""
    stats = _collection(spark, sf, V.damaged_landed(spark, sf)).stats()
    counts = [F.col("by_source")[s].alias(s) for s in ("remoteok", "adzuna", "jsearch")]
    return stats.select("cycle", "fetched_total", "deduplicated_total", "rejected_total", *counts)


def _collection(spark: SparkSession, sf: str, landed: DataFrame | None = None):
    """A run over stored responses; every adapter reads the folder of its own feed only."""
    folder = working_folder(spark, "landed")
    (V.all_landed(spark, sf) if landed is None else landed).write.partitionBy("source") \
        .option("compression", "zstd").parquet(folder)
    filters = CollectionFilters(V.CATEGORIES, V.REGIONS)
    landed = spark.read.schema(LANDED).parquet(folder)
    return collect(landed, filters, F.lit(_NOW))


@query
def collected_postings(spark, sf):
    return _collection(spark, sf).postings.select(
        "cycle", "source", "request", "pos", "title", "company", "location")


def _stats_row(stats: DataFrame) -> DataFrame:
    counts = [F.col("by_source")[s].alias(s) for s in feeds.FEEDS]
    return stats.select("cycle", "fetched_total", "deduplicated_total", "sent_total", *counts)


@query
def collection_stats(spark, sf):
    """Statistics of a run whose postings were sent."""
    return _stats_row(_collection(spark, sf).send("files", working_folder(spark, "sent")))


@query
def collection_last_run(spark, sf):
    """The run that a written statistics file ends with, as the status shows it."""
    rows = V.postings(spark, sf).select("source", "title", "company", "location").withColumns({
        "cycle": F.lit("c"), "source_rank": F.lit(0)})
    path = working_folder(spark, "stats")
    filters = CollectionFilters.load(spark, f"{path}-none")
    write_stats(cycle_stats(rows, filters, ["src0", "src1"], F.lit(_NOW), False), path)
    status = collection_status(spark, filters, path)
    last = F.col("collector_metrics")
    return status.select(joined("filters.categories").alias("categories"),
                         last["fetched_total"].alias("fetched_total"),
                         last["deduplicated_total"].alias("deduplicated_total"),
                         last["by_source"]["src0"].alias("src0"))


@query
def landed_files(spark, sf):
    """Responses stored as files in folders by cycle, source, request and phrase."""
    folder = working_folder(spark, "responses")
    V.landed(spark, sf, "adzuna").withColumnRenamed("body", "value") \
        .write.partitionBy("cycle", "source", "request", "query").text(folder)
    return _posting_row(feeds.adzuna(feeds.read_landed(spark, folder), now=F.lit(_NOW)))


@query
def latest_thread(spark, sf):
    hits = F.array(F.struct((F.col("page_id") + 1000).alias("objectID")),
                   F.struct(F.col("page_id").alias("objectID")))
    found = F.when(F.col("page_id") % 5 != 0, hits).otherwise(F.slice(hits, 1, 0))
    rows = V.table(spark, sf, "pages").select(
        "page_id", F.to_json(F.struct(found.alias("hits"))).alias("body"))
    return rows.select("page_id", feeds.latest_thread(F.col("body")).alias("thread"))


# Messages, stores, streams ------------------------------------------------------------------


@query
def parse_event_json(spark, sf):
    parsed = V.table(spark, sf, "events").select(
        "event_type", F.from_json("props", "k bigint")["k"].alias("k"))
    return parsed.groupBy("event_type").agg(F.count("*").alias("events"),
                                            F.sum("k").alias("k_sum"))


@query
def message_roundtrip(spark, sf):
    rows = V.postings(spark, sf)
    good = messages.to_messages(rows.where(F.col("doc_id") % 7 != 0))
    bad = rows.where(F.col("doc_id") % 7 == 0).select(F.concat(F.lit("not "), "title")
                                                      .alias("value"))
    parsed = messages.with_event_time(
        messages.parse_messages(good.unionByName(bad), flag_corrupt=True))
    return parsed.select("title", "company", "description", "salary",
                         F.unix_seconds("event_time").alias("event_second"),
                         F.col(messages.CORRUPT).isNotNull().alias("corrupt"))


def _stored(spark: SparkSession, sf: str, raw: bool = False, demand: bool = False) -> DemandStore:
    """Postings stored as four batches."""
    store = DemandStore(spark, working_folder(spark, "store"))
    batch = (F.col("doc_id") % 4).alias("batch_id")
    rows = V.postings(spark, sf)
    if raw:
        store.write_raw(messages.with_processing_time(rows).drop("tags", "is_remote"), batch)
    if demand:
        counted = market.posting_demand(rows.withColumn("batch_id", batch), V.VOCABULARY,
                                        by=["batch_id"])
        store.write_demand(counted, F.col("batch_id"))
    return store


@query
def raw_jobs_roundtrip(spark, sf):
    jobs = _stored(spark, sf, raw=True).raw_jobs()
    return jobs.groupBy("source", "batch_id").agg(
        F.count("*").alias("jobs"), F.sum(F.length("description")).alias("characters"))


@query
def market_demand(spark, sf):
    return market.market_demand(_stored(spark, sf, demand=True).skill_demand())


@query
def market_rollup(spark, sf):
    """The market of four days of batches, two of them closed and rolled up."""
    store = DemandStore(spark, working_folder(spark, "store"))
    batch = (F.col("doc_id") % 8).alias("batch_id")
    counted = market.posting_demand(V.postings(spark, sf).withColumn("batch_id", batch),
                                    V.VOCABULARY, by=["batch_id"])
    day = F.timestamp_seconds(F.lit(1_700_000_000) + F.floor(F.col("batch_id") / 2) * 86400)
    store.write_demand(counted, F.col("batch_id"), day)
    store.close("2023-11-15")
    return store.market()


@query
def latest_batch_demand(spark, sf):
    return market.latest_batch_demand(_stored(spark, sf, demand=True).latest_demand())


@query
def market_with_source(spark, sf):
    """The served market and where it comes from."""
    rows, source = market.market_skills(_stored(spark, sf, demand=True), 15)
    return rows.withColumn("origin", F.lit(source))


@query
def stats_summary(spark, sf):
    return system_stats(_stored(spark, sf, raw=True, demand=True))


@query
def streamed_demand(spark, sf):
    """Postings published as messages, worked off by the stream, read back as the market."""
    base = working_folder(spark, "stream")
    messages.publish(V.postings(spark, sf), "files", f"{base}/messages")
    store = DemandStore(spark, f"{base}/store")
    stream = messages.message_stream(spark, "files", f"{base}/messages")
    processor.start(stream, store, f"{base}/checkpoint", V.VOCABULARY, trigger=None,
                    name="streamed_demand").awaitTermination()
    return market.market_demand(store.skill_demand())


@query
def two_runs_in_one_store(spark, sf):
    """Two streams with checkpoints of their own, one of them restarted, fill one store."""
    base = working_folder(spark, "runs")
    store = DemandStore(spark, f"{base}/store")
    rows = V.postings(spark, sf)
    for run, of in (("a", F.col("is_remote")), ("b", ~F.col("is_remote")), ("a", None)):
        if of is not None:
            messages.publish(rows.where(of), "files", f"{base}/messages-{run}")
        stream = messages.message_stream(spark, "files", f"{base}/messages-{run}")
        processor.start(stream, store, f"{base}/checkpoint-{run}", V.VOCABULARY, trigger=None,
                        name=f"run_{run}").awaitTermination()
    return market.market_demand(store.skill_demand())


@query
def skill_trend_stream(spark, sf):
    """Demand per day of a stream with a watermark, all periods that it has seen."""
    base = working_folder(spark, "trend")
    seen = V.table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_type").alias("skill"),
        F.lit(1).cast("long").alias("count"))
    seen.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(seen.schema).parquet(f"{base}/in")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out")

    trends.skill_trend(stream).writeStream.outputMode("complete").foreachBatch(keep).option(
        "checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start() \
        .awaitTermination()
    return spark.read.parquet(f"{base}/out").withColumn(
        "period_start", F.col("period_start").cast("timestamp_ntz"))


@query
def streamed_keys(spark, sf):
    """Distinct postings of a stream, de-duplicated across its micro-batches."""
    base = working_folder(spark, "dedup")
    rows = V.postings(spark, sf).select("title", "company", "location", "timestamp")
    rows.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
    kept = trends.deduplicate_stream(stream, "400 days")
    writer = kept.select(*postings.dedup_keys()).writeStream.format("parquet").option(
        "checkpointLocation", f"{base}/checkpoint")
    writer.trigger(availableNow=True).start(f"{base}/out").awaitTermination()
    return spark.read.parquet(f"{base}/out").toDF(*postings.DEDUP_KEYS)


@query
def skill_trend_daily(spark, sf):
    seen = V.table(spark, sf, "events").select(
        F.col("ts").alias("timestamp"), F.col("event_type").alias("skill"),
        F.lit(1).cast("long").alias("count"))
    return trends.skill_trend(seen)


# Market and gap -----------------------------------------------------------------------------


@query
def market_top_parts(spark, sf):
    return market.top_n(V.parts_market(spark, sf), 50)


@query
def market_chart(spark, sf):
    row = market.chart(V.parts_market(spark, sf), 50)
    return row.select(joined("skills").alias("skills"), joined("counts").alias("counts"), "total")


FOLD = 40


@query
def gap_matching(spark, sf):
    return gap.matching(V.buyers(spark, sf), V.parts_market(spark, sf, FOLD))


@query
def gap_missing(spark, sf):
    return gap.missing(V.buyers(spark, sf), V.parts_market(spark, sf, FOLD))


@query
def gap_summary(spark, sf):
    return gap.summary(V.buyers(spark, sf), V.parts_market(spark, sf, FOLD))


@query
def gap_top_priorities(spark, sf):
    return gap.top_priorities(V.buyers(spark, sf), V.parts_market(spark, sf, FOLD))


@query
def gap_learning_path(spark, sf):
    return gap.learning_path(V.buyers(spark, sf), V.parts_market(spark, sf, FOLD))


@query
def gap_summary_large_market(spark, sf):
    """Every customer against all parts, each from each of its suppliers: thousands of skills."""
    return gap.summary(V.buyers(spark, sf, V.offer()), V.offers_market(spark, sf), None)


@query
def gap_priorities_large_market(spark, sf):
    return gap.top_priorities(V.buyers(spark, sf, V.offer()), V.offers_market(spark, sf), None)


@query
def gap_match_rate(spark, sf):
    return gap.match_rate(V.buyers(spark, sf), V.parts_market(spark, sf, FOLD),
                          gap.SERVED_MARKET)


@query
def gap_match_rate_whole_market(spark, sf):
    return gap.match_rate(V.buyers(spark, sf), V.parts_market(spark, sf))


def _named(array: str, *parts: str) -> Column:
    return F.array_join(F.transform(array, lambda e: F.concat(
        *[e[p].cast("string") if p in ("skill", "demand_count", "priority", "order", "reason")
          else F.lit(p) for p in parts])), "|")


@query
def gap_bundle(spark, sf):
    rows = bundle(V.buyer_lists(spark, sf), V.parts_market(spark, sf, FOLD))
    return rows.select(
        "resume_id", "skill_score", "match_count", "gap_count", "resume_skill_count",
        _named("matching_skills", "skill", "=", "demand_count").alias("matching_skills"),
        _named("missing_skills", "skill", "=", "demand_count", " ", "priority")
        .alias("missing_skills"),
        _named("recommendations", "order", " ", "skill", ": ", "reason").alias("recommendations"),
        "overall_assessment",
    )


@query
def gap_shown(spark, sf):
    rows = gap.shown(gap.analyze(V.buyer_lists(spark, sf), V.parts_market(spark, sf, FOLD)))
    return rows.select("resume_id", _named("matching_skills", "skill").alias("matching_skills"),
                       _named("missing_skills", "skill").alias("missing_skills"))


# Resumes ------------------------------------------------------------------------------------


def _keyed_turns(spark: SparkSession, sf: str) -> DataFrame:
    key = F.struct("conv_id", "turn").alias("file_path")
    return V.turns(spark, sf).select(key, "role", "text")


def _phrases(rows: DataFrame) -> DataFrame:
    return rows.select("file_path", F.explode(F.split("text", "[.,\n]+")).alias("phrase"))


def _entities(rows: DataFrame) -> DataFrame:
    names = F.regexp_extract_all("text", F.lit(r"\p{Lu}\p{Ll}+"), F.lit(0))
    label = F.when(F.col("role") == "user", "ORG").otherwise("PERSON")
    return rows.select("file_path", label.alias("label"), F.explode(names).alias("text"))


@query
def resume_skills(spark, sf):
    """Skills named in all turns of every conversation."""
    named = extraction.keyword_skills(V.turns(spark, sf), ["conv_id"], F.col("text"), V.RESUME_TERMS)
    return extraction.merge_skills([named], ["conv_id"]).select(
        "conv_id", joined("skills").alias("skills"))


@query
def phrase_skills(spark, sf):
    found = extraction.phrase_skills(_phrases(_keyed_turns(spark, sf)), ["file_path"],
                                     dictionary=V.RESUME_TERMS)
    return found.select("file_path.*", "skill").distinct()


@query
def entity_skills(spark, sf):
    found = extraction.entity_skills(_entities(_keyed_turns(spark, sf)), ["file_path"],
                                     dictionary=V.RESUME_TERMS)
    return found.select("file_path.*", "skill").distinct()


@query
def resume_analysis(spark, sf):
    rows = _keyed_turns(spark, sf)
    done = extraction.analyze_resumes(rows, phrases=_phrases(rows), entities=_entities(rows),
                                      dictionary=V.RESUME_TERMS)
    return done.select("file_path.*", "success", joined("skills").alias("skills"),
                       "skill_count", "word_count")


@query
def resume_report(spark, sf):
    """Every turn analysed as a resume against the demand of all turns."""
    rows = _keyed_turns(spark, sf)
    demand = market.skill_demand(rows, F.col("text"), V.RESUME_TERMS)
    done = report(extraction.analyze_resumes(rows, dictionary=V.RESUME_TERMS), demand)
    return done.select("file_path.*", "gap_analysis.matching_count",
                       "gap_analysis.missing_count", "message")


@query
def report_without_market(spark, sf):
    """Every turn analysed as a resume while nothing is known about the market."""
    none = spark.createDataFrame([], "skill string, count long")
    done = report(extraction.analyze_resumes(_keyed_turns(spark, sf),
                                             dictionary=V.RESUME_TERMS), none)
    return done.select("file_path.*", F.col("gap_analysis").isNull().alias("no_gap"), "message")


@query
def pdf_uploads(spark, sf):
    ending = F.get(F.array(F.lit(".pdf"), F.lit(".PDF"), F.lit(".pdf.doc")),
                   (F.col("p_partkey") % 3).cast("int"))
    rows = V.table(spark, sf, "part").select("p_partkey", F.concat("p_name", ending)
                                             .alias("file_name"))
    return accepted_uploads(rows).select("p_partkey")


# Collection requests ------------------------------------------------------------------------


@query
def filters_normalized(spark, sf):
    return requests.normalize_filters(V.filter_rows(spark, sf)).select(
        "filter_id", joined("categories").alias("categories"), joined("regions").alias("regions"),
        "enabled", "refresh_interval", joined("sources").alias("sources"))


@query
def filters_validated(spark, sf):
    return requests.validate_update(V.filter_rows(spark, sf), F.lit(_NOW)).select(
        "filter_id", joined("categories").alias("categories"), joined("regions").alias("regions"),
        "error")


@query
def country_requests(spark, sf):
    return requests.country_requests(requests.normalize_filters(V.filter_rows(spark, sf)),
                                     "filter_id")


@query
def phrase_requests(spark, sf):
    return requests.phrase_requests(requests.normalize_filters(V.filter_rows(spark, sf)),
                                    "filter_id")
