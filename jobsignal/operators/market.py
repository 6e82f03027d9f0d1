"""Market demand: mentions per skill, rankings, chart rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignal.dictionaries import SkillDictionary
from jobsignal.functions.skills import contained_terms, display_name, term_hits
from jobsignal.functions.text import blank_to, job_text
from jobsignal.sources.store import DemandStore

BATCH_TOP = 20
CHART_TOP = 50


def skill_demand(texts: DataFrame, text: Column, dictionary: SkillDictionary,
                 by: Sequence[str] = ()) -> DataFrame:
    """(*by, skill, count): mentions of every dictionary skill over all texts.

    Each task sums its own mentions first, so it shuffles at most one row per group and term.
    """
    return _count_terms(texts, F.lower(blank_to(text, "")), term_hits, dictionary, by)


def fallback_demand(texts: DataFrame, text: Column, dictionary: SkillDictionary,
                    by: Sequence[str] = ()) -> DataFrame:
    """(*by, skill, count): number of texts that contain the term, inside words too."""
    return _count_terms(texts, F.lower(blank_to(text, "")), contained_terms, dictionary, by)


def posting_demand(postings: DataFrame, dictionary: SkillDictionary,
                   fallback: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Demand over postings, searched in title and description."""
    text = job_text(F.col("title"), F.col("description"))
    return _count_terms(postings, text, contained_terms if fallback else term_hits, dictionary, by)


def _count_terms(texts: DataFrame, lowered: Column,
                 hits: Callable[[Column, SkillDictionary], Column],
                 dictionary: SkillDictionary, by: Sequence[str]) -> DataFrame:
    low = texts.select(*by, lowered.alias("_low"))
    found = low.select(*by, F.explode_outer(hits(F.col("_low"), dictionary)).alias("_term"))
    counted = (found.where(F.col("_term").isNotNull()).groupBy(*by, "_term")
               .agg(F.count("*").alias("count")))
    return counted.select(*by, display_name(F.col("_term"), dictionary).alias("skill"), "count")


def market_demand(demand: DataFrame) -> DataFrame:
    """(skill, count): counts of all batches added up."""
    return demand.groupBy("skill").agg(F.sum("count").alias("count"))


def top_n(market: DataFrame, n: int) -> DataFrame:
    """The ``n`` skills in highest demand; equal counts in name order."""
    return market.orderBy(F.col("count").desc(), "skill").limit(n)


def latest_batch_demand(latest: DataFrame, n: int = BATCH_TOP) -> DataFrame:
    """(skill, count): the top skills of a batch, in title case."""
    return top_n(latest, n).select(title_case(F.col("skill")).alias("skill"), "count")


def title_case(name: Column) -> Column:
    """Every letter that does not follow a letter in upper case, all others in lower case."""
    runs = F.regexp_extract_all(F.lower(name), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def chart(market: DataFrame, n: int = CHART_TOP) -> DataFrame:
    """One row: the top ``n`` skills and their counts as two arrays of the same order."""
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("k"), "skill")))
    return top_n(market, n).agg(ranked.alias("r")).select(
        F.transform("r", lambda e: e["skill"]).alias("skills"),
        F.transform("r", lambda e: -e["k"]).alias("counts"),
        F.size("r").alias("total"),
    )


def market_skills(store: DemandStore, n: int = 50,
                  latest: DataFrame | None = None) -> tuple[DataFrame, str]:
    """The market's top skills and where they come from.

    ``parquet`` when demand has been stored, ``in-memory`` for the latest batch that the caller
    passes when nothing is stored, ``none`` for an empty market.
    """
    if store.has_demand():
        return top_n(store.market(), n), "parquet"
    if latest is not None:
        return top_n(latest, n), "in-memory"
    none = store.spark.range(0).select(F.lit("").alias("skill"), F.col("id").alias("count"))
    return none, "none"
