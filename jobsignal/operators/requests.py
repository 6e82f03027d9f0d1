"""Collection filters and the provider requests that follow from them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.functions.rules import (
    CATEGORY_QUERIES, DEFAULT_COUNTRY, GLOBAL_COUNTRIES, REGION_COUNTRIES, string_array,
    string_map,
)
from jobsignal.functions.text import SPACE_CHARS, strip
from jobsignal.schema import FILTERS

# --- fixed values: filters where none are given ---------------------------------------------
DEFAULT_CATEGORIES = ("data science", "software engineer")
DEFAULT_REGIONS = ("us", "remote")
DEFAULT_SOURCES = ("remoteok", "arbeitnow", "wellfound", "hackernews", "adzuna", "jsearch")
DEFAULT_REFRESH = 10800
SHORTEST_REFRESH = 300

# --- fixed values: messages of a rejected update --------------------------------------------
NO_CATEGORY = "At least one category must be selected"
NO_REGION = "At least one region must be selected"
REFRESH_TOO_SHORT = "refresh_interval must be at least 300 seconds"

# --- fixed values: what a search phrase is extended by, first requested region first --------
REGION_PHRASES = (
    (("remote",), " remote"),
    (("us",), " in United States"),
    (("gb", "uk"), " in United Kingdom"),
    (("de", "eu"), " in Germany"),
)


def _cleaned(names: Column) -> Column:
    """Trimmed, lower case, blank ones dropped."""
    trimmed = F.transform(names, lambda n: F.lower(strip(n)))
    return F.filter(trimmed, lambda n: n != "")


def _or_default(names: Column, default: tuple[str, ...]) -> Column:
    cleaned = _cleaned(names)
    return F.when(F.size(cleaned) > 0, cleaned).otherwise(string_array(default))


def normalize_filters(filters: DataFrame) -> DataFrame:
    """Filter rows made safe: cleaned lists, defaults for empty ones, a shortest interval."""
    others = [c for c in filters.columns if c not in FILTERS.fieldNames()]
    return filters.select(
        *others,
        _or_default(F.col("categories"), DEFAULT_CATEGORIES).alias("categories"),
        _or_default(F.col("regions"), DEFAULT_REGIONS).alias("regions"),
        F.coalesce("enabled", F.lit(True)).alias("enabled"),
        F.greatest(F.lit(SHORTEST_REFRESH),
                   F.coalesce("refresh_interval", F.lit(DEFAULT_REFRESH)))
        .alias("refresh_interval"),
        _or_default(F.col("sources"), DEFAULT_SOURCES).alias("sources"),
        "last_updated",
    )


def validate_update(updates: DataFrame, now: Column) -> DataFrame:
    """Filter rows to be stored, with ``error`` for those that must be refused."""
    others = [c for c in updates.columns if c not in FILTERS.fieldNames()]
    return updates.select(
        *others,
        _cleaned(F.col("categories")).alias("categories"),
        _cleaned(F.col("regions")).alias("regions"),
        F.coalesce("enabled", F.lit(True)).alias("enabled"),
        F.coalesce("refresh_interval", F.lit(DEFAULT_REFRESH)).alias("refresh_interval"),
        _or_default(F.col("sources"), DEFAULT_SOURCES).alias("sources"),
        now.alias("last_updated"),
    ).withColumn(
        "error",
        F.when(F.coalesce(F.size("categories"), F.lit(0)) <= 0, F.lit(NO_CATEGORY))
        .when(F.coalesce(F.size("regions"), F.lit(0)) <= 0, F.lit(NO_REGION))
        .when(F.col("refresh_interval") < SHORTEST_REFRESH, F.lit(REFRESH_TOO_SHORT)),
    )


def search_queries(categories: Column,
                   queries: Mapping[str, str] = CATEGORY_QUERIES) -> Column:
    """Search phrases of the categories, each once, in order."""
    mapped = string_map(queries)
    return F.array_distinct(
        F.transform(categories, lambda c: F.coalesce(F.try_element_at(mapped, c), c)))


def country_codes(regions: Column) -> Column:
    """Countries to search in, each once, in order."""
    mapped = string_map(REGION_COUNTRIES)
    known = F.filter(F.transform(regions, lambda r: F.try_element_at(mapped, r)),
                     lambda c: c.isNotNull())
    return (F.when(F.array_contains(regions, "global"), string_array(GLOBAL_COUNTRIES))
            .when(F.size(known) == 0, string_array((DEFAULT_COUNTRY,)))
            .otherwise(F.array_distinct(known)))


def query_with_region(query: Column, regions: Column) -> Column:
    """The phrase for the search that takes the region as words."""
    suffix = F.when((F.size(regions) == 0) | F.array_contains(regions, "global"), F.lit(""))
    for names, words in REGION_PHRASES:
        suffix = suffix.when(F.arrays_overlap(regions, string_array(names)), F.lit(words))
    return F.concat(query, suffix.otherwise(F.lit("")))


def country_requests(filters: DataFrame, key: str) -> DataFrame:
    """(key, request, query, country): one row per phrase and country of every filter row."""
    lists = filters.select(key, search_queries(F.col("categories")).alias("q"),
                           country_codes(F.col("regions")).alias("c"))
    pairs = F.flatten(F.transform("q", lambda q: F.transform(
        F.col("c"), lambda c: F.struct(q.alias("query"), c.alias("country")))))
    return lists.select(key, F.posexplode(pairs).alias("request", "p")).select(
        key, "request", "p.query", "p.country")


def phrase_requests(filters: DataFrame, key: str) -> DataFrame:
    """(key, request, query, search): one row per phrase, with the text that is searched."""
    rows = filters.select(key, "regions", F.posexplode(search_queries(F.col("categories")))
                          .alias("request", "query"))
    return rows.select(key, "request", "query",
                       query_with_region(F.col("query"), F.col("regions")).alias("search"))


@dataclass(frozen=True)
class CollectionFilters:
    """The filters of one collection run."""

    categories: tuple[str, ...] = DEFAULT_CATEGORIES
    regions: tuple[str, ...] = DEFAULT_REGIONS
    enabled: bool = True
    refresh_interval: int = DEFAULT_REFRESH
    sources: tuple[str, ...] = DEFAULT_SOURCES
    last_updated: str | None = None

    @classmethod
    def from_settings(cls, settings: Mapping) -> CollectionFilters:
        def names(key: str, default: tuple[str, ...]) -> tuple[str, ...]:
            given = (str(n).strip(SPACE_CHARS).lower() for n in settings.get(key) or ())
            return tuple(n for n in given if n) or default

        return cls(
            names("categories", DEFAULT_CATEGORIES),
            names("regions", DEFAULT_REGIONS),
            bool(settings.get("enabled", True)),
            max(SHORTEST_REFRESH, int(settings.get("refresh_interval", DEFAULT_REFRESH))),
            names("sources", DEFAULT_SOURCES),
            settings.get("last_updated"),
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CollectionFilters:
        """Filters of a JSON document; defaults for what it leaves out, or if there is none."""
        try:
            row = spark.read.schema(FILTERS).option("multiLine", True).json(path).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            row = None
        settings = row.asDict() if row else {}
        return cls.from_settings({k: v for k, v in settings.items() if v is not None})

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([asdict(self)], FILTERS)
