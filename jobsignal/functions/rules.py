"""Posting filters and gap scoring rules as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsignal.functions.text import bind, blank_to

# --- fixed values: what a category is searched for ------------------------------------------
CATEGORY_QUERIES = {
    "data science": "data scientist",
    "software engineer": "software engineer",
    "ml engineer": "machine learning engineer",
    "machine learning": "machine learning engineer",
    "data analyst": "data analyst",
    "devops engineer": "devops engineer",
    "devops": "devops engineer",
    "full stack developer": "full stack developer",
    "full stack": "full stack developer",
    "sde": "software development engineer",
}

# --- fixed values: the country a region is searched in --------------------------------------
REGION_COUNTRIES = {
    "us": "us", "uk": "gb", "gb": "gb", "eu": "de", "germany": "de", "de": "de",
    "canada": "ca", "ca": "ca", "australia": "au", "au": "au",
}
GLOBAL_COUNTRIES = ("us", "gb", "de")
DEFAULT_COUNTRY = "us"

# --- fixed values: region names, and what a location of the region contains -----------------
# The leading blanks count: "Austin, USA" is in the US, a bare "USA" is not.
REGION_TOKENS = (
    (("us",), (" united states", " usa", " us", "new york", "california", "texas")),
    (("uk", "gb"), (" united kingdom", " uk", "london", "england", "gb")),
    (("eu", "de", "germany"), (" germany", "berlin", "munich", "europe", "eu")),
    (("canada", "ca"), (" canada", "toronto", "vancouver", "montreal")),
)

# --- fixed values: wording of the gap report ------------------------------------------------
# The placeholders are the skill and its demand.
RECOMMENDATIONS = {
    "High": "Highly recommended - %s is mentioned in many job postings (%d times). "
            "Learning this skill could significantly improve your job prospects.",
    "Medium": "Consider learning - %s appears regularly in job postings (%d times) "
              "and would be a valuable addition.",
    "Low": "Optional skill - %s is mentioned in some positions (%d times). "
           "Nice to have but not critical.",
}
LEARNING_REASONS = {
    "High": "High market demand (%d mentions)",
    "Medium": "Growing demand (%d mentions)",
}
EXCELLENT = "Excellent! Your skills are well-aligned with market demand."
GOOD = "Good skill set! Some areas for improvement identified."
MODERATE = "Moderate skill gap. Consider focusing on high-priority missing skills."
SIGNIFICANT = "Significant skill gap detected. Focus on learning in-demand skills."
NO_MARKET = "Resume analyzed but no market data available for comparison"


def string_array(values: Sequence[str] | Column) -> Column:
    if isinstance(values, Column):
        return values
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def string_map(pairs: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for item in pairs.items() for x in item])


def any_of(tests: Sequence[Column]) -> Column:
    out = F.lit(False)
    for test in tests:
        out = out | test
    return out


def contains_category(
    text: Column,
    categories: Sequence[str] | Column,
    queries: Mapping[str, str] = CATEGORY_QUERIES,
) -> Column:
    """Does the text contain one of the categories, or the phrase it is searched for?

    ``categories`` is a list, the same for all rows, or an array column.
    """
    if isinstance(categories, Column):
        mapped = string_map(queries)

        def found(low: Column) -> Column:
            return F.coalesce(F.exists(categories, lambda c: F.contains(low, c) | F.contains(
                low, F.coalesce(F.try_element_at(mapped, c), c))), F.lit(False))
    else:
        needles = dict.fromkeys(n for c in categories for n in (c, queries.get(c, c)))

        def found(low: Column) -> Column:
            return any_of([F.contains(low, F.lit(n)) for n in needles])

    # Bound, because a filter would lower the text again for every needle.
    return bind(F.lower(blank_to(text, "")), lambda low: (F.length(low) > 0) & found(low))


def matches_region(location: Column, regions: Sequence[str] | Column) -> Column:
    """Is the location in one of the regions?  No regions, or 'global', accept everything."""
    wanted = string_array(regions)

    def asked(names: Sequence[str]) -> Column:
        return any_of([F.array_contains(wanted, F.lit(n)) for n in names])

    def within(loc: Column) -> Column:
        remote = F.contains(loc, F.lit("remote")) | (loc == "")
        return any_of([asked(("remote",)) & remote] + [
            asked(names) & any_of([F.contains(loc, F.lit(t)) for t in tokens])
            for names, tokens in REGION_TOKENS
        ])

    anywhere = (F.size(wanted) == 0) | asked(("global",))
    return anywhere | bind(F.lower(blank_to(location, "")), within)


def matches_region_or_remote(location: Column, regions: Sequence[str]) -> Column:
    """Rule of the all-remote board: a request for remote work accepts every location."""
    return F.lit("remote" in regions) | matches_region(location, regions)


def is_pdf(file_name: Column) -> Column:
    return F.endswith(F.lower(file_name), F.lit(".pdf"))


# Gap scoring --------------------------------------------------------------------------------


def priority(demand: Column, market_size: Column) -> Column:
    """Tier of a missing skill: its demand against a share of the number of market skills."""
    return (F.when(demand > market_size * F.lit(0.3), F.lit("High"))
            .when(demand > market_size * F.lit(0.1), F.lit("Medium"))
            .otherwise(F.lit("Low")))


def recommendation(skill: Column, tier: Column, demand: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, sentence in RECOMMENDATIONS.items():
        out = F.when(tier == name, F.format_string(sentence, skill, demand)).otherwise(out)
    return out


def learning_reason(tier: Column, demand: Column) -> Column:
    return F.when(tier == "High", F.format_string(LEARNING_REASONS["High"], demand)).otherwise(
        F.format_string(LEARNING_REASONS["Medium"], demand))


def percentage(part: Column, whole: Column) -> Column:
    """part / whole * 100, unrounded; 0.0 for an empty whole."""
    return F.when(whole > 0, part / whole * F.lit(100.0)).otherwise(F.lit(0.0))


def rounded(value: Column) -> Column:
    """Two decimals, halves to even."""
    return F.bround(value, 2)


def assessment(gap: Column, matching: Column) -> Column:
    """Verdict on the unrounded gap percentage and the number of matching skills."""
    return (F.when((gap < 20) & (matching >= 10), F.lit(EXCELLENT))
            .when((gap < 40) & (matching >= 5), F.lit(GOOD))
            .when(gap < 60, F.lit(MODERATE))
            .otherwise(F.lit(SIGNIFICANT)))
