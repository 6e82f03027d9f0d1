"""Skill gap of many resumes against one market.

Resumes come in either of two forms:

* long, ``(resume_id, pos, skill)``: relational operators, fit for lists of any length and a market
  of any size;
* nested, one row per resume with a ``skills`` array: ``analyze``, which adds columns and moves no
  data.  Its rows hold up to ``n`` missing skills each, so the market array that it works with is no
  larger than one row of its result.

``n`` cuts the market to its top skills; None takes it whole.  The joins have no hints: the planner
broadcasts a market that it measures as small, and splits frequent skills at run time otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsignal.functions import rules
from jobsignal.functions.rules import percentage, rounded
from jobsignal.operators.market import top_n as top_of_market
from jobsignal.operators.ranking import with_rank

TOP_N = 50
SERVED_MARKET = 100
TOP_PRIORITIES = 10
LEARNING_PATH = 5
SHOWN_MATCHING = 20
SHOWN_MISSING = 15

_MISSING = ("skill", "demand_count", "priority", "recommendation")


def long_resumes(resumes: DataFrame, key: str = "resume_id") -> DataFrame:
    """(resume_id, pos, skill); a resume without skills keeps one row with a null skill."""
    return resumes.select(F.col(key).alias("resume_id"),
                          F.posexplode_outer("skills").alias("pos", "skill"))


def market_profile(market: DataFrame, n: int | None = TOP_N,
                   postings: int | None = None) -> DataFrame:
    """The top ``n`` market skills, ranked and scored once for all resumes.

    Columns: rank (from 0), skill, key (lower case), demand_count, market_size, priority,
    recommendation.  With ``postings`` the tiers are shares of that number instead of shares of the
    number of market skills.
    """
    named = market.where(F.col("skill").isNotNull())
    order = [F.col("demand_count").desc(), F.col("skill")]
    if n is None:
        ranked = with_rank(named.select("skill", F.col("count").alias("demand_count")), order)
        size = ranked.agg(F.count("*")).scalar()
    else:  # no more rows than ``n``: numbered in one place, as the cut has brought them there
        top = top_of_market(named, n).select("skill", F.col("count").alias("demand_count"))
        place = F.row_number().over(Window.orderBy(*order)) - 1
        ranked = top.withColumn("rank", place.cast("long"))
        size = F.count("*").over(Window.partitionBy())
    scored = ranked.select(
        "rank", "skill", F.lower("skill").alias("key"), "demand_count", size.alias("market_size"))
    tiers = F.col("market_size") if postings is None else F.lit(postings)
    return scored.withColumn("priority", rules.priority(F.col("demand_count"), tiers)).withColumn(
        "recommendation", rules.recommendation(
            F.col("skill"), F.col("priority"), F.col("demand_count")))


def matching(resume_skills: DataFrame, market: DataFrame, n: int | None = TOP_N) -> DataFrame:
    """(resume_id, pos, skill, demand_count, status): resume skills among the top ``n``.

    The skill is written as in the market, the first one of those that differ only by case; a skill
    listed twice matches twice.
    """
    wanted = market_profile(market, n).groupBy("key").agg(
        F.min_by(F.struct("skill", "demand_count"), "rank").alias("m"))
    return resume_skills.join(wanted, F.lower(F.col("skill")) == F.col("key")).select(
        "resume_id", "pos", "m.skill", "m.demand_count", F.lit("In Demand").alias("status"))


def _gaps(resume_skills: DataFrame, profile: DataFrame) -> DataFrame:
    """(resume_id, first, last, before): the runs of market ranks that a resume does not cover.

    ``before`` counts the missing ranks ahead of the run.  A resume has at most one run more than
    it has market skills, so no row is made for a rank before it is known to be missing.
    """
    held = (resume_skills.select("resume_id", F.lower("skill").alias("key"))
            .join(profile.select("key", "rank"), "key").select("resume_id", "rank").distinct())
    end = profile.agg(F.count("*")).scalar()
    ends = resume_skills.select("resume_id").distinct().select("resume_id", end.alias("rank"))
    in_order = Window.partitionBy("resume_id").orderBy("rank")
    runs = held.unionByName(ends).select(
        "resume_id",
        (F.lag("rank", 1, -1).over(in_order) + 1).alias("first"),
        (F.col("rank") - 1).alias("last"),
        (F.row_number().over(in_order) - 1).alias("held"),
    )
    return runs.where("first <= last").select(
        "resume_id", "first", "last", (F.col("first") - F.col("held")).alias("before"))


def _listed(gaps: DataFrame, last: Column, profile: DataFrame) -> DataFrame:
    """The market skills of the runs up to ``last``; ``place`` numbers a resume's missing skills."""
    ranks = gaps.withColumn("until", last).where("first <= until").select(
        "resume_id", "first", "before", F.explode(F.sequence("first", "until")).alias("rank"))
    numbered = ranks.select(
        "resume_id", "rank",
        (F.col("before") + F.col("rank") - F.col("first") + 1).cast("int").alias("place"))
    return numbered.join(profile, "rank")


def missing(resume_skills: DataFrame, market: DataFrame, n: int | None = TOP_N) -> DataFrame:
    """(resume_id, skill, demand_count, priority, recommendation): top skills a resume lacks."""
    profile = market_profile(market, n)
    return _listed(_gaps(resume_skills, profile), F.col("last"), profile) \
        .select("resume_id", *_MISSING)


def top_priorities(resume_skills: DataFrame, market: DataFrame, n: int | None = TOP_N,
                   k: int = TOP_PRIORITIES) -> DataFrame:
    """(resume_id, rank, ...): the ``k`` missing skills in highest demand."""
    profile = market_profile(market, n)
    last = F.least(F.col("last"), F.col("first") + k - 1 - F.col("before"))
    return _listed(_gaps(resume_skills, profile), last, profile).select(
        "resume_id", F.col("place").alias("rank"), *_MISSING)


def _path(missing_skills: Column, k: int) -> Column:
    """Up to ``k`` missing skills to learn, as array<struct<order, skill, ...>>.

    The tiers follow the demand, so missing skills in demand order list every High one before
    the first Medium one; Low ones are never suggested.
    """
    worth = F.filter(missing_skills, lambda e: e["priority"] != "Low")
    return F.transform(F.slice(worth, 1, k), lambda e, i: F.struct(
        (i + 1).alias("order"),
        e["skill"].alias("skill"),
        e["priority"].alias("priority"),
        e["demand_count"].alias("demand"),
        rules.learning_reason(e["priority"], e["demand_count"]).alias("reason"),
    ))


def learning_path(resume_skills: DataFrame, market: DataFrame, n: int | None = TOP_N,
                  k: int = LEARNING_PATH) -> DataFrame:
    """(resume_id, order, skill, priority, demand, reason): what to learn first.

    The skills worth learning are the first ranks of the market.
    """
    profile = market_profile(market, n)
    worth = profile.agg(F.count_if(F.col("priority") != "Low")).scalar()
    last = F.least(F.col("last"), F.col("first") + k - 1 - F.col("before"), worth - 1)
    return _listed(_gaps(resume_skills, profile), last, profile).select(
        "resume_id", F.col("place").alias("order"), "skill", "priority",
        F.col("demand_count").alias("demand"),
        rules.learning_reason(F.col("priority"), F.col("demand_count")).alias("reason"))


def summary(resume_skills: DataFrame, market: DataFrame, n: int | None = TOP_N) -> DataFrame:
    """One row per resume: counts, gap percentage (exact and rounded) and assessment.

    Market names that differ only by case are covered together.
    """
    profile = market_profile(market, n)
    names = profile.groupBy("key").agg(F.count("*").alias("names"))
    size = profile.agg(F.count("*")).scalar()
    listed = (resume_skills.select("resume_id", F.lower("skill").alias("key"))
              .groupBy("resume_id", "key").agg(F.count("key").alias("listed")))
    found = listed.join(names, "key", "left")
    counted = found.groupBy("resume_id").agg(
        F.sum("listed").alias("resume_skill_count"),
        F.coalesce(F.sum(F.when(F.col("names").isNotNull(), F.col("listed"))), F.lit(0))
        .alias("matching_count"),
        F.coalesce(F.sum("names"), F.lit(0)).alias("covered"),
    ).select(
        "resume_id", "resume_skill_count", size.alias("market_total_skills"), "matching_count",
        (size - F.col("covered")).alias("missing_count"))
    gap = percentage(F.col("missing_count"), F.col("market_total_skills"))
    return counted.select(
        "*",
        gap.alias("gap_ratio"),
        rounded(gap).alias("gap_percentage"),
        rules.assessment(gap, F.col("matching_count")).alias("overall_assessment"),
    )


def match_rate(resume_skills: DataFrame, market: DataFrame, n: int | None = None) -> DataFrame:
    """(resume_id, matches, resume_skill_count, match_ratio, match_rate).

    Distinct skills found in the market over listed skills.  The market is taken whole unless
    ``n`` limits it; a whole one has no size bound, so the planner picks the join and splits
    frequent skills by their size at run time.
    """
    if n is not None:
        market = top_of_market(market, n)
    keys = market.select(F.lower("skill").alias("key")).distinct()
    # Repeated skills are counted before the join; a skill that many resumes share stays one
    # row per resume.
    listed = (resume_skills.select("resume_id", F.lower("skill").alias("key"))
              .groupBy("resume_id", "key").agg(F.count("key").alias("listed")))
    found = listed.join(keys.withColumn("found", F.lit(1)), "key", "left")
    per_resume = found.groupBy("resume_id").agg(
        F.count("found").alias("matches"),
        F.sum("listed").alias("resume_skill_count"),
    )
    rate = percentage(F.col("matches"), F.col("resume_skill_count"))
    return per_resume.select("*", rate.alias("match_ratio"), rounded(rate).alias("match_rate"))


# Nested form --------------------------------------------------------------------------------


def _match_list(keys: Column, held: Column, entries: Column, entry_keys: Column) -> Column:
    """Market entries of the listed skills, in list order; the first entry of a key counts.

    ``held`` are the distinct keys that the market has, already in list order, so a list without
    repeated skills needs no second look.
    """
    listed = F.when(F.size(F.array_distinct(keys)) == F.size(keys), held).otherwise(
        F.filter(keys, lambda k: F.array_contains(held, k)))

    def match(key: Column) -> Column:
        entry = F.element_at(entries, F.array_position(entry_keys, key).cast("int"))
        return F.struct(entry["skill"].alias("skill"),
                        entry["demand_count"].alias("demand_count"),
                        F.lit("In Demand").alias("status"))

    return F.transform(listed, match)


def _packed(profile: DataFrame) -> Column:
    """The profile as one array value, in rank order; empty for an empty market."""
    fields = ["rank", "skill", "key", *_MISSING[1:]]
    return profile.agg(F.array_sort(F.collect_list(F.struct(*fields)))).scalar()


def analyze(resumes: DataFrame, market: DataFrame, n: int | None = TOP_N,
            top: int = TOP_PRIORITIES) -> DataFrame:
    """The whole gap report of every resume in one row, as nested columns.

    ``resumes`` has a ``skills`` array; all its columns are kept.  The market is an array of at
    most ``n`` entries that is computed once, and the report is built where the resume is.
    ``top`` is the length of ``top_priorities``.
    """
    entries = _packed(market_profile(market, n))
    lists = resumes.select(
        "*", entries.alias("_market"), F.transform("skills", F.lower).alias("_keys"))
    lists = lists.select("*", F.transform("_market", lambda e: e["key"]).alias("_market_keys"))
    lists = lists.select("*", F.array_intersect("_keys", "_market_keys").alias("_held"))
    lists = lists.select(
        "*",
        _match_list(*map(F.col, ("_keys", "_held", "_market", "_market_keys")))
        .alias("matching_skills"),
        F.filter("_market", lambda e: ~F.array_contains("_held", e["key"])).alias("_missing"),
    )
    gap = percentage(F.size("_missing"), F.size("_market"))
    report = lists.select(
        *resumes.columns,
        F.size("skills").alias("resume_skill_count"),
        F.size("_market").alias("market_total_skills"),
        "matching_skills",
        F.size("matching_skills").alias("matching_count"),
        F.transform("_missing", lambda e: F.struct(*[e[c].alias(c) for c in _MISSING]))
        .alias("missing_skills"),
        F.size("_missing").alias("missing_count"),
        rounded(gap).alias("gap_percentage"),
        rules.assessment(gap, F.size("matching_skills")).alias("overall_assessment"),
    )
    return report.withColumn("top_priorities", F.slice("missing_skills", 1, top))


def with_match_rate(resumes: DataFrame, market: DataFrame, n: int = SERVED_MARKET) -> DataFrame:
    """Add ``skill_score``, the match rate against the top ``n``, to nested resumes."""
    keys = top_of_market(market, n).agg(F.collect_set(F.lower("skill"))).scalar()
    rows = resumes.select("*", keys.alias("_keys"))
    listed = F.transform("skills", F.lower)
    matches = F.size(F.array_intersect(listed, F.col("_keys")))
    rate = rounded(percentage(matches, F.size("skills")))
    return rows.select(*resumes.columns, rate.alias("skill_score"))


def with_learning_path(report: DataFrame, k: int = LEARNING_PATH) -> DataFrame:
    """Add ``learning_path`` to the rows of :func:`analyze`."""
    return report.withColumn("learning_path", _path(F.col("missing_skills"), k))


def shown(report: DataFrame, matching: int = SHOWN_MATCHING,
          missing: int = SHOWN_MISSING) -> DataFrame:
    """Cut the two lists of a report to the lengths that are displayed."""
    return (report.withColumn("matching_skills", F.slice("matching_skills", 1, matching))
            .withColumn("missing_skills", F.slice("missing_skills", 1, missing)))
