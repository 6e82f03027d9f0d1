"""All pairs of similar skill sets, without forming the pairs that cannot be similar.

Equal sets are one class.  The skills of a class are ordered by how few classes have them, and two
sets can only reach the threshold if they share a skill among the first few of each, the rarer
ones.  So only these prefixes are joined, on the skill and on a range of lengths: sets whose
lengths rule the threshold out don't meet, and a skill that many share is spread over the ranges.
How far into both sets the shared skill comes bounds what they can share, and rules out more.
Prefixes travel without their sets; these are only joined to the pairs that are left.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignal.session import working_folder

_SLACK = 1e-9


def skill_sets(resumes: DataFrame, key: str = "resume_id", skills: str = "skills") -> DataFrame:
    """(key, class_id, members): the class of every resume, named after its smallest key.

    Case, order and repeats of skills don't matter, and null is an empty set.  Rows of one key are
    one resume; rows without a key are left out.  Empty sets are a class of their own, alike in
    full.
    """
    keyed = _written(_keyed(resumes, key, skills), "sets")
    return keyed.join(_classes(keyed, key), "skill_set").select(key, "class_id", "members")


def similar_sets(resumes: DataFrame, threshold: float, key: str = "resume_id",
                 skills: str = "skills") -> DataFrame:
    """(left_id, right_id, shared, similarity): classes whose Jaccard similarity is at least
    ``threshold``, which is above 0 and at most 1.

    Each pair comes once, the smaller class id to the left.  The members of a class, which are
    alike in full and share its pairs, are in ``skill_sets``.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is above 0 and at most 1")
    classes = _written(_classes(_keyed(resumes, key, skills), key), "classes")
    pairs = candidates(_written(prefixes(classes, threshold), "prefixes"), threshold)
    sets = classes.select("class_id", "skill_set")
    both = pairs.join(sets.toDF("left_id", "left_set"), "left_id") \
        .join(sets.toDF("right_id", "right_set"), "right_id")
    either = F.size("left_set") + F.size("right_set") - F.col("shared")
    return both.withColumn("shared", F.size(F.array_intersect("left_set", "right_set"))) \
        .withColumn("similarity", F.col("shared") / either) \
        .where(F.col("similarity") >= threshold) \
        .select("left_id", "right_id", "shared", "similarity")


def prefixes(classes: DataFrame, threshold: float) -> DataFrame:
    """(class_id, n, at, skill): the first skills of each set, rarest first, and their places.

    A skill's classes are counted per task first.
    """
    listed = classes.select("class_id", F.explode("skill_set").alias("skill"))
    counts = listed.groupBy("skill").agg(F.count("*").alias("classes"))
    ordered = listed.join(counts, "skill").groupBy("class_id").agg(
        F.array_sort(F.collect_list(F.struct("classes", "skill"))).alias("s"))
    n = F.size("s")
    length = (n - F.ceil(n * F.lit(threshold) - F.lit(_SLACK)) + 1).cast("int")
    return ordered.select("class_id", n.alias("n"), F.posexplode(F.transform(
        F.slice("s", F.lit(1), length), lambda x: x["skill"])).alias("at", "skill"))


def candidates(heads: DataFrame, threshold: float) -> DataFrame:
    """(left_id, right_id): the pairs of classes that are compared in full."""
    n = F.col("n")
    # A set of the next range is at most 1 / threshold times as long as the longest of this one.
    zone = n if threshold == 1 else F.floor(F.log(n.cast("double"))
                                            / F.lit(-math.log(threshold)) + F.lit(_SLACK))
    zone = zone.cast("long")
    short = heads.select(F.col("class_id").alias("a"), n.alias("a_n"), F.col("at").alias("a_at"),
                         "skill", F.explode(F.array(zone, zone + 1)).alias("zone"))
    long = heads.select(F.col("class_id").alias("b"), n.alias("b_n"), F.col("at").alias("b_at"),
                        "skill", zone.alias("zone"))
    met = short.join(long, ["skill", "zone"]).where(
        (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a") < F.col("b"))))
    most = F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    due = (F.col("a_n") + F.col("b_n")) * F.lit(threshold / (1 + threshold))
    fits = (F.col("a_n") >= F.col("b_n") * F.lit(threshold) - F.lit(_SLACK)) \
        & (most >= due - F.lit(_SLACK))
    return met.where(fits).select(F.least("a", "b").alias("left_id"),
                                  F.greatest("a", "b").alias("right_id")).distinct()


def _set(skills: Column) -> Column:
    names = F.transform(F.coalesce(skills, F.array().cast("array<string>")), F.lower)
    return F.filter(names, lambda s: s.isNotNull())


def _keyed(resumes: DataFrame, key: str, skills: str) -> DataFrame:
    """One row per resume with its set; the sets of one key are combined per task first."""
    rows = resumes.where(F.col(key).isNotNull()).select(
        key, F.array_sort(F.array_distinct(_set(F.col(skills)))).alias("skill_set"))
    return rows.groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(
        F.collect_set("skill_set")))).alias("skill_set"))


def _classes(keyed: DataFrame, key: str) -> DataFrame:
    """One row per set; a set that many resumes have is combined per task first."""
    return keyed.groupBy("skill_set").agg(F.min(key).alias("class_id"),
                                          F.count("*").alias("members"))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = working_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
