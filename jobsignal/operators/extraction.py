"""Skill extraction over tables of texts; see ``functions.skills`` for the column forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignal.dictionaries import RESUMES, SkillDictionary
from jobsignal.functions.skills import (
    contained_terms, display_name, mentions, skill_list, top_skills,
)
from jobsignal.functions.text import blank_to, strip, word_count

# --- fixed values: entity labels that may name a skill --------------------------------------
SKILL_LABELS = ("PRODUCT", "ORG", "TECH")
NO_TEXT = "Error extracting text from PDF: No text extracted from PDF"


def skill_mentions(texts: DataFrame, keys: Sequence[str], text: Column,
                   dictionary: SkillDictionary) -> DataFrame:
    """(*keys, skill, mentions), one row per text and skill found in it; moves no data."""
    found = texts.select(*keys, F.explode_outer(mentions(text, dictionary)).alias("_m"))
    return found.where(F.col("_m").isNotNull()).select(*keys, "_m.skill", "_m.mentions")


def top_skills_per_text(texts: DataFrame, keys: Sequence[str], text: Column,
                        dictionary: SkillDictionary, n: int = 10) -> DataFrame:
    """(*keys, rank, skill, mentions): the most mentioned skills of every text."""
    ranked = texts.select(
        *keys, F.posexplode_outer(top_skills(text, dictionary, n)).alias("_pos", "_m"))
    return ranked.where(F.col("_m").isNotNull()).select(
        *keys, (F.col("_pos") + 1).alias("rank"), "_m.skill", "_m.mentions")


def keyword_skills(resumes: DataFrame, keys: Sequence[str], text: Column,
                   dictionary: SkillDictionary = RESUMES) -> DataFrame:
    """(*keys, skill): dictionary skills named as whole words."""
    return _long(resumes, keys, skill_list(text, dictionary))


def phrase_skills(phrases: DataFrame, keys: Sequence[str], phrase: str = "phrase",
                  dictionary: SkillDictionary = RESUMES) -> DataFrame:
    """(*keys, skill): skills that a noun phrase is or contains, inside words too."""
    low = strip(F.lower(blank_to(F.col(phrase), "")))
    names = F.transform(contained_terms(low, dictionary), lambda t: display_name(t, dictionary))
    return _long(phrases, keys, names)


def entity_skills(entities: DataFrame, keys: Sequence[str], text: str = "text",
                  label: str = "label", dictionary: SkillDictionary = RESUMES) -> DataFrame:
    """(*keys, skill): entities with a technical label that are written like the skill."""
    named = entities.where(F.col(label).isin(*SKILL_LABELS))
    return (named.select(*keys, strip(F.col(text)).alias("skill"))
            .where(F.col("skill").isin(list(dictionary.display.values()))))


def _long(df: DataFrame, keys: Sequence[str], names: Column) -> DataFrame:
    return (df.select(*keys, F.explode_outer(names).alias("skill"))
            .where(F.col("skill").isNotNull()))


def merge_skills(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """(*keys, skills): sorted distinct skills of all parts.

    A list holds at most the dictionary, and each task reduces its rows to such lists before
    the shuffle.
    """
    rows = parts[0].select(*keys, "skill")
    for part in parts[1:]:
        rows = rows.unionByName(part.select(*keys, "skill"))
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_set("skill")).alias("skills"))


def analyze_resumes(
    resumes: DataFrame,
    key: str = "file_path",
    text: str = "text",
    phrases: DataFrame | None = None,
    entities: DataFrame | None = None,
    dictionary: SkillDictionary = RESUMES,
) -> DataFrame:
    """One result row per resume: success, error, text, skills, skill_count, word_count.

    Noun phrases and entities come from a language model, as tables with the resume key.
    Without them a resume is analysed where it is; with them their skills, one short list per
    resume, are joined to it.
    """
    trimmed = resumes.withColumn(text, strip(blank_to(F.col(text), "")))
    ok = F.col(text) != ""
    named = skill_list(F.col(text), dictionary)
    parts = []
    if phrases is not None:
        parts.append(phrase_skills(phrases, [key], dictionary=dictionary))
    if entities is not None:
        parts.append(entity_skills(entities, [key], dictionary=dictionary))
    if parts:
        extra = merge_skills(parts, [key]).withColumnRenamed("skills", "_extra")
        trimmed = trimmed.join(extra, key, "left")
        more = F.coalesce("_extra", F.array().cast("array<string>"))
        named = F.array_sort(F.array_union(named, more))
    none = F.array().cast("array<string>")
    listed = trimmed.withColumn("skills", F.when(ok, named).otherwise(none))
    return listed.select(
        key,
        ok.alias("success"),
        F.when(~ok, F.lit(NO_TEXT)).alias("error"),
        F.col(text).alias("text"),
        "skills",
        F.size("skills").alias("skill_count"),
        word_count(F.col(text)).alias("word_count"),
    )
