"""Skill extraction as column expressions.

Every function takes one text (or list) per row and returns one value per row, so none of them
moves data.  A text is cut into word runs once; single-word terms are looked up in a hash set,
and a term with blanks or punctuation is counted by a pattern, only in the texts that have its
longest word and contain the term.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsignal.dictionaries import SkillDictionary, boundary_pattern
from jobsignal.functions.text import bind, blank_to

# Runs of anything but letters, numbers and underscores.  The plain ``\W`` comes first because it
# settles an ASCII letter with one look-up.
NON_WORDS = r"[\W&&[^\p{L}\p{N}]]+"
_WORD_CLASS = r"[\p{L}\p{N}_]"


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _strings(values: Sequence[str]) -> Column:
    """An array literal; parsed from text, as one call per element adds up for a dictionary."""
    return F.expr(f"array({', '.join(map(_quoted, values))})").cast("array<string>")


def term_hits(lowered: Column, dictionary: SkillDictionary) -> Column:
    """All term occurrences in a lower-case text as array<string>, one element per mention."""
    keys = dictionary.phrase_keys
    wanted = list(dict.fromkeys([*dictionary.words, *filter(None, keys.values())]))
    if not dictionary.words:  # nothing to look up: the text is not cut into words
        return _phrase_hits(lowered, _strings([]), dictionary)

    def hits(found: Column) -> Column:
        if not keys:
            return found
        words = list(dictionary.words)
        named = found if len(words) == len(wanted) else F.filter(found, lambda t: t.isin(words))
        phrases = bind(F.array_distinct(found),
                       lambda seen: _phrase_hits(lowered, seen, dictionary))
        return F.concat(named, phrases)

    return bind(F.filter(F.split(lowered, NON_WORDS), lambda t: t.isin(wanted)), hits)


def _phrase_hits(lowered: Column, seen: Column, dictionary: SkillDictionary) -> Column:
    """Occurrences of the terms that are not single words.

    ``seen`` are the distinct words of the text, empty if the dictionary has no single words.  A
    term is searched for only if its key word is among them, and counted by its pattern only if the
    text contains it at all.
    """
    empty = F.array().cast("array<string>")

    def occurrences(term: str, word: str) -> Column:
        present = F.contains(lowered, F.lit(term))
        if word and dictionary.words:
            present = F.array_contains(seen, F.lit(word)) & present
        # The pattern is a constant, so it is compiled once.
        times = F.regexp_count(lowered, F.lit(boundary_pattern(term, dictionary.boundary)))
        return F.when(present, F.array_repeat(F.lit(term), times)).otherwise(empty)

    return F.concat(empty, *[occurrences(t, w) for t, w in dictionary.phrase_keys.items()])


def display_name(term: Column, dictionary: SkillDictionary) -> Column:
    pairs = ", ".join(_quoted(x) for item in dictionary.display.items() for x in item)
    return F.try_element_at(F.expr(f"map({pairs})"), term)


def mentions(text: Column, dictionary: SkillDictionary) -> Column:
    """array<struct<skill, mentions>> of the skills named in ``text``, by skill name.

    Mentions are counted on the sorted hits: each distinct term occupies one stretch.
    """

    def count(hits: Column) -> Column:
        def stretches(terms: Column) -> Column:
            def measure(starts: Column) -> Column:
                def entry(term: Column, i: Column) -> Column:
                    end = F.coalesce(F.get(starts, i + 1), F.size(hits) + 1)
                    return F.struct(
                        display_name(term, dictionary).alias("skill"),
                        (end - F.get(starts, i)).cast("long").alias("mentions"),
                    )

                return F.array_sort(F.transform(terms, entry))

            return bind(F.transform(terms, lambda t: F.array_position(hits, t)), measure)

        return bind(F.array_distinct(hits), stretches)

    return bind(
        F.lower(blank_to(text, "")),
        lambda low: bind(F.sort_array(term_hits(low, dictionary)), count),
    )


def mention_map(text: Column, dictionary: SkillDictionary) -> Column:
    """map<skill, mentions>; empty for an empty or null text."""
    return F.map_from_entries(mentions(text, dictionary))


def skill_list(text: Column, dictionary: SkillDictionary) -> Column:
    """Sorted distinct names of the skills found in ``text``."""
    return bind(
        F.lower(blank_to(text, "")),
        lambda low: F.array_sort(F.transform(
            F.array_distinct(term_hits(low, dictionary)),
            lambda t: display_name(t, dictionary),
        )),
    )


def top_skills(text: Column, dictionary: SkillDictionary, n: int = 10) -> Column:
    """The ``n`` most mentioned skills of the text; equal counts in name order."""
    by_count = F.array_sort(F.transform(
        mentions(text, dictionary),
        lambda m: F.struct((-m["mentions"]).alias("k"), m["skill"].alias("skill")),
    ))
    return F.transform(
        F.slice(by_count, 1, n),
        lambda m: F.struct(m["skill"].alias("skill"), (-m["k"]).alias("mentions")),
    )


def match_skills(text: Column, required: Sequence[str] | Column) -> Column:
    """map<skill, found>: which of the required skills occur as whole words.

    ``required`` is a list of names, the same for all rows, or an array column.  Names of a column
    that are single words are looked up among the words of the text.
    """
    if isinstance(required, Column):
        def found(low: Column, words: Column, name: Column) -> Column:
            plain = F.rlike(name, F.lit(f"^{_WORD_CLASS}+$"))
            return F.when(plain, F.array_contains(words, name)).otherwise(_has_word(low, name))

        return bind(
            F.lower(blank_to(text, "")),
            lambda low: bind(F.split(low, NON_WORDS), lambda words: F.map_from_entries(F.transform(
                F.array_distinct(required), lambda r: F.struct(
                    r.alias("skill"), found(low, words, F.lower(r)).alias("found")),
            ))),
        )
    names = list(dict.fromkeys(required))
    return bind(
        F.lower(blank_to(text, "")),
        lambda low: F.map_from_arrays(_strings(names), F.array(*[
            F.contains(low, F.lit(n.lower())) & low.rlike(boundary_pattern(n.lower()))
            for n in names
        ]).cast("array<boolean>")),
    )


def _has_word(low: Column, term: Column) -> Column:
    """Whole-word test for a term that is itself a column; see ``boundary_pattern``."""

    quoted = F.regexp_replace(term, r"([^\p{L}\p{N}_])", r"\\$1")

    def sign(ch: Column) -> Column:
        return F.when(ch.rlike(_WORD_CLASS), F.lit("!")).otherwise(F.lit("="))

    pattern = F.concat(
        quoted, F.lit("(?"), sign(F.right(term, F.lit(1))), F.lit(f"{_WORD_CLASS})(?<"),
        sign(F.left(term, F.lit(1))), F.lit(_WORD_CLASS), quoted, F.lit(")"))
    empty = low.rlike(_WORD_CLASS)  # an empty name is found next to any word
    return F.when(term == "", empty).otherwise(F.contains(low, term) & F.rlike(low, pattern))


def contained_terms(lowered: Column, dictionary: SkillDictionary) -> Column:
    """Terms that occur anywhere in the text, inside longer words too."""
    terms = _strings(dictionary.terms)
    return bind(lowered, lambda low: F.filter(terms, lambda t: F.contains(low, t)))


def jaccard(left: Column, right: Column) -> Column:
    """Similarity of two skill lists, case ignored: 1.0 when both are empty, 0.0 when one is."""

    def keys(skills: Column) -> Column:
        return F.array_distinct(F.transform(skills, F.lower))

    def similarity(a: Column, b: Column) -> Column:
        shared = F.size(F.array_intersect(a, b))
        either = F.size(a) + F.size(b) - shared
        return F.when(either == 0, F.lit(1.0)).otherwise(shared / either)

    return bind(keys(left), lambda a: bind(keys(right), lambda b: similarity(a, b)))
