"""Dictionaries as tables: terms of any number of dictionaries looked up in texts by a join.

Each term is filed under one of its words, the one that fewest terms have.  A bitmap of hashes, of
the word and of its neighbour in the term, says which words of a text could begin a look-up; they
leave the text with the few words around them and are joined, by that hash, with the filed terms, so
that a word meets only terms that have its neighbour too.  Whether the
rest of the term stands there, in its place, is then seen from the surroundings alone.  No term is
part of the plan, so a dictionary may have any number of them; the planner broadcasts the filed
terms if it measures them as small, and else only the words that passed the bitmap are shuffled.

The rules are those of ``functions.skills``: whole words, and next to a term's edge that is no
word character either a word character (``boundary="word"``) or none (``"token"``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.dictionaries import SkillDictionary
from jobsignal.functions.skills import NON_WORDS
from jobsignal.functions.text import blank_to
from jobsignal.operators.bitmap import bitmap, bits_for, hashed, may_contain
from jobsignal.session import working_folder

_WORD = r"[\p{L}\p{N}_]"
_PIECE = rf"{NON_WORDS[:-1]}*{_WORD}+|{NON_WORDS}$"
TERMS = "dict_id string, term string, skill string, boundary string"


def term_table(spark: SparkSession, dictionaries: dict[str, SkillDictionary]) -> DataFrame:
    """Dictionaries as rows (dict_id, term, skill, boundary)."""
    rows = [(name, term, skill, d.boundary) for name, d in dictionaries.items()
            for term, skill in d.display.items()]
    return spark.createDataFrame(rows, TERMS)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, NON_WORDS), "")


def _is_word(char: Column) -> Column:
    return F.coalesce(char.rlike(_WORD), F.lit(False))


def filed_terms(terms: DataFrame) -> DataFrame:
    """The terms under the word that they are looked up by, written down.

    ``terms`` has (dict_id, term, skill) and perhaps boundary; terms are lower-cased, and of equal
    ones of a dictionary the first skill by name counts.  A term without a letter, number or
    underscore is never found.  A word's terms are counted per task first.  Beside the word stands
    what comes before and after it in the term.
    """
    boundary = F.col("boundary") if "boundary" in terms.columns else F.lit("word")
    rows = terms.select("dict_id", F.lower("term").alias("term"), "skill",
                        F.coalesce(boundary, F.lit("word")).alias("boundary")) \
        .groupBy("dict_id", "term", "boundary").agg(F.min("skill").alias("skill"))
    # What each word comes after: the pieces of the term up to it, the word itself left out.
    pieces = F.regexp_extract_all("term", F.lit(_PIECE), F.lit(0))
    words = rows.withColumn("words", _words(F.col("term"))).withColumn("pieces", pieces) \
        .select("dict_id", "term", "skill", "boundary", "words", "pieces",
                F.posexplode("words").alias("i", "word"))
    counts = words.groupBy("word").agg(F.count("*").alias("_n"))
    best = words.join(counts, "word").groupBy("dict_id", "term", "boundary", "skill", "words",
                                              "pieces").agg(
        F.min(F.struct("_n", (-F.length("word")).alias("l"), "i", "word")).alias("b"))
    upto = F.array_join(F.slice("pieces", F.lit(1), F.col("b.i") + 1), "")
    head = F.left(upto, F.length(upto) - F.length("b.word"))
    size = F.size("words")
    near = F.col("b.i") + 1
    # The word and the next one, or at the end the one before and the word.
    pair = F.when(near < size, hashed("b.word", F.get("words", near))).otherwise(
        hashed(F.get("words", near - 2), "b.word"))
    first = F.regexp_extract("term", rf"^(?:{NON_WORDS})?", 0)
    last = F.regexp_extract("term", rf"(?:{NON_WORDS})?$", 0)
    # A term can overlap itself where its last words are its first ones, or both edges are signs.
    again = F.exists(F.sequence(F.lit(1), size - 1), lambda k: F.slice(
        "words", k + 1, size - k) == F.slice("words", F.lit(1), size - k))
    out = best.select(
        F.col("b.word").alias("word"), "dict_id", "term", "skill", "boundary",
        head.alias("head"), F.substr("term", F.length(upto) + 1).alias("tail"),
        F.col("b.i").alias("lead"), size.alias("size"),
        F.when(size > 1, pair).otherwise(hashed("b.word")).alias("mark"),
        F.length(first).alias("before"), F.length(last).alias("after"),
        ((size > 1) & F.coalesce(again, F.lit(False)) | ((first != "") & (last != "")))
        .alias("overlaps"))
    path = working_folder(terms.sparkSession, "terms")
    out.write.parquet(path)
    return terms.sparkSession.read.schema(out.schema).parquet(path)


def _cut_texts(texts: DataFrame, keys: Sequence[str], text: Column) -> DataFrame:
    """(*keys, _pieces, _words, i, word): one row per word, in a text that was cut once.

    The words leave their text before anything is looked up, as Spark compiles what is done to a
    row, but not what is done to the elements of a list.
    """
    low = texts.select(*keys, F.lower(blank_to(text, "")).alias("_low"))
    # The last piece may have no word.
    cut = low.select(*keys, F.regexp_extract_all("_low", F.lit(_PIECE), F.lit(0)).alias("_pieces"),
                     _words(F.col("_low")).alias("_words"))
    # The outer form keeps the optimizer from cutting every text a second time for a "list is not
    # empty" filter below the generator.
    return cut.select(*keys, "_pieces", "_words", F.posexplode_outer("_words").alias("i", "word"))


def _places(words: DataFrame, keys: Sequence[str], reach: int, marked: Column,
            bits: int) -> DataFrame:
    """(*keys, i, word, left, right, mark): the words that pass the bitmap, each with its place,
    what stands within ``reach`` words of it, and every mark that it passed with."""
    i, word = F.col("i"), F.col("word")

    def marks(next_word: Column, word_before: Column) -> list[Column]:
        return [hashed(word)] + ([hashed(word, next_word), hashed(word_before, word)]
                                 if reach > 1 else [])

    start = F.greatest(i - reach, F.lit(0))
    own = F.get("_pieces", i)
    before = F.concat(F.array_join(F.slice("_pieces", start + 1, i - start), ""),
                      F.left(own, F.length(own) - F.length(word)))
    after = F.array_join(F.slice("_pieces", i + 2, F.lit(reach + 1)), "")
    following, preceding = F.get("_words", i + 1), F.get("_words", i - 1)
    passed = reduce(Column.__or__, [may_contain(marked, m, bits)
                                    for m in marks(following, preceding)])
    found = words.where(word.isNotNull() & passed).select(
        *keys, "i", "word", before.alias("left"), after.alias("right"),
        following.alias("_next"), preceding.alias("_last"))
    # Between two equal words both neighbours give the same mark.  A list that is filtered ends the
    # compiled code above, which Java optimizes only while it is short.
    own_marks = F.filter(F.array_distinct(F.array(*marks(F.col("_next"), F.col("_last")))),
                         lambda m: m.isNotNull())
    return found.select(*keys, "i", "word", "left", "right", F.explode_outer(own_marks)
                        .alias("mark")).where(may_contain(marked, F.col("mark"), bits))


def term_places(texts: DataFrame, keys: Sequence[str], text: Column, filed: DataFrame) -> DataFrame:
    """(*keys, dict_id, term, skill, ...): every place where a term stands in a text."""
    n, reach = filed.agg(F.count("*"), F.coalesce(F.max("size"), F.lit(1))).first()
    bits = bits_for(n)
    # A subquery: its value is made once and is part of the compiled filter.
    marked = bitmap(filed, "mark", bits).scalar()
    low = _places(_cut_texts(texts, keys, text), keys, reach, marked, bits)
    there = low.join(filed, ["mark", "word"]).where(
        F.endswith("left", "head") & F.startswith("right", "tail"))
    inner = F.left("left", F.length("left") - F.length("head"))
    outer = F.substr("right", F.length("tail") + 1)
    strict = F.col("boundary") == "word"
    ok = (_is_word(F.right(inner, F.lit(1))) == (strict & (F.col("before") > 0))) \
        & (_is_word(F.left(outer, F.lit(1))) == (strict & (F.col("after") > 0)))
    gap = F.length(F.regexp_extract(outer, rf"^(?:{NON_WORDS})?", 0)) + F.col("after")
    return there.where(ok).select(
        *keys, "dict_id", "term", "skill", "overlaps", "size",
        (F.col("i") - F.col("lead")).alias("at"),
        # whether the same term can begin at the very next word
        (gap >= F.col("before") + F.col("after")).alias("room"))


def table_mentions(texts: DataFrame, keys: Sequence[str], text: Column,
                   terms: DataFrame) -> DataFrame:
    """(*keys, dict_id, term, skill, mentions) of the terms of a table; ``keys`` name a text.

    Mentions don't overlap; they are counted from the left.  Only the places of terms that could
    overlap themselves are listed, per text and term.
    """
    places = term_places(texts, keys, text, filed_terms(terms))
    place = F.when(F.col("overlaps"), F.struct("at", "room"))
    counted = places.groupBy(*keys, "dict_id", "term", "skill").agg(
        F.count("*").alias("n"), F.max("size").alias("size"),
        F.array_sort(F.collect_list(place)).alias("places"))

    def take(acc: Column, p: Column) -> Column:
        free = (p["at"] > acc["until"]) | ((p["at"] == acc["until"]) & acc["room"])
        return F.when(free, F.struct((acc["n"] + 1).alias("n"), (p["at"] + F.col("size"))
                                     .alias("until"), p["room"].alias("room"))).otherwise(acc)

    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("until"),
                     F.lit(True).alias("room"))
    apart = F.aggregate("places", start, take)["n"]
    return counted.select(*keys, "dict_id", "term", "skill",
                          F.when(F.size("places") > 0, apart).otherwise(F.col("n")).alias("mentions"))
