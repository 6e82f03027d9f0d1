"""Categories, regions and the like as a table: which of its needles a text contains, by a join.

A needle counts wherever it occurs, inside words too.  One of its pieces between blanks is filed
under its rarest trigram (a shorter piece is its own gram).  The words of all texts are looked up
by their trigrams once, each distinct word that is, and those that contain a filed piece are
entered with its needle.  A bitmap of the entered words says which words leave a text, with the few
words around them; they are joined with the entries, and the surroundings show whether the whole
needle is there.  No needle is part of the plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.functions import rules
from jobsignal.functions.text import bind, blank_to
from jobsignal.operators.bitmap import bitmap, bits_for, hashed, may_contain
from jobsignal.session import working_folder

GRAM = 3
NEEDLES = "dim string, name string, needle string"


def category_needles(spark: SparkSession, queries: Mapping[str, str] = rules.CATEGORY_QUERIES,
                     dim: str = "category") -> DataFrame:
    """A category is met by its own name or by the phrase it is searched for."""
    rows = {(dim, c, n) for c, phrase in queries.items() for n in (c, phrase)}
    return spark.createDataFrame(sorted(rows), NEEDLES)


def region_needles(spark: SparkSession, dim: str = "region") -> DataFrame:
    """A region is met by its tokens; 'remote' also by an empty location, the empty needle."""
    rows = [(dim, n, t) for names, tokens in rules.REGION_TOKENS for n in names for t in tokens]
    return spark.createDataFrame([*rows, (dim, "remote", "remote"), (dim, "remote", "")], NEEDLES)


def met_needles(texts: DataFrame, keys: Sequence[str], text: Column, needles: DataFrame) -> DataFrame:
    """(*keys, dim, name): the names of a table, of which a text contains one of the needles.

    ``needles`` has (dim, name, needle).  Case is ignored.  The empty needle is met by empty and
    null texts only; one of blanks alone, or null, is never met.  Equal keys are one text.
    """
    low = texts.select(*keys, F.lower(blank_to(text, "")).alias("_low"))
    entries = _written(_entries(low, _written(_filed(needles), "needles")), "entries")
    n, reach = entries.agg(F.count_distinct("word"), F.coalesce(F.max("size"), F.lit(1))).first()
    bits = bits_for(n)
    marked = low.select(*keys, "_low", bitmap(
        entries.select(hashed("word").alias("mark")), "mark", bits).scalar().alias("_bitmap"))
    words = marked.select(*keys, F.explode_outer(
        _windows(F.col("_low"), reach, F.col("_bitmap"), bits)).alias("w")) \
        .where(F.col("w").isNotNull()).select(*keys, "w.*")
    found = words.join(entries, "word").where(F.contains("window", "needle")) \
        .select(*keys, "dim", "name")
    # The names that an empty text meets, no more than the needles.
    blank = needles.where(F.col("needle") == "").agg(F.collect_set(F.struct("dim", "name"))).scalar()
    empty = low.where(F.col("_low") == "").select(*keys, F.explode(blank).alias("b")) \
        .select(*keys, "b.dim", "b.name")
    return found.unionByName(empty).distinct()


def _filed(needles: DataFrame) -> DataFrame:
    """(gram, piece, dim, name, needle, size): every needle under its rarest gram."""
    rows = needles.select("dim", "name", F.lower("needle").alias("needle")).distinct() \
        .where(F.trim("needle") != "")
    pieces = rows.select("*", F.explode(F.array_distinct(F.filter(
        F.split("needle", " "), lambda p: p != ""))).alias("piece"))
    listed = pieces.select("*", F.explode(_grams(F.col("piece"))).alias("gram")) \
        .where((F.length("gram") == GRAM) | (F.col("gram") == F.col("piece")))
    counts = listed.groupBy("gram").agg(F.count("*").alias("_n"))
    best = listed.join(counts, "gram").groupBy("dim", "name", "needle").agg(
        F.min(F.struct((-F.length("gram")).alias("l"), "_n", (-F.length("piece")).alias("p"),
                       "gram", "piece")).alias("b"))
    return best.select("b.gram", "b.piece", "dim", "name", "needle",
                       F.size(F.split("needle", " ")).alias("size"))


def _grams(word: Column) -> Column:
    """The distinct runs of up to ``GRAM`` characters in a word."""
    def of(chars: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(chars, lambda c, i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(GRAM), F.size(chars) - i)),
            lambda k: F.array_join(F.slice(chars, i + 1, k), "")))))

    return bind(F.filter(F.split(word, ""), lambda c: c != ""), of)


def _entries(low: DataFrame, filed: DataFrame) -> DataFrame:
    """(word, dim, name, needle, size): the distinct words of the texts that contain a piece."""
    words = low.select(F.explode(F.array_distinct(F.split("_low", " "))).alias("word")).distinct()
    grams = words.select("word", F.explode(_grams(F.col("word"))).alias("gram"))
    return grams.join(filed, "gram").where(F.contains("word", "piece")) \
        .select("word", "dim", "name", "needle", "size")


def _windows(low: Column, reach: int, marks: Column, bits: int) -> Column:
    """The words of a text that pass the bitmap, each with what stands around it.

    Words are what single blanks divide, so joining them again gives the text as it was.
    """
    def around(words: Column, marked: Column) -> Column:
        def window(word: Column, i: Column) -> Column:
            start = F.greatest(i - (reach - 1), F.lit(0))
            near = F.array_join(F.slice(words, start + 1, i - start + reach), " ")
            return F.when(may_contain(marked, hashed(word), bits),
                          F.struct(word.alias("word"), near.alias("window")))

        return F.filter(F.transform(words, window), lambda w: w.isNotNull())

    return bind(F.split(low, " "), lambda words: bind(marks, lambda marked: around(words, marked)))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = working_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
