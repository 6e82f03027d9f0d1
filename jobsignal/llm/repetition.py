"""Quality rules from a suffix array: how much of a text repeats itself, and how long at a time.

The suffix array is one of words.  Its longest-common-prefix intervals are the maximal repeated
word sequences; the deepest interval that holds a suffix says how far the text that begins there
occurs a second time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.llm.tables import documents

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """A text is kept if all hold; texts without a repeat of `span_words` words pass the last two."""

    least_words: int = 10
    #: Per cent of the words that may lie in repeated windows of `window` words.
    repeat_percent: int = 20
    window: int = 5
    #: Repeats of at least `span_words` words may cover so many per cent of the characters in
    #: words, and none may be longer than `longest` words.
    span_words: int = 8
    covered_percent: int = 30
    longest: int = 50


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array by prefix doubling, and the ranks of all prefixes of 1, 2, 4... words.

    Doubling stops as soon as all ranks differ.  The end of the text is smaller than any word, so
    two suffixes have one rank only if both are that long.
    """
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    ranks, length = [rank], 1
    while n and rank.max() < n - 1:
        key = rank * (n + 1)
        key[:n - length] += rank[length:] + 1
        order = np.argsort(key, kind="stable")
        held = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(held[1:] != held[:-1])))
        ranks.append(rank)
        length *= 2
    places = np.empty(n, np.int64)
    places[rank] = np.arange(n)
    return places, ranks


def common_prefixes(places: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix has in common with the next one of the array."""
    n = len(places)
    a, b = places[:-1].copy(), places[1:].copy()
    common = np.zeros(max(n - 1, 0), np.int64)
    for power in reversed(range(len(ranks) - 1)):
        rank = ranks[power]
        inside = np.maximum(a, b) < n
        same = np.zeros(len(a), bool)
        same[inside] = rank[a[inside]] == rank[b[inside]]
        common[same] += 1 << power
        a[same] += 1 << power
        b[same] += 1 << power
    return common


def repeat_lengths(ids: np.ndarray) -> np.ndarray:
    """For each place the longest word sequence from there that also stands elsewhere."""
    places, ranks = suffix_array(ids)
    longest = np.zeros(len(ids), np.int64)
    if len(ids) > 1:
        common = common_prefixes(places, ranks)
        longest[places[1:]] = common
        longest[places[:-1]] = np.maximum(longest[places[:-1]], common)
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeat of at least `least` words: the union of all such spans."""
    starts = np.flatnonzero(longest >= least)
    change = np.zeros(len(longest) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + longest[starts], -1)
    return np.cumsum(change[:-1]) > 0


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "covered_chars", "longest_repeat")


def measure(text: str, limits: Limits = Limits()) -> tuple[int, ...]:
    """The measures of a text, in the order of MEASURES."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    n = len(ids)
    repeated = spanned = longest = 0
    if len(known) < n:
        lengths = repeat_lengths(ids)
        repeated = int(covered(lengths, limits.window).sum())
        longest = int(lengths.max())
        inside = covered(lengths, limits.span_words)
        spanned = sum(len(words[i].decode("utf-8", "surrogatepass"))
                      for i in np.flatnonzero(inside))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    blanks = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    return (n, len(text) - blanks, sum(text.count(c) for c in SYMBOLS),
            len(lines) - len(set(lines)), repeated, spanned, longest)


def measures(text: Column, limits: Limits = Limits()) -> Column:
    """A struct of the MEASURES of a text; a null text is an empty one."""
    kind = pa.struct([(m, pa.int64()) for m in MEASURES])

    @F.arrow_udf("struct<" + ",".join(f"{m}:long" for m in MEASURES) + ">")
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = [measure(x.as_py() or "", limits) for x in texts]
            columns = np.array(rows, np.int64).reshape(-1, len(MEASURES))
            yield pa.StructArray.from_arrays([pa.array(columns[:, i])
                                              for i in range(len(MEASURES))], fields=list(kind))

    return each(text)


def judged(df: DataFrame, limits: Limits = Limits(), text: str = "text") -> DataFrame:
    """Add the MEASURES, `base_failed` and `kept`; columns of these names are replaced.

    Every row is judged by itself: repeated rows alike, null and empty texts fail.
    """
    found = df.withColumn("_m", measures(F.col(text), limits))
    found = found.withColumns({m: F.col(f"_m.{m}") for m in MEASURES}).drop("_m")
    failed = (F.col("n_words") < limits.least_words) | \
        (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words"))
    much = 100 * F.col("covered_chars") > limits.covered_percent * F.col("word_chars")
    long = (F.col("longest_repeat") > limits.longest)
    return found.withColumn("base_failed", failed) \
        .withColumn("kept", ~F.col("base_failed") & ~much & ~long)


def op4_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures and verdicts of all `documents`; an empty table gives no rows."""
    return judged(documents(spark, sf_dir)).select(
        "doc_id", *MEASURES[:-1], "base_failed", "kept")


def _sql(limits: Limits = Limits()) -> str:
    """The same rows in DuckDB, from windows of words that occur twice in their text.

    Words in repeats of at least k words are the words of the k-word windows found twice, and a
    repeat longer than k words is a window of k + 1 words found twice.
    """
    blank = r"[\x20\x09-\x0D]"

    def windows(k: int) -> str:
        return f"""
w{k} AS (
  SELECT r, i FROM (
    SELECT r, i, count(*) OVER (PARTITION BY r, w) AS c FROM (
      SELECT r, unnest(range(1, len(ws) - {k - 2})) AS i,
             unnest(list_transform(range(1, len(ws) - {k - 2}),
                                   lambda i: array_to_string(ws[i:i + {k - 1}], ' '))) AS w
      FROM texts WHERE len(ws) >= {k})) WHERE c > 1),
c{k} AS (
  SELECT r, count(*) AS n, sum(length(ws[j])) AS chars
  FROM (SELECT DISTINCT r, unnest(range(i, i + {k})) AS j FROM w{k}) JOIN texts USING (r)
  GROUP BY r)"""

    window, span, long = limits.window, limits.span_words, limits.longest + 1
    return f"""
WITH numbered AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
texts AS MATERIALIZED (
  SELECT r, doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws,
         length(regexp_replace(text, '{blank}', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^{SYMBOLS}]', '', 'g')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))
           AS lines
  FROM numbered),{windows(window)},{windows(span)},{windows(long)},
measured AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, word_chars, n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(a.n, 0) AS n_repeat_words, coalesce(b.chars, 0)::BIGINT AS covered_chars,
         c.n IS NOT NULL AS long
  FROM texts LEFT JOIN c{window} a USING (r) LEFT JOIN c{span} b USING (r)
       LEFT JOIN c{long} c USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_chars,
       n_words < {limits.least_words}
         OR 100 * n_repeat_words > {limits.repeat_percent} * n_words AS base_failed,
       NOT base_failed AND NOT long
         AND 100 * covered_chars <= {limits.covered_percent} * word_chars AS kept
FROM measured"""


SQL = _sql()
