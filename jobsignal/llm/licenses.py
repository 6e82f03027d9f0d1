"""License notices by a positional index of rare words; DataFrame functions only.

A text keeps, of its words, those that occur in a notice, with their places.  Their document
frequencies over the corpus rank them.  The look-up is turned round: anchors are chosen per notice,
the rarest words of its key phrase in the corpus, and each notice looks for them among a text's
places.  Where they agree on where the key phrase would begin, it is verified word by word.  No
text ranks its own words, and there is no table of notices' postings: there are a few notices, all
in the plan, and anchors from the key phrase find it at every place without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.functions.text import bind
from jobsignal.llm.tables import documents, stored

#: What separates words before letters are lowered.
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Notice:
    """Words of a notice; `key` is the phrase in it that must stand in a text."""

    label: str
    text: str
    key: str

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        """Where the key phrase begins in the notice."""
        words, key = self.words, self.key_words
        return next(i for i in range(len(words)) if words[i:i + len(key)] == key)


# The phrases of the contract.
BASE = (
    Notice("mit", "under the mit license", "under the mit license"),
    Notice("apache-2", "apache license version 2", "apache license version 2"),
    Notice("cc-by-nc", "cc by nc", "cc by nc"),
)
# Opening words of public licenses and of their usual notices.
MORE = (
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
                  "this software and associated documentation files",
           "granted free of charge to any person obtaining a copy"),
    Notice("apache-2", "licensed under the apache license version 2 0 the license you may not use "
                       "this file except in compliance with the license",
           "apache license version 2 0"),
    Notice("gpl-3", "this work is licensed under the gnu general public license version 3",
           "gnu general public license version 3"),
    Notice("gpl-2", "this work is licensed under the gnu general public license version 2",
           "gnu general public license version 2"),
    Notice("lgpl", "under the terms of the gnu lesser general public license",
           "gnu lesser general public license"),
    Notice("agpl", "under the terms of the gnu affero general public license",
           "gnu affero general public license"),
    Notice("mpl-2", "this source code form is subject to the terms of the mozilla public license "
                    "v 2 0", "mozilla public license"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification "
                  "are permitted provided that the following conditions are met",
           "redistribution and use in source and binary forms"),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose "
                  "with or without fee is hereby granted",
           "distribute this software for any purpose with or without fee"),
    Notice("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    Notice("cc0", "cc0 1 0 universal", "cc0 1 0 universal"),
    Notice("unlicense", "this is free and unencumbered software released into the public domain",
           "free and unencumbered software"),
)
NOTICES = BASE + MORE


def vocabulary(notices: Sequence[Notice] = NOTICES) -> list[str]:
    return sorted({w for n in notices for w in n.words})


def postings(df: DataFrame, key: list[str], known: list[str], text: str = "text") -> DataFrame:
    """`key`, n_words, and places: array of (at, word), the notice words of a text by place.

    Only A-Z have a lower case here; a word with other letters is never a notice word.  `word` is
    the number in `known`.
    """
    spaced = F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BREAKS, " "))
    words = F.filter(F.split(spaced, " "), lambda w: w != "")

    def place(w: Column, i: Column) -> Column:
        low = F.lower(w)
        return F.when(low.isin(known) & (F.octet_length(w) == F.length(w)), F.struct(
            i.alias("at"), (F.array_position(F.array(*map(F.lit, known)), low) - 1)
            .cast("int").alias("word")))

    both = bind(words, lambda ws: F.struct(
        F.size(ws).alias("n"),
        F.filter(F.transform(ws, place), lambda p: p.isNotNull()).alias("places")))
    return df.select(*key, both.alias("b")) \
        .select(*key, F.col("b.n").cast("long").alias("n_words"), F.col("b.places").alias("places"))


def document_frequencies(found: DataFrame, known: list[str]) -> list[int]:
    """In how many texts each known word occurs; one row per word of the vocabulary."""
    counts = found.select(F.explode(F.array_distinct("places.word")).alias("word")) \
        .groupBy("word").count().collect()  # bounded by the vocabulary
    by_word = {r["word"]: r["count"] for r in counts}
    return [by_word.get(i, 0) for i in range(len(known))]


def rarest(notice: Notice, known: list[str], frequencies: list[int], n: int = 2) -> list[int]:
    """Positions in the key phrase of its n rarest words (of one word the first position)."""
    words = notice.key_words
    order = sorted(set(words), key=lambda w: (frequencies[known.index(w)], w))
    return [words.index(w) for w in order[:n]]


def _in_order(columns: list[Column], empty: Column) -> Column:
    return reduce(lambda a, b: F.concat(a, b), columns, empty)


def matched(found: DataFrame, known: list[str], frequencies: list[int],
            notices: Sequence[Notice] = NOTICES) -> DataFrame:
    """Add `hits`: array of (notice, at, share) for every place where a key phrase stands.

    `notice` is the number in `notices`, `at` the first word of its key phrase and `share` the part
    of all words of the notice that stand at their positions around it.
    """
    hit_type = "array<struct<notice:int,at:int,share:double>>"

    def codes(words: Sequence[str]) -> list[int]:
        return [known.index(w) for w in words]

    def has(places: Column, word: int, at: Column) -> Column:
        return F.array_contains(places, F.struct(at.cast("int").alias("at"),
                                                 F.lit(word).alias("word")))

    def look_up(k: int, notice: Notice) -> Column:
        places = F.col("places")
        key = codes(notice.key_words)
        anchors = rarest(notice, known, frequencies)
        starts = F.transform(F.filter(places, lambda p: p["word"] == key[anchors[0]]),
                             lambda p: p["at"] - anchors[0])
        for at in anchors[1:]:
            starts = F.filter(starts, lambda s: has(places, key[at], s + at))
        starts = F.filter(starts, lambda s: reduce(
            lambda a, b: a & b, [has(places, w, s + j) for j, w in enumerate(key)]))
        before = notice.key_at

        def share(s: Column) -> Column:
            if len(notice.words) == len(key):
                return F.lit(1.0)
            there = [has(places, w, s - before + j).cast("int")
                     for j, w in enumerate(codes(notice.words))]
            return reduce(lambda a, b: a + b, there) / F.lit(float(len(there)))

        hits = F.transform(starts, lambda s: F.struct(
            F.lit(k).alias("notice"), s.cast("int").alias("at"), share(s).alias("share")))
        return F.when(F.exists("places", lambda p: p["word"] == key[anchors[0]]), hits) \
            .otherwise(F.array().cast(hit_type))

    return found.withColumn("hits", _in_order(
        [look_up(k, n) for k, n in enumerate(notices)], F.array().cast(hit_type)))


def scanned(df: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """`key`, n_words and hits of every row; a null text has no words.

    Texts are read once; their notice words are written down, so that the frequencies can be
    counted over all of them before the index is made.
    """
    known = vocabulary()
    found = stored(postings(df, key, known, text), "license_words")
    return matched(found, known, document_frequencies(found, known)).drop("places")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of all `documents`; rows without any have null first and last
    words, empty labels and score 0.  Repeated rows are repeated."""
    found = scanned(documents(spark, sf_dir), ["doc_id"])
    base = F.filter("hits", lambda h: h["notice"] < len(BASE))
    names = F.array(*[F.lit(n.label) for n in NOTICES])

    def labels(hits: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(
            F.transform(hits, lambda h: F.get(names, h["notice"])))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda h: h["at"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda h: h["at"])).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["share"])), F.lit(0.0))
        .alias("score"))


def _sql() -> str:
    """The same rows in DuckDB: every phrase is looked for at every word."""

    def at(words: list[str], start: str) -> str:
        return " AND ".join(f"ws[{start} + {j}] IS NOT DISTINCT FROM '{w}'"
                            for j, w in enumerate(words))

    hits = []
    for k, n in enumerate(NOTICES):
        there = " + ".join(f"(ws[i + {j - n.key_at}] IS NOT DISTINCT FROM '{w}')::INT"
                           for j, w in enumerate(n.words))
        hits.append(f"list_transform(list_filter(range(1, len(ws) + 1), lambda i: "
                    f"{at(n.key_words, 'i')}), lambda i: {{'notice': {k}, 'at': i - 1, "
                    f"'share': ({there})::DOUBLE / {len(n.words)}}})")
    names = "[" + ", ".join(f"'{n.label}'" for n in NOTICES) + "]"

    def labels(hits: str) -> str:
        return (f"array_to_string(list_sort(list_distinct(list_transform({hits}, "
                f"lambda h: {names}[h.notice + 1]))), ',')")

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents),
found AS (SELECT doc_id, len(ws) AS n_words, flatten([{', '.join(hits)}]) AS hits FROM words),
base AS (SELECT *, list_filter(hits, lambda h: h.notice < {len(BASE)}) AS base FROM found)
SELECT doc_id, n_words, len(base)::BIGINT AS n_base,
       list_min(list_transform(base, lambda h: h.at))::BIGINT AS first_word,
       list_max(list_transform(base, lambda h: h.at))::BIGINT AS last_word,
       {labels('base')} AS base_labels, {labels('hits')} AS labels,
       coalesce(list_max(list_transform(hits, lambda h: h.share)), 0)::DOUBLE AS score
FROM base"""


SQL = _sql()
