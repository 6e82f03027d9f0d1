"""Mix sources to target weights, block by block.

The words of each source, in order of document, are one stream that is cut into blocks of a fixed
length.  A source draws as many blocks as its target asks for.  Its draws are spread over the
output shards by a multinomial draw, and numbered; a number is a slot, and a pseudorandom
permutation of the source's block numbers says which block stands in the slot.  Each pass through
a source has a permutation of its own, so that no block is drawn a third time before all others
were drawn twice.  Blocks and slots meet in a join on source and block number.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.llm.tables import running_total, ship, stored

WORD = r"[^\x20\x09-\x0D]+"
_WORD = re.compile(WORD)


@dataclass(frozen=True)
class Mix:
    """`weights` go to the sources by code point, null last, over and over."""

    weights: tuple[int, ...] = (3, 1, 2)
    #: The targets share so many times the size of the corpus; none is more than `most` times the
    #: size of its source.
    total: float = 1.5
    most: int = 2
    block_words: int = 64
    shard_blocks: int = 4096
    #: Shards whose slots one task makes, about.
    task_shards: int = 16
    seed: int = 42


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, source_size, weight, target, blocks, draws), one row per source.

    Sources that would get more than their limit get the limit, and what is left is shared anew
    among the others, until none is above; each round needs two sums over the sources.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")) \
        .withColumn("one", F.lit(1))
    ranked = running_total(sources.withColumn("key", F.col("source").isNull()),
                           ["key", "source"], "one", "place").drop("one", "key")
    weights = F.array(*[F.lit(w) for w in mix.weights])
    table = stored(ranked.select(
        "source", "source_size",
        F.get(weights, F.pmod("place", F.lit(len(mix.weights))).cast("int")).alias("weight"),
        (mix.most * F.col("source_size")).alias("limit")), "sources")
    left = mix.total * (table.agg(F.sum("source_size")).first()[0] or 0)
    level = None
    while True:
        capped = F.lit(False) if level is None else F.col("limit") < level * F.col("weight")
        fixed, shares = table.agg(F.sum(F.when(capped, F.col("limit")).otherwise(0)),
                                  F.sum(F.when(capped, 0).otherwise(F.col("weight")))).first()
        if not shares:
            level = float("inf")
            break
        rest = left - fixed
        following = rest / shares
        if level is not None and following <= level:
            break
        level = following
    if level == float("inf"):
        target = F.col("limit").cast("double")
    else:
        target = F.when(F.col("limit") < level * F.col("weight"), F.col("limit")) \
            .otherwise(F.lit(rest) * F.col("weight") / F.lit(shares)).cast("double")
    blocks = F.ceil(F.col("source_size") / mix.block_words).cast("long")
    return table.withColumn("target", target).withColumn("blocks", blocks) \
        .withColumn("draws", F.when(F.col("source_size") > 0, F.round(
            F.col("target") * F.col("blocks") / F.col("source_size"))).otherwise(0).cast("long")) \
        .drop("limit")


def permuted(places: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(n), chosen by `key`, at some of its places.

    Four rounds of a Feistel network over the next even power of two; what falls outside goes
    through again.
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(0, 1 << 63, 4, dtype=np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        a, b = x >> np.uint64(half), x & mask
        for k in keys:
            f = (b ^ k) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ f >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
            a, b = b, a ^ (f >> np.uint64(32) & mask)
        return a << np.uint64(half) | b

    x = once(places.astype(np.uint64))
    while (outside := x >= n).any():
        x[outside] = once(x[outside])
    return x.astype(np.int64)


def _key(mix: Mix, source: str | None, *more: int) -> list[int]:
    name = b"\0" if source is None else b"\1" + source.encode()
    return [mix.seed, zlib.crc32(name), len(name), *more]


def shard_draws(targets: DataFrame, shards: int, mix: Mix = Mix()) -> DataFrame:
    """(source, blocks, shard, first_slot, n): how many draws of a source fall to each shard.

    Per source a multinomial draw with equal chances, so that the draws add up to what the target
    asks for.  It is made in two steps, over groups of shards and within each group, which gives
    the same distribution and keeps any task's arrays as short as the square root.
    """
    group = max(1, round(shards ** 0.5))
    groups = -(-shards // group)

    def sizes(g: int) -> int:
        return min(group, shards - g * group)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chances = np.array([sizes(g) for g in range(groups)]) / shards
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.random.default_rng(_key(mix, row["source"])) \
                    .multinomial(row["draws"], chances)
                used = np.flatnonzero(counts)
                starts = np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["source"]] * len(used), pa.string()),
                     pa.array([row["blocks"]] * len(used), pa.int64()), pa.array(used),
                     pa.array(starts[used]), pa.array(counts[used], pa.int64())],
                    ["source", "blocks", "shards", "first_slot", "n"])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                g = row["shards"]
                counts = np.random.default_rng(_key(mix, row["source"], g)) \
                    .multinomial(row["n"], np.full(sizes(g), 1 / sizes(g)))
                used = np.flatnonzero(counts)
                starts = row["first_slot"] + np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["source"]] * len(used), pa.string()),
                     pa.array([row["blocks"]] * len(used), pa.int64()),
                     pa.array(g * group + used), pa.array(starts[used]),
                     pa.array(counts[used], pa.int64())],
                    ["source", "blocks", "shard", "first_slot", "n"])

    by_group = targets.select("source", "blocks", "draws").mapInArrow(
        spread, "source string, blocks long, shards long, first_slot long, n long")
    # A stated number of tasks: by the size of these few rows they would all go to one.
    return by_group.repartition(max(1, shards // mix.task_shards), "source", "shards").mapInArrow(
        within, "source string, blocks long, shard long, first_slot long, n long")


def slots(draws: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, shard, slot, pass, block): the block in each slot."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                numbers = np.arange(row["first_slot"], row["first_slot"] + row["n"])
                passes, at = np.divmod(numbers, row["blocks"])
                blocks = np.empty_like(at)
                for p in np.unique(passes):
                    here = passes == p
                    blocks[here] = permuted(at[here], row["blocks"],
                                            _key(mix, row["source"], 1, int(p)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["source"]] * len(numbers), pa.string()),
                     pa.array([row["shard"]] * len(numbers), pa.int64()), pa.array(numbers),
                     pa.array(passes), pa.array(blocks)],
                    ["source", "shard", "slot", "pass", "block"])

    return draws.mapInArrow(place, "source string, shard long, slot long, pass long, block long")


def mixture(sizes: DataFrame, mix: Mix = Mix()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the mix takes: (documents, targets, pieces) for `sizes` (doc_id, source, size).

    documents: doc_id, source, size, offset (words of its source before it).  pieces: shard, slot,
    pass, and the words from `first` to before `last` of the document at (source, offset) that
    stand in the slot.  Rows with the same doc_id follow each other by size.  Empty documents have
    no pieces.  The same input gives the same mix.
    """
    narrow = stored(sizes.select("doc_id", "source", "size"), "sizes")
    targets = stored(source_targets(narrow, mix), "targets")
    docs = stored(running_total(narrow, ["doc_id", "size"], "size", "offset", within="source"),
                  "offsets")
    total = targets.agg(F.sum("draws")).first()[0] or 0
    shards = max(1, -(-total // mix.shard_blocks))
    drawn = slots(shard_draws(targets, shards, mix), mix)
    end = F.col("offset") + F.col("size")
    parts = docs.filter("size > 0").select(
        "doc_id", "source", "offset", "size",
        F.explode(F.sequence(F.floor(F.col("offset") / mix.block_words),
                             F.floor((end - 1) / mix.block_words))).alias("block"))
    begin = F.col("block") * mix.block_words
    parts = parts.select(
        F.col("source").alias("of"), F.col("block").alias("number"), "doc_id", "offset", "size",
        (F.greatest(begin, F.col("offset")) - F.col("offset")).alias("first"),
        (F.least(begin + mix.block_words, end) - F.col("offset")).alias("last"))
    # The planner can't know how many rows a draw becomes, and would broadcast them.
    pieces = drawn.join(parts.hint("merge"), (F.col("block") == F.col("number")) &
                        F.col("source").eqNullSafe(F.col("of"))).drop("of", "number")
    return docs, targets, pieces


def taken(docs: DataFrame, targets: DataFrame, pieces: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken): words that the mix takes of each document."""
    used = pieces.groupBy("source", "offset").agg(F.sum(F.col("last") - F.col("first"))
                                                  .alias("taken")) \
        .select(F.col("source").alias("of"), F.col("offset").alias("at"), "taken")
    same = (F.col("offset") == F.col("at")) & F.col("source").eqNullSafe(F.col("of"))
    some = docs.filter("size > 0").join(used.hint("merge"), same, "left").select(
        "doc_id", "source", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
    every = some.union(docs.filter("size = 0")
                       .select("doc_id", "source", "size", F.lit(0).cast("long")))
    of = targets.select(F.col("source").alias("of"), "source_size", "target")
    return every.join(of, F.col("source").eqNullSafe(F.col("of"))) \
        .select("doc_id", "size", "source_size", "target", F.col("taken").cast("long"))


def word_ranges(text: Column, ranges: Column) -> Column:
    """The parts of a text between words, from `first` to before `last` of each range, in order.

    Adjoining ranges keep what stands between them; others are set off by a line break.  Ranges
    that hold all words give the whole text.
    """

    @F.arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            out = []
            for x, wanted in zip(texts, lists):
                s, joined = x.as_py() or "", []
                for r in wanted.as_py() or []:
                    if joined and joined[-1][1] == r["first"]:
                        joined[-1][1] = r["last"]
                    else:
                        joined.append([r["first"], r["last"]])
                words = [m.span() for m in _WORD.finditer(s)]
                if joined == [[0, len(words)]]:
                    out.append(s)
                else:
                    out.append("\n".join(s[words[a][0]:words[b - 1][1]] for a, b in joined))
            yield pa.array(out, pa.string())

    return cut(text, ranges)


def op7_block_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each of the `documents`.

    Null texts have size 0, null sources are a source of their own, repeated rows are documents of
    their own; an empty table gives no rows.
    """
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return taken(*mixture(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))))
