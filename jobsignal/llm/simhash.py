"""SimHash fingerprints, and their comparison on vertical bit planes.

Cut into `bands` of bits, fingerprints within the radius agree in all but `radius` of them.  They
are dealt out by every choice of the other bands, many choices to a pool, and each pool is compared
whole: its fingerprints are stored as 64 bit planes, lane by lane, and the distances of many pairs
grow at once in bitwise counters.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.llm.tables import components, documents, stored, tiles

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Rows of a pool, and of a block of a pool that is larger.
POOL = 512
BLOCK = 1024
#: Shingles whose bits are counted at once.
CHUNK = 1 << 15


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text; 0 without words.

    The bits of each chunk of hashes are added up, so that a long text needs no more memory than
    its words.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[:max(1, len(words) - shingle + 1)].tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        hashes = np.array([digest(line[a:b], seed) for a, b
                           in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(text: Column) -> Column:
    """The fingerprint of a text as a long with the same bits; null counts as empty."""

    @F.arrow_udf("long")
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [fingerprint(x.as_py() or "") for x in texts]
            yield pa.array(np.array(found, np.uint64).view(np.int64))

    return each(text)


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 rows of words: bit i of lane j is bit i of the j-th fingerprint.  Spare lanes are 0."""
    lanes = -(-max(len(prints), 1) // 64) * 64
    padded = np.zeros(lanes, "<u8")
    padded[:len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(lanes, 8), axis=1, bitorder="little")
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return np.ascontiguousarray(planes).view("<u8").astype(np.uint64)


def within(queries: np.ndarray, planes: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each query and lane one bit: whether they differ in at most `radius` bits.

    Three planes of differences are added by a carry-save adder, and its sum and carry go into
    counters of weight 1, 2, 4...  A lane that has reached a weight beyond the counters is over for
    good.  After each group of planes the queries whose lanes are all over are abandoned.
    """
    weights = max(1, int(radius).bit_length())
    n, words = len(queries), planes.shape[1]
    result = np.zeros((n, words), np.uint64)
    alive = np.arange(n)
    counters = [np.zeros((n, words), np.uint64) for _ in range(weights)]
    over = np.zeros((n, words), np.uint64)
    asked = queries.astype(np.uint64)

    def add(bits: np.ndarray, at: int) -> None:
        for w in range(at, weights):
            carry = counters[w] & bits
            counters[w] ^= bits
            bits = carry
        np.bitwise_or(over, bits, out=over)

    for first in range(0, 64, 3):
        diffs = []
        for bit in range(first, min(first + 3, 64)):
            flip = (np.uint64(0) - (asked >> np.uint64(bit) & np.uint64(1)))[:, None]
            diffs.append(planes[bit][None, :] ^ flip)
        if len(diffs) == 3:
            a, b, c = diffs
            both = a ^ b
            add(both ^ c, 0)
            carry = (a & b) | (both & c)
            if weights > 1:
                add(carry, 1)
            else:
                over |= carry
        else:
            for d in diffs:
                add(d, 0)
        if first % 12 == 9:
            beyond = over | _above(counters, radius)
            going = ~(beyond == np.uint64(0xFFFFFFFFFFFFFFFF)).all(axis=1)
            if not going.all():
                alive, asked, over = alive[going], asked[going], over[going]
                counters = [c[going] for c in counters]
                if not len(alive):
                    return result
    result[alive] = ~(over | _above(counters, radius))
    return result


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter exceeds the radius, compared bit by bit from the highest weight."""
    more = np.zeros_like(counters[0])
    same = ~more
    for w in reversed(range(len(counters))):
        if radius >> w & 1:
            same &= counters[w]
        else:
            more |= same & counters[w]
    return more


def close_pairs(left: np.ndarray, right: np.ndarray,
                radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of `left` and `right` within the radius, some rows of `left` at a time."""
    planes = bit_planes(right)
    step = max(1, (1 << 16) // planes.shape[1])
    for at in range(0, len(left), step):
        hits = within(left[at:at + step], planes, radius)
        rows, words = np.nonzero(hits)
        if len(rows):
            lanes = np.unpackbits(hits[rows, words].view(np.uint8).reshape(-1, 8), axis=1,
                                  bitorder="little")
            k, bit = np.nonzero(lanes)
            other = words[k] * 64 + bit
            real = other < len(right)
            yield rows[k][real] + at, other[real]


def smallest_linked(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n vertices the smallest index that it is connected with by the pairs."""
    low = np.arange(n)
    for a, b in pairs:
        while True:
            x, y = low[a], low[b]
            differ = x != y
            if not differ.any():
                break
            m = np.minimum(x, y)[differ]
            np.minimum.at(low, np.maximum(x, y)[differ], m)
            while True:
                jumped = low[low]
                if (jumped == low).all():
                    break
                low = jumped
    return low


def masks(radius: int, bands: int) -> list[int]:
    """The bits in which a pair within the radius agrees, for each choice of its differing bands."""
    if bands <= radius:
        raise ValueError("there must be more bands than the radius")
    edges = [64 * i // bands for i in range(bands + 1)]
    band = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(band, bands - radius)]


def bands_for(n: int, radius: int = RADIUS) -> int:
    """The fewest bands whose choices spread n fingerprints over pools of the wanted size.

    More bands fix more bits at once and have more choices; any number finds the same pairs.
    """
    bands = radius + 1
    while bands < 16 and 64 * (bands - radius) // bands < math.log2(max(1, n / POOL)):
        bands += 1
    return bands


def links(prints: DataFrame, radius: int = RADIUS, bands: int | None = None) -> DataFrame:
    """Edges (src, dst) that connect all fingerprints within the radius, by their ids.

    `prints` has one row per distinct fingerprint: (id, print).  Each pool gives a row per linked
    member at most, to the smallest id that it is connected with there, however many pairs there
    are.  Pools are as many as the rows demand; one that holds a very frequent choice of bits is
    cut into blocks, and any two blocks meet.
    """
    n = prints.count()
    choices = masks(radius, bands or bands_for(n, radius))
    pools = max(1, -(-n * len(choices) // POOL))
    own = F.array_distinct(F.array(*[
        F.pmod(F.xxhash64(F.lit(i), F.col("print").bitwiseAND(F.lit(m - (m >> 63 << 64)))),
               F.lit(pools)) for i, m in enumerate(choices)]))
    dealt = prints.select("id", "print", F.explode(own).alias("pool"))

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        prints = table.column("print").to_numpy()[order].view(np.uint64)
        block = table.column("block").to_numpy()[order]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        pairs = ((left[a], right[b]) for a, b in
                 close_pairs(prints[left], prints[right], radius))
        low = smallest_linked(len(ids), pairs)
        linked = low != np.arange(len(ids))
        return pa.table({"src": ids[linked], "dst": ids[low[linked]]},
                        pa.schema([("src", pa.int64()), ("dst", pa.int64())]))

    return tiles(dealt, ["pool"], "print", BLOCK) \
        .groupBy("pool", "tile_i", "tile_j").applyInArrow(compare, "src long, dst long")


def grouped(df: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, print, component_id): near-duplicate groups of all rows of `df` (doc_id, text).

    Rows with the same fingerprint are one vertex, represented by their smallest doc_id, so that
    copies are never paired.  A null text is an empty one; texts without words have fingerprint 0.
    Rows without doc_id are linked with nothing and have no component_id; rows with the same doc_id
    are the same vertex.
    """
    prints = stored(df.select(F.col("doc_id").cast("long").alias("doc_id"),
                              fingerprints(F.col("text")).alias("print")), "fingerprints")
    distinct = stored(prints.filter("doc_id IS NOT NULL").groupBy("print")
                      .agg(F.min("doc_id").alias("id")), "distinct_prints")
    groups = components(links(distinct, radius))
    named = distinct.join(groups, "id", "left") \
        .select("print", F.coalesce("component_id", "id").alias("component"))
    return prints.join(named, "print", "left").select(
        "doc_id", "print",
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))


def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of each of the `documents`; repeated rows are repeated."""
    return grouped(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
