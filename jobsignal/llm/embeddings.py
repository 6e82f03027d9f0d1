"""Near-duplicate vectors by binary codes that know their error.

A seeded random rotation is followed by the signs of the coordinates: one bit each.  With each code
goes a correction factor, the inner product of the unit vector and its code.  The code's inner
product with another rotated vector, divided by the factor, is an unbiased estimate of the cosine,
and the factor also bounds how far the estimate strays.  Pairs whose bound reaches the threshold
are computed again exactly.

All pairs of one length meet, in tiles of two blocks, and the bound is wide enough to hold for
certain, so that no link is lost.  The work grows with the square of the number of vectors; the
rows dealt grow with it too, divided by a block of `tile` rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.llm.simhash import smallest_linked
from jobsignal.llm.tables import components, ship, stored


@dataclass(frozen=True)
class Search:
    """`error` is the least number of standard deviations that the estimate's bound allows for.

    Vectors are dealt in blocks of `spread * block`, of which `block` are compared at a time.
    `recall` and `bucket` only belong to `bits` and `rotations`, the size of a search in buckets
    of leading signs; the links don't depend on it.
    """

    cosine: float = 0.9
    recall: float = 0.9995
    bucket: int = 1024
    block: int = 1024
    spread: int = 8
    error: float = 5.0
    seed: int = 42

    def bits(self, n: int, width: int) -> int:
        """Signs in a bucket's number: as many as make buckets of about `bucket` vectors."""
        return max(0, min(width, 30, math.ceil(math.log2(max(1, n / self.bucket)))))

    def certain(self, width: int) -> float:
        """Deviations that hold for certain for a pair at the threshold, `error` at least.

        The angle to the other's code is at most the pair's angle and the code's own together, so
        the estimate is at most sqrt(1 - cosine^2) sqrt(1 - factor^2) / factor below the threshold.
        """
        return max(self.error, math.sqrt((1 - self.cosine ** 2) * max(1, width - 1)))

    def rotations(self, bits: int) -> int:
        """Rotations after which a pair at the threshold shared a bucket with the wanted recall."""
        same = (1 - math.acos(self.cosine) / math.pi) ** bits
        if same >= 1:
            return 1
        return math.ceil(math.log(1 - self.recall) / math.log(1 - same))


def rotation(width: int, seed: int) -> np.ndarray:
    """A random rotation: the orthogonal part of a Gaussian matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, width]).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def codes(units: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors, their packed sign bits, and the correction factors."""
    rotated = units @ turn.T
    factors = np.abs(rotated).sum(axis=1) / math.sqrt(units.shape[1])
    return rotated, np.packbits(rotated >= 0, axis=1), factors


def estimates(bits: np.ndarray, factors: np.ndarray, rotated: np.ndarray,
              error: float) -> tuple[np.ndarray, np.ndarray]:
    """Cosines of coded and rotated vectors, estimated without bias, and the bounds' width."""
    width = rotated.shape[1]
    signs = np.unpackbits(bits, axis=1, count=width).astype(np.float32) * 2 - 1
    guess = (signs @ rotated.T.astype(np.float32)) / (math.sqrt(width) * factors[:, None])
    spread = np.sqrt(np.maximum(0, 1 - factors ** 2)) / factors / math.sqrt(max(1, width - 1))
    return guess, (error * spread)[:, None]


def close_pairs(left: np.ndarray, right: np.ndarray, search: Search,
                turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of unit vectors with at least the wanted cosine.

    A pair is computed exactly if both estimates, from either one's code, could reach it.  The
    estimates are in single precision, hence the slack.
    """
    error, slack = search.certain(left.shape[1]), 1e-4
    rotated_l, bits_l, factors_l = codes(left, turn)
    rotated_r, bits_r, factors_r = codes(right, turn)
    guess, bound = estimates(bits_l, factors_l, rotated_r, error)
    maybe = guess + bound >= search.cosine - slack
    guess, bound = estimates(bits_r, factors_r, rotated_l, error)
    maybe &= (guess + bound >= search.cosine - slack).T
    a, b = np.nonzero(maybe)
    keep = np.zeros(len(a), bool)
    for at in range(0, len(a), 1 << 16):
        part = slice(at, at + (1 << 16))
        keep[part] = np.einsum("ij,ij->i", left[a[part]], right[b[part]]) >= search.cosine
    return a[keep], b[keep]


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, width)


def _units(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that no square is lost."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _links(classes: DataFrame, width: int, n: int, search: Search) -> DataFrame:
    """(id, other, links) per tile: how many rows a class is linked with there, and the smallest
    class that the tile connects it with.

    Any two of the `n` classes meet in one tile.  A tile gives a row per class at most, however
    many pairs it has.
    """
    blocks = math.ceil(n / (search.spread * search.block))
    dealt = classes.select("id", "copies", "vector", F.pmod(
        F.xxhash64("id", F.lit("block")), F.lit(blocks)).cast("int").alias("block")) \
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))) \
        .withColumn("tile_i", F.least("block", "with")) \
        .withColumn("tile_j", F.greatest("block", "with")).drop("with")
    error_turn = rotation(width, search.seed)

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[0].as_py(), key[1].as_py()
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, copies = ids[order], table.column("copies").to_numpy()[order]
        units = _units(_matrix(table.column("vector"), width))[order]
        block = table.column("block").to_numpy()[order]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        total = np.zeros(len(ids), np.int64)

        def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for at in range(0, len(left), search.block):
                rows = left[at:at + search.block]
                for to in range(at if i == j else 0, len(right), search.block):
                    others = right[to:to + search.block]
                    a, b = close_pairs(units[rows], units[others], search, error_turn)
                    a, b = rows[a], others[b]
                    if i == j and at == to:
                        a, b = a[a < b], b[a < b]
                    np.add.at(total, a, copies[b])
                    np.add.at(total, b, copies[a])
                    yield a, b

        low = smallest_linked(len(ids), pairs())
        found = total > 0
        return pa.table({"id": ids[found], "other": ids[low[found]], "links": total[found]})

    return dealt.groupBy("tile_i", "tile_j") \
        .applyInArrow(compare, "id long, other long, links long")


def near_duplicates(vectors: DataFrame, search: Search = Search()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of `vectors` (vec_id, embedding).

    Equal vectors are one class, represented by its smallest vec_id, and are not paired; a class
    counts as many links as it has rows.  Vectors that are null, empty, zero, or hold a null or a
    component that isn't finite are linked with nothing, and so are rows without vec_id.  Vectors
    of different lengths aren't compared.
    """
    value = F.col("embedding").cast("array<double>")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce((F.size(value) > 0) & ~bad & F.exists(value, lambda x: x != 0),
                        F.lit(False)) & F.col("vec_id").isNotNull()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.when(usable, F.col("embedding")).alias("vector"))
    rows = stored(rows.withColumn("class", F.when(F.col("vector").isNotNull(), F.sha2(
        F.array_join(F.col("vector").cast("array<string>"), ","), 256))), "vectors")
    classes = stored(rows.filter("class IS NOT NULL").groupBy("class").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies"),
        F.first("vector").alias("vector")), "vector_classes")
    sizes = classes.groupBy(F.size("vector").alias("width")).count().collect()  # one per length
    parts = [_links(classes.filter(F.size("vector") == r["width"]), r["width"], r["count"], search)
             for r in sizes]
    if not parts:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                           F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    found = stored(found, "vector_links")
    groups = components(found.select(F.col("id").alias("src"), F.col("other").alias("dst")))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = classes.select("class", "id", "copies").join(groups, "id", "left") \
        .join(counts, "id", "left") \
        .select("class", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                F.coalesce("component_id", "id").alias("component"))
    return rows.select("vec_id", "class").join(named, "class", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op2_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all `embeddings`, whatever their labels."""
    ship(spark)
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet")
                           .select("vec_id", "embedding"))


#: The same rows in DuckDB: all pairs of usable vectors, then labels passed on until none changes.
SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
   AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT vec_id AS id, vec_id AS other FROM embeddings
  UNION
  SELECT r.id, p.b FROM reach r JOIN pairs p ON r.other = p.a),
least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON id = e.vec_id LEFT JOIN links ON a = e.vec_id"""
