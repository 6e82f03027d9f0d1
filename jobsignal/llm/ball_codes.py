"""Vectors compressed to one byte a part, with codebooks from ball k-means.

A vector of integers is cut into equal parts, and each part position has a codebook.  The parts
that share an entry form a ball around it.  Half the distance between two entries tells what an
update can change: an entry further away than twice a ball's radius is no neighbour of it; a part
in the ball's stable core, nearer to its entry than half the way to any other, keeps it unseen; in
the ring between two such half-ways a part is compared with the neighbours up to there, and no
others.  Everything is computed in integers, so the result is that of comparing all entries.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.llm.tables import ship, stored


@dataclass(frozen=True)
class Codes:
    """`entries` is at most 256, since a code is a byte."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256

    def largest(self, width: int) -> int:
        """Integers up to this have squared distances that leave room for an entry's number."""
        return math.isqrt((1 << 54) // max(1, width)) // 2


def squares(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, row by row."""
    return ((parts - entries) ** 2).sum(axis=-1)


def nearest(parts: np.ndarray, book: np.ndarray, rows: int = 4096) -> np.ndarray:
    """The nearest entry of each part among all; the first one of a tie."""
    found = [squares(parts[i:i + rows, None], book[None]).argmin(axis=1)
             for i in range(0, len(parts), rows)]
    return np.concatenate(found or [np.empty(0, np.int64)])


def moved(parts: np.ndarray, book: np.ndarray, codes: np.ndarray,
          pairs: int = 1 << 18) -> tuple[np.ndarray, int]:
    """The nearest entry of each part, given the entries it had before `book` changed, and the
    number of distances computed for it.

    The parts may be any share of a ball: its radius is then that of the share.
    """
    k = len(book)
    own = squares(parts, book[codes])
    between = squares(book[:, None], book[None])
    order = np.argsort(between, axis=1, kind="stable")
    apart = np.take_along_axis(between, order, axis=1)
    after = codes.copy()
    computed = len(parts)
    by_entry = np.argsort(codes, kind="stable")
    bounds = np.searchsorted(codes[by_entry], np.arange(k + 1))
    for e in range(k):
        members = by_entry[bounds[e]:bounds[e + 1]]
        if not len(members):
            continue
        reach = 4 * own[members]
        # the ball's neighbours, nearest first, its own entry among them
        near = apart[e][:np.searchsorted(apart[e], reach.max(), side="right")]
        ring = np.searchsorted(near, reach, side="right")
        members, ring = members[ring > 1], ring[ring > 1]
        step = max(1, pairs // max(1, len(near)))
        for at in range(0, len(members), step):
            some, many = members[at:at + step], ring[at:at + step]
            start = np.cumsum(many) - many
            row = np.repeat(some, many)
            entry = order[e][np.arange(len(row)) - np.repeat(start, many)]
            key = squares(parts[row], book[entry]) * k + entry
            after[some] = np.minimum.reduceat(key, start) % k
            computed += len(row)
    return after, computed


def _batch(batch: pa.RecordBatch, c: Codes) -> np.ndarray:
    """The batch's integers as (row, part, component)."""
    flat = batch.column("ints").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, c.parts, -1)


def _old(batch: pa.RecordBatch, c: Codes) -> np.ndarray:
    flat = b"".join(batch.column("codes").to_pylist())
    return np.frombuffer(flat, np.uint8).reshape(-1, c.parts).astype(np.int64)


def assigned(rows: DataFrame, books: np.ndarray, c: Codes) -> DataFrame:
    """Add or renew `codes` (a byte a part) and `error`, the squared distances of all parts."""
    kept = [x for x in rows.columns if x not in ("codes", "error")]
    first = "codes" not in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            parts = _batch(b, c)
            codes = np.zeros(parts.shape[:2], np.int64) if first else _old(b, c)
            error = np.zeros(len(parts), np.int64)
            for p in range(c.parts):
                codes[:, p] = nearest(parts[:, p], books[p]) if first else \
                    moved(parts[:, p], books[p], codes[:, p])[0]
                error += squares(parts[:, p], books[p][codes[:, p]])
            packed = [x.tobytes() for x in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(x) for x in kept), pa.array(packed, pa.binary()), pa.array(error)],
                [*kept, "codes", "error"])

    plain = rows.select(*kept)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
    return rows.mapInArrow(run, f"{kinds}, codes binary, error long")


def updated(rows: DataFrame, books: np.ndarray, c: Codes) -> np.ndarray:
    """The codebooks after each entry moved to the floor of its parts' mean; unused ones stay.

    A task adds up its rows to one row an entry; the driver fetches the entries' sums, whose
    number is that of the codebooks' components.
    """
    k, width = books.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((c.parts * k, width), np.int64)
        counts = np.zeros(c.parts * k, np.int64)
        for b in batches:
            slot = (_old(b, c) + np.arange(c.parts) * k).ravel()
            np.add.at(sums, slot, _batch(b, c).reshape(-1, width))
            counts += np.bincount(slot, minlength=c.parts * k)
        used = np.flatnonzero(counts)
        slots, at = np.repeat(used, width), np.tile(np.arange(width), len(used))
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots), pa.array(at), pa.array(sums[used].ravel()),
             pa.array(np.repeat(counts[used], width))], ["slot", "at", "total", "n"])

    found = rows.select("ints", "codes").mapInArrow(run, "slot long, at long, total long, n long") \
        .groupBy("slot", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                                   F.sum("n").alias("n")).collect()
    out = books.copy()
    for r in found:
        out[r["slot"] // k, r["slot"] % k, r["at"]] = int(r["total"]) // r["n"]
    return out


def integers(df: DataFrame, c: Codes = Codes(), vector: str = "embedding") -> DataFrame:
    """(vec_id, label, ints) of the vectors that can be coded.

    Left out are vectors that are null or empty, hold null or non-finite components or such as
    leave no room for exact distances (`Codes.largest`), or can't be cut into `parts`.
    """
    v = F.col(vector)
    width = F.size(v)
    most = c.largest(1) / c.scale
    ints = F.transform(v, lambda x: F.floor(x.cast("double") * c.scale).cast("long"))
    small = F.forall(v, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) * F.sqrt(width.cast("double")) <= most),
        F.lit(False)))
    fit = v.isNotNull() & (width > 0) & (width % c.parts == 0)
    return df.select("vec_id", "label", F.when(fit & small, ints).alias("ints")) \
        .filter(F.col("ints").isNotNull())


def compressed(df: DataFrame, c: Codes = Codes(), vector: str = "embedding") \
        -> tuple[DataFrame, np.ndarray | None]:
    """(vec_id, label, codes, error) of the vectors in `df`, and the codebooks.

    `df` has vec_id, label and `vector`.  The codebooks start from the smallest vec_ids, fewer
    than `entries` if there are no more; of equal ids the vector that is smaller component by
    component comes first, and rows without an id come last.  Vectors as long as the first of
    these are coded, and those that `integers` leaves out or that have another length are not.
    Repeated rows are coded alike and count as often as they occur.  Without a vector to code
    there are no rows, and no codebooks.  The codebooks, `parts * entries` parts of a vector, go
    to every task.
    """
    spark = df.sparkSession
    ship(spark)
    rows = stored(integers(df, c, vector), "vectors")
    order = [F.col("vec_id").asc_nulls_last(), F.col("ints")]
    lead = rows.orderBy(*order).limit(1).collect()
    if not lead:
        return rows.select("vec_id", "label", F.lit(b"").alias("codes"),
                           F.lit(0).cast("long").alias("error")), None
    rows = rows.filter(F.size("ints") == len(lead[0]["ints"]))
    start = np.array([r["ints"] for r in rows.orderBy(*order).limit(c.entries).collect()],
                     np.int64)
    books = start.reshape(len(start), c.parts, -1).transpose(1, 0, 2).copy()
    for _ in range(c.rounds):
        rows = stored(assigned(rows, books, c), "codes")
        books = updated(rows, books, c)
    return assigned(rows, books, c).select("vec_id", "label", "codes", "error"), books


def decompressed(codes: bytes, books: np.ndarray, c: Codes = Codes()) -> np.ndarray:
    """The vector that a code stands for: the middle of the cells of its entries' integers."""
    entries = [book[e] for book, e in zip(books, codes)]
    return (np.concatenate(entries) + 0.5) / c.scale


def fingerprint(books: np.ndarray | None) -> str:
    numbers = [] if books is None else books.ravel().tolist()
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def op11_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all `embeddings`; an empty table gives no rows.

    Errors are added up per label, rows without a label together; the sums, a row a label, are
    written, so that the planner knows their size and broadcasts them only if they are small.
    """
    rows, books = compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    rows = stored(rows, "coded")
    totals = stored(rows.groupBy("label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).alias("total")), "label_errors") \
        .select(F.col("label").alias("_label"), F.expr("try_cast(total AS bigint)").alias("total"))
    return rows.join(totals, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", F.lower(F.hex("codes")).alias("code"), "error",
        F.col("total").alias("label_error"), F.lit(fingerprint(books)).alias("codebooks_sha256"))


def _sql(c: Codes = Codes()) -> str:
    """The same rows in DuckDB, from all distances."""

    def nearest_entries(n: int) -> str:
        return f"""
a{n} AS MATERIALIZED (
  SELECT r, p, min(struct_pack(d := list_sum(list_transform(list_zip(x, y),
                                        lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT,
                               e := e)) AS best
  FROM parts JOIN b{n} USING (p) GROUP BY r, p),"""

    def next_entries(n: int) -> str:
        return f"""
s{n} AS (
  SELECT p, e, i, sum(v)::BIGINT AS s, count(*) AS n FROM (
    SELECT p, best.e AS e, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS v
    FROM a{n} JOIN parts USING (r, p)) GROUP BY p, e, i),
b{n + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(z, y) AS y FROM b{n} LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS z FROM s{n} GROUP BY p, e)
  USING (p, e)),"""

    rounds = "".join(nearest_entries(i) + next_entries(i) for i in range(c.rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label, embedding
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT r, p, list_transform(embedding[p * len(embedding) // {c.parts} + 1:
                                        (p + 1) * len(embedding) // {c.parts}],
                              lambda x: floor(x::DOUBLE * {c.scale})::BIGINT) AS x
  FROM kept, range({c.parts}) AS t(p)),
b0 AS MATERIALIZED (SELECT p, r AS e, x AS y FROM parts WHERE r < {c.entries}),{rounds}{
    nearest_entries(c.rounds)}
coded AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code,
         sum(best.d)::BIGINT AS error
  FROM a{c.rounds} GROUP BY r),
book AS (
  SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, e, i)) AS h FROM (
    SELECT p, e, unnest(range(1, len(y) + 1)) AS i, unnest(y) AS v FROM b{c.rounds}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       h AS codebooks_sha256
FROM coded JOIN kept USING (r), book"""


SQL = _sql()
