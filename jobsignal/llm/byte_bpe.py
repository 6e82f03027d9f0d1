"""Byte-level BPE with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsignal.llm.tables import documents

#: Characters after which a longer text is cut at the next safe boundary.
PIECE = 1 << 16
#: Rows whose ids and bytes a worker holds at a time.
VISIT_ROWS = 256
#: Every match of the splitting pattern ends between such characters, whatever stands around.
_PLAIN_BOUNDARY = re.compile(r"(?<=[A-Za-z0-9])(?=[ \n])")
_BOUNDARY = regex.compile(r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})")


@lru_cache(maxsize=4)
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """One encoder per Python worker; `ranks_path` is a file on every machine."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Cut a long text where the pattern always ends a match, at least `size` characters apart.

    After a letter that no letter follows (or a digit that no digit follows) a match has ended and
    the next begins: letters and digits are matched greedily, and the only look-ahead of the
    pattern concerns runs of white space, which such a cut never divides.  A text without such a
    place is one run and stays whole.
    """
    start = 0
    while len(text) - start > size:
        cut = _PLAIN_BOUNDARY.search(text, start + size, start + 5 * size) \
            or _BOUNDARY.search(text, start + size)
        if not cut or cut.start() >= len(text):
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def ids_of(enc: tiktoken.Encoding, text: str, size: int = PIECE) -> np.ndarray:
    if len(text) <= size:
        return enc.encode_to_numpy(text, disallowed_special=())
    return np.concatenate([enc.encode_to_numpy(x, disallowed_special=())
                           for x in pieces(text, size)])


def token_ids(text: Column, ranks_path: str, pattern: str = public_tokenizers.PATTERN,
              size: int = PIECE) -> Column:
    """Ids of a text as array<int>; a null or empty text has none."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoding(ranks_path, pattern)
        for texts in batches:
            rows = [ids_of(enc, x.as_py() or "", size).astype(np.int32) for x in texts]
            ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
            flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return encode(text)


def decoded_bytes(ids: Column, ranks_path: str,
                  pattern: str = public_tokenizers.PATTERN) -> Column:
    """Bytes of an id list: the tokens' raw bytes, one after another; null ids give no bytes.

    Ids need not end at a character, so the result is binary and not text.
    """

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoding(ranks_path, pattern)
        for lists in batches:
            yield pa.array([enc.decode_bytes(x.values.to_numpy().tolist() if x.is_valid else [])
                            for x in lists], pa.binary())

    return decode(ids)


def encode(df: DataFrame, ranks_path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the ids of `text`; a column of the name `out` is replaced, all others stay."""
    return df.withColumn(out, token_ids(F.col(text), ranks_path))


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that `ids` stand for; a column of the name `out` is replaced."""
    return df.withColumn(out, decoded_bytes(F.col(ids), ranks_path))


def round_trip(df: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids",
               decoded: str = "decoded", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Replace `text` by its ids and by the bytes decoded from them, in one visit.

    Some rows at a time leave the worker, so that neither the ids nor the bytes of a whole batch
    are held.  Columns named like the new ones are replaced.
    """
    kept = [f for f in df.schema if f.name not in (text, ids, decoded)]
    schema = T.StructType([*kept, T.StructField(ids, T.ArrayType(T.IntegerType())),
                           T.StructField(decoded, T.BinaryType())])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, VISIT_ROWS):
                part = batch.slice(start, VISIT_ROWS)
                lists = [ids_of(enc, x.as_py() or "") for x in part.column(text)]
                ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
                flat = pa.array(np.concatenate(lists).astype(np.int32))
                back = [enc.decode_bytes(x.tolist()) for x in lists]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(f.name) for f in kept],
                     pa.ListArray.from_arrays(pa.array(ends), flat), pa.array(back, pa.binary())],
                    [*[f.name for f in kept], ids, decoded])

    return df.select(*[f.name for f in kept], text).mapInArrow(visit, schema)


def digests(df: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens and the hashes of the ids and of the decoded bytes, one row per row.

    Null and empty texts have no tokens and the hashes of nothing; repeated rows are repeated; an
    empty table gives an empty one; further columns are not read.
    """
    both = round_trip(df.select("doc_id", "text"), ranks_path)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))
