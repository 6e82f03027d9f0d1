"""Token ids in files of variable-length code words, ordered by document.

The ids get ranks by their frequency over the whole corpus, so that frequent ids are small numbers.
A rank takes one to four bytes.  Two bits say how many, and they stand apart from the bytes
themselves: a segment is

    magic "TIDS", u32 number of documents, u64 number of ids, u64 number of data bytes
    u8 per document: 1 if its doc_id is null
    i64 per document: doc_id (0 for null)
    u32 per document: its number of ids
    control bytes: four 2-bit lengths (less one) in each, lowest bits first
    data bytes: the ranks, little-endian, without leading zero bytes

all little-endian.  Segments are rows of a Parquet table, so that Spark's commit protocol stands
in for lost executors and any file system will do; `file_no` and `segment_no` order them by doc_id.
The table of ranks is written beside them.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jobsignal.llm.tables import documents, stored
from jobsignal.session import working_folder

#: Id that ends each document.
END_ID = 1
#: A segment is closed when it holds this many ids.
SEGMENT_IDS = 1 << 21
#: Words whose ids a worker remembers in each of two generations.
MEMO_WORDS = 400_000

_HEADER = struct.Struct("<4sIQQ")
#: Latin letters and signs, which composition leaves alone and whose lower case is the same in
#: every library; control characters, unusual spaces and the dotted capital I are left out.
_PLAIN = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x250)) if c not in (0xAD, 0x130)]
_LETTERS = "".join(c for c in _PLAIN if unicodedata.category(c).startswith("L"))
_NUMBERS = "".join(c for c in _PLAIN if unicodedata.category(c).startswith("N"))
_PLAIN_TEXT = re.compile(f"[ \\n\\t\\r{re.escape(''.join(_PLAIN))}]*")
#: The file's own splitting pattern, for such characters.
_PIECES = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]"
                     f"|[^ \\n\\t\\r{_LETTERS}{_NUMBERS}]+")
#: The characters that a word's bytes are shown as to the model: printable ones as themselves.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_CHARS = dict(zip((b for b in range(256) if b not in _PRINTABLE), map(chr, range(256, 512))))
_BYTE_CHARS.update((b, chr(b)) for b in _PRINTABLE)
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


class Memo(dict):
    """Values by key, made by `make` where unknown.

    When a generation has `size` keys a new one begins, and what the last one knew is kept if it
    is asked for while the new one fills: frequent keys stay, rare ones go.
    """

    def __init__(self, make: Callable[[str], bytes], size: int):
        super().__init__()
        self.make, self.size, self.last = make, size, {}

    def __missing__(self, key: str) -> bytes:
        value = self.last.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.size:
                self.last = dict(self)
                self.clear()
            self[key] = value
        return value


class WordEncoder:
    """A word tokenizer whose words are looked up, not encoded again.

    The splitting pattern never joins what white space divides, and a word's ids don't depend on
    its neighbours.  So plain Latin text in lower case is split here, and the model encodes each
    word that the worker doesn't remember; text with other characters goes to the library as it
    is, one line-free run between blanks at a time.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4")
        rules = json.loads(self.whole.to_str())
        self.plain = _SPLIT in str(rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]) \
            and [x["type"] for x in rules["normalizer"]["normalizers"]] \
            == ["NFC", "Replace", "Lowercase"]
        self.model = self.whole.model
        self.memo = Memo(self._word, MEMO_WORDS)

    def _bytes(self, text: str) -> bytes:
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        shown = word if word.isascii() else "".join(map(_BYTE_CHARS.__getitem__, word.encode()))
        return np.array([t.id for t in self.model.tokenize(shown)], self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, little-endian."""
        if self.plain and _PLAIN_TEXT.fullmatch(text):
            return b"".join(map(self.memo.__getitem__, _PIECES.findall(text.lower())))
        if not self.plain:
            return self._bytes(text)
        out = []
        for run in re.findall(r"[^ \n]+", text):
            out.append(b"".join(map(self.memo.__getitem__, _PIECES.findall(run.lower())))
                       if _PLAIN_TEXT.fullmatch(run) else self._bytes(run))
        return b"".join(out)


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def encoded(df: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian integers with the end id appended.

    A null text counts as empty and has the end id alone.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows = [encoder.encode(x.as_py() or "") + end for x in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"),
                     pa.array([len(x) // encoder.dtype.itemsize for x in rows], pa.int64()),
                     pa.array(rows, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(encode, "doc_id long, n_tokens long, ids binary")


def id_ranks(ids: DataFrame, width: int) -> DataFrame:
    """(id, rank): all ids that occur, the most frequent first, equal ones by id.

    Counted over all documents; a task sends one row per id.  The vocabulary bounds the result.
    """
    dtype = f"<u{width}"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for x in batch.column(0):
                more = np.bincount(np.frombuffer(x.as_py(), dtype))
                if len(more) > len(total):
                    more[:len(total)] += total
                    total = more
                else:
                    total[:len(more)] += more
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    counts = ids.select("ids").mapInArrow(count, "id long, n long") \
        .groupBy("id").agg(F.sum("n").alias("n"))
    # One row per id of the vocabulary, in one window.
    return counts.select("id", (F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1)
                         .cast("long").alias("rank"))


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of a run of ranks."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[:len(ranks)] = extra
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    used = np.arange(4, dtype=np.uint8)[None, :] <= extra[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


#: For each control byte the four lengths it stands for.
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
#: For each length the bits of a word that count.
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks again: lengths by table, then one four-byte word from each place, masked."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    raw = np.frombuffer(data + bytes(4), np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(raw, 4)[ends - lengths]
    return np.ascontiguousarray(words).view("<u4").reshape(-1) & _MASKS[lengths]


def _segment(doc_ids: list[int | None], counts: list[int], ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    return b"".join([
        _HEADER.pack(b"TIDS", len(doc_ids), len(ranks), len(data)),
        np.array([x is None for x in doc_ids], np.uint8).tobytes(),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
        np.array(counts, "<u4").tobytes(), control, data])


def read_segment(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, numbers of ids, and ranks of a segment."""
    magic, docs, ids, size = _HEADER.unpack_from(raw)
    if magic != b"TIDS":
        raise ValueError("not a segment of token ids")
    at = _HEADER.size
    nulls = np.frombuffer(raw, np.uint8, docs, at)
    doc_ids = np.frombuffer(raw, "<i8", docs, at + docs)
    counts = np.frombuffer(raw, "<u4", docs, at + 9 * docs)
    at += 13 * docs
    control = -(-ids // 4)
    ranks = unpack(raw[at:at + control], raw[at + control:at + control + size], ids)
    return [None if z else int(x) for x, z in zip(doc_ids, nulls)], counts.astype(np.int64), ranks


def write_files(df: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """Encode `df` (doc_id, text) and write its token files below `folder`.

    Texts are encoded once.  Their ids are counted, then dealt by range of doc_id and packed; rows
    without doc_id come first, and rows of the same doc_id are ordered by their ids.
    """
    width = _encoder(tokenizer_path).dtype.itemsize
    ids = stored(encoded(df, tokenizer_path, end_id), "ids")
    ranks = stored(id_ranks(ids, width), "ranks", f"{folder}/ranks")
    rank_of = np.zeros(1 << 16 if width == 2 else end_id + 1, np.uint32)
    for row in ranks.toLocalIterator():  # bounded by the vocabulary
        if row["id"] >= len(rank_of):
            rank_of = np.append(rank_of, np.zeros(row["id"] + 1, np.uint32))
        rank_of[row["id"]] = row["rank"]

    def pack_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_no, number = TaskContext.get().partitionId(), 0
        docs: list[int | None] = []
        counts: list[int] = []
        runs: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            raw = _segment(docs, counts, np.concatenate(runs))
            return pa.RecordBatch.from_arrays(
                [pa.array([file_no], pa.int64()), pa.array([number], pa.int64()),
                 pa.array([held], pa.int64()), pa.array([raw], pa.binary())],
                ["file_no", "segment_no", "n_tokens", "segment"])

        for batch in batches:
            for doc, x in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                docs.append(doc)
                runs.append(rank_of[np.frombuffer(x.as_buffer(), f"<u{width}")])
                counts.append(len(runs[-1]))
                held += counts[-1]
                if held >= SEGMENT_IDS:
                    yield close()
                    number, held = number + 1, 0
                    docs.clear(), counts.clear(), runs.clear()
        if docs:
            yield close()

    dealt = ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids") \
        .select("doc_id", "ids")
    dealt.mapInArrow(pack_range, "file_no long, segment_no long, n_tokens long, segment binary") \
        .write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/segments")


def segment_starts(spark: SparkSession, folder: str) -> DataFrame:
    """(file_no, segment_no, segment_start): the ids of all segments before each.

    Segments are added up per file, and only the totals of the files in one place.
    """
    sizes = spark.read.parquet(f"{folder}/segments").select("file_no", "segment_no", "n_tokens")
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = sizes.groupBy("file_no").agg(F.sum("n_tokens").alias("n")) \
        .select("file_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))
    inside = Window.partitionBy("file_no").orderBy("segment_no") \
        .rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))) \
        .join(files, "file_no") \
        .select("file_no", "segment_no",
                (F.col("file_start") + F.col("inside")).alias("segment_start"))


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the token files: (file_no, segment_no, doc_id, begin, n_tokens, ids).

    `begin` counts the ids before the document in its segment; `ids` are little-endian unsigned
    32-bit integers in a binary column.
    """
    id_of = np.array([r["id"] for r in spark.read.parquet(f"{folder}/ranks").orderBy("rank")
                      .toLocalIterator()], "<u4")  # bounded by the vocabulary

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file_no, number, x in zip(*(batch.column(i) for i in range(3))):
                docs, counts, ranks = read_segment(x.as_py())
                offsets = np.append(0, np.cumsum(counts))
                flat = id_of[ranks].tobytes()
                for a in range(0, len(docs), 1000):
                    b = min(a + 1000, len(docs))
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(file_no, b - a), pa.repeat(number, b - a),
                         pa.array(docs[a:b], pa.int64()), pa.array(offsets[a:b]),
                         pa.array(counts[a:b]),
                         pa.array([flat[4 * offsets[i]:4 * offsets[i + 1]] for i in range(a, b)],
                                  pa.binary())],
                        ["file_no", "segment_no", "doc_id", "begin", "n_tokens", "ids"])

    return spark.read.parquet(f"{folder}/segments").select("file_no", "segment_no", "segment") \
        .mapInArrow(decode, "file_no long, segment_no long, doc_id long, begin long, "
                            "n_tokens long, ids binary")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the token files of `documents` and return what is read back from them.

    Null and empty texts have the end id alone.  An empty table gives files without segments and
    no rows.  Further columns are not read.
    """
    folder = working_folder(spark, "token_files")
    write_files(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_files(spark, folder).withColumn("ids_crc32", F.crc32("ids")) \
        .join(segment_starts(spark, folder), ["file_no", "segment_no"]) \
        .select("doc_id", (F.col("segment_start") + F.col("begin")).alias("start"), "n_tokens",
                "ids_crc32")
