"""Fill-in-middle by secondary sort: texts are assembled from pieces that arrive in order.

A text is cut into lines, and two numbers from its id choose where its prefix and its middle end.
Its pieces, runs of whole lines of a bounded size, are keyed by document and by their place in the
output.  One shuffle deals the documents out, a sort within each partition brings their pieces into
output order, and a task streams them by: it never holds more than a batch of pieces, however long
a text is.  Restoration reads the output alone: passing the marks, it gives each piece its place
in the text, and a second sort within the same partitions streams them in that order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.llm.tables import documents, ship

PREFIX, SUFFIX, MIDDLE = MARKS = (b"<P>", b"<S>", b"<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Rule:
    """`rate` per cent of the texts are transformed, and `spm` per cent of these suffix first."""

    seed: str = "7"
    rate: int = 100
    spm: int = 50
    #: Lines go into one piece up to this many bytes; a longer line is cut.
    piece_bytes: int = 1 << 16


@dataclass(frozen=True)
class Cut:
    """Where a text is cut: byte offsets of the prefix's and the middle's end."""

    units: int
    form: str
    prefix: int = 0
    middle: int = 0

    def sections(self, raw: bytes) -> list[bytes]:
        """The output as marks and sections, in order."""
        if self.form == PLAIN:
            return [raw]
        first, second, last = raw[:self.prefix], raw[self.prefix:self.middle], raw[self.middle:]
        if self.form == PSM:
            return [PREFIX, first, SUFFIX, last, MIDDLE, second]
        return [SUFFIX, last, PREFIX, first, MIDDLE, second]


def line_ends(raw: bytes) -> np.ndarray:
    """Byte offsets after each line; the last line may lack its line feed."""
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    return ends if raw.endswith(b"\n") or not raw else np.append(ends, len(raw))


def cut(doc_id: int | None, raw: bytes, rule: Rule = Rule()) -> Cut:
    """Form and cuts of a text; a missing id counts as an empty one."""
    ends = line_ends(raw)
    n = len(ends)
    digest = hashlib.sha256(f"{rule.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    if not raw or any(m in raw for m in MARKS) or h3 % 100 >= rule.rate:
        return Cut(n, PLAIN)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    after = np.concatenate([[0], ends])
    return Cut(n, SPM if h4 % 100 < rule.spm else PSM, int(after[a]), int(after[b]))


def pieces_of(section: bytes, size: int) -> list[bytes]:
    """Runs of whole lines of up to `size` bytes; a line that is longer is cut."""
    if len(section) <= size:
        return [section] if section else []
    ends, out, at = line_ends(section), [], 0
    while at < len(section):
        i = int(np.searchsorted(ends, at + size, side="right")) - 1
        end = int(ends[i]) if i >= 0 and ends[i] > at else min(at + size, len(section))
        out.append(section[at:end])
        at = end
    return out


def _chars(raw: bytes) -> int:
    return len(raw) - int(np.count_nonzero(np.frombuffer(raw, np.uint8) & 0xC0 == 0x80))


#: A document's first row, at place -1, has its facts; the others have a piece each.
HEAD = pa.schema([("row", pa.int64()), ("at", pa.int64()), ("piece", pa.binary()),
                  ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
                  ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                  ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
KINDS = "row long, at long, piece binary, doc_id long, n long, form string, prefix_chars long, " \
    "middle_chars long, output_sha256 string, restored_sha256 string"
FACTS = HEAD.names[3:]


def _batches(rows: Iterator[dict], size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as batches of up to about `size` bytes of pieces."""
    held, weight = [], 0
    for r in rows:
        held.append(r)
        weight += len(r["piece"] or b"") + 64
        if weight >= size:
            yield pa.RecordBatch.from_pylist(held, HEAD)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, HEAD)


def pieces(df: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The output pieces of all texts, each keyed by its row of `df` and its place.

    Equal ids and equal rows are documents of their own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for b in batches:
                for row, doc_id, text in zip(*(b.column(c) for c in ("row", "doc_id", "text"))):
                    raw, doc_id = (text.as_py() or "").encode(), doc_id.as_py()
                    c = cut(doc_id, raw, rule)
                    plain = c.form == PLAIN
                    row = row.as_py()
                    yield {"row": row, "at": -1, "doc_id": doc_id, "n": c.units, "form": c.form,
                           "piece": None,
                           "prefix_chars": None if plain else _chars(raw[:c.prefix]),
                           "middle_chars": None if plain else _chars(raw[c.prefix:c.middle])}
                    at = 0
                    for section in c.sections(raw):
                        for piece in pieces_of(section, rule.piece_bytes):
                            yield {"row": row, "at": at, "piece": piece}
                            at += 1

        return _batches(rows())

    return df.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"),
                     "text").mapInArrow(run, KINDS)


def _streamed(batches: Iterator[pa.RecordBatch],
              visit: Callable[[dict, Iterator[bytes]], Iterator[dict]]) -> Iterator[dict]:
    """What `visit` makes of each document: its head and its pieces as they come by."""
    def rows() -> Iterator[dict]:
        for b in batches:
            facts = b.select(FACTS)
            for i, at in enumerate(b.column("at").to_pylist()):
                head = {"row": b.column("row")[i].as_py()} | facts.slice(i, 1).to_pylist()[0] \
                    if at < 0 else None
                yield head, b.column("piece")[i].as_py()

    source = rows()
    waiting = next(source, None)

    def rest() -> Iterator[bytes]:
        nonlocal waiting
        for waiting in source:
            if waiting[0]:
                return
            yield waiting[1]
        waiting = None

    while waiting:
        yield from visit(waiting[0], rest())


def assembled(cut_up: DataFrame) -> DataFrame:
    """Digest every output, and give its pieces their places in the restored text.

    The places are found from the output and its form alone: a mark says which section begins.
    """
    def visit(head: dict, arriving: Iterator[bytes]) -> Iterator[dict]:
        digest, section = hashlib.sha256(), 0
        marked = head["form"] != PLAIN
        for at, piece in enumerate(arriving):
            digest.update(piece)
            if marked and piece in MARKS:
                section = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}[piece]
            else:
                yield {"row": head["row"], "at": (section << 48) + at, "piece": piece}
        yield head | {"at": -1, "piece": None, "output_sha256": digest.hexdigest()}

    return cut_up.repartition("row").sortWithinPartitions("row", "at") \
        .mapInArrow(lambda batches: _batches(_streamed(batches, visit)), KINDS)


def restored(outputs: DataFrame) -> DataFrame:
    """A row per document: facts and digests of its output and of the text rebuilt from it."""
    def visit(head: dict, arriving: Iterator[bytes]) -> Iterator[dict]:
        digest = hashlib.sha256()
        for piece in arriving:
            digest.update(piece)
        yield head | {"at": -1, "piece": None, "restored_sha256": digest.hexdigest()}

    return outputs.sortWithinPartitions("row", "at") \
        .mapInArrow(lambda batches: _batches(_streamed(batches, visit)), KINDS).select(*FACTS)


def transformed(df: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, form, output): the output texts themselves, for a training set.

    Each text is whole in one row, as it is in `df`, so nothing is shuffled.
    """
    kind = "doc_id long, form string, output string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id")
            raws = [(x.as_py() or "").encode() for x in b.column("text")]
            cuts = [cut(i.as_py(), raw, rule) for i, raw in zip(ids, raws)]
            outs = [b"".join(c.sections(raw)).decode() for c, raw in zip(cuts, raws)]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([c.form for c in cuts], pa.string()), pa.array(outs, pa.string())],
                ["doc_id", "form", "output"])

    return df.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kind)


def restore(output: str, form: str) -> str:
    """The text that an output was made from."""
    if form == PLAIN:
        return output
    p, s, m = (x.decode() for x in MARKS)
    rest, middle = output.split(m)
    one, two = (p, s) if form == PSM else (s, p)
    first, second = rest.removeprefix(one).split(two)
    prefix, suffix = (first, second) if form == PSM else (second, first)
    return prefix + middle + suffix


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms, cuts and digests of all `documents`; an empty table gives no rows.

    A null text is an empty one, and an empty text or one that holds a mark stays plain.
    """
    return restored(assembled(pieces(documents(spark, sf_dir))))


def _sql(rule: Rule = Rule()) -> str:
    """The same rows in DuckDB."""
    def h(i: int) -> str:
        return f"CAST('0x' || substr(digest, {8 * i + 1}, 8) AS BIGINT)"

    p, s, m = (x.decode() for x in MARKS)
    held = " OR ".join(f"contains(text, '{x}')" for x in (p, s, m))
    return f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
         sha256('{rule.seed}:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
units AS (
  SELECT *, CASE WHEN text = '' THEN [] WHEN text[-1] = chr(10) THEN all_lines[:-2]
                 ELSE all_lines END AS lines
  FROM (SELECT *, string_split(text, chr(10)) AS all_lines FROM texts)),
counted AS (
  SELECT doc_id, text, lines, len(lines)::BIGINT AS n,
         least({h(0)} % (len(lines) + 1), {h(1)} % (len(lines) + 1)) AS a,
         greatest({h(0)} % (len(lines) + 1), {h(1)} % (len(lines) + 1)) AS b,
         CASE WHEN text = '' OR {held} OR {h(2)} % 100 >= {rule.rate} THEN '{PLAIN}'
              WHEN {h(3)} % 100 < {rule.spm} THEN '{SPM}' ELSE '{PSM}' END AS form
  FROM units),
-- a line feed follows every line but the text's last, so lengths and not joins give the cuts
placed AS (
  SELECT *, least(length(text), coalesce(list_sum(list_transform(lines[:a], lambda x: length(x) + 1)), 0))
              ::BIGINT AS i,
         least(length(text), coalesce(list_sum(list_transform(lines[:b], lambda x: length(x) + 1)), 0))
              ::BIGINT AS j
  FROM counted),
parts AS (
  SELECT doc_id, n, form, i, j, text, substr(text, 1, i) AS pre, substr(text, i + 1, j - i) AS mid,
         substr(text, j + 1) AS suf
  FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> '{PLAIN}' THEN i END AS prefix_chars,
       CASE WHEN form <> '{PLAIN}' THEN j - i END AS middle_chars,
       sha256(CASE form WHEN '{PLAIN}' THEN text
                        WHEN '{PSM}' THEN '{p}' || pre || '{s}' || suf || '{m}' || mid
                        ELSE '{s}' || suf || '{p}' || pre || '{m}' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""


SQL = _sql()
