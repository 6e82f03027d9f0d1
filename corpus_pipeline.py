"""A corpus from raw documents to token ids: five stages, each written and read again.

Every stage but the last returns the columns of `documents`.  A stage works on all rows that its
predecessor kept, and reads nothing else.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.llm import byte_bpe, mixing, pii, repetition, simhash
from jobsignal.llm.tables import ship, stored
from jobsignal.session import working_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns of documents; with a new text also its number of characters.

    A column that the input lacks is null.
    """
    ship(docs.sparkSession)
    if text is not None:
        docs = docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    types = {"doc_id": "long", "n_chars": "long"}
    return docs.select(*[F.col(c) if c in docs.columns else
                         F.lit(None).cast(types.get(c, "string")).alias(c) for c in COLUMNS])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep; null and empty texts go, repeated rows stay."""
    return _documents(repetition.judged(_documents(docs)).filter("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one whose doc_id names the group.

    Rows without doc_id belong to no group and stay.  Of rows that repeat that doc_id the first by
    text, lang, source and n_chars stays.
    """
    docs = _documents(docs)
    leaders = simhash.grouped(docs).filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(leaders.hint("shuffle_hash"), "doc_id", "left_semi")
    once = named.groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("row")) \
        .select("doc_id", "row.*")
    return _documents(once.unionByName(docs.filter("doc_id IS NULL")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each span of personal data replaced by its kind in brackets.

    A null text stays null.  Spans travel with their texts, so that no row has to be found again.
    """
    docs = _documents(docs)
    good = pii.accepted_patterns(docs)
    spans = pii.spans_of(pii.proposed(F.col("text")), good)
    return _documents(docs, pii.redacted(F.col("text"), spans))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, document by document and pass by pass.

    A row is what one pass takes of a document: its whole text where all of its blocks are drawn,
    else the drawn parts.  A document of which two passes take something gives two rows with its
    doc_id; one of which nothing is taken gives none.
    """
    rows = stored(_documents(docs).withColumn("_row", F.monotonically_increasing_id()), "mix_rows")
    _, _, pieces = mixing.mixture(rows.select(
        F.col("_row").alias("doc_id"), "source", mixing.word_count(F.col("text")).alias("size")))
    parts = pieces.groupBy(F.col("doc_id").alias("_row"), "pass").agg(F.array_sort(F.collect_list(
        F.struct(F.col("first").cast("long").alias("first"),
                 F.col("last").cast("long").alias("last")))).alias("_parts"))
    taken = rows.join(parts.hint("shuffle_hash"), "_row")
    return _documents(taken, mixing.word_ranges(F.col("text"), F.col("_parts")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and the hashes of ids and decoded bytes of every row."""
    ship(spark)
    return byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

#: SimHash, the classifier, the permutations and the token ids have no counterpart in SQL; the
#: tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = working_folder(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
