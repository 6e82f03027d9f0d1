"""The pipeline's stages, each against a plain version on the same input."""

import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline
from jobsignal.llm import byte_bpe, mixing, pii, repetition, simhash
from tests.llm.test_tables import smallest_reachable

STAGE = dict(corpus_pipeline.STAGES)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tuples(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def docs(spark, sf_dir, tmp_path_factory):
    """The edge cases and the small table of documents."""
    path = str(tmp_path_factory.mktemp("docs"))
    columns = list(corpus_pipeline.COLUMNS)
    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*columns)
    edge = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)
    small.withColumn("doc_id", small.doc_id + 1000).unionByName(edge).write.mode("overwrite") \
        .parquet(path)
    return spark.read.parquet(path)


def test_quality(spark, docs):
    got = Counter(tuples(corpus_pipeline.quality(spark, docs, "")))
    verdict = Counter()
    for r in tuples(docs):
        n, chars, _, _, repeated, spanned, longest = repetition.measure(r[1] or "")
        if n >= 10 and 100 * repeated <= 20 * n and 100 * spanned <= 30 * chars and longest <= 50:
            verdict[r] += 1
    assert got == verdict and 0 < sum(got.values()) < docs.count()


def test_near_duplicates(spark, docs):
    rows = tuples(docs)
    prints = [(r[0], simhash.fingerprint(r[1] or "")) for r in rows if r[0] is not None]
    low = smallest_reachable({d for d, _ in prints}, [
        (a, b) for a, x in prints for b, y in prints if (x ^ y).bit_count() <= 4])
    leaders = {d for d in low if low[d] == d}
    got = tuples(corpus_pipeline.near_duplicates(spark, docs, ""))
    assert Counter(r[0] for r in got) == Counter({d: 1 for d in leaders} |
                                                 {None: sum(r[0] is None for r in rows)})
    assert not Counter(got) - Counter(rows)
    assert len(got) < len(rows)


def test_personal_data(spark, docs):
    rows = tuples(docs)
    got = tuples(corpus_pipeline.personal_data(spark, docs, ""))
    found = Counter(f"{k}:{pii.votes(r[1], k, a, b)}:{pii.shape(r[1][a:b])}"
                    for r in rows if r[1] for k, a, b in pii.proposals(r[1]))
    good = set(pii.accepted(dict(sorted(found.items()))))
    want = Counter()
    for d, t, lang, source, n in rows:
        if t is not None:
            at, out = 0, ""
            for k, a, b in pii.proposals(t):
                take = k in pii.BASE or f"{k}:{pii.votes(t, k, a, b)}:{pii.shape(t[a:b])}" in good
                if take and a >= at:
                    out += t[at:a] + f"[{k.upper()}]"
                    at = b
            t = out + t[at:]
        want[d, t, lang, source, None if t is None else len(t)] += 1
    assert Counter(got) == want
    assert any(t and "[EMAIL]" in t for _, t, _, _, _ in got)


def test_mixing(spark, docs):
    rows = tuples(docs)
    got = tuples(corpus_pipeline.mix_sources(spark, docs, ""))
    assert Counter(got) == Counter(tuples(corpus_pipeline.mix_sources(spark, docs, "")))
    size = {}
    for r in rows:
        size[r[3]] = size.get(r[3], 0) + len(WORD.findall(r[1] or ""))
    took = Counter()
    by_id = {}
    for r in rows:
        by_id.setdefault(r[0], []).append(r)
    for d, t, lang, source, n in got:
        assert n == len(t)
        took[source] += len(WORD.findall(t))
        assert any(x[2:4] == (lang, source) and
                   (t == x[1] or not Counter(WORD.findall(t)) - Counter(WORD.findall(x[1] or "")))
                   for x in by_id[d])
    targets = {r["source"]: r["target"] for r in mixing.source_targets(
        docs.select("source", mixing.word_count(docs.text).alias("size"))).collect()}
    for s in size:
        assert abs(took[s] - targets[s]) <= 2 * mixing.Mix().block_words


def test_word_ranges(spark):
    df = spark.createDataFrame([
        (" a b\n c ", [(0, 3)]), (" a b\n c ", [(0, 1), (1, 3)]), ("a b c d", [(0, 1), (2, 4)]),
        ("a b c d", [(1, 2), (2, 3)]), (None, [])],
        "t string, r array<struct<first:long,last:long>>")
    got = [r[0] for r in df.select(mixing.word_ranges(df.t, df.r)).collect()]
    assert got == [" a b\n c ", " a b\n c ", "a\nc d", "b c", ""]


def test_encoding(spark, docs):
    enc = byte_bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            public_tokenizers.PATTERN)

    def sha(b):
        return hashlib.sha256(b).hexdigest()

    want = Counter()
    for r in tuples(docs):
        ids = enc.encode_ordinary(r[1] or "")
        want[r[0], len(ids), sha(" ".join(map(str, ids)).encode()), sha((r[1] or "").encode())] += 1
    assert Counter(tuples(corpus_pipeline.encode(spark, docs, ""))) == want


def test_run_applies_the_stages_in_order(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        held = stage(spark, rows, sf_dir)
        rows = spark.createDataFrame(held.collect(), held.schema)
    assert Counter(tuples(corpus_pipeline.run(spark, sf_dir))) == Counter(tuples(rows))


@pytest.mark.parametrize("name", list(STAGE))
def test_stages_on_empty_tables_and_with_other_columns(spark, empty_dir, sf_dir, name):
    empty = spark.read.parquet(f"{empty_dir}/documents.parquet")
    out = STAGE[name](spark, empty, "")
    assert out.collect() == []
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == list(corpus_pipeline.COLUMNS)
        wide = spark.read.parquet(f"{sf_dir}/documents.parquet")
        assert STAGE[name](spark, wide, "").columns == list(corpus_pipeline.COLUMNS)
