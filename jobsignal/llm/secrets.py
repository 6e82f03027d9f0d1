"""Secret scans with a ledger of blobs.

Every version of every path is addressed by the hash of its content.  The ledger keeps, for each
blob and version of the rules, what was found; a run scans only the pairs it doesn't have, and the
findings reach all paths of a blob by a join.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.llm.tables import documents
from jobsignal.session import working_folder


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  `group` of a match must have `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        """Leftmost matches that don't overlap; those too short are dropped afterwards."""
        for m in re.compile(self.pattern, re.ASCII).finditer(text):
            a, b = m.span(self.group)
            if b - a >= self.least:
                yield m.span()


#: The kinds that every scan has, in the order of ties.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                   r"""([A-Za-z0-9+/_.=-]+)""", 1, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: Further kinds: key blocks and tokens with a prefix of their issuer.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    # A first part without the others is consumed as well, so that a long run is tried once; the
    # group is empty then, and the match too short.
    Rule("web_token", r"\beyJ[A-Za-z0-9_-]{8,}"
                      r"(\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})?", 1, 1),
    Rule("hosted_token", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,})"),
)
RULES = BASE + MORE

SPAN = "struct<kind:string,start:int,end:int>"


def rules_version(rules: tuple[Rule, ...]) -> str:
    """Changes with any rule."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def scan(text: str, rules: tuple[Rule, ...] = RULES) -> list[tuple[str, int, int]]:
    """All spans of a text by start, then kind as listed; code points, end exclusive."""
    found = [(a, k, rule.kind, b) for k, rule in enumerate(rules) for a, b in rule.spans(text)]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def found_spans(text: Column, rules: tuple[Rule, ...]) -> Column:
    """The spans of a text as an array of structs."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    @F.arrow_udf(f"array<{SPAN}>")
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([[dict(zip(("kind", "start", "end"), s))
                             for s in scan(x.as_py() or "", rules)] for x in texts], kind)

    return spans(text)


class Ledger:
    """Folders of Parquet: versions (path, blob), and per version of the rules (blob, spans).

    A version's part is replaced when its run is repeated.  Scans are appended, and a repeated run
    only finds fewer blobs unseen.
    """

    def __init__(self, spark: SparkSession, folder: str, rules: tuple[Rule, ...] = RULES):
        self.spark, self.folder, self.rules = spark, folder, rules
        self.scans_path = f"{folder}/scans/rules={rules_version(rules)}"

    def versions(self, version: str) -> DataFrame:
        return self.spark.read.schema("path long, blob binary") \
            .parquet(f"{self.folder}/versions/version={version}")

    def scans(self) -> DataFrame:
        """What was found in each blob by the present rules."""
        schema = f"blob binary, spans array<{SPAN}>"
        try:
            return self.spark.read.schema(schema).parquet(self.scans_path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def update(self, texts: DataFrame, version: str) -> None:
        """Record the texts (path, text) as `version` and scan the blobs not scanned before.

        Only hashes are compared.  One path stands for each new blob, and only its text is
        scanned; the join has one row per path, so copies weigh nothing.  A null text is the empty
        blob.  Of several rows with the same path each is a version of its own content.
        """
        texts = texts.select("path", F.coalesce("text", F.lit("")).alias("text")) \
            .withColumn("blob", F.unhex(F.sha2("text", 256)))
        texts.select("path", "blob").write.mode("overwrite").option("compression", "zstd") \
            .parquet(f"{self.folder}/versions/version={version}")
        unseen = self.versions(version).groupBy("blob").agg(F.min("path").alias("path")) \
            .join(self.scans().select("blob"), "blob", "left_anti")
        chosen = texts.alias("t").join(
            unseen.hint("shuffle_hash").alias("u"),
            F.expr("t.path <=> u.path AND t.blob = u.blob"), "left_semi")
        chosen.select("blob", found_spans(F.col("text"), self.rules).alias("spans")) \
            .write.mode("append").option("compression", "zstd").parquet(self.scans_path)

    def findings(self, version: str) -> DataFrame:
        """(path, blob, spans) for every path of a version; nothing found is an empty list."""
        found = self.scans().filter(F.size("spans") > 0).dropDuplicates(["blob"])
        return self.versions(version).join(found, "blob", "left").select(
            "path", "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(findings: DataFrame) -> DataFrame:
    """The columns of the contract from a version's findings."""
    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(list(kinds)))

    base = of(*(r.kind for r in BASE))
    counts = [F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return findings.select(F.col("path").alias("doc_id"), *counts,
                           F.sha2(joined_spans(base), 256).alias("base_sha256"),
                           joined_spans(F.col("spans")).alias("spans"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All secrets of `documents`, from a ledger of its own.

    Null and empty texts have none.  Every row is a path, also repeated ones; an empty table gives
    an empty result; further columns are not read.
    """
    ledger = Ledger(spark, working_folder(spark, "secret_ledger"))
    ledger.update(documents(spark, sf_dir).withColumnRenamed("doc_id", "path"), "1")
    return digests(ledger.findings("1"))


def _sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same rows in DuckDB: a pattern's matches, and what lies between them, give the places."""

    def either_case(pattern: str) -> str:
        """The pattern with the letters of its case-blind group in classes."""
        group = re.search(r"\(\?i:([^)]*)\)", pattern)
        if not group:
            return pattern
        letters = re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", group[1])
        return pattern.replace(group[0], f"(?:{letters})")

    columns, found = [], []
    for k, rule in enumerate(rules):
        pattern = either_case(rule.pattern).replace("'", "''")
        columns += [f"regexp_extract_all(text, '{pattern}') AS m{k}",
                    f"string_split_regex(text, '{pattern}') AS s{k}",
                    f"regexp_extract_all(text, '{pattern}', {rule.group}) AS g{k}"]
        start = (f"list_sum(list_transform(s{k}[1:i], lambda x: length(x)))::BIGINT + "
                 f"coalesce(list_sum(list_transform(m{k}[1:i - 1], lambda x: length(x))), 0)::BIGINT")
        found.append(f"list_transform(list_filter(range(1, len(m{k}) + 1), "
                     f"lambda i: length(g{k}[i]) >= {rule.least}), lambda i: "
                     f"{{'a': {start}, 'k': {k}, 'n': length(m{k}[i])}})")
    names = "[" + ", ".join(f"'{r.kind}'" for r in rules) + "]"

    def joined(spans: str) -> str:
        return (f"array_to_string(list_transform({spans}, lambda s: {names}[s.k + 1] || ':' || s.a "
                f"|| ':' || (s.a + s.n)), ',')")

    counts = ", ".join(f"len(list_filter(spans, lambda s: s.k = {k}))::BIGINT AS n_{r.kind}"
                       for k, r in enumerate(BASE))
    base = f"list_filter(spans, lambda s: s.k < {len(BASE)})"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS (SELECT doc_id, {", ".join(columns)} FROM texts),
found AS (SELECT doc_id, list_sort(flatten([{", ".join(found)}])) AS spans FROM parts)
SELECT doc_id, {counts}, sha256({joined(base)}) AS base_sha256, {joined("spans")} AS spans
FROM found"""


SQL = _sql()
