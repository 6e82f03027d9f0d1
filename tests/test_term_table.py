import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobsignal.dictionaries import POSTINGS, RESUMES, SkillDictionary
from jobsignal.operators import extraction
from jobsignal.operators.bitmap import bitmap, bits_for, hashed, may_contain
from jobsignal.operators.term_table import TERMS, filed_terms, table_mentions, term_table

WORD = r"[^\W]"
TRICKY = SkillDictionary.titled(
    ["c++", "c#", ".net", "asp.net", "a b a", "b", "a b", "node.js", "a-b", "+a+", "c++ dev",
     "machine learning", "learning", "r", "x y z", "é à", "_id", "a  b"])


def texts():
    rng = random.Random(4)
    parts = ["a", "b", "c++", "c#", ".net", "asp.net", "c++11", "learning", "machine", "node.js",
             "+a+", "+", "é", "à", "x", "y", "z", "_id", "dev", "r", "R&D", "日本"]
    gaps = [" ", " ", " ", "  ", "\n", "-", "+", ".", ", ", ""]
    out = ["", "   ", "a", "a b a b a", "a b a a b a", "+a+a+a+", ".net", "x.net", "machine learning",
           "machine\nlearning", "that work at work", "c++ c++11 c++", "a b", "A B A", "\n a b \n\n"]
    for _ in range(150):
        out.append("".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.randint(1, 40))))
    return out + ["a b " * 3000, None]


@pytest.mark.parametrize("boundary", ["word", "token"])
def test_equals_the_column_form(spark, boundary):
    dictionaries = {n: SkillDictionary(d.display, boundary)
                    for n, d in (("t", TRICKY), ("p", POSTINGS), ("r", RESUMES))}
    df = spark.createDataFrame(list(enumerate(texts())), "id long, text string").repartition(3)
    want = Counter()
    for name, d in dictionaries.items():
        for r in extraction.skill_mentions(df, ["id"], F.col("text"), d).collect():
            want[r.id, name, r.skill] += r.mentions
    got = Counter()
    for r in table_mentions(df, ["id"], F.col("text"), term_table(spark, dictionaries)).collect():
        got[r.id, r.dict_id, r.skill] += r.mentions
    assert got == want and len(want) > 300


def test_tables_with_odd_rows(spark):
    terms = spark.createDataFrame([("d", "A b", "x", None), ("d", "a B", "w", "word"), ("e", "a b", "z", None),
                                   ("d", "++", "never", None), ("d", "", "never", None),
                                   ("d", None, "never", None)], TERMS)
    df = spark.createDataFrame([(1, "a b ++ a b"), (2, None)], "id long, text string")
    got = {(r.id, r.dict_id, r.skill): r.mentions
           for r in table_mentions(df, ["id"], F.col("text"), terms).collect()}
    assert got == {(1, "d", "w"): 2, (1, "e", "z"): 2}
    none = spark.createDataFrame([], TERMS)
    assert table_mentions(df, ["id"], F.col("text"), none).collect() == []
    assert table_mentions(df.limit(0), ["id"], F.col("text"), terms).collect() == []


def plan_size(df):
    return len(df._jdf.queryExecution().optimizedPlan().toString())


def test_a_hundred_thousand_terms(spark):
    """Two-word terms that all share their first word: each is filed under its second."""
    n = 100_000
    many = spark.range(n).select(
        F.lit("d").alias("dict_id"), F.concat(F.lit("data w"), "id").alias("term"),
        F.concat(F.lit("W"), "id").alias("skill"))
    filed = filed_terms(many)
    assert filed.count() == n and filed.groupBy("word").count().agg(F.max("count")).first()[0] == 1
    rng = random.Random(1)
    picks = [[rng.randrange(n) for _ in range(50)] for _ in range(40)]
    df = spark.createDataFrame([(i, " ".join(f"data w{k}, w{k}" for k in p)) for i, p in enumerate(picks)],
                               "id long, text string")
    found = table_mentions(df, ["id"], F.col("text"), many)
    got = {(r.id, r.skill): r.mentions for r in found.collect()}
    assert got == {(i, f"W{k}"): c for i, p in enumerate(picks) for k, c in Counter(p).items()}
    few = table_mentions(df, ["id"], F.col("text"), many.limit(10))
    assert abs(plan_size(found) - plan_size(few)) < 200
    assert not re.search("NestedLoop|Cartesian|Python", found._jdf.queryExecution()
                         .executedPlan().toString())


def test_words_are_tested_one_by_one_in_compiled_code(spark):
    """Words leave a text before the bitmap is asked, and meet the terms by its hash."""
    terms = term_table(spark, {"t": TRICKY})
    df = spark.createDataFrame([(1, "a a a b a b, a a")], "id long, text string")
    aa = spark.createDataFrame([("d", "a a", "AA", None), ("d", "b a", "BA", None)], TERMS)
    got = {r.skill: r.mentions for r in table_mentions(df, ["id"], F.col("text"), aa).collect()}
    assert got == {"AA": 2, "BA": 1}
    plan = table_mentions(df, ["id"], F.col("text"), terms)._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "posexplode(_words" in plan and "(mark#" in plan[plan.index("Join"):].split("\n")[0]


def test_two_bits_a_key_let_few_others_pass(spark):
    bits = bits_for(3000)
    marks = spark.range(3000).select(hashed("id").alias("k"))
    others = spark.range(10_000, 110_000).select(hashed("id").alias("k"))
    passed = others.crossJoin(bitmap(marks, "k", bits)) \
        .where(may_contain(F.col("bitmap"), F.col("k"), bits)).count()
    assert passed < 300
