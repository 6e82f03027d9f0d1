import random

import pytest
from pyspark.sql import functions as F

from jobsignal.functions import rules
from jobsignal.operators.needle_table import (
    NEEDLES, category_needles, met_needles, region_needles,
)


def texts():
    rng = random.Random(6)
    parts = ["us", " us", "usa", "Europe", "eu", "gb", "remote", "REMOTE", "data", "scientist", "sde",
             "devops", "ml engineer", "x", "ü", "\n", "machine", "learning", "engineer", ",", "日本"]
    out = [None, "", " ", "us", " us", "a us", "data scientist", "data  scientist", "bigdata scientists",
           "x" * 3000 + "sde", "full stack" * 50]
    return out + ["".join(rng.choice(parts) + rng.choice(["", " ", "  "])
                          for _ in range(rng.randint(1, 25))) for _ in range(150)]


@pytest.mark.parametrize("tables", ["rules", "odd"])
def test_equals_a_search_for_every_needle(spark, tables):
    if tables == "rules":
        needles = category_needles(spark).unionByName(region_needles(spark))
    else:
        needles = spark.createDataFrame(
            [("d", "one", "u"), ("d", "one", "ü"), ("d", "two", "a s"), ("d", "two", "A S"),
             ("d", "three", "  "), ("d", "four", None), ("d", "five", ""), ("e", "five", " us "),
             ("e", None, "remote"), ("e", "six", "日本"), ("e", "six", "\n"), ("e", "seven", "x\n"),
             ("e", "eight", "data  scientist")], NEEDLES)
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    want = set()
    for i, t in rows:
        low = (t or "").lower()
        for d, name, needle in needles.collect():
            if needle is not None and (needle.strip(" ") and needle.lower() in low
                                       or needle == "" and low == ""):
                want.add((i, d, name))
    got = [tuple(r) for r in met_needles(df, ["id"], F.col("text"), needles).collect()]
    assert set(got) == want and len(got) == len(want) and len(want) > 100


def test_equals_the_column_rules(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "id long, text string")
    needles = category_needles(spark).unionByName(region_needles(spark))
    got = {(r.id, r.dim, r.name) for r in met_needles(df, ["id"], F.col("text"), needles).collect()}
    want = set()
    for name in rules.CATEGORY_QUERIES:
        hit = df.where(rules.contains_category(F.col("text"), [name]))
        want |= {(r.id, "category", name) for r in hit.collect()}
    for name in ("us", "uk", "eu", "canada", "remote"):
        hit = df.where(rules.matches_region(F.col("text"), [name]))
        want |= {(r.id, "region", name) for r in hit.collect()}
    listed = {"us", "uk", "eu", "canada", "remote"} | set(rules.CATEGORY_QUERIES)
    assert {g for g in got if g[2] in listed} == want


def test_a_thousand_categories_without_a_nested_loop(spark):
    many, five = (spark.range(n).selectExpr("'d' dim", "concat('n', id) name", "concat('skill no', id, ' x') needle")
                  for n in (1000, 5))
    df = spark.createDataFrame([(1, "a skill no17 xy skill no999 x"), (2, "skill no1000 x")],
                               "id long, text string")
    found = met_needles(df, ["id"], F.col("text"), many)
    assert {(r.id, r.name) for r in found.collect()} == {(1, "n17"), (1, "n999")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "skill no17" not in plan
    few = met_needles(df, ["id"], F.col("text"), five)
    assert abs(len(few._jdf.queryExecution().optimizedPlan().toString())
               - len(found._jdf.queryExecution().optimizedPlan().toString())) < 200
    assert met_needles(df, ["id"], F.col("text"), many.limit(0)).collect() == []
