import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import model
from jobsignal.dictionaries import BASIC, POSTINGS, RESUMES, SkillDictionary
from jobsignal.functions import skills as S
from jobsignal.operators import extraction as E
from jobsignal.operators import market as M

PIECES = (
    "python java javascript c++ c# .net asp.net node.js vue.js vue spring|spring boot|machine "
    "learning|machine learning|google cloud|cloud functions|google cloud functions|r|go|api|"
    "rest|rest assured|rest api|ci/cd|tcp/ip|objective-c|c++11|.net5|x.net|é|ß|²|_|İ|pythoné|"
    "python_3|9|scikit-learn|react native|power bi|PYTHON|Node.JS|d3.js|git|gitlab ci"
)
TOKENS = [t for p in PIECES.split("|") for t in ([p] if " " in p and len(p) < 25 else p.split())]
SEPARATORS = [" ", "  ", "\n", ", ", ".", "-", "", "/", "+", "\t", "é", " "]


def random_texts(n, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(TOKENS) + rng.choice(SEPARATORS) for _ in range(rng.randint(0, 14)))
            for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


@pytest.mark.parametrize("dictionary", [POSTINGS, RESUMES], ids=["postings", "resumes"])
def test_mentions_equal_the_word_boundary_search(spark, dictionary):
    texts = [*random_texts(1500), "", None]
    df = frame(spark, texts)
    rows = df.select("id", S.mention_map(F.col("text"), dictionary).alias("m"),
                     S.skill_list(F.col("text"), dictionary).alias("l")).collect()
    assert len(rows) == len(texts)
    for row in rows:
        expected = model.count_mentions(texts[row["id"]], dictionary)
        assert row["m"] == expected, repr(texts[row["id"]])
        assert row["l"] == sorted(expected)


@pytest.mark.parametrize("terms", [["++", "+"], ["c++", "."], ["go"], ["machine learning", "api"]])
def test_small_dictionaries(spark, terms):
    texts = random_texts(300, seed=5)
    d = SkillDictionary.titled(terms)
    rows = frame(spark, texts).select("id", S.mention_map(F.col("text"), d).alias("m")).collect()
    assert any(r["m"] for r in rows)
    for row in rows:
        assert row["m"] == model.count_mentions(texts[row["id"]], d)


def test_demand_adds_up_mentions(spark):
    texts = random_texts(400, seed=3)
    expected = {}
    for t in texts:
        for k, n in model.count_mentions(t, POSTINGS).items():
            expected[k] = expected.get(k, 0) + n
    got = M.skill_demand(frame(spark, texts), F.col("text"), POSTINGS).collect()
    assert {r["skill"]: r["count"] for r in got} == expected


def test_known_boundaries(spark):
    texts = ["javascript", "c++ and", "c++11", " .net dev", "asp.net dev", "spring boot"]
    rows = frame(spark, texts).select("id", S.mention_map(F.col("text"), POSTINGS).alias("m"))
    got = {texts[r["id"]]: r["m"] for r in rows.collect()}
    assert got == {
        "javascript": {"Javascript": 1}, "c++ and": {}, "c++11": {"C++": 1}, " .net dev": {},
        "asp.net dev": {"Asp.Net": 1, ".Net": 1}, "spring boot": {"Spring": 1, "Spring Boot": 1},
    }


def test_token_boundary_finds_punctuated_terms(spark):
    d = SkillDictionary.titled(["c++", ".net", "go"], boundary="token")
    texts = ["c++ and go", " .net dev", "c++11", "asp.net"]
    rows = frame(spark, texts).select("id", S.mention_map(F.col("text"), d).alias("m")).collect()
    assert {texts[r["id"]]: r["m"] for r in rows} == {
        "c++ and go": {"C++": 1, "Go": 1}, " .net dev": {".Net": 1}, "c++11": {}, "asp.net": {}}


def test_demo_paragraph(spark):
    text = "Python, then python and Java. AWS (Azure), Docker; Node.js with MongoDB. CI/CD!"
    row = frame(spark, [text]).select(S.top_skills(F.col("text"), POSTINGS, 3).alias("t")).first()
    assert [(e["skill"], e["mentions"]) for e in row["t"]] == [
        ("Python", 2), ("Aws", 1), ("Azure", 1)]


def test_top_skills_per_text(spark):
    df = frame(spark, ["go go java", "nothing", "rust java rust java go"])
    rows = E.top_skills_per_text(df, ["id"], F.col("text"), POSTINGS, 2).collect()
    assert sorted(map(tuple, rows)) == [
        (0, 1, "Go", 2), (0, 2, "Java", 1), (2, 1, "Java", 2), (2, 2, "Rust", 2)]


REQUIRED = ["Python", "c++", ".NET", "Machine Learning", "r", "_", "Python"]


def test_match_skills_for_a_list_and_for_a_column(spark):
    texts = random_texts(300, seed=11)
    df = frame(spark, texts).withColumn("req", F.array(*[F.lit(r) for r in REQUIRED]))
    rows = df.select("id", S.match_skills(F.col("text"), REQUIRED).alias("a"),
                     S.match_skills(F.col("text"), F.col("req")).alias("b")).collect()
    for row in rows:
        expected = {r: model.has_word(texts[row["id"]], r) for r in REQUIRED}
        assert row["a"] == expected and row["b"] == expected


def test_match_skills_with_an_empty_name(spark):
    df = frame(spark, ["a b", "!!"]).withColumn("req", F.array(F.lit("")))
    rows = df.select("id", S.match_skills(F.col("text"), F.col("req")).alias("m")).collect()
    assert {r["id"]: r["m"][""] for r in rows} == {0: True, 1: False}


def test_fallback_counts_texts_that_contain_the_term(spark):
    texts = ["Scala and more scala", "javascript", None, ""]
    got = M.fallback_demand(frame(spark, texts), F.col("text"), BASIC).collect()
    expected = {t: sum(t in (x or "").lower() for x in texts) for t in BASIC.terms}
    assert {r["skill"]: r["count"] for r in got} == {k: v for k, v in expected.items() if v}


def test_jaccard_edges(spark):
    cases = [([], [], 1.0), ([], ["x"], 0.0), (["A", "b"], ["a"], 0.5), (["a", "A"], ["a"], 1.0)]
    df = spark.createDataFrame(cases, "a array<string>, b array<string>, want double")
    for row in df.select("*", S.jaccard(F.col("a"), F.col("b")).alias("got")).collect():
        assert row["got"] == row["want"] == model.jaccard(row["a"], row["b"])


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="python java+c#.nét_9²İ \n-/", max_size=40), min_size=1,
                max_size=40))
def test_mentions_on_arbitrary_text(spark, texts):
    rows = frame(spark, texts).select("id", S.mention_map(F.col("text"), POSTINGS).alias("m"))
    for row in rows.collect():
        assert row["m"] == model.count_mentions(texts[row["id"]], POSTINGS)
