import re

from pyspark.sql import functions as F

import model
from jobsignal.dictionaries import POSTINGS, RESUMES
from jobsignal.operators import extraction as E
from jobsignal.sources.resumes import accepted_uploads

TEXTS = {
    "a.pdf": " Python and C++11, machine learning\nwith REST API experience ",
    "b.pdf": "   \n ",
    "c.pdf": "gardening",
    "d.pdf": None,
}
PHRASES = [("a.pdf", "Python programming"), ("c.pdf", " the Postgresql database "),
           ("c.pdf", "a gopher"), ("b.pdf", "sql")]
ENTITIES = [("a.pdf", "Kubernetes", "PRODUCT"), ("a.pdf", "kubernetes", "ORG"),
            ("c.pdf", " Spark ", "ORG"), ("c.pdf", "Kafka", "PERSON"), ("c.pdf", "Acme", "ORG")]


def frames(spark):
    return (spark.createDataFrame(list(TEXTS.items()), "file_path string, text string"),
            spark.createDataFrame(PHRASES, "file_path string, phrase string"),
            spark.createDataFrame(ENTITIES, "file_path string, text string, label string"))


def keywords(text):
    return {n for n in RESUMES.display.values()
            if re.search(r"\b" + re.escape(n.lower()) + r"\b", text.lower())}


def test_keywords_only(spark):
    rows = {r["file_path"]: r for r in E.analyze_resumes(frames(spark)[0]).collect()}
    a = rows["a.pdf"]
    assert a["skills"] == sorted(keywords(TEXTS["a.pdf"])) and a["success"] and a["error"] is None
    assert a["text"] == TEXTS["a.pdf"].strip() and a["word_count"] == len(TEXTS["a.pdf"].split())
    assert (rows["c.pdf"]["success"], rows["c.pdf"]["skills"]) == (True, [])
    for name in ("b.pdf", "d.pdf"):
        r = rows[name]
        assert (r["success"], r["text"], r["skills"], r["skill_count"], r["word_count"]) == (
            False, "", [], 0, 0)
        assert r["error"] == E.NO_TEXT


def test_phrases_and_entities(spark):
    resumes, phrases, entities = frames(spark)
    rows = {r["file_path"]: r["skills"] for r in
            E.analyze_resumes(resumes, phrases=phrases, entities=entities).collect()}
    inside = {n for n in RESUMES.display.values() for p, t in PHRASES
              if p == "c.pdf" and n.lower() in t.lower().strip()}
    assert {"PostgreSQL", "SQL", "Go", "R"} <= inside
    assert rows["c.pdf"] == sorted(inside | {"Spark"})
    from_a = {n for n in RESUMES.display.values() if n.lower() in "python programming"}
    assert rows["a.pdf"] == sorted(keywords(TEXTS["a.pdf"]) | from_a | {"Kubernetes"})
    assert rows["b.pdf"] == []  # no text, no skills, whatever the phrases say


def test_long_forms(spark):
    resumes, phrases, entities = frames(spark)
    long = E.keyword_skills(resumes, ["file_path"], F.col("text")).collect()
    assert {r["skill"] for r in long if r["file_path"] == "a.pdf"} == keywords(TEXTS["a.pdf"])
    assert {r["file_path"] for r in long} == {"a.pdf"}
    got = E.entity_skills(entities, ["file_path"]).collect()
    assert sorted(map(tuple, got)) == [("a.pdf", "Kubernetes"), ("c.pdf", "Spark")]


def test_skill_mentions_long(spark):
    df = spark.createDataFrame([(1, "java java go"), (2, None), (3, "nothing here")],
                               "id int, text string")
    got = E.skill_mentions(df, ["id"], F.col("text"), POSTINGS).collect()
    assert {r["skill"]: r["mentions"] for r in got} == model.count_mentions("java java go", POSTINGS)


def test_only_pdf_uploads(spark):
    df = spark.createDataFrame([("a.PDF",), ("b.docx",)], "file_name string")
    assert [r[0] for r in accepted_uploads(df).collect()] == ["a.PDF"]
