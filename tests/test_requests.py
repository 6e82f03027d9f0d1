import json

from pyspark.sql import functions as F

from jobsignal.operators import requests as Q
from jobsignal.schema import FILTERS


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), FILTERS)


def test_normalize(spark):
    rows = Q.normalize_filters(frame(
        spark, ([" Data Science ", " "], ["US"], None, 60, None, "t"),
        ([], None, False, None, ["\tX"], None))).collect()
    assert tuple(rows[0]) == (["data science"], ["us"], True, 300, list(Q.DEFAULT_SOURCES), "t")
    assert tuple(rows[1]) == (list(Q.DEFAULT_CATEGORIES), list(Q.DEFAULT_REGIONS), False, 10800,
                              ["x"], None)


def test_validate(spark):
    rows = Q.validate_update(frame(
        spark, (["a"], ["b"], True, 300, [], None), ([" "], ["b"], True, 300, [], None),
        (["a"], [], True, 300, [], None), (["a"], ["b"], True, 299, ["S "], None),
        (None, None, None, None, None, None)), F.lit("now")).collect()
    assert [r["error"] for r in rows] == [
        None, Q.NO_CATEGORY, Q.NO_REGION, Q.REFRESH_TOO_SHORT, Q.NO_CATEGORY]
    assert rows[0]["sources"] == list(Q.DEFAULT_SOURCES) and rows[3]["sources"] == ["s"]
    assert rows[0]["last_updated"] == "now"


def lists(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v array<string>")
    return [r["o"] for r in sorted(df.select("i", fn(F.col("v")).alias("o")).collect())]


def test_queries_and_countries(spark):
    assert lists(spark, [["devops", "devops engineer", "cook", "sde"], []], Q.search_queries) == [
        ["devops engineer", "cook", "software development engineer"], []]
    assert lists(spark, [["us", "global"], ["eu", "uk", "de", "gb"], ["mars"], [], ["au", "ca"]],
                 Q.country_codes) == [["us", "gb", "de"], ["de", "gb"], ["us"], ["us"], ["au", "ca"]]


def test_phrase_for_region(spark):
    regions = [[], ["global", "us"], ["us", "remote"], ["uk", "us"], ["gb"], ["de", "uk"], ["eu"],
               ["canada"]]
    got = lists(spark, regions, lambda r: Q.query_with_region(F.lit("q"), r))
    assert got == ["q", "q", "q remote", "q in United States", "q in United Kingdom",
                   "q in United Kingdom", "q in Germany", "q"]


def test_requests_per_filter_row(spark):
    df = frame(spark, (["devops", "cook"], ["us", "uk"], True, 300, [], None)).withColumn(
        "id", F.lit(1))
    got = sorted(map(tuple, Q.country_requests(df, "id").collect()))
    assert got == [(1, 0, "devops engineer", "us"), (1, 1, "devops engineer", "gb"),
                   (1, 2, "cook", "us"), (1, 3, "cook", "gb")]
    assert sorted(map(tuple, Q.phrase_requests(df, "id").collect())) == [
        (1, 0, "devops engineer", "devops engineer in United States"),
        (1, 1, "cook", "cook in United States")]


def test_filters_of_a_run(spark, tmp_path):
    path = tmp_path / "filters.json"
    path.write_text(json.dumps({"categories": ["ML Engineer "], "regions": [" "],
                                "refresh_interval": 10}, indent=2))
    got = Q.CollectionFilters.load(spark, str(path))
    assert got == Q.CollectionFilters(("ml engineer",), Q.DEFAULT_REGIONS, True, 300)
    assert got.frame(spark).first()["categories"] == ["ml engineer"]
    assert Q.CollectionFilters.from_settings({}) == Q.CollectionFilters()
