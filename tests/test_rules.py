import pytest
from pyspark.sql import functions as F

from jobsignal.functions import rules as R


def values(spark, rows, schema, **columns):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    got = df.select("i", *[c.alias(n) for n, c in columns.items()]).collect()
    return [r[1:] for r in sorted(got)]


REGION_CASES = [
    ("USA", ["us"], False), ("Austin, USA", ["us"], True), ("", ["remote"], True),
    (None, ["remote"], True), ("Fully Remote", ["remote"], True), ("Toronto", ["canada"], True),
    ("Toronto", ["ca"], True), ("Sydney", ["au"], False), ("Sydney", ["global"], True),
    ("Sydney", [], True), ("Museum", ["eu"], True), ("Bugbrooke", ["uk"], True),
    ("Paris", ["us", "uk", "de"], False), ("New York", ["us"], True), ("Berlin", ["germany"], True),
    ("", ["us"], False), ("London", ["gb"], True), ("uk", ["uk"], False),
]


def test_regions_from_a_column_and_from_a_list(spark):
    rows = [(loc, regions) for loc, regions, _ in REGION_CASES]
    got = values(spark, rows, "loc string, r array<string>",
                 a=R.matches_region(F.col("loc"), F.col("r")))
    assert [g[0] for g in got] == [want for *_, want in REGION_CASES]
    for loc, regions, want in REGION_CASES:
        [(one,)] = values(spark, [(loc,)], "loc string",
                          a=R.matches_region(F.col("loc"), regions))
        assert one == want, (loc, regions)


def test_all_remote_board_accepts_any_location(spark):
    got = values(spark, [("Paris",)], "loc string",
                 a=R.matches_region_or_remote(F.col("loc"), ["us", "remote"]),
                 b=R.matches_region_or_remote(F.col("loc"), ["us"]))
    assert got == [(True, False)]


CATEGORY_CASES = [
    ("Senior Data Scientist", ["data science"], True), ("data science lead", ["data science"], True),
    ("Machine Learning Engineer", ["ml engineer"], True), ("cook", ["data science"], False),
    ("Chef de partie", ["chef"], True), ("", ["chef"], False), (None, ["chef"], False),
    ("anything", [], False), ("anything", [""], True), ("", [""], False),
]


def test_categories_from_a_column_and_from_a_list(spark):
    rows = [(t, c) for t, c, _ in CATEGORY_CASES]
    got = values(spark, rows, "t string, c array<string>",
                 a=R.contains_category(F.col("t"), F.col("c")))
    assert [g[0] for g in got] == [want for *_, want in CATEGORY_CASES]
    for text, categories, want in CATEGORY_CASES:
        [(one,)] = values(spark, [(text,)], "t string",
                          a=R.contains_category(F.col("t"), categories))
        assert one == want, (text, categories)


@pytest.mark.parametrize(("demand", "size", "tier"), [
    (4, 10, "High"), (3, 10, "Medium"), (2, 10, "Medium"), (1, 10, "Low"), (0, 0, "Low"),
    (16, 50, "High"), (15, 50, "Medium"), (5, 50, "Low")])
def test_priority_edges(spark, demand, size, tier):
    got = values(spark, [(demand, size)], "d long, n long",
                 p=R.priority(F.col("d"), F.col("n")))
    assert got == [(tier,)]


def test_assessment_and_rounding(spark):
    rows = [(19.99, 10), (19.99, 9), (20.0, 10), (39.9, 4), (40.0, 50), (59.99, 0), (60.0, 99),
            (0.0, 0)]
    got = values(spark, rows, "g double, m long", a=R.assessment(F.col("g"), F.col("m")))
    assert [g[0] for g in got] == [R.EXCELLENT, R.GOOD, R.GOOD, R.MODERATE, R.MODERATE, R.MODERATE,
                                   R.SIGNIFICANT, R.MODERATE]
    halves = [(3.125,), (9.375,), (66.66666666666667,), (2.0,)]
    got = values(spark, halves, "x double", r=R.rounded(F.col("x")))
    assert [g[0] for g in got] == [round(x, 2) for (x,) in halves]


def test_pdf_names(spark):
    got = values(spark, [("cv.PDF",), ("cv.pdf.doc",), ("pdf",)], "n string",
                 p=R.is_pdf(F.col("n")))
    assert got == [(True,), (False,), (False,)]
