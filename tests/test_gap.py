import random

import pytest

import model
from jobsignal.functions import rules as R
from jobsignal.operators import gap
from jobsignal.plans.resume_gap import gap_bundle, resume_report

SCHEMA = "resume_id string, skills array<string>"
SMALL = {"python": 100, "sql": 80, "spark": 60, "aws": 50, "docker": 40}
# A demonstration market and resume with known results.
DEMO = {"Python": 850, "SQL": 720, "Machine Learning": 600, "AWS": 550, "Docker": 480,
        "Kubernetes": 420, "Java": 400, "React": 380, "TensorFlow": 350, "Django": 320,
        "PostgreSQL": 300, "MongoDB": 280, "Git": 750, "Linux": 650, "Spark": 290}
DEMO_RESUME = ["Python", "SQL", "Git", "Linux", "Flask", "JavaScript", "HTML", "CSS", "REST API"]


def market_frame(spark, market):
    return spark.createDataFrame(list(market.items()), "skill string, count long")


def resume_frame(spark, resumes):
    return spark.createDataFrame(list(resumes.items()), SCHEMA)


def reports(spark, resumes, market, n):
    rows = gap.analyze(resume_frame(spark, resumes), market_frame(spark, market), n).collect()
    return {r["resume_id"]: r for r in rows}


def test_small_market(spark):
    row = reports(spark, {"a": ["python", "java"]}, SMALL, 10)["a"]
    assert [m["skill"] for m in row["matching_skills"]] == ["python"]
    assert [m["skill"] for m in row["missing_skills"]] == ["sql", "spark", "aws", "docker"]
    assert {m["priority"] for m in row["missing_skills"]} == {"High"}
    assert row["gap_percentage"] == 80.0 and row["overall_assessment"] == R.SIGNIFICANT
    long = gap.long_resumes(resume_frame(spark, {"a": ["python", "java"]}))
    assert gap.match_rate(long, market_frame(spark, SMALL)).first()["match_rate"] == 50.0


def test_three_skill_market(spark):
    market = {k: SMALL[k] for k in ("python", "sql", "spark")}
    row = reports(spark, {"a": ["python", "java"]}, market, 50)["a"]
    assert (row["market_total_skills"], row["missing_count"], row["gap_percentage"]) == (3, 2, 66.67)
    assert row["overall_assessment"] == R.SIGNIFICANT


def test_demo_market(spark):
    row = reports(spark, {"a": DEMO_RESUME}, DEMO, 15)["a"]
    assert [m["skill"] for m in row["matching_skills"]] == ["Python", "SQL", "Git", "Linux"]
    assert (row["missing_count"], row["gap_percentage"]) == (11, 73.33)
    bundle = gap_bundle(resume_frame(spark, {"a": DEMO_RESUME}), market_frame(spark, DEMO)).first()
    assert bundle["skill_score"] == 44.44
    assert [(s["order"], s["skill"], s["demand"], s["priority"]) for s in
            bundle["recommendations"]] == [
        (1, "Machine Learning", 600, "High"), (2, "AWS", 550, "High"), (3, "Docker", 480, "High"),
        (4, "Kubernetes", 420, "High"), (5, "Java", 400, "High")]
    assert bundle["recommendations"][0]["reason"] == "High market demand (600 mentions)"


def test_empty_market(spark):
    row = gap.analyze(
        resume_frame(spark, {"a": ["python"]}),
        spark.createDataFrame([], "skill string, count long")).first()
    assert (row["market_total_skills"], row["gap_percentage"]) == (0, 0.0)
    assert row["overall_assessment"] == R.MODERATE and row["missing_skills"] == []
    empty = spark.createDataFrame([], "skill string, count long")
    long = gap.long_resumes(resume_frame(spark, {"a": ["python"], "b": []}))
    for r in gap.summary(long, empty).collect():
        assert (r["market_total_skills"], r["missing_count"], r["gap_percentage"]) == (0, 0, 0.0)
        assert r["overall_assessment"] == R.MODERATE
    assert gap.missing(long, empty).count() == gap.missing(long, empty, None).count() == 0
    assert {r["match_rate"] for r in gap.match_rate(long, empty).collect()} == {0.0}
    report = resume_report(resume_frame(spark, {"a": ["python"]}), empty).first()
    assert report["gap_analysis"] is None and report["message"] == R.NO_MARKET


def test_report_with_a_market(spark):
    report = resume_report(resume_frame(spark, {"a": ["python"]}),
                           market_frame(spark, SMALL)).first()
    assert report["message"] is None and report["gap_analysis"]["missing_count"] == 4


def test_tiers_by_share_of_postings(spark):
    rows = gap.market_profile(market_frame(spark, SMALL), 50, postings=200).collect()
    assert {r["skill"]: r["priority"] for r in rows} == {
        "python": "High", "sql": "High", "spark": "Medium", "aws": "Medium", "docker": "Medium"}


def random_case(seed):
    rng = random.Random(seed)
    names = ["a", "A", "b", "B", "c", "d", "e", "f", "g", "H", "h", "i", "J", "k", "l", "m", "n"]
    market = {s: rng.randint(0, 12) for s in rng.sample(names, rng.randint(1, len(names)))}
    resumes = {f"r{i}": [rng.choice(names + ["x", "y", "Z"]) for _ in range(rng.randint(0, 14))]
               for i in range(25)}
    return market, resumes


@pytest.mark.parametrize("seed", range(6))
def test_random_markets_in_both_forms(spark, seed):
    market, resumes = random_case(seed)
    n = [1, 3, 5, 9, 14, 50][seed]
    want = {k: model.gap(v, market, n) for k, v in resumes.items()}
    mf, rf = market_frame(spark, market), resume_frame(spark, resumes)
    long = gap.long_resumes(rf)

    nested = {r["resume_id"]: r for r in gap.with_learning_path(gap.analyze(rf, mf, n)).collect()}
    summary = {r["resume_id"]: r for r in gap.summary(long, mf, n).collect()}
    assert set(nested) == set(summary) == set(resumes)
    lacking, match, path, first = {}, {}, {}, {}
    for r in gap.missing(long, mf, n).collect():
        lacking.setdefault(r["resume_id"], []).append((r["skill"], r["demand_count"], r["priority"]))
    for r in sorted(gap.matching(long, mf, n).collect(), key=lambda r: r["pos"]):
        match.setdefault(r["resume_id"], []).append((r["skill"], r["demand_count"]))
    for r in sorted(gap.learning_path(long, mf, n).collect(), key=lambda r: r["order"]):
        path.setdefault(r["resume_id"], []).append((r["skill"], r["demand"], r["priority"]))
    for r in sorted(gap.top_priorities(long, mf, n, 2).collect(), key=lambda r: r["rank"]):
        first.setdefault(r["resume_id"], []).append((r["skill"], r["demand_count"], r["priority"]))
    for k, w in want.items():
        assert [tuple(m)[:3] for m in nested[k]["missing_skills"]] == w["missing"]
        assert [tuple(m)[:2] for m in nested[k]["matching_skills"]] == w["matching"]
        assert nested[k]["gap_percentage"] == summary[k]["gap_percentage"] == w["gap"]
        assert [(s["skill"], s["demand"], s["priority"]) for s in nested[k]["learning_path"]] \
            == w["path"] == path.get(k, [])
        assert summary[k]["resume_skill_count"] == len(resumes[k])
        assert summary[k]["matching_count"] == len(w["matching"])
        assert summary[k]["missing_count"] == len(w["missing"])
        assert summary[k]["overall_assessment"] == nested[k]["overall_assessment"]
        assert sorted(lacking.get(k, [])) == sorted(w["missing"])
        assert match.get(k, []) == w["matching"]
        assert first.get(k, []) == w["missing"][:2]


@pytest.mark.parametrize("n", [None, 4])
def test_random_match_rates(spark, n):
    market, resumes = random_case(77)
    kept = dict(sorted(market.items(), key=lambda kv: (-kv[1], kv[0]))[:n])
    mf, rf = market_frame(spark, market), resume_frame(spark, resumes)
    got = gap.match_rate(gap.long_resumes(rf), mf, n).collect()
    want = {k: model.match_rate(v, kept) for k, v in resumes.items()}
    assert {r["resume_id"]: r["match_rate"] for r in got} == want
    scored = gap.with_match_rate(rf, mf, n or 1000).collect()
    assert {r["resume_id"]: r["skill_score"] for r in scored} == want


def test_display_limits(spark):
    market = {f"s{i:02d}": 100 - i for i in range(60)}
    have = [f"S{i:02d}" for i in range(30)]
    report = gap.shown(gap.analyze(resume_frame(spark, {"a": have}),
                                   market_frame(spark, market), 60)).first()
    assert len(report["matching_skills"]) == 20 and len(report["missing_skills"]) == 15


def test_other_display_lengths(spark):
    market = {f"s{i:02d}": 100 - i for i in range(60)}
    report = gap.analyze(resume_frame(spark, {"a": ["s01", "s02", "s03"]}),
                         market_frame(spark, market), 60, top=7)
    row = gap.shown(report, matching=2, missing=3).first()
    assert len(row["top_priorities"]) == 7
    assert (len(row["matching_skills"]), len(row["missing_skills"])) == (2, 3)


def test_a_market_of_ten_thousand_skills(spark):
    market = {f"s{i}": (i * 7919) % 10_007 for i in range(10_007)}
    have = {"a": [f"S{i}" for i in range(0, 10_007, 700)], "b": [], "c": ["other"]}
    order = sorted(market, key=lambda s: (-market[s], s))[:10_000]
    mf, rf = market_frame(spark, market), resume_frame(spark, have)
    for r in gap.analyze(rf, mf, 10_000).collect():
        held = {s.lower() for s in have[r["resume_id"]]}
        assert [m["skill"] for m in r["missing_skills"]] == [s for s in order if s not in held]
    long = gap.long_resumes(rf)
    lacking = {}
    for r in gap.missing(long, mf, None).collect():
        lacking.setdefault(r["resume_id"], set()).add(r["skill"])
    for k, names in have.items():
        assert lacking[k] == set(market) - {s.lower() for s in names}
    first = {}
    for r in gap.top_priorities(long, mf, None, 12).collect():
        first.setdefault(r["resume_id"], {})[r["rank"]] = r["skill"]
    every = sorted(market, key=lambda s: (-market[s], s))
    for k, names in have.items():
        held = {s.lower() for s in names}
        assert first[k] == dict(enumerate([s for s in every if s not in held][:12], 1))
