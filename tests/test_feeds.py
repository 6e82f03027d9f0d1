import datetime as dt
import json

from pyspark.sql import functions as F

import model
from jobsignal.operators import postings as P
from jobsignal.operators.requests import CollectionFilters
from jobsignal.plans.collection import collect, write_stats
from jobsignal.schema import CYCLE_STATS, LANDED, POSTING
from jobsignal.sources import feeds

NOW = "2024-05-01T00:00:00+00:00"


def landed(spark, *responses):
    return spark.createDataFrame(
        [(c, s, r, q, b if isinstance(b, str) else json.dumps(b)) for c, s, r, q, b in responses],
        LANDED)


def read(spark, feed, body, *limits, query="data scientist", **more):
    rows = feeds.ADAPTERS[feed].read(landed(spark, ("c", feed, 0, query, body)), *limits,
                                     now=F.lit(NOW), **more).collect()
    return sorted((r.asDict() for r in rows), key=lambda r: r["pos"])


def test_remoteok(spark):
    jobs = [{"legal": "notice", "position": "data scientist"},
            {"position": "Data Scientist", "company": "A", "description": "x", "tags": ["ml"],
             "location": "Berlin", "salary": 5, "url": "/u", "slug": "s"},
            {"tags": ["data scientist"], "slug": "s2", "location": ""},
            {"position": "cook", "description": "kitchen"}]
    rows = read(spark, "remoteok", jobs, ["data science"], ["us"])
    assert rows == []
    rows = read(spark, "remoteok", jobs, ["data science"], ["remote"])
    assert [(r["pos"], r["title"], r["company"], r["location"], r["salary"], r["url"]) for r in rows] \
        == [(1, "Data Scientist", "A", "Berlin", "5", "/u"),
            (2, "Unknown", "Unknown", "", None, "https://remoteok.com/remote-jobs/s2")]
    assert all(r["is_remote"] and r["source"] == "remoteok" and r["timestamp"] == NOW for r in rows)
    many = [{}] + [{"position": "sde", "location": "remote"}] * 70
    assert [r["pos"] for r in read(spark, "remoteok", many, ["sde"], ["remote"])] == list(range(1, 71))
    rows = read(spark, "remoteok", many, ["sde"], ["remote"], limit=50)
    assert [r["pos"] for r in rows] == list(range(1, 51))


def test_arbeitnow_object_and_bare_list(spark):
    jobs = [{"title": "DevOps Engineer", "company_name": "B", "location": "Munich", "remote": True},
            {"title": "devops", "tags": ["a", "b"]}, {"title": "clerk", "location": "Munich"}]
    for body in ({"data": jobs}, jobs, "  \n" + json.dumps(jobs)):
        rows = read(spark, "arbeitnow", body, ["devops"], ["eu"])
        assert [(r["title"], r["company"], r["salary"], r["url"], r["tags"], r["is_remote"])
                for r in rows] == [("DevOps Engineer", "B", None, "", [], True)]
    many = {"data": [{"title": "cook"}] * 99 + [{"title": "sde"}] * 5}
    assert [r["pos"] for r in read(spark, "arbeitnow", many, ["sde"], [])] == list(range(99, 104))
    assert [r["pos"] for r in read(spark, "arbeitnow", many, ["sde"], [], limit=100)] == [99]
    assert read(spark, "arbeitnow", {"other": 1}, ["sde"], []) == []


def test_adzuna(spark):
    jobs = [{"title": "T", "company": {"display_name": "C"}, "description": "Fully REMOTE",
             "location": {"display_name": "L"}, "salary_min": 50000.0, "redirect_url": "/r"},
            {"company": {}}]
    rows = read(spark, "adzuna", {"results": jobs * 40})
    assert len(rows) == 80  # the search limits its answer, the reader does not
    assert [(r["title"], r["company"], r["location"], r["salary"], r["url"], r["tags"],
             r["is_remote"]) for r in rows[:2]] == [
        ("T", "C", "L", "50000.0", "/r", ["data scientist"], True),
        ("Unknown", "Unknown", "Unknown", None, "", ["data scientist"], False)]


def test_jsearch(spark):
    jobs = [{"job_title": "T", "employer_name": "E", "job_city": "Paris", "job_country": "FR",
             "job_salary": None, "job_is_remote": True},
            {"job_city": None, "job_country": "US"}, {"job_city": "Rome"}, {}]
    assert len(read(spark, "jsearch", {"data": jobs * 10}, limit=30)) == 30
    rows = read(spark, "jsearch", {"data": jobs * 10})
    assert len(rows) == 40
    assert [(r["title"], r["location"], r["is_remote"]) for r in rows[:4]] == [
        ("T", "Paris, FR", True), ("Unknown", "US", False), ("Unknown", "Rome", False),
        ("Unknown", "", False)]


def test_hackernews(spark):
    comments = [{"id": 1, "text": "Acme | <b>Data Science</b> | Remote &amp; more"},
                {"id": 2, "text": None}, {"id": 3, "text": "| no company, devops engineer"},
                {"id": 4, "text": "x" * 90 + " | data scientist, remote"}]
    rows = read(spark, "hackernews", {"children": comments}, ["data science", "devops"], ["remote"])
    assert [(r["title"], r["company"], r["location"], r["url"], r["is_remote"]) for r in rows] == [
        ("Data Scientist", "Acme", "Remote", "https://news.ycombinator.com/item?id=1", True),
        ("Software Engineer", "x" * 90, "Remote", "https://news.ycombinator.com/item?id=4", True)]
    short = read(spark, "hackernews", {"children": comments}, ["data science"], ["remote"],
                 company_length=80)
    assert [r["company"] for r in short] == ["Acme", "x" * 80]
    assert rows[0]["description"] == "Acme | Data Science | Remote & more"
    rows = read(spark, "hackernews", {"children": comments}, ["devops"], ["global"])
    assert [(r["title"], r["company"], r["location"]) for r in rows] == [
        ("Devops Engineer", "Unknown", "Unknown")]
    many = {"children": [{"id": i, "text": "sde remote" if i % 2 else "cook"} for i in range(300)]}
    rows = read(spark, "hackernews", many, ["sde"], ["remote"])
    assert [r["pos"] for r in rows] == list(range(1, 300, 2))
    rows = read(spark, "hackernews", many, ["sde"], ["remote"], limit=80)
    assert [r["pos"] for r in rows] == list(range(1, 160, 2))


def test_wellfound_marked_cards(spark):
    card = ('<div class="c" data-test="JobSearchResult"><a href="/jobs/1?x=1&amp;y=2"><h2>ML '
            'engineer</h2></a><span>Acme <i>Inc</i></span> Germany, remote</div>')
    other = '<div data-test="JobSearchResult"><p>ml engineer wanted, nowhere at all</p></div>'
    page = f"<html><div>ml engineer ml engineer Canada</div>{card}\n{other}</html>"
    rows = read(spark, "wellfound", page, ["ml engineer"], ["de", "global"])
    assert [(r["title"], r["company"], r["location"], r["url"], r["is_remote"]) for r in rows] == [
        ("ML engineer", "Acme Inc", "Germany", "https://wellfound.com/jobs/1?x=1&y=2", True),
        ("Unknown", "Unknown", "Unknown", "", False)]
    assert rows[0]["description"] == "ML engineer Acme Inc Germany, remote"
    assert len(read(spark, "wellfound", card * 60, ["ml engineer"], [])) == 60
    assert len(read(spark, "wellfound", card * 60, ["ml engineer"], [], limit=40)) == 40


def test_wellfound_any_block(spark):
    page = ("<div>short sde</div><div>sde in the United States of America</div><p>sde not in a "
            "block at all</p><div>an open block, sde, canada")
    rows = read(spark, "wellfound", page, ["sde"], [])
    assert [(r["description"], r["location"]) for r in rows] == [
        ("sde in the United States of America", "United States"),
        ("an open block, sde, canada", "canada")]


def test_wellfound_nested_blocks(spark):
    page = ("<div class=a><div><h2>The sde title</h2></div><div>a long enough text in Canada</div>"
            "tail</div> <div>second block, sde, open at the end")
    rows = read(spark, "wellfound", page, ["sde"], [], shortest=5)
    assert [(r["pos"], r["title"], r["description"]) for r in rows] == [
        (0, "The sde title", "The sde title a long enough text in Canada tail"),
        (1, "The sde title", "The sde title"),
        (3, "Unknown", "second block, sde, open at the end")]


def test_latest_thread(spark):
    bodies = ['{"hits":[{"objectID":"7"},{"objectID":"8"}]}', '{"hits":[]}', "{}", "oops"]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, b string")
    rows = df.select("i", feeds.latest_thread(F.col("b")).alias("t")).collect()
    assert [r["t"] for r in sorted(rows)] == ["7", None, None, None]


def test_read_landed_files(spark, tmp_path):
    for feed, request, query, body in [
        ("remoteok", 0, "__HIVE_DEFAULT_PARTITION__", "[\n{}\n]"),
        ("adzuna", 3, "data scientist", '{"results":[]}'),
    ]:
        folder = tmp_path / f"cycle=c1/source={feed}/request={request}/query={query}"
        folder.mkdir(parents=True)
        (folder / "part.json").write_text(body)
    df = feeds.read_landed(spark, str(tmp_path))
    assert df.schema.simpleString() == LANDED.simpleString()
    assert sorted(map(tuple, df.collect()), key=str) == [
        ("c1", "adzuna", 3, "data scientist", '{"results":[]}'),
        ("c1", "remoteok", 0, None, "[\n{}\n]")]


def cycle(spark):
    job = {"title": " Data Scientist", "company_name": "ACME ", "location": "remote"}
    return landed(
        spark,
        ("c1", "arbeitnow", 0, None, {"data": [job, {**job, "location": "Remote "}]}),
        ("c1", "remoteok", 0, None, [{}, {"position": "data scientist", "company": "acme",
                                          "location": "REMOTE"}]),
        ("c1", "adzuna", 0, "q", {"results": [{"title": "Other"}]}),
        ("c1", "adzuna", 1, "q", {"results": [{"title": "other "}]}),
        ("c2", "arbeitnow", 0, None, {"data": [job]}),
    )


FILTERS = CollectionFilters(("data science",), ("remote",),
                            sources=("adzuna", "arbeitnow", "remoteok", "jsearch"))


def test_collection_cycles(spark, tmp_path):
    done = collect(cycle(spark), FILTERS, F.lit(NOW))
    kept = sorted((r["cycle"], r["source"], r["request"], r["pos"]) for r in done.postings.collect())
    assert kept == [("c1", "adzuna", 0, 0), ("c1", "remoteok", 0, 1), ("c2", "arbeitnow", 0, 0)]
    assert [f for f in POSTING.fieldNames() if f not in done.postings.columns] == []
    assert {r["sent_total"] for r in done.stats().collect()} == {0}
    stats = {r["cycle"]: r for r in done.send("files", str(tmp_path / "sent")).collect()}
    assert spark.read.text(str(tmp_path / "sent")).count() == 3
    assert stats["c1"]["by_source"] == {"remoteok": 1, "arbeitnow": 2, "adzuna": 2, "jsearch": 0}
    assert (stats["c1"]["fetched_total"], stats["c1"]["deduplicated_total"],
            stats["c1"]["sent_total"]) == (5, 2, 2)
    assert stats["c2"]["by_source"]["adzuna"] == 0
    assert stats["c1"]["filters"]["categories"] == ["data science"]
    write_stats(done.stats(), str(tmp_path / "m"))
    write_stats(done.stats(), str(tmp_path / "m"))
    assert spark.read.schema(CYCLE_STATS).json(str(tmp_path / "m")).count() == 2


def test_collection_switched_off(spark):
    off = CollectionFilters(enabled=False)
    done = collect(cycle(spark), off)
    assert done.postings.count() == 0 and done.stats().count() == 0


def test_counts_by_source(spark):
    fetched = collect(cycle(spark), FILTERS, F.lit(NOW)).fetched
    got = P.counts_by_source(fetched, ["adzuna", "jsearch"]).collect()
    assert sorted(map(tuple, got)) == [("adzuna", 2), ("jsearch", 0)]


def test_first_posting_wins(spark):
    values = ["a", " A ", "b\t", "B", "", None, " "]
    rows = [(i, values[i * 5 % 7], values[i % 7], values[i * 3 % 7]) for i in range(200)]
    df = spark.createDataFrame(rows, "o int, title string, company string, location string")
    got = P.deduplicate(df.repartition(7), order=["o"]).collect()
    assert sorted(r["o"] for r in got) == sorted(r[0] for r in model.dedup(rows))


def test_first_posting_wins_where_rows_are_written(spark, tmp_path):
    """Files of several words of bits, words without a row that is taken, and a file without any."""
    values = ["a", " A ", "b\t", "B", "", None, " "]
    rows = [(i % 3, i, values[i * 5 % 7], values[i % 7], values[i * 3 % 7], "x" * (i % 50))
            for i in range(400)]
    rows += [(0, 400 + i, f"t{i // 150}", None, None, "y") for i in range(600)]
    columns = "cycle int, o int, title string, company string, location string, description string"
    spark.createDataFrame(rows, columns).coalesce(1).write.parquet(str(tmp_path / "w"))
    spark.createDataFrame([(*r[:1], r[1] + 5000, *r[2:]) for r in rows[:300]], columns) \
        .repartition(3).write.mode("append").parquet(str(tmp_path / "w"))
    written = spark.read.schema(columns).parquet(str(tmp_path / "w"))
    found = P.deduplicate_written(written, order=["o"], within=["cycle"])
    assert found.columns == written.columns
    want = P.deduplicate(written, order=["o"], within=["cycle"]).collect()
    assert sorted(found.collect(), key=lambda r: r["o"]) == sorted(want, key=lambda r: r["o"])
    assert P.deduplicate_written(written.where("o < 0"), order=["o"]).count() == 0
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "description" not in plan[plan.index("Aggregate"):].split("Relation")[0]


def test_sent_messages_are_the_postings(spark, tmp_path):
    done = collect(cycle(spark), FILTERS, F.lit(NOW))
    out = str(tmp_path / "sent")
    sent = sum(r["sent_total"] for r in done.send("files", out).collect())
    got = [json.loads(r["value"]) for r in spark.read.text(out).collect()]
    want = [r.asDict() for r in done.postings.select(*POSTING.fieldNames()).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and sent == len(got) > 0
    assert all(f.name.endswith(".gz") for f in (tmp_path / "sent").glob("part-*"))
    folder = done.fetched.inputFiles()
    assert folder and all(f.endswith(".zstd.parquet") for f in folder)


def test_iso_now_is_utc_whatever_the_session_says(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        row = spark.range(1).select(feeds.iso_now().alias("t"),
                                    F.unix_micros(F.current_timestamp()).alias("u")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert abs(dt.datetime.fromisoformat(row["t"]).timestamp() * 1e6 - row["u"]) < 2


def test_explicit_nulls_stay_and_absent_fields_get_defaults(spark):
    entry = {"position": None, "company": None, "description": "sde", "tags": None,
             "location": None, "url": None, "slug": None}
    rows = read(spark, "remoteok", [{}, entry, {"description": "sde"}], ["sde"], ["global"])
    shown = [(r["title"], r["company"], r["location"], r["url"], r["tags"]) for r in rows]
    assert shown == [(None, None, None, None, []),
                     ("Unknown", "Unknown", "Remote", "https://remoteok.com/remote-jobs/", [])]
    rows = read(spark, "adzuna", {"results": [
        {"title": None, "company": {"display_name": None}, "description": None, "redirect_url": None},
        {"company": None}]})
    assert [(r["title"], r["company"], r["description"], r["location"], r["url"], r["is_remote"])
            for r in rows] == [(None, None, None, "Unknown", None, False),
                               ("Unknown", "Unknown", "", "Unknown", "", False)]
    yes = [True, 1, 2.5, "no", "false", [0], {"a": 1}]
    no = [False, 0, 0.0, "", None, [], {}]
    rows = read(spark, "jsearch", {"data": [{"job_is_remote": x} for x in yes + no]})
    assert [r["is_remote"] for r in rows] == [True] * len(yes) + [False] * len(no)
    rows = read(spark, "arbeitnow", [{"title": None, "description": None}], ["none none"], ["global"])
    assert [r["title"] for r in rows] == [None]


def test_damaged_responses_are_listed_and_the_others_kept(spark, tmp_path):
    good = {"results": [{"title": "a"}, {"title": "b"}]}
    rows = landed(spark, ("c1", "adzuna", 0, "q", good), ("c1", "adzuna", 1, "q", json.dumps(good)[:-2]),
                  ("c1", "adzuna", 2, "q", {"results": None}), ("c1", "adzuna", 3, "q", {"other": 1}),
                  ("c1", "adzuna", 4, "q", {"results": [7, {"title": "c"}, None]}),
                  ("c2", "jsearch", 0, "q", "<html>busy</html>"), ("c2", "jsearch", 1, "q", ""),
                  ("c2", "remoteok", 0, "q", ["notice"]), ("c2", "remoteok", 1, "q", [{}, "x"]),
                  ("c2", "wellfound", 0, "q", " "), ("c2", "hackernews", 0, "q", [1]))
    done = collect(rows, CollectionFilters(["sde"], ["global"]), F.lit(NOW))
    assert sorted(r["title"] for r in done.postings.collect()) == ["a", "b", "c"]
    got = {(r["cycle"], r["source"], r["request"], r["pos"]): r["reason"] for r in done.rejected.collect()}
    assert got == {
        ("c1", "adzuna", 1, None): feeds.NOT_JSON, ("c1", "adzuna", 2, None): feeds.NO_LIST,
        ("c1", "adzuna", 4, 0): feeds.NO_OBJECT, ("c1", "adzuna", 4, 2): feeds.NO_OBJECT,
        ("c2", "jsearch", 0, None): feeds.NOT_JSON, ("c2", "jsearch", 1, None): feeds.EMPTY,
        ("c2", "remoteok", 1, 1): feeds.NO_OBJECT, ("c2", "wellfound", 0, None): feeds.EMPTY,
        ("c2", "hackernews", 0, None): feeds.NO_LIST}
    stats = {r["cycle"]: (r["fetched_total"], r["rejected_total"], r["by_source"]["adzuna"])
             for r in done.stats().collect()}
    assert stats == {"c1": (3, 4, 3), "c2": (0, 5, 0)}
