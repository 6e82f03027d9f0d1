import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import model
from jobsignal.dictionaries import BASIC, POSTINGS
from jobsignal.operators import market as M
from jobsignal.operators.requests import CollectionFilters
from jobsignal.plans import status
from jobsignal.schema import POSTING
from jobsignal.session import CHECKPOINT_DIR, working_folder
from jobsignal.sources import messages
from jobsignal.sources.resumes import read_resume_texts, read_stored_resumes, read_stored_users
from jobsignal.sources.store import DemandStore
from jobsignal.streaming import processor, trends

JOBS = [
    ("Python dev", "a", "python and sql, C++11", "s1"),
    ("Java dev", "b", "java, javascript", "s2"),
    ("Python lead", "c", None, None),
    (None, None, "go go go", "s1"),
]


def message(row):
    if isinstance(row, str):
        return row
    fields = dict(zip(("title", "company", "description", "source"), row, strict=True))
    return json.dumps({**fields, "tags": ["x"], "is_remote": True, "salary": 5.0,
                       "timestamp": "2024-01-01T00:00:00+00:00"})


def write_messages(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(message(r) + "\n" for r in rows))


def expected_demand(rows):
    out = {}
    for r in rows:
        if isinstance(r, str):
            continue
        text = "".join(f"{p.lower()} " for p in (r[0], r[2]) if p)
        for k, n in model.count_mentions(text, POSTINGS).items():
            out[k] = out.get(k, 0) + n
    return out


def run(spark, base, **options):
    store = DemandStore(spark, str(base / "store"))
    stream = messages.message_stream(spark, "files", str(base / "in"), maxFilesPerTrigger="1")
    processor.start(stream, store, str(base / "checkpoint"), trigger=None, name="t",
                    **options).awaitTermination()
    return store


def demand_of(store):
    return {r["skill"]: r["count"] for r in M.market_demand(store.skill_demand()).collect()}


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    write_messages(tmp_path / "in", "1.json", JOBS[:2])
    write_messages(tmp_path / "in", "2.json", [*JOBS[2:], "{broken"])
    store = run(spark, tmp_path)
    assert demand_of(store) == expected_demand(JOBS)
    assert store.raw_jobs().count() == 5  # the broken message is kept as a row of nulls
    assert store.raw_jobs().where("source is null").count() == 2
    run(spark, tmp_path)  # nothing new: nothing is added
    assert demand_of(store) == expected_demand(JOBS)
    write_messages(tmp_path / "in", "3.json", JOBS[:1])
    run(spark, tmp_path)
    assert demand_of(store) == expected_demand([*JOBS, JOBS[0]])
    newest = M.latest_batch_demand(store.latest_demand()).collect()
    assert {r["skill"]: r["count"] for r in newest} == expected_demand(JOBS[:1])
    batches = {r["batch_id"] for r in store.skill_demand().select("batch_id").collect()}
    assert batches == {0, 1, 2}


def test_repeated_batch_replaces_itself(spark, tmp_path):
    store = DemandStore(spark, str(tmp_path))
    rows = spark.createDataFrame(JOBS, "title string, company string, description string, source string")
    batch = messages.with_processing_time(rows)
    write = processor.batch_writer(store)
    for batch_id in (0, 1, 1, 0):
        write(batch, batch_id)
    assert store.raw_jobs().count() == 8
    assert demand_of(store) == {k: 2 * n for k, n in expected_demand(JOBS).items()}
    write(batch.limit(0), 2)
    assert store.raw_jobs().where("batch_id = 2").count() == 0


def test_a_new_checkpoint_keeps_what_is_stored(spark, tmp_path):
    write_messages(tmp_path / "one" / "in", "1.json", JOBS[:2])
    write_messages(tmp_path / "two" / "in", "1.json", JOBS[2:])
    store = DemandStore(spark, str(tmp_path / "store"))
    for name in ("one", "two", "one"):
        stream = messages.message_stream(spark, "files", str(tmp_path / name / "in"))
        processor.start(stream, store, str(tmp_path / name / "checkpoint"), trigger=None,
                        name=name).awaitTermination()
    assert demand_of(store) == expected_demand(JOBS)
    assert store.raw_jobs().count() == len(JOBS)


def test_what_a_failed_attempt_left_is_not_seen(spark, tmp_path):
    store = DemandStore(spark, str(tmp_path))
    rows = spark.createDataFrame([("A", 1), ("B", 2)], "skill string, count long")
    store.write_demand(rows, 0, run_id="r")
    stray = spark.read.parquet(store.demand_path).withColumn("attempt", F.lit("lost"))
    stray.write.partitionBy("date").parquet(str(tmp_path / "stray"))
    spark.read.parquet(str(tmp_path / "stray")).write.mode("append").partitionBy("date") \
        .parquet(store.demand_path)
    assert demand_of(store) == {"A": 1, "B": 2}
    store.write_demand(rows.where("skill = 'A'"), 0, run_id="r")
    store.write_demand(rows, 0, run_id="other")
    assert demand_of(store) == {"A": 2, "B": 2}


def test_folders_follow_dates_and_a_closed_day_is_compacted(spark, tmp_path):
    store = DemandStore(spark, str(tmp_path))
    jobs = messages.with_processing_time(spark.createDataFrame(
        JOBS, "title string, company string, description string, source string"))
    rows = spark.createDataFrame([("A", 1), ("B", 2)], "skill string, count long")
    for batch in range(5):
        day = F.lit(f"2024-01-0{1 + batch // 3} 10:00:00").cast("timestamp")
        store.write_demand(rows, batch, day)
        store.write_demand(rows, batch, day)  # repeated
        store.write_raw(jobs.withColumn("date", day.cast("date")), batch)

    def files(pattern):
        return sorted(str(p.relative_to(tmp_path)) for p in tmp_path.glob(pattern))

    assert files("skill_demand/date=*") == [
        "skill_demand/date=2024-01-01", "skill_demand/date=2024-01-02"]
    assert len(files("raw_jobs/date=*/source=*")) == 6
    before, raw = demand_of(store), store.raw_jobs().count()
    assert before == {"A": 5, "B": 10} and raw == 20
    many = len(files("skill_demand/date=2024-01-01/*.parquet"))
    store.compact("2024-01-01")
    assert len(files("skill_demand/date=2024-01-01/*.parquet")) == 1 < many
    assert len(files("skill_demand_commits/date=2024-01-01/*.parquet")) == 1
    assert demand_of(store) == before and store.raw_jobs().count() == raw
    assert {r["skill"]: r["count"] for r in store.latest_demand().collect()} == {"A": 1, "B": 2}
    store.write_demand(rows, 9)
    assert demand_of(store) == {"A": 6, "B": 12}


def market_of(store):
    return {r["skill"]: r["count"] for r in store.market().collect()}


def days_of_batches(spark, folder, per_day, days=3):
    """A store with so many batches on each day, every skill of batch b counted b + 1 times."""
    store = DemandStore(spark, str(folder))
    for d in range(days):
        rows = spark.range(per_day).selectExpr(
            f"explode(array('A', 'B', 'd{d}')) AS skill", "id + 1 AS count", f"id + {d * per_day} AS b")
        stamp = F.lit(f"2024-01-0{d + 1} 10:00:00").cast("timestamp")
        store.write_demand(rows, F.col("b"), stamp, "r")
    return store


def test_closing_keeps_the_market_and_bounds_what_a_read_opens(spark, tmp_path):
    opened = []
    for per_day in (2, 12):
        store = days_of_batches(spark, tmp_path / str(per_day), per_day)
        want, newest = demand_of(store), sorted(map(tuple, store.latest_demand().select("skill", "count").collect()))
        assert market_of(store) == want and want["A"] == 3 * per_day * (per_day + 1) // 2
        store.close("2024-01-02")
        assert market_of(store) == demand_of(store) == want
        rollup = store._rollup()
        assert str(rollup["until"]) == "2024-01-02"
        assert sorted(map(tuple, store.latest_demand().select("skill", "count").collect())) == newest
        store.close("2024-01-03")
        opened.append((store._log(store.demand_path).count(),
                       spark.read.parquet(store._rollup()["folder"]).count()))
        assert market_of(store) == demand_of(store) == want
        assert sorted(map(tuple, store.latest_demand().select("skill", "count").collect())) == newest
    # a record per closed day and a row per skill, whatever the number of batches
    assert opened == [(3, 5), (3, 5)]


def test_batches_after_closing_count_once(spark, tmp_path):
    store = days_of_batches(spark, tmp_path, 3)
    store.close("2024-01-02")
    want = demand_of(store)
    one = spark.createDataFrame([("A", 100)], "skill string, count long")
    stamp = F.lit("2024-01-01 11:00:00").cast("timestamp")
    store.write_demand(one, 0, stamp, "late")  # another run's batch on a closed day
    want = want | {"A": want["A"] + 100}
    assert market_of(store) == demand_of(store) == want and store._rollup() is None
    store.write_demand(one, 1, stamp, "r")  # stands in for a closed batch with counts of 2
    want = want | {"A": want["A"] + 98, "B": want["B"] - 2, "d0": want["d0"] - 2}
    assert market_of(store) == demand_of(store) == want
    store.close("2024-01-02")
    assert market_of(store) == demand_of(store) == want and store._rollup() is not None
    store.write_demand(one, 50, F.lit("2024-01-04 11:00:00").cast("timestamp"), "r")
    want = want | {"A": want["A"] + 100}
    assert market_of(store) == demand_of(store) == want and store._rollup() is not None


@pytest.mark.parametrize("step", ["skill_demand", "skill_demand_commits", "rollup", "record"])
def test_closing_may_be_interrupted_anywhere(spark, tmp_path, monkeypatch, step):
    from jobsignal.sources import store as module

    store = days_of_batches(spark, tmp_path, 3)
    want = demand_of(store)
    real = module._partitioned

    def failing(df, path, *rest):
        if path.endswith(step):
            raise OSError("lost")
        real(df, path, *rest)

    monkeypatch.setattr(module, "_partitioned", failing)
    if step in ("rollup", "record"):
        target = "parquet" if step == "rollup" else "mode"
        writer = type(spark.range(1).write)
        whole = getattr(writer, target)
        seen = []

        def broken(self, *a, **k):
            if target == "mode" or "_rollup/" in a[0]:
                seen.append(a)
                if target == "parquet" or a == ("append",):
                    raise OSError("lost")
            return whole(self, *a, **k)

        monkeypatch.setattr(writer, target, broken)
    with pytest.raises(OSError):
        store.close("2024-01-02")
    monkeypatch.undo()
    assert market_of(store) == demand_of(store) == want
    store.close("2024-01-02")
    assert market_of(store) == demand_of(store) == want and store._rollup() is not None


def test_late_and_repeated_postings_of_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    batches = [[("a", "2024-06-01"), ("a", "2024-06-02")], [("b", "2020-01-01"), ("a", "2025-01-01")],
               [("c", None), ("b", "2026-01-01")]]
    for i, rows in enumerate(batches):
        spark.createDataFrame([(t, "x", "y", d) for t, d in rows], "title string, company string, "
                              "location string, timestamp string").coalesce(1) \
            .write.mode("append").parquet(str(source))
        kept = trends.deduplicate_stream(spark.readStream.schema(
            "title string, company string, location string, timestamp string")
            .parquet(str(source)), "10 days")
        kept.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")) \
            .trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    got = sorted(r["title"] for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == ["a", "b", "c"]


def test_missing_filter_file_gives_the_defaults(spark, tmp_path):
    assert CollectionFilters.load(spark, str(tmp_path / "none.json")) == CollectionFilters()


def test_fallback_stream_counts_postings(spark, tmp_path):
    write_messages(tmp_path / "in", "1.json", JOBS)
    store = run(spark, tmp_path, dictionary=BASIC, fallback=True)
    texts = ["".join(f"{p.lower()} " for p in (r[0], r[2]) if p) for r in JOBS]
    want = {t: sum(t in x for x in texts) for t in BASIC.terms}
    assert demand_of(store) == {k: v for k, v in want.items() if v}
    latest = {r["skill"] for r in M.latest_batch_demand(store.latest_demand()).collect()}
    assert "Python" in latest and "Javascript" not in latest


def test_market_sources(spark, tmp_path):
    store = DemandStore(spark, str(tmp_path / "new"))
    empty, source = M.market_skills(store)
    assert (empty.count(), source) == (0, "none")
    latest = spark.createDataFrame([("A", 1), ("B", 2)], "skill string, count long")
    rows, source = M.market_skills(store, 1, latest)
    assert ([r["skill"] for r in rows.collect()], source) == (["B"], "in-memory")
    assert tuple(status.system_stats(store).first()) == (0, 0)
    store.write_demand(latest, 4)
    store.write_demand(latest.where("skill = 'A'"), 7)
    rows, source = M.market_skills(store, 5)
    assert (list(map(tuple, rows.collect())), source) == ([("A", 2), ("B", 2)], "parquet")
    assert tuple(status.system_stats(store).first()) == (0, 1)
    many = spark.range(60).selectExpr("concat('s', id) skill", "id + 1 count")
    store.write_demand(many, 8)
    assert tuple(status.system_stats(store).first()) == (0, 60)
    chart = M.chart(rows).first()
    assert (chart["skills"], chart["counts"], chart["total"]) == (["A", "B"], [2, 2], 2)


@pytest.mark.parametrize("name", ["node.js", "neo4j", "CI/CD", "a1b c", "Machine Learning", "c++"])
def test_title_case(spark, name):
    row = spark.createDataFrame([(name,)], "n string").select(M.title_case(F.col("n")).alias("t"))
    assert row.first()["t"] == name.title()


def test_published_messages_read_back(spark, tmp_path):
    row = {"title": "t", "company": None, "description": "d", "source": "s", "location": None,
           "salary": "5", "url": "u", "tags": ["a"], "is_remote": True, "timestamp": "x"}
    df = spark.createDataFrame([row], POSTING)
    assert messages.publish(df, "files", str(tmp_path / "out")) == 1
    assert messages.publish(df.limit(0), "files", str(tmp_path / "none")) == 0
    sent = spark.read.text(str(tmp_path / "out"))
    assert json.loads(sent.first()["value"]) == row
    back = messages.parse_messages(sent).first().asDict()
    assert back == {k: v for k, v in row.items() if k not in ("tags", "is_remote")}
    with pytest.raises(ValueError):
        messages.publish(df, "pigeon", "x")
    with pytest.raises(ValueError):
        messages.message_stream(spark, "pigeon", "x")


def test_corrupt_messages_and_event_time(spark):
    df = spark.createDataFrame([("{broken",), ('{"title":"a","timestamp":"2024-01-02T03:04:05Z"}',)],
                               "value string")
    plain = messages.parse_messages(df).collect()
    assert all(v is None for v in plain[0]) and plain[1]["title"] == "a"
    rows = messages.with_event_time(messages.parse_messages(df, flag_corrupt=True)).collect()
    assert [r[messages.CORRUPT] for r in rows] == ["{broken", None]
    assert rows[0]["event_time"] is None
    assert rows[1]["event_time"] == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_trend_of_a_stream_equals_that_of_a_table(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, d, h), s, n) for d in (1, 2, 5) for h in (0, 23)
            for s, n in (("A", d), ("B", 1))]
    df = spark.createDataFrame(rows, "timestamp timestamp, skill string, count long")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    batch = sorted(map(tuple, trends.skill_trend(df).collect()))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = (trends.skill_trend(stream).writeStream.format("memory").queryName("trend")
             .outputMode("complete").option("checkpointLocation", str(tmp_path / "cp"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(map(tuple, spark.table("trend").collect())) == batch
    assert len(batch) == 6 and sum(r[2] for r in batch) == 22


def test_collection_status(spark, tmp_path):
    filters = CollectionFilters(("a",))
    row = status.collection_status(spark, filters, str(tmp_path / "none")).first()
    assert row["filters"]["categories"] == ["a"] and row["collector_metrics"] is None
    (tmp_path / "m.json").write_text(
        '{"timestamp":"2024","fetched_total":3,"by_source":{"x":3}}\n{"timestamp":"2023"}\n')
    row = status.collection_status(spark, filters, str(tmp_path / "m.json")).first()
    assert row["collector_metrics"]["fetched_total"] == 3
    assert row["collector_metrics"]["by_source"] == {"x": 3}


def test_resume_files(spark, tmp_path):
    (tmp_path / "texts").mkdir()
    (tmp_path / "texts" / "a.pdf").write_text("Python\nSQL")
    row = read_resume_texts(spark, str(tmp_path / "texts")).first()
    assert row["file_path"].endswith("a.pdf") and row["text"] == "Python\nSQL"
    (tmp_path / "r.json").write_text('{"resume_id": "1",\n "skills": ["a"], "text": "t"}')
    (tmp_path / "u.json").write_text('{"user_id": "1",\n "total_uploads": 2}')
    assert read_stored_resumes(spark, str(tmp_path / "r.json")).first()["skills"] == ["a"]
    assert read_stored_users(spark, str(tmp_path / "u.json")).first()["total_uploads"] == 2


def test_working_folder_is_below_the_shared_one(spark):
    shared = spark.conf.get(CHECKPOINT_DIR)
    first, second = working_folder(spark, "x"), working_folder(spark, "x")
    assert first.startswith(shared) and first != second
