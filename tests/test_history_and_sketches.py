import random

from pyspark.sql import functions as F

from jobsignal.operators import distinct
from jobsignal.operators.bitmap import bitmap, bits_for, hashed, may_contain
from jobsignal.operators.history import PostingHistory

SCHEMA = "id long, title string, company string, location string, source string, fresh string"


def cycles(n=3, size=150):
    """Postings of cycles with repeats inside and across them, odd case and nulls."""
    rng = random.Random(9)
    out = {}
    for c in range(n):
        rows = []
        for i in range(size):
            title = rng.choice([f"T{rng.randint(0, 80)}", f" t{rng.randint(0, 80)} ", None, "hot"])
            rows.append((c * size + i, title, rng.choice(["A", "a", None]), rng.choice(["x", ""]), "s", "?"))
        out[f"c{c}"] = rows
    return out


def key(row):
    return tuple((v or "").strip().lower() for v in row[1:4])


def test_each_posting_is_new_once(spark, tmp_path):
    history = PostingHistory(spark, str(tmp_path))
    given, known, seen = cycles(), set(), {}
    for again in (False, True):  # a cycle that is added again replaces itself
        for cycle, rows in given.items():
            df = spark.createDataFrame(rows, SCHEMA).repartition(3)
            new = [tuple(r) for r in history.add(df, cycle, ("id",)).collect()]
            first = {}
            for r in rows:
                first.setdefault(key(r), r)
                seen.setdefault(key(r), set()).add(cycle)
            if not again:
                assert sorted(new) == sorted(r for k, r in first.items() if k not in known)
                known |= first.keys()
    got = {tuple(r)[:3]: (r.first_cycle, r.last_cycle, r.cycles) for r in history.seen().collect()}
    assert got == {k: (min(c), max(c), len(c)) for k, c in seen.items()}
    per_cycle = {r.cycle: (r.postings, r.new) for r in history.new_by_cycle().collect()}
    assert sum(new for _, new in per_cycle.values()) == len(known)
    assert per_cycle["c0"][0] == per_cycle["c0"][1] and per_cycle["c2"][1] < per_cycle["c2"][0]


def test_only_postings_that_may_match_are_joined(spark, tmp_path):
    history = PostingHistory(spark, str(tmp_path))
    many = spark.range(20_000).selectExpr("id", "concat('t', id) title", "'a' company", "'x' location")
    history.add(many, "c0", ("id",))
    keys = many.where("id < 10").selectExpr("concat('t', id) _title", "'a' _company", "'x' _location")
    assert 10 <= history._known(keys, "c1").count() < 3000
    none = history.add(many.limit(0), "c1", ("id",))
    assert none.count() == 0 and history.seen().count() == 20_000


def test_bitmaps_hold_their_keys_and_little_else(spark):
    for n in (0, 1, 500, 3000):
        bits = bits_for(n)
        key = hashed(F.concat(F.lit("k"), "id"), F.lit("x")).alias("k")
        asked = spark.range(2 * n + 10).select(key, "id").crossJoin(
            bitmap(spark.range(n).select(key), "k", bits))
        found = {r.id for r in asked.where(may_contain(F.col("bitmap"), F.col("k"), bits)).collect()}
        assert set(range(n)) <= found and len(found) <= n + 0.04 * (n + 10) + 2
    assert bits_for(10 ** 12) == 1 << 24


def test_sketches_add_up(spark):
    n = 40_000
    rows = spark.range(n).selectExpr(
        "concat('t', id % 9000) title", "'a' company", "cast(null as string) location",
        "concat('s', id % 3) source", "id % 7 batch")
    sketches = distinct.posting_sketches(rows, ["source", "batch"])
    whole = distinct.merged(sketches).select("rows", distinct.estimate().alias("n")).first()
    once = distinct.posting_sketches(rows, []).select(distinct.estimate().alias("n")).first()
    assert whole.rows == n and abs(whole.n - once.n) <= 0.02 * 9000
    assert abs(whole.n - 9000) <= 3 * distinct.STANDARD_ERROR * 9000
    exact = {r.source: r.distinct for r in distinct.distinct_postings(rows, ["source"]).collect()}
    for r in distinct.merged(sketches, ["source"]).select("source", distinct.estimate().alias("n")).collect():
        assert abs(r.n - exact[r.source]) <= 3 * distinct.STANDARD_ERROR * exact[r.source]
    again = distinct.merged(sketches.unionByName(sketches), []).select(distinct.estimate()).first()[0]
    assert again == whole.n
    none = distinct.merged(sketches.limit(0)).select("rows", distinct.estimate().alias("n")).first()
    assert tuple(none) == (0, 0)
    skills = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3)], "skill string, count long")
    assert distinct.skill_sketches(skills, []).select(distinct.estimate()).first()[0] == 2
