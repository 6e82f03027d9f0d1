import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from jobsignal.operators import similarity

SCHEMA = "resume_id long, skills array<string>, class_id string, n string"


def rows(rng, n=220, vocabulary=60):
    """Skill lists with hot skills, copies, near copies, odd case, repeats, nulls and empty ones."""
    out = []
    for i in range(n):
        base = [f"S{int(vocabulary * rng.random() ** 3)}" for _ in range(rng.randint(0, 14))]
        out.append((i, rng.choice([base, ["python", "sql", *base], ["python", "sql"]])))
    out += [(n + i, [s.upper() for s in reversed(out[7 * i][1])] * 2) for i in range(20)]
    out += [(500 + i, ["hot"]) for i in range(80)] + [(600, None), (601, []), (602, [None, "hot"]),
                                                      (None, ["hot"]), (7, ["extra"]), (7, ["extra"])]
    return [(i, s, "?", "?") for i, s in out]


def plain(given):
    sets = {}
    for i, skills, *_ in given:
        if i is not None:
            sets.setdefault(i, set()).update(s.lower() for s in skills or [] if s is not None)
    low = {}
    for i, s in sorted(sets.items()):
        low.setdefault(frozenset(s), i)
    return sets, low


@pytest.mark.parametrize("threshold", [0.15, 0.5, 2 / 3, 0.8, 1.0])
def test_all_pairs_equal_brute_force(spark, threshold):
    given = rows(random.Random(threshold))
    sets, low = plain(given)
    want = set()
    for (a, i), (b, j) in combinations(low.items(), 2):
        if (a or b) and len(a & b) / len(a | b) >= threshold:
            want.add((min(i, j), max(i, j), len(a & b), len(a & b) / len(a | b)))
    df = spark.createDataFrame(given, SCHEMA).repartition(5)
    got = [tuple(r) for r in similarity.similar_sets(df, threshold).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    members = {r.resume_id: (r.class_id, r.members) for r in similarity.skill_sets(df).collect()}
    sizes = [frozenset(s) for s in sets.values()]
    assert members == {i: (low[frozenset(s)], sizes.count(frozenset(s))) for i, s in sets.items()}


def test_candidates_are_few(spark):
    """2000 sets of ten among which 40 are near copies, and a third of them with two hot skills."""
    rng = random.Random(5)
    sets = [{f"s{rng.randrange(3000)}" for _ in range(10)} | ({"python", "sql"} if i % 3 else set())
            for i in range(2000)]
    sets += [s - {min(s)} for s in sets[:40]]
    df = spark.createDataFrame([(i, list(s)) for i, s in enumerate(sets)],
                               "resume_id long, skills array<string>")
    classes = similarity._classes(similarity._keyed(df, "resume_id", "skills"), "resume_id")
    pairs = similarity.candidates(similarity.prefixes(classes, 0.7), 0.7).count()
    found = similarity.similar_sets(df, 0.7).count()
    assert found >= 40 and pairs < 4 * len(sets)  # of two million pairs


def test_thresholds_and_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert similarity.similar_sets(none, 0.5).collect() == []
    assert similarity.skill_sets(none).collect() == []
    for bad in (0, -1, 1.5):
        with pytest.raises(ValueError):
            similarity.similar_sets(none, bad)


def test_no_pairs_of_all_rows(spark):
    df = spark.range(50).select(F.col("id").alias("resume_id"), F.array(F.col("id").cast("string"))
                                .alias("skills"))
    plan = similarity.similar_sets(df, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
