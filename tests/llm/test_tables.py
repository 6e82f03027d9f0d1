"""Operators that compare rows with each other, against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from jobsignal.llm import embeddings, mixing, simhash, url_trust
from jobsignal.llm.queries import QUERIES
from jobsignal.llm.tables import components, running_total, tiles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_reachable(vertices, pairs):
    low = {v: v for v in vertices}

    def root(v):
        while low[v] != v:
            v = low[v]
        return v

    for a, b in pairs:
        a, b = root(a), root(b)
        low[max(a, b)] = min(a, b)
    return {v: root(v) for v in vertices}


# Shared -------------------------------------------------------------------------------------


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(60)] + [(1000 + i, 1000) for i in range(200)] + \
        [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(250)] + [(5, 5)]
    got = components(spark.createDataFrame(pairs, "src long, dst long")).collect()
    want = smallest_reachable({v for p in pairs if p[0] != p[1] for v in p}, pairs)
    assert len(got) == len(want) and {r["id"]: r["component_id"] for r in got} == want


def test_running_total(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", None]), rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "i long, s string, n long").repartition(7)
    got = {r["i"]: r["before"] for r in running_total(df, ["i"], "n", "before").collect()}
    assert got == {i: sum(r[2] for r in rows[:i]) for i, _, _ in rows}
    got = {r["i"]: r["before"] for r in running_total(df, ["i"], "n", "before", "s").collect()}
    assert got == {i: sum(r[2] for r in rows[:i] if r[1] == s) for i, s, _ in rows}


def test_any_two_rows_of_a_group_meet_once(spark):
    df = spark.createDataFrame([("big", i) for i in range(300)] + [("small", i) for i in range(9)],
                               "g string, i long")
    met = Counter()
    by_tile = defaultdict(list)
    for r in tiles(df, ["g"], "i", 64).collect():
        by_tile[r["g"], r["tile_i"], r["tile_j"]].append((r["block"], r["i"]))
    for (g, i, j), members in by_tile.items():
        for x, a in members:
            for y, b in members:
                if x == i and y == j and (i != j or a < b):
                    met[g, min(a, b), max(a, b)] += 1
    assert len(met) == 300 * 299 // 2 + 9 * 8 // 2 and set(met.values()) == {1}


# SimHash ------------------------------------------------------------------------------------


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_groups(spark, sf_dir, rows):
    prints = [(d, plain_fingerprint(t or "")) for d, t, _ in rows]
    pairs = [(a, b) for a, x in prints for b, y in prints
             if a is not None and b is not None and (x ^ y).bit_count() <= 4]
    low = smallest_reachable({d for d, _ in prints if d is not None}, pairs)
    want = Counter((d, f"{p:016x}", None if d is None else low[d]) for d, p in prints)
    got = Counter(tuple(r) for r in QUERIES["op8_simhash_groups"](spark, sf_dir).collect())
    assert got == want


def close(a, b, radius):
    return {(i, j) for i, x in enumerate(a) for j, y in enumerate(b)
            if (int(x) ^ int(y)).bit_count() <= radius}


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 5, 7, 8, 10])
def test_bit_planes(radius):
    rng = np.random.default_rng(radius)
    right = rng.integers(0, 2**64, 130, dtype=np.uint64)
    left = np.array([int(x) ^ sum(1 << int(b) for b in rng.choice(64, d, replace=False))
                     for x in right for d in (0, radius, radius + 1, 9)], np.uint64)
    found = set()
    for a, b in simhash.close_pairs(left, right, radius):
        found |= set(zip(a.tolist(), b.tolist()))
    assert found == close(left, right, radius)


def test_links_reach_all_pairs_also_in_crowded_pools(spark, monkeypatch):
    rng = np.random.default_rng(4)
    center = int(rng.integers(0, 2**63))
    near = {center ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
            for _ in range(400)}
    prints = sorted(near | {int(x) for x in rng.integers(0, 2**64, 400, dtype=np.uint64)})
    monkeypatch.setattr(simhash, "BLOCK", 64)
    df = spark.createDataFrame([(i, p - (p >> 63 << 64)) for i, p in enumerate(prints)],
                               "id long, print long")
    want = smallest_reachable(range(len(prints)), close(prints, prints, 4))
    for bands in (None, 6):
        found = simhash.links(df, bands=bands).collect()
        assert bands or len(found) < 20 * len(prints)
        assert smallest_reachable(range(len(prints)), [tuple(r) for r in found]) == want


def test_bands_grow_with_the_fingerprints_and_lose_no_pair():
    assert [simhash.bands_for(n) for n in (0, 10**5, 10**8, 10**11)] == [5, 5, 6, 8]
    rng = np.random.default_rng(2)
    for bands in (5, 6, 8):
        choices = simhash.masks(4, bands)
        assert len(choices) == math.comb(bands, 4)
        for _ in range(200):
            differ = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(m & differ == 0 for m in choices)


# Embeddings ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(6)
    out = [v.tolist() for v in rng.standard_normal((250, 16))]
    for c in range(6):
        center = rng.standard_normal(16)
        out += [(center + rng.standard_normal(16) * s).tolist() for s in (.05, .1, .2, .3, .4) * 6]
    out += [out[3]] * 40 + [[2 * x for x in out[4]], [1e-30 * x for x in out[5]]]
    out += [None, [], [0.0] * 16, [None] + [1.0] * 15, [math.nan] + [1.0] * 15,
            [math.inf] + [1.0] * 15, [1.0] * 16, [1.0] * 8, [1.0] * 8, [-1.0] * 8]
    ids = rng.permutation(len(out)).tolist()
    return list(zip(ids, out)) + [(None, out[0])]


def test_near_duplicate_vectors(spark, vectors):
    good = {}
    for i, v in vectors:
        v = np.array([np.nan if x is None else x for x in v or []], float)
        if i is not None and len(v) and np.isfinite(v).all() and v.any():
            v = v / np.abs(v).max()
            good[i] = v / np.linalg.norm(v)
    pairs = [(a, b) for a in good for b in good if a != b and len(good[a]) == len(good[b])
             and good[a] @ good[b] >= 0.9 - 1e-12]
    n = Counter(a for a, _ in pairs)
    low = smallest_reachable([i for i, _ in vectors if i is not None], pairs)
    want = Counter((i, n[i], None if i is None else low[i], i is not None and low[i] == i)
                   for i, _ in vectors)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    for search in (embeddings.Search(), embeddings.Search(block=16)):  # one bucket: exact
        assert Counter(tuple(r) for r in
                       embeddings.near_duplicates(df, search).collect()) == want
    assert len(pairs) > 2000
    several = embeddings.near_duplicates(df, embeddings.Search(bucket=16, block=16)).collect()
    assert all(r["n_links"] <= n[r["vec_id"]] for r in several)
    assert sum(r["n_links"] for r in several) >= 0.99 * len(pairs)


@pytest.mark.parametrize("width", [2, 16, 64, 300])
def test_links_are_exact_in_many_blocks(spark, width):
    """Pairs just above and just below the threshold, in tables of more than 1024 vectors."""
    rng = np.random.default_rng(width)
    a = embeddings._units(rng.standard_normal((700, width)))
    b = rng.standard_normal((700, width))
    b = embeddings._units(b - (a * b).sum(1, keepdims=True) * a)
    c = rng.choice([0.8999, 0.9001, 0.905], (700, 1))
    units = np.concatenate([a, c * a + np.sqrt(1 - c * c) * b])
    linked = units @ units.T >= 0.9
    df = spark.createDataFrame(list(enumerate(units.tolist())), "vec_id long, embedding array<double>")
    for search in (embeddings.Search(bucket=64), embeddings.Search(bucket=64, block=64, error=0.5)):
        got = embeddings.near_duplicates(df, search).collect()
        assert {r["vec_id"]: r["n_links"] for r in got} == dict(enumerate(linked.sum(1) - 1))


def test_estimates_are_unbiased_and_their_bounds_hold():
    rng = np.random.default_rng(8)
    left, right = (embeddings._units(rng.standard_normal((400, 64))) for _ in range(2))
    right[:200] = embeddings._units(left[:200] + 0.06 * right[:200])
    turn = embeddings.rotation(64, 1)
    assert np.allclose(turn @ turn.T, np.eye(64))
    _, bits, factors = embeddings.codes(left, turn)
    guess, bound = embeddings.estimates(bits, factors, right @ turn.T, 5.0)
    error = guess - left @ right.T
    assert abs(error.mean()) < 0.002 and (np.abs(error) > bound).mean() < 1e-4
    near = left @ right.T >= 0.9
    assert near.sum() > 100 and (np.abs(error)[near] < 0.7 * bound.repeat(400, 1)[near]).all()
    assert 0.05 < error.std() < 0.15


def test_recall_at_the_threshold():
    search = embeddings.Search()
    rng = np.random.default_rng(9)
    a = embeddings._units(rng.standard_normal((3000, 64)))
    b = rng.standard_normal((3000, 64))
    b = embeddings._units(b - (a * b).sum(1, keepdims=True) * a)
    b = 0.9 * a + math.sqrt(1 - 0.81) * b
    for n in (10**4, 10**6):
        bits = search.bits(n, 64)
        met = np.zeros(len(a), bool)
        for t in range(search.rotations(bits)):
            turn = embeddings.rotation(64, search.seed + 1 + t)[:bits]
            met |= ((a @ turn.T >= 0) == (b @ turn.T >= 0)).all(axis=1)
        assert met.mean() > 0.98


# Hosts --------------------------------------------------------------------------------------


def test_url_rules(spark):
    urls = {
        "http://A.com/x": ("a.com", "/x", "com/", "allow"),
        "http://com/": ("com", "/", "com/", "allow"),
        "http://com": ("com", "", None, "allow"),
        "x://www.example.com/en/1?q#f": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "x://m.www.example.com/en/": ("m.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "x://wwwexample.com/en/": ("wwwexample.com", "/en/", "com/", "allow"),
        "x://EXAMPLE.com/en/?a": ("example.com", "/en/", "example.com/en/", "block"),
        "x://b.net/es/y": ("b.net", "/es/y", "net/es/", "block"),
        "x://b.net?/es/": ("b.net", "", None, "allow"),
        "x://ÄB.net/fr/\n#": ("Äb.net", "/fr/\n", "net/fr/", "block"),
        "no host": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "x:///en/": ("", "/en/", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)],
                                  "page_id long, url string, html string")
    got = {r["page_id"]: tuple(r)[1:] for r in url_trust.judged_pages(pages).collect()}
    assert got == dict(enumerate(urls.values()))


def plain_blocked(pages):
    """Hosts that distrust takes, with dictionaries."""
    def host(url):
        m = re.search(r"://([^/?#]*)", url or "")
        return m[1].lower() if m else ""

    rules = {"good.com": "allow", "sub.good.com": "allow", "bad.net": "block"}
    count = defaultdict(Counter)
    links = Counter()
    for _, url, html in pages:
        h = host(url)
        if not h:
            continue
        count[h][rules.get(h)] += 1
        for dst in re.findall(url_trust.LINKED_HOST, html or ""):
            if dst.lower() != h:
                links[h, dst.lower()] += 1
    for h in count:
        parent = h.partition(".")[2]
        if parent in count:
            links[h, parent] += 1
            links[parent, h] += 1
    result = {}
    for kind, verdict in (("trust", "allow"), ("distrust", "block")):
        edges = links if kind == "trust" else Counter({(b, a): n for (a, b), n in links.items()})
        out = Counter()
        for (a, _), n in edges.items():
            out[a] += n
        start = {h: c[verdict] for h, c in count.items() if 2 * c[verdict] > sum(c.values())}
        total = sum(start.values())
        start = {h: n / total for h, n in start.items()}
        state = dict(start)
        for _ in range(10):
            new = Counter({h: 0.15 * s for h, s in start.items()})
            for (a, b), n in edges.items():
                new[b] += 0.85 * state.get(a, 0) * n / out[a]
            state = new
        result[kind] = state
    return {h for h in {*result["trust"], *result["distrust"]}
            if round(result["distrust"].get(h, 0), 12) > 0.5 * (
                round(result["distrust"].get(h, 0), 12) + round(result["trust"].get(h, 0), 12))}


def test_trust_and_distrust_reach_other_hosts(spark):
    rng = random.Random(3)
    hosts = ["good.com", "sub.good.com", "bad.net", *[f"h{i}.org" for i in range(30)],
             "a.h1.org", "b.a.h1.org"]
    pages = []
    for i in range(300):
        h = rng.choice(hosts)
        near = [hosts[(hosts.index(h) * 7 + k) % len(hosts)] for k in (1, 2)]
        html = " ".join(f'<a HREF="https://{x}/p?q">' for x in near) + "<a href='/local'><a href=x>"
        path = "/es/1" if h == "bad.net" else "/p"
        pages.append((i, f"http://{h}{path}", rng.choice([html, html, None])))
    pages.append((300, "http://h5.org/z", '<a href=//BAD.net/es/ x>' * 50))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    bad = plain_blocked(pages)
    assert bad - {"bad.net"} and set(hosts) - bad
    for r in url_trust.judged_pages(df).collect():
        expected = r["rule"] and ("block" if r["rule"].startswith("net") else "allow") or \
            ("block" if r["host"] in bad else "allow")
        assert r["verdict"] == expected, r


@pytest.mark.parametrize("hops, leaves", [(9, 20), (15, 0)])  # small scores; a long way
def test_distrust_alone_reaches_far_hosts(spark, hops, leaves):
    chain = ["bad.net", *[f"h{i}.org" for i in range(hops)]]
    pages = [("http://bad.net/es/1", None)]
    for near, far in zip(chain, chain[1:]):
        pages += [(f"http://{h}/p", f"<a href='//{near}/x'>")
                  for h in (far, *[f"l{i}-{far}" for i in range(leaves)])]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)],
                               "page_id long, url string, html string")
    got = url_trust.judged_pages(df).collect()
    assert len(got) == len(pages) and {r["verdict"] for r in got} == {"block"}


# Mixing -------------------------------------------------------------------------------------


def plain_targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + \
        [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_ = 1.5 * sum(sizes.values()), set(names)
    target = {}
    while open_:
        shares = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / shares > 2 * sizes[s]}
        if not above:
            target |= {s: left * weight[s] / shares for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in above}
        left -= sum(2 * sizes[s] for s in above)
        open_ -= above
    return target


def test_mixing(spark, sf_dir, rows):
    query = QUERIES["op7_block_mixing"]
    got = [tuple(r) for r in query(spark, sf_dir).collect()]
    assert Counter(got) == Counter(tuple(r) for r in query(spark, sf_dir).collect())
    size = Counter()
    docs = Counter()
    for d, t, s in rows:
        n = len(WORD.findall(t or ""))
        size[s] += n
        docs[d, n, s] += 1
    target = plain_targets(size)
    assert Counter((d, n, size_, round(x, 6)) for d, n, size_, x, _ in got) == Counter(
        {(d, n, size[s], round(target[s], 6)): k for (d, n, s), k in docs.items()})
    assert all(0 <= took <= 2 * n for _, n, _, _, took in got)
    by_target = Counter()
    for _, _, total, x, took in got:
        by_target[total, x] += took
    assert all(abs(took - x) <= 2 * mixing.Mix().block_words for (_, x), took in by_target.items())


def test_pieces_are_the_blocks_of_the_slots(spark):
    rng = random.Random(5)
    docs = [(i, rng.choice(["a", "b", None]), rng.choice([0, 1, 3, 40])) for i in range(200)]
    mix = mixing.Mix(block_words=8, shard_blocks=16)
    placed, targets, pieces = mixing.mixture(
        spark.createDataFrame(docs, "doc_id long, source string, size long"), mix)
    draws = {r["source"]: (r["draws"], r["blocks"]) for r in targets.collect()}
    stream = {s: [(i, k) for i, x, n in docs if x == s for k in range(n)] for s in draws}
    slots = defaultdict(list)
    shards = set()
    for r in pieces.collect():
        slots[r["source"], r["slot"]].append((r["doc_id"], r["first"], r["last"]))
        shards.add(r["shard"])
    assert len(shards) > 10
    used = defaultdict(Counter)
    for (s, slot), parts in slots.items():
        words = [(d, k) for d, a, b in sorted(parts) for k in range(a, b)]
        at = stream[s].index(words[0])
        assert at % 8 == 0 and words == stream[s][at:at + 8]
        used[s][at // 8] += 1
    for s, (n, blocks) in draws.items():
        assert sum(used[s].values()) == n
        assert set(used[s].values()) <= {n // blocks, -(-n // blocks)}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 100, 4097])
def test_permutations(n):
    a, b = (mixing.permuted(np.arange(n), n, [42, k]) for k in (1, 2))
    assert sorted(a) == sorted(b) == list(range(n))
    assert n < 60 or (a != b).mean() > 0.9
