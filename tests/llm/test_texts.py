"""Operators that judge each text by itself, against plain versions."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from jobsignal.llm import byte_bpe, licenses, pii, repetition, secrets, token_files
from jobsignal.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def got(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", sorted(set(QUERIES)))
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


# Secrets ------------------------------------------------------------------------------------


def secret_spans(text):
    found = []
    for m in re.finditer(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*"""
                         r"""["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            found.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 32:
            found.append((m.start(), 2, "hex", m.end()))
    return [(k, a, b) for a, _, k, b in sorted(found)]


def test_secrets(spark, sf_dir, rows):
    want = Counter()
    for d, t, _ in rows:
        spans = secret_spans(t or "")
        n = Counter(k for k, _, _ in spans)
        want[d, n["assign"], n["access"], n["hex"], sha(joined(spans)), joined(spans)] += 1
    assert got(QUERIES["op1_secret_scan"](spark, sf_dir)) == want
    assert any(secret_spans(t or "") for _, t, _ in rows)


def test_secret_ledger_scans_only_what_is_new(spark, tmp_path):
    ledger = secrets.Ledger(spark, str(tmp_path / "ledger"))
    first = spark.createDataFrame([(1, "token: abcdefgh"), (2, "token: abcdefgh"), (3, None)],
                                  "path long, text string")
    ledger.update(first, "a")
    assert ledger.scans().count() == 2
    second = spark.createDataFrame([(1, "token: abcdefgh"), (3, "AKIAABCDEFGHIJKL"), (4, "")],
                                   "path long, text string")
    ledger.update(second, "b")
    assert ledger.scans().count() == 3
    ledger.update(second, "b")
    assert ledger.scans().count() == 3
    found = {r["path"]: [tuple(s) for s in r["spans"]] for r in ledger.findings("b").collect()}
    assert found == {1: [("assign", 0, 15)], 3: [("access", 0, 16)], 4: []}
    assert {r["path"]: len(r["spans"]) for r in ledger.findings("a").collect()} == {1: 1, 2: 1, 3: 0}
    other = secrets.Ledger(spark, str(tmp_path / "ledger"), secrets.BASE)
    assert other.scans().count() == 0
    other.update(second, "b")
    assert other.scans().count() == 3


def test_more_secret_kinds():
    text = "-----BEGIN RSA PRIVATE KEY----- ghp_" + "z1" * 20
    assert [s[0] for s in secrets.scan(text)] == ["private_key", "hosted_token"]


# Licenses -----------------------------------------------------------------------------------


def test_licenses(spark, sf_dir, rows):
    want = Counter()
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for d, t, _ in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(upper))
        base, labels, score = [], set(), 0.0
        for k, n in enumerate(licenses.NOTICES):
            key, all_words = n.key.split(), n.text.split()
            for i in range(len(words)):
                if words[i:i + len(key)] == key:
                    at = i - n.key_at
                    score = max(score, sum(
                        0 <= at + j < len(words) and words[at + j] == w
                        for j, w in enumerate(all_words)) / len(all_words))
                    labels.add(n.label)
                    if k < 3:
                        base.append((i, n.label))
        places = [i for i, _ in base]
        want[d, len(words), len(base), min(places, default=None), max(places, default=None),
             ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), score] += 1
    assert got(QUERIES["op3_license_scan"](spark, sf_dir)) == want
    assert {x for r in want for x in r[6].split(",")} >= {"mit", "apache-2", "cc-by-nc", "gpl-3"}


# Repetition ---------------------------------------------------------------------------------


def longest_repeats(words):
    n, out = len(words), [0] * len(words)
    last = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        row = [0] * (n + 1)
        for j in range(n - 1, i, -1):
            if words[i] == words[j]:
                row[j] = last[j + 1] + 1
                out[i], out[j] = max(out[i], row[j]), max(out[j], row[j])
        last = row
    return out


def test_repetition(spark, sf_dir, rows):
    want = {}
    for d, t, _ in rows:
        t = t or ""
        words = WORD.findall(t)
        if len(words) > 400:
            continue
        windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        inside = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1
                  for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
        lengths = longest_repeats(words)
        limits = repetition.Limits()
        spanned = {j for i, n in enumerate(lengths) if n >= limits.span_words
                   for j in range(i, i + n)}
        chars = sum(map(len, words))
        kept = not failed and max(lengths) <= limits.longest and \
            100 * sum(len(words[i]) for i in spanned) <= limits.covered_percent * chars
        want.setdefault(d, []).append(
            (len(words), chars, sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
             len(inside), failed, kept))
    found = {}
    for r in QUERIES["op4_suffix_repetition"](spark, sf_dir).collect():
        found.setdefault(r["doc_id"], []).append(
            (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
             r["n_repeat_words"], r["base_failed"], r["kept"]))
    for d, v in want.items():
        assert [x for x in sorted(found[d]) if x[0] <= 400] == sorted(v)


def test_longest_repeat_alone_rejects():
    long = " ".join(f"w{i}" for i in range(60))
    rest = " ".join(f"r{i}" for i in range(2000))
    n, chars, _, _, repeated, spanned, longest = repetition.measure(f"{long} {rest} {long}")
    assert (n, repeated, longest) == (2120, 120, 60)
    assert 100 * spanned < 20 * chars and longest > repetition.Limits().longest


@pytest.mark.parametrize("words", [[], [1], [1, 1], [1] * 50, [1, 2] * 20, [3, 1, 2, 3, 1, 2, 3]])
def test_suffix_array(words):
    assert repetition.repeat_lengths(np.array(words, np.int64)).tolist() == longest_repeats(words)


# Token files --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return t


def test_token_files(spark, sf_dir, rows, tokenizer):
    ids = [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for d, t, _ in rows]
    ids.sort(key=lambda x: (x[0] is not None, x[0] or 0, np.array(x[1], "<u2").tobytes()))
    want, start = Counter(), 0
    for d, x in ids:
        want[d, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())] += 1
        start += len(x)
    assert got(QUERIES["op5_token_files"](spark, sf_dir)) == want


def test_packing_round_trip():
    rng = np.random.default_rng(3)
    for ranks in ([], [0], [255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1],
                  rng.integers(0, 2**18, 1001)):
        ranks = np.array(ranks, "<u4")
        control, data = token_files.pack(ranks)
        assert len(control) == -(-len(ranks) // 4)
        assert (token_files.unpack(control, data, len(ranks)) == ranks).all()


def test_word_encoder_equals_the_library(tokenizer):
    encoder = token_files.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    assert encoder.plain
    rng = np.random.default_rng(5)
    parts = ["a", "B", " ", "\n", "'", "s", "t", "é", "́", "Σ", "İ", "1", "²", "\x1c", "\x85",
             "ß", ".", "#", "ll", "re", "‍", "K", "ſ", "Ǆ", "\xa0", "\xad", "日"]
    for _ in range(2000):
        text = "".join(rng.choice(parts, rng.integers(1, 14)))
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == \
            tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


# Byte BPE -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                             special_tokens={})


def test_byte_bpe(spark, sf_dir, rows, ranks):
    want = Counter()
    for d, t, _ in rows:
        ids = ranks.encode_ordinary(t or "")
        want[d, len(ids), sha(" ".join(map(str, ids))), sha((t or "").encode())] += 1
    assert got(QUERIES["op10_byte_bpe"](spark, sf_dir)) == want


@pytest.mark.parametrize("text", [
    "It's the cat's 3rd 'll.   \n\n x" * 40, "日本語、テスト。" * 60, "a" * 500, " " * 500,
    "!?'s" * 100, "ab1 \t'reé́" * 50, "x'" * 200 + "s"])
def test_pieces_do_not_change_the_ids(ranks, text):
    for size in (1, 7, 50):
        assert "".join(byte_bpe.pieces(text, size)) == text
        assert byte_bpe.ids_of(ranks, text, size).tolist() == ranks.encode_ordinary(text)


# Personal data ------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def checks(kind, s):
    digits = [int(c) for c in s if "0" <= c <= "9"]
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        twice = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(twice) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def personal_spans(text):
    found = [(m.start(), i, k, m.end()) for i, (k, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text) if checks(k, m[0])]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def test_personal_data(spark, sf_dir, rows):
    want = Counter()
    for d, t, _ in rows:
        spans = personal_spans(t or "")
        n = Counter(k for k, _, _ in spans)
        want[d, *(n[k] for k in PATTERNS), sha(joined(spans))] += 1
    found = QUERIES["op9_weak_pii"](spark, sf_dir).collect()
    assert Counter(tuple(r)[:6] for r in found) == want
    every = [r["spans"].split(",") for r in found if r["n_phone"]]
    assert every and all({"email", "ip", "card", "phone"} <= {s.split(":")[0] for s in x}
                         for x in every)


def test_base_spans_of_random_texts():
    rng = np.random.default_rng(3)
    parts = ["a", "b.", "@", "@x.y", "1", "22", "255", "256", ".", "+4", " ", "-", "(", ")", "0",
             "4111 1111 1111 1111", "4111111111111111", "_", "%", "é"]
    for _ in range(5000):
        text = "".join(rng.choice(parts, rng.integers(1, 18)))
        assert [s for s in pii.proposals(text) if s[0] in pii.BASE] == personal_spans(text)


def test_classifier_trusts_labelers_and_not_failed_checks():
    patterns = {"card:11---:24": 100, "unchecked_card:0----:24": 300, "unchecked_card:01-0-:24": 9,
                "national_phone:--1-1:13": 20, "national_phone:---0-:13": 20, "email:11---:20": 50,
                "social_number:--1--:13": 4}
    likely = pii.estimate(patterns)
    assert likely["card:11---:24"] > 0.9 > 0.1 > likely["unchecked_card:0----:24"]
    good = pii.accepted(patterns)
    assert "national_phone:--1-1:13" in good and "unchecked_card:01-0-:24" not in good
    assert "national_phone:---0-:13" not in good


@pytest.mark.parametrize("text, real", [("2023 555-123-4567", ("national_phone", 5, 17)),
                                        ("2023 123-45-6789", ("social_number", 5, 16))])
def test_rejected_proposals_hide_nothing(spark, text, real):
    assert pii.proposals(text) == [("unchecked_card", 0, len(text)), real]
    pattern = f"{real[0]}:{pii.votes(text, *real)}:{pii.shape(text[real[1]:real[2]])}"
    df = spark.createDataFrame([(text,)], "text string")
    spans = df.select(pii.spans_of(pii.proposed(df.text), {pattern: 0.6})).first()[0]
    assert [tuple(s) for s in spans] == [real]


def test_proposals_of_one_kind_may_overlap():
    assert [s for s in pii.proposals("2023 555 123 4567") if s[0] == "national_phone"] == \
        [("national_phone", 0, 12), ("national_phone", 5, 17)]


def test_overlaps_are_settled_by_score():
    spans = [{"kind": k, "start": a, "end": b, "pattern": p} for k, a, b, p in (
        ("unchecked_card", 0, 17, "c"), ("email", 2, 4, "e"), ("national_phone", 5, 17, "n"),
        ("social_number", 17, 28, "s"), ("national_phone", 20, 32, "n"))]
    for good, want in (({"c": .9, "n": .8, "s": .7}, [0, 2, 20]), ({"c": .6, "n": .8}, [2, 5, 20]),
                       ({"c": .8, "n": .8, "s": .8}, [0, 2, 17]), ({"n": .5}, [2, 5, 20]),
                       ({}, [2]), ({"s": .6}, [2, 17])):
        assert [s["start"] for s in pii.settled(spans, good)] == want


def test_overlapping_spans_are_redacted_whole(spark):
    texts = {"+1 555 123 4567-joe@x.com": "[PHONE]", "a +1 555 123 4567-joe@x.com b": "a [PHONE] b",
             "10.0.0.41 1111 1111 1111 11 x": "[IP] x", "joe@x.com, 10.0.0.41": "[EMAIL], [IP]"}
    for text in list(texts)[:3]:
        a, b = pii.proposals(text)
        assert a[0] in ("phone", "ip") and b[0] in ("email", "card") and a[1] < b[1] < a[2] < b[2]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    spans = pii.spans_of(pii.proposed(df.text), {})
    for text, out in df.select("text", pii.redacted(df.text, spans)).collect():
        assert out == texts[text]


def test_very_long_runs_take_linear_time():
    for unit in ("a", "1", "@", "1.", "+1", "(", "a@", "a@b.c", "1-", "[at]", " ",
                 "eyJ-", "eyJ-abcdefgh.", "eyJ.", "ghp_", "xoxa-", "-----BEGIN ", "token "):
        pii.proposals(unit * (200_000 // len(unit)))
        secrets.scan(unit * (200_000 // len(unit)))


def test_web_tokens_are_those_of_the_plain_pattern():
    part = r"[A-Za-z0-9_-]{8,}"
    plain = re.compile(rf"\beyJ{part}\.eyJ{part}\.{part}", re.ASCII)
    rule = next(r for r in secrets.RULES if r.kind == "web_token")
    rng = random.Random(5)
    pieces = ["eyJ", "eyJabcdefgh", "abcdefgh", "-", ".", "_", " ", "é", "a", "eyJ12345678."]
    found = 0
    for _ in range(20_000):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 14)))
        expected = [m.span() for m in plain.finditer(text)]
        assert list(rule.spans(text)) == expected, text
        found += len(expected)
    assert found > 100
