"""Ball k-means codes, main texts of pages and fill-in-middle, against plain versions."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from jobsignal.llm import ball_codes, fill_middle, main_text
from jobsignal.llm.queries import QUERIES

# Ball k-means ------------------------------------------------------------------------------


def plain_codes(rows, parts=16, entries=64, rounds=2, scale=256):
    """(id, label, code, error) and the codebooks, all distances computed one by one."""
    kept = []
    for i, label, v in rows:
        if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) and abs(x) < 1e4
                                             for x in v):
            kept.append((i, label, [math.floor(scale * x) for x in v]))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    w = len(kept[0][2]) // parts

    def cut(v):
        return [tuple(v[p * w:p * w + w]) for p in range(parts)]

    vectors = [cut(v) for _, _, v in kept]
    books = [[v[p] for v in vectors[:entries]] for p in range(parts)]

    def assign():
        out = []
        for v in vectors:
            out.append([min(range(len(book)), key=lambda e: (
                sum((a - b) ** 2 for a, b in zip(x, book[e])), e)) for x, book in zip(v, books)])
        return out

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p] for v, c in zip(vectors, codes) if c[p] == e]
                if own:
                    books[p][e] = tuple(sum(x) // len(own) for x in zip(*own))
    codes = assign()
    out = []
    for (i, label, _), v, c in zip(kept, vectors, codes):
        error = sum((a - b) ** 2 for x, book, e in zip(v, books, c) for a, b in zip(x, book[e]))
        out.append((i, label, bytes(c), error))
    return out, books


def vectors(n, width=32):
    rng = np.random.default_rng(n)
    rows = [(int(i), int(i) % 3 or None, [round(float(x), 2) for x in rng.standard_normal(width)])
            for i in rng.permutation(n)]
    if n > 20:
        rows += [(5, 1, rows[0][2]), rows[3], rows[3], (None, 2, rows[4][2]), (200, None, None),
                 (201, 1, []), (202, 1, [None] + [1.0] * (width - 1)), (203, 1, [math.nan] * width),
                 (204, 1, [math.inf] * width), (205, 1, [1.0] * 16), (206, 1, [1.0] * 7),
                 (207, 1, [1e300] * width), (208, 2, [0.0] * width), (209, 2, [0.0] * width)]
    return rows


@pytest.mark.parametrize("n", [1, 9, 120, 400])
def test_codes_equal_those_of_all_distances(spark, n):
    rows = vectors(n)
    want, books = plain_codes(rows)
    df = spark.createDataFrame([(*r, "?", "?") for r in rows], "vec_id long, label int, "
                               "embedding array<double>, codes string, error string").repartition(5)
    got, found = ball_codes.compressed(df)
    assert Counter((r[0], r[1], bytes(r[2]), r[3]) for r in got.collect()) == Counter(want)
    assert [[tuple(e) for e in b] for b in found.tolist()] == books
    near = ball_codes.decompressed(want[0][2], found)
    assert near.shape == (32,)


def test_label_errors_and_digest(spark, tmp_path):
    rows = vectors(150)
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>") \
        .write.parquet(f"{tmp_path}/embeddings.parquet")
    with np.errstate(over="ignore"):
        rows = [(i, label, v and [None if x is None else float(np.float32(x)) for x in v])
                for i, label, v in rows]
    plain, books = plain_codes(rows)
    totals = Counter()
    for _, label, _, error in plain:
        totals[label] += error
    text = ",".join(str(x) for b in books for e in b for x in e)
    digest = hashlib.sha256(text.encode()).hexdigest()
    want = Counter((i, c.hex(), e, totals[label], digest) for i, label, c, e in plain)
    got = QUERIES["op11_ball_codes"](spark, str(tmp_path)).collect()
    assert Counter(tuple(r) for r in got) == want


@pytest.mark.parametrize("width", [1, 4, 16])
def test_balls_skip_distances_and_change_nothing(width):
    rng = np.random.default_rng(width)
    parts = rng.integers(-40, 40, (5000, width))
    book = parts[:64].copy()
    before = ball_codes.nearest(parts, book)
    for e in range(64):
        if (before == e).any():
            book[e] = parts[before == e].sum(0) // (before == e).sum()
    book[7] = book[9]  # a tie between entries
    after, computed = ball_codes.moved(parts, book, before, pairs=1000)
    assert (after == ball_codes.nearest(parts, book)).all()
    if width <= 4:
        assert computed < len(parts) * 64 / 4


# Main text ---------------------------------------------------------------------------------

PROSE = ("The river rises in the hills to the north and it is fed by the snow that lies there for "
         "most of the year, as the old maps of the valley have shown since they were drawn.")
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Section {i}</a></li>' for i in range(6)) + "</ul>"
SPARSE = "Lorem ipsum dolor amet consectetur adipiscing elit sed eiusmod tempor incididunt labore " * 2


def test_tags_and_names_mark_what_is_no_article():
    page = f"""<html><head><title>Site &amp; title</title><style>p{{}}</style></head>
      <body class="has-sidebar"><header><h1>Site</h1></header><nav>{MENU}</nav>
      <div class="cookie-notice"><p>{PROSE}</p></div>
      <main><article class="post ad-free"><h1>A&nbsp;river</h1><p>{PROSE}<br>Short&#33;</p>
      <div id="ad_top">{PROSE}</div><p>One</p><script>var a = "</p><p>x</p>";</script>
      <form><p>{PROSE}</p><button>Send</button></form>
      <p>A <b>bold</b> &lt;end&gt;<!-- <p>{PROSE}</p> --></p>
      <section id="comments"><article><p>{PROSE}</p></article></section></article></main>
      <aside><p>{PROSE}</p></aside><footer><p>{PROSE}</p></footer></body></html>"""
    assert main_text.main_text(page) == "\n\n".join(
        ["A river", f"{PROSE} Short!", "One", "A bold <end>"])


def test_density_decides_where_nothing_is_marked():
    page = (f"<div>{MENU}</div><div>About us</div><h2>The river</h2><div>{PROSE}</div>"
            f"<div>It is long.</div><p>{PROSE}</p><div>Imprint</div><div>{SPARSE}</div>"
            f"<div>All rights reserved</div>")
    # 'About us' is nearer to the menu; 'Imprint' lies right between a good and a bad block
    assert main_text.main_text(page).split("\n\n") == \
        ["The river", PROSE, "It is long.", PROSE, "Imprint"]
    assert "Section" not in main_text.main_text(page) and "Lorem" not in main_text.main_text(page)
    assert "rights" not in main_text.main_text(page)
    assert main_text.main_text("<p>Hello") == "Hello"
    assert main_text.main_text(f"<nav>{MENU}</nav><p>Hello</p>") == "Hello"


def test_second_pass_takes_the_nearer_label():
    def block(text, label=None, heading=False):
        b = main_text.Block(main_text.Element("", None), heading)
        b.text, b.label = text, label
        return b

    rng = random.Random(3)
    for border in ("good", None):
        for _ in range(200):
            found = [block("x" * rng.randint(1, 9), rng.choice([None, None, "good", "bad"]),
                           rng.random() < 0.2) for _ in range(rng.randint(1, 12))]
            before = [b.label for b in found]
            main_text.inherit(found, border)
            for i, b in enumerate(found):
                if before[i]:
                    assert b.label == before[i]
                    continue
                back = [j for j in range(i) if before[j]]
                ahead = [j for j in range(i + 1, len(found)) if before[j]]
                left = before[back[-1]] if back else border
                right = before[ahead[0]] if ahead else border
                a = sum(len(x.text) for x in found[(back[-1] if back else -1) + 1:i])
                z = sum(len(x.text) for x in found[i + 1:ahead[0] if ahead else len(found)])
                if not left or not right or left == right:
                    assert b.label == (left or right or "good")
                elif border or a == z:
                    assert b.label == "good"
                else:
                    assert b.label == (right if b.heading or z < a else left)


@pytest.mark.parametrize("page", [
    "", "   ", "plain words", "<p", "<a<a<a", "<p>a < b</p>", "<!-- open", "<script>x", "<p>&amp;&am",
    "<p title='>'>x</p>", "<p title=\">x</p>", "</p></div>x", "<div><span>x</div>y</span>"])
def test_odd_pages(page):
    text = main_text.main_text(page)
    assert "<p" not in text and text == text.strip()
    assert main_text.main_text(None) == ""


def test_odd_pages_give_their_text():
    assert main_text.main_text("<p>a < b</p>") == "a < b"
    assert main_text.main_text("<p title='>'>x</p>") == "x"
    assert main_text.main_text("<ul class=menu><li>x</ul><article><p>y<p class=ad>z<p>w") == "y\n\nw"
    assert main_text.main_text("<nav><p>x<article><p>y</article>") == "y"
    assert main_text.main_text("a<!-->b<!-- -->c") == "abc"


@pytest.mark.parametrize("unit", ["<a<", "<p>", "<div class=x>", "<!--", "<a href=\"", "<li>x", "&amp;",
                                  "<article>", "<script>", "<p x='", "= ", "<b>x</b>", "</div>"])
def test_long_pages_take_linear_time(unit):
    start = time.perf_counter()
    main_text.main_text("<body>" + unit * (300_000 // len(unit)))
    assert time.perf_counter() - start < 6


def test_pages_with_repeats_nulls_and_clashing_columns(spark):
    rows = [(1, "u", f"<article><p>{PROSE}</article>", "?"), (1, "u", f"<article><p>{PROSE}</article>", "?"),
            (None, None, None, "?"), (2, "u", "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = Counter((r.page_id, r.text, r.n_chars) for r in main_text.extracted(df).collect())
    assert got == Counter({(1, PROSE, len(PROSE)): 2, (None, "", 0): 1, (2, "", 0): 1})


# Fill-in-middle ----------------------------------------------------------------------------


def plain_middle(doc_id, text, rate=100, spm=50):
    """(n, form, prefix, middle, suffix, output)."""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    parts = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", *parts, text
    p, m, s = parts
    if h[3] % 100 < spm:
        return len(units), "spm", *parts, f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", *parts, f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


EXTRA = ["\n", "\n\n\n", "a\nb", "a\nb\n", "ü\n日本\r\n\x0bz", "x <P> y\nz\n", "<M>", "<\nP>\n<S\n>",
         "line\n" * 3000, "ü" * 200_000 + "\n" + "b\n" * 10]


def middle_rows(rows):
    return [(d, t) for d, t, _ in rows] + [(100 + i, t) for i, t in enumerate(EXTRA * 3)]


def test_fill_middle(spark, rows, tmp_path):
    docs = middle_rows(rows)
    spark.createDataFrame([(d, t, "?", 1) for d, t in docs],
                          "doc_id long, text string, form string, row long").repartition(4) \
        .write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter()
    for d, t in docs:
        n, form, p, m, _, out = plain_middle(d, t or "")
        plain = form == "plain"
        want[d, n, form, None if plain else len(p), None if plain else len(m), sha(out),
             sha(t or "")] += 1
    got = QUERIES["op13_fill_middle"](spark, str(tmp_path)).collect()
    assert Counter(tuple(r) for r in got) == want
    assert {f for _, _, f, *_ in want} == {"plain", "psm", "spm"}


def test_small_pieces_and_partial_rates(spark, rows):
    rule = fill_middle.Rule(rate=60, spm=20, piece_bytes=7)
    docs = [(d, t[:3000] if t else t) for d, t in middle_rows(rows)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = fill_middle.restored(fill_middle.assembled(fill_middle.pieces(df, rule))).collect()
    want = Counter()
    for d, t in docs:
        _, form, _, _, _, out = plain_middle(d, t or "", 60, 20)
        want[d, form, sha(out), sha(t or "")] += 1
    assert Counter((r.doc_id, r.form, r.output_sha256, r.restored_sha256) for r in got) == want


def test_outputs_and_their_restoration(spark, rows):
    docs = middle_rows(rows)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = Counter((r.doc_id, r.form, r.output, fill_middle.restore(r.output, r.form))
                  for r in fill_middle.transformed(df).collect())
    assert got == Counter((d, plain_middle(d, t or "")[1], plain_middle(d, t or "")[-1], t or "")
                          for d, t in docs)


def test_pieces_are_whole_lines_where_these_fit():
    text = b"".join(b"x" * n + b"\n" for n in (3, 40, 0, 12, 5, 5, 5)) + b"tail"
    for size in (1, 4, 8, 16, 100):
        pieces = fill_middle.pieces_of(text, size)
        assert b"".join(pieces) == text and all(len(p) <= size for p in pieces)
        for p, q in zip(pieces, pieces[1:]):
            line = q.split(b"\n")[0]
            assert p.endswith(b"\n") or len(line) + 1 > size or len(p) == size
