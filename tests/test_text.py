import html
import random
import re
from html.entities import html5

from pyspark.sql import functions as F

from jobsignal.functions import text as T

EVERY_CHAR = [chr(c) for c in range(1, 0x11000) if not 0xD800 <= c <= 0xDFFF]


def run(spark, values, column):
    df = spark.createDataFrame(list(enumerate(values)), "i long, s string")
    rows = df.select("i", column(F.col("s")).alias("o")).collect()
    return [r["o"] for r in sorted(rows)]


def test_white_space_set(spark):
    got = run(spark, EVERY_CHAR, lambda s: F.concat(
        F.regexp_replace(s, T.SPACES, "").alias("a"), F.lit("|"), T.strip(s)))
    for ch, out in zip(EVERY_CHAR, got, strict=True):
        assert out == ("|" if ch.isspace() else f"{ch}|{ch}"), hex(ord(ch))


def test_word_count(spark):
    values = ["", "  ", "a", " a b\x1cc　", "one two\nthree", None]
    assert run(spark, values, T.word_count) == [len((v or "").split()) for v in values]


def test_job_text(spark):
    df = spark.createDataFrame([("A B", "C"), ("", "C"), (None, None), ("x", None)],
                               "t string, d string")
    rows = df.select(T.job_text(F.col("t"), F.col("d")).alias("j")).collect()
    assert [r["j"] for r in rows] == ["a b c ", "c ", "", "x "]


REFERENCES = [
    "&amp;", "&amp", "&am", "&", "&&amp;&", "&lt;b&gt;", "&notit;", "&notin;", "&not;x", "&notx",
    "&#65;", "&#065", "&#x41;", "&#X41", "&#x;", "&#;", "&#", "&#0;", "&#13;", "&#128;", "&#129;",
    "&#x9f;", "&#xD800;", "&#xDFFF;", "&#x110000;", "&#99999999999999999999;", "&#x1F600;",
    "&#11;", "&#xFDD0;", "&#xFFFE;", "&#x1FFFF;", "&#127;", "&#xFEFF;", "&#8364;", "&#1;x",
    "&CounterClockwiseContourIntegral;", "&copy;&copy", "&copyx;", "&Aacute", "&NotEqualTilde;",
    "&amp;copy;", "a & b", "& amp;", "&quot;&apos;", "&ltimes;", "&lt=", "&unknown;", "&x y;",
]


def test_character_references(spark):
    rng = random.Random(5)
    pieces = REFERENCES + ["x", " ", "#", ";", "&#", "\n", "<p>"]
    mixed = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 6))) for _ in range(600)]
    named = [f"&{n}" for n in html5]
    values = REFERENCES + mixed + named
    for value, out in zip(values, run(spark, values, T.unescape_html), strict=True):
        assert out == html.unescape(value), repr(value)


def test_numeric_references(spark):
    values = [f"&#{n};" for n in [*range(0x300), *range(0xD7F0, 0xE010), *range(0xFDC0, 0xFE00),
                                  0xFFFD, 0xFFFE, 0xFFFF, 0x10000, 0x10FFFE, 0x10FFFF]]
    for value, out in zip(values, run(spark, values, T.unescape_html), strict=True):
        assert out == html.unescape(value), value


def test_html_to_text(spark):
    values = ["<p>Acme | Berlin<p>We&#x27;re  <b>hiring</b> &lt;now&gt;", " <br/> ", "", None,
              "a<b\nc>d", "1 < 2", "&nbsp;x&nbsp;"]
    want = [html.unescape(re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", v or ""))).strip()
            for v in values]
    assert run(spark, values, T.html_to_text) == want


def test_visible_text_leaves_out_scripts_and_comments(spark):
    page = "<div>a<script>var x = '<p>';</script><!-- no\n --><style>p{}</style> b</div>"
    assert run(spark, [page], T.visible_text) == ["a b"]
