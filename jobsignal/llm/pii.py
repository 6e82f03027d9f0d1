"""Personal data by weak supervision.

Patterns propose spans.  Labelers vote on each: its own pattern's check, gazetteers of domains,
issuers and country codes, the words before it, its surroundings and its form; each says yes, no or
nothing.  Expectation-maximisation over the counts of vote patterns in the whole corpus estimates
how far each labeler can be trusted and how likely each pattern is personal data, and a logistic
classifier learns that from votes, kind and form.  Spans of the base kinds that pass their checks
always stay; the classifier decides on the others, and of accepted ones that overlap the likelier
stays.
"""

from __future__ import annotations

import math
import re
from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.llm.tables import documents, stored

#: Kinds whose spans stay, then those that the classifier decides on; also the order of ties.
BASE = ("email", "ip", "card", "phone")
MORE = ("spelled_email", "national_phone", "social_number", "bank_account", "unchecked_card")
KINDS = BASE + MORE
LABELERS = ("check", "gazetteer", "context", "surroundings", "form")

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}"
                      r"(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{2,63}){1,5}", re.IGNORECASE)
_NATIONAL = re.compile(r"(?<![0-9+.-])(?<!\+[0-9] )(?:\([0-9]{2,5}\) ?|[0-9]{3,5}[ /-])"
                       r"[0-9]{3,4}[ -][0-9]{3,5}(?![0-9.-])")
_SOCIAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_BANK = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?"
                   r"(?![A-Za-z0-9])")

# Gazetteers and context words; choices of this module.
_DOMAIN_ENDS = frozenset("com org net edu gov io info biz de fr es it uk eu nl ch at us".split())
_COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43",
                  "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "82", "86", "91")
_ISSUERS = ("4", "34", "37", "51", "52", "53", "54", "55", "6011", "65")
_CONTEXT = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write to|courriel|correo)\W*$"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|telephone|call|fax|mobile|cell|telefon|teléfono)\W*$"),
    "ip": re.compile(r"(?i)\b(?:ip|address|host|server|from|login)\W*$"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|credit|karte|carte|tarjeta)\W*$"),
    "social_number": re.compile(r"(?i)\b(?:ssn|social security(?: number)?|social)\W*$"),
    "bank_account": re.compile(r"(?i)\b(?:iban|account|bank|konto|compte|cuenta)\W*$"),
}
_AGAINST = re.compile(r"(?i)\b(?:version|release|isbn|order|invoice|page|section|figure|no|nr|id)"
                      r"\W*$")
_CONTEXT_OF = {"spelled_email": "email", "national_phone": "phone", "unchecked_card": "card"}
#: Characters before a span that the context labeler sees.
CONTEXT = 40


def digits_of(s: str) -> str:
    return _NOT_DIGIT.sub("", s)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """As the pattern's leftmost matches, found from each @ to both sides."""
    end, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        if m:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = m.end()
                yield "email", start, end
                at = text.find("@", end)
                continue
        at = text.find("@", at + 1)


def ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.groups()]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            yield "ip", *m.span()


def cards(text: str) -> Iterator[Span]:
    """Cards, and what only lacks the check digit."""
    for m in _CARD.finditer(text):
        digits = digits_of(m[0])
        if 12 <= len(digits) <= 19:
            yield "card" if luhn(digits) else "unchecked_card", *m.span()


def phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 9 <= len(digits_of(m[0])) <= 15:
            yield "phone", *m.span()


def every(kind: str, pattern: re.Pattern[str], text: str) -> Iterator[Span]:
    """The pattern's match from each place, also inside the one before."""
    m = pattern.search(text)
    while m:
        yield kind, *m.span()
        m = pattern.search(text, m.start() + 1)


def proposals(text: str) -> list[Span]:
    """All proposed spans by start, then kind; others give way to base spans they overlap.

    Others may overlap each other: that is settled among those that the classifier accepts.
    """
    base: list[Span] = []
    more: list[Span] = []
    if "@" in text:
        base += emails(text)
    if "at" in text.lower() and ("[" in text or "(" in text):
        more += every("spelled_email", _SPELLED, text)
    if _DIGIT.search(text):
        base += ips(text)
        for span in cards(text):
            (base if span[0] == "card" else more).append(span)
        if "+" in text:
            base += phones(text)
        more += every("social_number", _SOCIAL, text)
        more += every("national_phone", _NATIONAL, text)
        more += every("bank_account", _BANK, text)
    if more and base:
        ranked = sorted(base, key=lambda s: s[1])
        starts = [s[1] for s in ranked]
        reach = np.maximum.accumulate([s[2] for s in ranked])
        last = [int(k) for k in np.searchsorted(starts, [s[2] for s in more])]
        more = [s for s, k in zip(more, last) if not (k and reach[k - 1] > s[1])]
    return sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))


def _bank_check(s: str) -> bool:
    plain = s.replace(" ", "")
    turned = plain[4:] + plain[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def votes(text: str, kind: str, start: int, end: int) -> str:
    """The labelers' votes on a span: 1 yes, 0 no, - nothing, in the order of LABELERS."""
    body = text[start:end]
    digits = digits_of(body)
    check = {"unchecked_card": "0", "spelled_email": "-", "national_phone": "-"}.get(kind, "1")
    if kind == "bank_account":
        check = "1" if _bank_check(body) else "0"
    if kind == "social_number":
        check = "0" if digits[:3] in ("000", "666") or digits[0] == "9" or digits[5:] == "0000" \
            else "-"
    known = "-"
    if kind in ("email", "spelled_email"):
        known = "1" if re.split(r"[.\])]", body.lower())[-1].strip() in _DOMAIN_ENDS else "0"
    elif kind == "ip":
        known = "0" if body.startswith(("0.", "10.", "127.", "192.168.", "255.")) else "1"
    elif kind in ("card", "unchecked_card"):
        known = "1" if digits.startswith(_ISSUERS) else "-"
    elif kind == "phone":
        known = "1" if digits.startswith(_COUNTRY_CODES) else "0"
    before = text[max(0, start - CONTEXT):start]
    context = _CONTEXT.get(_CONTEXT_OF.get(kind, kind))
    said = "1" if context and context.search(before) else "0" if _AGAINST.search(before) else "-"
    glued = start > 0 and (text[start - 1].isalnum() or text[start - 1] in "_./=") \
        or end < len(text) and (text[end].isalnum() or text[end] in "_/=")
    form = "-"
    if kind in ("phone", "national_phone"):
        form = "1" if "(" in body else "-"
    elif kind in ("card", "unchecked_card"):
        form = "1" if re.fullmatch(r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}", body) else "-"
    return check + known + said + ("0" if glued else "-") + form


def shape(body: str) -> str:
    """Length and share of digits, in five steps each."""
    digits = len(digits_of(body))
    return f"{min(4, len(body) // 8)}{min(4, 5 * digits // max(1, len(body)))}"


PROPOSED = "struct<kind:string,start:int,end:int,pattern:string>"


def proposed(text: Column) -> Column:
    """The proposed spans of a text with their patterns: kind, votes and shape."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                               ("end", pa.int32()), ("pattern", pa.string())]))

    def of(text: str) -> list[dict]:
        return [{"kind": k, "start": a, "end": b,
                 "pattern": f"{k}:{votes(text, k, a, b)}:{shape(text[a:b])}"}
                for k, a, b in proposals(text)]

    @F.arrow_udf(f"array<{PROPOSED}>")
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([of(x.as_py() or "") for x in texts], kind)

    return each(text)


def estimate(patterns: dict[str, int], rounds: int = 50) -> dict[str, float]:
    """How likely each vote pattern is personal data, by expectation-maximisation.

    Two classes, independent labelers.  Within each class a labeler's answers, yes, no or nothing,
    are counted, with a few more counts for being right, so that the classes can't change places.
    Each kind has a share of personal data of its own.
    """
    keys = list(patterns)
    n = np.array([patterns[k] for k in keys], float)
    kind = np.array([KINDS.index(k.split(":")[0]) for k in keys])
    said = np.array([["10-".index(c) for c in k.split(":")[1]] for k in keys])
    answers = said[:, :, None] == np.arange(3)
    yes, no = answers[:, :, 0].sum(1), answers[:, :, 1].sum(1)
    right = 1 / (1 + np.exp(-1.5 * (yes - no - 0.5)))
    true_more, false_more = np.array([8.0, 1.0, 8.0]), np.array([1.0, 8.0, 8.0])
    for _ in range(rounds):
        w, v = n * right, n * (1 - right)
        share = np.array([(w[kind == k].sum() + 1) / (n[kind == k].sum() + 2)
                          for k in range(len(KINDS))])
        true = (w[:, None, None] * answers).sum(0) + true_more
        false = (v[:, None, None] * answers).sum(0) + false_more
        true /= true.sum(1, keepdims=True)
        false /= false.sum(1, keepdims=True)
        odds = np.log(share[kind] / (1 - share[kind])) + \
            (answers * np.log(true / false)).sum((1, 2))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - right).max() < 1e-9:
            break
        right = new
    return dict(zip(keys, right.tolist()))


def features(pattern: str) -> np.ndarray:
    kind, said, form = pattern.split(":")
    x = np.zeros(len(KINDS) + 2 * len(LABELERS) + 10)
    x[KINDS.index(kind)] = 1
    for i, c in enumerate(said):
        if c != "-":
            x[len(KINDS) + 2 * i + (c == "1")] = 1
    at = len(KINDS) + 2 * len(LABELERS)
    x[at + int(form[0])] = 1
    x[at + 5 + int(form[1])] = 1
    return x


def train(patterns: dict[str, int], likely: dict[str, float], decay: float = 1.0) -> np.ndarray:
    """Weights of a logistic classifier that agrees with the estimates, by Newton's method."""
    x = np.array([features(p) for p in patterns])
    n = np.array([math.log1p(c) for c in patterns.values()])
    y = np.array([likely[p] for p in patterns])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - decay * w
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + decay * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def accepted(patterns: dict[str, int], threshold: float = 0.5) -> dict[str, float]:
    """The patterns that the trained classifier takes for personal data, with its scores."""
    if not patterns:
        return {}
    weights = train(patterns, estimate(patterns))
    likely = {p: 1 / (1 + math.exp(-float(features(p) @ weights))) for p in sorted(patterns)}
    return {p: score for p, score in likely.items() if score >= threshold}


def accepted_counts(found: DataFrame) -> dict[str, float]:
    """The accepted patterns with scores of `found`, a table with a column `proposed`.

    A pattern has one of a fixed number of forms, so that the counts that the driver fetches are
    bounded, whatever the corpus.
    """
    counts = found.select(F.explode("proposed.pattern").alias("pattern")) \
        .groupBy("pattern").count().orderBy("pattern").collect()
    return accepted({r["pattern"]: r["count"] for r in counts})


def accepted_patterns(df: DataFrame, text: str = "text") -> dict[str, float]:
    """The accepted patterns with scores of all texts of `df`."""
    return accepted_counts(df.select(proposed(F.col(text)).alias("proposed")))


def settled(spans: list[dict], good: dict[str, float]) -> list[dict]:
    """The spans of base kinds, and of accepted patterns those that overlap no likelier one.

    Of equally likely ones the first by start, then kind, stays.
    """
    starts: list[int] = []
    ends: list[int] = []
    stays = []
    others = [s for s in spans if s["kind"] not in BASE and s["pattern"] in good]
    for s in sorted(others, key=lambda s: (-good[s["pattern"]], s["start"],
                                           KINDS.index(s["kind"]))):
        k = bisect(starts, s["start"])
        if (k == 0 or ends[k - 1] <= s["start"]) and \
                (k == len(starts) or starts[k] >= s["end"]):
            starts.insert(k, s["start"])
            ends.insert(k, s["end"])
            stays.append(s)
    return sorted([s for s in spans if s["kind"] in BASE] + stays,
                  key=lambda s: (s["start"], KINDS.index(s["kind"])))


def spans_of(proposed: Column, good: dict[str, float]) -> Column:
    """Of the proposed spans those that stay (kind, start, end), given the accepted patterns."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                               ("end", pa.int32())]))

    @F.arrow_udf("array<struct<kind:string,start:int,end:int>>")
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            yield pa.array([[{k: s[k] for k in ("kind", "start", "end")}
                             for s in settled(x.as_py() or [], good)] for x in lists], kind)

    return each(proposed)


def detected(df: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """`key` and `spans` (kind, start, end) of every row of `df`; a null text is empty.

    Texts are read once: the proposed spans are written down, counted and judged.
    """
    found = stored(df.select(*key, proposed(F.col(text)).alias("proposed")), "proposed")
    return found.select(*key, spans_of(F.col("proposed"), accepted_counts(found)).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets.

    Overlapping spans are replaced as one, by the kind of the first; nothing of them stays.
    """

    @F.arrow_udf("string")
    def each(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            out = []
            for x, found in zip(texts, lists):
                s, at, parts = x.as_py(), 0, []
                for span in (found.as_py() or []) if s is not None else []:
                    if span["start"] >= at:
                        parts += [s[at:span["start"]], f"[{span['kind'].upper()}]"]
                    at = max(at, span["end"])
                out.append("".join([*parts, s[at:]]) if s is not None else None)
            yield pa.array(out, pa.string())

    return each(text, spans)


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all `documents`: repeated rows alike, null and empty texts have none."""
    found = detected(documents(spark, sf_dir), ["doc_id"])

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(list(kinds)))

    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined_spans(of(*BASE)), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"))
