"""Row-at-a-time models of the rules, to hold the Spark expressions against."""

import re


def count_mentions(text, dictionary):
    low = (text or "").lower()
    found = {t: len(re.findall(r"\b" + re.escape(t) + r"\b", low)) for t in dictionary.terms}
    return {dictionary.display[t]: n for t, n in found.items() if n}


def has_word(text, name):
    return re.search(r"\b" + re.escape(name.lower()) + r"\b", text.lower()) is not None


def jaccard(a, b):
    a, b = {x.lower() for x in a}, {x.lower() for x in b}
    return 1.0 if not a | b else len(a & b) / len(a | b)


def gap(resume, market, n):
    """Gap report with equal counts in name order; ``market`` maps skills to counts."""
    top = sorted(market.items(), key=lambda kv: (-kv[1], kv[0]))[:n]
    first = {}
    for skill, count in top:
        first.setdefault(skill.lower(), (skill, count))
    have = {s.lower() for s in resume}
    match = [first[s.lower()] for s in resume if s.lower() in first]
    lacking = [(s, c, tier(c, len(top))) for s, c in top if s.lower() not in have]
    share = len(lacking) / len(top) * 100 if top else 0.0
    worth = [x for x in lacking if x[2] == "High"] + [x for x in lacking if x[2] == "Medium"]
    return {"size": len(top), "matching": match, "missing": lacking,
            "gap": round(share, 2), "share": share, "path": worth[:5]}


def tier(count, size):
    return "High" if count > size * 0.3 else "Medium" if count > size * 0.1 else "Low"


def match_rate(resume, market):
    if not resume or not market:
        return 0.0
    return round(len({s.lower() for s in resume} & {s.lower() for s in market})
                 / len(resume) * 100, 2)


def dedup(rows):
    """First row of every key; rows are (order, title, company, location)."""
    seen, kept = set(), []
    for row in sorted(rows):
        key = tuple((v or "").strip().lower() for v in row[1:])
        if key not in seen:
            seen.add(key)
            kept.append(row)
    return kept
