"""Text columns: whitespace rules, tag stripping, character references."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space in Unicode-aware text handling, and the same set
# as a pattern.  The Unicode form of ``\s`` leaves out the four separator controls; the printable
# ASCII characters are ruled out first because that settles most characters at once.
SPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
SPACES = r"(?U)[[^!-~]&&[\s\x1c-\x1f]]+"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body`` as often as needed."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def blank_to(text: Column, default: str) -> Column:
    """``default`` where the text is null."""
    return F.coalesce(text, F.lit(default))


def word_count(text: Column) -> Column:
    return bind(strip(blank_to(text, "")), lambda t: F.when(t == "", 0).otherwise(
        F.size(F.split(t, SPACES))))


def job_text(title: Column, description: Column) -> Column:
    """Lower-case title and description, each followed by a blank, empty parts left out."""

    def part(c: Column) -> Column:
        return F.when(F.length(c) > 0, F.concat(F.lower(c), F.lit(" "))).otherwise(F.lit(""))

    return F.concat(part(title), part(description))


def category_text(title: Column, description: Column, tags: Column | None = None) -> Column:
    """The blob that category filters search: title, description and tags."""
    parts = [blank_to(title, ""), blank_to(description, "")]
    if tags is not None:
        parts.append(blank_to(F.array_join(tags, " "), ""))
    return F.concat_ws(" ", *parts)


def tags_to_spaces(html: Column) -> Column:
    """Replace every tag by a blank and collapse white space."""
    return F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), SPACES, " ")


def html_to_text(html: Column) -> Column:
    """Tags to blanks, white space collapsed, then character references decoded, then trimmed."""
    return strip(unescape_html(tags_to_spaces(blank_to(html, ""))))


def visible_text(html: Column) -> Column:
    """Like :func:`html_to_text`, without scripts, style sheets and comments."""
    invisible = r"(?is)<(?:(script|style)\b.*?</\1\s*>|!--.*?-->)"
    return html_to_text(F.regexp_replace(blank_to(html, ""), invisible, " "))


# Character references -----------------------------------------------------------------------

_NAMED = {n: html5[f"{n};"] for n in ("amp", "lt", "gt", "quot", "apos")}
_NAMED.update((n[:-1], c) for n, c in html5.items() if n.endswith(";"))
# The names that HTML also accepts without the closing semicolon, longest first.
_BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
_BEYOND = 0x110000


def _replaced_code_points() -> dict[int, str]:
    """Numeric references that stand for another character or for nothing."""
    out = {0x00: "\ufffd", 0x0D: "\r"}
    for n in [*range(0x1, 0x9), 0xB, *range(0xE, 0x20), 0x7F, *range(0xFDD0, 0xFDF0)]:
        out[n] = ""
    for plane in range(0x11):
        out[plane * 0x10000 + 0xFFFE] = out[plane * 0x10000 + 0xFFFF] = ""
    for n in range(0x80, 0xA0):  # read as Windows-1252 where that defines the byte
        try:
            out[n] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            out[n] = chr(n)
    return out


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def _character(code: Column) -> Column:
    """The character of a valid code point, by way of its UTF-16 form."""
    above = code - F.lit(0x10000)
    high = (F.lit(0xD800) + F.shiftright(above, 10)) * F.lit(0x10000)
    low = F.lit(0xDC00) + above.bitwiseAND(F.lit(0x3FF))
    units = F.when(code < 0x10000, F.lpad(F.hex(code), 4, "0")).otherwise(F.hex(high + low))
    return F.decode(F.unhex(units), "UTF-16BE")


def _decode_number(code: Column) -> Column:
    replaced = _literal_map({str(n): c for n, c in _replaced_code_points().items()})
    return bind(code, lambda n: (
        F.when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("\ufffd"))
        .otherwise(F.coalesce(F.try_element_at(replaced, n.cast("string")), _character(n)))
    ))


# No name is longer than this, so only the beginning of a text is searched for one.
_LONGEST = max(map(len, html5)) + 1


def _decode_name(rest: Column) -> Column:
    head = F.left(rest, F.lit(_LONGEST))
    closed = F.regexp_extract(head, "^([A-Za-z][A-Za-z0-9]*);", 1)
    bare = F.regexp_extract(head, f"^({'|'.join(_BARE)})", 1)

    def decoded(name: Column, known: dict[str, str], extra: int) -> Column:
        return bind(name, lambda n: F.concat(F.try_element_at(_literal_map(known), n),
                                             F.substr(rest, F.length(n) + 1 + extra)))

    return F.coalesce(decoded(closed, _NAMED, 1), decoded(bare, {n: html5[n] for n in _BARE}, 0),
                      F.concat(F.lit("&"), rest))


def _decode_code(rest: Column) -> Column:
    decimal = F.regexp_extract(rest, r"^#0*([0-9]+)", 1)
    hexadecimal = F.regexp_extract(rest, r"^#[xX]0*([0-9a-fA-F]+)", 1)
    whole = F.regexp_extract(rest, r"^#([0-9]+|[xX][0-9a-fA-F]+);?", 0)

    def number(digits: Column, base: int, limit: int) -> Column:
        value = F.conv(F.when(F.length(digits) <= limit, digits), base, 10).cast("long")
        return F.coalesce(value, F.lit(_BEYOND))

    code = F.when(decimal != "", number(decimal, 10, 9)).otherwise(number(hexadecimal, 16, 7))
    return bind(whole, lambda w: F.when(w == "", F.concat(F.lit("&"), rest)).otherwise(
        F.concat(_decode_number(code), F.substr(rest, F.length(w) + 1))))


def _decode_reference(rest: Column) -> Column:
    """Decode ``rest``, the text between one ampersand and the next one."""
    first = F.left(rest, F.lit(1))
    return (F.when(first == "#", _decode_code(rest))
            .when(first.between("A", "Z") | first.between("a", "z"), _decode_name(rest))
            .otherwise(F.concat(F.lit("&"), rest)))


def unescape_html(text: Column) -> Column:
    """Decode named and numeric character references by the HTML5 rules."""
    pieces = F.split(text, "&")
    decoded = F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(_decode_reference(p)))
    return F.when(F.contains(text, F.lit("&")), F.array_join(decoded, "")).otherwise(text)
