"""Landed provider responses -> postings.

A response is one row of the landed table (``schema.LANDED``): collection cycle, feed name, number
of the request within the cycle, search phrase, and the response text.  Each adapter cuts the text
into its entries and projects them to the posting schema plus ``cycle`` and the order that "first
one wins" rules go by, ``request`` and ``pos``.  Any number of cycles is read at once.

JSON is read as a variant, which tells an absent field from a null one: an absent field gets the
feed's default, an explicit null stays null.  A response that can't be read, or an entry that is
no object, gives no posting; ``rejected`` lists it with its reason, and all others are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.functions import rules
from jobsignal.functions.text import (
    bind, blank_to, category_text, html_to_text, strip, unescape_html, visible_text,
)
from jobsignal.operators.postings import first_k
from jobsignal.schema import LANDED

# --- fixed values: feeds in the order their postings are taken ------------------------------
FEEDS = ("remoteok", "arbeitnow", "wellfound", "hackernews", "adzuna", "jsearch")

# --- fixed values: characters of the shortest job card --------------------------------------
SHORTEST_CARD = 20

# --- fixed values: addresses and patterns ---------------------------------------------------
REMOTEOK_JOB = "https://remoteok.com/remote-jobs/"
WELLFOUND_SITE = "https://wellfound.com"
HACKERNEWS_ITEM = "https://news.ycombinator.com/item?id="
CARD_LOCATIONS = ("Remote", "United States", "UK", "Europe", "Germany", "India", "Canada")
CARD_MARK = 'data-test="JobSearchResult"'

# --- fixed values: where a JSON response has its entries; "" is the response itself ---------
ENTRIES = {"remoteok": "", "arbeitnow": "data", "hackernews": "children", "adzuna": "results",
           "jsearch": "data"}

EMPTY, NOT_JSON = "empty response", "not JSON"
NO_LIST, NO_OBJECT = "no list of entries", "entry is no object"


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """Responses stored as ``cycle=<id>/source=<feed>/request=<n>/query=<phrase>/<file>``.

    A filter on ``cycle`` or ``source`` prunes whole folders.
    """
    raw = spark.read.text(root, wholetext=True)
    columns = [F.col("value").alias("body") if f.name == "body"
               else (F.col(f.name) if f.name in raw.columns else F.lit(None))
               .cast(f.dataType).alias(f.name) for f in LANDED]
    return raw.select(*columns)


def unified_schema(now: Column, **fields: Column) -> list[Column]:
    """The ten posting columns; absent ones are null, no tags and not remote."""
    defaults = {
        "tags": F.array().cast("array<string>"),
        "is_remote": F.lit(False),
    }

    def value(name: str) -> Column:
        given = fields.get(name)
        if name in defaults:
            return defaults[name] if given is None else F.coalesce(given, defaults[name])
        return (F.lit(None) if given is None else given).cast("string")

    names = ("title", "company", "description", "source", "location", "salary", "url")
    return [
        *[value(n).alias(n) for n in names],
        value("tags").alias("tags"),
        value("is_remote").cast("boolean").alias("is_remote"),
        now.alias("timestamp"),
    ]


def iso_now() -> Column:
    """The time of the run as ISO-8601 text in UTC."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def _entries(landed: DataFrame, feed: str, entries: Column, first: int = 0,
             limit: int | None = None) -> DataFrame:
    """One row per entry of the feed's responses from ``first`` on: request, query, pos, e."""
    rows = landed.where(F.col("source") == feed).select("cycle", "request", "query", entries.alias("list"))
    # The outer form keeps the optimizer from parsing every response a second time for a
    # "list is not empty" filter below the generator.
    return (rows.select("cycle", "request", "query", F.posexplode_outer("list").alias("pos", "e"))
            .where(F.col("pos") >= first if limit is None
                   else F.col("pos").between(first, first + limit - 1)))


def _first(postings: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` postings of every response; all without a limit."""
    if limit is None:
        return postings
    return first_k(postings, limit, by=["cycle", "request"], order=["pos"])


def _list(response: Column, feed: str) -> Column:
    """The entries of a parsed response; null unless it is of the feed's shape.

    An object without the feed's key has no entries.
    """
    key = ENTRIES[feed]
    bare = F.try_variant_get(response, "$", "array<variant>")
    if not key:
        return bare
    here = F.try_variant_get(response, f"$.{key}", "variant")
    keyed = F.when(here.isNotNull(), F.try_variant_get(here, "$", "array<variant>")) \
        .when(_is_object(response), F.array().cast("array<variant>"))
    # This feed also answers with the list itself.
    return F.coalesce(bare, keyed) if feed == "arbeitnow" else keyed


def _is_object(value: Column) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))


def _objects(feed: str, fields: Callable[[Column], Sequence[Column]]) -> Column:
    """The response's entries as structs of ``fields``; null in the place of one that is no object.

    They are made inside the list: a filter on a column that is computed after the generator would
    compute it once more.
    """
    return bind(F.try_parse_json("body"), lambda response: F.transform(
        _list(response, feed), lambda e: F.when(_is_object(e), F.struct(*fields(e)))))


def _text(entry: Column, path: str, default: str | None = None) -> Column:
    """A field as text: the default where it is absent, null where it is null."""
    value = F.try_variant_get(entry, f"$.{path}", "string")
    if default is None:
        return value
    absent = F.try_variant_get(entry, f"$.{path}", "variant").isNull()
    return F.when(absent, F.lit(default)).otherwise(value)


def _amount(entry: Column, path: str) -> Column:
    """A number as text; one that is written with a point keeps it."""
    def shown(value: Column) -> Column:
        text = F.try_variant_get(value, "$", "string")
        cut = F.startswith(F.schema_of_variant(value), F.lit("DECIMAL")) & ~F.contains(text, F.lit("."))
        return F.when(cut, F.concat(text, F.lit(".0"))).otherwise(text)

    return bind(F.try_variant_get(entry, f"$.{path}", "variant"), shown)


def _texts(entry: Column, path: str) -> Column:
    return F.try_variant_get(entry, f"$.{path}", "array<string>")


def _truth(entry: Column, path: str) -> Column:
    """Whether a field says yes: a number other than 0, a text, list or object that is not empty."""
    def says(value: Column) -> Column:
        text = F.try_variant_get(value, "$", "string")
        empty = text.isin("false", "[]", "{}") | (F.coalesce(text.try_cast("double"), F.lit(1.0)) == 0)
        plain = F.schema_of_variant(value) == "STRING"
        return F.coalesce(F.when(plain, text != "").otherwise(~empty), F.lit(False))

    return bind(F.try_variant_get(entry, f"$.{path}", "variant"), says)


def rejected(landed: DataFrame) -> DataFrame:
    """Responses that can't be read, and entries that are no object: LANDED, ``pos``, ``reason``.

    ``pos`` is null for a whole response; ``body`` is the response's, or the entry's, text.  An
    object that names a field twice is not JSON here.
    """
    def faults(feed: str, response: Column) -> Column:
        def of(entries: Column) -> Column:
            whole = F.when(F.col("body").isNull() | (strip(F.col("body")) == ""), EMPTY) \
                .when(response.isNull(), NOT_JSON).when(entries.isNull(), NO_LIST)
            # The notice ahead of this feed's entries may be anything.
            first = 1 if feed == "remoteok" else 0
            odd = F.filter(F.transform(entries, lambda e, i: F.when(
                ~_is_object(e) & (i >= first), F.struct(
                    i.alias("pos"), F.lit(NO_OBJECT).alias("reason"), F.to_json(e).alias("body")))),
                lambda x: x.isNotNull())
            return F.when(whole.isNotNull(), F.array(F.struct(
                F.lit(None).cast("int").alias("pos"), whole.alias("reason"),
                F.col("body").alias("body")))).otherwise(odd)

        return bind(_list(response, feed), of)

    found = F.when(F.col("source").isin(list(ENTRIES)), bind(F.try_parse_json("body"), lambda v: reduce(
        lambda rest, feed: F.when(F.col("source") == feed, faults(feed, v)).otherwise(rest),
        ENTRIES, F.lit(None).cast("array<struct<pos:int,reason:string,body:string>>"))))
    blank = F.col("body").isNull() | (strip(F.col("body")) == "")
    found = F.when((F.col("source") == "wellfound") & blank, F.array(F.struct(
        F.lit(None).cast("int").alias("pos"), F.lit(EMPTY).alias("reason"),
        F.col("body").alias("body")))).otherwise(found)
    return landed.select("cycle", "source", "request", "query", F.explode_outer(found).alias("f")) \
        .where(F.col("f").isNotNull()).select("cycle", "source", "request", "query", "f.pos",
                                              "f.reason", "f.body")


def remoteok(landed: DataFrame, categories: Sequence[str], regions: Sequence[str],
             now: Column | None = None, limit: int | None = None) -> DataFrame:
    """Entry 0 is a notice; the others, or the next ``limit``, are filtered."""
    def fields(e: Column) -> list[Column]:
        address = F.concat(F.lit(REMOTEOK_JOB), F.coalesce(_text(e, "slug", ""), F.lit("None")))
        absent = F.try_variant_get(e, "$.url", "variant").isNull()
        return [_text(e, "position", "Unknown").alias("title"),
                _text(e, "company", "Unknown").alias("company"),
                _text(e, "description", "").alias("description"),
                _text(e, "location", "Remote").alias("location"),
                _amount(e, "salary").alias("salary"),
                F.when(absent, address).otherwise(_text(e, "url")).alias("url"),
                _texts(e, "tags").alias("tags")]

    rows = _entries(landed, "remoteok", _objects("remoteok", fields), 1, limit)
    rows = _postings(rows, "remoteok", now, salary=F.col("e.salary"), tags=F.col("e.tags"),
                     is_remote=F.lit(True))
    return rows.where(
        rules.contains_category(_blob(), categories)
        & rules.matches_region_or_remote(F.col("location"), regions)
    )


def arbeitnow(landed: DataFrame, categories: Sequence[str], regions: Sequence[str],
              now: Column | None = None, limit: int | None = None) -> DataFrame:
    """All entries, or the first ``limit``, filtered; the response is an object or a bare list."""
    def fields(e: Column) -> list[Column]:
        return [_text(e, "title", "Unknown").alias("title"),
                _text(e, "company_name", "Unknown").alias("company"),
                _text(e, "description", "").alias("description"),
                _text(e, "location", "Unknown").alias("location"),
                _text(e, "url", "").alias("url"),
                _texts(e, "tags").alias("tags"), _truth(e, "remote").alias("remote")]

    rows = _entries(landed, "arbeitnow", _objects("arbeitnow", fields), 0, limit)
    rows = _postings(rows, "arbeitnow", now, tags=F.col("e.tags"), is_remote=F.col("e.remote"))
    return rows.where(rules.contains_category(_blob(), categories)
                      & rules.matches_region(F.col("location"), regions))


def adzuna(landed: DataFrame, now: Column | None = None, limit: int | None = None) -> DataFrame:
    """Search results, one response per phrase and country; the search has filtered them.

    ``limit`` takes the first so many of every response.
    """
    def fields(e: Column) -> list[Column]:
        return [_text(e, "title", "Unknown").alias("title"),
                _text(e, "company.display_name", "Unknown").alias("company"),
                _text(e, "description", "").alias("description"),
                _text(e, "location.display_name", "Unknown").alias("location"),
                _amount(e, "salary_min").alias("salary"), _text(e, "redirect_url", "").alias("url")]

    rows = _entries(landed, "adzuna", _objects("adzuna", fields), 0, limit)
    return _postings(rows, "adzuna", now, salary=F.col("e.salary"), tags=F.array("query"),
                     is_remote=_says_remote(F.col("e.description")))


def jsearch(landed: DataFrame, now: Column | None = None, limit: int | None = None) -> DataFrame:
    """The search results of every phrase, or the first ``limit`` of them."""
    def fields(e: Column) -> list[Column]:
        place = F.concat(blank_to(_text(e, "job_city"), ""), F.lit(", "),
                         blank_to(_text(e, "job_country"), ""))
        return [_text(e, "job_title", "Unknown").alias("title"),
                _text(e, "employer_name", "Unknown").alias("company"),
                _text(e, "job_description", "").alias("description"),
                F.btrim(place, F.lit(", ")).alias("location"),
                _amount(e, "job_salary").alias("salary"), _text(e, "job_apply_link", "").alias("url"),
                _truth(e, "job_is_remote").alias("remote")]

    rows = _entries(landed, "jsearch", _objects("jsearch", fields), 0, limit)
    return _postings(rows, "jsearch", now, salary=F.col("e.salary"), tags=F.array("query"),
                     is_remote=F.col("e.remote"))


def _postings(rows: DataFrame, feed: str, now: Column | None, **more: Column) -> DataFrame:
    """Entries that are objects, in the posting schema."""
    named = {c: F.col(f"e.{c}") for c in ("title", "company", "description", "location", "url")}
    return rows.where(F.col("e").isNotNull()).select("cycle", "request", "pos", *unified_schema(
        now if now is not None else iso_now(), source=F.lit(feed), **named, **more))


def wellfound(landed: DataFrame, categories: Sequence[str], regions: Sequence[str],
              now: Column | None = None, limit: int | None = None,
              shortest: int = SHORTEST_CARD) -> DataFrame:
    """Job cards of a listing page that pass the filters, or the first ``limit`` of them.

    Cards are the marked blocks of the page, or every block where none is marked.  The page is
    cut by pattern: a marked card reaches up to the next one.  An unmarked block reaches to the tag
    that closes it, inner blocks included, and each inner block is a card as well.
    """
    def pieces(start: str) -> Column:
        # The blank keeps a block at the very beginning from becoming the part before it.
        parts = F.split(F.concat(F.lit(" "), F.col("body")), f"(?i)(?={start})")
        return F.slice(parts, 2, 1 << 30)

    marked = pieces(f"<div\\b[^>]*{CARD_MARK}")
    page = F.when(F.col("body").rlike(f"(?i)<div\\b[^>]*{CARD_MARK}"), marked) \
        .otherwise(_nested_blocks(pieces(r"</?div\b")))
    # Texts are made inside the list: a filter on a column that is computed after the generator
    # would compute it once more.
    cards = _entries(landed, "wellfound", F.transform(page, lambda html: bind(
        visible_text(html),
        lambda text: F.struct(html.alias("html"), text.alias("text"),
                              _first_location(text).alias("place")),
    )))
    location = F.col("e.place")
    cards = cards.where(
        (F.length("e.text") >= shortest)
        & rules.contains_category(F.col("e.text"), categories)
        & rules.matches_region(location, regions))

    def inner(names: str) -> Column:
        """Content of the first such element of the card, 'Unknown' without one."""
        found = F.col("e.html").rlike(f"(?is)<({names})\\b")
        content = F.regexp_extract("e.html", f"(?is)<({names})\\b[^>]*>(.*?)</\\1\\s*>", 2)
        return F.when(found, content).otherwise(F.lit("Unknown"))

    cards = cards.withColumn("names", F.transform(
        F.array(inner("h2|h3|a"), inner("span")), visible_text))
    link = unescape_html(F.regexp_extract(
        "e.html", r"""(?is)<a\b[^>]*?\bhref\s*=\s*(["'])(.*?)\1""", 2))
    rows = cards.select(
        "cycle", "request", "pos",
        *unified_schema(
            now if now is not None else iso_now(),
            title=F.get("names", F.lit(0)),
            company=F.get("names", F.lit(1)),
            description=F.col("e.text"),
            source=F.lit("wellfound"),
            location=location,
            url=F.when(F.startswith(link, F.lit("/")), F.concat(F.lit(WELLFOUND_SITE), link))
            .otherwise(link),
            is_remote=_says_remote(F.col("e.text")),
        ),
    )
    return _first(rows, limit)


def _nested_blocks(tags: Column) -> Column:
    """The blocks of a page that was cut before every opening and closing tag, in page order.

    A block ends where the depth falls below its own for the first time, or with the page.
    """
    def opens(piece: Column) -> Column:
        return F.when(F.startswith(piece, F.lit("</")), -1).otherwise(1)

    def blocks(parts: Column) -> Column:
        # Depth after each tag.
        depth = F.aggregate(parts, F.array().cast("array<int>"), lambda acc, p: F.concat(
            acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + opens(p))))

        def cut(depths: Column) -> Column:
            def block(piece: Column, i: Column) -> Column:
                rest = F.slice(depths, i + 1, F.size(depths))
                inside = F.array_position(
                    F.transform(rest, lambda d: d < F.get(depths, i)), F.lit(True))
                n = F.when(inside > 0, inside - 1).otherwise(F.size(rest))
                return F.when(opens(piece) > 0, F.array_join(
                    F.slice(parts, i + 1, n.cast("int")), ""))

            return F.filter(F.transform(parts, block), lambda x: x.isNotNull())

        return bind(depth, cut)

    return bind(tags, blocks)


def _first_location(text: Column) -> Column:
    """The first place name in the text, as it is written there, else 'Unknown'."""
    # Plain searches rule out most texts; the pattern has to look at every character.
    named = bind(F.lower(text), lambda low: rules.any_of(
        [F.contains(low, F.lit(n.lower())) for n in CARD_LOCATIONS]))
    found = F.regexp_extract(text, f"(?i)({'|'.join(CARD_LOCATIONS)})", 1)
    return F.coalesce(F.nullif(F.when(named, found), F.lit("")), F.lit("Unknown"))


def hackernews(landed: DataFrame, categories: Sequence[str], regions: Sequence[str],
               now: Column | None = None, limit: int | None = None,
               company_length: int | None = None) -> DataFrame:
    """Comments of a hiring thread that pass the filters, or the first ``limit`` of them.

    The company is what stands before the first bar, cut to ``company_length`` characters if given.
    """
    comments = _entries(landed, "hackernews", _objects("hackernews", lambda c: [
        _text(c, "id").alias("id"), html_to_text(_text(c, "text")).alias("text")]))
    text = F.col("e.text")
    remote = _says_remote(text)
    location = F.when(remote, F.lit("Remote")).otherwise(F.lit("Unknown"))
    comments = comments.where((text != "") & rules.contains_category(text, categories)
                              & rules.matches_region(location, regions))
    low = F.lower(text)
    title = F.lit("Software Engineer")
    for name in reversed(list(categories)):
        phrase = rules.CATEGORY_QUERIES.get(name, name).title()
        title = F.when(F.contains(low, F.lit(name)), F.lit(phrase)).otherwise(title)
    company = strip(F.substring_index(text, "|", 1))
    if company_length is not None:
        company = F.left(company, F.lit(company_length))
    postings = comments.select(
        "cycle", "request", "pos",
        *unified_schema(
            now if now is not None else iso_now(),
            title=title,
            company=F.when(company == "", F.lit("Unknown")).otherwise(company),
            description=text,
            source=F.lit("hackernews"),
            location=location,
            url=F.concat(F.lit(HACKERNEWS_ITEM), F.coalesce(F.col("e.id"), F.lit("None"))),
            is_remote=remote,
        ),
    )
    return _first(postings, limit)


def latest_thread(body: Column) -> Column:
    """Id of the first search hit, null without hits."""
    hits = F.from_json(body, "struct<hits:array<struct<objectID:string>>>")["hits"]
    return F.get(hits, F.lit(0))["objectID"]


def _blob() -> Column:
    """What the category filter searches; a null title or description is the word None in it."""
    return category_text(blank_to(F.col("title"), "None"), blank_to(F.col("description"), "None"),
                         F.col("tags"))


def _says_remote(text: Column) -> Column:
    return F.contains(F.lower(blank_to(text, "")), F.lit("remote"))


@dataclass(frozen=True)
class Adapter:
    """How one feed is read; ``filtered`` adapters apply the category and region filters."""

    read: Callable[..., DataFrame]
    filtered: bool


ADAPTERS = {
    "remoteok": Adapter(remoteok, True),
    "arbeitnow": Adapter(arbeitnow, True),
    "wellfound": Adapter(wellfound, True),
    "hackernews": Adapter(hackernews, True),
    "adzuna": Adapter(adzuna, False),
    "jsearch": Adapter(jsearch, False),
}
