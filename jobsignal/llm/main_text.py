"""The main text of a page, by block rules in two passes.

The first pass judges each block of text by itself: blocks in menus, footers and the like and
blocks that are mostly links are bad, long blocks dense in stop words are good, and the rest is
undecided.  In the second pass undecided blocks, short ones above all, inherit the label of the
nearest decided block before or after them.

Where a page has an `article` (else a `main`) element with text, its blocks alone are candidates,
and its borders count as decided neighbours that are good.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.llm.tables import ship

# Frequent function words of four languages.
STOP_WORDS = {
    "en": "a an and are as at be but by for from had has have he her his i in is it not of on or "
          "she that the their they this to was we were which with you",
    "de": "als am auch auf aus bei das dem den der des die ein eine einen er es für hat ich im in "
          "ist mit nicht sich sie sind und von war wie zu zum",
    "fr": "au aux avec ce ces dans de des du elle en est et il je la le les mais ne nous on ou par "
          "pas plus pour qu que qui sa se son sur un une",
    "es": "al como con de del el en es esta este la las lo los más mi no o para pero por que se "
          "su sus un una y ya",
}
# Elements that start a block of their own.
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt "
             "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html "
             "legend li main menu nav ol optgroup option p pre search section select summary table "
             "tbody td tfoot th thead tr ul".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# Elements whose text is no part of an article, and elements without an end tag.
APART = set("nav header footer aside form menu search dialog noscript template svg button select "
            "object audio video canvas map".split())
SINGLE = set("li dt dd td th tr option".split())  # a second one ends the first
LEAVES = HEADINGS | {"p"}  # end where the next block begins
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Words of a class, id or role that name such parts.
NAMES = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs complementary "
            "consent contentinfo cookie cookies footer gdpr header login masthead menu modal nav "
            "navbar navigation newsletter notice notices pager pagination popup promo promotion related "
            "share sharing sidebar signup skip social sponsor sponsored subscribe toolbar "
            "widget".split())
REPLIES = set("comment comments commentlist disqus replies reply".split())

_ATTRS = r"""(?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+"""
TOKEN = re.compile(rf"<!--|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>{_ATTRS})>|<[!?/][^>]*>",
                   re.I)
# Elements whose content is no markup.
RAW = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in
       "script style title textarea iframe noembed noframes xmp".split()}
_OPEN = re.compile(r"<[a-z/!?]", re.I)
_HREF = re.compile(r"\bhref\b", re.I)
_NAMED = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORD = re.compile(r"[^\W\d_]+")

GOOD, BAD, UNDECIDED = "good", "bad", None


@dataclass(frozen=True)
class Rules:
    """Lengths are in code points, shares of words and of characters in links."""

    short: int = 60
    dense: float = 0.2
    sparse: float = 0.05
    links: float = 0.5
    stop_words: frozenset[str] = frozenset(" ".join(STOP_WORDS.values()).split())


@dataclass
class Element:
    name: str
    parent: Element | None
    marks: str = ""  # "tag", "name" or "reply" where it is no part of an article
    closed: bool = False
    frame: bool = False  # holds an article or main element, or is a form with a first heading
    out: bool = False  # it or an element around it is no part of an article
    region: str = ""  # the nearest of article and main around it

    def settle(self) -> None:
        """Whether its text is left out; its parent is settled before.

        A part that holds an article is a frame around the page and no menu, if only a name says
        so, it is a form, or no end tag closes it.  Replies are left out even so.
        """
        frame = self.frame and (self.marks == "name" or self.name == "form" or not self.closed)
        own = self.marks == "reply" or (self.marks and not frame)
        self.out = bool(own) or bool(self.parent and self.parent.out)
        around = self.parent.region if self.parent else ""
        self.region = self.name if self.name in ("article", "main") and around != "article" \
            else around


@dataclass
class Block:
    inside: Element
    heading: bool = False
    pieces: list[list] = field(default_factory=list)  # [text, in a link]
    text: str = ""
    links: float = 0.0  # share of its characters
    label: str | None = UNDECIDED


def _marks(name: str, attrs: str, in_article: bool) -> str:
    if name in ("html", "body", "main"):
        return ""
    found = set()
    if "=" in attrs:
        for m in _NAMED.finditer(attrs):
            found.update(w.lower() for w in _PART.findall(m[1]))
    if found & REPLIES or (name == "article" and in_article):
        return "reply"
    if name == "article":
        return ""
    if name in APART:
        return "tag"
    return "name" if found & NAMES else ""


class _Reader:
    """Gathers blocks while tags and text come by."""

    def __init__(self) -> None:
        self.here = Element("", None)
        self.elements = [self.here]
        self.open: dict[str, list[Element]] = {}
        self.block = Block(self.here)
        self.blocks = [self.block]
        self.link: tuple[int, int] | None = None  # block and piece where an open link began

    def text(self, text: str) -> None:
        self.block.pieces.append([text, False])

    def begin(self, inside: Element, heading: bool = False) -> None:
        self.block = Block(inside, heading)
        self.blocks.append(self.block)

    def end_link(self, closed: bool) -> None:
        """Mark what the link holds; without an end tag it only reaches to its block's end."""
        if self.link:
            first, piece = self.link
            for i in range(first, len(self.blocks) if closed else first + 1):
                for p in self.blocks[i].pieces[piece if i == first else 0:]:
                    p[1] = True
        self.link = None

    def pop(self, name: str) -> None:
        """End the innermost open element of this name and those within it."""
        if self.open.get(name):
            while self.here.name != name:
                self.open[self.here.name].pop()
                self.here = self.here.parent
            self.here.closed = True
            self.open[name].pop()
            self.here = self.here.parent

    def tag(self, name: str, end: bool, attrs: str) -> None:
        if name == "a":
            self.end_link(closed=end)
            if not end and _HREF.search(attrs):
                self.link = len(self.blocks) - 1, len(self.block.pieces)
        elif name == "br":
            self.text(" ")
        elif name not in BLOCKS and name not in APART:
            return
        elif end:
            self.pop(name)
            self.begin(self.here)
        else:
            if name in SINGLE and self.here.name == name:
                self.pop(name)
            element = Element(name, self.here, _marks(name, attrs, bool(self.open.get("article"))))
            self.elements.append(element)
            if name not in LEAVES and name not in VOID:
                self.here = element
                self.open.setdefault(name, []).append(element)
            if name in ("article", "main"):
                e = element.parent
                while e and not e.frame:
                    e.frame, e = True, e.parent
            if name == "h1" and self.open.get("form"):
                self.open["form"][-1].frame = True
            self.begin(element if name in LEAVES else self.here, name in HEADINGS)


def blocks(page: str) -> list[Block]:
    """The blocks of a page that have text, in order, with the elements they lie in.

    Comments, scripts and the like without an end reach to the end of the page, and so does a last
    tag without one.
    """
    reader, at = _Reader(), 0
    last = page.rfind(">") + 1  # behind it there is no further tag
    while m := TOKEN.search(page, at, last):
        if m.start() > at:
            reader.text(page[at:m.start()])
        at = m.end()
        if m[0] == "<!--":
            at = page.find("-->", m.start() + 2) + 3
            at = at if at > 2 else len(page)
        elif name := (m["name"] or "").lower():
            if name in RAW and not m["end"]:
                end = RAW[name].search(page, at)
                at = end.end() if end else len(page)
            else:
                reader.tag(name, bool(m["end"]), m["attrs"])
    reader.text(_OPEN.split(page[at:], maxsplit=1)[0])
    reader.end_link(closed=False)
    for e in reader.elements:
        e.settle()
    for b in reader.blocks:
        shown = [(entities.unescape(t), linked) for t, linked in b.pieces]
        b.text = " ".join("".join(t for t, _ in shown).split())
        if b.text and any(linked for _, linked in shown):
            b.links = sum(len("".join(t.split())) for t, linked in shown if linked) \
                / len("".join(b.text.split()))
    return [b for b in reader.blocks if b.text]


def judge(block: Block, rules: Rules = Rules()) -> str | None:
    """The first pass: the block's label by its own text."""
    if block.links > rules.links:
        return BAD
    if len(block.text) < rules.short or block.heading:
        return UNDECIDED
    words = _WORD.findall(block.text.lower())
    stops = sum(w in rules.stop_words for w in words)
    if words and stops >= rules.dense * len(words):
        return GOOD
    return BAD if stops < rules.sparse * len(words) and not block.inside.region else UNDECIDED


def inherit(found: list[Block], border: str | None) -> None:
    """The second pass: undecided blocks take the label of the nearest decided neighbour.

    `border` is the label behind the first and the last block, if there is one.  A heading looks
    ahead first.  Where both neighbours disagree the nearer one counts, by the characters between;
    in a tie, inside an article, or where nothing is decided, the block stays.
    """
    n = len(found)
    before: list = [(border, 0)] * n
    after: list = [(border, 0)] * n
    for near, order in ((before, range(n)), (after, range(n - 1, -1, -1))):
        label, way = border, 0
        for i in order:
            near[i] = label, way
            if found[i].label:
                label, way = found[i].label, 0
            else:
                way += len(found[i].text)
    for b, (back, back_way), (ahead, ahead_way) in zip(found, before, after):
        if b.label:
            continue
        if back == ahead or not back or not ahead:
            b.label = back or ahead or GOOD
        elif border or back_way == ahead_way:
            b.label = GOOD
        elif b.heading:
            b.label = ahead
        else:
            b.label = back if back_way < ahead_way else ahead


def main_text(page: str | None, rules: Rules = Rules()) -> str:
    """The main text of a page; empty for a null page and one without such a text.

    Character references are decoded and white space is one space; blocks are joined by two line
    feeds.  Nested article elements are taken for replies.
    """
    found = [b for b in blocks(page or "") if not b.inside.out]
    for region in ("article", "main", ""):
        chosen = [b for b in found if not region or b.inside.region == region]
        if chosen:
            break
    for b in chosen:
        b.label = judge(b, rules)
    inherit(chosen, GOOD if region else UNDECIDED)
    return "\n\n".join(b.text for b in chosen if b.label == GOOD)


def texts(page: Column, rules: Rules = Rules()) -> Column:
    @F.arrow_udf("string")
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array([main_text(x.as_py(), rules) for x in pages], pa.string())

    return each(page)


def extracted(df: DataFrame, rules: Rules = Rules(), page: str = "html") -> DataFrame:
    """Add `text` and `n_chars`, its code points; columns of these names are replaced.

    Every row is judged by itself, repeated rows alike.
    """
    return df.withColumn("text", texts(F.col(page), rules)) \
        .withColumn("n_chars", F.length("text").cast("long"))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main texts of all `pages`; an empty table gives no rows."""
    ship(spark)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extracted(pages).select("page_id", "url", "text", "n_chars")


#: The same rows in DuckDB for pages with one article element that holds all of the text, as those
#: of the given tables; the block rules are held against labelled pages in the tests.
SQL = r"""
WITH bodies AS (
  SELECT page_id, url, regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1) AS body
  FROM pages),
cut AS (
  SELECT page_id, url,
         string_split(regexp_replace(body, '</?(p|h[1-6]|div|ul|ol|li)( [^>]*)?>', chr(1), 'g'),
                      chr(1)) AS parts
  FROM bodies),
plain AS (
  SELECT page_id, url, list_transform(parts, lambda x:
           regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g')) AS parts
  FROM cut),
shown AS (
  SELECT page_id, url, list_transform(parts, lambda x: trim(regexp_replace(
           replace(replace(replace(replace(replace(x, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'),
             '&amp;', '&'), '&amp', '&'),
           '\s+', ' ', 'g'))) AS parts
  FROM plain),
joined AS (
  SELECT page_id, url, coalesce(array_to_string(list_filter(parts, lambda x: x <> ''),
                                                chr(10) || chr(10)), '') AS text
  FROM shown)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM joined
"""
