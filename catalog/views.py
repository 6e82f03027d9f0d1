"""The given tables seen as postings, resumes, markets, feed responses and filter rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobsignal.dictionaries import POSTINGS, RESUMES, SkillDictionary

# Frequent words and phrases of the invented prose, next to two real skill names; more of them
# than any top list is long.
TEXT_TERMS = SkillDictionary.titled(
    ["that", "with", "this", "from", "rest", "apache", "of the", "in the", "the", "and", "for",
     "was", "are", "les", "des", "qui", "pour", "par", "und", "der", "die", "das", "mit", "ein",
     "los", "las", "que", "con", "una"])
VOCABULARY = SkillDictionary({**POSTINGS.display, **TEXT_TERMS.display})
RESUME_TERMS = SkillDictionary({
    **RESUMES.display,
    **SkillDictionary.cased(["That", "With", "From", "The", "Rest", "La", "Un", "of the"]).display,
})
CATEGORIES = ("that", "rest of")
CATEGORY_PHRASES = {"rest of": "in the"}
REGIONS = ("us", "remote")
SMALL_PAYLOAD = 64
LARGE_PAYLOAD = 128
# What the list of entries is called in a response; "" is the response itself.
WRAPS = {"remoteok": "", "arbeitnow": "data", "adzuna": "results", "jsearch": "data"}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up in the file once, which takes a job of its own."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def first_line(text: str | Column = "text") -> Column:
    return F.substring_index(text, "\n", 1)


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as postings; ``doc_id`` is the feed order."""
    posted = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id"))
    stamp = F.date_format(F.to_utc_timestamp(posted, F.current_timezone()),
                          "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return documents(spark, sf_dir).select(
        "doc_id",
        first_line().alias("title"),
        F.col("source").alias("company"),
        F.col("text").alias("description"),
        "source",
        F.col("lang").alias("location"),
        F.col("n_chars").cast("string").alias("salary"),
        F.concat(F.lit("/doc/"), "doc_id").alias("url"),
        F.array("lang").alias("tags"),
        (F.col("doc_id") % 2 == 0).alias("is_remote"),
        stamp.alias("timestamp"),
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def part_skill() -> Column:
    return F.concat_ws(" ", "p_type", F.col("p_size").cast("string"))


def parts_market(spark: SparkSession, sf_dir: str, fold: int | None = None) -> DataFrame:
    """(skill, count): lines sold per part type and size.

    ``fold`` keeps the remainder only, which spreads the skills over all priority tiers.
    """
    lines = table(spark, sf_dir, "lineitem")
    lines = lines.groupBy("l_partkey").agg(F.count("*").alias("n"))
    parts = table(spark, sf_dir, "part").select("p_partkey", part_skill().alias("skill"))
    sold = (lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy("skill").agg(F.sum("n").alias("count")))
    return sold if fold is None else sold.withColumn("count", F.col("count") % fold)


def offer() -> Column:
    """A part and its supplier."""
    return F.concat_ws(" ", "p_type", F.col("l_partkey").cast("string"),
                       F.col("l_suppkey").cast("string"))


def offers_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(skill, count): pieces sold per part and supplier."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("count"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")) \
        .select(offer().alias("skill"), "count")


def buyers(spark: SparkSession, sf_dir: str, skill: Column | None = None) -> DataFrame:
    """(resume_id, pos, skill): customers and the part types and sizes they bought.

    ``skill`` names what was bought in another way.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    bought = (lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
              .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .groupBy(F.col("o_custkey").alias("resume_id"),
                       (part_skill() if skill is None else skill).alias("skill"))
              .agg(F.min(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos")))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("resume_id"))
    return customers.join(bought, "resume_id", "left").select("resume_id", "pos", "skill")


def buyer_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(resume_id, skills): the same, one row per customer; a list holds part kinds only."""
    rows = buyers(spark, sf_dir).groupBy("resume_id").agg(F.array_sort(F.collect_list(
        F.when(F.col("skill").isNotNull(), F.struct("pos", "skill")))).alias("s"))
    return rows.select("resume_id", F.transform("s", lambda e: e["skill"]).alias("skills"))


# Feed responses -----------------------------------------------------------------------------


Field = Callable[[str], Column]


def _place(d: Field) -> Column:
    lang = d("lang")
    return (F.when(lang == "en", "Austin, USA").when(lang == "de", "Berlin")
            .when(lang == "fr", F.lit(None)).otherwise("Remote"))


def _every(d: Field, n: int, value: Column) -> Column:
    """``value``, left out for every ``n``-th document."""
    return F.when(d("doc_id") % n != 0, value)


def _shared(docs: DataFrame, *columns: str) -> DataFrame:
    """Consecutive documents in one row, as many as the largest response holds.

    Every feed packs its responses from these rows, and Spark shuffles the documents once for all
    feeds that are read together.
    """
    return docs.groupBy(F.floor(F.col("doc_id") / LARGE_PAYLOAD).alias("n")).agg(
        F.collect_list(F.struct("doc_id", *columns)).alias("docs"))


def _entries(docs: str | Column, entry: Callable[[Field], Column]) -> Column:
    """The entries of the documents of a list, in the order of ``doc_id``."""
    listed = F.array_sort(F.transform(docs, lambda d: F.struct(
        d["doc_id"].alias("doc_id"), entry(lambda c: d[c]).alias("e"))))
    return F.transform(listed, lambda e: e["e"])


def _responses(shared: DataFrame, feed: str, size: int, entry: Callable[[Field], Column],
               wrap: str) -> DataFrame:
    """Consecutive documents packed into responses of ``size`` entries each."""
    text = F.concat(F.lit("["), F.array_join(_entries("docs", entry), ","), F.lit("]"))
    body = text if not wrap else F.concat(F.lit('{"' + wrap + '":'), text, F.lit("}"))
    return _landed(_cut(shared, size), feed, body)


def _cut(shared: DataFrame, size: int) -> DataFrame:
    """The shared rows cut into lists of ``size`` documents, which divides theirs."""
    if size == LARGE_PAYLOAD:
        return shared

    def number(d: Column) -> Column:
        return F.floor(d["doc_id"] / size)

    numbers = F.array_distinct(F.transform("docs", number))
    # The outer form keeps the optimizer from listing the numbers a second time.
    return shared.select("docs", F.explode_outer(numbers).alias("n")).select(
        "n", F.filter("docs", lambda d: number(d).eqNullSafe(F.col("n"))).alias("docs"))


def _landed(packed: DataFrame, feed: str, body: Column) -> DataFrame:
    """Responses of even and odd numbers belong to two cycles."""
    return packed.select(
        F.concat(F.lit("c"), F.col("n") % 2).alias("cycle"),
        F.lit(feed).alias("source"),
        F.col("n").cast("int").alias("request"),
        F.concat(F.lit("phrase "), F.col("n") % 3).alias("query"),
        body.alias("body"),
    )


def _document_entry(feed: str, d: Field) -> Column:
    """A document as an entry of the feed's response."""
    title, text, source, doc_id = first_line(d("text")), d("text"), d("source"), d("doc_id")
    if feed == "remoteok":
        return F.to_json(F.struct(
            _every(d, 5, title).alias("position"), source.alias("company"),
            text.alias("description"), F.array(d("lang")).alias("tags"),
            _place(d).alias("location"), d("n_chars").alias("salary"),
            _every(d, 2, F.concat(F.lit("/r/"), doc_id)).alias("url"),
            F.concat(F.lit("doc-"), doc_id).alias("slug")))
    if feed == "arbeitnow":
        return F.to_json(F.struct(
            title.alias("title"), text.alias("description"),
            _every(d, 3, F.array(d("lang"))).alias("tags"), _place(d).alias("location"),
            _every(d, 4, source).alias("company_name"),
            F.concat(F.lit("/a/"), doc_id).alias("url"),
            _every(d, 2, F.lit(True)).alias("remote")))
    if feed == "adzuna":
        return F.to_json(F.struct(
            title.alias("title"), F.struct(_every(d, 4, source).alias("display_name"))
            .alias("company"), text.alias("description"),
            F.struct(_place(d).alias("display_name")).alias("location"),
            (d("n_chars") + F.lit(0.5)).alias("salary_min"),
            F.concat(F.lit("/z/"), doc_id).alias("redirect_url")))
    if feed == "jsearch":
        return F.to_json(F.struct(
            _every(d, 5, title).alias("job_title"), source.alias("employer_name"),
            text.alias("job_description"), _every(d, 3, F.lit("Paris")).alias("job_city"),
            _every(d, 2, d("lang")).alias("job_country"),
            F.lit(None).cast("string").alias("job_salary"),
            F.concat(F.lit("/j/"), doc_id).alias("job_apply_link"),
            (doc_id % 2 == 0).alias("job_is_remote")))
    if feed == "wellfound":
        return F.concat(
            F.lit('<div class="x" data-test="JobSearchResult"><h2>'), title, F.lit("</h2>"),
            F.coalesce(_every(d, 4, F.concat(F.lit("<span>"), source, F.lit("</span>"))), F.lit("")),
            F.lit('<a href="/jobs/'), doc_id.cast("string"), F.lit('?a=1&amp;b=2">'),
            F.coalesce(_place(d), F.lit("-")), F.lit("</a><p>"), text, F.lit("</p></div>"))
    raise ValueError(feed)


def landed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    if feed == "hackernews":
        pages = table(spark, sf_dir, "pages").withColumnRenamed("page_id", "doc_id")
        # Comments open with the company; pages carry real tags and character references.
        return _responses(_shared(pages, "url", "html"), feed, LARGE_PAYLOAD, lambda d: F.to_json(
            F.struct(d("doc_id").alias("id"), _every(d, 9, F.concat(
                F.lit("<b>"), d("url"), F.lit("</b> | "), d("html"))).alias("text"))), "children")
    shared = _shared(documents(spark, sf_dir), "text", "source", "lang", "n_chars")

    def entry(d: Field) -> Column:
        return _document_entry(feed, d)

    if feed == "wellfound":
        cards = F.array_join(_entries("docs", entry), "\n")
        return _landed(shared, feed, F.concat(F.lit("<html><body>"), cards, F.lit("</body>")))
    size = LARGE_PAYLOAD if feed == "arbeitnow" else SMALL_PAYLOAD
    return _responses(shared, feed, size, entry, WRAPS[feed])


def _field(d: Field, name: str, value: Column, stretch: int) -> Column:
    """A JSON field that is absent, null or ``value``, by turns of ``stretch`` documents."""
    turn = F.floor(d("doc_id") / stretch) % 3
    text = F.to_json(F.struct(value.alias(name)))
    given = F.nullif(F.substr(text, F.lit(2), F.length(text) - 2), F.lit(""))
    return F.when(turn == 1, F.lit(f'"{name}":null')).when(turn == 2, given)


def _sparse_entry(feed: str, d: Field) -> Column:
    title, text, source, lang = first_line(d("text")), d("text"), d("source"), d("lang")
    fields = {
        "remoteok": [("position", title, 1), ("company", source, 2), ("description", text, 4),
                     ("location", lang, 5), ("url", source, 7), ("slug", title, 8),
                     ("tags", F.array(lang), 10), ("salary", d("n_chars"), 11)],
        "arbeitnow": [("title", title, 1), ("company_name", source, 2), ("description", text, 4),
                      ("location", lang, 5), ("url", source, 7),
                      ("tags", F.array(lang), 10), ("remote", d("doc_id") % 2 == 0, 11)],
        "adzuna": [("title", title, 1), ("company", F.struct(source.alias("display_name")), 2),
                   ("description", text, 4), ("redirect_url", source, 7),
                   ("salary_min", d("n_chars"), 11)],
        "jsearch": [("job_title", title, 1), ("employer_name", source, 2),
                    ("job_description", text, 4), ("job_city", lang, 5),
                    ("job_country", source, 7), ("job_apply_link", source, 8),
                    ("job_is_remote", d("n_chars") % 2, 11)],
    }[feed]
    return F.concat(F.lit("{"), F.concat_ws(",", *[_field(d, *f) for f in fields]), F.lit("}"))


def sparse_landed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """Responses whose fields are absent, null or given."""
    shared = _shared(documents(spark, sf_dir), "text", "source", "lang", "n_chars")
    return _responses(shared, feed, SMALL_PAYLOAD, lambda d: _sparse_entry(feed, d), WRAPS[feed])


#: What a response of each remainder has suffered; 0 is whole.
TRUNCATED, STRAY, LISTLESS = 1, 2, 3


def damaged_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three feeds' responses, of which one in four is whole."""
    frames = [landed(spark, sf_dir, f) for f in ("remoteok", "adzuna", "jsearch")]
    rows = frames[0].unionByName(frames[1]).unionByName(frames[2])
    body, kind = F.col("body"), F.col("request") % 4
    stray = F.regexp_replace(body, r"\](\}?)$", ",7]$1")
    return rows.withColumn("body", F.when(kind == TRUNCATED, F.left(body, F.length(body) - 3))
                           .when(kind == STRAY, stray)
                           .when(kind == LISTLESS, F.lit('{"results":null,"data":7}'))
                           .otherwise(body))


def all_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [landed(spark, sf_dir, f) for f in
              ("remoteok", "arbeitnow", "wellfound", "hackernews", "adzuna", "jsearch")]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def filter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One filter row per customer, with blanks, repeats and unknown names among the values."""
    k = F.col("c_custkey")

    def pick(shift: int, *names: str) -> Column:
        values = F.array(*[F.lit(n) for n in names])
        return F.get(values, F.pmod(k + shift, F.lit(len(names))).cast("int"))

    categories = F.array(
        pick(0, " Data Science", "devops", "machine learning ", "ML Engineer", "cook", " "),
        pick(0, "devops engineer", "", "sde", "machine learning", " full stack\t"))
    regions = F.array(pick(0, "US", " uk", "eu", "mars", "remote", "global", " "),
                      pick(2, "gb", "germany", "Canada ", "au", "", "  "))
    return table(spark, sf_dir, "customer").select(
        k.alias("filter_id"),
        categories.alias("categories"),
        regions.alias("regions"),
        F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("enabled"),
        F.when(k % 4 != 0, (k % 4 * 200).cast("int")).alias("refresh_interval"),
        F.when(k % 5 == 0, F.array(F.lit("Adzuna "))).when(k % 5 == 1, F.array().cast(
            "array<string>")).alias("sources"),
        F.lit(None).cast("string").alias("last_updated"),
    )
