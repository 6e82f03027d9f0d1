"""Plain SQL for the registered queries, written from the rules and not from the Spark plans."""

from __future__ import annotations

from catalog import views as V
from jobsignal.dictionaries import BASIC, POSTINGS, SkillDictionary

# --- fixed values, stated once more so that a wrong one in the library shows -----------------
SPACE_CHARS = "".join(map(chr, [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203),
                                8232, 8233, 8239, 8287, 12288]))
CATEGORY_QUERIES = {
    "data science": "data scientist",
    "software engineer": "software engineer",
    "ml engineer": "machine learning engineer",
    "machine learning": "machine learning engineer",
    "data analyst": "data analyst",
    "devops engineer": "devops engineer",
    "devops": "devops engineer",
    "full stack developer": "full stack developer",
    "full stack": "full stack developer",
    "sde": "software development engineer",
}
REGION_COUNTRIES = {
    "us": "us", "uk": "gb", "gb": "gb", "eu": "de", "germany": "de", "de": "de",
    "canada": "ca", "ca": "ca", "australia": "au", "au": "au",
}
REGION_TOKENS = (
    (("us",), (" united states", " usa", " us", "new york", "california", "texas")),
    (("uk", "gb"), (" united kingdom", " uk", "london", "england", "gb")),
    (("eu", "de", "germany"), (" germany", "berlin", "munich", "europe", "eu")),
    (("canada", "ca"), (" canada", "toronto", "vancouver", "montreal")),
)
EXCELLENT = "Excellent! Your skills are well-aligned with market demand."
GOOD = "Good skill set! Some areas for improvement identified."
MODERATE = "Moderate skill gap. Consider focusing on high-priority missing skills."
SIGNIFICANT = "Significant skill gap detected. Focus on learning in-demand skills."
NO_MARKET = "Resume analyzed but no market data available for comparison"

W = r"[\p{L}\p{N}_]"
NL = "chr(10)"


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def chars(text: str) -> str:
    """A string of white space characters, spelled by code point."""
    return "||".join(f"chr({ord(c)})" for c in text)


SPACE_SET = chars(SPACE_CHARS)


SPACES = f"('['||{SPACE_SET}||']+')"
NON_SPACES = f"('[^'||{SPACE_SET}||']+')"


def strip(expr: str) -> str:
    return f"trim({expr}, {SPACE_SET})"


def values(dictionary: SkillDictionary) -> str:
    rows = ", ".join(f"({lit(t)}, {lit(n)})" for t, n in dictionary.display.items())
    return f"(VALUES {rows}) AS d(term, skill)"


def words(*names: str) -> str:
    return ", ".join(map(lit, names))


def mentions(texts: str, key: str, dictionary: SkillDictionary, boundary: str = "word") -> str:
    """CTEs ending in ``mention(<key>, skill, mentions)`` over ``texts(<key>, low)``.

    Word terms are counted among the word runs.  The other terms cut the text into pieces, and
    a cut counts if the characters around it are of the right kind.
    """
    if boundary == "word":
        left = f"regexp_full_match(l, '{W}') <> regexp_full_match(left(term, 1), '{W}')"
        right = f"regexp_full_match(r, '{W}') <> regexp_full_match(right(term, 1), '{W}')"
    else:
        left, right = f"NOT regexp_full_match(l, '{W}')", f"NOT regexp_full_match(r, '{W}')"
    return f"""
    dict AS (SELECT * FROM {values(dictionary)}),
    src AS ({texts}),
    run AS (SELECT {key}, unnest(regexp_split_to_array(low, '[^\\p{{L}}\\p{{N}}_]+')) AS term
            FROM src),
    cut AS (SELECT {key}, term, skill, string_split(low, term) AS p
            FROM src JOIN dict ON contains(low, term)
            WHERE NOT regexp_full_match(term, '{W}+')),
    gap AS (SELECT {key}, term, skill, p, unnest(range(1, len(p))) AS i FROM cut),
    around AS (SELECT {key}, term, skill,
                 CASE WHEN p[i] <> '' THEN right(p[i], 1)
                      WHEN i > 1 THEN right(term, 1) ELSE '' END AS l,
                 CASE WHEN p[i + 1] <> '' THEN left(p[i + 1], 1)
                      WHEN i + 1 < len(p) THEN left(term, 1) ELSE '' END AS r
               FROM gap),
    hit AS (SELECT {key}, skill FROM run JOIN dict USING (term)
            WHERE regexp_full_match(term, '{W}+')
            UNION ALL
            SELECT {key}, skill FROM around WHERE ({left}) AND ({right})),
    mention AS (SELECT {key}, skill, count(*) AS mentions FROM hit GROUP BY ALL)"""


LOW_DOCUMENTS = "SELECT doc_id, lower(text) AS low FROM documents"
POSTING = f"""
    posting AS (SELECT doc_id, split_part(text, {NL}, 1) AS title, source AS company,
                       text AS description, source, lang AS location, n_chars FROM documents)"""
CYCLES = POSTING + f""",
    seen AS (SELECT doc_id, {", ".join(f"lower({strip(f'coalesce({c}, {lit(str())})')}) AS {c}"
                                       for c in ("title", "company", "location"))},
                    unnest(CASE WHEN doc_id % 5 = 0 THEN ['c0', 'c1', 'c2']
                                ELSE ['c' || (doc_id % 3)] END) AS cycle FROM posting)"""
LOW_POSTINGS = f"""
    SELECT doc_id, source, (CASE WHEN title <> '' THEN lower(title) || ' ' ELSE '' END)
        || (CASE WHEN description <> '' THEN lower(description) || ' ' ELSE '' END) AS low
    FROM (SELECT doc_id, source, split_part(text, {NL}, 1) AS title, text AS description
          FROM documents)"""


def title_key(title: str = "title", company: str = "company", location: str = "location") -> str:
    return ", ".join(f"lower({strip(f'coalesce({c}, {lit(str())})')})"
                     for c in (title, company, location))


def has_category(low: str, categories=V.CATEGORIES, phrases=V.CATEGORY_PHRASES) -> str:
    needles = dict.fromkeys(n for c in categories for n in (c, phrases.get(c, c)))
    tests = " OR ".join(f"contains({low}, {lit(n)})" for n in needles)
    return f"({low} <> '' AND ({tests}))"


def in_region(location: str, regions: tuple[str, ...]) -> str:
    if not regions or "global" in regions:
        return "true"
    loc = f"lower(coalesce({location}, ''))"
    tests = ["false"]
    if "remote" in regions:
        tests.append(f"contains({loc}, 'remote') OR {loc} = ''")
    for names, tokens in REGION_TOKENS:
        if set(names) & set(regions):
            tests.extend(f"contains({loc}, {lit(t)})" for t in tokens)
    return "(" + " OR ".join(tests) + ")"


def entities(expr: str) -> str:
    """The character references that occur in the pages."""
    for name, char in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"')):
        expr = f"replace({expr}, '{name}', '{char}')"
    return f"regexp_replace({expr}, '&amp;?', '&', 'g')"


def html_text(expr: str) -> str:
    no_tags = f"regexp_replace({expr}, '<[^>]+>', ' ', 'g')"
    return strip(entities(f"regexp_replace({no_tags}, {SPACES}, ' ', 'g')"))


# Feeds --------------------------------------------------------------------------------------

PLACE = ("CASE lang WHEN 'en' THEN 'Austin, USA' WHEN 'de' THEN 'Berlin' "
         "WHEN 'fr' THEN NULL ELSE 'Remote' END")
POSTING_COLUMNS = ("cycle, source, request, pos, title, company, location, salary, url, tags, "
                   "is_remote, description")


def _entry(size: int, table: str = "documents", key: str = "doc_id") -> str:
    return f"""SELECT *, 'c' || ({key} // {size} % 2) AS cycle, ({key} // {size})::INTEGER AS request,
               ({key} % {size})::INTEGER AS pos, 'phrase ' || ({key} // {size} % 3) AS query
               FROM {table}"""


def _docs(size: int) -> str:
    return (f"(SELECT *, split_part(text, {NL}, 1) AS first_line, {PLACE} AS place "
            f"FROM ({_entry(size)}))")


def _blob(title: str, tags: str) -> str:
    return f"lower({title} || ' ' || description || ' ' || coalesce({tags}, ''))"


FEED_SQL = {
    "remoteok": f"""
        SELECT cycle, 'remoteok' AS source, request, pos, title, source AS company, location,
               n_chars::VARCHAR AS salary,
               CASE WHEN doc_id % 2 <> 0 THEN '/r/' || doc_id
                    ELSE 'https://remoteok.com/remote-jobs/doc-' || doc_id END AS url,
               lang AS tags, true AS is_remote, text AS description
        FROM (SELECT *, CASE WHEN doc_id % 5 <> 0 THEN first_line ELSE 'Unknown' END AS title,
                     coalesce(place, 'Remote') AS location FROM {_docs(V.SMALL_PAYLOAD)})
        WHERE pos >= 1
          AND {has_category("lower(title || ' ' || text || ' ' || lang)", phrases=CATEGORY_QUERIES)}""",
    "arbeitnow": f"""
        SELECT cycle, 'arbeitnow' AS source, request, pos, first_line AS title,
               CASE WHEN doc_id % 4 <> 0 THEN source ELSE 'Unknown' END AS company,
               location, NULL::VARCHAR AS salary, '/a/' || doc_id AS url, tags,
               doc_id % 2 <> 0 AS is_remote, text AS description
        FROM (SELECT *, coalesce(place, 'Unknown') AS location,
                     CASE WHEN doc_id % 3 <> 0 THEN lang ELSE '' END AS tags
              FROM {_docs(V.LARGE_PAYLOAD)})
        WHERE {has_category("lower(first_line || ' ' || text || ' ' || tags)", phrases=CATEGORY_QUERIES)}
          AND {in_region("location", V.REGIONS)}""",
    "wellfound": f"""
        SELECT cycle, 'wellfound' AS source, request, pos, title, company, location,
               NULL::VARCHAR AS salary, 'https://wellfound.com/jobs/' || doc_id || '?a=1&b=2' AS url,
               '' AS tags, contains(lower(card), 'remote') AS is_remote, card AS description
        FROM (SELECT * FROM (SELECT *, coalesce(nullif(regexp_extract(card, {lit(R'(?i)(Remote|United States|UK|Europe|Germany|India|Canada)')}, 1), ''), 'Unknown') AS location
            FROM (SELECT *, {strip(f"regexp_replace(first_line, {SPACES}, ' ', 'g')")} AS title,
                  CASE WHEN doc_id % 4 <> 0 THEN source ELSE 'Unknown' END AS company,
                  {strip(f"regexp_replace(' ' || first_line || ' ' || CASE WHEN doc_id % 4 <> 0 THEN ' ' || source || ' ' ELSE '' END || ' ' || coalesce(place, '-') || ' ' || text, {SPACES}, ' ', 'g')")} AS card
                  FROM {_docs(V.LARGE_PAYLOAD)}))
          WHERE length(card) >= 20 AND {has_category("lower(card)", phrases=CATEGORY_QUERIES)}
            AND {in_region("location", V.REGIONS)})""",
    "hackernews": f"""
        SELECT cycle, 'hackernews' AS source, request, pos,
               CASE WHEN contains(lower(comment), 'that') THEN 'That'
                    WHEN contains(lower(comment), 'rest of') THEN 'Rest Of'
                    ELSE 'Software Engineer' END AS title,
               coalesce(nullif({strip("split_part(comment, '|', 1)")}, ''), 'Unknown') AS company,
               location, NULL::VARCHAR AS salary,
               'https://news.ycombinator.com/item?id=' || page_id AS url, '' AS tags,
               location = 'Remote' AS is_remote, comment AS description
        FROM (SELECT * FROM (SELECT *, CASE WHEN contains(lower(comment), 'remote') THEN 'Remote'
                               ELSE 'Unknown' END AS location
                FROM (SELECT *, {html_text("'<b>' || url || '</b> | ' || html")} AS comment
                      FROM ({_entry(V.LARGE_PAYLOAD, "pages", "page_id")}) WHERE page_id % 9 <> 0))
          WHERE comment <> '' AND {has_category("lower(comment)", phrases=CATEGORY_QUERIES)}
            AND {in_region("location", ("global",))})""",
    "adzuna": f"""
        SELECT cycle, 'adzuna' AS source, request, pos, first_line AS title,
               CASE WHEN doc_id % 4 <> 0 THEN source ELSE 'Unknown' END AS company,
               coalesce(place, 'Unknown') AS location, n_chars || '.5' AS salary,
               '/z/' || doc_id AS url, query AS tags,
               contains(lower(text), 'remote') AS is_remote, text AS description
        FROM {_docs(V.SMALL_PAYLOAD)}""",
    "jsearch": f"""
        SELECT cycle, 'jsearch' AS source, request, pos,
               CASE WHEN doc_id % 5 <> 0 THEN first_line ELSE 'Unknown' END AS title,
               source AS company,
               CASE WHEN doc_id % 3 <> 0 AND doc_id % 2 <> 0 THEN 'Paris, ' || lang
                    WHEN doc_id % 3 <> 0 THEN 'Paris' WHEN doc_id % 2 <> 0 THEN lang
                    ELSE '' END AS location,
               NULL::VARCHAR AS salary, '/j/' || doc_id AS url, query AS tags,
               doc_id % 2 = 0 AS is_remote, text AS description
        FROM {_docs(V.SMALL_PAYLOAD)}""",
}


def feed(name: str) -> str:
    return f"SELECT {POSTING_COLUMNS} FROM ({FEED_SQL[name]})"


def fetched() -> str:
    """All feeds with their rank.  The thread is filtered like the rest here."""
    parts = [f"SELECT {rank} AS source_rank, {POSTING_COLUMNS} FROM ({sql})"
             for rank, (name, sql) in enumerate(FEED_SQL.items()) if name != "hackernews"]
    local = FEED_SQL["hackernews"].replace("AND true)", f"AND {in_region('location', V.REGIONS)})")
    parts.append(f"SELECT 3 AS source_rank, {POSTING_COLUMNS} FROM ({local})")
    return " UNION ALL ".join(parts)


def turn(stretch: int, absent: str, given: str) -> str:
    return (f"CASE doc_id // {stretch} % 3 WHEN 0 THEN {absent} WHEN 1 THEN NULL "
            f"ELSE {given} END")


_TITLE, _COMPANY = turn(1, "'Unknown'", "first_line"), turn(2, "'Unknown'", "source")
_TEXT, _TAGS = turn(4, "''", "text"), turn(10, "NULL", "lang")
_SALARY = turn(11, "NULL", "n_chars::VARCHAR")
_SPARSE_BLOB = (f"lower(coalesce({_TITLE}, 'None') || ' ' || coalesce({_TEXT}, 'None') || ' ' || "
                f"coalesce({_TAGS}, ''))")
SPARSE = f"""
    SELECT cycle, 'remoteok' AS source, request, pos, {_TITLE} AS title, {_COMPANY} AS company,
           {turn(5, "'Remote'", "lang")} AS location, {_SALARY} AS salary,
           {turn(7, "'https://remoteok.com/remote-jobs/' || coalesce(" + turn(8, "''", "first_line")
                 + ", 'None')", "source")} AS url,
           coalesce({_TAGS}, '') AS tags, true AS is_remote, {_TEXT} AS description
    FROM {_docs(V.SMALL_PAYLOAD)}
    WHERE pos >= 1 AND {has_category(_SPARSE_BLOB, phrases=CATEGORY_QUERIES)}
    UNION ALL
    SELECT cycle, 'arbeitnow', request, pos, {_TITLE}, {_COMPANY}, {turn(5, "'Unknown'", "lang")},
           NULL, {turn(7, "''", "source")}, coalesce({_TAGS}, ''),
           doc_id // 11 % 3 = 2 AND doc_id % 2 = 0, {_TEXT}
    FROM {_docs(V.SMALL_PAYLOAD)} WHERE {has_category(_SPARSE_BLOB, phrases=CATEGORY_QUERIES)}
    UNION ALL
    SELECT cycle, 'adzuna', request, pos, {_TITLE}, coalesce({_COMPANY}, 'Unknown'), 'Unknown',
           {_SALARY}, {turn(7, "''", "source")}, query,
           contains(lower(coalesce({_TEXT}, '')), 'remote'), {_TEXT} FROM {_docs(V.SMALL_PAYLOAD)}
    UNION ALL
    SELECT cycle, 'jsearch', request, pos, {_TITLE}, {_COMPANY},
           trim(coalesce({turn(5, "NULL", "lang")}, '') || ', '
                || coalesce({turn(7, "NULL", "source")}, ''), ', '),
           NULL, {turn(8, "''", "source")}, query, doc_id // 11 % 3 = 2 AND n_chars % 2 = 1, {_TEXT}
    FROM {_docs(V.SMALL_PAYLOAD)}"""
DAMAGED_FEEDS = ("remoteok", "adzuna", "jsearch")
REJECTED = f"""
    SELECT cycle, source, request, query, CASE request % 4 WHEN 2 THEN entries END AS pos,
           CASE request % 4 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'entry is no object'
                ELSE 'no list of entries' END AS reason,
           CASE WHEN request % 4 = 2 THEN '7' WHEN request % 4 = 1 AND source = 'remoteok' THEN '['
                ELSE '{{' END AS begins
    FROM (SELECT cycle, request, query, count(*)::INTEGER AS entries
          FROM {_docs(V.SMALL_PAYLOAD)} GROUP BY ALL),
         (VALUES {", ".join(f"({lit(f)})" for f in DAMAGED_FEEDS)}) AS s(source)
    WHERE request % 4 <> 0"""
DAMAGED = f"""
    WITH kept AS (SELECT *, ({title_key()}) AS k FROM ({" UNION ALL ".join(
        feed(f) for f in DAMAGED_FEEDS)}) WHERE request % 4 IN (0, 2)),
    counts AS (SELECT cycle, count(*) AS fetched_total, count(DISTINCT k) AS deduplicated_total,
                      {", ".join(f"count(*) FILTER (source = {lit(f)}) AS {f}" for f in DAMAGED_FEEDS)}
               FROM kept GROUP BY 1),
    lost AS (SELECT cycle, count(*) AS rejected_total FROM ({REJECTED}) GROUP BY 1)
    SELECT coalesce(counts.cycle, lost.cycle) AS cycle,
           {", ".join(f"coalesce({c}, 0) AS {c}" for c in
                      ("fetched_total", "deduplicated_total", "rejected_total", *DAMAGED_FEEDS))}
    FROM counts FULL JOIN lost ON counts.cycle = lost.cycle"""


# Markets and resumes ------------------------------------------------------------------------

SOLD = """SELECT p_type || ' ' || p_size AS skill, count(*) AS count
          FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"""
BOUGHT = """SELECT c_custkey AS resume_id, min(l_orderkey * 10 + l_linenumber) AS pos,
                   p_type || ' ' || p_size AS skill
            FROM customer LEFT JOIN (orders JOIN lineitem ON o_orderkey = l_orderkey
                 JOIN part ON l_partkey = p_partkey) ON o_custkey = c_custkey
            GROUP BY c_custkey, p_type || ' ' || p_size"""


OFFERED = """SELECT p_type || ' ' || l_partkey || ' ' || l_suppkey AS skill,
                    sum(l_quantity::BIGINT)::BIGINT AS count
             FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"""
OFFERS_BOUGHT = BOUGHT.replace("p_type || ' ' || p_size",
                               "p_type || ' ' || l_partkey || ' ' || l_suppkey")


def scored(market: str, n: int | None = 50) -> str:
    """CTEs market(skill, count) and scored(skill, count, rank, n, priority, recommendation)."""
    return f"""
    market AS ({market}),
    top AS (SELECT *, row_number() OVER (ORDER BY count DESC, skill) AS rank,
                   count(*) OVER () AS n
            FROM (SELECT * FROM market ORDER BY count DESC, skill {f"LIMIT {n}" if n else ""})),
    tier AS (SELECT *, CASE WHEN count > 0.3 * n THEN 'High' WHEN count > 0.1 * n THEN 'Medium'
                            ELSE 'Low' END AS priority FROM top),
    scored AS (SELECT *, CASE priority
        WHEN 'High' THEN 'Highly recommended - ' || skill || ' is mentioned in many job postings ('
            || count || ' times). Learning this skill could significantly improve your job prospects.'
        WHEN 'Medium' THEN 'Consider learning - ' || skill || ' appears regularly in job postings ('
            || count || ' times) and would be a valuable addition.'
        ELSE 'Optional skill - ' || skill || ' is mentioned in some positions (' || count
            || ' times). Nice to have but not critical.' END AS recommendation FROM tier)"""


def gap(n: int = 50, fold: int = 40) -> str:
    """CTEs market(skill, count), top(..., rank, n, priority) and bought."""
    return scored(f"SELECT skill, count % {fold} AS count FROM ({SOLD})", n) + f""",
    bought AS ({BOUGHT}),
    matching AS (SELECT resume_id, pos, t.skill, t.count AS demand_count
                 FROM bought b JOIN scored t ON lower(b.skill) = lower(t.skill)),
    missing AS (SELECT resume_id, t.* FROM (SELECT DISTINCT resume_id FROM bought) r
                CROSS JOIN scored t
                WHERE NOT EXISTS (SELECT 1 FROM bought b WHERE b.resume_id = r.resume_id
                                  AND lower(b.skill) = lower(t.skill))),
    counts AS (SELECT resume_id, count(skill) AS resume_skill_count FROM bought GROUP BY 1),
    summary AS (SELECT resume_id, resume_skill_count,
                   (SELECT count(*) FROM top) AS market_total_skills,
                   (SELECT count(*) FROM matching m WHERE m.resume_id = c.resume_id) AS matching_count,
                   (SELECT count(*) FROM missing m WHERE m.resume_id = c.resume_id) AS missing_count
                FROM counts c)"""


ASSESSMENT = f"""CASE
    WHEN gap_ratio < 20 AND matching_count >= 10 THEN {lit(EXCELLENT)}
    WHEN gap_ratio < 40 AND matching_count >= 5 THEN {lit(GOOD)}
    WHEN gap_ratio < 60 THEN {lit(MODERATE)} ELSE {lit(SIGNIFICANT)} END"""
PATH = """path AS (SELECT resume_id, row_number() OVER (PARTITION BY resume_id
            ORDER BY CASE priority WHEN 'High' THEN 0 ELSE 1 END, count DESC, skill) AS "order",
            skill, priority, count AS demand,
            CASE priority WHEN 'High' THEN 'High market demand (' ELSE 'Growing demand (' END
                || count || ' mentions)' AS reason
          FROM missing WHERE priority <> 'Low' QUALIFY "order" <= 5)"""
MATCH_RATE = """rates AS (SELECT resume_id, count(DISTINCT lower(m.skill)) AS matches,
            count(b.skill) AS resume_skill_count
          FROM bought b LEFT JOIN served m ON lower(b.skill) = lower(m.skill) GROUP BY 1),
    rated AS (SELECT *, CASE WHEN resume_skill_count > 0 AND (SELECT count(*) FROM served) > 0
                 THEN matches / resume_skill_count * 100.0::DOUBLE ELSE 0.0 END AS match_ratio
              FROM rates)"""


def filter_rows() -> str:
    def pick(shift: int, *names: str) -> str:
        return f"([{words(*names)}])[(c_custkey + {shift}) % {len(names)} + 1]"

    categories = (pick(0, " Data Science", "devops", "machine learning ", "ML Engineer", "cook", " ")
                  + ", " + pick(0, "devops engineer", "", "sde", "machine learning",
                                " full stack\t"))
    regions = (pick(0, "US", " uk", "eu", "mars", "remote", "global", " ")
               + ", " + pick(2, "gb", "germany", "Canada ", "au", "", "  "))
    return f"""
    given AS (SELECT c_custkey AS filter_id, [{categories}] AS categories, [{regions}] AS regions,
        CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS enabled,
        CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 4 * 200 END AS refresh_interval,
        CASE c_custkey % 5 WHEN 0 THEN ['adzuna'] ELSE [] END AS sources FROM customer),
    cleaned AS (SELECT filter_id, enabled, refresh_interval, sources,
        list_filter(list_transform(categories, lambda x: lower({strip("x")})), lambda x: x <> '') AS categories,
        list_filter(list_transform(regions, lambda x: lower({strip("x")})), lambda x: x <> '') AS regions
        FROM given),
    ready AS (SELECT filter_id, coalesce(enabled, true) AS enabled,
        greatest(300, coalesce(refresh_interval, 10800))::INTEGER AS refresh_interval,
        CASE WHEN len(sources) > 0 THEN sources ELSE [{words(*R_SOURCES)}] END AS sources,
        CASE WHEN len(categories) > 0 THEN categories ELSE ['data science', 'software engineer'] END AS categories,
        CASE WHEN len(regions) > 0 THEN regions ELSE ['us', 'remote'] END AS regions
        FROM cleaned)"""


R_SOURCES = ("remoteok", "arbeitnow", "wellfound", "hackernews", "adzuna", "jsearch")


def mapped(pairs: dict[str, str], column: str, default: str) -> str:
    cases = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in pairs.items())
    return f"CASE {column} {cases} ELSE {default} END"


QUERY_ROWS = f"""
    asked AS (SELECT filter_id, i, {mapped(CATEGORY_QUERIES, "categories[i]", "categories[i]")} AS query
              FROM (SELECT *, unnest(range(1, len(categories) + 1)) AS i FROM ready)),
    query AS (SELECT filter_id, query, row_number() OVER (PARTITION BY filter_id ORDER BY min(i)) - 1 AS q
              FROM asked GROUP BY filter_id, query)"""
COUNTRY_ROWS = f"""
    land AS (SELECT filter_id, i, {mapped(REGION_COUNTRIES, "regions[i]", "NULL")} AS country
             FROM (SELECT *, unnest(range(1, len(regions) + 1)) AS i FROM ready)
             WHERE NOT list_contains(regions, 'global')),
    found AS (SELECT filter_id, country, min(i) AS i FROM land WHERE country IS NOT NULL
              GROUP BY ALL
              UNION ALL SELECT filter_id, unnest(['us', 'gb', 'de']), unnest([1, 2, 3]) FROM ready
              WHERE list_contains(regions, 'global')),
    country AS (SELECT filter_id, country, i FROM found
                UNION ALL SELECT filter_id, 'us', 1 FROM ready
                WHERE filter_id NOT IN (SELECT filter_id FROM found))"""

NAMED_TURNS = """SELECT conv_id, role, lower(text) AS low FROM conversations"""
TURN_KEY = "conv_id, turn"
PHRASES = (f"SELECT conv_id, turn, unnest(regexp_split_to_array(text, '[.,{chr(10)}]+')) AS phrase "
           "FROM conversations")
ENTITIES = """SELECT conv_id, turn, unnest(regexp_extract_all(text, '\\p{Lu}\\p{Ll}+')) AS text,
              CASE role WHEN 'user' THEN 'ORG' ELSE 'PERSON' END AS label FROM conversations"""


def met(texts: str, needles: list[tuple[str, str, str]]) -> str:
    """(doc_id, dim, name) by a search for every needle; the empty one is met by empty texts."""
    rows = ", ".join(f"({lit(d)}, {lit(n)}, {lit(x)})" for d, n, x in needles)
    return f"""SELECT DISTINCT doc_id, dim, name FROM ({texts}) JOIN (VALUES {rows}) AS d(dim, name, needle)
        ON CASE WHEN needle = '' THEN low = '' ELSE contains(low, needle) END"""


def similar(sets: str, threshold: float) -> str:
    """All pairs of distinct sets ``(id, s)``, compared one by one."""
    return f"""WITH sets AS ({sets}),
        class AS MATERIALIZED (SELECT min(id) AS id, s FROM sets GROUP BY s),
        pair AS (SELECT a.id AS left_id, b.id AS right_id, len(list_intersect(a.s, b.s)) AS shared,
                        len(a.s) + len(b.s) AS total
                 FROM class a JOIN class b ON a.id < b.id)
        SELECT left_id, right_id, shared::INTEGER AS shared, shared / (total - shared) AS similarity
        FROM pair WHERE total > 0 AND shared / (total - shared) >= {threshold}"""


def oracle_sql() -> dict[str, str]:
    vocab = mentions(LOW_DOCUMENTS, "doc_id", V.VOCABULARY)
    text_terms = mentions(LOW_DOCUMENTS, "doc_id", V.TEXT_TERMS)
    posting_vocab = mentions(LOW_POSTINGS, "doc_id, source", V.VOCABULARY)
    batch = mentions(LOW_POSTINGS, "doc_id, source", V.VOCABULARY) + """,
    demand AS (SELECT doc_id % 4 AS batch_id, skill, sum(mentions)::BIGINT AS count
               FROM mention GROUP BY ALL)"""
    resume = mentions(f"SELECT {TURN_KEY}, lower(text) AS low FROM conversations", TURN_KEY,
                      V.RESUME_TERMS)
    names = values(V.RESUME_TERMS)
    phrase_hits = f"""SELECT DISTINCT conv_id, turn, skill FROM ({PHRASES}) JOIN {names}
                      ON contains({strip("lower(phrase)")}, term)"""
    entity_hits = f"""SELECT DISTINCT conv_id, turn, skill FROM ({ENTITIES}) e JOIN {names}
                      ON {strip("e.text")} = skill WHERE label IN ('PRODUCT', 'ORG', 'TECH')"""
    turn_sets = f"""SELECT conv_id * 10000 + turn AS id,
        coalesce(list_sort(list(DISTINCT lower(skill)) FILTER (skill IS NOT NULL)), []) AS s
        FROM conversations LEFT JOIN (WITH {resume} SELECT * FROM mention) USING (conv_id, turn)
        GROUP BY conv_id, turn"""
    required = ("That", "OF THE", "Rest", "nowhere", "t")
    region_sets = {"us": ("us",), "uk": ("uk",), "eu": ("eu",), "canada": ("canada",),
                   "remote": ("remote",), "us remote": ("us", "remote"), "au": ("au",),
                   "global": ("global",), "any": ()}
    both = [mentions(LOW_DOCUMENTS, "doc_id", d) for d in (V.TEXT_TERMS, V.RESUME_TERMS)]
    out = {
        "table_mentions": " UNION ALL ".join(
            f"SELECT * FROM (WITH {m} SELECT doc_id, {lit(n)} AS dict_id, skill, mentions FROM mention)"
            for n, m in zip(("text", "resume"), both)),
        "opening_mentions": f"""WITH low AS ({LOW_DOCUMENTS}),
            first AS (SELECT lang, string_split(text, ' ') AS w FROM documents),
            dict AS (SELECT DISTINCT lang AS dict_id, lower(w[1]) AS a, lower(w[2]) AS b FROM first
                     WHERE regexp_full_match(w[1], '[A-Za-z]+')
                       AND regexp_full_match(w[2], '[A-Za-z]+')),
            cut AS (SELECT doc_id, regexp_extract_all(low, '[^\\p{{L}}\\p{{N}}_]*[\\p{{L}}\\p{{N}}_]+') AS p
                    FROM low),
            run AS (SELECT doc_id, i, p[i] AS x, p[i + 1] AS y
                    FROM (SELECT *, unnest(range(1, len(p))) AS i FROM cut)),
            pair AS (SELECT doc_id, i, regexp_extract(x, '[\\p{{L}}\\p{{N}}_]+$') AS a, y[2:] AS b
                     FROM run WHERE regexp_full_match(y, ' [\\p{{L}}\\p{{N}}_]+')),
            hit AS (SELECT doc_id, dict_id, a, b, i, i - row_number() OVER (
                        PARTITION BY doc_id, dict_id, a, b ORDER BY i) AS stretch
                    FROM pair JOIN dict USING (a, b))
            SELECT doc_id, dict_id, a || ' ' || b AS term, sum(n)::BIGINT AS mentions FROM (
                -- of a word that is repeated n + 1 times every second pair counts
                SELECT doc_id, dict_id, a, b, CASE WHEN a = b THEN (count(*) + 1) // 2
                       ELSE count(*) END AS n FROM hit GROUP BY doc_id, dict_id, a, b, stretch)
            GROUP BY ALL""",
        "similar_titles": similar(f"""SELECT doc_id AS id, list_sort(list_distinct(
            string_split(lower(split_part(text, {NL}, 1)), ' '))) AS s FROM documents""", 0.7),
        "similar_resumes": similar(turn_sets, 0.5),
        "skill_set_classes": f"""WITH sets AS ({turn_sets})
            SELECT id AS resume_id, min(id) OVER (PARTITION BY s) AS class_id,
                   count(*) OVER (PARTITION BY s) AS members FROM sets""",
        "skill_demand_topk": f"""WITH {posting_vocab}
            SELECT skill, sum(mentions)::BIGINT AS count FROM mention GROUP BY skill
            ORDER BY count DESC, skill LIMIT 20""",
        "demand_of_all_skills": "WITH " + mentions(LOW_POSTINGS, "doc_id, source", POSTINGS) + f"""
            SELECT d.skill, coalesce(sum(mentions), 0)::BIGINT AS count
            FROM {values(POSTINGS)} LEFT JOIN mention m ON m.skill = d.skill GROUP BY 1""",
        "skill_demand_by_source": f"""WITH {posting_vocab}
            SELECT source, skill, sum(mentions)::BIGINT AS count FROM mention GROUP BY ALL""",
        "skill_mentions": f"WITH {text_terms} SELECT doc_id, skill, mentions FROM mention",
        "full_dictionary_mentions": f"WITH {vocab} SELECT doc_id, skill, mentions FROM mention",
        "page_mentions": "WITH " + mentions(
            "SELECT page_id, lower(html) AS low FROM pages", "page_id", POSTINGS)
            + " SELECT page_id, skill, mentions FROM mention",
        "phrase_mentions": "WITH " + mentions(
            LOW_DOCUMENTS, "doc_id", SkillDictionary.titled(PHRASE_TERMS))
            + " SELECT doc_id, skill, mentions FROM mention",
        "token_boundary_mentions": "WITH " + mentions(
            "SELECT page_id, lower(html) AS low FROM pages", "page_id",
            SkillDictionary.titled(MARKUP_TERMS), "token")
            + " SELECT page_id, skill, mentions FROM mention",
        "skill_list_per_doc": f"""WITH {vocab}
            SELECT d.doc_id, coalesce(string_agg(skill, '|' ORDER BY skill), '') AS skills,
                   count(skill)::INTEGER AS skill_count
            FROM documents d LEFT JOIN mention m ON d.doc_id = m.doc_id GROUP BY 1""",
        "top_skills_per_doc": f"""WITH {text_terms}
            SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY mentions DESC, skill)
                ::INTEGER AS rank, skill, mentions FROM mention QUALIFY rank <= 3""",
        "match_required_skills": f"""
            SELECT doc_id, required, {" OR ".join(
                f"required = {lit(r)} AND list_contains(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+'), {lit(r.lower())})"
                if " " not in r else
                f"required = {lit(r)} AND regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}_]){r.lower()}($|[^\\p{{L}}\\p{{N}}_])')"
                for r in required)} AS found
            FROM documents, (VALUES {", ".join(f"({lit(r)})" for r in required)}) AS r(required)""",
        "skill_similarity": "WITH " + mentions(NAMED_TURNS, "conv_id, role", V.RESUME_TERMS) + """,
            side AS (SELECT DISTINCT conv_id, role, skill FROM mention),
            pair AS (SELECT conv_id, count(DISTINCT skill) AS either,
                       count(DISTINCT CASE WHEN skill IN (SELECT skill FROM side b WHERE b.conv_id = a.conv_id
                           AND b.role = CASE a.role WHEN 'user' THEN 'assistant' ELSE 'user' END)
                         THEN skill END) AS shared
                     FROM side a WHERE role IN ('user', 'assistant') GROUP BY 1)
            SELECT c.conv_id, CASE WHEN coalesce(either, 0) = 0 THEN 1.0::DOUBLE ELSE shared / either END AS similarity
            FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN pair USING (conv_id)""",
        "fallback_demand": f"""
            SELECT skill, count(*) AS count FROM ({LOW_POSTINGS}) JOIN {values(BASIC)}
            ON contains(low, term) GROUP BY skill""",
        "word_count": f"""SELECT doc_id, len(regexp_extract_all(text, {NON_SPACES}))
            ::INTEGER AS words FROM documents""",
        "html_to_text": f"SELECT page_id, {html_text('html')} AS text FROM pages",
        "category_filter": f"""SELECT doc_id, {has_category("lower(text)")} AS in_category,
            contains(lower(text), lang) OR contains(lower(text), 'rest of') OR contains(lower(text), 'in the') AS in_own_category
            FROM documents""",
        "region_filter": " UNION ALL ".join(
            f"""SELECT doc_id, {lit(name)} AS asked FROM documents
                WHERE {in_region(f"split_part(text, {NL}, 1)", regions)}"""
            for name, regions in region_sets.items()),
        "postings_seen": f"""WITH {CYCLES} SELECT title, company, location, min(cycle) AS first_cycle,
            max(cycle) AS last_cycle, count(DISTINCT cycle) AS cycles FROM seen GROUP BY ALL""",
        "new_postings_by_cycle": f"""WITH {CYCLES},
            first AS (SELECT title, company, location, min(cycle) AS cycle FROM seen GROUP BY ALL)
            SELECT cycle, count(DISTINCT (title, company, location)) AS postings,
                   (SELECT count(*) FROM first f WHERE f.cycle = s.cycle) AS new
            FROM seen s GROUP BY cycle""",
        "last_cycle_new_postings": f"""WITH {CYCLES}
            SELECT doc_id, p.title, p.company, p.location FROM seen s JOIN posting p USING (doc_id)
            WHERE NOT EXISTS (SELECT 1 FROM seen e WHERE e.cycle < 'c2' AND e.title = s.title
                              AND e.company = s.company AND e.location = s.location)
            QUALIFY row_number() OVER (PARTITION BY s.title, s.company, s.location
                                       ORDER BY doc_id) = 1""",
        "distinct_by_sketch": f"""WITH {POSTING}
            SELECT source, count(*) AS rows, count(DISTINCT ({title_key()})) AS distinct,
                   true AS close FROM posting GROUP BY source""",
        "feed_sparse_fields": SPARSE,
        "rejected_responses": REJECTED,
        "damaged_collection": DAMAGED,
        "category_dimension": met("SELECT doc_id, lower(text) AS low FROM documents", [
            ("category", c, n) for c, q in {**CATEGORY_QUERIES, "rest of": "in the", "that": "that"}.items()
            for n in (c, q)]),
        "region_dimension": met(f"SELECT doc_id, lower(split_part(text, {NL}, 1)) AS low FROM documents", [
            *[("region", n, t) for names, tokens in REGION_TOKENS for n in names for t in tokens],
            ("region", "remote", "remote"), ("region", "remote", "")]),
        "source_selection": """SELECT source, count(*) AS postings FROM documents
            WHERE source IN ('src1', 'src7', 'src19') GROUP BY 1""",
        "source_caps": """SELECT source, doc_id FROM documents
            QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 5""",
        "dedup_postings": f"""WITH {POSTING} SELECT doc_id, title, company, location FROM posting
            QUALIFY row_number() OVER (PARTITION BY {title_key()} ORDER BY doc_id) = 1""",
        "cycle_totals": f"""WITH {POSTING},
            keyed AS (SELECT *, 'c' || (doc_id % 3) AS cycle, ({title_key()}) AS k FROM posting)
            SELECT cycle, count(*) AS fetched_total, count(DISTINCT k) AS deduplicated_total,
                   count(*) FILTER (source = 'src0') AS src0, 0::BIGINT AS elsewhere
            FROM keyed GROUP BY cycle""",
        "counts_by_source": """SELECT s.source, count(doc_id) AS postings
            FROM (VALUES ('src0'), ('src3'), ('elsewhere')) AS s(source)
            LEFT JOIN documents d ON d.source = s.source GROUP BY 1""",
        **{f"feed_{name}": feed(name) for name in FEED_SQL},
        "collected_postings": f"""SELECT cycle, source, request, pos, title, company, location
            FROM ({fetched()})
            QUALIFY row_number() OVER (PARTITION BY cycle, {title_key()}
                                       ORDER BY source_rank, request, pos) = 1""",
        "collection_stats": f"""
            SELECT cycle, count(*) AS fetched_total, count(DISTINCT ({title_key()})) AS deduplicated_total,
                   count(DISTINCT ({title_key()})) AS sent_total,
                   {", ".join(f"count(*) FILTER (source = '{s}') AS {s}" for s in FEED_SQL)}
            FROM ({fetched()}) GROUP BY cycle""",
        "collection_last_run": f"""WITH {POSTING}
            SELECT 'data science|software engineer' AS categories, count(*) AS fetched_total,
                   count(DISTINCT ({title_key()})) AS deduplicated_total,
                   count(*) FILTER (source = 'src0') AS src0 FROM posting""",
        "landed_files": feed("adzuna"),
        "latest_thread": """SELECT page_id, CASE WHEN page_id % 5 <> 0 THEN (page_id + 1000)::VARCHAR END
            AS thread FROM pages""",
        "parse_event_json": """SELECT event_type, count(*) AS events,
            sum((props->>'k')::BIGINT)::BIGINT AS k_sum FROM events GROUP BY 1""",
        "message_roundtrip": f"""WITH {POSTING}
            SELECT CASE WHEN doc_id % 7 <> 0 THEN title END AS title,
                   CASE WHEN doc_id % 7 <> 0 THEN company END AS company,
                   CASE WHEN doc_id % 7 <> 0 THEN description END AS description,
                   CASE WHEN doc_id % 7 <> 0 THEN n_chars::VARCHAR END AS salary,
                   CASE WHEN doc_id % 7 <> 0 THEN epoch(TIMESTAMP '1970-01-01' + to_seconds(1700000000 + doc_id))::BIGINT END AS event_second,
                   doc_id % 7 = 0 AS corrupt FROM posting""",
        "raw_jobs_roundtrip": """SELECT source, doc_id % 4 AS batch_id, count(*) AS jobs,
            sum(length(text))::BIGINT AS characters FROM documents GROUP BY ALL""",
        "market_demand": f"""WITH {batch}
            SELECT skill, sum(count)::BIGINT AS count FROM demand GROUP BY skill""",
        "market_rollup": f"WITH {batch} SELECT skill, sum(count)::BIGINT AS count FROM demand GROUP BY 1",
        "latest_batch_demand": f"""WITH {batch}
            SELECT skill, count FROM demand WHERE batch_id = (SELECT max(batch_id) FROM demand)
            ORDER BY count DESC, skill LIMIT 20""",
        "market_with_source": f"""WITH {batch}
            SELECT skill, sum(count)::BIGINT AS count, 'parquet' AS origin FROM demand GROUP BY skill
            ORDER BY count DESC, skill LIMIT 15""",
        "two_runs_in_one_store": f"""WITH {posting_vocab}
            SELECT skill, sum(mentions)::BIGINT AS count FROM mention GROUP BY skill""",
        "skill_trend_stream": """SELECT date_trunc('day', ts)::TIMESTAMP AS period_start,
            event_type AS skill, count(*) AS count FROM events GROUP BY ALL""",
        "match_own_skills": f"""
            SELECT DISTINCT doc_id, required, CASE WHEN contains(required, ' ')
                THEN regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}_])of the($|[^\\p{{L}}\\p{{N}}_])')
                ELSE list_contains(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+'),
                                   lower(required)) END AS found
            FROM (SELECT doc_id, text, unnest([lang, 'That', 'of the', source]) AS required
                  FROM documents)""",
        "report_without_market": """SELECT conv_id, turn, true AS no_gap,
            'Resume analyzed but no market data available for comparison' AS message
            FROM conversations""",
        "stats_summary": f"""WITH {batch}
            SELECT (SELECT count(*) FROM documents) AS total_jobs_processed,
                   (SELECT count(*) FROM demand
                    WHERE batch_id = (SELECT max(batch_id) FROM demand)) AS total_skills_tracked""",
        "streamed_demand": f"""WITH {posting_vocab}
            SELECT skill, sum(mentions)::BIGINT AS count FROM mention GROUP BY skill""",
        "streamed_keys": f"WITH {POSTING} SELECT DISTINCT {aliased_keys()} FROM posting",
        "market_top_parts": f"SELECT skill, count FROM ({SOLD}) ORDER BY count DESC, skill LIMIT 50",
        "market_chart": f"""SELECT string_agg(skill, '|' ORDER BY count DESC, skill) AS skills,
            string_agg(count::VARCHAR, '|' ORDER BY count DESC, skill) AS counts,
            count(*)::INTEGER AS total
            FROM (SELECT * FROM ({SOLD}) ORDER BY count DESC, skill LIMIT 50)""",
        "gap_matching": f"""WITH {gap()} SELECT resume_id, pos, skill, demand_count,
            'In Demand' AS status FROM matching""",
        "gap_missing": f"""WITH {gap()} SELECT resume_id, skill, count AS demand_count, priority,
            recommendation FROM missing""",
        "gap_summary": f"""WITH {gap()}, ratio AS (SELECT *, CASE WHEN market_total_skills > 0
                THEN missing_count / market_total_skills * 100.0::DOUBLE ELSE 0.0 END AS gap_ratio FROM summary)
            SELECT resume_id, resume_skill_count, market_total_skills, matching_count, missing_count,
                   gap_ratio, round_even(gap_ratio, 2)::DOUBLE AS gap_percentage,
                   {ASSESSMENT} AS overall_assessment FROM ratio""",
        "gap_summary_large_market": f"""WITH {scored(OFFERED, None)}, bought AS ({OFFERS_BOUGHT}),
            summary AS (SELECT resume_id, count(skill) AS resume_skill_count,
                    (SELECT count(*) FROM top) AS market_total_skills, count(skill) AS matching_count,
                    (SELECT count(*) FROM top) - count(skill) AS missing_count
                FROM bought GROUP BY 1),
            ratio AS (SELECT *, missing_count / market_total_skills * 100.0::DOUBLE AS gap_ratio FROM summary)
            SELECT resume_id, resume_skill_count, market_total_skills, matching_count, missing_count,
                   gap_ratio, round_even(gap_ratio, 2)::DOUBLE AS gap_percentage,
                   {ASSESSMENT} AS overall_assessment FROM ratio""",
        "gap_priorities_large_market": f"""WITH {scored(OFFERED, None)}, bought AS ({OFFERS_BOUGHT}),
            held AS (SELECT resume_id, list(t.rank) AS ranks, count(t.rank) AS n
                     FROM bought b LEFT JOIN scored t ON b.skill = t.skill GROUP BY 1)
            SELECT resume_id, row_number() OVER (PARTITION BY resume_id ORDER BY t.rank)::INTEGER AS rank,
                   skill, count AS demand_count, priority, recommendation
            FROM held JOIN scored t ON t.rank <= held.n + 10 AND NOT list_contains(ranks, t.rank)
            QUALIFY row_number() OVER (PARTITION BY resume_id ORDER BY t.rank) <= 10""",
        "gap_top_priorities": f"""WITH {gap()} SELECT resume_id,
            row_number() OVER (PARTITION BY resume_id ORDER BY count DESC, skill)::INTEGER AS rank,
            skill, count AS demand_count, priority, recommendation FROM missing
            QUALIFY row_number() OVER (PARTITION BY resume_id ORDER BY count DESC, skill) <= 10""",
        "gap_learning_path": f"""WITH {gap()}, {PATH}
            SELECT resume_id, "order"::INTEGER AS "order", skill, priority, demand, reason FROM path""",
        "gap_match_rate": f"""WITH {gap()},
            served AS (SELECT * FROM market ORDER BY count DESC, skill LIMIT 100), {MATCH_RATE}
            SELECT resume_id, matches, resume_skill_count, match_ratio,
                   round_even(match_ratio, 2)::DOUBLE AS match_rate FROM rated""",
        "gap_match_rate_whole_market": f"""WITH {gap()},
            served AS (SELECT * FROM ({SOLD})), {MATCH_RATE}
            SELECT resume_id, matches, resume_skill_count, match_ratio,
                   round_even(match_ratio, 2)::DOUBLE AS match_rate FROM rated""",
        "gap_bundle": f"""WITH {gap()}, {PATH},
            served AS (SELECT * FROM market ORDER BY count DESC, skill LIMIT 100), {MATCH_RATE},
            m AS (SELECT resume_id, string_agg(skill || '=' || demand_count, '|' ORDER BY pos, m.skill) AS s
                  FROM matching m GROUP BY 1),
            x AS (SELECT resume_id, string_agg(skill || '=' || count || ' ' || priority, '|' ORDER BY rank) AS s
                  FROM missing GROUP BY 1),
            p AS (SELECT resume_id, string_agg("order" || ' ' || skill || ': ' || reason, '|' ORDER BY "order") AS s
                  FROM path GROUP BY 1),
            ratio AS (SELECT *, missing_count / market_total_skills * 100.0::DOUBLE AS gap_ratio FROM summary)
            SELECT ratio.resume_id, round_even(match_ratio, 2)::DOUBLE AS skill_score,
                   matching_count::INTEGER AS match_count, missing_count::INTEGER AS gap_count,
                   ratio.resume_skill_count::INTEGER AS resume_skill_count,
                   coalesce(m.s, '') AS matching_skills, coalesce(x.s, '') AS missing_skills,
                   coalesce(p.s, '') AS recommendations, {ASSESSMENT} AS overall_assessment
            FROM ratio JOIN rated USING (resume_id) LEFT JOIN m USING (resume_id)
                 LEFT JOIN x USING (resume_id) LEFT JOIN p USING (resume_id)""",
        "gap_shown": f"""WITH {gap()},
            m AS (SELECT resume_id, string_agg(skill, '|' ORDER BY pos, skill) AS s FROM (SELECT * FROM matching
                  QUALIFY row_number() OVER (PARTITION BY resume_id ORDER BY pos, skill) <= 20) GROUP BY 1),
            x AS (SELECT resume_id, string_agg(skill, '|' ORDER BY rank) AS s FROM (SELECT * FROM missing
                  QUALIFY row_number() OVER (PARTITION BY resume_id ORDER BY rank) <= 15) GROUP BY 1)
            SELECT resume_id, coalesce(m.s, '') AS matching_skills, coalesce(x.s, '') AS missing_skills
            FROM counts LEFT JOIN m USING (resume_id) LEFT JOIN x USING (resume_id)""",
        "resume_report": f"""WITH {resume},
            market AS (SELECT skill, sum(mentions)::BIGINT AS count FROM mention GROUP BY 1),
            top AS (SELECT * FROM market ORDER BY count DESC, skill LIMIT 50),
            have AS (SELECT DISTINCT {TURN_KEY}, skill FROM mention)
            SELECT c.conv_id, c.turn,
                   CASE WHEN (SELECT count(*) FROM top) > 0 THEN count(t.skill)::INTEGER END AS matching_count,
                   CASE WHEN (SELECT count(*) FROM top) > 0 THEN ((SELECT count(*) FROM top) - count(t.skill))::INTEGER END AS missing_count,
                   CASE WHEN (SELECT count(*) FROM top) = 0 THEN {lit(NO_MARKET)} END AS message
            FROM conversations c LEFT JOIN have h USING (conv_id, turn)
                 LEFT JOIN top t ON t.skill = h.skill GROUP BY 1, 2""",
        "resume_skills": "WITH " + mentions(
            "SELECT conv_id, lower(text) AS low FROM conversations", "conv_id",
            V.RESUME_TERMS) + """
            SELECT conv_id, string_agg(DISTINCT skill, '|' ORDER BY skill) AS skills
            FROM mention GROUP BY 1""",
        "phrase_skills": f"SELECT * FROM ({phrase_hits})",
        "entity_skills": f"SELECT * FROM ({entity_hits})",
        "resume_analysis": f"""WITH {resume},
            named AS (SELECT DISTINCT conv_id, turn, skill FROM mention UNION {phrase_hits} UNION {entity_hits})
            SELECT c.conv_id, c.turn, {strip("text")} <> '' AS success,
                   coalesce(string_agg(skill, '|' ORDER BY skill), '') AS skills,
                   count(skill)::INTEGER AS skill_count,
                   len(regexp_extract_all(any_value(text), {NON_SPACES}))::INTEGER AS word_count
            FROM conversations c LEFT JOIN named USING (conv_id, turn) GROUP BY c.conv_id, c.turn, success""",
        "skill_trend_daily": """SELECT date_trunc('day', ts) AS period_start, event_type AS skill,
            count(*) AS count FROM events GROUP BY ALL""",
        "filters_normalized": f"""WITH {filter_rows()}
            SELECT filter_id, array_to_string(categories, '|') AS categories,
                   array_to_string(regions, '|') AS regions, enabled, refresh_interval,
                   array_to_string(sources, '|') AS sources FROM ready""",
        "filters_validated": f"""WITH {filter_rows()}
            SELECT filter_id, array_to_string(categories, '|') AS categories,
                   array_to_string(regions, '|') AS regions,
                   CASE WHEN len(categories) = 0 THEN 'At least one category must be selected'
                        WHEN len(regions) = 0 THEN 'At least one region must be selected'
                        WHEN coalesce(refresh_interval, 10800) < 300
                        THEN 'refresh_interval must be at least 300 seconds' END AS error
            FROM cleaned""",
        "country_requests": f"""WITH {filter_rows()}, {QUERY_ROWS}, {COUNTRY_ROWS}
            SELECT filter_id, (row_number() OVER (PARTITION BY filter_id ORDER BY q, c.i) - 1)::INTEGER AS request,
                   query, country FROM query JOIN country c USING (filter_id)""",
        "phrase_requests": f"""WITH {filter_rows()}, {QUERY_ROWS}
            SELECT filter_id, q::INTEGER AS request, query, query || CASE
                WHEN list_contains(regions, 'global') THEN ''
                WHEN list_contains(regions, 'remote') THEN ' remote'
                WHEN list_contains(regions, 'us') THEN ' in United States'
                WHEN list_has_any(regions, ['gb', 'uk']) THEN ' in United Kingdom'
                WHEN list_has_any(regions, ['de', 'eu']) THEN ' in Germany' ELSE '' END AS search
            FROM query JOIN ready USING (filter_id)""",
        "pdf_uploads": """SELECT p_partkey FROM part WHERE p_partkey % 3 <> 2""",
    }
    return out


PHRASE_TERMS = ("of the", "in the", "to the", "and the", "of de", "the and")
MARKUP_TERMS = (".net", "&amp;", "</p>", "example", "?page=", "c++")


def aliased_keys() -> str:
    names = ("title", "company", "location")
    parts = title_key().split(", lower(")
    keys = [parts[0], *["lower(" + p for p in parts[1:]]]
    return ", ".join(f"{k} AS {n}" for k, n in zip(keys, names, strict=True))
