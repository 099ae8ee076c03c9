"""Every registered query with the SQL of its expected result.

A query gets ``(spark, sf_dir)`` and runs over whole tables. Texts are compared as
they are and arrays joined by ``|``; of whole pages and records some queries
compare lengths, flags or chosen fields only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as B
from checks.truth import AMOUNT, CLEAN, LINKS, POSITION, SALARY, truth, years
from dossierflow.operators import aggregate, education, fields, select, similarity, skills, text, work
from dossierflow.plans.collect import collect_payloads
from dossierflow.plans.payloads import build_payloads, cleaned_pages
from dossierflow.plans.processed import assemble_processed, assemble_processed_similar
from dossierflow.session import new_scratch_path
from dossierflow.sources import pages as P
from dossierflow.sources import store as S
from dossierflow.streaming import pages as ST
from dossierflow.streaming import stats as SS
from fixtures.render import corpus_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


K = ("k",)


def _k(df: DataFrame) -> DataFrame:
    return df.withColumn("k", B.number(F.col("source_url")))


# --------------------------------------------------------------------------
# sources and sinks
# --------------------------------------------------------------------------
@register("src1_load_pages", "SELECT page_id, url AS source_url, length(html) AS n FROM pages WHERE html IS NOT NULL AND html <> ''")
def src1(spark, d):
    pages = B.driver_pages(spark, d)
    return pages.select("page_id", "source_url", F.length("html").cast("bigint").alias("n"))


def _links(spark, d):
    return P.extract_links(
        B.driver_pages(spark, d), base="http://site.example", link_re="", in_link_box=False
    )


@register("src2_extract_links", LINKS + "SELECT list_page, pos, url, CAST(NULL AS VARCHAR) AS key FROM link")
def src2(spark, d):
    return B.longs(_links(spark, d), "pos")


@register(
    "src2_links_in_boxes",
    "SELECT c_custkey // 10 AS list_page, row_number() OVER (PARTITION BY c_custkey // 10 ORDER BY c_custkey) - 1 AS pos, "
    "'https://s.example/resumes/' || c_custkey || '/?a=1&b=2' AS url, CAST(c_custkey AS VARCHAR) AS key FROM customer",
)
def src2_boxes(spark, d):
    def markup(k: Column) -> Column:
        link = F.concat(F.lit("<a class='x>y' href='/resumes/"), k, F.lit("/?a=1&amp;b=2'>Резюме</a>"))
        box = F.concat(F.lit("<div class='card resume-link'><div>"), link, F.lit("</div><a href='/about/'>o</a></div>"))
        other = F.concat(F.lit("<div class='resume-links'><a href='/resumes/9"), k, F.lit("/'>no</a></div>"))
        return F.concat(box, other, F.when(k % 3 == 0, box).otherwise(""))

    k = F.col("c_custkey")
    listing = B.table(spark, d, "customer").groupBy(F.floor(k / 10).alias("page_id")).agg(F.array_sort(F.collect_list(k)).alias("ks"))
    html = F.concat(F.lit("<nav><a href='/resumes/1/'>first</a></nav>"), F.array_join(F.transform("ks", markup), "\n"))
    return B.longs(P.extract_links(listing.select("page_id", html.alias("html")), base="https://s.example/"), "list_page", "pos")


@register("src3_export_json", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src3(spark, d):
    customers = B.table(spark, d, "customer")
    path = new_scratch_path(spark, "json")
    P.export_json(customers, path)
    return spark.read.schema(customers.schema).json(path)


# --------------------------------------------------------------------------
# selection
# --------------------------------------------------------------------------
@register("sel1_pages_range", LINKS + "SELECT list_page, pos, url FROM link WHERE list_page BETWEEN 10 AND 160")
def sel1(spark, d):
    return B.longs(select.pages_range(_links(spark, d), 10, 160), "pos").select("list_page", "pos", "url")


@register("sel2_by_urls", "SELECT 1000000 - page_id AS req_pos, page_id, url AS source_url FROM pages")
def sel2(spark, d):
    pages = B.driver_pages(spark, d)
    wanted = B.table(spark, d, "pages").select((1000000 - F.col("page_id")).alias("req_pos"), "url")
    return select.by_urls(pages, wanted).select("req_pos", "page_id", "source_url")


@register(
    "sel3_dedupe_first",
    "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1",
)
def sel3(spark, d):
    events = B.table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return select.dedupe_first(events, "user_id", ["ts", "event_id"]).drop("ts")


@register(
    "sel4_skip_limit",
    "WITH f AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1), "
    "g AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS r FROM f) "
    "SELECT user_id, event_id, event_type FROM g WHERE r > 20 AND event_type <> 'error' ORDER BY r LIMIT 50",
)
def sel4(spark, d):
    events = B.table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return select.skip_limit(
        events, key="user_id", order=["ts", "event_id"], skip=20, limit=50,
        success=F.col("event_type") != "error",
    ).drop("ts")


_LISTING = (
    "WITH l AS (SELECT CAST(date_diff('minute', TIMESTAMP '2024-01-01', ts) // 10 + 1 AS BIGINT) AS list_page, event_id AS pos, "
    "'u' || user_id AS url, event_type FROM events), "
    "pg AS (SELECT DISTINCT list_page FROM l), "
    "stop AS (SELECT min(p) AS p FROM (SELECT list_page AS p FROM pg UNION ALL SELECT 0) WHERE p + 1 NOT IN (SELECT list_page FROM pg)), "
    "f AS (SELECT * FROM l WHERE list_page <= (SELECT p FROM stop) QUALIFY row_number() OVER (PARTITION BY url ORDER BY list_page, pos) = 1) "
)


def _listing(spark, d):
    minutes = F.expr("timestampdiff(MINUTE, timestamp_ntz'2024-01-01 00:00:00', ts)")
    return B.table(spark, d, "events").select(
        (F.floor(minutes / 10) + 1).alias("list_page"), F.col("event_id").alias("pos"),
        F.concat(F.lit("u"), F.col("user_id")).alias("url"), "event_type",
    )


@register(
    "sel5_until_n",
    _LISTING + "SELECT list_page, pos, url FROM f WHERE event_type <> 'error' ORDER BY list_page, pos LIMIT 40",
)
def sel5(spark, d):
    return select.until_n(
        _listing(spark, d), 40, success=F.col("event_type") != "error"
    ).select("list_page", "pos", "url")


@register(
    "sel5_collect_payloads",
    truth(
        "SELECT p.k, c_name AS person_name FROM person p JOIN (SELECT k, row_number() OVER (ORDER BY k) AS r FROM "
        "(SELECT DISTINCT o_orderkey // 8 AS k FROM orders)) o ON o.k = p.k WHERE r > 7 ORDER BY p.k LIMIT 60"
    ),
)
def sel5_collect(spark, d):
    pages = B.profiles(spark, d)
    k = F.col("page_id")
    once = pages.select((F.floor(k / 10) + 1).alias("list_page"), (k % 10).alias("pos"), F.col("source_url").alias("url"))
    again = once.where("pos % 4 = 0").select((F.col("list_page") + 1).alias("list_page"), F.lit(50).cast("bigint").alias("pos"), "url")
    done = collect_payloads(once.unionByName(again), pages, 60, as_of=B.AS_OF_TIME, skip=7)
    return _k(done.payloads).select("k", "parsed.person_name")


@register(
    "sel6_project_mode",
    truth("SELECT k, true AS has_raw, true AS has_cleaned, false AS has_parsed FROM person"),
)
def sel6(spark, d):
    shown = select.project_mode(B.payloads(spark, d), select.PayloadMode.RAW_CLEANED)
    return _k(shown).select(
        "k", F.col("raw_html").isNotNull().alias("has_raw"),
        F.col("cleaned_text").isNotNull().alias("has_cleaned"),
        F.col("parsed").isNotNull().alias("has_parsed"),
    )


@register("sel7_drop_unsupported", truth("SELECT k FROM person"))
def sel7(spark, d):
    return _k(select.drop_unsupported(B.cleaned(spark, d))).select("k")


# --------------------------------------------------------------------------
# text
# --------------------------------------------------------------------------
@register("txt1_clean_html", CLEAN + "SELECT page_id, cleaned_text FROM cleaned")
def txt1(spark, d):
    return text.clean_html(B.driver_pages(spark, d)).select("page_id", "cleaned_text")


def _nested_markup() -> Column:
    """Block elements in each other, left open, and angle brackets in attributes."""
    k, name, segment = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    shapes = [
        ("<dl><dt>Segment:</dt><dd><p>", segment, "</p></dd><dt><b>Name</b></dt><dd><ul><li>", name, "</li></ul></dd></dl>"),
        ("<ul><li><p>", name, "</p><p>", segment, "</p></li><li>x", k, "</li></ul>"),
        ("<ul><li>", name, "<ul><li>", segment, "</li><li>", k, "</li></ul></li></ul><p>end</p>"),
        ("<ul><li><div><p>", name, "</p></div><li>", segment, "</ul>tail ", k),
        ("<p title=\"", k, " > 1\" class='a>b'>", name, "</p><a href='?x>", k, "'>", segment, "</a>"),
        ("<div><p>", name, "</div><div>", segment, "</div><li><dl><dt>", k, "</dt><dd>v</dd></dl></li>"),
    ]
    made = F.lit(None).cast("string")
    for i, parts in enumerate(shapes):
        text = F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
        made = F.when(k % len(shapes) == i, text).otherwise(made)
    return made


@register(
    "txt1_nested_blocks",
    "SELECT c_custkey AS k, CASE c_custkey % 6 "
    "WHEN 0 THEN 'Segment: ' || c_mktsegment || chr(10) || chr(10) || 'Name: ' || c_name "
    "WHEN 1 THEN '• ' || c_name || ' ' || c_mktsegment || chr(10) || chr(10) || '• x' || c_custkey "
    "WHEN 2 THEN '• ' || c_name || ' ' || c_mktsegment || ' ' || c_custkey || chr(10) || chr(10) || 'end' "
    "WHEN 3 THEN '• ' || c_name || chr(10) || chr(10) || '• ' || c_mktsegment || chr(10) || chr(10) || 'tail ' || c_custkey "
    "WHEN 4 THEN c_name || chr(10) || chr(10) || c_mktsegment "
    "ELSE c_name || chr(10) || chr(10) || c_mktsegment || chr(10) || chr(10) || '• ' || c_custkey || ': v' END AS cleaned_text FROM customer",
)
def txt1_nested(spark, d):
    pages = B.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), _nested_markup().alias("html"))
    return text.clean_html(pages).select("k", "cleaned_text")


_DOC_LINES = r"""
WITH t AS (
  SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(160), ' '),
    '\r\n?|[\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]', chr(10), 'g'), '[ \t]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10)) AS t
  FROM documents
), l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: x <> '') AS ls FROM t))
"""


@register("txt2_line_table", _DOC_LINES + "SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line FROM l")
def txt2(spark, d):
    documents = B.table(spark, d, "documents").select("doc_id", "text")
    return B.longs(text.line_table(documents, "text", ["doc_id"]), "line_no")


@register(
    "txt3_select_container",
    truth(
        "SELECT k, CASE WHEN k % 40 = 3 THEN 'whole_page_fallback' ELSE 'resume_id_block' END AS parse_mode, "
        "CASE WHEN k % 40 = 3 THEN 'missing_main_resume_block|used_whole_page_fallback' ELSE '' END AS warnings, "
        "k % 40 = 3 AS has_footer, true AS has_end FROM head"
    ),
)
def txt3(spark, d):
    found = text.select_container(B.profiles(spark, d))
    return _k(found).select(
        "k", "parse_mode", B.joined("warnings"),
        F.contains("raw_html", F.lit("<footer>")).alias("has_footer"),
        F.contains("raw_html", F.lit("<p>приховано</p></div>")).alias("has_end"),
    )


@register(
    "txt4_classify_format",
    truth(
        "SELECT 'p' AS source, k AS id, 'structured' AS format FROM head UNION ALL "
        "SELECT 'd', doc_id, CASE WHEN len(list_filter(string_split(text, chr(10)), lambda x: contains(x, ':'))) >= 5 "
        "THEN 'br_only' ELSE 'unknown' END FROM documents"
    ),
)
def txt4(spark, d):
    documents = B.table(spark, d, "documents").select(
        F.lit("d").alias("source"), F.col("doc_id").alias("id"), F.col("text").alias("cleaned_text")
    )
    people = _k(B.cleaned(spark, d)).select(F.lit("p").alias("source"), F.col("k").alias("id"), "cleaned_text")
    return text.classify_format(people.unionByName(documents)).drop("cleaned_text")


# --------------------------------------------------------------------------
# fields
# --------------------------------------------------------------------------
def _supported(spark, d):
    return _k(select.drop_unsupported(B.cleaned(spark, d)))


@register(
    "fld1_label_value",
    truth("SELECT k, CASE WHEN k % 3 = 0 THEN segment || '; Водій' END AS value FROM person"),
)
def fld1(spark, d):
    return fields.label_value(_supported(spark, d), ["Розглядає посади"]).select("k", "value")


_LABELS = (
    "n_name AS city, CASE WHEN k % 2 = 1 THEN 'Київ|Львів' END AS ready_to_work, "
    "CASE WHEN k % 3 = 0 THEN segment || '|Водій' END AS considered_positions, "
    "k % 4 IN (0, 2) AS full_time, k % 4 IN (1, 2) AS part_time, k % 4 = 3 AS from_home"
)


@register("fld2_label_fields", truth(f"SELECT k, {_LABELS}, 18 + k % 50 AS age FROM person"))
def fld2(spark, d):
    found = fields.label_fields(_supported(spark, d), keys=K)
    return B.longs(found, "age").select(
        "k", "city", B.joined("ready_to_work"), B.joined("considered_positions"),
        "full_time", "part_time", "from_home", "age",
    )


@register(
    "fld3_name_position",
    truth(f"SELECT k, c_name AS person_name, segment || ', ' || {AMOUNT} || ' грн' AS position FROM person"),
)
def fld3(spark, d):
    return fields.name_position(_supported(spark, d), keys=K)


@register("fld4_profile_date", truth("SELECT k, day AS resume_date FROM person"))
def fld4(spark, d):
    return fields.profile_date(_supported(spark, d), keys=K)


@register("fld5_salary", truth(f"SELECT k, {SALARY} AS salary, {POSITION} AS position FROM person"))
def fld5(spark, d):
    return B.longs(fields.salary(_supported(spark, d), keys=K), "salary")


@register("fld6_veteran", truth("SELECT k, k % 7 = 0 AS veteran FROM person"))
def fld6(spark, d):
    return fields.veteran(_supported(spark, d), keys=K)


_SECTIONS = (
    "work_experience, education, additional_education, skills, languages, recommendations, "
    "additional_info, disability"
)


@register("fld7_sections", truth(f"SELECT k, {_SECTIONS} FROM sections"))
def fld7(spark, d):
    found = fields.sections(_supported(spark, d), keys=K)
    return found.withColumns({c: F.array_join(c, "|") for c in ("skills", "languages")})


@register(
    "fld8_parse_profiles",
    truth(
        f"SELECT p.k, c_name AS person_name, day AS resume_date, {POSITION} AS position, {SALARY} AS salary, "
        + _LABELS.replace("k %", "p.k %")
        + ", p.k % 7 = 0 AS veteran, CAST(NULL AS DATE) AS birthday, "
        + ", ".join("s." + c.strip() for c in _SECTIONS.split(","))
        + " FROM person p JOIN sections s ON p.k = s.k"
    ),
)
def fld8(spark, d):
    found = fields.parse_profiles(_supported(spark, d)).select("k", "parsed.*")
    lists = ("ready_to_work", "considered_positions", "skills", "languages")
    return B.longs(found.withColumns({c: F.array_join(c, "|") for c in lists}), "salary")


# --------------------------------------------------------------------------
# work history
# --------------------------------------------------------------------------
def _work(spark, d):
    return B.parsed(spark, d, "work_experience", "position")


@register("wrk1_job_blocks", truth("SELECT k, block_no, title, dates_line, duties_text FROM block"))
def wrk1(spark, d):
    found = work.job_blocks(_work(spark, d), keys=K)
    return B.longs(found, "block_no").select("k", "block_no", "title", "dates_line", "duties_text")


@register(
    "wrk2_dates_line",
    truth(
        'SELECT b.k, block_no, i."start", i."end", i.company, i.city, i.industry FROM block b '
        "JOIN item i ON b.k = i.k AND b.block_no = i.pos AND i.sub = 0"
    ),
)
def wrk2(spark, d):
    found = work.dates_line(work.job_blocks(_work(spark, d), keys=K))
    return B.longs(found, "block_no").select("k", "block_no", "start", "end", "company", "city", "industry")


@register(
    "wrk3_span_months",
    "WITH t AS (SELECT o_orderkey, year(o_orderdate) * 12 + month(o_orderdate) AS a, CASE WHEN o_orderstatus = 'O' THEN 2026 * 12 + 1 "
    "WHEN o_orderstatus = 'F' THEN 1998 * 12 + 6 ELSE NULL END AS b FROM orders) "
    "SELECT o_orderkey, CAST(coalesce(greatest(b - a + 1, 0), 0) AS BIGINT) AS months FROM t",
)
def wrk3(spark, d):
    orders = B.table(spark, d, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "MM.yyyy").alias("start"),
        F.when(F.col("o_orderstatus") == "O", "present")
        .when(F.col("o_orderstatus") == "F", "червень 1998").otherwise("скоро").alias("end"),
    )
    return B.longs(work.span_months(orders, as_of=B.AS_OF), "months").select("o_orderkey", "months")


@register(
    "wrk4_split_roles",
    truth("SELECT k, item_no, title, duties_text, v = 7 AS is_role FROM item WHERE v <= 7"),
)
def wrk4(spark, d):
    found = work.split_roles(_work(spark, d), keys=K)
    return B.longs(found, "item_no").select("k", "item_no", "title", "duties_text", "is_role")


@register(
    "wrk5_split_duties",
    truth(
        "SELECT k, item_no, CAST(generate_subscripts(duties, 1) - 1 AS BIGINT) AS duty_no, unnest(duties) AS duty "
        "FROM item WHERE v <= 7"
    ),
)
def wrk5(spark, d):
    roles = work.split_roles(_work(spark, d), keys=K)
    found = work.split_duties(roles, keys=("k", "item_no"), is_role="is_role")
    return B.longs(found, "item_no", "duty_no")


_ITEM = (
    'k, item_no, title, company, city, industry, "start", "end", months, '
    "array_to_string(duties, '|') AS duties, duties_text"
)


def _flat_items(df: DataFrame) -> DataFrame:
    flat = B.longs(df, "item_no", "months").withColumn("duties", F.array_join("duties", "|"))
    return flat.drop("block_text")


@register("wrk6_inline_year_jobs", truth(f"SELECT {_ITEM} FROM item WHERE v = 8"))
def wrk6(spark, d):
    return _flat_items(work.inline_year_jobs(_work(spark, d), as_of=B.AS_OF, keys=K))


@register("wrk7_one_line_jobs", truth(f"SELECT {_ITEM} FROM item WHERE v = 9"))
def wrk7(spark, d):
    return _flat_items(work.one_line_jobs(_work(spark, d), as_of=B.AS_OF, keys=K))


@register("wrk8_work_items", truth(f"SELECT {_ITEM} FROM item"))
def wrk8(spark, d):
    return _flat_items(work.work_items(_work(spark, d), as_of=B.AS_OF, keys=K))


# --------------------------------------------------------------------------
# education, skills, languages
# --------------------------------------------------------------------------
@register(
    "edu1_education_items",
    truth('SELECT k, item_no, place, degree, specialty, "start", "end", months, extra FROM edu'),
)
def edu1(spark, d):
    found = education.education_items(B.parsed(spark, d, "education"), keys=K)
    return B.longs(found, "item_no", "months")


@register("skl1_normalize_skills", truth("SELECT k, lower(array_to_string(skills, '|')) AS normalized_skills FROM skills"))
def skl1(spark, d):
    found = skills.normalize_skills(B.parsed(spark, d, "skills"))
    return found.select("k", B.joined("normalized_skills"))


@register(
    "skl2_languages",
    truth(
        "SELECT k, CAST(0 AS BIGINT) AS language_no, ['Англійська', 'Польська', 'Німецька', 'Французька', 'Іспанська'][k % 5 + 1] AS language, "
        "['середній', 'вище середнього', 'вільно'][k % 3 + 1] AS level FROM person UNION ALL "
        "SELECT k, 1, 'Українська', 'вільно' FROM person WHERE k % 2 = 0"
    ),
)
def skl2(spark, d):
    return B.longs(skills.languages(B.parsed(spark, d, "languages"), keys=K), "language_no")


@register("skl3_categories", truth("SELECT k, categories AS driving_categories FROM category"))
def skl3(spark, d):
    return skills.categories(B.parsed(spark, d, "skills")).select("k", B.joined("driving_categories"))


# --------------------------------------------------------------------------
# aggregations
# --------------------------------------------------------------------------
@register(
    "agg1_totals",
    truth(
        "SELECT coalesce(w.k, e.k) AS k, w.m AS total_work_months, " + years("w.m") + " AS total_work_years, "
        "e.m AS total_edu_months, " + years("e.m") + " AS total_edu_years FROM "
        "(SELECT k, CAST(sum(months) AS BIGINT) AS m FROM item GROUP BY k) w FULL JOIN "
        "(SELECT k, CAST(sum(months) AS BIGINT) AS m FROM edu GROUP BY k) e ON w.k = e.k"
    ),
)
def agg1(spark, d):
    studies = education.education_items(B.parsed(spark, d, "education"), keys=K)
    return aggregate.totals(B.items(spark, d), keys=K).join(
        aggregate.totals(studies, keys=K, out="edu"), "k", "full"
    )


_TITLES = "SELECT k, position, display_position, months, " + years("months") + " AS years, display_position AS titles, first_item_no FROM title_sum"


def _flat_titles(df: DataFrame) -> DataFrame:
    flat = B.longs(df, "months", "first_item_no").withColumn("titles", F.array_join("titles", "|"))
    return flat.select("k", "position", "display_position", "months", "years", "titles", "first_item_no")


@register("agg2_months_by_title", truth(_TITLES))
def agg2(spark, d):
    return _flat_titles(aggregate.months_by_title(B.items(spark, d), keys=K))


WORD_SLOTS = 228


def _words(text: str) -> Column:
    """A vector per text: a one for the slot of every word outside parentheses."""
    words = F.split(F.lower(F.regexp_replace(text, r"\s*\(.*\)", "")), "[^\\p{L}0-9]+")
    slots = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(WORD_SLOTS)))
    return F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.lit(WORD_SLOTS - 1).cast("bigint")),
        lambda i: F.array_contains(slots, i).cast("float"),
    ).alias("vector")


@register("agg3_months_by_title_similar", truth(_TITLES))
def agg3(spark, d):
    # with vectors of whole titles and a high threshold, clusters are the equal titles
    titles = B.items(spark, d).select("title").distinct().select("title", _words("title"))
    found = aggregate.months_by_title_similar(B.items(spark, d), titles, thr=0.99, keys=K)
    return _flat_titles(found)


@register("agg4_skill_months", truth("SELECT k, skill, skill_months FROM skill_sum"))
def agg4(spark, d):
    known = skills.known_skills(B.parsed(spark, d, "skills"), keys=K)
    return aggregate.skill_months(B.items(spark, d), known, keys=K)


@register(
    "agg5_skill_months_similar",
    truth(
        "SELECT d.k, s.name AS skill, CAST(sum(months) AS BIGINT) AS skill_months FROM duty d JOIN known s "
        "ON d.k = s.k AND replace(d.duty, ' (етап 1, етап 2; план)', '') = s.name WHERE months > 0 GROUP BY d.k, s.name"
    ),
)
def agg5(spark, d):
    # the vector of a duty ignores its parenthesis, so a staged duty is most similar to its skill
    jobs = B.items(spark, d)
    known = skills.known_skills(B.parsed(spark, d, "skills"), keys=K)
    duties = jobs.select(F.explode("duties").alias("duty")).distinct().select("duty", _words("duty"))
    named = known.select("skill").distinct().select("skill", _words("skill"))
    return aggregate.skill_months_similar(jobs, known, duties, named, thr=0.99, keys=K)


_PROCESSED = truth(
    "SELECT p.k, categories AS driving_categories, lower(array_to_string(skills, '|')) AS normalized_skills, "
    "sm.m AS skill_months, w.n AS n_work, w.text AS work, e.n AS n_edu, "
    + years("w.m") + " AS total_work_years, " + years("e.m") + " AS total_edu_years, t.text AS months_by_position "
    "FROM person p JOIN category c ON p.k = c.k JOIN skills s ON p.k = s.k "
    "LEFT JOIN (SELECT k, string_agg(skill || '=' || skill_months, '|' ORDER BY skill) AS m FROM skill_sum GROUP BY k) sm ON p.k = sm.k "
    "LEFT JOIN (SELECT k, count(*) AS n, CAST(sum(months) AS BIGINT) AS m, "
    "string_agg(title || '/' || \"start\" || '/' || \"end\" || '/' || months || '/' || len(duties), '|' ORDER BY item_no) AS text FROM item GROUP BY k) w ON p.k = w.k "
    "LEFT JOIN (SELECT k, count(*) AS n, CAST(sum(months) AS BIGINT) AS m FROM edu GROUP BY k) e ON p.k = e.k "
    "LEFT JOIN (SELECT k, string_agg(position || '=' || months, '|' ORDER BY months DESC, first_item_no) AS text FROM title_sum GROUP BY k) t ON p.k = t.k"
)


def _flat_processed(df: DataFrame) -> DataFrame:
    p = F.col("processed")
    counted = F.transform(
        F.array_sort(F.map_entries(p.skill_months)),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    jobs = F.transform(
        p.work_experience_items,
        lambda i: F.concat_ws("/", i.title, i.start, i.end, i.months.cast("string"), F.size(i.duties).cast("string")),
    )
    titles = F.transform(
        p.months_by_position, lambda t: F.concat(t.position, F.lit("="), t.months.cast("string"))
    )
    return df.select(
        "k", B.joined(p.driving_categories, "driving_categories"),
        B.joined(p.normalized_skills, "normalized_skills"), B.joined(counted, "skill_months"),
        F.size(p.work_experience_items).cast("bigint").alias("n_work"), B.joined(jobs, "work"),
        F.size(p.education_items).cast("bigint").alias("n_edu"),
        p.total_work_years.alias("total_work_years"), p.total_edu_years.alias("total_edu_years"),
        B.joined(titles, "months_by_position"),
    )


@register("agg6_assemble_processed", _PROCESSED)
def agg6(spark, d):
    numbered = _k(B.payloads(spark, d))
    return _flat_processed(assemble_processed(numbered, as_of=B.AS_OF, keys=K))


def _embedded(spark, d, texts: DataFrame) -> DataFrame:
    """``(text, vector)`` of ``(text, base)``: three of the given vectors by the base, and a
    lesser part by the text, so texts of one base are similar, not equal."""
    given = B.table(spark, d, "embeddings").select("vec_id", "embedding")
    n = given.agg(F.count("*")).scalar()

    def part(column: str, seed: int, weight: float) -> Column:
        return F.struct(F.pmod(F.xxhash64(column, F.lit(seed)), n).alias("vec_id"), F.lit(weight).alias("w"))

    mixed = F.array(*[part("base", i, 1.0) for i in range(3)], part("text", 9, 0.4))
    parts = texts.distinct().select("text", F.inline(mixed)).join(given, "vec_id")
    summed = parts.select("text", "w", F.posexplode("embedding").alias("at", "x")).groupBy("text", "at").agg(
        F.sum(F.col("x") * F.col("w")).alias("x")
    )
    listed = F.array_sort(F.collect_list(F.struct("at", "x")))
    return summed.groupBy("text").agg(F.transform(listed, lambda e: e.x).alias("vector"))


def _title_vectors(spark, d) -> DataFrame:
    title = F.col("title")
    titles = B.items(spark, d).select(title.alias("text"), F.concat(F.lit("title "), F.length(title) % 4).alias("base"))
    return _embedded(spark, d, titles)


def _skill_vectors(spark, d, known: DataFrame) -> DataFrame:
    listed = B.parsed(spark, d, "skills").select(F.explode("skills"))  # as the pages spell them
    texts = B.items(spark, d).select(F.explode("duties").alias("text")).union(known.select("skill")).union(listed).distinct()
    return _embedded(spark, d, texts.select("text", F.lower(F.regexp_replace("text", r"\s*\(.*\)", "")).alias("base")))


# titles whose lengths leave the same rest are similar: the shortest stands for them
_MERGED = (
    "SELECT k, lower(arg_min(title, len(title) * 1000 + item_no)) AS position, arg_min(title, len(title) * 1000 + item_no) AS display_position, "
    "CAST(sum(months) AS BIGINT) AS months, string_agg(DISTINCT title, '|' ORDER BY title) AS titles, min(item_no) AS first_item_no "
    "FROM item WHERE months > 0 GROUP BY k, len(title) % 4"
)
_STAGED = (
    "SELECT d.k, s.name AS skill, CAST(sum(months) AS BIGINT) AS skill_months FROM duty d JOIN known s "
    "ON d.k = s.k AND replace(d.duty, ' (етап 1, етап 2; план)', '') = s.name WHERE months > 0 GROUP BY d.k, s.name"
)


@register(
    "agg3_titles_merge_on_embeddings",
    truth("SELECT k, position, display_position, months, " + years("months") + f" AS years, titles, first_item_no FROM ({_MERGED})"),
)
def agg3_embeddings(spark, d):
    vectors = _title_vectors(spark, d).withColumnRenamed("text", "title")
    return _flat_titles(aggregate.months_by_title_similar(B.items(spark, d), vectors, thr=0.6, keys=K))


@register("agg5_duties_match_on_embeddings", truth(_STAGED))
def agg5_embeddings(spark, d):
    known = skills.known_skills(B.parsed(spark, d, "skills"), keys=K)
    vectors = _skill_vectors(spark, d, known)
    return aggregate.skill_months_similar(
        B.items(spark, d), known, vectors.withColumnRenamed("text", "duty"), vectors.withColumnRenamed("text", "skill"), keys=K
    )


@register(
    "agg6_semantic",
    _PROCESSED.replace("FROM skill_sum GROUP BY k", f"FROM ({_STAGED}) GROUP BY k").replace("FROM title_sum GROUP BY k", f"FROM ({_MERGED}) GROUP BY k"),
)
def agg6_semantic(spark, d):
    known = skills.known_skills(B.parsed(spark, d, "skills"), keys=K)
    vectors = _title_vectors(spark, d).unionByName(_skill_vectors(spark, d, known))
    numbered = _k(B.payloads(spark, d))
    return _flat_processed(assemble_processed_similar(numbered, vectors, as_of=B.AS_OF, keys=K, title_thr=0.6))


@register(
    "agg7_run_stats",
    LINKS.rstrip() + " SELECT (SELECT count(DISTINCT page_id) FROM pages) AS pages_visited, (SELECT count(*) FROM link) AS urls_found, "
    "count(*) FILTER (WHERE k % 50 <> 0) AS payloads_yielded, count(*) FILTER (WHERE k % 50 = 0) AS payloads_failed, "
    "count(*) FILTER (WHERE k % 40 = 3) AS missing_main_block FROM (SELECT DISTINCT o_orderkey // 8 AS k FROM orders)",
)
def agg7(spark, d):
    tried = B.cleaned(spark, d).select("parse_mode", select.is_supported(F.col("cleaned_text")).alias("ok"))
    listing = B.driver_pages(spark, d).withColumnRenamed("page_id", "list_page")
    return aggregate.run_stats(listing, _links(spark, d), tried)


@register(
    "agg7_stream_stats",
    "SELECT count(*) AS urls_found, count(*) FILTER (WHERE k % 50 <> 0) AS payloads_yielded, count(*) FILTER (WHERE k % 50 = 0) AS payloads_failed, "
    "count(*) FILTER (WHERE k % 40 = 3) AS missing_main_block FROM (SELECT DISTINCT o_orderkey // 8 AS k FROM orders)",
)
def agg7_stream(spark, d):
    stats = SS.RunStats("checked")
    spark.streams.addListener(stats)
    try:
        arriving = ST.dealt(ST.stream_pages(spark, corpus_path(spark, d), files_per_batch=2))
        tried = cleaned_pages(arriving.drop("seen"))
        counted = SS.observed(tried.select("parse_mode", select.is_supported(F.col("cleaned_text")).alias("ok")), "checked")
        query = (
            counted.writeStream.format("noop").option("checkpointLocation", new_scratch_path(spark, "state"))
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        stats.wait(query)
    finally:
        spark.streams.removeListener(stats)
    return spark.createDataFrame([tuple(stats.totals().values())], ", ".join(f"{c} bigint" for c in SS.COUNTS))


# --------------------------------------------------------------------------
# similarity
# --------------------------------------------------------------------------
_NORMED = (
    "WITH n AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) / "
    "sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE))))) AS v FROM embeddings) "
)


@register(
    "sim1_cosine_pairs",
    _NORMED + "SELECT a.vec_id, round(list_dot_product(a.v, b.v), 4) AS similarity FROM n a JOIN n b ON b.vec_id = a.vec_id + 1",
)
def sim1(spark, d):
    vectors = B.table(spark, d, "embeddings").select("vec_id", "embedding")
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("vector_b"))
    pairs = vectors.withColumnRenamed("embedding", "vector_a").join(following, "vec_id")
    return similarity.cosine_pairs(pairs).select("vec_id", F.round("similarity", 4).alias("similarity"))


@register(
    "sim2_nearest",
    _NORMED + "SELECT a.vec_id AS query_id, b.vec_id AS item_id, round(list_dot_product(a.v, b.v), 4) AS score, "
    "row_number() OVER (PARTITION BY a.vec_id ORDER BY list_dot_product(a.v, b.v) DESC, b.vec_id) AS rank FROM n a JOIN n b "
    "ON a.vec_id <> b.vec_id AND list_dot_product(a.v, b.v) >= 0.3 QUALIFY rank <= 2",
)
def sim2(spark, d):
    vectors = B.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector")
    )
    found = similarity.nearest(vectors, vectors, k=2, thr=0.3, skip_same=True)
    return B.longs(found.withColumn("score", F.round("score", 4)), "rank")


@register("sim2_nearest_in_cells", ORACLES["sim2_nearest"])
def sim2_cells(spark, d):
    vectors = B.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    found = similarity.nearest_in_cells(vectors, vectors, k=2, thr=0.3, skip_same=True, cells=32)
    return B.longs(found.withColumn("score", F.round("score", 4)), "rank")


# --------------------------------------------------------------------------
# store
# --------------------------------------------------------------------------
_HALVES = (
    "WITH a AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-08' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1), "
    "b AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-08' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) "
)
_COLUMNS = ("event_type", "value")


def _halves(spark, d):
    """Store rows after the first half of the events, and the second half as batch."""
    events = B.table(spark, d, "events").select(
        F.concat(F.lit("u"), F.col("user_id")).alias("source_url"), "event_type", "value", "props", "ts", "event_id"
    )
    cut = F.lit("2024-01-08").cast("timestamp_ntz")

    def batch(rows: DataFrame) -> DataFrame:
        last = select.dedupe_first(rows, "source_url", [F.desc("ts"), F.desc("event_id")])
        return last.select("source_url", *_COLUMNS, F.col("props").alias("processed_json"))

    empty = spark.createDataFrame(
        [], "id bigint, source_url string, event_type string, value double, processed_json string, "
        "created_at timestamp_ntz, updated_at timestamp_ntz"
    )
    stored = S.upsert(
        empty, batch(events.filter(F.col("ts") < cut)), as_of="2026-01-01 00:00:00", columns=_COLUMNS
    ).drop("inserted")
    return stored, batch(events.filter(F.col("ts") >= cut))


@register(
    "sto1_upsert",
    _HALVES + "SELECT 'u' || coalesce(a.user_id, b.user_id) AS source_url, coalesce(b.event_type, a.event_type) AS event_type, "
    "CASE WHEN b.user_id IS NULL THEN a.value ELSE b.value END AS value, coalesce(a.props, NULL) AS processed_json, "
    "CASE WHEN a.user_id IS NULL THEN TIMESTAMP '2026-01-02' ELSE TIMESTAMP '2026-01-01' END AS created_at, "
    "CASE WHEN b.user_id IS NULL THEN TIMESTAMP '2026-01-01' ELSE TIMESTAMP '2026-01-02' END AS updated_at, "
    "CASE WHEN b.user_id IS NOT NULL THEN a.user_id IS NULL END AS inserted FROM a FULL JOIN b ON a.user_id = b.user_id",
)
def sto1(spark, d):
    stored, batch = _halves(spark, d)
    plain = batch.withColumn("processed_json", F.lit(None).cast("string"))
    return S.upsert(stored, plain, as_of="2026-01-02 00:00:00", columns=_COLUMNS).drop("id")


@register(
    "sto2_set_processed",
    _HALVES + "SELECT 'u' || a.user_id AS source_url, a.event_type, coalesce(b.props, a.props) AS processed_json, "
    "CASE WHEN b.user_id IS NULL THEN TIMESTAMP '2026-01-01' ELSE TIMESTAMP '2026-01-03' END AS updated_at "
    "FROM a LEFT JOIN b ON a.user_id = b.user_id",
)
def sto2(spark, d):
    stored, batch = _halves(spark, d)
    found = S.set_processed(
        stored, batch.select("source_url", F.col("processed_json").alias("processed")), as_of="2026-01-03 00:00:00"
    )
    return found.select("source_url", "event_type", "processed_json", "updated_at")


def _event_store(spark, d):
    return B.table(spark, d, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("source_url"), "user_id",
        F.when(F.col("value") > 10, F.col("props")).alias("processed_json"), F.col("props").alias("parsed_json"),
        F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"),
    )


@register(
    "sto3_store_stats",
    "SELECT count(*) AS total, count(*) FILTER (WHERE value > 10) AS processed, count(props) AS parsed, "
    "min(ts) AS min_created, max(ts) AS max_updated FROM events",
)
def sto3(spark, d):
    return S.store_stats(_event_store(spark, d))


@register(
    "sto4_list_page",
    "SELECT event_id AS id, event_type AS source_url, ts AS updated_at FROM events ORDER BY ts DESC, event_id DESC LIMIT 40 OFFSET 80",
)
def sto4(spark, d):
    return S.list_page(_event_store(spark, d), 3, 40, columns=("id", "source_url", "updated_at"))


@register("sto5_get_profile", "SELECT event_id AS id, event_type AS source_url, ts AS updated_at FROM events WHERE event_id = 77")
def sto5(spark, d):
    return S.get_profile(_event_store(spark, d), 77).select("id", "source_url", "updated_at")


@register(
    "sto6_json_filter",
    "SELECT event_id AS id, props AS parsed_json FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) = 69",
)
def sto6(spark, d):
    return S.json_filter(_event_store(spark, d), "parsed_json", "k", 69).select("id", "parsed_json")


@register(
    "sto6_contains",
    "SELECT event_id AS id FROM events WHERE event_type = 'click' AND user_id % 5 = 2 AND CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 = 1",
)
def sto6_contains(spark, d):
    number = F.get_json_object("props", "$.k").cast("int")
    tags = F.array(F.concat(F.lit("u"), F.col("user_id") % 5), F.lit("all"))
    nested = F.struct(F.col("event_type").alias("type"), F.struct((number % 3).alias("rest"), tags.alias("tags")).alias("n"))
    docs = B.table(spark, d, "events").select(F.col("event_id").alias("id"), F.to_json(nested).alias("doc"))
    path = new_scratch_path(spark, "containment")
    S.containment_index(docs, "doc").sort("path", "value").write.parquet(path)
    part = {"type": "click", "n": {"tags": ["u2"], "rest": 1}}
    return S.contains_indexed(docs, "doc", part, spark.read.parquet(path)).select("id")


@register(
    "sto1_store_batches",
    truth(
        f"SELECT k, {SALARY} AS salary, day AS resume_date, CASE WHEN k % 2 = 0 THEN TIMESTAMP '2026-01-01' ELSE TIMESTAMP '2026-01-02' END AS created_at, "
        "CASE WHEN k % 6 = 0 OR k % 2 = 1 THEN TIMESTAMP '2026-01-02' ELSE TIMESTAMP '2026-01-01' END AS updated_at FROM person"
    ),
)
def sto1_store(spark, d):
    payloads = _k(B.payloads(spark, d))
    store = S.ProfileStore(spark, new_scratch_path(spark, "store"))
    store.upsert(payloads.where("k % 2 = 0").drop("k"), as_of="2026-01-01 00:00:00", token="first", stored=True)
    second = payloads.where("k % 6 = 0 OR k % 2 = 1").drop("k")
    for _ in range(2):  # a repeated batch changes nothing
        store.upsert(second, as_of="2026-01-02 00:00:00", token="second", stored=True)
    return _k(store.read()).select(
        "k", F.col("parsed_json.salary").cast("bigint").alias("salary"), "resume_date", "created_at", "updated_at"
    )


# --------------------------------------------------------------------------
# streams
# --------------------------------------------------------------------------
@register(
    "str1_stream_payloads",
    truth(
        f"SELECT k, CASE WHEN k % 40 = 3 THEN 'whole_page_fallback' ELSE 'resume_id_block' END AS parse_mode, "
        f"c_name AS person_name, {SALARY} AS salary FROM person"
    ),
)
def str1(spark, d):
    out, state = new_scratch_path(spark, "stream"), new_scratch_path(spark, "state")
    stream = ST.stream_payloads(spark, corpus_path(spark, d), as_of=B.AS_OF_TIME)
    query = (
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    written = _k(spark.read.schema(stream.schema).parquet(out))
    return written.select(
        "k", "meta.parse_mode", "parsed.person_name", F.col("parsed.salary").cast("bigint").alias("salary")
    )


@register("str1_new_pages", ORACLES["str1_stream_payloads"])
def str1_places(spark, d):
    # files with every URL twice, and some a third time
    pages = spark.read.parquet(corpus_path(spark, d))
    twice = pages.unionByName(pages).unionByName(pages.where("page_id % 3 = 0"))
    folder, out = new_scratch_path(spark, "arriving"), new_scratch_path(spark, "stream")
    twice.repartition(6, F.rand(7)).write.parquet(folder)

    def save(batch: DataFrame, batch_id: int) -> None:
        build_payloads(batch, as_of=B.AS_OF_TIME).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = ST.stream_new_pages(
        ST.stream_pages(spark, folder, files_per_batch=2), save, checkpoint=new_scratch_path(spark, "state"), available_now=True
    )
    query.awaitTermination()
    return _k(spark.read.parquet(out)).select(
        "k", "meta.parse_mode", "parsed.person_name", F.col("parsed.salary").cast("bigint").alias("salary")
    )


@register(
    "str2_stream_upsert",
    truth(
        f"SELECT p.k, {SALARY} AS salary, day AS resume_date, w.n AS n_work, " + years("w.m") + " AS total_work_years "
        "FROM person p JOIN (SELECT k, count(*) AS n, CAST(sum(months) AS BIGINT) AS m FROM item GROUP BY k) w ON p.k = w.k"
    ),
)
def str2(spark, d):
    store = S.ProfileStore(spark, new_scratch_path(spark, "store"))
    query = ST.stream_upsert(
        ST.stream_pages(spark, corpus_path(spark, d)), store, as_of=B.AS_OF_TIME,
        checkpoint=new_scratch_path(spark, "state"), available_now=True,
    )
    query.awaitTermination()
    return _k(store.read()).select(
        "k", F.col("parsed_json.salary").cast("bigint").alias("salary"), "resume_date",
        F.size("processed_json.work_experience_items").cast("bigint").alias("n_work"),
        F.col("processed_json.total_work_years").alias("total_work_years"),
    )
