"""Profile pages rendered from orders, lineitem, part, customer and nation.

One page per run of eight consecutive order keys, so a page has at most eight
jobs whatever the distribution of customers. Every part of a page follows from
columns of the given tables; ``checks/truth.py`` states the expected values in
SQL without looking at a page.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierflow.session import new_scratch_path

ORDERS_PER_PAGE = 8

COMPANIES = ("Альфа Трейд", "Бета Логістик", "Гамма", "Дельта Сервіс", "Омега")
CITIES = ("Київ", "Львів", "Одеса", "Біла Церква")
INDUSTRIES = ("Логістика", "Торгівля", "Автобізнес")
REGIONS = ("Київська обл.", "Львівська обл.")
EMPLOYMENT = ("повна зайнятість", "неповна зайнятість", "повна, неповна зайнятість", "віддалена робота")
DEGREE_WORDS = ("незакінчена вища", "вища", "середня спеціальна", "середня")
LANGUAGES = ("Англійська", "Польська", "Німецька", "Французька", "Іспанська")
MONTHS = (
    "січня", "лютого", "березня", "квітня", "травня", "червня",
    "липня", "серпня", "вересня", "жовтня", "листопада", "грудня",
)


def _pick(values, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _mm(month: Column) -> Column:
    return F.lpad(month.cast("string"), 2, "0")


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the markup of its job."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name")
    # an order holds each part name once; the name vocabulary bounds the list
    names = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set("p_name")).alias("names")
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    n = F.col("o_orderkey")
    k = F.floor(n / ORDERS_PER_PAGE)
    first = F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1
    last = first + n % 36
    base = orders.join(names, n == F.col("l_orderkey"), "left").select(
        k.alias("k"), n.alias("n"), "o_custkey", "o_orderdate",
        F.coalesce("names", F.array().cast("array<string>")).alias("names"),
        F.col("o_orderpriority").alias("prio"), F.col("o_orderstatus").alias("status"),
        F.floor(first / 12).alias("y1"), (first % 12 + 1).alias("m1"),
        F.floor(last / 12).cast("int").alias("y2"), (last % 12 + 1).cast("int").alias("m2"),
        (n % 36 + 1).alias("span"), (n % 11 == 0).alias("open"),
        _pick(COMPANIES, n % 5).alias("company"),
        _pick(CITIES, F.floor(n / 2) % 4).alias("city"),
        _pick(INDUSTRIES, n % 3).alias("industry"),
        _pick(REGIONS, n % 2).alias("region"),
    )
    n, k = F.col("n"), F.col("k")
    end = F.when(F.col("open"), "нині").otherwise(F.concat(_mm(F.col("m2")), F.lit("."), F.col("y2")))
    tail = (
        F.when(n % 4 == 2, F.format_string("%s (%s)", "company", "industry"))
        .when(n % 4 == 3, F.format_string("%s, %s (%s) (%s)", "company", "city", "region", "industry"))
        .otherwise(F.format_string("%s, %s (%s)", "company", "city", "industry"))
    )
    dates = F.concat(
        F.lit("з "), _mm(F.col("m1")), F.lit("."), F.col("y1"), F.lit(" по "), end,
        F.when(n % 6 == 5, "").otherwise(F.format_string(" (%d міс.)", "span")), F.lit(" "), tail,
    )
    duty_names = F.when(
        n % 9 == 0, F.transform("names", lambda x: F.concat(x, F.lit(" (етап 1, етап 2; план)")))
    ).otherwise(F.col("names"))
    duties = F.array_join(duty_names, ", ")
    primary = F.concat(
        F.lit("<div class='job'><h3>"), F.col("prio"), F.lit("</h3>\n<p>"), dates, F.lit("</p>"),
        F.when(F.size("names") > 0, F.concat(F.lit("<p>"), duties, F.lit("</p>"))).otherwise(""),
        F.lit("</div>"),
    )
    described = F.when(F.size("names") > 0, F.col("names")).otherwise(F.array(F.lit("нема")))
    role = F.regexp_replace("prio", "^[0-9]-", "")
    two_roles = F.concat(
        F.lit("<h3>Роль "), F.col("status"), F.lit(" / "), role, F.lit("</h3><p>"), dates, F.lit("</p><p>"),
        role, F.lit(": "), F.array_join(described, ". "), F.lit("</p><p>Роль "), F.col("status"),
        F.lit(" - "), F.array_join(described, "; "), F.lit("</p>"),
    )
    years_end = F.when(F.col("open"), "нині").otherwise((F.col("y1") + n % 3).cast("string"))
    inline = F.concat(
        F.lit("<p>"), F.col("prio"), F.lit(" ("), F.col("y1"), F.lit(" – "), years_end, F.lit(") "),
        F.col("company"), F.lit(" ("), F.col("industry"), F.lit(")</p>"),
        F.when(
            F.size("names") > 0, F.concat(F.lit("<p>"), F.array_join("names", ", "), F.lit("</p>"))
        ).otherwise(""),
    )
    year = F.when((n % 13 == 0) & ~F.col("open"), F.substr(F.col("y1").cast("string"), F.lit(3))).otherwise(
        F.col("y1").cast("string")
    )
    one_line = F.concat(
        F.lit("<p>з 01."), _mm(F.col("m1")), F.lit("."), year, F.lit(" по "),
        F.when(F.col("open"), "нині").otherwise(F.concat(F.lit("28."), _mm(F.col("m2")), F.lit("."), F.col("y2"))),
        F.lit(" - "), F.col("prio"), F.lit(", ТОВ "), F.col("company"), F.lit("</p>"),
    )
    html = (
        F.when(k % 10 == 7, two_roles).when(k % 10 == 8, inline).when(k % 10 == 9, one_line)
        .otherwise(primary)
    )
    return base.select("k", "n", "o_custkey", "o_orderdate", "names", html.alias("job"))


def render_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, url, html)``, one row per profile."""
    rows = F.array_sort(F.collect_list(F.struct("n", "o_custkey", "names", "job")))
    pages = _jobs(spark, sf_dir).groupBy("k").agg(
        rows.alias("jobs"), F.max("o_orderdate").alias("day")
    )
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    people = (
        pages.withColumn("c", F.get("jobs", F.lit(0))["o_custkey"])
        .join(customer, F.col("c") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    k = F.col("k")

    def when(condition: Column, *parts) -> Column:
        return F.when(condition, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])).otherwise("")

    def text(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    amount = F.abs((F.col("c_acctbal") * 10).cast("int")).cast("string")
    amount = F.regexp_replace(amount, r"(?<=[0-9])(?=(?:[0-9]{3})+$)", "&nbsp;")
    y1, y2 = 1970 + k % 25, 1970 + k % 25 + k % 6
    study = text(
        "КНТУ фак. Економіка, Київ, ", _pick(DEGREE_WORDS, k % 4), ", з ", y1, " по ", y2,
        " (", k % 6 + 1, " р.)",
    )
    skills = F.array_sort(F.array_distinct(F.flatten(F.transform(F.slice("jobs", 1, 3), lambda j: j.names))))
    skills = F.transform(skills, lambda s: F.when(k % 2 == 0, F.upper(s)).otherwise(s))
    skills = F.when(
        k % 5 == 0, F.concat(skills, F.array(F.lit("Водій кат. B"), F.lit("CE")))
    ).otherwise(skills)
    items = F.array_join(F.transform(skills, lambda s: F.concat(F.lit("<li>"), s, F.lit("</li>"))), "\n")
    language = _pick(LANGUAGES, k % 5)
    spoken = text(
        "<li>", language,
        F.when(k % 3 == 0, " — середній").when(k % 3 == 1, " upper intermediate").otherwise(": вільно"),
        "</li>",
    )
    html = text(
        "<!DOCTYPE html><html><head><title>Резюме</title><style>p{margin:0}</style>",
        "<script>var t=\"</div><div id='resume_0'>\";</script></head><body>",
        "<nav><ul><li>Головна сторінка сайту вакансій</li></ul></nav><div class='wrap'>",
        F.when(k % 40 == 3, text("<div id='profile_", k, "'>")).otherwise(
            text("<div class='card' id=\"resume_", k, "\">")
        ),
        "<p class='hidden-print'>сховано</p>",
        "<p>Резюме від ", F.dayofmonth("day"), " ", _pick(MONTHS, F.month("day") - 1), " ", F.year("day"), "</p>",
        when(k % 50 == 0, "<p>Завантажити файл</p>"),
        "<div><h1>", F.col("c_name"), when(k % 7 == 0, " <span class='label'>Ветеран</span>"), "</h1></div>",
        "<h2 class='mt title-print'>", F.col("c_mktsegment"), ", ", amount, " грн</h2>",
        "<dl><dt>Місто проживання:</dt>\n<dd>", F.col("n_name"), "</dd>",
        "<dt>Зайнятість:</dt><dd><b>", _pick(EMPLOYMENT, k % 4), "</b></dd>",
        "<dt>Вік</dt><dd>", 18 + k % 50, " років</dd>",
        when(k % 2 == 1, "<dt>Готовий працювати:</dt><dd>Київ, Львів</dd>"),
        when(k % 3 == 0, "<dt>Розглядає посади:</dt><dd>", F.col("c_mktsegment"), "; Водій</dd>"),
        "</dl><div class='x hidden-print'><div>Місто: немає</div><p>ветеран</p></div>",
        "<h2>Досвід роботи</h2><div>", F.array_join(F.transform("jobs", lambda j: j.job), "\n"), "</div>",
        "<h2>Освіта</h2>",
        when(k % 3 == 1, "<p>Національний університет Харків</p><p>Право</p>"),
        when(k % 3 == 2, "<p>Перший інститут</p><p>Фізика</p><p>Хімія</p><p>Другий університет</p>"),
        "<p>", study, "</p>", when(k % 3 == 1, "<p>Диплом</p>"),
        when(k % 8 == 1, "<h2>Додаткова освіта</h2><p>Курси Excel ", k % 9, "</p>"),
        "<h2>Знання і навички</h2><ul>", items, "</ul>",
        "<h2>Знання мов</h2><ul>", spoken, when(k % 2 == 0, "<li>Українська вільно</li>"),
        when(k % 4 == 0, spoken), "</ul>",
        when(k % 6 == 2, "<h2>Рекомендації</h2><p>Керівник ", k % 3, "</p>"),
        when(k % 6 == 0, "<h2>Інвалідність</h2><p>III група</p><p>довічно</p>"),
        when(k % 3 == 1, "<h2>Додаткова інформація</h2><p>Стаж ", k % 20, " &amp; ветеран праці</p><p>OK</p>"),
        "<h2>Контактна інформація</h2><p>приховано</p></div></div>",
        "<footer><p>&copy; сайт</p></footer></body></html>",
    )
    return people.select(
        k.cast("bigint").alias("page_id"),
        text("https://profiles.example/resumes/", k, "/").alias("url"),
        html.alias("html"),
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered pages, written once per session to the shared scratch folder."""
    known = spark.conf.get(_conf_key(sf_dir), "")
    if not known:
        known = new_scratch_path(spark, "profiles")
        render_profiles(spark, sf_dir).write.option("compression", "zstd").parquet(known)  # pages are alike
        spark.conf.set(_conf_key(sf_dir), known)
    return spark.read.parquet(known)


def corpus_path(spark: SparkSession, sf_dir: str) -> str:
    corpus(spark, sf_dir)
    return spark.conf.get(_conf_key(sf_dir))


def _conf_key(sf_dir: str) -> str:
    return "dossierflow.corpus." + hashlib.sha1(sf_dir.encode()).hexdigest()[:12]
