"""Page tables in, link tables and JSON lines out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierflow.functions import text as T
from dossierflow.operators.common import explode_rows

PROFILE_LINK = "/resumes/"
PROFILE_KEY = r"/resumes/([0-9]+)/"
_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(["'])(.*?)\1"""
_LINK_BOX = (
    r"""(?i)(<div\s[^>]*class\s*=\s*["'](?:[^"'>]*\s)?resume-link(?:\s[^"'>]*)?["'][^>]*>)"""
)


def load_pages(
    spark: SparkSession, path: str, *, url: str = "url", html: str = "html",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Collected pages that have content, as ``(*keep, source_url, html)``.

    Only the named columns are read and the null test reaches the scan.
    """
    pages = spark.read.parquet(path).select(
        *keep, F.col(url).alias("source_url"), F.col(html).alias("html")
    )
    return pages.filter(F.col("html").isNotNull() & (F.col("html") != ""))


def profile_key(url: Column) -> Column:
    return T.blank_to_null(F.regexp_extract(url, PROFILE_KEY, 1))


def absolute_url(href: Column, base: str) -> Column:
    """Join a path to the site's base address; query and fragment stay."""
    root = base.rstrip("/")
    return (
        F.when(href.rlike("^https?://"), href)
        .otherwise(F.concat(F.lit(root + "/"), F.ltrim(href, F.lit("/"))))
    )


def extract_links(
    listing: DataFrame, *, base: str, page: str = "page_id", html: str = "html",
    link_re: str = PROFILE_LINK, in_link_box: bool = True,
) -> DataFrame:
    """Profile links of listing pages: ``(list_page, pos, url, key)``.

    ``pos`` is the place among the distinct links of the page, first occurrence
    first. ``in_link_box`` keeps to anchors inside ``div.resume-link``.
    """
    markup = T.let(F.regexp_replace(F.col(html), T.INVISIBLE, "<!>"), T.quoted_angles)
    if in_link_box:
        boxes = F.split(F.regexp_replace(markup, _LINK_BOX, T.MARK + "$1"), T.MARK)
        markup = F.array_join(
            F.transform(
                F.slice(boxes, F.lit(2), F.size(boxes)), T.div_element
            ),
            "",
        )
    urls = F.transform(
        F.regexp_extract_all(markup, F.lit(_HREF), F.lit(2)),
        lambda h: absolute_url(T.decode_entities(h), base),
    )
    # an empty href resolves to the bare base address and is no link
    urls = F.filter(urls, lambda u: u.rlike(link_re) & (u != base.rstrip("/") + "/"))
    links = explode_rows(
        listing.withColumn("list_page", F.col(page)), ["list_page"], F.array_distinct(urls), "url", "pos"
    )
    return links.select("list_page", "pos", "url", profile_key(F.col("url")).alias("key"))


def as_json(df: DataFrame) -> DataFrame:
    """One JSON text per row: ISO dates, null fields kept, text not escaped."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))


def export_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write one JSON object per line (UTF-8)."""
    df.write.mode(mode).option("ignoreNullFields", "false").option("encoding", "UTF-8").json(path)
