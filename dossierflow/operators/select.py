"""Choosing pages: ranges, URL lists, first-wins de-duplication, limits, modes."""

from __future__ import annotations

from collections.abc import Iterable
from enum import Enum

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossierflow import schemas
from dossierflow.functions import text as T
from dossierflow.sources.pages import absolute_url


class PayloadMode(str, Enum):
    """How much of a payload to make; unused columns are never computed."""

    RAW = "raw"
    RAW_CLEANED = "raw_cleaned"
    RAW_CLEANED_PARSED = "raw_cleaned_parsed"


# markers of pages without profile text (fixed values)
FILE_ONLY = r"файл резюме|завантажити файл|прикріплен(?:ий|і)\s+файл"
BUSINESS_CARD = "• Візитка"
# one pass for both
_UNSUPPORTED = T.any_case_of(("файл", "завантажити", "прикріплен", "•"), f"{FILE_ONLY}|{BUSINESS_CARD}")


def pages_range(listing: DataFrame, lo: int, hi: int, page: str = "list_page") -> DataFrame:
    """Inclusive range of listing pages; prunes partitions of a table laid out by page."""
    return listing.filter(F.col(page).between(lo, hi))


def by_urls(
    pages: DataFrame, urls: Iterable[str] | DataFrame, *, url: str = "source_url",
    base: str = "", dedupe: bool = True,
) -> DataFrame:
    """Pages of an explicit URL list with the caller's position ``req_pos``.

    ``urls`` is a list, or a table ``(req_pos, url)`` when it is long. The join
    is a plain equi-join, so Spark broadcasts the list only when it is small.
    """
    if not isinstance(urls, DataFrame):
        urls = pages.sparkSession.createDataFrame(
            list(enumerate(urls)), "req_pos BIGINT, url STRING"
        )
    wanted = urls.select(
        F.col("req_pos"), (absolute_url(F.col("url"), base) if base else F.col("url")).alias(url)
    )
    if dedupe:
        wanted = wanted.groupBy(url).agg(F.min("req_pos").alias("req_pos"))
    return pages.join(wanted, url).select("req_pos", *pages.columns).orderBy("req_pos")


def dedupe_first(
    df: DataFrame, key: str | list[str], order: list, *, enabled: bool = True
) -> DataFrame:
    """First row per key. ``row_number() = 1`` is cut down on the map side
    before the exchange, so a hot key ships one row per map task."""
    if not enabled:
        return df
    keys = [key] if isinstance(key, str) else key
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_first", first).filter(F.col("_first") == 1).drop("_first")


def skip_limit(
    df: DataFrame, *, key: str, order: list, skip: int = 0, limit: int | None = None,
    success: Column | None = None, dedupe: bool = True,
) -> DataFrame:
    """Skip the first distinct keys, then keep the first ``limit`` successes.

    Both steps are top-k operations with partial heaps per task; nothing is
    sorted or numbered in one task.
    """
    rows = dedupe_first(df, key, order, enabled=dedupe)
    if skip > 0:
        if dedupe:
            rows = rows.join(rows.orderBy(*order).limit(skip).select(key), key, "left_anti")
        else:
            names = [c if isinstance(c, str) else None for c in order]
            if None in names:
                raise ValueError("without dedupe, order must be column names that identify a row")
            rows = rows.join(rows.orderBy(*order).limit(skip).select(*names), names, "left_anti")
    if success is not None:
        rows = rows.filter(success)
    if limit is None:
        return rows.select(*df.columns)
    return rows.orderBy(*order).limit(max(0, limit)).select(*df.columns)


def until_n(
    listing: DataFrame, n: int, *, start_page: int = 1, max_pages: int | None = None,
    skip: int = 0, success: Column | None = None, dedupe: bool = True,
    page: str = "list_page", pos: str = "pos", url: str = "url",
) -> DataFrame:
    """Scan listing pages upward until ``n`` successes, the first page without
    links, or ``max_pages``."""
    start = max(1, start_page)
    ahead = listing.filter(F.col(page) >= start)
    if max_pages is not None:
        ahead = ahead.filter(F.col(page) < start + max_pages)
    # the first gap: a visited page (or the one before the start) with no successor
    spark = listing.sparkSession
    seen = ahead.select(F.col(page).cast("bigint").alias("p")).distinct()
    visited = seen.unionByName(spark.range(start - 1, start).select(F.col("id").alias("p")))
    ends = visited.join(seen.select((F.col("p") - 1).alias("p")), "p", "left_anti")
    last = ends.agg(F.min("p"))
    reached = ahead.filter(F.col(page) <= last.scalar())
    return skip_limit(
        reached, key=url, order=[page, pos], skip=skip, limit=n, success=success, dedupe=dedupe
    )


def project_mode(payloads: DataFrame, mode: PayloadMode | str) -> DataFrame:
    """Blank the columns a mode leaves out; pruning then skips their work."""
    mode = PayloadMode(mode)
    blank = {
        PayloadMode.RAW: ("cleaned_text", "parsed"),
        PayloadMode.RAW_CLEANED: ("parsed",),
        PayloadMode.RAW_CLEANED_PARSED: (),
    }[mode]
    return payloads.select(
        *[
            F.lit(None).cast(schemas.PAYLOAD[c].dataType).alias(c) if c in blank else F.col(c)
            for c in payloads.columns
        ]
    )


def is_supported(text: Column) -> Column:
    return ~text.rlike(_UNSUPPORTED)


def drop_unsupported(df: DataFrame, text: str = "cleaned_text") -> DataFrame:
    """Drop pages that only hold an attached file or a business card."""
    return df.filter(is_supported(F.coalesce(F.col(text), F.lit(""))))
