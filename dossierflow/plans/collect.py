"""From listing pages to payloads, no further than asked.

Listing pages are read in growing ranges. Links, first occurrences, skipped keys and successes
are settled on narrow rows; pages are read only for the URLs of a range, found by a
runtime filter on the page table, and once enough are good no later range is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierflow.operators.select import PayloadMode, is_supported
from dossierflow.plans.payloads import build_payloads, cleaned_pages
from dossierflow.session import new_scratch_path


@dataclass(frozen=True)
class Collected:
    """Payloads, and how far the listing was read."""

    payloads: DataFrame
    pages_visited: int
    urls_found: int
    urls_tried: int


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = new_scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def collect_payloads(
    links: DataFrame, pages: DataFrame, n: int, *, as_of: str, start_page: int = 1, max_pages: int | None = None,
    skip: int = 0, dedupe: bool = True, success: Column | None = None, first_range: int = 4, growth: int = 2,
    mode: PayloadMode | str = PayloadMode.RAW_CLEANED_PARSED, **options,
) -> Collected:
    """Payloads of the first ``n`` good pages in listing order, as :func:`until_n` counts them.

    ``links``: ``(list_page, pos, url)``, best laid out by ``list_page``; ``pages``:
    ``(source_url, html)``. From ``start_page`` on, the first page without links ends the
    listing, or ``max_pages`` do. Of a URL listed twice the first counts (``dedupe``); the
    first ``skip`` URLs are passed over. A page is good if it exists with content and is
    supported; ``success`` is a test of ``cleaned_text`` in place of the latter. Ranges grow by
    ``growth``, so at most that many times the listing pages needed are read.
    """
    spark = links.sparkSession
    if n <= 0:
        return Collected(build_payloads(pages.limit(0), as_of=as_of, mode=mode, **options), 0, 0, 0)
    low, step = max(1, start_page), max(1, first_range)
    end = None if max_pages is None else low + max_pages  # the first page not to visit
    known: DataFrame | None = None  # URLs of earlier ranges
    good: list[DataFrame] = []
    have = passed = visited = found = tried = 0
    while have < n and (end is None or low < end):
        high = low + step if end is None else min(low + step, end)
        rows = links.where(F.col("list_page").between(low, high - 1)).select("list_page", "pos", "url")
        there = [r.list_page for r in rows.select("list_page").distinct().orderBy("list_page").collect()]  # a range's pages
        gap = next((p for i, p in enumerate(range(low, high)) if i >= len(there) or there[i] != p), None)
        visited += (gap if gap is not None else high) - low
        rows = rows.where(F.col("list_page") < (high if gap is None else gap))
        if dedupe:
            rows = rows.groupBy("url").agg(F.min(F.struct("list_page", "pos")).alias("at")).select("at.list_page", "at.pos", "url")
            if known is not None:
                rows = rows.join(known, "url", "left_anti")
        fresh = _stored(rows, "links")
        count = fresh.count()
        found += count
        if dedupe:
            known = fresh.select("url") if known is None else known.unionByName(fresh.select("url"))
        if passed < skip:
            over = fresh.orderBy("list_page", "pos").limit(skip - passed)
            passed += min(count, skip - passed)
            fresh = fresh.join(over, ["list_page", "pos", "url"], "left_anti")
        tried += fresh.count()
        content = pages.where(F.col("html").isNotNull() & (F.col("html") != ""))
        chosen = content.join(fresh.withColumnRenamed("url", "source_url"), "source_url")
        text = cleaned_pages(chosen.select("source_url", "html")).select("source_url", "cleaned_text").distinct()
        passes = is_supported(F.coalesce("cleaned_text", F.lit(""))) if success is None else success
        urls = text.where(passes).select("source_url").distinct()
        right = _stored(fresh.withColumnRenamed("url", "source_url").join(urls, "source_url", "left_semi"), "good-links")
        taken = right.orderBy("list_page", "pos").limit(n - have)
        have += taken.count()
        good.append(taken)
        if gap is not None:
            break
        low, step = high, step * max(1, growth)
    best = good[0] if good else spark.createDataFrame([], "source_url string, list_page bigint, pos bigint")
    for more in good[1:]:
        best = best.unionByName(more)
    # at most n rows decide which pages are read
    wanted = pages.join(best.select("source_url").distinct(), "source_url", "left_semi")
    made = build_payloads(wanted.select("source_url", "html"), as_of=as_of, mode=mode, **options)
    return Collected(made, visited, found, tried)
