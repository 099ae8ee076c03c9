"""Inputs shared by the registered queries, written once per session."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierflow.operators import work
from dossierflow.plans.payloads import build_payloads, cleaned_pages
from dossierflow.session import new_scratch_path
from dossierflow.sources.pages import load_pages, profile_key
from fixtures.render import corpus_path

AS_OF = "2026-01-01"
AS_OF_TIME = "2026-01-01 00:00:00"
#: Pages of one task at most, and those worth a task of their own.
PAGES_PER_TASK, LEAST_PAGES = 4000, 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table in the shared scratch folder, made on first use."""
    key = f"dossierflow.{name}.{corpus_path(spark, sf_dir).rsplit('/', 1)[-1]}"
    path = spark.conf.get(key, "")
    if not path:
        path = new_scratch_path(spark, name)
        make().write.option("compression", "zstd").parquet(path)  # pages are alike
        spark.conf.set(key, path)
    return spark.read.parquet(path)


def spread(rows: DataFrame, by: str, n: int) -> DataFrame:
    """``n`` rows dealt by a key into even tasks, several per core and of a bounded number of pages.

    Files are read by their bytes, about a task per core or one more, which then runs alone; and
    a page takes far longer than its bytes say. Only the columns read later are moved."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, -(-n // PAGES_PER_TASK), min(4 * cores, -(-n // LEAST_PAGES))), by)


def driver_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_pages(spark, f"{sf_dir}/pages.parquet", keep=("page_id",))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered profile pages ``(page_id, source_url, html)``."""
    path = corpus_path(spark, sf_dir)
    n = spark.read.parquet(path).count()  # of the files' footers
    return spread(load_pages(spark, path, keep=("page_id",)), "page_id", n)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned profile pages, unsupported ones included."""
    made = _once(spark, sf_dir, "cleaned", lambda: cleaned_pages(profiles(spark, sf_dir)))
    return spread(made, "source_url", made.count())


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payload table at rest."""
    return _once(
        spark, sf_dir, "payloads",
        lambda: build_payloads(profiles(spark, sf_dir), as_of=AS_OF_TIME),
    )


def parsed(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """Columns of the parsed record with the profile number ``k``."""
    made = payloads(spark, sf_dir)
    return spread(made, "source_url", made.count()).select(
        number(F.col("source_url")).alias("k"), *[F.col(f"parsed.{f}").alias(f) for f in fields]
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job table at rest, keyed by ``k``."""
    return _once(
        spark, sf_dir, "items",
        lambda: work.work_items(
            parsed(spark, sf_dir, "work_experience", "position"), as_of=AS_OF, keys=("k",)
        ),
    )


def number(url: Column) -> Column:
    return profile_key(url).cast("bigint")


def joined(c: str | Column, alias: str | None = None) -> Column:
    """Arrays are compared as text."""
    column = F.col(c) if isinstance(c, str) else c
    return F.array_join(column, "|").alias(alias or c)


def longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})
