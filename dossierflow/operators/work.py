"""Work-history jobs: blocks, dates, roles, duties and the complete item table.

A profile's work text is split into entries inside its row; after the explode
every job is a row of its own and no step needs an exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierflow.functions import dates as D
from dossierflow.functions import text as T
from dossierflow.functions import work as W
from dossierflow.operators.common import explode_rows, reused, settle

KEYS = ("source_url",)


@reused
def _built(build) -> Column:
    return build(F.col("_text"))


def _blocks_by_role(text: Column) -> Column:
    return W.with_roles(W.title_blocks(text))


@reused
def _item(as_of, default: str | None, line_bullets: bool) -> Column:
    return W.item(
        F.col("e"), as_of, default=F.col(default) if default else None, line_bullets=line_bullets
    )


def _entries(df: DataFrame, keys, text: str, build, as_: str) -> DataFrame:
    """Settle the normal text, then one row per entry: ``(*keys, <as_>, e)``."""
    normal = settle(df.select(*keys, F.col(text)), _text=T.normal_text(F.col(text)))
    return explode_rows(normal, list(keys), _built(build), "e", as_)


def job_blocks(
    df: DataFrame, *, text: str = "work_experience", keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Blocks of the title-and-dates layout:
    ``(*keys, block_no, title, dates_line, body, duties_text, block_text)``."""
    rows = _entries(df, keys, text, W.title_blocks, "block_no")
    return rows.select(
        *keys, "block_no", F.col("e.title").alias("title"), F.col("e.head").alias("dates_line"),
        F.col("e.body").alias("body"), F.translate("e.body", "\n", " ").alias("duties_text"),
        F.col("e.block_text").alias("block_text"),
    )


def dates_line(blocks: DataFrame, *, line: str = "dates_line") -> DataFrame:
    """Add ``start, end, company, city, industry`` read from a dates line."""
    read = settle(blocks, _d=W.dates_fields(F.col(line)))
    return read.select(*blocks.columns, "_d.*")


def span_months(
    items: DataFrame, *, as_of: str | Column, start: str = "start", end: str = "end",
    out: str = "months",
) -> DataFrame:
    """Add months from start to end, both included; ``present`` counts to ``as_of``."""
    return items.withColumn(out, D.months_between(F.col(start), F.col(end), as_of))


def split_roles(
    df: DataFrame, *, text: str = "work_experience", keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Blocks with several described roles become one row per role:
    ``(*keys, item_no, title, dates_line, duties_text, block_text, is_role)``."""
    rows = _entries(df, keys, text, _blocks_by_role, "item_no")
    return rows.select(
        *keys, "item_no", F.col("e.title").alias("title"), F.col("e.head").alias("dates_line"),
        F.translate("e.body", "\n", " ").alias("duties_text"),
        F.col("e.block_text").alias("block_text"), (F.col("e.kind") == W.ROLE).alias("is_role"),
    )


def split_duties(
    items: DataFrame, *, text: str = "duties_text", keys: tuple[str, ...] = ("source_url", "item_no"),
    is_role: str | None = None, line_bullets: bool = False,
) -> DataFrame:
    """One row per duty: ``(*keys, duty_no, duty)``."""
    role = F.col(is_role) if is_role else F.lit(False)
    kind = F.when(role, W.ROLE).otherwise(W.BLOCK)
    duties = W.duties(kind, F.coalesce(F.col(text), F.lit("")), line_bullets=line_bullets)
    return explode_rows(items, list(keys), duties, "duty", "duty_no").select(*keys, "duty_no", "duty")


def _items(rows: DataFrame, keys, as_of: str | Column, line_bullets: bool = False) -> DataFrame:
    """Item fields of exploded entries ``(*keys, item_no, e)``."""
    made = settle(rows, _i=_item(as_of, None, line_bullets))
    return made.select(*keys, "item_no", "_i.*")


def inline_year_jobs(
    df: DataFrame, *, as_of: str | Column, text: str = "work_experience",
    keys: tuple[str, ...] = KEYS,
) -> DataFrame:
    """Jobs written as ``Title (2018 – 2021) Company (Industry)``."""
    return _items(_entries(df, keys, text, W.inline_blocks, "item_no"), keys, as_of)


def one_line_jobs(
    df: DataFrame, *, as_of: str | Column, text: str = "work_experience",
    keys: tuple[str, ...] = KEYS,
) -> DataFrame:
    """Jobs written as ``from X to Y - role, role, COMPANY``; their months are 0."""
    return _items(_entries(df, keys, text, W.one_line_entries, "item_no"), keys, as_of)


def work_items(
    df: DataFrame, *, as_of: str | Column, text: str = "work_experience",
    position: str | None = "position", keys: tuple[str, ...] = KEYS, line_bullets: bool = False,
) -> DataFrame:
    """All jobs of a profile, one row each, ``schemas.WORK_ITEM`` plus keys and
    ``item_no``. A missing title takes the profile position, else a position
    labelled inside the work text."""
    base = settle(
        df,
        _text=T.normal_text(F.col(text)),
        _title=W.default_title(F.col(position) if position else F.lit(None), F.col(text)),
    )
    rows = explode_rows(base, [*keys, "_title"], _built(W.entries), "e", "item_no")
    made = settle(rows, _i=_item(as_of, "_title", line_bullets))
    return made.select(*keys, "item_no", "_i.*")
