"""HTML cleaning, line tables, container choice, layout class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierflow.functions import text as T
from dossierflow.functions import vocabulary as V
from dossierflow.operators.common import explode_rows, reused, settle
from dossierflow.sources.pages import profile_key


@reused
def _cleaned(html: str) -> Column:
    return T.clean_html(F.col(html))


def clean_html(pages: DataFrame, html: str = "html", out: str = "cleaned_text") -> DataFrame:
    """Add the cleaned text of each page (no shuffle, no Python)."""
    return settle(pages, **{out: _cleaned(html)})


def line_table(
    df: DataFrame, text: str, keys: list[str], *, drop_bullets: bool = False
) -> DataFrame:
    """One row per non-empty line: ``(*keys, line_no, line)``, numbered from 1."""
    lines = T.lines_of(F.col(text))
    if drop_bullets:
        lines = F.filter(F.transform(lines, lambda x: T.without_bullet(x)), lambda x: x != "")
    rows = explode_rows(df, keys, lines, "line", "pos")
    return rows.select(*keys, (F.col("pos") + 1).alias("line_no"), "line")


def container_start(html: Column, key: Column) -> Column:
    """1-based place of ``<div id="resume_<key>">``; 0 when there is none."""
    pattern = F.concat(
        F.lit(r"""(?i)<div\s(?:[^>]*\s)?id\s*=\s*["']?resume_"""), key, F.lit(r"""(?=["'\s>])""")
    )
    return F.when(key.isNull(), 0).otherwise(F.regexp_instr(html, pattern))


def _is_hidden(before: Column) -> Column:
    """Whether a place lies in a script or comment, from the text before it."""

    def more(opening: str, closing: str) -> Column:
        return F.regexp_count(before, F.lit(opening)) > F.regexp_count(before, F.lit(closing))

    return more(r"(?i)<script[\s>]", r"(?i)</script") | more("<!--", "-->")


@reused
def _container() -> Column:
    return T.div_element(F.substr(F.col("_shown"), F.col("_at")))


def select_container(
    pages: DataFrame, *, url: str = "source_url", html: str = "html"
) -> DataFrame:
    """Narrow each page to its profile container, else keep the whole page.

    Adds ``raw_html, has_container, parse_mode, warnings``.
    """
    columns = [c for c in pages.columns if c != html]
    keyed = pages.withColumn("_key", profile_key(F.col(url))).withColumn(
        "_at", container_start(F.col(html), F.col("_key"))
    )
    # a script may quote the container's tag: then look again without scripts
    quoted = (F.col("_at") > 0) & _is_hidden(F.left(F.col(html), F.col("_at") - 1))
    shown = F.when(quoted, F.regexp_replace(F.col(html), T.INVISIBLE, "<!>")).otherwise(F.col(html))
    found = settle(keyed, _shown=shown, _quoted=quoted).withColumn(
        "_at",
        F.when(F.col("_quoted"), container_start(F.col("_shown"), F.col("_key"))).otherwise(F.col("_at")),
    )
    has = F.col("_at") > 0
    warnings = F.when(has, F.array().cast("array<string>")).otherwise(
        F.array_compact(
            F.array(
                F.when(F.col("_key").isNotNull(), F.lit(V.WARN_NO_CONTAINER)),
                F.lit(V.WARN_WHOLE_PAGE),
            )
        )
    )
    raw = F.when(has, _container()).otherwise(F.col(html))
    return settle(
        found,
        raw_html=raw,
        has_container=has,
        parse_mode=F.when(has, V.MODE_CONTAINER).otherwise(V.MODE_WHOLE_PAGE),
        warnings=warnings,
    ).select(*columns, "raw_html", "has_container", "parse_mode", "warnings")


def classify_format(df: DataFrame, text: str = "cleaned_text", out: str = "format") -> DataFrame:
    """``structured`` when a section name occurs, ``br_only`` when at least five
    lines hold a colon, else ``unknown``."""
    t = F.coalesce(F.col(text), F.lit(""))
    colon_lines = F.regexp_count(t, F.lit(r"(?m)^.*:"))
    return df.withColumn(
        out,
        F.when(t.rlike("(?iu)" + T.any_of(V.STRUCTURED_MARKERS)), "structured")
        .when(colon_lines >= V.BR_ONLY_MIN_COLON_LINES, "br_only")
        .otherwise("unknown"),
    )
