"""Pages to payloads: container, cleaning, unsupported pages out, 20-field record.

The whole plan is one stage without an exchange: each page is handled inside its
own row, so it scales with the number of input splits and has no key to skew on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierflow.functions import vocabulary as V
from dossierflow.operators import fields, select, text


def cleaned_pages(pages: DataFrame, *, url: str = "source_url", html: str = "html") -> DataFrame:
    """``source_url, raw_html, has_container, parse_mode, warnings, cleaned_text``."""
    narrowed = text.select_container(
        pages.select(F.col(url).alias("source_url"), F.col(html).alias("html"))
    )
    return text.clean_html(narrowed, html="raw_html")


def build_payloads(
    pages: DataFrame, *, as_of: str, mode: select.PayloadMode | str = "raw_cleaned_parsed",
    **options,
) -> DataFrame:
    """Payload table of ``schemas.PAYLOAD``. ``as_of`` is the collection time;
    ``options`` go to :func:`dossierflow.operators.fields.parse_profiles`."""
    kept = select.drop_unsupported(cleaned_pages(pages))
    mode = select.PayloadMode(mode)
    if mode is select.PayloadMode.RAW_CLEANED_PARSED:
        parsed = fields.parse_profiles(kept, **options)
        unnamed = F.col("parsed.person_name") == V.UNKNOWN_NAME
    else:
        parsed = kept.withColumn("parsed", F.lit(None))
        unnamed = F.lit(False)
    warnings = F.when(
        unnamed, F.array_append(F.col("warnings"), F.lit(V.WARN_NO_NAME))
    ).otherwise(F.col("warnings"))
    payloads = parsed.select(
        F.lit(V.PAYLOAD_SCHEMA_VERSION).alias("schema_version"),
        "source_url",
        "raw_html",
        "cleaned_text",
        "parsed",
        F.struct(
            F.col("parse_mode"),
            warnings.alias("warnings"),
            F.lit(as_of).cast("timestamp_ntz").alias("scraped_at"),
        ).alias("meta"),
    )
    return select.project_mode(payloads, mode)
