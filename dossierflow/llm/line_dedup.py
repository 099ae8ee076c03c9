"""Line de-duplication: lines that several documents share stay in one of them.

Lines are exploded as (digest of the normalised line, document, position); the
text itself stays behind. Documents are counted per digest with two map-side
sums, the few shared digests are joined back to the line positions, and each
document is put together again from the positions that stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierflow.llm.common import narrow, same, written

SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without outer ASCII white space, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, UPPER.lower())


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    exploded = docs.select("doc_id", "copy", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    key = exploded.select("doc_id", "copy", "pos", line_key(F.col("line")).alias("key"))
    return key.where(F.length("key") >= min_chars).select(
        "doc_id", "copy", "pos", F.unhex(F.md5("key")).alias("digest")
    )


def dedup_lines(
    spark: SparkSession, docs: DataFrame, *, min_chars: int = 10, min_docs: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_text)``, one row per row of ``docs``.

    A line whose key has at least ``min_chars`` code points and occurs in at least
    ``min_docs`` documents is dropped everywhere but in the smallest ``doc_id``
    holding it (where each of its occurrences stays). Null and empty texts have
    one empty line. Rows with the same ``doc_id`` are one document for the count.
    A null ``doc_id`` is a document that is never the smallest.
    """
    rows = narrow(docs, id_col, text_col).withColumn("copy", F.unhex(F.md5("text")))
    lines = _lines(rows, min_chars)
    shared = (
        lines.groupBy("digest", "doc_id").agg(F.lit(1).alias("one"))
        .groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))
        .where(F.col("n") >= min_docs).select(F.col("digest").alias("shared"), "first_id")
    )
    # as a table, so that the join below shuffles both sides and a hot line can be split
    shared = written(spark, shared, "shared-lines")
    dropped = (
        lines.join(shared, lines.digest == shared.shared)
        .where(~same(F.col("doc_id"), F.col("first_id")))
        .groupBy("doc_id", "copy").agg(F.collect_set("pos").alias("gone"))
        .select(F.col("doc_id").alias("gone_id"), F.col("copy").alias("gone_copy"), "gone")
    )
    all_lines = F.split("text", "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    return (
        rows.join(dropped, same(F.col("doc_id"), F.col("gone_id")) & (F.col("copy") == F.col("gone_copy")), "left")
        .select("doc_id", "text", "gone", all_lines.alias("lines"))
        .select(
            "doc_id",
            F.size("lines").cast("bigint").alias("n_lines"),
            F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
            F.when(F.col("gone").isNull(), F.col("text"))
            .otherwise(F.array_join(F.transform(stay, lambda i: F.get(F.col("lines"), i)), "\n"))
            .alias("kept_text"),
        )
    )
