"""Exact de-duplication against a persistent digest index.

The index is a table with one row per text seen so far, bucketed and sorted by
digest. New documents are reduced to one row per digest before anything moves,
a sort-merge anti-join finds the digests that the index lacks (the index side
needs no shuffle), and only those are appended. Adding a batch again changes
nothing, so a writer that died may simply run again. Every batch adds a file to
each bucket; ``compact`` merges them, and then the merge join sorts nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierflow.llm.common import narrow, once, packed, same, written
from dossierflow.session import new_scratch_path


def digest(text: Column) -> Column:
    """SHA-256 of the text as it is, in UTF-8; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


_STORED_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"


@contextmanager
def _stored_order(spark: SparkSession) -> Iterator[None]:
    """While planning inside, buckets of one file count as sorted, as they were written."""
    before = spark.conf.get(_STORED_ORDER)
    spark.conf.set(_STORED_ORDER, "true")
    try:
        yield
    finally:
        spark.conf.set(_STORED_ORDER, before)


class DigestIndex:
    """``(digest, doc_id)`` at ``path``, one row per known text.

    ``buckets`` is fixed when the index is made and noted beside it; later sessions open
    it with that number, whatever they ask for (a scan by another number would miss
    files). None takes the session's number of shuffle partitions.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        asked = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        layout = f"{path.rstrip('/')}-layout"
        spark.range(1).select(F.lit(asked).alias("buckets")).write.mode("ignore").parquet(layout)
        self.buckets = spark.read.schema("buckets int").parquet(layout).first().buckets
        self.table = "digest_index_" + hashlib.md5(path.encode()).hexdigest()[:16]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, doc_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def _write(self, rows: DataFrame) -> None:
        with _stored_order(self.spark):
            (
                rows.repartition(self.buckets, "digest").write.mode("append").format("parquet")
                .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.table)
            )

    def append(self, groups: DataFrame) -> None:
        """Add the digests that are new. ``groups``: (digest, doc_id), digests unique."""
        fresh = groups.join(self.read().hint("merge"), "digest", "left_anti").select("digest", "doc_id")
        self._write(fresh)

    def compact(self, path: str) -> DigestIndex:
        """The same index at a new ``path``, with one sorted file in each bucket."""
        made = DigestIndex(self.spark, path, self.buckets)
        # as plain files: a scan that knew the buckets would make the shuffle look needless
        made._write(self.spark.read.schema(self.read().schema).parquet(self.path))
        return made

    def forget(self) -> None:
        """Take the table out of the session's catalog; the files stay and may be opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def _groups(rows: DataFrame) -> DataFrame:
    """One row per digest: largest doc_id, rows, how often that doc_id repeats, and the
    first row that has it. Both steps sum on the map side, so a text with any share of
    all rows is cheap."""
    best = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "n", "first_row")
    return (
        rows.groupBy("digest", "doc_id").agg(F.count("*").alias("n"), F.min("row").alias("first_row"))
        .groupBy("digest").agg(F.max(best).alias("best"), F.sum("n").alias("group_size"))
        .select("digest", "best.doc_id", "group_size", F.col("best.n").alias("repeats"), "best.first_row")
    )


def assign(index: DigestIndex, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Enter ``docs`` into the index; one row per document:
    ``(doc_id, keep_id, group_size, repeats, kept, text_sha256)``.

    The row with the largest ``doc_id`` of equal texts stays, unless an earlier
    batch has the text: then that batch's document does (``keep_id``) and no row
    of this batch is kept, but a row with that very id (a batch entered again).
    Null texts count as empty, and empty texts are equal. A null ``doc_id`` stays
    only where its text has no other. Of rows that repeat an id and its text
    one is kept; ``repeats`` counts those of ``keep_id``. No rows in, no rows out.
    """
    spark = index.spark
    rows = written(
        spark,
        narrow(docs, id_col, text_col).select(
            "doc_id", digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row")
        ),
        "digests",
    )
    groups = written(spark, _groups(rows), "digest-groups")
    with _stored_order(spark):
        known = groups.join(
            index.read().hint("merge").select("digest", F.col("doc_id").alias("old_id"), F.lit(True).alias("old")),
            "digest", "left",
        )
        # written before the append: afterwards the index knows all
        decided = written(
            spark,
            known.select(
                F.col("digest").alias("key"),
                F.when(F.col("old"), F.col("old_id")).otherwise(F.col("doc_id")).alias("keep_id"),
                "group_size", "repeats",
                F.when(F.col("old").isNull() | same(F.col("old_id"), F.col("doc_id")), F.col("first_row")).alias("keep_row"),
            ),
            "digest-decided",
        )
    index.append(groups)
    # both sides are shuffled here, so adaptive execution can split a hot digest
    return rows.join(decided, rows.digest == decided.key).select(
        "doc_id", "keep_id", "group_size", "repeats", same(F.col("row"), F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(
    index: DigestIndex, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, one per text."""
    stay = assign(index, docs, id_col, text_col).where("kept").select(
        F.col("doc_id").alias("stay_id"), F.unhex("text_sha256").alias("stay_copy"), F.col("repeats").alias("times")
    )
    return once(packed(docs, id_col, text_col, lambda text: F.sha2(text, 256)), stay)


def new_index(spark: SparkSession, buckets: int | None = None) -> DigestIndex:
    """An empty index in the shared scratch folder."""
    return DigestIndex(spark, new_scratch_path(spark, "digest-index"), buckets)
