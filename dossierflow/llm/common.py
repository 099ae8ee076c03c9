"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierflow.session import new_scratch_path


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` with null texts as empty. Other columns are left behind,
    so extra columns can't clash with names used inside an operator."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared scratch folder: lineage ends there, so
    a lost executor costs a re-read and not a re-run of what came before."""
    path = new_scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = F.md5
) -> DataFrame:
    """``(row, id, copy)``: all columns as one, so that none can clash, and what tells rows
    apart that share an id: the digest of the text (null as empty)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(whole.alias("row"), F.col(f"`{id_col}`").alias("id"), F.unhex(digest(text)).alias("copy"))


def once(rows: DataFrame, stay: DataFrame) -> DataFrame:
    """The ``packed`` rows named by ``stay (stay_id, stay_copy, times)``, unpacked; of those that
    repeat both, ``times`` of them, any one."""
    marked = rows.join(stay, same(rows.id, stay.stay_id) & (rows.copy == stay.stay_copy))
    single = marked.where("times = 1").select("row.*")
    return single.unionByName(marked.where("times > 1").dropDuplicates(["id", "copy"]).select("row.*"))


def keep_one(
    docs: DataFrame, grouped: DataFrame, group: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of ``docs`` for each value of ``group`` in ``grouped (doc_id, copy, group)``: the smallest
    id (nulls last), then the smallest ``copy``. Sums on the map side first."""
    counts = grouped.groupBy(group, "doc_id", "copy").agg(F.count("*").alias("n"))
    lead = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "copy", "n")
    stay = counts.groupBy(group).agg(F.min(lead).alias("lead")).select(
        F.col("lead.doc_id").alias("stay_id"), F.col("lead.copy").alias("stay_copy"), F.col("lead.n").alias("times")
    )
    return once(packed(docs, id_col, text_col), stay)


def same(left: Column, right: Column) -> Column:
    """Equal, nulls included."""
    return left.eqNullSafe(right)


def text_chunks(batches: Iterator[pa.RecordBatch], limit: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each. A longer
    text is a slice of its own: texts are never cut."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        size = pa.compute.binary_length(batch.column(at)).to_numpy(zero_copy_only=False)
        begin, held = 0, 0
        for i, n in enumerate(size):
            if held and held + n > limit:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += int(n)
        if begin < batch.num_rows:
            yield batch.slice(begin)


def buffers(column: pa.Array):
    """Offsets (from 0) and the bytes of a string column without nulls."""
    import numpy as np

    wide = column.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], dtype=np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw
