"""Shards of near-equal bytes from sampled splitters.

Documents are ordered by (hash of the text, doc_id, row), so copies are neighbours and
no two keys are equal. A size-weighted sample of these keys, bounded by a parameter, gives quantile
boundaries of many small ranges; the exact bytes and rows of each range are then
summed by Spark. Overfull ranges are divided again by samples taken inside
them, until only single documents are larger than a range should be. Those few
are dealt out first, largest to the emptiest shard; then the ranges, in order,
fill each shard up to the mean. Numbers within a shard are a range's offset plus
the row's number in its range, so no task ever sees a whole shard.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossierflow.llm.common import written

Key = tuple[int, int, int]
_KEY = ("h", "k", "o")
_FIELDS = "doc_id bigint, size bigint, text_crc32 bigint, h bigint, k bigint, o bigint"


def _ranges(keys: DataFrame, bounds: list[Key]) -> DataFrame:
    """Add ``r``, the number of boundaries at or below the row's key."""
    heads = np.array([b[0] for b in bounds], dtype=np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("h").to_numpy()
            k, o = batch.column("k").to_numpy(), batch.column("o").to_numpy()
            low = np.searchsorted(heads, h, "left")
            at = np.searchsorted(heads, h, "right")
            for i in np.flatnonzero(low != at):  # boundaries inside one text's group
                at[i] = bisect.bisect_right(bounds, (int(h[i]), int(k[i]), int(o[i])))
            yield batch.append_column("r", pa.array(at, pa.int64()))

    return keys.mapInArrow(place, f"{_FIELDS}, r bigint")


def _boundaries(keys: DataFrame, total: int, pieces: int, oversample: int, draw_no: int) -> list[Key]:
    """Quantiles of a size-weighted sample of about ``pieces * oversample`` keys."""
    if not total:
        return []
    want = pieces * oversample
    # a hash of the key decides, not a random number: a re-run task draws the same rows
    draw = F.pmod(F.xxhash64(*_KEY, F.lit(draw_no)), F.lit(1 << 40)) / float(1 << 40)
    found = sorted(map(tuple, keys.where(draw < F.col("size") * (want / total)).select(*_KEY).collect()))
    step = max(1, len(found) // pieces)
    return found[step::step]


def _sums(placed: DataFrame) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each range: as many rows as ranges, which parameters bound."""
    return {r.r: (r.b, r.n) for r in placed.groupBy("r").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()}


def _plan(sums: dict[int, tuple[int, int]], shards: int, heavy: float) -> list[tuple[int, int, int]]:
    """``(range, shard, rows of the shard before it)``."""
    mean = sum(b for b, _ in sums.values()) / shards
    load, rows, plan = [0.0] * shards, [0] * shards, []

    def put(r: int, at: int) -> None:
        plan.append((r, at, rows[at]))
        load[at] += sums[r][0]
        rows[at] += sums[r][1]

    for r in sorted((r for r in sums if sums[r][0] > heavy), key=lambda r: (-sums[r][0], r)):
        put(r, min(range(shards), key=load.__getitem__))
    at = 0
    for r in sorted(r for r in sums if sums[r][0] <= heavy):
        while at < shards - 1 and load[at] + sums[r][0] / 2 > mean:
            at += 1
        put(r, at)
    return plan


def _keys(rows: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """The keys of ``rows``, which have their number in ``o``."""
    whole = F.coalesce(text, F.lit(""))
    number = doc_id.cast("bigint")
    return rows.select(
        number.alias("doc_id"),
        (F.octet_length(whole) + 1).cast("bigint").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.xxhash64(whole).alias("h"),
        F.coalesce(number, F.lit(-(1 << 63))).alias("k"),
        "o",
    )


def _assigned(spark: SparkSession, keys: DataFrame, shards: int, ranges_per_shard: int, oversample: int) -> DataFrame:
    """``(doc_id, size, text_crc32, o, shard, slot)`` of a table of keys."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    heavy = total / (shards * ranges_per_shard)
    bounds = _boundaries(keys, total, 2 * shards * ranges_per_shard, oversample, 0)
    placed = _ranges(keys, bounds)
    sums = _sums(placed)
    draw_no = 0
    while overfull := {r: b for r, (b, n) in sums.items() if b > heavy and n > 1}:
        draw_no += 1
        size = sum(overfull.values())
        inside = placed.where(F.col("r").isin(sorted(overfull)))
        more = _boundaries(inside, size, 4 * len(overfull) + int(4 * size / heavy), oversample, draw_no)
        if set(more) <= set(bounds):  # nothing drawn: the last row of each becomes a range
            last = inside.groupBy("r").agg(F.max(F.struct(*_KEY)).alias("last")).select("last.*")
            more = list(map(tuple, last.collect()))
        bounds = sorted({*bounds, *more})
        placed = _ranges(keys, bounds)
        sums = _sums(placed)
    # a row per range, so its size is bounded by the parameters
    table = F.broadcast(spark.createDataFrame(_plan(sums, shards, heavy), "r bigint, shard int, before bigint"))
    order = Window.partitionBy("r").orderBy(*_KEY)
    return (
        placed.withColumn("n", F.row_number().over(order)).join(table, "r")
        .select("doc_id", "size", "text_crc32", "o", "shard", (F.col("before") + F.col("n") - 1).alias("slot"))
    )


def shard(
    spark: SparkSession, docs: DataFrame, *, shards: int = 16, ranges_per_shard: int = 64,
    oversample: int = 8, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``, one row per row of ``docs``.

    ``size`` is the UTF-8 bytes of the text plus 1; a null text has none. Shards
    differ from the mean by about one part in ``ranges_per_shard``, or by one
    document where that is larger. Copies lie together where sizes allow it.
    ``slot`` counts from 0 without gaps. Null ids sort first; rows that repeat an
    id and its text are rows of their own and may be parted. No rows in, no rows out.
    """
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.monotonically_increasing_id().alias("o"))
    keys = written(spark, _keys(rows, F.col("i"), F.col("t")), "shard-keys")
    return _assigned(spark, keys, shards, ranges_per_shard, oversample).drop("o")


def write_shards(
    spark: SparkSession, docs: DataFrame, path: str, *, shards: int = 16, ranges_per_shard: int = 64,
    oversample: int = 8, id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Write each row of ``docs`` once, to the folder ``shard=<n>`` of its shard, by the law of
    ``shard``. Rows are numbered in a copy in the scratch folder, so that repeated rows
    and rows without an id are told apart."""
    if "shard" in docs.columns:
        raise ValueError("the column 'shard' names the folders; rename yours")
    numbered = written(
        spark, docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("o")), "numbered"
    )
    keys = written(spark, _keys(numbered, F.col("row")[id_col], F.col("row")[text_col]), "shard-keys")
    where = _assigned(spark, keys, shards, ranges_per_shard, oversample).select(F.col("o").alias("of"), "shard")
    joined = numbered.join(where, numbered.o == where.of).select("row.*", "shard")
    joined.write.partitionBy("shard").parquet(path)
