"""SimHash near-duplicates with bit-sliced comparison.

Copies are reduced to distinct fingerprints first. Fingerprints within the
radius agree in some bands of bits; rows that share such bands meet in one
bucket, and a bucket larger than a block is split again by bands of the other
bits. Within buckets, fingerprints are stored as vertical bit planes, 64 to a
machine word. A comparison adds one plane after the other to carry-save
counters, 64 distances at a time, and words in which all 64 exceed the radius
are given up early. A bucket returns a star per cluster, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierflow.llm.common import keep_one, narrow, text_chunks, written
from dossierflow.llm.components import components

BITS = 64
CHUNK_BYTES = 4_000_000
#: Hashes summed, and words compared, at once.
SUM_ROWS, COMPARE_ROWS = 1 << 16, 1 << 18


def fingerprint(text: str, shingle: int = 3) -> int:
    """Bits set in over half of the XXH64 hashes (seed 42) of the word shingles."""
    import xxhash

    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(b" ".join(words), 42)]
    else:
        hashes = [digest(b" ".join(s), 42) for s in zip(*[words[i:] for i in range(shingle)], strict=False)]
    all_hashes = np.array(hashes, dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(all_hashes), SUM_ROWS):
        part = all_hashes[at : at + SUM_ROWS]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(all_hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, copy, fp)``: the MD5 of the text, and the 64 bits as a long. Texts without
    words, null and empty ones included, have 0; texts of up to ``shingle`` words are one shingle."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, CHUNK_BYTES):
            made = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            columns = [batch.column(0), batch.column(2), pa.array(made.view(np.int64))]
            yield pa.record_batch(columns, names=["doc_id", "copy", "fp"])

    rows = narrow(docs, id_col, text_col).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.unhex(F.md5("text")).alias("copy")
    )
    return rows.mapInArrow(make, "doc_id bigint, copy binary, fp bigint")


def _planes(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit planes of groups ``values[begin[g]:begin[g] + size[g]]``, each padded to
    whole words: ``planes[bit, word]`` and each word's mask of real lanes."""
    words = -(-size // 64)
    first = np.cumsum(words) - words
    total = int(words.sum())
    lanes = np.zeros(total * 64, dtype=np.uint64)
    real = np.zeros(total * 64, dtype=bool)
    at = np.repeat(first * 64 - begin, size) + np.arange(len(values))
    lanes[at] = values
    real[at] = True
    planes = np.empty((BITS, total), dtype=np.uint64)
    for bit in range(BITS):
        ones = ((lanes >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        planes[bit] = np.packbits(ones, bitorder="little").view("<u8")
    return planes, np.packbits(real, bitorder="little").view("<u8")


def _within(planes: np.ndarray, word: np.ndarray, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For each (word of 64 lanes, query): which lanes are within ``radius``.
    Returns the numbers of the comparisons left and their lane masks."""
    alive = np.arange(len(word))
    depth = radius.bit_length()
    count = [np.zeros(len(word), dtype=np.uint64) for _ in range(depth)]
    over = np.zeros(len(word), dtype=np.uint64)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)

    def beyond() -> np.ndarray:
        """Lanes whose counter is above the radius (compared from the top bit)."""
        above, equal = over.copy(), ~over
        for bit in reversed(range(depth)):
            if radius >> bit & 1:
                equal &= count[bit]
            else:
                above |= equal & count[bit]
                equal &= ~count[bit]
        return above

    for bit in range(BITS):
        carry = planes[bit][word] ^ (np.uint64(0) - ((query >> np.uint64(bit)) & np.uint64(1)))
        for level in range(depth):  # carry-save: add one bit to every lane's counter
            count[level], carry = count[level] ^ carry, count[level] & carry
        over |= carry
        if bit % 8 == 7:
            keep = beyond() != full
            if not keep.all():
                alive, word, query, over = alive[keep], word[keep], query[keep], over[keep]
                count = [c[keep] for c in count]
                if not len(alive):
                    break
    return alive, ~beyond()


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of ``a[i]`` and ``b[i]``; labels are the smallest members."""
    while True:
        low = np.minimum(label[a], label[b])
        changed = (label[a] != low) | (label[b] != low)
        if not changed.any():
            break
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def linked(values: np.ndarray, begin: np.ndarray, size: np.ndarray, radius: int) -> np.ndarray:
    """For each of ``values``, grouped as given, the place of the first member of its
    cluster within its group."""
    label = np.arange(len(values))
    planes, real = _planes(values, begin, size)
    words = -(-size // 64)
    first = np.cumsum(words) - words
    group = np.repeat(np.arange(len(size)), size)  # of each query
    need = words[group]
    end = np.cumsum(need)
    at = 0
    while at < len(values):
        stop = max(at + 1, int(np.searchsorted(end, (end[at] - need[at]) + COMPARE_ROWS, "right")))
        q = np.repeat(np.arange(at, stop), need[at:stop])
        inner = np.arange(len(q)) - np.repeat(end[at:stop] - need[at:stop] - (end[at] - need[at]), need[at:stop])
        word = first[group[q]] + inner
        alive, lanes = _within(planes, word, values[q], radius)
        lanes = lanes & real[word[alive]]
        bits = np.unpackbits(lanes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, lane = np.nonzero(bits)
        hit = alive[row]
        other = begin[group[q[hit]]] + inner[hit] * 64 + lane
        apart = other != q[hit]
        _merge(label, q[hit][apart], other[apart])
        at = stop
    return label


def _band(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))


def links(spark: SparkSession, distinct: DataFrame, *, radius: int = 2, block: int = 4096) -> DataFrame:
    """``(u, v)``: links between fingerprints (column ``fp``, each once) that connect all
    within ``radius`` bits.

    Bands: ``radius + 2`` of them, so at least two are untouched; a row goes to a
    bucket for each pair of bands. Buckets of more than ``block`` rows go by one
    of ``radius + 1`` bands of their other bits as well.
    """
    n = radius + 2
    cuts = [BITS * i // n for i in range(n + 1)]
    pairs = list(combinations(range(n), 2))
    keys, subs = [], []
    for p, (a, b) in enumerate(pairs):
        low = [_band(F.col("fp"), cuts[i], cuts[i + 1] - cuts[i]) for i in (a, b)]
        keys.append(F.struct(F.lit(p).alias("p"), low[0].alias("a"), low[1].alias("b")))
        rest = [bit for i in range(n) if i not in (a, b) for bit in range(cuts[i], cuts[i + 1])]
        parts = [rest[len(rest) * i // (radius + 1) : len(rest) * (i + 1) // (radius + 1)] for i in range(radius + 1)]
        masks = [sum(1 << bit for bit in part) for part in parts]
        signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
        subs.append(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed]))
    rows = distinct.select("fp", F.explode(F.array(*[
        F.struct(k.alias("k"), s.alias("s")) for k, s in zip(keys, subs, strict=True)
    ])).alias("x")).select("fp", "x.k.p", "x.k.a", "x.k.b", "x.s")
    big = written(
        spark,
        rows.groupBy("p", "a", "b").agg(F.count("*").alias("n")).where(F.col("n") > block)
        .select(F.col("p").alias("bp"), F.col("a").alias("ba"), F.col("b").alias("bb")),
        "big-buckets",
    )
    marked = rows.join(
        big, (rows.p == big.bp) & (rows.a == big.ba) & (rows.b == big.bb), "left"
    ) if big.limit(1).count() else rows.withColumn("bp", F.lit(None).cast("int"))
    split = F.when(F.col("bp").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(F.col("s"))
    bucketed = marked.select("fp", "p", "a", "b", F.posexplode(split).alias("part", "value"))
    order = ["p", "a", "b", "part", "value"]
    sorted_rows = bucketed.repartition(*order).sortWithinPartitions(*order).select("fp", *order)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            both = pa.Table.from_batches(held).combine_chunks()
            columns = [both.column(c).to_numpy() for c in order]
            values = both.column("fp").to_numpy().view(np.uint64)
            new = np.zeros(len(values), dtype=bool)
            new[:1] = True
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, len(values)))
            pick = np.repeat(size > 1, size)
            values, size = values[pick], size[size > 1]
            label = linked(values, np.cumsum(size) - size, size, radius)
            other = np.flatnonzero(label != np.arange(len(label)))
            u, v = values[other].view(np.int64), values[label[other]].view(np.int64)
            return pa.record_batch([pa.array(u), pa.array(v)], names=["u", "v"])

        held: list[pa.RecordBatch] = []  # rows of whole buckets, and the beginning of the last
        rows_held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if held and rows_held >= block:
                last = [held[-1].column(c)[-1] for c in order]
                n = 0
                while n < batch.num_rows and all(batch.column(c)[n] == x for c, x in zip(order, last, strict=True)):
                    n += 1
                if n < batch.num_rows:
                    yield stars([*held, batch.slice(0, n)])
                    held, rows_held, batch = [], 0, batch.slice(n)
            held.append(batch)
            rows_held += batch.num_rows
        if held:
            yield stars(held)

    return sorted_rows.mapInArrow(compare, "u bigint, v bigint")


def _rooted(spark: SparkSession, docs: DataFrame, shingle: int, radius: int, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, copy, fp, root, component_id)`` per row; ``root`` names the component even
    where it has no id."""
    marked = written(spark, fingerprints(docs, shingle=shingle, id_col=id_col, text_col=text_col), "fingerprints")
    distinct = written(spark, marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(spark, links(spark, distinct.select("fp"), radius=radius))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # a table, so that the join below shuffles both sides and a hot fingerprint can be split
    named = written(
        spark, rooted.join(smallest, "root").select(F.col("fp").alias("key"), "root", "component_id"), "components"
    )
    return marked.join(named, marked.fp == named.key).select("doc_id", "copy", "fp", "root", "component_id")


def near_duplicates(
    spark: SparkSession, docs: DataFrame, *, shingle: int = 3, radius: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``docs``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest ``doc_id`` reachable over links, the document's
    own included. Texts without words have fingerprint 0 and are linked like any
    other. Null ids are never the smallest; repeated rows share a component.
    """
    return _rooted(spark, docs, shingle, radius, id_col, text_col).select("doc_id", "fp", "component_id")


def drop_near_duplicates(
    spark: SparkSession, docs: DataFrame, *, shingle: int = 3, radius: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row of ``docs`` of each component, with all its columns: that with the smallest
    id. Of rows that share it the one whose text has the smallest MD5 stays, of rows
    that repeat both any one; null ids stay only where the component has no other."""
    return keep_one(
        docs, _rooted(spark, docs, shingle, radius, id_col, text_col), "root", id_col=id_col, text_col=text_col
    )
