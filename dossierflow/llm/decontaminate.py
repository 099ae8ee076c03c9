"""Benchmark decontamination by multi-pattern search with block shifts.

Symbols are words. The patterns are all windows of ``window`` words of the
benchmark items (an item with fewer is one pattern). For patterns of one length,
a table over hashed blocks of words tells how far the search may move on; where
it says 0, the block is the end of some pattern, a bucket of the suffix names
the candidates, and their words are compared one by one. Many places of many
texts are searched in step, so each step is an array operation.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierflow.llm.common import buffers, narrow, packed, same, text_chunks, written
from dossierflow.llm.pretokens import span_hash

CHUNK_BYTES = 2_000_000
#: Words that one lane of the search covers.
LANE = 256


def _fold() -> np.ndarray:
    """Bytes of words, A-Z in lower case; 0 for all others."""
    out = np.zeros(256, dtype=np.uint8)
    for b in range(256):
        if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80:
            out[b] = b
        elif 0x41 <= b <= 0x5A:
            out[b] = b + 32
    return out


FOLD = _fold()


class Words:
    """Words of texts: digests with a 0 between texts, and where their bytes are."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        n, texts = len(raw), len(offsets) - 1
        self.bytes = FOLD[raw]
        part = self.bytes > 0
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.append(False, part[:-1]) if n else part
        starts = np.flatnonzero(part & (~before | edge[:n]))
        after = np.append(part[1:], False) if n else part
        ends = np.flatnonzero(part & (~after | edge[1:])) + 1
        text = np.searchsorted(offsets, starts, "right") - 1
        self.per_text = np.bincount(text, minlength=texts)
        at = np.arange(len(starts)) + text + 1  # a 0 before each text
        total = len(starts) + texts + 1
        self.digest = np.zeros(total, dtype=np.uint64)
        self.start, self.end = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=np.int64)
        self.text = np.full(total, -1)
        if len(starts):
            self.digest[at] = span_hash(self.bytes, starts, ends) | np.uint64(1)
        self.start[at], self.end[at], self.text[at] = starts, ends, text

    def spelled(self, first: int, last: int) -> bytes:
        raw = self.bytes
        return b" ".join(raw[self.start[i] : self.end[i]].tobytes() for i in range(first, last + 1))


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x632BE59BD9B4E019))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Patterns:
    """Shift table and suffix buckets of patterns of one length (in words)."""

    def __init__(self, digests: np.ndarray, spelled: list[bytes]):
        self.m = m = digests.shape[1]
        self.block = block = min(2, m)
        self.bits = max(12, math.ceil(math.log2(len(spelled) * m * 8)))
        self.shift = np.full(1 << self.bits, m - block + 1, dtype=np.int32)
        for j in range(block - 1, m):  # farthest first is not needed: the minimum holds
            key = self._block(digests, j)
            np.minimum.at(self.shift, self._slot(key), m - 1 - j)
        suffix = self._block(digests, m - 1)
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.digests = suffix[order], digests[order]
        self.spelled = [spelled[i] for i in order]
        self.number = order

    def _block(self, digests: np.ndarray, j: int) -> np.ndarray:
        return digests[:, j] if self.block == 1 else _mix(digests[:, j - 1], digests[:, j])

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (_mix(key, key) >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """``(first word, pattern)`` of all occurrences."""
        d, m = words.digest, self.m
        lanes = np.arange(0, len(d), LANE)
        stop = np.minimum(lanes + LANE, len(d))
        at = np.maximum(lanes, m - 1)  # the last word of the window
        found = []
        active = at < stop
        at, stop = at[active], stop[active]
        while len(at):
            key = d[at] if self.block == 1 else _mix(d[at - 1], d[at])
            move = self.shift[self._slot(key)]
            end = at[move == 0]
            if len(end):
                found.append(end)
            at = at + np.maximum(move, 1)
            active = at < stop
            at, stop = at[active], stop[active]
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        end = np.concatenate(found)
        key = d[end] if self.block == 1 else _mix(d[end - 1], d[end])
        low, high = np.searchsorted(self.suffix, key, "left"), np.searchsorted(self.suffix, key, "right")
        many = high - low
        row = np.repeat(np.arange(len(end)), many)
        which = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(len(row))
        first = end[row] - m + 1
        alike = np.ones(len(row), dtype=bool)
        for j in range(m):
            alike &= d[first + j] == self.digests[which, j]
        first, which = first[alike], which[alike]
        # the words themselves decide
        true = [words.spelled(f, f + m - 1) == self.spelled[w] for f, w in zip(first.tolist(), which.tolist(), strict=True)]
        true = np.array(true, dtype=bool)
        return first[true], self.number[which[true]]


class Benchmark:
    """All patterns of a block of items, with the items each occurs in."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        raws = [(t or "").encode("utf-8") for _, t in items]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raws])]).astype(np.int64)
        words = Words(np.frombuffer(b"".join(raws), dtype=np.uint8), offsets)
        head = np.cumsum(words.per_text) - words.per_text + np.arange(len(items)) + 1
        of: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
        where: dict[bytes, int] = {}
        for (item, _), at, n in zip(items, head.tolist(), words.per_text.tolist(), strict=True):
            m = min(n, window)
            for k in range(at, at + n - m + 1) if m else ():
                spelled = words.spelled(k, k + m - 1)
                of[m][spelled].add(item)
                where[spelled] = k
        self.classes = []
        for m, found in sorted(of.items()):
            spelled = list(found)
            digests = np.stack([words.digest[where[s] : where[s] + m] for s in spelled])
            self.classes.append((Patterns(digests, spelled), [sorted(found[s]) for s in spelled]))

    def match(self, raw: np.ndarray, offsets: np.ndarray):
        """Per text: words, hit runs ``[(first, end)]`` in words, names of items."""
        words = Words(raw, offsets)
        texts = len(offsets) - 1
        items: list[set[str]] = [set() for _ in range(texts)]
        edge = np.zeros(len(words.digest) + 1, dtype=np.int64)
        for patterns, names in self.classes:
            first, which = patterns.search(words)
            np.add.at(edge, first, 1)
            np.add.at(edge, first + patterns.m, -1)
            for t, w in {*zip(words.text[first].tolist(), which.tolist(), strict=True)}:
                items[t].update(names[w])
        hit = np.cumsum(edge[:-1]) > 0
        begin = np.flatnonzero(hit & ~np.append(False, hit[:-1]))
        end = np.flatnonzero(hit & ~np.append(hit[1:], False)) + 1
        head = np.cumsum(words.per_text) - words.per_text + np.arange(texts) + 1
        runs: list[list[tuple[int, int]]] = [[] for _ in range(texts)]
        for a, b in zip(begin.tolist(), end.tolist(), strict=True):
            t = int(words.text[a])
            runs[t].append((a - int(head[t]), b - int(head[t])))
        return words.per_text, runs, items


def _merged(runs) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


RESULT = (
    "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
    "runs array<struct<first: bigint, last: bigint>>, items array<string>, copy binary"
)
_RUNS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _table(ids, n_words, runs, items, copies) -> pa.RecordBatch:
    names = [sorted(i) for i in items]
    return pa.record_batch(
        [
            pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()),
            pa.array([sum(b - a for a, b in r) for r in runs], pa.int64()),
            pa.array([len(n) for n in names], pa.int64()),
            pa.array([hashlib.sha256(",".join(n).encode()).hexdigest() for n in names]),
            pa.array([[{"first": a, "last": b} for a, b in r] for r in runs], _RUNS),
            pa.array(names, pa.list_(pa.string())),
            pa.array(copies, pa.binary()),
        ],
        names=[f.split(" ")[0] for f in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "runs", "items", "copy")],
    )


def find_contamination(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, window: int = 10,
    block_bytes: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, runs, items)``, one row per row
    of ``docs``: words in occurrences of benchmark windows, and the items concerned.

    ``benchmark``: ``(item_id, text)``. Its tables go to the tasks in blocks of about
    ``block_bytes`` of text (an item is not cut); built, they take up to a hundred bytes per
    byte of text, so about 100 MB are sent at once, whatever its size; all documents are
    searched for each block. Null texts have no words, on either
    side; a null item id is named ``null``; repeated items count once.
    """
    return _found(spark, docs, benchmark, window, block_bytes, id_col, text_col).drop("copy")


def _found(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int, id_col: str, text_col: str
) -> DataFrame:
    """The rows of ``find_contamination`` with the MD5 of the text, ``copy``."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = narrow(docs, id_col, text_col).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.unhex(F.md5("text")).alias("copy")
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))

    def run(k: int) -> DataFrame:
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        patterns = spark.sparkContext.broadcast(Benchmark([(r.item, r.text) for r in part.collect()], window))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_chunks(batches, CHUNK_BYTES):
                offsets, raw = buffers(batch.column(1))
                n_words, runs, names = patterns.value.match(raw, offsets)
                yield _table(batch.column(0), n_words, runs, names, batch.column(2))

        return rows.mapInArrow(search, RESULT)

    if blocks == 1:
        return run(0)
    passes = [written(spark, run(k), "contamination") for k in range(blocks)]
    together = passes[0]
    for p in passes[1:]:
        together = together.unionByName(p)
    # a pass adds what it found to each (document, text); rows that repeat are set apart again
    grouped = together.groupBy("doc_id", "copy", "n_words").agg(
        F.flatten(F.collect_set("runs")).alias("runs"), F.flatten(F.collect_set("items")).alias("items"),
        (F.count("*") / blocks).cast("int").alias("times"),
    )
    again = grouped.select("doc_id", "copy", "n_words", "runs", "items", F.explode(F.sequence(F.lit(1), "times")))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            runs = [_merged((x["first"], x["last"]) for x in r) for r in b.column(3).to_pylist()]
            yield _table(b.column(0), b.column(2), runs, [set(i) for i in b.column(4).to_pylist()], b.column(1))

    return again.drop("col").mapInArrow(merge, RESULT)


def drop_contaminated(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, window: int = 10,
    block_bytes: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without any benchmark window; all columns are kept. A row goes by
    its own text, also where rows share an id or have none."""
    found = _found(spark, docs, benchmark, window, block_bytes, id_col, text_col).where("n_hit > 0")
    gone = found.select(F.col("doc_id").alias("gone_id"), F.col("copy").alias("gone_copy")).distinct()
    rows = packed(docs, id_col, text_col)
    return rows.join(gone, same(rows.id, gone.gone_id) & (rows.copy == gone.gone_copy), "left_anti").select("row.*")
