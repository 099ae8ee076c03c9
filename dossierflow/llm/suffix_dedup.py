"""Repeated substrings by a suffix array built block by block.

A suffix array of a whole corpus sorts every position. Here only positions that
can repeat are sorted, and only near others they can equal:

1. Every string of ``length`` bytes has an anchor, the place of its smallest
   rolling digest of ``GRAM`` bytes. Equal strings have equal anchors at the same
   distance, so an anchor whose digest occurs once settles all its strings.
2. For anchors that occur again, the segment of text around each (its strings'
   bytes, about 1.3 times ``length``) goes to the tasks by the anchor's digest.
3. A task builds the suffix array of its segments one block at a time. Ranks of a
   difference-cover sample are computed first. The suffixes of a bucket (same
   anchor, same distance) are then sorted by their first bytes, and longer ties
   by the ranks of the two sample suffixes at the cover's common offset, so no
   comparison looks further. All buckets of a block are sorted in step.
   Neighbours in that order share ``length`` bytes or nobody does.
4. ``share`` bounds what one task sorts for an anchor. The segments of an anchor that
   occurs more often are dealt by a hash of their place into shares of about that
   size, each sorted as above. A string that repeats within its share is settled there.
   Every share also sends a digest of each different string it has, once, so that
   strings alone in theirs are settled by counting the shares that have them.

Texts move twice: once into a table bucketed by row, once as segments. What comes
back is intervals of byte positions per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierflow.llm.common import buffers, narrow, text_chunks, written
from dossierflow.llm.pretokens import powers
from dossierflow.session import new_scratch_path

#: Bytes of text handled at once, so few that the arrays over them stay in a core's cache.
CHUNK_BYTES = 200_000
GRAM = 64
#: Bytes of segments sorted at once, and the cover's period (a square).
BLOCK_BYTES, PERIOD = 200_000, 64
_BASE = 0xD1342543DE82EF95


def cover(period: int) -> np.ndarray:
    """A difference cover of the residues: 0..r-1 and the multiples of r, r * r = period."""
    r = int(period**0.5)
    inside = np.zeros(period, dtype=bool)
    inside[:r] = inside[::r] = True
    return inside


COVER = cover(PERIOD)


def _common(inside: np.ndarray) -> np.ndarray:
    """``offset[a, b]``: how far residues a and b move on until both are in the cover."""
    n = len(inside)
    offset = np.full((n, n), -1, dtype=np.int64)
    residue = np.arange(n)
    for d in reversed(range(n)):
        moved = inside[(residue + d) % n]
        offset[np.ix_(moved, moved)] = d
    return offset


OFFSET = _common(COVER)


def _digests(raw: np.ndarray, length: int) -> np.ndarray:
    """Digest of the ``length`` bytes from each position on (none for the last ones)."""
    n = len(raw)
    if n < length:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n + 1, dtype=np.uint64)
    value = (raw.astype(np.uint64) + np.uint64(0x51ED27)) * np.uint64(0x9FB21C651E98DF25)
    value ^= value >> np.uint64(28)
    np.cumsum(value * powers(n, _BASE), out=total[1:])
    out = (total[length:] - total[:-length]) * powers(n, pow(_BASE, -1, 1 << 64))[: n - length + 1]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int):
    """Runs of strings with one anchor: ``(text, first, last, anchor, digest)``, places
    counted in the whole buffer. ``first`` to ``last`` are the strings' starts."""
    none = np.zeros(0, dtype=np.int64)
    digest = _digests(raw, GRAM)
    width = length - GRAM + 1
    n = len(digest)
    if n < width:
        return none, none, none, none, np.zeros(0, dtype=np.uint64)
    low = np.uint64((1 << 32) - 1)
    key = (digest & ~low) | np.arange(n, dtype=np.uint64)  # the first of equal ones
    pad = -n % width
    padded = np.append(key, np.full(pad, np.uint64(0xFFFFFFFFFFFFFFFF))).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - width + 1
    place = (np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts]) & low).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:starts]
    inside = np.arange(starts) + length <= offsets[text + 1]
    change = np.ones(starts, dtype=bool)
    change[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(change & inside)
    ended = np.ones(starts, dtype=bool)
    ended[:-1] = change[1:] | ~inside[1:]
    last = np.flatnonzero(ended & inside)
    return text[first], first, last, place[first], digest[place[first]]


class SuffixBlock:
    """Sorted suffixes of a block of text; ties are resolved for ``length`` bytes."""

    def __init__(self, text: bytes, length: int):
        self.size = len(text)
        depth = PERIOD
        while depth < length:
            depth *= 2
        padded = text + bytes(2 * depth)
        self.word = np.ndarray((len(padded) - 8,), dtype=">u8", buffer=padded, strides=(1,))
        sample = np.flatnonzero(COVER[np.arange(self.size) % PERIOD])
        self.rank = np.zeros(self.size + 2 * depth, dtype=np.int64)  # 0: past the end
        columns = [self.word[sample + 8 * j].astype(np.uint64) for j in reversed(range(PERIOD // 8))]
        order = np.lexsort(columns)
        fresh = np.zeros(len(order), dtype=bool)
        for c in columns:
            fresh[1:] |= c[order][1:] != c[order][:-1]
        self.rank[sample[order]] = np.cumsum(fresh) + 1
        step = PERIOD
        while step < depth:  # both halves start in the sample
            pair = self.rank[sample] * (self.size + 2) + self.rank[sample + step]
            self.rank[sample] = np.unique(pair, return_inverse=True)[1] + 1
            step *= 2

    def compare(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """-1, 0 or 1: first bytes, then the ranks at the cover's common offset."""
        out = np.zeros(len(p), dtype=np.int8)
        tied = np.arange(len(p))
        for j in range(PERIOD // 8):
            a, b = self.word[p[tied] + 8 * j], self.word[q[tied] + 8 * j]
            out[tied] = (a > b).astype(np.int8) - (a < b)
            tied = tied[a == b]
            if not len(tied):
                return out
        at = OFFSET[p[tied] % PERIOD, q[tied] % PERIOD]
        a, b = self.rank[p[tied] + at], self.rank[q[tied] + at]
        out[tied] = (a > b).astype(np.int8) - (a < b)
        return out

    def sort(self, start: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Places of ``start`` (rows sorted by ``bucket``) in order within their buckets:
        a three-way quicksort of all buckets in step."""
        order = np.arange(len(start))
        slots, group = order, bucket
        while len(slots):
            head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            size = np.diff(np.append(head, len(group)))
            many = np.repeat(size > 1, size)
            slots, group, size = slots[many], group[many], size[size > 1]
            if not len(slots):
                break
            head = np.cumsum(size) - size
            mine = order[slots]
            pivot = np.repeat(mine[head + size // 2], size)
            side = self.compare(start[mine], start[pivot])
            group = np.repeat(np.arange(len(size)), size) * 3 + side + 1
            move = np.argsort(group, kind="stable")
            order[slots] = mine[move]
            group = group[move]
            unsettled = group % 3 != 1
            slots, group = slots[unsettled], group[unsettled]
        return order

    def alike(self, p: np.ndarray, q: np.ndarray, length: int) -> np.ndarray:
        """Do the two suffixes share ``length`` bytes?"""
        tied = np.arange(len(p))
        # the last word may overlap the one before
        for at in [*range(0, length - 7, 8), length - 8]:
            tied = tied[self.word[p[tied] + at] == self.word[q[tied] + at]]
        out = np.zeros(len(p), dtype=bool)
        out[tied] = True
        return out


def repeated(
    segments: list[bytes], before: np.ndarray, bucket: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each string of the segments, in order: its segment, its place there, whether
    it occurs in another segment of its bucket, and whether it is the first of its
    equals. ``before``: bytes before the anchor; segments are distinct."""
    sizes = np.array([len(s) for s in segments], dtype=np.int64)
    base = np.cumsum(sizes) - sizes
    strings = sizes - length + 1
    which = np.repeat(np.arange(len(segments)), strings)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(strings) - strings, strings)
    start = base[which] + inner
    # same anchor, same distance to it
    key = bucket[which] * (4 * length) + (before[which] - inner) + length
    by = np.argsort(key, kind="stable")
    block = SuffixBlock(b"".join(segments), length)
    order = by[block.sort(start[by], key[by])]
    a, b = order[:-1], order[1:]
    pair = np.flatnonzero(key[a] == key[b])
    pair = pair[block.alike(start[a[pair]], start[b[pair]], length)]
    found = np.zeros(len(which), dtype=bool)
    found[a[pair]] = found[b[pair]] = True
    leads = np.ones(len(which), dtype=bool)
    leads[b[pair]] = False
    return which, inner, found, leads


_SEGMENT = "digest bigint, shares bigint, before bigint, row bigint, first bigint, segment binary"
_RUN = "row bigint, first bigint, last bigint"
#: A run, or the digest of a string that its share has; the place only if it is alone there.
_SETTLED = f"{_RUN}, string binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.record_batch(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
    )


def remove_repeats(
    spark: SparkSession, docs: DataFrame, *, length: int = 200, share: int = 2_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)``, one row per row of ``docs``.

    Bytes covered by a string of ``length`` bytes that starts anywhere else too are
    removed; ``kept`` holds the others (binary: a cut may fall inside a
    character). Repeats within a text count, overlapping ones too, and strings are
    judged on the input. Strings never cross texts. Null texts are empty; texts
    shorter than ``length`` stay whole; repeated rows repeat each other's text.
    """
    if length < GRAM + 8:
        raise ValueError(f"length must be at least {GRAM + 8}")
    path = new_scratch_path(spark, "texts")
    name = "texts_" + hashlib.md5(path.encode()).hexdigest()[:16]
    rows = narrow(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        rows.repartition(parts, "row").write.format("parquet").option("compression", "zstd").option("path", path)
        .bucketBy(parts, "row").sortBy("row").saveAsTable(name)
    )
    texts = spark.table(name)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, CHUNK_BYTES):
            offsets, raw = buffers(batch.column(1))
            text, _, _, _, digest = anchors(raw, offsets, length)
            at = batch.column(0).to_numpy()[text]
            yield pa.record_batch([pa.array(at), pa.array(digest.view(np.int64))], names=["row", "digest"])

    found = texts.select("row", "text").mapInArrow(find, "row bigint, digest bigint")
    again = written(
        spark,
        found.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")
        .select(F.col("digest").alias("key"), F.ceil(F.col("n") / share).alias("shares")),
        "anchors",
    )
    tied = (
        found.join(again, found.digest == again.key)
        .groupBy("row").agg(F.collect_set(F.struct("digest", "shares")).alias("tied"))
        .select(F.col("row").alias("of"), "tied")
    )

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, CHUNK_BYTES):
            offsets, raw = buffers(batch.column(1))
            data, number = raw.tobytes(), batch.column(0).to_pylist()
            known = [{t["digest"]: t["shares"] for t in tied} for tied in batch.column(2).to_pylist()]
            out = []
            text, first, last, place, digest = anchors(raw, offsets, length)
            columns = (text, first, last, place, digest.view(np.int64))
            for t, a, b, p, d in zip(*[c.tolist() for c in columns], strict=True):
                if (shares := known[t].get(d)) is not None:
                    out.append((d, shares, p - a, number[t], a - int(offsets[t]), data[a : b + length]))
            yield _batch(out, _SEGMENT)

    segments = written(
        spark,
        texts.join(tied, texts.row == tied.of).select("row", "text", "tied").mapInArrow(segment, _SEGMENT),
        "segments",
    )

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], dict[tuple[int, bytes], list[tuple[int, int]]]] = {}
        size, current = 0, None

        def block() -> pa.RecordBatch:
            out, distinct, members, split = [], [], [], []
            for g, ((_, shares, _), of) in enumerate(held.items()):
                for (before, text), where in of.items():
                    if len(where) > 1:  # copies repeat each other throughout
                        out += [(row, first, first + len(text) - length, None) for row, first in where]
                    distinct.append((g, before, text))
                    members.append(where)
                    split.append(shares > 1)
            lone = np.array([len(m) == 1 for m in members], dtype=bool)
            dealt = np.array(split, dtype=bool)
            if not (lone | dealt).any():
                return _batch(out, _SETTLED)
            which, inner, found, leads = repeated(
                [d[2] for d in distinct], np.array([d[1] for d in distinct]), np.array([d[0] for d in distinct]), length
            )
            row = np.array([m[0][0] for m in members], dtype=np.int64)
            first = np.array([m[0][1] for m in members], dtype=np.int64)
            flags = found & lone[which]
            new = np.append(True, which[1:] != which[:-1])
            begin = np.flatnonzero(flags & (new | ~np.append(False, flags[:-1])))
            end = np.flatnonzero(flags & (np.append(new[1:], True) | ~np.append(flags[1:], False)))
            of_run = which[begin]
            out += [
                (r, a, b, None) for r, a, b in zip(
                    row[of_run].tolist(), (first[of_run] + inner[begin]).tolist(), (first[of_run] + inner[end]).tolist(),
                    strict=True,
                )
            ]
            alone = ~found & lone[which]
            for j in np.flatnonzero(leads & dealt[which]).tolist():
                i, at = int(which[j]), int(inner[j])
                string = hashlib.md5(distinct[i][2][at : at + length]).digest()
                place = int(first[i]) + at
                out.append((int(row[i]), place, place, string) if alone[j] else (None, None, None, string))
            return _batch(out, _SETTLED)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("digest", "shares", "part", "before", "row", "first", "segment")]
            for digest, shares, part, before, row, first, text in zip(*columns, strict=True):
                if (key := (digest, shares, part)) != current:
                    if size > BLOCK_BYTES:
                        yield block()
                        held, size = {}, 0
                    current = key
                where = held.setdefault(key, {}).setdefault((before, text), [])
                size += 16 if where else len(text)
                where.append((row, first))
        if held:
            yield block()

    dealt = segments.withColumn("part", F.pmod(F.xxhash64("row", "first"), F.col("shares")))
    dealt = dealt.repartition("digest", "part").sortWithinPartitions("digest", "part")
    settled = written(
        spark,
        dealt.select("digest", "shares", "part", "before", "row", "first", "segment").mapInArrow(settle, _SETTLED),
        "settled",
    )
    runs = settled.where("string IS NULL").drop("string")
    sent = settled.where("string IS NOT NULL")
    apart = (
        sent.groupBy("string").agg(F.count("*").alias("shares"), F.count("row").alias("alone"))
        .where("shares > 1 AND alone > 0").select(F.col("string").alias("key"))
    )
    alone = sent.where("row IS NOT NULL")
    more = alone.join(apart, alone.string == apart.key).select("row", "first", "last")
    spans = (
        runs.unionByName(more).groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
        .select(F.col("row").alias("of"), "runs")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, CHUNK_BYTES):
            out = []
            columns = [c.to_pylist() for c in batch.columns]
            for doc, text, found in zip(*columns, strict=True):
                raw, kept, removed, n, end = text.encode("utf-8"), [], 0, 0, 0
                for r in sorted(found or (), key=lambda r: r["first"]):
                    a, b = r["first"], r["last"] + length
                    if a > end or not n:
                        kept.append(raw[end:a])
                        n += 1
                        removed += b - a
                        end = b
                    elif b > end:
                        removed += b - end
                        end = b
                kept.append(raw[end:])
                out.append((doc, len(raw), removed, n, b"".join(kept)))
            yield _batch(out, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")

    whole = texts.join(spans, texts.row == spans.of, "left").select(F.col("doc_id").cast("bigint"), "text", "runs")
    return whole.mapInArrow(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
