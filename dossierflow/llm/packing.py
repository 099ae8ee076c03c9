"""Bounded-space online packing of token sequences.

Each task keeps a fixed number of open windows. A document's ids fill whole
windows first; the rest goes where it fits best. When it fits nowhere, the
fullest window takes as much of it as it has room for (documents may be cut)
and is emitted full. The windows still open at a task's end, a bounded number
each, are laid end to end by one merging task per group of tasks.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierflow.llm.common import buffers, narrow, text_chunks, written
from dossierflow.llm.pretokens import byte_chars, cut

#: Bytes of text handled at once, and pre-tokens remembered by a task.
CHUNK_BYTES = 2_000_000
REMEMBERED = 400_000
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids binary, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, task bigint"
)
#: Sequence numbers of a task: its number times this, plus its own count.
PER_TASK = 1 << 40


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_padding()
    made.no_truncation()
    return made


class Encoder:
    """Ids of texts by the tokenizer file, a pre-token at a time. Those already
    met are remembered, up to a bound."""

    def __init__(self, path: str):
        tokenizer = _tokenizer(path)
        self.model = tokenizer.model
        self.specials = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.chars = dict(enumerate(byte_chars()))
        self.known: dict[str, bytes] = {}

    def _encode(self, word: str, special: bool) -> bytes:
        if special:
            return np.uint32(self.specials[word]).tobytes()
        found = self.model.tokenize(word.encode("utf-8").decode("latin-1").translate(self.chars))
        return np.array([t.id for t in found], dtype=np.uint32).tobytes()

    def ids(self, data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the count of each text."""
        found = cut(data, offsets, tuple(self.specials))
        if len(self.known) > REMEMBERED:
            self.known.clear()
        made = []
        for word, special in zip(found.words, found.special.tolist(), strict=True):
            ids = self.known.get(word)
            if ids is None:
                ids = self.known[word] = self._encode(word, special)
            made.append(ids)
        sizes = np.fromiter(map(len, made), dtype=np.int64, count=len(made)) >> 2
        flat = np.frombuffer(b"".join(made), dtype=np.uint32)
        begin = np.cumsum(sizes) - sizes
        each = sizes[found.which]
        total = int(each.sum())
        # ranges begin[w] .. begin[w] + size[w] of all occurrences, concatenated
        index = np.arange(total) + np.repeat(begin[found.which] - (np.cumsum(each) - each), each)
        return flat[index], np.bincount(found.text, weights=each, minlength=len(offsets) - 1).astype(np.int64)


class Windows:
    """The open windows of one task, and rows of pieces that are done."""

    def __init__(self, task: int, size: int, count: int, keep_ids: bool):
        self.base, self.task = task * PER_TASK, task
        self.size, self.count, self.keep_ids = size, count, keep_ids
        self.open: list[list] = []  # [room, pieces]
        self.made = 0
        self.rows: list[tuple] = []

    def _emit(self, pieces: list[tuple], leftover: bool = False) -> None:
        offset, number = 0, self.base + self.made
        self.made += 1
        for doc, start, ids, total in pieces:
            raw = ids.tobytes()
            self.rows.append((
                doc, start, len(ids), raw if leftover or self.keep_ids else None, zlib.crc32(raw), total, number,
                offset, self.task if leftover else None,
            ))
            offset += len(ids)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.size:
            self._emit([(doc, start, ids[start : start + self.size], total)])
            start += self.size
        need = total - start
        if not need:
            return
        fits = [w for w in self.open if w[0] >= need]
        if fits:
            best = min(fits, key=lambda w: w[0])
        elif len(self.open) < self.count:
            best = [self.size, []]
            self.open.append(best)
        else:
            fullest = min(self.open, key=lambda w: w[0])
            fullest[1].append((doc, start, ids[start : start + fullest[0]], total))
            self._emit(fullest[1])
            start += fullest[0]
            fullest[:] = [self.size, []]
            best, need = fullest, total - start
        best[1].append((doc, start, ids[start:], total))
        best[0] -= need
        if not best[0]:
            self._emit(best[1])
            self.open = [w for w in self.open if w is not best]

    def finish(self) -> None:
        for _, pieces in self.open:
            self._emit(pieces, leftover=True)
        self.open = []

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 9
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5]
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def pack(
    spark: SparkSession, docs: DataFrame, vocabulary: str, *, size: int = 1024, windows: int = 16,
    merge_tasks: int = 64, end_id: int = 0, keep_ids: bool = True, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of documents: ``(doc_id, start, length, ids, ids_crc32, doc_tokens,
    sequence_id, offset)``.

    A document's ids are those of the tokenizer file ``vocabulary``, without added
    special tokens, then ``end_id``; so null and empty texts have one id. ``ids``
    holds little-endian unsigned 32-bit numbers, or null without ``keep_ids``. A
    sequence is full but for the last of each merging task, which takes the open
    windows (``windows`` each) of ``merge_tasks`` tasks. Repeated rows are packed
    as rows of their own; null ids stay null. No rows in, no rows out.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = Encoder(vocabulary)
        held = Windows(TaskContext.get().partitionId(), size, windows, keep_ids)
        for batch in text_chunks(batches, CHUNK_BYTES):
            offsets, raw = buffers(batch.column(1))
            ids, counts = encoder.ids(raw.tobytes(), offsets)
            end = np.cumsum(counts)
            for doc, a, b in zip(batch.column(0).to_pylist(), (end - counts).tolist(), end.tolist(), strict=True):
                held.add(doc, np.append(ids[a:b], np.uint32(end_id)))
            yield held.take()
        held.finish()
        yield held.take()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces one after the other; a sequence ends where ``size`` is reached."""
        held, room, group = [], size, None
        out: Windows | None = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["group"] != group:
                    if held:
                        out._emit(held)
                    held, room, group = [], size, row["group"]
                    # numbers that no first-pass task can have
                    done, out = out, Windows(-1 - group, size, 1, keep_ids)
                    if done is not None:
                        yield done.take()
                ids, start = np.frombuffer(row["ids"], dtype=np.uint32), row["start"]
                while len(ids):
                    held.append((row["doc_id"], start, ids[:room], row["doc_tokens"]))
                    start, ids, room = start + len(held[-1][2]), ids[room:], room - len(held[-1][2])
                    if not room:
                        out._emit(held)
                        held, room = [], size
            if out is not None:
                yield out.take()
        if held:
            out._emit(held)
            yield out.take()

    rows = narrow(docs, id_col, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    first = written(spark, rows.mapInArrow(place, SCHEMA), "packed")
    left = (
        first.where("task IS NOT NULL").withColumn("group", F.expr(f"task DIV {merge_tasks}"))
        .repartition("group").sortWithinPartitions("group", "sequence_id", "offset")
    )
    merged = left.mapInArrow(merge, SCHEMA)
    return first.where("task IS NULL").unionByName(merged).drop("task")
