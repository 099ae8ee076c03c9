"""Runs of repeated words, found online with dyadic catchers of squares.

The words of a chunk of documents are appended to one stream, with a separator
that occurs once after each document, so nothing matches across documents. For
every power of two B, each completed block of B words gets a catcher. While the
words from 2 B to 4 B after the block are appended, its catcher compares the
block with the suffix of B words that ends at the new word: a match at distance
p says that words p apart are equal over that block. Of each size two catchers
are live at any word (three of size 1, which also watch distance 1), and a
square of period p, 2 B <= p < 4 B, holds a whole block of its size in its first
half, so no square escapes. Catchers of consecutive blocks that match at one
distance belong to one stretch of equal words; its two ends are found by halving
steps of less than B. A stretch of at least p words makes a square, and the
whole stretch is the run that all its squares merge into.

The words of a step are appended as arrays: one comparison per word and live
catcher, no loop over words, documents or distances.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierflow.llm.common import narrow, text_chunks

CHUNK_BYTES = 2_000_000
#: Fingerprints are polynomials modulo this prime.
PRIME = (1 << 61) - 1
BASE = 0x1D3C5A96B7F01E25
#: Elements multiplied at once, so that partial products stay in a core's cache.
SLICE = 1 << 14

_U = np.uint64


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _U(PRIME)) + (x >> _U(61))
    return np.where(x >= _U(PRIME), x - _U(PRIME), x)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a * b`` modulo the prime, of numbers below it."""
    a, b = np.broadcast_arrays(a, b)
    out = np.empty(a.shape, dtype=np.uint64)
    low31, low30 = _U((1 << 31) - 1), _U((1 << 30) - 1)
    for at in range(0, len(out), SLICE):
        x, y = a[at : at + SLICE], b[at : at + SLICE]
        xh, xl, yh, yl = x >> _U(31), x & low31, y >> _U(31), y & low31
        mid = xl * yh + xh * yl
        out[at : at + SLICE] = _reduced(
            xh * yh * _U(2) + (mid >> _U(30)) + ((mid & low30) << _U(31)) + xl * yl
        )
    return out


def _minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(a >= b, a - b, a + _U(PRIME) - b)


class Stream:
    """Appended words, and fingerprints of any stretch of them."""

    def __init__(self, ids: np.ndarray):
        n = self.n = len(ids)
        mixed = (ids.astype(np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15)
        mixed ^= mixed >> _U(32)
        mixed *= _U(0xD6E8FEB86659FD93)
        mixed = _reduced(mixed ^ (mixed >> _U(29)))
        self.power = np.ones(n + 1, dtype=np.uint64)
        have = 1
        while have <= n:
            step = pow(BASE, have, PRIME)
            more = min(have, n + 1 - have)
            self.power[have : have + more] = _product(self.power[:more], _U(step))
            have += more
        terms = _product(mixed, self.power[:n])
        high, low = np.cumsum(terms >> _U(32)), np.cumsum(terms & _U(0xFFFFFFFF))
        self.total = np.zeros(n + 1, dtype=np.uint64)
        self.total[1:] = _reduced(_product(_reduced(high), _U(1 << 32)) + _reduced(low))

    def suffixes(self, size: int) -> np.ndarray:
        """Of each word: the fingerprint of the ``size`` words from it on. Where
        fewer are left, numbers above the prime, each once."""
        full = self.n - size + 1
        out = _U(PRIME + 1) + np.arange(-(-self.n // size) * size, dtype=np.uint64)
        out[:full] = _product(_minus(self.total[size:], self.total[:full]), self.power[self.n : size - 1 : -1])
        return out

    def alike(self, i: np.ndarray, j: np.ndarray, size: int) -> np.ndarray:
        """Whether the ``size`` words from ``i`` on equal those from ``j > i`` on."""
        one = _minus(self.total[i + size], self.total[i])
        return _product(one, self.power[j - i]) == _minus(self.total[j + size], self.total[j])

    def reach(self, i: np.ndarray, j: np.ndarray, below: int, step: int) -> np.ndarray:
        """How many words are equal going on from ``i`` and ``j`` (``step`` 1), or back
        from before them (-1); fewer than ``below``, a power of two."""
        far = np.zeros(len(i), dtype=np.int64)
        size = below >> 1
        while size:
            if step > 0:
                a, b = i + far, j + far
                inside = b + size <= self.n
            else:
                a, b = i - far - size, j - far - size
                inside = a >= 0
            at = np.flatnonzero(inside)
            at = at[self.alike(a[at], b[at], size)]
            far[at] += size
            size >>= 1
        return far


def _caught(stream: Stream, size: int, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What the catchers of all blocks of ``size`` words catch that start ``distance``
    blocks or more, but less than one more, before the suffix: stretches ``[begin, end)`` of
    words that equal those ``period`` before."""
    suffix = stream.suffixes(size).reshape(-1, size)
    match = np.zeros((len(suffix) + 2, size), dtype=bool)  # an empty row before and after
    if distance < len(suffix):
        match[distance + 1 : -1] = suffix[distance:] == suffix[:-distance, :1]
    ends = []
    for edge in (match[1:-1] & ~match[:-2], match[1:-1] & ~match[2:]):
        row, column = np.nonzero(edge)
        order = np.lexsort((row, column))
        ends.append((row[order], column[order]))
    (first, column), (last, _) = ends
    return first * size + column, (last + 1) * size + column, distance * size + column


def find_runs(ids: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, period)`` of all runs of at least two periods in the stream
    ``ids``, by start and period; no period is more than ``longest // 2``."""
    none = np.zeros(0, dtype=np.int64)
    found = [(none, none, none)]
    stream = Stream(ids)
    size = 1
    while size == 1 or 2 * size <= longest // 2:
        for distance in (1, 2, 3) if size == 1 else (2, 3):
            begin, end, period = _caught(stream, size, distance)
            near = end - begin + 2 * (size - 1) >= period
            begin, end, period = begin[near], end[near], period[near]
            begin = begin - stream.reach(begin - period, begin, size, -1)
            end = end + stream.reach(end - period, end, size, 1)
            square = end - begin >= period
            begin, end, period = begin[square], end[square], period[square]
            found.append((begin - period, end - begin + period, period))
        size *= 2
    start, length, period = (np.concatenate(part) for part in zip(*found, strict=True))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    # a multiple of a run's period has the same stretch: the smallest period stays
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


RESULT = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, text string"


def _offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)


def _chunk(batch: pa.RecordBatch, min_length: int) -> pa.RecordBatch:
    """Runs of a chunk of documents, and their texts without the repeats."""
    split = pc.ascii_split_whitespace(batch.column("text"))
    words = split.flatten()
    real = pc.greater(pc.binary_length(words), 0)
    text = np.repeat(np.arange(batch.num_rows), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    text, words = text[real.to_numpy(zero_copy_only=False)], words.filter(real)
    n_words = np.bincount(text, minlength=batch.num_rows)
    codes = words.dictionary_encode()
    # a separator of its own after each document
    ids = len(codes.dictionary) + np.arange(len(words) + batch.num_rows, dtype=np.int64)
    place = np.arange(len(words)) + text
    ids[place] = codes.indices.to_numpy()
    start, length, period = find_runs(ids, int(n_words.max(initial=0)))
    long = length >= min_length
    start, length, period = start[long], length[long], period[long]
    repeated = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(repeated, start + period, 1)
    np.add.at(repeated, start + length, -1)
    keep = np.cumsum(repeated)[place] == 0
    head = np.cumsum(n_words + 1) - (n_words + 1)
    owner = np.searchsorted(head, start, "right") - 1
    runs = pa.StructArray.from_arrays(
        [pa.array(start - head[owner]), pa.array(length), pa.array(period)], names=["start", "length", "period"]
    )
    kept = pa.ListArray.from_arrays(
        pa.array(_offsets(np.bincount(text[keep], minlength=batch.num_rows))), words.filter(pa.array(keep))
    )
    return pa.record_batch(
        [
            batch.column("doc_id"), pa.array(n_words, pa.int64()),
            pa.ListArray.from_arrays(pa.array(_offsets(np.bincount(owner, minlength=batch.num_rows))), runs),
            pc.binary_join(kept, " "),
        ],
        names=["doc_id", "n_words", "runs", "text"],
    )


def collapse_runs(
    docs: DataFrame, *, min_length: int = 12, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_words, runs, text)``, one row per row of ``docs``.

    Words are what stands between ASCII white space. ``runs``: ``(start, length, period)``
    of each longest stretch with smallest period ``period`` (words that far apart are
    equal) of at least ``min_length`` words and two periods, by start and period.
    ``text``: the words, joined by one space, without those that a run holds after
    its first period. Stretches are compared by 61-bit fingerprints.

    Null and empty texts have no words, no runs and an empty text. Null ids stay
    null; repeated rows are rows of their own. A text is handled whole by one task,
    with about 100 bytes of memory per word. No rows in, no rows out.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, CHUNK_BYTES):
            yield _chunk(batch, min_length)

    rows = narrow(docs, id_col, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(find, RESULT)
