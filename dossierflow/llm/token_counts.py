"""Token counts by byte-pair merging, without making tokens.

A pre-token is a doubly linked list of symbols. A heap holds its adjacent pairs
by merge rank; the lowest is popped and merged until none is left, and stale
pairs are skipped. The count is the initial symbols minus the merges.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierflow.llm.common import buffers, narrow, text_chunks
from dossierflow.llm.pretokens import byte_chars, cut

#: Bytes of text handled at once, and counts remembered by a worker.
CHUNK_BYTES = 2_000_000
REMEMBERED = 300_000


class Merges:
    """The merge ranks of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.specials = tuple(t["content"] for t in spec["added_tokens"])
        self.symbols = [vocab[c] for c in byte_chars()]
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs[vocab[a], vocab[b]] = (rank, vocab[a + b])

    def count(self, word: str) -> int:
        """Symbols left of one pre-token after all merges."""
        raw = word.encode("utf-8")
        n = len(raw)
        if n == 1:
            return 1
        pairs = self.pairs
        sym = [self.symbols[b] for b in raw]
        right = list(range(1, n + 1))
        left = list(range(-1, n - 1))
        heap = [(*found, i, a, b) for i, (a, b) in enumerate(zip(sym, sym[1:], strict=False)) if (found := pairs.get((a, b)))]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, made, i, a, b = heapq.heappop(heap)
            j = right[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue  # one of the two has merged since
            merges += 1
            sym[i], sym[j] = made, -1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if found := pairs.get((made, sym[k])):
                    heapq.heappush(heap, (*found, i, made, sym[k]))
            h = left[i]
            if h >= 0 and (found := pairs.get((sym[h], made))):
                heapq.heappush(heap, (*found, h, sym[h], made))
        return n - merges


@functools.cache
def _merges(path: str) -> Merges:
    return Merges(path)


def count_tokens(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)``, one row per row of ``docs``.

    ``vocabulary``: path of a byte-level BPE file in the tokenizers library's
    format, at the same place on every machine. No tokens are added; special
    strings in a text count one each. Null and empty texts have 0 tokens.
    Texts are read whole, in a chunk of their own where long.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = _merges(vocabulary)
        known: dict[str, int] = {}
        for batch in text_chunks(batches, CHUNK_BYTES):
            offsets, raw = buffers(batch.column(1))
            found = cut(raw.tobytes(), offsets, merges.specials)
            if len(known) > REMEMBERED:
                known.clear()
            sizes = np.empty(len(found.words), dtype=np.int64)
            for i, word in enumerate(found.words):
                n = known.get(word)
                if n is None:
                    n = known[word] = 1 if found.special[i] else merges.count(word)
                sizes[i] = n
            tokens = np.bincount(found.text, weights=sizes[found.which], minlength=batch.num_rows).astype(np.int64)
            yield pa.record_batch(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(tokens)], names=["doc_id", "n_bytes", "n_tokens"]
            )

    rows = narrow(docs, id_col, text_col).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
