"""Phrases whose words keep company, counted in a prefix-free parse of the corpus.

A piece of text is cut into chunks wherever the next words (one fewer than a
phrase may have) hash to a trigger, and a chunk runs on over the trigger words
that begin the next. Equal passages are cut alike wherever they stand, so the
corpus becomes a dictionary of distinct chunks with the number of times each was
parsed. A chunk owns the words before its last trigger (the last of a piece owns
all of its words), and counts the phrases that begin at words it owns, times its
frequency: every occurrence is counted once, and none is cut off.

A phrase is no more frequent than its parts. So passes over the dictionary first sum
hashes: of words and pairs, then of longer phrases whose parts may be frequent;
what may be is marked in a bit table of fixed size. The last pass counts the
phrases themselves, whole, where all their parts are marked. Hashes only spare work,
so the counts are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dossierflow.llm.common import buffers, text_chunks, written
from dossierflow.llm.pretokens import span_hash

#: Bytes of text, and of chunks, handled at once.
TEXT_BYTES, CHUNK_BYTES = 2_000_000, 1_000_000
NO_LANG = "und"
#: Bits of the hashes that are summed.
KEY_BITS = 48
#: What ends a piece.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
SPACE, END = 0x20, 0x0A


def _folded() -> np.ndarray:
    """Bytes in lower case (A-Z), with one blank and one end of pieces."""
    out = np.arange(256, dtype=np.uint8)
    out[0x41:0x5B] += 0x20
    out[0x09] = SPACE
    out[list(PIECE_ENDS)] = END
    return out


FOLDED = _folded()


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x632BE59BD9B4E019))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _cut(raw: np.ndarray, offsets: np.ndarray, ahead: int, spacing: int):
    """Chunks of texts: ``(text, bytes, owned words)`` of each."""
    low = FOLDED[raw]
    inside = (low != SPACE) & (low != END)
    edge = np.zeros(len(low) + 1, dtype=bool)
    edge[offsets] = True
    before, after = np.append(False, inside[:-1]), np.append(inside[1:], False)
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    size = np.flatnonzero(inside & (~after | edge[1:])) + 1 - start
    n = len(start)
    if not n:
        return np.zeros(0, dtype=np.int64), [], start
    text = np.searchsorted(offsets, start, "right") - 1
    piece = np.cumsum(low == END)[start]
    opens = np.append(True, (piece[1:] != piece[:-1]) | (text[1:] != text[:-1]))
    first = np.flatnonzero(opens)
    last = np.append(first[1:], n)  # the end of each piece
    ends = np.repeat(last, last - first)
    # words from here on decide whether a chunk begins here
    word = span_hash(low, start, start + size)
    seen = word.copy()
    for k in range(1, ahead):
        seen[:-k] = _mixed(seen[:-k], word[k:])
    trigger = (seen % np.uint64(spacing) == 0) & (np.arange(n) + ahead <= ends)
    begin = np.flatnonzero(opens | trigger)
    next_begin = np.append(begin[1:], n)
    final = next_begin >= ends[begin]
    stop = np.where(final, ends[begin], next_begin + ahead)
    # the words once more, one blank after each
    place = np.cumsum(size + 1) - (size + 1)
    index = np.arange(place[-1] + size[-1] + 1) + np.repeat(start - place, size + 1)
    plain = low[np.minimum(index, len(low) - 1)]
    plain[place + size] = SPACE
    plain = plain.tobytes()
    a, b = place[begin].tolist(), (place[stop - 1] + size[stop - 1]).tolist()
    return text[begin], [plain[i:j] for i, j in zip(a, b, strict=True)], next_begin - begin


def parse(docs: DataFrame, *, ahead: int = 3, spacing: int = 16, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The dictionary of chunks: ``(lang, chunk, owned, weight)``. ``ahead``: words of a trigger;
    one word in ``spacing``, about, begins one. Null texts have no chunks; a null
    language is ``und``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, TEXT_BYTES):
            offsets, raw = buffers(batch.column("text"))
            text, chunks, owned = _cut(raw, offsets, ahead, spacing)
            yield pa.record_batch(
                [
                    batch.column("lang").take(pa.array(text)),
                    pa.array(chunks, pa.binary()).cast(pa.string()),
                    pa.array(owned, pa.int64()),
                ],
                names=["lang", "chunk", "owned"],
            )

    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    chunks = rows.mapInArrow(cut, "lang string, chunk string, owned bigint")
    return chunks.groupBy("lang", "chunk", "owned").agg(F.count("*").alias("weight"))


class _Words:
    """Words of a batch of the dictionary. ``grams(m)[i]`` hashes the language and the ``m``
    words from ``i`` on; ``left[i]`` words are left in the chunk."""

    def __init__(self, batch: pa.RecordBatch):
        offsets, self.raw = buffers(batch.column("chunk"))
        blank = np.flatnonzero(self.raw == SPACE)
        # chunks are not empty, so their beginnings and those after blanks are all different
        self.start = np.sort(np.concatenate([offsets[:-1], blank + 1]))
        self.end = np.sort(np.concatenate([blank, offsets[1:]]))
        n_words = np.diff(np.searchsorted(self.start, offsets, "left"))
        self.chunk = np.repeat(np.arange(batch.num_rows), n_words)
        stop = np.repeat(np.cumsum(n_words), n_words)
        number = np.arange(len(self.start))
        self.left = stop - number
        owned = batch.column("owned").to_numpy()
        self.owned = number - (stop - n_words[self.chunk]) < owned[self.chunk]
        self.weight = batch.column("weight").to_numpy()[self.chunk]
        langs = batch.column("lang").dictionary_encode()
        seeds = np.array([xxhash.xxh64_intdigest(v.encode(), 1) for v in langs.dictionary.to_pylist()], dtype=np.uint64)
        self.word = _mixed(span_hash(self.raw, self.start, self.end), seeds[langs.indices.to_numpy()][self.chunk])

    def grams(self, m: int) -> np.ndarray:
        made = self.word.copy()
        for k in range(1, m):
            made[:-k] = _mixed(made[:-k], self.word[k:])
        return made

    def marked(self, m: int, table: np.ndarray, bits: int) -> np.ndarray:
        """Whether the ``m`` words from each word on are marked."""
        spot = self.grams(m) >> np.uint64(64 - bits)
        return (table[spot >> np.uint64(6)] >> (spot & np.uint64(63)) & np.uint64(1)).astype(bool) & (self.left >= m)

    def parts_marked(self, m: int, table: np.ndarray, bits: int) -> np.ndarray:
        """Whether the ``m`` words are in the chunk and both phrases of one word fewer are marked."""
        good = self.marked(m - 1, table, bits)
        return good & np.append(good[1:], False) & (self.left >= m)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[new], np.add.reduceat(weights, new) if len(new) else weights


def _mark(
    spark: SparkSession, dictionary: DataFrame, sizes: tuple[int, ...], table: np.ndarray | None, min_count: int, bits: int
) -> np.ndarray:
    """A table of ``2 ** bits`` bits, with those set of the phrases of the given sizes whose hashes
    occur ``min_count`` times; ``table`` has the marks of shorter ones, which phrases of more than
    two words must have. At most a row for each 64 bits reaches the driver."""
    sent = spark.sparkContext.broadcast(table)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, CHUNK_BYTES, "chunk"):
            w = _Words(batch)
            keys, weights = [], []
            for m in sizes:
                pick = w.owned & (w.parts_marked(m, sent.value, bits) if m > 2 else w.left >= m)
                keys.append(w.grams(m)[pick])
                weights.append(w.weight[pick])
            made, sums = _summed(np.concatenate(keys) >> np.uint64(64 - KEY_BITS), np.concatenate(weights))
            yield pa.record_batch([pa.array(made.view(np.int64)), pa.array(sums)], names=["key", "n"])

    counts = dictionary.mapInArrow(hashed, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    spot = F.shiftright("key", KEY_BITS - bits)
    found = (
        counts.where(F.col("n") >= min_count).select(spot.alias("spot"))
        .groupBy(F.shiftright("spot", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(spot & 63 AS INT))")).alias("mask"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), dtype=np.uint64) if table is None else table.copy()
    out[found.column("at").to_numpy()] |= found.column("mask").to_numpy().view(np.uint64)
    return out


def frequent(
    spark: SparkSession, dictionary: DataFrame, *, max_words: int = 4, min_count: int = 30, bits: int = 26
) -> DataFrame:
    """``(lang, phrase, words, f)``: the phrases of up to ``max_words`` words that occur at least
    ``min_count`` times, with their exact counts. ``dictionary`` is one of ``parse`` with
    ``ahead >= max_words - 1``; ``bits`` is at most 48."""
    marks = _mark(spark, dictionary, (1, 2), None, min_count, bits)
    for m in range(3, max_words):
        marks = _mark(spark, dictionary, (m,), marks, min_count, bits)
    table = spark.sparkContext.broadcast(marks)

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, CHUNK_BYTES, "chunk"):
            w = _Words(batch)
            first = []
            for m in range(1, max_words + 1):
                whole = m <= max(2, max_words - 1)  # marked itself
                good = w.marked(m, table.value, bits) if whole else w.parts_marked(m, table.value, bits)
                first.append(np.flatnonzero(good & w.owned))
            words = np.repeat(np.arange(1, max_words + 1), [len(f) for f in first])
            first = np.concatenate(first)
            start, end = w.start[first], w.end[first + words - 1]
            length = end - start
            offsets = np.concatenate([[0], np.cumsum(length)])
            index = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)
            spelled = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(w.raw[index])]
            )
            lang = batch.column("lang").dictionary_encode()
            rows = pa.table({
                "lang": pa.array(lang.indices.to_numpy()[w.chunk[first]]), "phrase": spelled, "words": pa.array(words),
                "n": pa.array(w.weight[first]),
            }).group_by(["lang", "phrase", "words"]).aggregate([("n", "sum")]).combine_chunks()
            for part in rows.to_batches():
                yield pa.record_batch(
                    [
                        lang.dictionary.take(part.column("lang")),
                        part.column("phrase").cast(pa.large_string()).cast(pa.string()),
                        part.column("words"), part.column("n_sum"),
                    ],
                    names=["lang", "phrase", "words", "n"],
                )

    counted = dictionary.mapInArrow(phrases, "lang string, phrase string, words bigint, n bigint")
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)


def _part(phrase: Column, words: Column, first: Column, size: Column) -> Column:
    """``size`` words of a phrase from word ``first`` (0 is the beginning) on."""
    listed = F.split(phrase, " ")
    return F.array_join(F.slice(listed, (first + 1).cast("int"), size.cast("int")), " ")


def collocations(
    spark: SparkSession, docs: DataFrame, *, max_words: int = 4, min_count: int = 30, absorbed_percent: int = 80,
    top: int | None = 2000, spacing: int = 16, bits: int = 26, lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language, or all.

    A candidate is a phrase of 2 to ``max_words`` words, inside a piece, that occurs
    ``a >= min_count`` times. Cut in two parts that occur ``l`` and ``r`` times, it scores
    floor(2000000 a / (l + r)); its lowest-scoring cut counts, the earliest of equals.
    Candidates inside a longer one with at least ``absorbed_percent`` of their count
    are dropped. ``n``: all words of the language. Order: score, then ``a`` (both
    descending), then the phrase's bytes.

    Null and empty texts have no words; a null language is ``und``; repeated rows count
    again; a language without candidates has no rows. Decimals keep products exact.
    Chunks and phrases are summed before they are shuffled, so a passage with any share of
    all rows is cheap; the bit table has ``2 ** bits`` bits whatever the input.
    """
    dictionary = written(
        spark, parse(docs, ahead=max_words - 1, spacing=spacing, lang_col=lang_col, text_col=text_col), "chunks"
    )
    counts = written(
        spark, frequent(spark, dictionary, max_words=max_words, min_count=min_count, bits=bits), "frequent-phrases"
    )
    long = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = long.withColumn("k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("words") - 1)))
    cuts = cuts.withColumn("head", _part(F.col("phrase"), F.col("words"), F.lit(0), F.col("k"))).withColumn(
        "tail", _part(F.col("phrase"), F.col("words"), F.col("k"), F.col("words") - F.col("k"))
    )
    known = counts.select("lang", "phrase", "f")
    score = F.expr("CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) DIV CAST(l + r AS DECIMAL(20,0))")
    scored = (
        cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
        .join(known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
        .withColumn("score", score)
        .groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    inner = long.where("words > 2").select(
        "lang", F.col("a").alias("outside"),
        F.explode(F.array_distinct(F.expr(
            "flatten(transform(sequence(2, CAST(words - 1 AS INT)), m -> transform(sequence(1, CAST(words - m + 1 AS INT)), "
            "i -> array_join(slice(split(phrase, ' '), i, m), ' '))))"
        ))).alias("phrase"),
    )
    holder = inner.groupBy("lang", "phrase").agg(F.max("outside").alias("outside"))
    enough = F.lit(100).cast("decimal(3,0)") * F.col("outside").cast("decimal(19,0)") >= (
        F.lit(absorbed_percent).cast("decimal(10,0)") * F.col("a").cast("decimal(19,0)")
    )
    total = dictionary.groupBy("lang").agg(F.sum(F.col("owned") * F.col("weight")).alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (
        scored.join(holder, ["lang", "phrase"], "left").where(F.col("outside").isNull() | ~enough)
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        .withColumn("rank", F.row_number().over(order).cast("bigint"))
    )
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
