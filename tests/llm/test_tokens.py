import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dossierflow.llm import packing, pretokens, sharding, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    alphabet = [*"abcsdtrevmlXY  \n\t,.!19éß　中'’-", "<|endoftext|>", "'ll", "'s", "'re", "  ", " \n", " ", "\U0001f600"]
    made = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(1500)]
    return [*made, None, "", " ", "\n", "<|endoftext|>", "a<|endoftext|>b<|endoftext|", "z" * 3000, "I'll we're 'tis '''s"]


@pytest.fixture(scope="module")
def ids(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_counts_equal_the_library(spark, docs, by_id, texts, ids):
    got = by_id(token_counts.count_tokens(docs(texts), PATH))
    assert [got[i].n_tokens for i in range(len(texts))] == [len(x) for x in ids]
    assert [got[i].n_bytes for i in range(len(texts))] == [len((t or "").encode()) for t in texts]
    assert token_counts.count_tokens(docs(["a"]).where("false"), PATH).count() == 0


def test_character_classes_are_the_library_s():
    split = Tokenizer.from_file(PATH).pre_tokenizer.pre_tokenize_str
    points = [c for c in range(0x3400) if c != 10] + list(range(0xA000, 0xD800, 7)) + list(range(0xF900, 0x11000))
    text = "".join(f"\na{chr(c)}1" for c in points)
    raw = text.encode()
    found = pretokens.cut(raw, np.array([0, len(raw)]))
    assert np.cumsum([len(found.words[i]) for i in found.which]).tolist() == [b for _, (_, b) in split(text)]


@pytest.mark.parametrize(("size", "windows"), [(16, 2), (64, 4), (1024, 16)])
def test_packing(spark, docs, texts, ids, size, windows):
    df = docs([*texts, "again", "again"], [*range(len(texts)), None, None])
    rows = packing.pack(spark, df.repartition(5), PATH, size=size, windows=windows, merge_tasks=2).collect()
    pieces, sequences = {}, {}
    for r in rows:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        if r.doc_id is not None:
            pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, dtype="<u4").tolist(), r.doc_tokens))
    for i, want in enumerate(ids):
        at, got = 0, []
        for start, part, total in sorted(pieces[i]):
            assert start == at and total == len(want) + 1
            at += len(part)
            got += part
        assert got == [*want, 0]
    loose = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
        loose += at < size
    assert loose <= 3  # the last one of each merging task
    assert sum(r.length for r in rows if r.doc_id is None) == 2 * (len(Tokenizer.from_file(PATH).encode("again").ids) + 1)


def test_packing_nothing(spark, docs):
    assert packing.pack(spark, docs(["a"]).where("false"), PATH).count() == 0


def test_shards(spark, docs):
    rng = random.Random(6)
    texts = ["w" * rng.randint(0, 300) + str(i) for i in range(3000)] + ["copy"] * 1500 + [None, "", "x" * 9000]
    ids = [*range(len(texts) - 3), 7, 7, 8]
    rows = sharding.shard(spark, docs(texts, ids), shards=16).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts, strict=True)
    )
    loads = [0] * 16
    slots = [[] for _ in range(16)]
    for r in rows:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    mean = sum(loads) / 16
    assert max(loads) - min(loads) < 0.05 * mean


def test_shards_of_nothing_and_of_few(spark, docs):
    assert sharding.shard(spark, docs(["a"]).where("false")).count() == 0
    rows = sharding.shard(spark, docs(["a", "a", None], [None, 1, 1]), shards=2).collect()
    assert len(rows) == 3
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_written_shards(spark, docs, tmp_path):
    df = docs([f"text {i}" for i in range(50)])
    assigned = sharding.shard(spark, df, shards=4)
    sharding.write_shards(spark, df, str(tmp_path / "out"), shards=4)
    read = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.doc_id, r.shard) for r in read.collect()} == {(r.doc_id, r.shard) for r in assigned.collect()}
