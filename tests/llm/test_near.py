import random
import re

import numpy as np
import xxhash

from dossierflow.llm import components, simhash
from dossierflow.llm.simhash import linked


def _fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _classes(items, near):
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if near(items[i], items[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(items))]


def test_fingerprints_and_classes_equal_brute_force(spark, docs, by_id):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(400)]
    texts = []
    for k in range(6):
        own = rng.sample(base, 300)
        for _ in range(12):
            near = own[:]
            for _ in range(rng.randint(0, 3)):
                near[rng.randrange(300)] = f"Z{rng.random()}É"
            texts.append(" ".join(near))
    texts += [None, "", " \t", "one", "One", "one two", "İ ſ K", "a b c d", *texts[:3]]
    got = by_id(simhash.near_duplicates(spark, docs(texts)))
    prints = [_fingerprint(t) for t in texts]
    assert [got[i].fp % (1 << 64) for i in range(len(texts))] == prints
    want = _classes(prints, lambda a, b: bin(a ^ b).count("1") <= 2)
    assert [got[i].component_id for i in range(len(texts))] == want
    assert len(set(want)) < len(set(prints))  # different fingerprints do link


def test_big_buckets_are_split_and_lose_no_link(spark):
    rng = random.Random(4)
    center = rng.getrandbits(64)
    values = {center}
    while len(values) < 250:
        v = rng.choice(sorted(values))
        for _ in range(rng.randint(1, 3)):
            v ^= 1 << rng.randrange(64)
        values.add(v)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    want = _classes(values, lambda a, b: bin(a ^ b).count("1") <= 2)
    for block in (10, 4096):
        edges = [(r.u, r.v) for r in simhash.links(spark, df, radius=2, block=block).collect()]
        at = {v: i for i, v in enumerate(signed)}
        pairs = {frozenset((at[u], at[v])) for u, v in edges}
        got = _classes(list(range(len(values))), lambda a, b: frozenset((a, b)) in pairs)
        assert got == want


def test_bit_sliced_radius(spark):
    rng = random.Random(1)
    values = np.array([rng.getrandbits(64) & 0xFFF for _ in range(150)], dtype=np.uint64)
    for radius in (0, 1, 2, 3, 5):
        got = linked(values, np.array([0, 100]), np.array([100, 50]), radius)
        for a, b in ((0, 100), (100, 150)):
            want = _classes(values[a:b].tolist(), lambda x, y, r=radius: bin(x ^ y).count("1") <= r)
            assert (got[a:b] - a).tolist() == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (1, 0), (0, 1)]
    rows = components.components(spark, spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {r.node: r.root for r in rows} == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}
    assert len(rows) == 44
    none = spark.createDataFrame([], "u bigint, v bigint")
    assert components.components(spark, none).count() == 0


def test_near_duplicates_empty_null_and_repeated(spark, docs):
    assert simhash.near_duplicates(spark, docs(["a"]).where("false")).count() == 0
    df = docs(["x y z", "x y z", "q r s t", "x y z"], [None, 4, 9, 2])
    assert sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(spark, df).collect()) == [
        (-1, 2), (2, 2), (4, 2), (9, 9)
    ]
    stay = simhash.drop_near_duplicates(spark, df)
    assert stay.columns == df.columns and sorted(r.doc_id for r in stay.collect()) == [2, 9]
