"""Collocations against plain counting of all phrases."""

import collections
import re

import numpy as np
import pytest

from dossierflow.llm import collocations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def pieces(text):
    low = (text or "").translate(str.maketrans(UPPER, UPPER.lower()))
    return [w for p in re.split(r"[.,;:!?\n-\r]", low) if (w := [x for x in re.split("[ \t]+", p) if x])]


def plain(rows, max_words=4, min_count=30, percent=80, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                f.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    long = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= min_count}
    inside = collections.Counter()
    for (lang, w), v in long.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                inside[lang, w[i : i + m]] = max(inside[lang, w[i : i + m]], v)
    out = collections.defaultdict(list)
    for (lang, w), a in long.items():
        if inside[lang, w] and 100 * inside[lang, w] >= percent * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out[lang].append((score, a, " ".join(w), f[lang, w[:k]], f[lang, w[k:]]))
    made = set()
    for lang, found in out.items():
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        made |= {(lang, i + 1, p, a, left, right, n[lang], s) for i, (s, a, p, left, right) in enumerate(found[:top])}
    return made


def tables(spark, rows):
    return spark.createDataFrame(
        [(t, g, 1, 2, "x", "y") for g, t in rows], "text string, lang string, owned int, n int, chunk string, phrase string"
    )


@pytest.fixture
def corpus():
    rng = np.random.default_rng(7)
    words = np.array(["the", "of", "New", "york", "City", "ÉTÉ", "été", "\x00", "a-b", "x'", "und", "z" * 300, "in", "to", "on", "at"])
    share = np.arange(len(words), 0, -1.0) ** 2
    rows = []
    for i in range(250):
        chosen = rng.choice(words, rng.integers(0, 60), p=share / share.sum())
        gaps = rng.choice([" ", "  ", "\t", ". ", ", ", "\n", "!?"], len(chosen), p=[0.8, 0.04, 0.04, 0.03, 0.03, 0.03, 0.03])
        rows.append((["en", None, "und", "de", ""][i % 5], "".join(w + g for w, g in zip(chosen, gaps, strict=True))))
    rows += [("en", "One, TWO three four five six seven eight nine ten")] * 40 + [("de", "la " * 4000), ("fr", "solo"), ("fr", None), (None, "")]
    return rows


@pytest.mark.parametrize("options", [{}, {"spacing": 1}, {"spacing": 3, "bits": 6}, {"spacing": 10**9, "bits": 12}])
def test_equals_plain_counting(spark, corpus, options):
    """Whatever the triggers and however small the bit table."""
    got = collocations.collocations(spark, tables(spark, corpus), min_count=10, **options)
    assert {tuple(r) for r in got.collect()} == plain(corpus, min_count=10)


@pytest.mark.parametrize("max_words", [2, 3, 5])
def test_other_lengths_and_limits(spark, corpus, max_words):
    got = collocations.collocations(
        spark, tables(spark, corpus), max_words=max_words, min_count=8, absorbed_percent=60, top=7
    )
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain(corpus, max_words, 8, 60, 7)


def test_batches_of_any_size(spark, corpus, monkeypatch):
    monkeypatch.setattr(collocations, "TEXT_BYTES", 50)
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 50)
    got = collocations.collocations(spark, tables(spark, corpus[::3]), min_count=5)
    assert {tuple(r) for r in got.collect()} == plain(corpus[::3], min_count=5)


def test_chunks_own_each_word_once(spark, corpus):
    found = collocations.parse(tables(spark, corpus), spacing=3).collect()
    owned = collections.Counter()
    for r in found:
        words = r.chunk.split(" ")
        assert r.owned in (len(words), len(words) - 3) and r.owned > 0
        owned.update({(r.lang, w): 0 for w in words})
        for w in words[: r.owned]:
            owned[r.lang, w] += r.weight
    want = collections.Counter(("und" if g is None else g, w) for g, t in corpus for p in pieces(t) for w in p)
    assert +owned == want
    assert max(r.weight for r in found) >= 40  # copies are one entry


def test_no_rows_and_large_counts(spark):
    assert collocations.collocations(spark, tables(spark, [])).count() == 0
    assert collocations.collocations(spark, tables(spark, [("en", None), (None, " . ")])).count() == 0
    dictionary = spark.createDataFrame(
        [("en", "big deal", 2, 6 * 10**12), ("en", "big", 1, 10**12)], "lang string, chunk string, owned bigint, weight bigint"
    )
    counts = {r.phrase: r.f for r in collocations.frequent(spark, dictionary).collect()}
    assert counts == {"big": 7 * 10**12, "deal": 6 * 10**12, "big deal": 6 * 10**12}
