"""Runs against a comparison of all words at all distances."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dossierflow.llm import periodic
from dossierflow.llm.queries import op11_periodic
from tests.conftest import SF


def every_run(words):
    """``{(start, length): smallest period}`` by trying each distance."""
    n, out = len(words), {}
    for p in range(1, n // 2 + 1):
        i = p
        while i < n:
            j = i
            while j < n and words[j] == words[j - p]:
                j += 1
            if j - i >= p:
                out.setdefault((i - p, j - i + p), p)
            i = j + 1
    return out


def found(words):
    start, length, period = periodic.find_runs(np.array(words, dtype=np.int64), len(words))
    return {(s, n): p for s, n, p in zip(start.tolist(), length.tolist(), period.tolist(), strict=True)}


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("words", [
    [], [1], [1, 1], [7] * 77, [1] * 40 + [2] + [1] * 40, [1, 2] * 30 + [1] + [1, 2] * 30 + [1],
    fibonacci(300), [bin(i).count("1") & 1 for i in range(600)], list(range(50)) * 3,
], ids=range(9))
def test_known_words(words):
    assert found(words) == every_run(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=25), st.integers(1, 90), st.lists(st.integers(0, 89), max_size=3))
def test_periods_with_breaks(base, n, breaks):
    words = (base * 90)[:n]
    for b in breaks:
        words[b % n] = 9
    assert found(words) == every_run(words)


def expected(text, min_length=12):
    words = (text or "").encode().split()
    runs = sorted((s, p, n) for (s, n), p in every_run(words).items() if n >= min_length)
    gone = {i for s, p, n in runs for i in range(s + p, s + n)}
    return len(words), [(s, n, p) for s, p, n in runs], b" ".join(w for i, w in enumerate(words) if i not in gone)


def test_documents_and_edge_cases(spark, docs, by_id):
    long = " ".join(str(i * i % 1009) for i in range(30_000))  # period 1009
    texts = [None, "", " \t\r\n", "a", "la " * 11, "la " * 12, "a b\x0bc\x0c" * 4, " x " * 12, "la la la " * 9]
    got = by_id(periodic.collapse_runs(docs([*texts, long])))
    for i, text in enumerate(texts):
        n_words, runs, kept = expected(text)
        assert (got[i].n_words, [tuple(r) for r in got[i].runs], got[i].text.encode()) == (n_words, runs, kept)
    assert [tuple(r) for r in got[len(texts)].runs if r.period == 1009] == [(0, 30_000, 1009)]
    assert got[len(texts)].text == " ".join(long.split()[:1009])
    assert periodic.collapse_runs(docs([])).count() == 0
    twice = periodic.collapse_runs(docs(["x " * 20, "x " * 20, "y " * 20], [4, 4, None])).collect()
    assert sorted((r.doc_id or -1, r.text, len(r.runs)) for r in twice) == [(-1, "y", 1), (4, "x", 1), (4, "x", 1)]


def test_chunks_of_any_size(spark, docs, monkeypatch):
    """Documents that end with each other's beginnings don't make runs together."""
    rows = docs(["a b c " * k for k in range(1, 9)] * 3, range(24))
    whole = sorted(map(str, periodic.collapse_runs(rows).collect()))
    monkeypatch.setattr(periodic, "CHUNK_BYTES", 1)
    assert sorted(map(str, periodic.collapse_runs(rows).collect())) == whole


def test_query_against_brute_force(spark):
    want = {}
    for row in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        words = (row.text or "").encode().split()
        h, n = zlib.crc32(str(row.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
        ids, every = np.array([codes[w] for w in words], dtype=np.int64), {}
        for p in range(1, n // 2 + 1):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], ids[p:] == ids[:-p], [0]])))
            for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                if e - s >= p:
                    every.setdefault((s, e - s + p), p)
        runs = sorted((s, p, m) for (s, m), p in every.items() if m >= 12)
        gone = {i for s, p, m in runs for i in range(s + p, s + m)}
        best = max(((m, -s, -p) for s, p, m in runs), default=None)
        listed = "".join(f"{s},{m},{p}\n" for s, p, m in runs)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        want[row.doc_id] = (
            len(runs), *((-best[1], best[0], -best[2], 1000 * best[0] // -best[2]) if best else (None,) * 4),
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
        )
    got = {r.doc_id: tuple(r)[1:] for r in op11_periodic(spark, SF).collect()}
    assert got == want and any(w[0] for w in want.values())
