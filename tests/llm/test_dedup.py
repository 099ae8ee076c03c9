import hashlib
import random
from collections import Counter

import pytest

from dossierflow.llm import exact_dedup, line_dedup, suffix_dedup


def test_exact_largest_id_stays_and_texts_are_compared_as_they_are(spark, docs, by_id):
    df = docs(["a", "b", "a", None, "", "A", "a "])
    got = by_id(exact_dedup.assign(exact_dedup.new_index(spark, 4), df))
    assert [(got[i].keep_id, got[i].group_size, got[i].kept) for i in range(7)] == [
        (2, 2, False), (1, 1, True), (2, 2, True), (4, 2, False), (4, 2, True), (5, 1, True), (6, 1, True)
    ]
    assert got[0].text_sha256 == hashlib.sha256(b"a").hexdigest()


def test_exact_index_persists_and_repeated_batches_change_nothing(spark, docs, by_id):
    index = exact_dedup.new_index(spark, 4)
    exact_dedup.assign(index, docs(["a", "b"])).collect()
    again = exact_dedup.DigestIndex(spark, index.path, 4)  # another writer, or a restart
    got = by_id(exact_dedup.assign(again, docs(["b", "c", "c"], [10, 11, 12])))
    assert (got[10].keep_id, got[10].kept) == (1, False)
    assert (got[11].kept, got[12].kept) == (False, True)
    exact_dedup.assign(again, docs(["b", "c", "c"], [10, 11, 12])).collect()
    assert again.read().count() == 3
    plan = again.read().hint("merge").join(again.read().hint("merge").select("digest"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Exchange" not in text
    # a later session with other settings: the catalog entry is gone, the files stay
    spark.sql(f"DROP TABLE {index.table}")
    later = exact_dedup.DigestIndex(spark, index.path, 2)
    assert later.buckets == 4 and later.read().hint("merge").join(again.read(), "digest").count() == 3


def test_exact_repeated_rows_null_ids_and_empty_tables(spark, docs):
    df = docs(["a", "a", "a", "b", "b"], [3, 3, 1, None, None])
    stay = exact_dedup.drop_copies(exact_dedup.new_index(spark, 4), df)
    assert stay.columns == df.columns
    assert sorted((r.doc_id or -1, r.text) for r in stay.collect()) == [(-1, "b"), (3, "a")]
    none = docs(["a"]).where("false")
    assert exact_dedup.assign(exact_dedup.new_index(spark, 4), none).count() == 0


def test_lines(spark, docs, by_id):
    shared = "A shared line of text"
    df = docs([
        f"one\n  {shared.upper()}\t\nend", f"{shared}\nother\n{shared}", shared, "short\nshort", "short", None, "",
        "\n\n", f"twice here only\ntwice here only\n{shared}",
    ])
    got = by_id(line_dedup.dedup_lines(spark, df))
    assert [got[i].kept_text for i in range(9)] == [
        f"one\n  {shared.upper()}\t\nend", "other", "", "short\nshort", "short", "", "", "\n\n",
        "twice here only\ntwice here only",
    ]
    assert [(got[i].n_lines, got[i].n_dropped) for i in range(9)] == [
        (3, 0), (3, 2), (1, 1), (2, 0), (1, 0), (1, 0), (1, 0), (3, 0), (3, 1)
    ]
    assert line_dedup.dedup_lines(spark, df.where("false")).count() == 0


def test_lines_null_and_repeated_ids(spark, docs):
    line = "the same long line"
    df = docs([line, line, line + "\nx", line + "\nx"], [None, 5, 7, 7])
    got = sorted((r.doc_id or -1, r.kept_text) for r in line_dedup.dedup_lines(spark, df).collect())
    assert got == [(-1, ""), (5, line), (7, "x"), (7, "x")]


def test_lines_long_document_is_linear(spark, docs, by_id):
    lines = [f"line number {i}" for i in range(60_000)]
    got = by_id(line_dedup.dedup_lines(spark, docs(["\n".join(lines[::2]), "\n".join(lines)])))
    assert (got[1].n_lines, got[1].n_dropped) == (60_000, 30_000)


def _brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[p : p + length] for r in raws for p in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = set()
        for p in range(len(r) - length + 1):
            if seen[r[p : p + length]] > 1:
                gone.update(range(p, p + length))
        spans = sum(1 for p in gone if p - 1 not in gone)
        out.append((len(r), len(gone), spans, bytes(b for i, b in enumerate(r) if i not in gone)))
    return out


@pytest.mark.parametrize("share", [1, 3, 2_000])
def test_suffix_dedup_equals_brute_force(spark, docs, by_id, share):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé ", k=rng.randint(1, 9))) for _ in range(60)]

    def some(n):
        return " ".join(rng.choices(words, k=n))

    passage, other = some(40), some(30)
    texts = [some(rng.randint(0, 90)) for _ in range(25)]
    texts += [some(8) + passage[rng.randint(0, 5) :] + some(9) for _ in range(8)]
    texts += [other[:75] + some(3), some(3) + other[:75], other[:72], other[1:], other]  # around the length
    texts += ["x" * 400, "ab" * 90, "y" * 71, None, "", passage, passage]
    got = by_id(suffix_dedup.remove_repeats(spark, docs(texts), length=72, share=share))
    for i, want in enumerate(_brute(texts, 72)):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) == want, i


def test_suffix_dedup_empty_table_and_repeated_rows(spark, docs):
    assert suffix_dedup.remove_repeats(spark, docs(["a"]).where("false")).count() == 0
    text = "".join(map(chr, range(33, 300)))
    rows = suffix_dedup.remove_repeats(spark, docs([text, text], [4, 4])).collect()
    assert [r.n_removed for r in rows] == [len(text.encode())] * 2
    rows = suffix_dedup.remove_repeats(spark, docs([text], [None])).collect()
    assert [(r.doc_id, r.n_removed) for r in rows] == [(None, 0)]


def test_difference_cover_reaches_every_pair():
    assert (suffix_dedup.OFFSET >= 0).all() and suffix_dedup.COVER.sum() == 15


def test_suffix_block_sorts_suffixes():
    import numpy as np

    rng = random.Random(2)
    text = bytes(rng.choices(b"ab", k=300)) * 3 + bytes(rng.choices(b"abc", k=400))
    block = suffix_dedup.SuffixBlock(text, 240)
    start = np.array(rng.sample(range(1000), 500))
    order = block.sort(start, np.zeros(500, dtype=np.int64))
    assert start[order].tolist() == sorted(start.tolist(), key=lambda p: (text[p : p + 240], 0)) or all(
        text[a : a + 240] <= text[b : b + 240] for a, b in zip(start[order], start[order][1:], strict=False)
    )


def test_native_plans_have_no_python(spark, docs):
    df = docs(["a\nb", "a"])
    for made in (exact_dedup.assign(exact_dedup.new_index(spark, 4), df), line_dedup.dedup_lines(spark, df)):
        text = made._jdf.queryExecution().executedPlan().toString()
        assert not any(w in text for w in ("Python", "Arrow", "Pandas"))
