"""Rows that share an id, have none, repeat, or carry columns with awkward names:
every filter judges a row by its own text, and loses or doubles none."""

import random
from collections import Counter

import pytest

from dossierflow.llm import decontaminate, exact_dedup, sharding, simhash, suffix_dedup, toxicity


@pytest.fixture
def awkward(spark):
    """Documents with columns that operators might use as names of their own."""

    def make(rows):
        names = (
            "__id __stay __gone __mark __sha __n id copy row rows root stay_id stay_copy times gone_id gone_copy lead n fp "
            "component_id h k o r group_size digest key keep_row score"
        ).split()
        ddl = "doc_id bigint, text string, " + ", ".join(f"{n} string" for n in names)
        return spark.createDataFrame([(i, t, *[f"{n}{j}" for n in names]) for j, (i, t) in enumerate(rows)], ddl)

    return make


def left(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def whole_rows(before, after):
    """Columns come back as they went in."""
    assert after.columns == before.columns
    assert after.exceptAll(before).count() == 0


def test_leaks_go_by_their_own_text(spark, awkward):
    bench = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    df = awkward([(None, "x a b c"), (None, "clean one"), (5, "clean two"), (6, "a b c"), (6, "clean three"), (6, None)])
    stay = decontaminate.drop_contaminated(spark, df, bench, window=3)
    assert left(stay) == sorted([(None, "clean one"), (5, "clean two"), (6, "clean three"), (6, None)], key=str)
    whole_rows(df, stay)


@pytest.mark.parametrize("rows, want", [
    ([(7, "a b c d"), (7, "q r s t"), (3, "q r s t")], [(3, "q r s t"), (7, "a b c d")]),
    ([(None, "x y z"), (None, "x y z"), (None, "q r s t"), (2, "q r s t")], [(2, "q r s t"), (None, "x y z")]),
    ([(4, "x y z")] * 3 + [(9, "x y z")], [(4, "x y z")]),
    ([(1, None), (1, ""), (1, "  "), (2, "w")], [(1, None), (2, "w")]),
])
def test_one_row_of_each_near_group(spark, awkward, rows, want):
    df = awkward(rows)
    stay = simhash.drop_near_duplicates(spark, df)
    got = [(i, t or None) for i, t in left(stay)]
    assert sorted(((i, (t or "").strip() or None) for i, t in got), key=str) == sorted(want, key=str)
    whole_rows(df, stay)


def test_exact_copies(spark, awkward):
    df = awkward([(3, "a"), (3, "a"), (1, "a"), (None, "b"), (None, "b"), (5, "c"), (5, "d"), (6, None), (6, "")])
    stay = exact_dedup.drop_copies(exact_dedup.new_index(spark, 4), df)
    got = Counter((i, t or "") for i, t in left(stay))
    assert got == {(3, "a"): 1, (None, "b"): 1, (5, "c"): 1, (5, "d"): 1, (6, ""): 1}
    whole_rows(df, stay)
    rows = exact_dedup.assign(exact_dedup.new_index(spark, 4), df).collect()
    assert Counter(r.text_sha256 for r in rows if r.kept) == dict.fromkeys({r.text_sha256 for r in rows}, 1)


def test_index_knows_texts_of_rows_without_an_id(spark, docs):
    index = exact_dedup.new_index(spark, 4)
    exact_dedup.assign(index, docs(["a"], [None])).collect()
    got = {r.doc_id: r for r in exact_dedup.assign(index, docs(["a", "b"], [5, 6])).collect()}
    assert (got[5].kept, got[5].keep_id, got[6].kept) == (False, None, True)
    assert index.read().count() == 2


def test_compacted_index_is_not_sorted_again(spark, docs, tmp_path):
    index = exact_dedup.new_index(spark, 2)
    for batch in range(3):
        exact_dedup.assign(index, docs([f"t{batch}{i}" for i in range(40)])).collect()
    small = index.compact(str(tmp_path / "index"))
    assert small.read().exceptAll(index.read()).count() == 0 and small.read().count() == 120

    def sorts(of):
        with exact_dedup._stored_order(spark):
            fresh = spark.range(9).selectExpr("unhex(sha2(CAST(id AS STRING), 256)) AS digest")
            joined = fresh.join(of.read().hint("merge"), "digest", "left_anti")
            return joined._jdf.queryExecution().executedPlan().toString().count("Sort [digest")

    assert (sorts(index), sorts(small)) == (2, 1)
    got = {r.doc_id: r.kept for r in exact_dedup.assign(small, docs(["t00", "new"], [900, 901])).collect()}
    assert got == {900: False, 901: True}
    small.forget()
    assert exact_dedup.DigestIndex(spark, small.path).read().count() == 121


def test_toxic_rows(spark, awkward):
    rng = random.Random(3)
    calm = [" ".join(rng.choices("one two three four five six".split(), k=30)) for _ in range(200)]
    foul = [c + " vilewordx grimtermy" for c in calm[:60]]
    df = awkward([*enumerate(calm), *enumerate(foul, 1000), (1000, "clean text"), (None, foul[0]), (None, "calm text"), (7, None)])
    labels = spark.createDataFrame(
        [(i, 0) for i in range(200)] + [(i, 1) for i in range(1001, 1060)], "doc_id bigint, toxic int"
    )
    stay = toxicity.drop_toxic(spark, df, toxicity.fit(spark, df, labels))
    assert Counter(left(stay)) == Counter([*enumerate(calm), (1000, "clean text"), (None, "calm text"), (7, None)])
    whole_rows(df, stay)


def test_shards_of_repeated_rows(spark, awkward):
    rows = [(1, "same text " * 30)] * 400 + [(i, "other text " * 27) for i in range(400)]
    found = sharding.shard(spark, awkward(rows)).collect()
    loads, slots = Counter(), {}
    for r in found:
        loads[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(found) == 800 and len(loads) == 16
    assert max(loads.values()) - min(loads.values()) < 0.1 * sum(loads.values()) / 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_written_shards_have_each_row_once(spark, awkward, tmp_path):
    df = awkward([(1, f"text {i}") for i in range(30)] + [(None, "none")] * 5 + [(2, None)] * 3 + [(3, "twice")] * 26)
    sharding.write_shards(spark, df, str(tmp_path / "s"), shards=4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(r.shard for r in back.select("shard").distinct().collect()) == [0, 1, 2, 3]
    plain = back.drop("shard").select(*df.columns)
    assert plain.exceptAll(df).count() == df.exceptAll(plain).count() == 0
    with pytest.raises(ValueError):
        sharding.write_shards(spark, back, str(tmp_path / "t"))


@pytest.mark.parametrize("length", [200, 300, 600])
def test_suffix_dedup_beyond_256_bytes(spark, docs, by_id, length):
    rng = random.Random(11)

    def some(n):
        return "".join(rng.choices("abcdefgh ", k=n))

    shared = some(length - 40)
    strings = [shared + some(40 + 5) for _ in range(6)]  # equal up to near their ends
    texts = [some(50) + s + some(50) for s in strings] + [some(30) + s + some(30) for s in strings]
    got = by_id(suffix_dedup.remove_repeats(spark, docs(texts), length=length))
    places = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    for i, t in enumerate(texts):
        gone = set()
        for p in range(len(t) - length + 1):
            if places[t[p : p + length]] > 1:
                gone.update(range(p, p + length))
        assert got[i].n_removed == len(gone) > 0, i
