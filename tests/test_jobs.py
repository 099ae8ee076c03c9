"""Aggregates, similarity, selection, store and streams against plain computations."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import tables as B
from dossierflow.functions import similarity as M
from dossierflow.operators import aggregate, select, similarity, skills, work
from dossierflow.plans.payloads import build_payloads
from dossierflow.plans.processed import assemble_processed
from dossierflow.sources import pages as P
from dossierflow.sources import store as S
from dossierflow.streaming import pages as ST
from tests.conftest import SF


# -- aggregates --------------------------------------------------------------
def test_table_and_row_aggregates_agree(spark):
    numbered = B.payloads(spark, SF).withColumn("k", B.number(F.col("source_url")))
    record = assemble_processed(numbered, as_of=B.AS_OF, keys=("k",)).cache()
    in_row = record.select("k", F.explode("processed.months_by_position").alias("t")).select(
        "k", "t.position", "t.display_position", "t.months", "t.years", "t.titles"
    )
    table = aggregate.months_by_title(B.items(spark, SF), keys=("k",)).drop("first_item_no")
    assert in_row.exceptAll(table).count() == 0 == table.exceptAll(in_row).count()
    counted = record.select("k", F.explode("processed.skill_months").alias("skill", "m")).withColumn(
        "skill_months", F.col("m").cast("bigint")).drop("m")
    known = skills.known_skills(B.parsed(spark, SF, "skills"), keys=("k",))
    matched = aggregate.skill_months(B.items(spark, SF), known, keys=("k",))
    assert counted.exceptAll(matched).count() == 0 == matched.exceptAll(counted).count()


def test_twenty_titles_in_order(spark):
    rows = [("u", i, f"x{'.' * i} y", 1, []) for i in range(30)] + [("u", 40, " ", 5, []), ("u", 41, "z", 0, [])]
    items = spark.createDataFrame(rows, "source_url string, item_no int, title string, months int, duties array<string>")
    (row,) = aggregate.months_by_title(items).collect()
    assert row.months == 30 and row.display_position == "x y"
    assert row.titles == sorted(f"x{'.' * i} y" for i in range(30))[:20]


def test_similar_titles_are_the_planted_clusters(spark):
    """Clusters are laid out first: each has an axis of its own, its titles lie close to it."""
    rng = np.random.default_rng(1)
    rows, expected = [], {}
    for p in range(20):
        n = int(rng.integers(1, 7))
        members = [int(c) for c in rng.integers(0, n, int(rng.integers(1, 25)))]
        planted = {}
        for i, c in enumerate(members):
            vector = rng.normal(scale=0.02, size=6)
            vector[c] += 1
            vector /= np.linalg.norm(vector)
            title, months = "t" * int(rng.integers(1, 9)) + str(i), int(rng.integers(1, 50))
            rows.append((f"u{p}", i, title, months, vector.tolist()))
            planted.setdefault(c, []).append((title, months))
        expected[f"u{p}"] = [
            (min((t for t, _ in items), key=len), sum(m for _, m in items), sorted(t for t, _ in items)[:20])
            for items in planted.values()
        ]
    random.Random(2).shuffle(rows)
    items = spark.createDataFrame(rows, "source_url string, item_no int, title string, months int, vector array<double>")
    found = aggregate.months_by_title_similar(items, thr=0.6).orderBy("source_url", "cluster_no").collect()
    got = {}
    for r in found:
        got.setdefault(r.source_url, []).append((r.display_position, r.months, list(r.titles)))
    assert got == expected
    total = items.agg(F.sum("months")).first()[0]
    assert sum(r.months for r in found) == total
    replaced = aggregate.months_by_title_similar(items, thr=0.6, fn=lambda v, m: np.ones(len(m)))
    assert replaced.count() == 20  # a measure that calls everything equal


def test_title_without_vector_stays_alone(spark):
    items = spark.createDataFrame(
        [("u", 0, "a", 3, [1.0, 0.0]), ("u", 1, "b", 4, None), ("u", 2, "c", 5, [1.0, 0.0])],
        "source_url string, item_no int, title string, months int, vector array<double>")
    got = aggregate.months_by_title_similar(items).orderBy("cluster_no").collect()
    assert [(r.display_position, r.months) for r in got] == [("a", 8), ("b", 4)]


def test_similar_skills_equal_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(aggregate, "SKILLS_PER_ROW", 3)
    rng = np.random.default_rng(4)
    unit = lambda: (lambda v: (v / np.linalg.norm(v)).tolist())(rng.normal(size=3))
    names = [f"s{i}" for i in range(10)]
    duties = [f"d{i}" for i in range(15)] + ["S1", "s2"]
    sv, dv = {n: unit() for n in names}, {d: unit() for d in duties}
    jobs = [("u", i, int(rng.integers(0, 9)), [duties[j] for j in rng.integers(0, len(duties), 5)]) for i in range(12)]
    expected = {}
    for _, _, months, ds in jobs:
        for d in ds:
            if d.lower() in names:
                hit = d.lower()
            else:
                sims = [float(np.dot(dv[d], sv[n])) for n in names]
                hit = names[int(np.argmax(sims))] if max(sims) >= 0.8 else None
            if months and hit:
                expected[hit] = expected.get(hit, 0) + months
    items = spark.createDataFrame(jobs, "source_url string, item_no int, months int, duties array<string>")
    known = spark.createDataFrame([("u", i, n) for i, n in enumerate(names)], "source_url string, skill_no int, skill string")
    found = aggregate.skill_months_similar(
        items, known, spark.createDataFrame(list(dv.items()), "duty string, vector array<double>"),
        spark.createDataFrame(list(sv.items()), "skill string, vector array<double>"), thr=0.8,
    )
    assert {r.skill: r.skill_months for r in found.collect()} == expected


# -- similarity --------------------------------------------------------------
@pytest.mark.parametrize("k,thr", [(1, -1.0), (3, 0.2)])
def test_nearest_scan_and_grid_are_exact(spark, k, thr):
    rng = np.random.default_rng(7)
    vectors = np.round(rng.normal(size=(60, 4)), 1)
    vectors[::4] = vectors[0]  # copies: ties must go to the smaller id
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(vectors)], "id bigint, vector array<double>")
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    u = vectors / np.where(norms == 0, 1, norms)
    scores = u @ u.T
    want = set()
    for q in range(60):
        order = sorted((i for i in range(60) if i != q and scores[q, i] >= thr), key=lambda i: (-round(scores[q, i], 9), i))
        want |= {(q, i, r + 1) for r, i in enumerate(order[:k])}
    for options in ({}, {"max_broadcast_bytes": 0, "block_rows": 16}):
        found = similarity.nearest(df, df, k=k, thr=thr, skip_same=True, **options).collect()
        got = {(r.query_id, r.item_id, r["rank"]) for r in found}
        assert len(got) == len(want)
        same = {(q, r): round(float(scores[q, i]), 6) for q, i, r in want}
        assert {(q, r): round(float(scores[q, i]), 6) for q, i, r in got} == same


def test_cosine(spark):
    rows = spark.createDataFrame(
        [([3.0, 4.0], [6.0, 8.0], "a", "b"), ([0.0, 0.0], [1.0, 0.0], "a", "b"), ([1.0, 0.0], [1.0, 0.0], " ", "b"),
         (None, [1.0, 0.0], "a", "b")],
        "vector_a array<double>, vector_b array<double>, x string, y string")
    got = similarity.cosine_pairs(rows, text_a="x", text_b="y").collect()
    assert [round(r.similarity, 9) for r in got] == [1.0, 0.0, 0.0, 0.0]
    first = similarity.cosine_pairs(rows, fn=lambda a, b: F.get(a, F.lit(0))).collect()
    assert round(first[0].similarity, 9) == 0.6


# -- sources and selection ---------------------------------------------------
def test_links_in_boxes(spark):
    html = """<a href="/resumes/9/">out</a><div class="card resume-link x"><div><a class=b href='/resumes/1/?a=1&amp;b=2'>x</a></div>
    <a href="https://o/resumes/2">y</a><a href="/jobs/3/">z</a><a data-href="/resumes/8/">n</a></div>
    <div class="resume-link"><a href='/resumes/1/?a=1&amp;b=2'>again</a><a href="resumes/4/">r</a></div><!-- <div class="resume-link"><a href="/resumes/7/">c</a></div> -->"""
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "page_id int, html string")
    rows = P.extract_links(df, base="https://h/").orderBy("pos").collect()
    assert [(r.pos, r.url, r.key) for r in rows] == [
        (0, "https://h/resumes/1/?a=1&b=2", "1"), (1, "https://o/resumes/2", None), (2, "https://h/resumes/4/", "4")]


def test_json_lines(spark, tmp_path):
    made = build_payloads(
        spark.createDataFrame([("https://x/resumes/1/", "<div id=resume_1><p>1 мая 2020</p><p>Ім’я</p></div>")],
                              "source_url string, html string"), as_of="2026-01-01 00:00:00")
    path = str(tmp_path / "out")
    P.export_json(made, path)
    (line,) = [r.value for r in spark.read.text(path).collect()]
    assert "Ім’я" in line and '"resume_date":"2020-05-01"' in line and '"salary":null' in line
    assert spark.read.schema(made.schema).json(path).collect() == made.collect()
    assert [r.json for r in P.as_json(made).collect()] == [line]


def test_by_urls_list_and_limits(spark):
    pages = spark.createDataFrame([(f"https://h/{i}", i) for i in range(10)], "source_url string, n int")
    got = select.by_urls(pages, ["/5", "https://h/2", "5", "/77"], base="https://h/").collect()
    assert [(r.req_pos, r.n) for r in got] == [(0, 5), (1, 2)]
    rows = [r.n for r in select.skip_limit(pages, key="source_url", order=["n"], skip=2, limit=3, success=F.col("n") != 3).collect()]
    assert rows == [2, 4, 5]
    assert select.skip_limit(pages, key="source_url", order=["n"], limit=0).count() == 0
    assert select.skip_limit(pages, key="source_url", order=["n"], skip=4).count() == 6


def test_until(spark):
    listing = spark.createDataFrame(
        [(p, i, f"u{p}-{i}") for p in (2, 3, 4, 6) for i in range(3)] + [(3, 9, "u2-0")], "list_page int, pos int, url string")
    run = lambda n, **o: [r.url for r in select.until_n(listing, n, **o).orderBy("list_page", "pos").collect()]
    assert run(100) == []  # page 1 has no links
    assert run(100, start_page=2) == [f"u{p}-{i}" for p in (2, 3, 4) for i in range(3)]
    assert run(4, start_page=3) == ["u3-0", "u3-1", "u3-2", "u2-0"]
    assert run(100, start_page=2, max_pages=1) == ["u2-0", "u2-1", "u2-2"]
    assert run(2, start_page=2, skip=1) == ["u2-1", "u2-2"]
    assert run(0, start_page=2) == []


def test_modes_and_unsupported(spark):
    pages = spark.createDataFrame(
        [("https://x/resumes/1/", "<div id=resume_1><p>ФАЙЛ РЕЗЮМЕ</p></div>"), ("https://x/resumes/2/", "<ul><li>візитка</li></ul>"),
         ("https://x/resumes/3/", "<div id=resume_3><p>так</p></div>")], "source_url string, html string")
    raw = build_payloads(pages, as_of="2026-01-01 00:00:00", mode="raw").collect()
    assert [(r.source_url[-2], r.raw_html is None, r.cleaned_text, r.parsed) for r in raw] == [("3", False, None, None)]
    with pytest.raises(ValueError):
        build_payloads(pages, as_of="2026-01-01 00:00:00", mode="all")


# -- plans -------------------------------------------------------------------
def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_page_to_record_needs_no_exchange(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select(F.col("url").alias("source_url"), "html")
    made = build_payloads(pages, as_of="2026-01-01 00:00:00")
    plan = _plan(assemble_processed(made, as_of="2026-01-01"))
    assert "Exchange" not in plan and "Python" not in plan
    assert "ReadSchema: struct<url:string,html:string>" in plan
    raw = _plan(build_payloads(pages, as_of="2026-01-01 00:00:00", mode="raw"))
    assert "Досвід" not in raw and len(raw) < len(_plan(made)) / 2


def test_first_wins_is_cut_before_the_exchange(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    plan = _plan(select.dedupe_first(events, "user_id", ["ts"]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    listing = S.list_page(events.select(F.col("event_id").alias("id"), F.col("ts").alias("updated_at")), columns=("id", "updated_at"))
    assert "TakeOrderedAndProject" in _plan(listing)


def test_filters_reach_the_scan(spark):
    plan = _plan(P.load_pages(spark, f"{SF}/pages.parquet"))
    assert "IsNotNull(html)" in plan and "page_id" not in plan
    items = spark.read.parquet(f"{SF}/events.parquet").select(F.col("event_id").alias("id"))
    assert "EqualTo(event_id,7)" in _plan(S.get_profile(items, 7))


# -- store -------------------------------------------------------------------
def _pages(spark, *rows):
    return spark.createDataFrame(
        [(f"https://x/resumes/{i}/", f"<div id=resume_{i}><h1>{n}</h1><p>Місто: Київ</p></div>") for i, n in rows],
        "source_url string, html string")


def test_store_life(spark, tmp_path):
    store = S.ProfileStore(spark, str(tmp_path / "store"))
    assert store.read().count() == 0 and store.stats().first().total == 0
    one = build_payloads(_pages(spark, (1, "А"), (2, "Б")), as_of="2026-01-01 00:00:00")
    report = store.upsert(one, as_of="2026-01-01 00:00:00").collect()
    assert sorted(r.inserted for r in report) == [True, True]
    store.set_processed(assemble_processed(one, as_of="2026-01-01"), as_of="2026-01-02 00:00:00")
    two = build_payloads(_pages(spark, (2, "В"), (3, "Г")), as_of="2026-01-03 00:00:00")
    for _ in range(2):  # a repeated batch changes nothing more
        report = {r.source_url[-2]: r.inserted for r in store.upsert(two, as_of="2026-01-03 00:00:00").collect()}
    assert report == {"2": False, "3": False}
    rows = {r.source_url[-2]: r for r in store.read().collect()}
    assert {k: r.parsed_json.person_name for k, r in rows.items()} == {"1": "А", "2": "В", "3": "Г"}
    assert rows["2"].processed_json is not None and rows["3"].processed_json is None  # kept on upsert
    assert rows["2"].created_at == dt.datetime(2026, 1, 1) and rows["2"].updated_at == dt.datetime(2026, 1, 3)
    stats = store.stats(stale=True).first()
    assert (stats.total, stats.processed, stats.parsed, stats.stale) == (3, 2, 3, 1)
    ids = sorted((rows["2"].id, rows["3"].id), reverse=True)
    assert [r.id for r in store.list_page(1, 2).collect()] == ids
    assert store.list_page(0, 0).count() == 1
    assert store.get(rows["1"].id).first().source_url.endswith("/1/") and store.get(5).count() == 0
    by_city = S.json_filter(store.read(), "parsed_json", "city", "Київ")
    assert by_city.count() == 3 and S.json_filter(store.read(), "warnings", "", "x").count() == 0


def _bytes(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_store_appends_repeats_and_compacts(spark, tmp_path):
    store = S.ProfileStore(spark, str(tmp_path / "store"))
    at = "2026-01-0{} 00:00:00".format
    many = build_payloads(_pages(spark, *[(i, f"Ім{i}") for i in range(200)]), as_of=at(1)).cache()
    store.upsert(many, as_of=at(1), token="a")
    before = _bytes(tmp_path / "store")
    few = build_payloads(_pages(spark, *[(i, f"Но{i}") for i in range(4)], (3, "Но3")), as_of=at(2))
    # a writer that died: some rows arrived, and its working folder stayed behind
    left = S.batch_rows(few).limit(2).withColumns({
        "id": S.profile_id(F.col("source_url")), "is_payload": F.lit(True), "created_at": S._time(at(2)),
        "collected_at": S._time(at(2)), "processed_at": F.lit(None).cast("timestamp_ntz"), "updated_at": S._time(at(2))})
    store._append(left, 2, "b")
    (tmp_path / "store" / "changes" / "batch=2" / "_temporary").mkdir()
    for _ in range(2):
        report = store.upsert(few, as_of=at(2), token="b").collect()
        assert len(report) == 4 and not any(r.inserted for r in report)
    alone = tmp_path / "alone"
    S.batch_rows(few).write.parquet(str(alone))
    assert _bytes(tmp_path / "store") - before < 3 * 2 * _bytes(alone)  # three attempts, each below twice its rows
    assert store.changes().agg(F.max("batch")).first()[0] == 2
    unknown = spark.createDataFrame([("https://x/none/",)], "source_url string")
    store.set_processed(unknown.withColumn("processed", F.lit(None).cast(S.schemas.PROCESSED)), as_of=at(3))
    rows = {r.source_url: r for r in store.read().collect()}
    names = {r.parsed_json.person_name for r in rows.values()}
    assert len(rows) == 200 and names == {f"Но{i}" for i in range(4)} | {f"Ім{i}" for i in range(4, 200)}
    small = store.compact(str(tmp_path / "small"))
    assert {r.source_url: r for r in small.read().collect()} == rows
    again = small.upsert(few, as_of=at(4)).collect()
    assert len(again) == 4 and not any(r.inserted for r in again)
    changed = small.get(rows["https://x/resumes/1/"].id)
    assert changed.first().updated_at == dt.datetime(2026, 1, 4) and changed.first().created_at == dt.datetime(2026, 1, 1)
    plan = _plan(small.get(7).select("id", "updated_at"))
    assert "EqualTo(id,7)" in plan and "raw_html" not in plan.split("ReadSchema")[-1]
    many.unpersist()


def test_batch_rules(spark):
    made = build_payloads(_pages(spark, (1, "А")), as_of="2026-01-01 00:00:00")
    later = build_payloads(_pages(spark, (1, "Я")), as_of="2026-01-02 00:00:00")
    (row,) = S.batch_rows(made.unionByName(later)).collect()
    assert row.parsed_json.person_name == "Я"
    with pytest.raises(Exception, match="source_url is required"):
        S.batch_rows(made.withColumn("source_url", F.lit(None).cast("string"))).collect()


def test_json_filter_text_and_variant(spark):
    df = spark.createDataFrame([('{"a":{"b":"x"}}',), ('{"a":1}',), (None,)], "j string")
    assert S.json_filter(df, "j", "a.b", "x").count() == 1
    assert S.json_filter(df.select(F.parse_json("j").alias("v")), "v", "a.b", "x").count() == 1
    nested = spark.createDataFrame([({"k": [1, 2]},), ({"k": [3]},)], "m map<string,array<int>>")
    assert S.json_filter(nested, "m", "k", 3).count() == 1


# -- streams -----------------------------------------------------------------
def test_stream_drops_repeated_urls(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    folder = str(tmp_path / "in")
    pages.unionByName(pages).repartition(4).write.parquet(folder)
    stream = ST.stream_payloads(spark, folder, as_of="2026-01-01 00:00:00", mode="raw_cleaned", files_per_batch=2)
    out = str(tmp_path / "out")
    query = (stream.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination()
    got = spark.read.schema(stream.schema).parquet(out).select("source_url", "cleaned_text")
    batch = build_payloads(
        select.dedupe_first(pages.select(F.col("url").alias("source_url"), "html", "page_id"), "source_url", ["page_id"]),
        as_of="2026-01-01 00:00:00", mode="raw_cleaned").select("source_url", "cleaned_text")
    assert got.count() == batch.count() and got.exceptAll(batch).count() == 0


def test_stream_upsert_equals_batch(spark, tmp_path):
    pages = _pages(spark, *[(i, f"Ім{i}") for i in range(6)]).select(
        F.lit(0).cast("bigint").alias("page_id"), F.col("source_url").alias("url"), "html")
    folder = str(tmp_path / "in")
    pages.repartition(3).write.parquet(folder)
    store = S.ProfileStore(spark, str(tmp_path / "store"))
    query = ST.stream_upsert(ST.stream_pages(spark, folder, files_per_batch=1), store, as_of="2026-01-01 00:00:00",
                             checkpoint=str(tmp_path / "c"), available_now=True)
    query.awaitTermination()
    assert query.exception() is None
    rows = store.read().collect()
    assert sorted(r.parsed_json.person_name for r in rows) == [f"Ім{i}" for i in range(6)]
    assert all(r.processed_json is not None for r in rows)


def test_vectors_listed_twice_count_once(spark):
    items = spark.createDataFrame(
        [("u", 0, "a", 10)], "source_url string, item_no int, title string, months int"
    )
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("a", [1.0, 0.0])], "title string, vector array<double>")
    (row,) = aggregate.months_by_title_similar(items, vectors).collect()
    assert row.months == 10


def test_nearest_skips_missing_vectors_and_emits_k_per_task(spark):
    from dossierflow.operators import similarity

    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)] + [(900, None)]
    items = spark.createDataFrame(rows, "id bigint, vector array<double>").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        emitted = similarity._scan(items.where("id < 20"), items.where("id < 300"), 3, -1.0, False).count()
        found = similarity.nearest(items.where("id < 20 OR id = 900"), items, k=3)
        assert emitted == 60 and found.count() == 60
        assert found.where("rank = 1 AND query_id = item_id").count() == 20
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_json_filter_on_booleans_lists_and_numbers(spark):
    from dossierflow.sources import store

    rows = [(1, '{"a": {"b": true}, "l": ["x", "y"], "n": 5}'), (2, '{"a": {"b": false}, "l": ["z"], "n": 6}')]
    text = spark.createDataFrame(rows, "id int, doc string")
    variant = text.withColumn("doc", F.parse_json("doc"))
    typed = text.withColumn("doc", F.from_json("doc", "a struct<b: boolean>, l array<string>, n bigint"))
    for df in (text, variant, typed):
        for path, value in (("a.b", True), ("l", "y"), ("n", 5)):
            assert [r.id for r in store.json_filter(df, "doc", path, value).collect()] == [1], (path, value)
