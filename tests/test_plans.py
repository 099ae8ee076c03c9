"""Plans that must not move or read documents, and the operators behind them against
plain computations."""

import json
import re
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dossierflow import schemas
from dossierflow.functions import experience as X
from dossierflow.functions import similarity as M
from dossierflow.operators import aggregate, select, similarity
from dossierflow.plans.collect import collect_payloads
from dossierflow.plans.payloads import build_payloads
from dossierflow.plans.processed import assemble_processed, assemble_processed_similar
from dossierflow.sources import store as S
from dossierflow.streaming import pages as ST
from dossierflow.streaming import stats as SS

AS_OF = "2026-01-01 00:00:00"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def page(i, name="", extra=""):
    return (i, f"https://x/resumes/{i}/", f"<div id='resume_{i}'><h1>{name or f'Ім{i}'}</h1><p>Резюме</p>{extra}</div>")


@pytest.fixture
def pages(spark):
    def make(rows):
        return spark.createDataFrame(rows, "page_id bigint, url string, html string")

    return make


# -- similarity inside the record ---------------------------------------------
def test_similar_titles_and_skills_in_a_row(spark):
    rng = np.random.default_rng(4)
    names = ["Aa", "Bbb", "Cccc", "Dd ee", "Ff gg hh", "", "Ii (x)"]
    vector = {n: rng.normal(size=3).tolist() for n in names if n and n != "Bbb"}
    vector |= {w: rng.normal(size=3).tolist() for w in ("d1", "d2", "d3", "Skill One", "two")}
    rows = []
    for k in range(40):
        items = [
            (names[rng.integers(len(names))], int(rng.integers(0, 9)), [str(w) for w in rng.choice(["d1", "d2", "d3", "TWO", "zz", ""], 2)])
            for _ in range(rng.integers(0, 8))
        ]
        rows.append((k, items, [["Skill One", "two"], ["two", "Two", "Skill One"], []][k % 3]))
    df = spark.createDataFrame(rows, "k int, items array<struct<title:string,months:int,duties:array<string>>>, skills array<string>")
    unit = {n: np.array(v) / np.linalg.norm(v) for n, v in vector.items()}
    known = F.create_map(*[x for n, v in unit.items() for x in (F.lit(n), F.array(*[F.lit(float(y)) for y in v]))])
    got = df.select(
        "k", X.months_by_title_similar(F.col("items"), known, 0.3).alias("t"),
        X.skill_months_similar(F.col("items"), F.col("skills"), known, 0.2).alias("s"),
    ).collect()

    def sim(a, b):
        return float(unit[a] @ unit[b]) if a in unit and b in unit else 0.0

    for row, (_, items, skills) in zip(sorted(got), rows, strict=True):
        groups = []  # [representative, months, titles]
        counted = {}
        for title, months, duties in items:
            if months <= 0:
                continue
            if title:
                near = max(range(len(groups)), key=lambda g: sim(title, groups[g][0]), default=None)
                if near is not None and sim(title, groups[near][0]) >= 0.3:
                    group = groups[near]
                    group[1] += months
                    group[2].add(title)
                    group[0] = min(group[0], title, key=len)
                else:
                    groups.append([title, months, {title}])
            for duty in filter(None, duties):
                named = [s.lower() for s in skills]
                if duty.lower() in named:
                    best = duty.lower()
                else:
                    at = max(range(len(skills)), key=lambda i: sim(duty, skills[i]), default=None)
                    best = named[at] if at is not None and sim(duty, skills[at]) >= 0.2 else None
                if best:
                    counted[best] = counted.get(best, 0) + months
        want = sorted(groups, key=lambda g: -g[1])
        assert [(t.display_position, t.months, t.titles) for t in row.t] == [(g[0], g[1], sorted(g[2])) for g in want]
        assert row.s == counted


def test_vectors_of_hot_texts_are_dealt(spark):
    texts = spark.createDataFrame([(i, "hot" if i % 3 else f"t{i % 7}") for i in range(900)] + [(901, None), (902, "none")], "k int, text string")
    vectors = spark.createDataFrame([("hot", [3.0, 4.0]), ("hot", [9.0, 9.0]), (None, [1.0, 0.0])] + [(f"t{i}", [0.0, 2.0]) for i in range(7)], "text string, vector array<double>")
    got = similarity.attach_vectors(texts, vectors, key="k", hot_texts=20, salts=5)
    rows = got.collect()
    assert len(rows) == 900 and {tuple(r.vector) for r in rows if r.text == "hot"} == {(0.6, 0.8)}
    assert similarity.attach_vectors(texts.limit(0), vectors, key="k").count() == 0


def test_record_without_vectors_is_the_exact_one(spark, pages):
    body = "<h2>Досвід роботи</h2><h3>Водій</h3><p>з 01.2020 по 12.2020 (12 міс.) Альфа, Київ (Авто)</p><p>їздити, лагодити</p><h2>Знання і навички</h2><ul><li>їздити</li></ul>"
    made = build_payloads(pages([page(i, extra=body) for i in (1, 1, 2)]).selectExpr("url AS source_url", "html"), as_of=AS_OF)
    none = spark.createDataFrame([], "text string, vector array<double>")
    exact = assemble_processed(made, as_of="2026-01-01")
    similar = assemble_processed_similar(made, none, as_of="2026-01-01")
    show = [F.to_json("processed").alias("p"), "source_url"]
    assert similar.count() == 3
    assert similar.select(*show).exceptAll(exact.select(*show)).count() == 0


# -- nearest items ------------------------------------------------------------
@pytest.mark.parametrize("options", [{"k": 3, "skip_same": True}, {"k": 2, "thr": 0.9}, {"k": 1}])
def test_cells_give_the_same_neighbours(spark, options):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(10, 8))
    rows = [(i, (centres[i % 10] + 0.15 * rng.normal(size=8)).tolist()) for i in range(400)]
    rows += [(1000 + i, centres[3].tolist()) for i in range(60)] + [(5000, None), (None, [1.0] * 8), (6000, [0.0] * 8)]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>")

    def found(result):
        return sorted(tuple(r) for r in result.select("query_id", "rank", "item_id", F.round("score", 6)).collect())

    want = found(similarity.nearest(df, df, **options))
    assert found(similarity.nearest_in_cells(df, df, cells=12, block_rows=40, **options)) == want
    none = df.where("id < 0")
    assert similarity.nearest_in_cells(df, none).count() == similarity.nearest_in_cells(none, df).count() == 0


def test_cells_rule_others_out(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = np.eye(16)
    rows = [(i, (centres[i % 16] + 0.02 * rng.normal(size=16)).tolist()) for i in range(640)]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>")
    sent = []
    meet = similarity._meet

    def counted(routed, *rest):
        sent.append(routed.count())
        return meet(routed, *rest)

    monkeypatch.setattr(similarity, "_meet", counted)
    similarity.nearest_in_cells(df, df, k=2, cells=16).count()
    assert sent[0] == 640 and sum(sent) < 2 * 640  # of 640 * 16


def test_cells_are_searched_in_bounded_memory():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(4096, 64))
    tracemalloc.start()
    found = M.top_k(np.arange(4096), vectors, np.arange(4096), vectors, 2, -1.0, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 2 * 4096 and peak < 50_000_000  # all scores at once are 134 MB
    cells = similarity._Cells(vectors[:32], np.full(32, np.pi), np.ones(32, dtype=np.int64))
    batch = pd.DataFrame({"id": np.arange(4096), "vector": list(vectors)})
    routed = list(similarity._routed(iter([batch]), cells, lambda c, a, _: a >= 0))
    assert sum(map(len, routed)) == 4096 * 32
    assert max(map(len, routed)) * 64 <= similarity.ROUTED_AT_ONCE


def test_recall_of_probes(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    exact = {(r.query_id, r.item_id) for r in similarity.nearest(given, given, k=2, skip_same=True).collect()}
    some = {(r.query_id, r.item_id) for r in similarity.nearest_in_cells(given, given, k=2, skip_same=True, cells=32, probes=20).collect()}
    assert len(exact & some) >= 0.9 * len(exact)


# -- streams ------------------------------------------------------------------
def test_no_page_is_shuffled_or_kept_by_the_stream(spark, pages, tmp_path):
    folder = str(tmp_path / "in")
    rows = [page(i % 40, name=f"N{i}") for i in range(120)] + [(7, "https://x/resumes/900/", ""), (8, "https://x/resumes/901/", None)]
    pages(rows).repartition(5).write.parquet(folder)
    got, seen_plans = [], []

    def use(batch, batch_id):
        seen_plans.append(plan(batch))
        got.extend((batch_id, r.source_url, r.html) for r in batch.collect())

    query = ST.stream_new_pages(
        ST.stream_pages(spark, folder, files_per_batch=2), use, checkpoint=str(tmp_path / "c"), available_now=True
    )
    query.awaitTermination()
    assert len(got) == 40 == len({u for _, u, _ in got}) and len({b for b, _, _ in got}) >= 2
    explained = query._jsq.explainInternal(False)
    for line in re.findall(r"(?:Exchange|StateStoreSave|StreamingDeduplicate)[^\n]*", explained):
        assert "html" not in line
    # pages are scanned, filtered by a broadcast of places, and not exchanged
    assert all("Exchange hashpartitioning" not in p for p in seen_plans)


def test_places_beyond_one_broadcast(spark, pages, tmp_path):
    folder = str(tmp_path / "in")
    pages([page(i) for i in range(90)]).repartition(3).write.parquet(folder)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), "page_id"]
    spark.read.schema(schemas.PAGE).parquet(folder).select(*place).where("page_id % 4 = 1").drop("page_id").write.parquet(str(tmp_path / "p"))
    places = spark.read.parquet(str(tmp_path / "p"))
    want = {f"https://x/resumes/{i}/" for i in range(90) if i % 4 == 1}
    for at_once in (4, 11, 1000):
        got = [r.source_url for r in ST.pages_at(spark, places, at_once=at_once).collect()]
        assert len(got) == len(want) and set(got) == want
    assert ST.pages_at(spark, places.limit(0)).count() == 0


def test_stream_statistics_equal_the_batch(spark, tmp_path):
    rows = [(i, i % 3 > 0 if i % 7 else None, "whole_page_fallback" if i % 5 == 0 else "resume_id_block") for i in range(60)]
    table = spark.createDataFrame(rows, "i int, ok boolean, parse_mode string")
    for part in range(3):
        table.where(f"i % 3 = {part}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stats = SS.RunStats("t")
    spark.streams.addListener(stats)
    try:
        stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = SS.observed(stream, "t").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination()
        stats.wait(query)
    finally:
        spark.streams.removeListener(stats)
    good = sum(bool(ok) for _, ok, _ in rows)
    assert stats.totals() == dict(zip(SS.COUNTS, (60, good, 60 - good, 12), strict=True))
    assert len(stats.batches) == 3 and sorted(b[0] for b in stats.batches.values()) == [20, 20, 20]


# -- store --------------------------------------------------------------------
def test_a_page_of_the_store_reads_its_own_documents(spark, pages, tmp_path):
    store = S.ProfileStore(spark, str(tmp_path / "s"))
    for day in (1, 2, 3):
        made = build_payloads(pages([page(i) for i in range(30 * day, 30 * day + 40)]).selectExpr("url AS source_url", "html"), as_of=AS_OF)
        store.upsert(made, as_of=f"2026-01-0{day} 00:00:00")
    want = sorted(((r.updated_at, r.id) for r in store.read().collect()), reverse=True)
    listed = store.list_page(2, 25)
    assert [(r.updated_at, r.id) for r in listed.collect()] == want[25:50]
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", listed._jdf.queryExecution().explainString(listed._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    assert "In(id" in pushed.group(1)
    one = store.get(want[3][1])
    assert [r.id for r in one.collect()] == [want[3][1]] and store.get(12345).count() == 0
    assert store._number("new token") == 4 == store._number("new token")


# -- containment --------------------------------------------------------------
DOCS = [
    '{"a":{"b":1,"c":[1,"x",{"d":true}]},"e":null}', '{"a":{"b":"1"}}', "broken", None, '[1,2,{"k":"v"}]',
    '{"a":{"b":1.0}}', '{"sp ace":{"q\'":5}}', '{"a":{"c":[{"d":false},{"d":true,"x":[]}]}}', "{}",
]


def holds(doc, part):
    if isinstance(part, dict):
        return isinstance(doc, dict) and all(k in doc and holds(doc[k], v) for k, v in part.items())
    if isinstance(part, list):
        return isinstance(doc, list) and all(any(holds(d, p) for d in doc) for p in part)
    return type(doc) in (type(part), *({int, float} if type(part) in (int, float) else ())) and doc == part


@pytest.mark.parametrize("part", [
    {"a": {"b": 1}}, {"a": {"c": ["x"]}}, {"a": {"c": [{"d": True}]}}, {"e": None}, {"a": {}}, {"a": {"b": "1"}}, [2], [{"k": "v"}],
    {"sp ace": {"q'": 5}}, {"a": {"c": [1, "y"]}}, {}, [],
], ids=str)
def test_containment(spark, part):
    def parsed(doc):
        try:
            return json.loads(doc)
        except (TypeError, ValueError):
            return ...

    want = [i for i, d in enumerate(DOCS) if parsed(d) is not ... and holds(parsed(d), part)]
    df = spark.createDataFrame(list(enumerate(DOCS)), "id bigint, doc string")
    as_variant = df.select("id", F.try_parse_json("doc").alias("doc"))
    for table in (df, as_variant):
        assert sorted(r.id for r in S.contains(table, "doc", part).collect()) == want
    index = S.containment_index(df, "doc")
    assert sorted(r.id for r in S.contains_indexed(df, "doc", part, index).collect()) == want


def test_containment_in_structs(spark):
    df = spark.createDataFrame([(1, ("x", [1, 2])), (2, ("y", [2])), (3, None)], "id bigint, doc struct<a: string, l: array<int>>")
    assert [r.id for r in S.contains(df, "doc", {"l": [2], "a": "y"}).collect()] == [2]
    index = S.containment_index(df, "doc")
    assert sorted(r.id for r in S.contains_indexed(df, "doc", {"l": [2]}, index).collect()) == [1, 2]


# -- collecting ---------------------------------------------------------------
def test_collecting_stops_early(spark, pages, tmp_path):
    listing = [(p, i, f"https://x/resumes/{p * 10 + i}/") for p in range(1, 41) for i in range(5)]
    listing += [(p + 1, 9, f"https://x/resumes/{p * 10}/") for p in range(1, 40)] + [(50, 0, "https://x/resumes/9/")]
    links = spark.createDataFrame(listing, "list_page bigint, pos bigint, url string")
    links.write.partitionBy("list_page").parquet(str(tmp_path / "links"))
    links = spark.read.parquet(str(tmp_path / "links"))
    unsupported = "<p>Завантажити файл</p>"
    ids = [p * 10 + i for p in range(1, 41) for i in range(5) if (p + i) % 4]  # a quarter is missing
    table = pages([page(i, extra=unsupported if i % 7 == 0 else "") for i in ids]).selectExpr("url AS source_url", "html")
    order = [u for p, _, u in sorted(listing) if p < 41]
    order = list(dict.fromkeys(order))
    good = [u for u in order if (k := int(u.split("/")[-2])) in ids and k % 7]

    def run(n, **options):
        done = collect_payloads(links, table, n, as_of=AS_OF, mode="raw", **options)
        return sorted(int(r.source_url.split("/")[-2]) for r in done.payloads.collect()), done

    def numbers(urls):
        return sorted(int(u.split("/")[-2]) for u in urls)

    got, done = run(9)
    assert got == numbers(good[:9]) and done.pages_visited == 4
    got, done = run(30, first_range=2, growth=3, skip=6)
    assert got == numbers([u for u in good if u in order[6:]][:30]) and done.pages_visited < 40
    got, done = run(10_000)
    assert got == numbers(good) and done.pages_visited == 40 and done.urls_found == len(order)
    got, done = run(10_000, start_page=39, max_pages=1)
    assert got == numbers(u for p, _, u in set(listing) if p == 39 and u in good) and done.pages_visited == 1
    assert run(0)[0] == [] and run(5, start_page=42)[0] == []


# -- modes --------------------------------------------------------------------
def test_modes_plan_no_work_they_leave_out(spark, pages):
    some = pages([page(1)]).selectExpr("url AS source_url", "html")
    plans = {m.value: build_payloads(some, as_of=AS_OF, mode=m)._jdf.queryExecution().optimizedPlan().toString() for m in select.PayloadMode}
    sizes = {m: len(p) for m, p in plans.items()}
    assert sizes["raw"] <= sizes["raw_cleaned"] < sizes["raw_cleaned_parsed"] / 2
    assert build_payloads(some, as_of=AS_OF, mode="raw").schema["parsed"].dataType == schemas.PAYLOAD["parsed"].dataType


def test_stored_payloads_are_pruned_by_mode(spark, pages, tmp_path):
    build_payloads(pages([page(1)]).selectExpr("url AS source_url", "html"), as_of=AS_OF).write.parquet(str(tmp_path / "p"))
    shown = select.project_mode(spark.read.parquet(str(tmp_path / "p")), "raw")
    read = re.search(r"ReadSchema: (\S+)", plan(shown)).group(1)
    assert "raw_html" in read and "person_name" not in read and "cleaned_text" not in read


def test_small_vectors_are_not_shuffled(spark):
    texts = spark.createDataFrame([(i, f"t{i % 7}") for i in range(200)] + [(201, None), (202, "none")], "k int, text string")
    vectors = spark.createDataFrame([(f"t{i}", [1.0 * i, 2.0]) for i in range(7)], "text string, vector array<double>")

    def lists(**options):
        return similarity.attach_vectors(texts, vectors, key="k", **options).groupBy("k").agg(F.collect_list("vector").alias("v"))

    small = lists()
    assert plan(small).count("Exchange hashpartitioning") == 1  # the texts, before they meet their vectors
    assert sorted(small.collect()) == sorted(lists(max_broadcast_bytes=0).collect())


def _counted_vector(spark):
    """A vector of a text, and how often it was made."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def vector(text):
        calls.add(1)
        return [float(len(text)), 1.0, float(ord(text[-1]) % 3)]

    return vector, calls


def test_title_vectors_are_made_once_per_title(spark):
    items = spark.createDataFrame(
        [(f"u{i % 9}", i, "ab" * (1 + i % 4), 1 + i % 5) for i in range(400)], "source_url string, item_no int, title string, months int"
    )
    vector, calls = _counted_vector(spark)
    vectors = items.select("title").distinct().select("title", vector("title").alias("vector"))
    found = sorted(aggregate.months_by_title_similar(items, vectors, thr=0.9).collect())
    assert calls.value == 4
    assert found == sorted(aggregate.months_by_title_similar(items, vectors, thr=0.9, max_broadcast_bytes=0).collect())


def test_duty_vectors_are_made_once_per_duty_and_numbers_match_vectors(spark):
    jobs = [(f"u{i % 9}", i, 1 + i % 5, [f"d{i % 6}", f"s{i % 3}", "d1"]) for i in range(300)]
    items = spark.createDataFrame(jobs, "source_url string, item_no int, months int, duties array<string>")
    # skills 1 and 4 have equal vectors, and 5 one of another length
    known = spark.createDataFrame([(f"u{i % 9}", i // 9, f"s{i // 9}") for i in range(54)], "source_url string, skill_no int, skill string")
    named = spark.createDataFrame(
        [(f"s{i}", [float(i % 3), 1.0, 0.5]) for i in range(5)] + [("s5", [1.0])], "skill string, vector array<double>"
    )
    vector, calls = _counted_vector(spark)
    duties = items.select(F.explode("duties").alias("duty")).distinct().select("duty", vector("duty").alias("vector"))

    def found(**options):
        return sorted(aggregate.skill_months_similar(items, known, duties, named, thr=0.7, **options).collect())

    got = found()
    assert got and calls.value == 9
    assert got == found(max_broadcast_bytes=0) == found(fn=lambda a, b: M.dot(a, b))
