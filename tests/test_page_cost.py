"""Cheaper steps from pages to items give what the plain forms give."""

import re

from pyspark.sql import functions as F

from checks import tables as B
from dossierflow.functions import text as T
from dossierflow.functions import vocabulary as V
from dossierflow.operators import fields


def test_lambdas_of_cleaning_test_no_lists(spark):
    pieces = spark.createDataFrame([("",)], "html string").select(T._flat_text(F.col("html")))
    plan = pieces._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"\bIN \(|\bINSET\b", plan)


def test_block_tags_of_any_spelling(texts):
    got = texts(T.clean_html, [
        "<H1>a</H1><Dl><Dt>k:</dT><dD>v</DD></Dl><lI class='x'>i<b>j</B></Li><P>p</p>t<i>u</i>",
        "<dt>k</dt><p></p><dd>x<h5>y</h5></dd>",
    ])
    assert got == ["a\n\nk: v\n\n• i j\n\np\n\nt\nu", "k:\n\nx y"]


def test_words_in_any_case_are_those_of_the_plain_pattern(texts):
    words = (*V.SECTION_STOPS, *fields.ALL_LABELS)
    odd = {"о": "\u1c82", "д": "\u1c81", "в": "\u1c80"}
    values = [f"- {v}: x" for w in words for v in (
        w, w.upper(), w.lower(), w[1:], w[0].swapcase() + w[1:], odd.get(w[0].lower(), "ы") + w[1:],
    )]
    plain = texts(lambda c: c.rlike("(?iu)" + T.any_of(words)), values)
    assert texts(lambda c: c.rlike(T.any_case_of(words)), values) == plain
    assert True in plain and False in plain


def test_normal_text_is_that_of_the_plain_patterns(texts):
    def plain(text):
        t = F.regexp_replace(text, r"\r\n?|[\x0B\f\x1C-\x1E\x85\u2028\u2029]", "\n")
        t = F.regexp_replace(t, r"[ \t\u00A0\u1680\u2000-\u200A\u202F\u205F\u3000]+", " ")
        return T.trim_lines(F.regexp_replace(t, r" ?\n[ \n]*", "\n"))

    marks = ["a", "•", " ", "\n", "\t", "\r", "\u00a0", "\u2003", "\u2028", "\u0085", "\u3000", "\u200b", "\r\n"]
    values = [x + y + z + w for x in marks for y in marks for z in marks for w in ("", " ", "\n", "b", "\u2003b")]
    assert texts(T.normal_text, values) == texts(plain, values)


def test_a_line_after_a_label_may_be_one_itself(texts):
    def named(text):
        return F.transform(fields.label_lines(text, V.LABELS_CITY + V.LABELS_AGE), lambda e: F.concat_ws("|", e.line, e.following))

    assert texts(named, ["Місто\nВІК 30\nx\ny", "x\nвік", "", "x"]) == [["Місто|ВІК 30", "ВІК 30|x"], ["вік"], [], []]


def test_pages_are_dealt_into_even_bounded_tasks(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "pages")
    spark.range(9000).selectExpr("id AS page_id", "concat('https://x/resumes/', id, '/') AS url", "'<p>x</p>' AS html").coalesce(1).write.parquet(path)
    monkeypatch.setattr(B, "corpus_path", lambda *_: path)
    monkeypatch.setattr(B, "PAGES_PER_TASK", 200)
    pages = B.profiles(spark, "unused")
    sizes = [r["count"] for r in pages.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 9000 and len(sizes) == 45 and max(sizes) < 400  # one file: one task of 9,000
