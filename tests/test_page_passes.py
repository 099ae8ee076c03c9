"""Texts are passed over once and only where something may change; results stay those of the plain forms."""

from itertools import product

from pyspark.sql import functions as F

from dossierflow.functions import text as T
from dossierflow.functions import work as W
from dossierflow.operators import fields, select


def _plan(spark, made) -> str:
    return spark.createDataFrame([("",)], "t string").select(made(F.col("t")).alias("v"))._jdf.queryExecution().analyzed().toString()


def test_unsupported_pages_are_found_in_one_pass(spark, texts):
    assert _plan(spark, select.is_supported).count("RLIKE") == 1
    marks = ["файл резюме", "завантажити файл", "прикріплений \tфайл", "прикріплені файл", "• візитка", "візитка", "• ", "файл", "прикріплен файл", ""]
    values = [a + f(m) + b for m in marks for f in (str, str.upper, str.title) for a in ("", "x ", "\n") for b in ("", "\ny")]

    def plain(c):
        return ~(c.rlike(r"(?iu)файл резюме|завантажити файл|прикріплен(?:ий|і)\s+файл") | c.rlike(r"(?iu)• Візитка"))

    got = texts(select.is_supported, values)
    assert got == texts(plain, values) and set(got) == {True, False}


def test_a_heading_is_looked_for_once(spark):
    def named(c):
        return fields.name_position_columns(F.split(c, "\n"), c, F.lit(True))

    assert _plan(spark, named).count("title-print") == 1


def test_tidy_text_is_that_of_the_plain_patterns(spark, texts):
    def plain(text):
        t = F.replace(F.replace(text, F.lit(" "), F.lit(" ")), F.lit("​"), F.lit(""))
        t = F.regexp_replace(t, r"[ \t]{2,}", " ")
        t = F.regexp_replace(t, r"[ \t]?(\n)[ \t]?(?:(\n)[ \t\n]*)?", "$1$2")
        t = F.regexp_replace(F.regexp_replace(t, r"\n•[ \t\n]*\n", "\n"), r"(?m)^OK$\n?", "")
        return F.btrim(t, F.lit(" \t\n"))

    marks = ["a", "•", " ", "\n", "\t", "OK", "\r", " ", "​"]
    values = ["".join(p) + "z" for p in product(marks, repeat=5)]
    assert texts(T.tidy, values) == texts(plain, values)
    assert "\\n\\n\\n++" in _plan(spark, T.tidy) or "\n\n\n++" in _plan(spark, T.tidy)  # line ends alone need no groups


def test_salaries_and_veterans_in_any_case(texts):
    lines = ["12 000 грн", "12 000 ГРН", "12 000 Грн.", "12 000 гРн", "12 000 гр", "12 000"]
    assert texts(lambda c: fields.salary_column(F.array(c)), lines) == [12000] * 4 + [None] * 2
    heads = [f"<h1>x {w}</h1>" for w in ("ветеран", "Ветеран", "ВЕТЕРАН", "ᲀетеран", "ветер")]
    assert texts(fields.veteran_column, heads) == [True] * 4 + [False]


def test_blocks_are_cut_once(spark):
    assert _plan(spark, W.inline_blocks).count("array_join") == 1
    assert _plan(spark, W.title_blocks).count("split(") == 1


def test_a_text_without_years_has_no_inline_jobs(spark, texts):
    assert "CASE WHEN NOT" in _plan(spark, W.inline_blocks)
    values = ["Кухар (2001 – 2003) Кафе (Їжа)\nборщ", "x\nКухар (2010-НИНІ) Кафе", "Кухар (у 2010 - now) y", "Кухар (2001–\n2003)", "Кухар 2001 – 2003", "Кухар (now)", ""]
    got = [[(b.title, b.body) for b in blocks] for blocks in texts(W.inline_blocks, values)]
    assert got == [[("Кухар", "борщ")], [("Кухар", "")], [("Кухар", "")], [], [], [], []]


def test_pieces_of_markup_make_no_structs(spark, texts):
    assert "struct(" not in _plan(spark, T._flat_text)
    pages = ["<dt> k:: </dt> \n<dd>v<b>w</b>x</dd><dt></dt>t<DT>q</Dt>", "<LI> a<i>b </i></lI>\n\t<p></p><h2> h<br>i </h2>z<br>y<P/> w", " <br>a ", "", "<p>a</p> \n<dd></dd><li></li><h1></h1>"]
    assert texts(T._flat_text, pages) == [
        "\n\nk: v w x\n\n\n:\nt\n\nq:", "\n\n• a b\n\n\n\n\n\nh i\n\nz\ny\n\nw\n", "\na\n", "\n", "\n\na\n\n\n\n\n\n\n\n",
    ]
