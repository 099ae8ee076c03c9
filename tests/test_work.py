import random
import re
import time

import pytest
from pyspark.sql import functions as F

from dossierflow.functions import dates as D
from dossierflow.functions import education as E
from dossierflow.functions import skills as S
from dossierflow.functions import text as T
from dossierflow.functions import work as W
from dossierflow.operators import work


def test_golden_record(parse):
    row = parse(
        "<h1>Олександр</h1><h2 class='title-print'>Водій</h2><h2>Досвід роботи</h2><p>Механік,водий, слесарь</p>"
        "<p>з 05.1997 по 10.2020 (23 роки 6 місяців) ч/п (Автобізнес та автосервіс)</p><h2>Знання і навички</h2>"
        "<ul><li>Адаптивність</li><li>Водий</li><li>Водий в</li><li>В д</li></ul>"
    )
    p = row.processed
    (job,) = p.work_experience_items
    assert (job.start, job.end, job.months, job.company, job.city, job.industry) == (
        "1997-05", "2020-10", 282, "ч/п", None, "Автобізнес та автосервіс"
    )
    assert job.duties == [] and job.duties_text == ""
    (title,) = p.months_by_position
    assert (title.position, title.display_position, title.months, title.years) == (
        "механік водий слесарь", "Механік,водий, слесарь", 282, 23.5
    )
    assert p.total_work_years == 23.5 and p.total_edu_years is None
    assert p.normalized_skills == ["адаптивність", "водий", "водий в", "в д"]
    assert p.driving_categories == [] and p.skill_months is None and p.education_items is None
    assert p.extractor_warnings == []


# -- texts built from the result they must give ------------------------------
def test_blocks_are_found_in_built_texts(texts):
    rng = random.Random(3)
    dates = lambda: f"з 01.2000 по 02.2001 x{rng.random()}"
    long_line = lambda: "длинный " + "x" * 90 + str(rng.random())
    samples, expected = [], []
    for _ in range(600):
        lines = [long_line() for _ in range(rng.randint(0, 2))]
        if lines and rng.random() < 0.5:
            lines += [dates(), "lost"]  # dates below no title start nothing
        blocks = []
        for k in range(rng.randint(0, 4)):
            body = [rng.choice([long_line(), f"t{rng.random()}", f"c. {k}"]) for _ in range(rng.randint(0, 4))]
            block = (f"title {k}", dates(), "\n".join(body))
            lines += [*block[:2], *body]
            if body and len(body[-1]) > 80 and rng.random() < 0.4:
                lines += [dates(), "lost", "lost"]  # ends the block, and what follows belongs to none
            blocks.append(block)
        samples.append("\n".join(lines))
        expected.append(blocks)
    got = texts(W.title_blocks, samples)
    assert [[(b.title, b["head"], b.body) for b in blocks] for blocks in got] == expected


def _nested(rng, depth):
    inner = "".join(rng.choice(["a", ",", ".", ";", " "]) for _ in range(rng.randint(0, 3)))
    return inner if not depth else f"{inner}({_nested(rng, depth - 1)}){inner}"


@pytest.mark.parametrize("depth", [0, 1, 4, 9])
def test_pieces_are_found_in_built_texts(texts, depth):
    rng = random.Random(5)
    samples, expected = [], []
    for _ in range(300):
        pieces = [
            rng.choice(["", "a", "b)", f"a({_nested(rng, rng.randint(0, depth))})b", " b a "])
            for _ in range(rng.randint(1, 6))
        ]
        if rng.random() < 0.3:
            pieces.append("a(" + _nested(rng, depth) + ", rest; of (it")  # never closed
        samples.append("".join(p + rng.choice(",.;") for p in pieces[:-1]) + pieces[-1])
        expected.append([p.strip() for p in pieces if p.strip()])
    assert texts(lambda c: W.split_outside_parens(c, ",.;"), samples) == expected


def test_duties(texts):
    cases = [
        ("готую, мию (все, що є), прання", ["готую", "мию (все, що є)", "прання"]),
        ("Обов'язки: готую, мию. Прання; сон", ["готую, мию", "Прання", "сон"]),
        ("ОБОВ'ЯЗКИ:", []),
        ("раз два три чотири пять шість сім вісім девять, десять. Кінець", [
            "раз два три чотири пять шість сім вісім девять, десять", "Кінець"]),
        ("• a, b", ["a, b"]),
        ("-a", ["-a"]),
        ("", []),
        ("a - , – b", ["a", "b"]),
    ]
    assert texts(W.block_duties, [c for c, _ in cases]) == [w for _, w in cases]


def test_bullets_by_line_are_optional(spark):
    df = spark.createDataFrame([("u", 0, "• a, b\n• c", )], "source_url string, item_no int, duties_text string")
    assert [r.duty for r in work.split_duties(df).collect()] == ["a, b • c"]
    assert [r.duty for r in work.split_duties(df, line_bullets=True).collect()] == ["a, b", "c"]


def test_dates_line(texts):
    rows = texts(W.dates_fields, [
        "з 10.2019 по 02.2022 (2 роки 5 місяців) Ostriv, Киев (Розничная торговля)",
        "з 01.2004 по нині (22 роки) Власне авто (Приватні особи)",
        "з 01.2004 по 05.2005 Завод, ТОВ (Збут)",  # no duration: the paren is the industry
        "з 01.2004 по 05.2005 (1 рік) ЛК Юкрейн, Груп Три Слова (Обл) (Збут)",
        "з 01.2004 до теперішнього часу (22 роки) X",
    ])
    assert [tuple(r) for r in rows] == [
        ("2019-10", "2022-02", "Ostriv", "Киев", "Розничная торговля"),
        ("2004-01", "present", "Власне авто", None, "Приватні особи"),
        ("2004-01", "2005-05", "Завод, ТОВ", None, "Збут"),
        ("2004-01", "2005-05", "ЛК Юкрейн, Груп Три Слова", "Обл", "Збут"),
        ("2004-01", "", "X", None, None),
    ]


def test_months(spark):
    rows = spark.createDataFrame(
        [("2018-03", "2018-03"), ("2018-03", "2019-06"), ("2019-06", "2018-03"), (None, "2018-01"),
         ("2025-12", "present"), ("04.2017", "квітень 2018"), ("апрель 2017", "груд 2017"), ("листопада 2017", "x"),
         ("2018-01", "2018-13")],
        "start string, end string",
    )
    got = [r.months for r in work.span_months(rows, as_of="2026-01-15").collect()]
    assert got == [1, 16, 0, 0, 2, 13, 9, 0, 13]


def test_years_round_like_python(spark):
    rows = spark.range(1, 1200).select(D.years_1dp(F.col("id")).alias("y")).collect()
    assert [r.y for r in rows] == [float(f"{m / 12.0:.1f}") for m in range(1, 1200)]


def test_roles(texts):
    def roles(c):
        return F.transform(W.with_roles(F.array(W.entry("block", F.lit("Кухар / Водій"), F.lit("d"), c, c))),
                           lambda e: F.concat_ws("=", e.title, e.body))

    got = texts(roles, [
        "Водій: їжджу; мию. КУХАР - готую", "Кухар: готую. І ще", "Кухар: Водій: x", "Кухарка: a Водій: b",
    ])
    assert got[0] == ["Водій=їжджу; мию.", "Кухар=готую"]
    assert got[1] == ["Кухар / Водій=Кухар: готую. І ще"]
    assert got[2] == ["Кухар / Водій=Кухар: Водій: x"]
    assert got[3] == ["Кухар / Водій=Кухарка: a Водій: b"]
    quoted = texts(lambda c: W.role_segments(F.lit(r"C++ (\E) / Q.A"), c), [r"Q.A: b C++ (\E): a"])
    assert [tuple(s) for s in quoted[0]] == [("Q.A", "b"), (r"C++ (\E)", "a")]


def test_fallback_layouts(parse):
    inline = parse(
        "<h2>Досвід роботи</h2><p>Кур’єр / водій (2020 – 2025) Some Company (Industry)</p><p>a, b. A; c</p>"
        "<p>• d, e</p><p>2001-2002 щось</p><p>не моє</p><p>Інший (2019-НИНІ) X</p>"
    ).processed.work_experience_items
    assert [(j.title, j.start, j.end, j.months, j.company, j.industry) for j in inline] == [
        ("Кур’єр / водій", "2020-01", "2025-12", 72, "Some Company", "Industry"),
        ("Інший", "2019-01", "present", 85, "X", None),
    ]
    assert inline[0].duties == ["a", "b", "c", "d, e"]
    assert inline[0].block_text.startswith("Кур’єр / водій (2020 – 2025)") and inline[0].block_text.endswith("• d, e")
    lines = parse(
        "<h2>Досвід роботи</h2><p>з 01.05.97 по 01.10.2020 - слюсар, майстер, ТОВ \"Рога\"</p>"
        "<p>з 03.2021р. по дотепер - токар ДП Завод</p>"
    ).processed.work_experience_items
    assert [(j.title, j.company, j.start, j.end, j.months) for j in lines] == [
        ("слюсар, майстер", 'ТОВ "Рога"', "1997-05", "2020-10", 0),
        ("токар", "ДП Завод", "2021-03", "present", 0),
    ]


def test_education(texts):
    items = texts(E.study_items, [
        "шум\nз 1983 по 1990 вища\nНаціональний університет\nПраво\nКНТУ. Економіка, Київ з 1991 по 1995\nЩе",
        "Київський інститут\nз 2000 по 2002, середня\nдо 1\nУЖ з 2003 по 2001 higher",
        "",
    ])
    assert [(i.place, i.degree, i.specialty, i.start, i.end, i.months, i.extra) for i in items[0]] == [
        ("з", "вища", "", "1983-01", "1990-12", 96, "вища"),
        ("КНТУ.", "", "Економіка", "1991-01", "1995-12", 60, "Ще"),
    ]
    (second,) = items[1]  # the later line with years wins
    assert (second.place, second.degree, second.start, second.months) == ("УЖ", "вища", "2003-01", 0)
    assert items[2] == []


def test_languages_and_categories(texts):
    langs = texts(S.language_items, [
        ["Англійська — середній", "Deutsch B2", "Polski: вільно", "English upper intermediate", "— x",
         "Англійська — середній", "Français"],
    ], "array<string>")[0]
    assert [(x.language, x.level) for x in langs] == [
        ("Англійська", "середній"), ("Deutsch", "вище середнього"), ("Polski", "вільно"),
        ("English", "вище середнього"), ("Français", None),
    ]
    none = F.lit(None).cast("array<string>")
    cats = texts(lambda c: S.categories(c, none), [["DE", "кат. b", "КАТ C", "В д", "кат. В"], ["ABC", "a"], None], "array<string>")
    assert cats == [["B", "C", "DE"], [], []]
    keys = texts(lambda c: S.categories(none, c), [["кат. ce", "b"]], "array<string>")
    assert keys == [["CE"]]


def test_languages_do_not_lose_the_jobs(parse):
    row = parse(
        "<h2>Досвід роботи</h2><p>Кухар</p><p>з 01.2020 по 02.2020 x</p><h2>Знання мов</h2><p>Англійська</p>"
    )
    assert len(row.processed.work_experience_items) == 1


def test_missing_title_takes_position(spark):
    df = spark.createDataFrame(
        [("a", "з 01.2020 по 02.2021 - ТОВ Рога", "Кухар"),
         ("b", "з 01.2020 по 02.2021 - ТОВ Рога\nПосада: Токар", None)],
        "source_url string, work_experience string, position string",
    )
    got = {r.source_url: r.title for r in work.work_items(df, as_of="2026-01-01").collect()}
    assert got == {"a": "Кухар", "b": "Токар"}


def test_long_text_is_linear(texts):
    long = ", ".join(f"справа {i} (а, б)" for i in range(20000))
    (pieces,) = texts(W.block_duties, [long])
    assert len(pieces) == 20000
    (blocks,) = texts(W.title_blocks, ["\n".join(f"t{i}\nз 01.2000 по 02.2001 x\nbody" for i in range(5000))])
    assert len(blocks) == 5000


def test_hostile_texts_are_linear(texts):
    start = time.monotonic()
    deep = "a, " + "(" * 700 + "x, y" + ")" * 700 + ", b"
    opened, nested, both = texts(lambda c: W.split_outside_parens(c, ","), ["a, b " + "(" * 32000, deep, "), ".join("c" * 600) + " (d, e"])
    assert opened == ["a", "b " + "(" * 32000]
    assert nested == ["a", "(" * 700 + "x, y" + ")" * 700, "b"]
    assert len(both) == 600 and both[-1] == "c (d, e"
    lines = [f"рядок {i}" for i in range(20000)]
    (studies,) = texts(E.study_items, ["Київський національний університет\n" + "\n".join(lines)])
    assert len(studies) == 1 and studies[0].extra == " ".join(lines[1:])
    assert time.monotonic() - start < 30


def test_impossible_years_are_flagged_not_fatal(parse):
    row = parse("<h2>Освіта</h2><p>КНТУ з 0000 по 1990</p><h2>Знання і навички</h2><ul><li>a</li></ul>").processed
    assert row.extractor_warnings == ["processing_failed"] and row.normalized_skills == ["a"]
