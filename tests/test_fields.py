import datetime as dt

from pyspark.sql import functions as F

from dossierflow.operators import fields


def _text(spark, *texts):
    return spark.createDataFrame(
        [(f"u{i}", t, "", False) for i, t in enumerate(texts)],
        "source_url string, cleaned_text string, raw_html string, has_container boolean",
    )


def test_label_lookup_default_and_strict(spark):
    df = _text(spark, "Місто проживання: Київ\nнаступний", "• Місто\n• Львів", "Місто:\nx", "Місто", "Місто\nВік: 5")
    rows = fields.label_value(df, ["Місто"]).collect()
    assert [r.value for r in rows] == ["Київ", "Львів", None, None, "Вік: 5"]
    strict = fields.label_value(df, ["Місто"], strict=True).collect()
    assert [r.value for r in strict] == ["наступний", "Львів", "x", None, "Вік: 5"]


def test_employment_flags(spark):
    df = _text(spark, "Зайнятість: НЕПОВНА", "Вид зайнятості: повна, віддалена")
    flags = [(r.full_time, r.part_time, r.from_home) for r in fields.label_fields(df).collect()]
    assert flags == [(False, True, False), (True, False, True)]
    legacy = fields.label_fields(df, legacy_flags=True).collect()
    assert (legacy[0].full_time, legacy[0].part_time) == (True, True)


def test_dates(spark):
    df = _text(
        spark, "31 лютого 2020\nвід 26 СІЧНЯ 2026", "12 января 2026", "1 foo 2020", "x\n" * 20 + "1 мая 2020", ""
    )
    got = [r.resume_date for r in fields.profile_date(df).collect()]
    assert got == [dt.date(2026, 1, 26), dt.date(2026, 1, 12), None, None, None]
    timed = spark.createDataFrame(
        [("a", '<time datetime="2026-01-26 03:50:33">x</time>'), ("b", '<time datetime="2026-13-26">')],
        "source_url string, raw_html string",
    )
    found = fields.profile_date(timed, from_attribute=True).collect()
    assert [r.resume_date for r in found] == [dt.date(2026, 1, 26), None]


def test_salary_bounds(spark):
    df = _text(
        spark, "від 45\u00a0000 грн", "500 грн\n2000 грн", "Освіта 5000 грн", "2 000 000 грн", "1000 гривень",
    )
    assert [r.salary for r in fields.salary(df).collect()] == [45000, 2000, None, None, None]


def test_heading_salary(texts):
    rows = texts(fields.heading_salary, ["Водій (виїзний), 90\u00a0000 грн", "Кухар 15 000 грн", ""])
    assert [(r.position, r.salary) for r in rows] == [("Водій (виїзний)", 90000), ("Кухар", 15000), ("", None)]


def test_salary_tail(texts):
    got = texts(fields.without_salary_tail, ["Водій, 90 000 грн", "Кухар — 15 000 ГРН за місяць", "5000 грн", None])
    assert got == ["Водій", "Кухар", None, None]


def test_names_from_lines(spark):
    df = _text(
        spark, "Резюме від 1 мая 2020\nІван Франко ветеран\nВодій: так\nКухар шостого розряду",
        "Освіта\nодин два три чотири\na: b", "", "Петро",
    )
    got = [(r.person_name, r.position) for r in fields.name_position(df).collect()]
    assert got == [("Іван Франко", "Кухар шостого розряду"), ("unknown", None), ("unknown", None), ("Петро", None)]


def test_veteran(texts):
    pages = [
        "<h1>Іван <span>Ветеран</span></h1>", "<h1>Іван</h1><p>ВЕТЕРАН</p><h2>x</h2>",
        "<h1>Іван</h1><h2>x</h2><p>ветеран праці</p>", "<h1>І</h1><h2>x</h2><span class='a'> Ветеран </span>",
        "<h1>ветеранка</h1>", "",
        "<h1>І</h1><h2>x</h2><span>ветеран" + "<i></i>" * 40 + "</span>",
        "<h1>І</h1><h2>x</h2><span>ветеран" + "<i></i>" * 4000 + "праці</span>",
    ]
    assert texts(fields.veteran_column, pages) == [True, True, False, True, False, False, True, False]


def test_sections_contains_and_exact(spark):
    text = "Моя освіта тут\nа\nДодаткова освіта\nкурси\nОсвіта\nінститут\nЗнання мов\n• Англійська\n• Англійська"
    row = fields.sections(_text(spark, text)).first()
    assert row.education == "а" and row.additional_education == "курси"
    assert row.languages == ["Англійська"] and row.skills is None
    exact = fields.sections(_text(spark, text), exact=True).first()
    assert exact.education == "інститут"


def test_parsed_record(parse):
    row = parse("<h1>Ім'я</h1><h2>Досвід роботи</h2><p>x</p><h2 class='a title-print'>Кухар, 9 000 грн</h2>")
    assert row.parsed.position == "Кухар" and row.parsed.salary == 9000 and row.parsed.birthday is None
    assert row.meta.warnings == []
    nameless = parse("<p>а б в г д</p>")
    assert nameless.parsed.person_name == "unknown"
    assert nameless.meta.warnings == ["unknown_person_name"]


def test_age(texts):
    assert texts(fields.age_column, ["41 рік", "немає"]) == [41, None]


def test_limits_are_keywords(spark):
    from dossierflow.operators import fields as ops

    lines = ["Резюме", *[f"рядок {i}: x" for i in range(14)], "Ім'я Прізвище", *[f"мітка {i}: y" for i in range(7)], "П" * 130]
    lines += [f"поле {i}: z" for i in range(25)] + ["5 червня 2020", "12 500 грн"]
    page = spark.createDataFrame([("u", "\n".join(lines), "", False)], "source_url string, cleaned_text string, raw_html string, has_container boolean")

    def read(limits):
        np = ops.name_position(page, limits=limits).first()
        return (
            np.person_name, len(np.position or ""), ops.profile_date(page, limits=limits).first().resume_date,
            ops.salary(page, limits=limits).first().salary,
        )

    assert read(ops.Limits()) == ("unknown", 0, None, None)
    some = ops.Limits(name_lines=20, position_lines=9, date_lines=60, salary_lines=60)
    assert read(some)[:2] == ("Ім'я Прізвище", 120)
    none = ops.Limits(*[None] * 7)
    name, size, day, amount = read(none)
    assert (size, str(day), amount) == (130, "2020-06-05", 12500) and name == "Ім'я Прізвище"
    parsed = ops.parse_profiles(page, limits=none).select("parsed.*").first()
    assert (parsed.person_name, parsed.salary) == (name, 12500)
