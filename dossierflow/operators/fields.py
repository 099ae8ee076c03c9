"""Profile fields from cleaned text and markup.

Extraction works on the *normal text* of a page (trimmed, non-empty lines joined
by newline): most fields are one multi-line pattern over it, so a page is read
inside its own row and no line table has to be shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierflow import schemas
from dossierflow.functions import text as T
from dossierflow.functions import vocabulary as V
from dossierflow.operators.common import reused, settle

_BULLET = r"(?:[•\-*] *)?"
_STOP = T.any_of(V.SECTION_STOPS)
_HOLDS_STOP = T.any_case_of(V.SECTION_STOPS)
_LETTER = "[A-Za-zА-Яа-яІіЇїЄєҐґ]"
_SALARY = r"(?uU)([0-9][0-9\s]{2,})\s*(?i:грн)\b"  # digits have no case
_CURRENCY = T.beginnings(("грн",))  # most lines hold none of these letters
_VETERAN = r"(?iuU)\bветеран\b"
_H1 = r"(?is)<h1(?:\s[^>]*)?>(.*?)</h1\s*>"
_H2 = r"(?is)<h2(?:\s[^>]*)?>(.*?)</h2\s*>"
_H2_TITLE = (
    r"""(?is)<h2\s[^>]*class\s*=\s*["'](?:[^"'>]*\s)?title-print(?:\s[^"'>]*)?["'][^>]*>(.*?)</h2\s*>"""
)


# --------------------------------------------------------------------------
# columns
# --------------------------------------------------------------------------
ALL_LABELS = (
    *V.LABELS_CITY, *V.LABELS_EMPLOYMENT, *V.LABELS_AGE, *V.LABELS_READY, *V.LABELS_CONSIDERED
)


def label_lines(text: Column, labels) -> Column:
    """Lines of normal text that name any of the labels, each with the line after it."""
    pairs = F.regexp_extract_all(text, F.lit(rf"(?md)^(?=(.*{T.any_case_of(labels)}.*+(?:\n.*+)?))"), F.lit(1))
    return F.transform(
        pairs, lambda x: F.struct(
            F.substring_index(x, "\n", 1).alias("line"),
            F.when(F.contains(x, F.lit("\n")), F.substring_index(x, "\n", -1)).alias("following"),
        )
    )


def label_column(named: Column, labels, *, strict: bool = False) -> Column:
    """Value of the first of the :func:`label_lines` with these labels, null when
    empty.

    ``Label: value`` gives the right side; a label without a colon gives the
    next line. ``strict`` always takes the next line.
    """
    label = T.any_case_of(labels)
    next_line = lambda e: T.without_bullet(e.following)

    def usable(e: Column) -> Column:
        return e.line.rlike(label) & (
            e.following.isNotNull() if strict else (e.following.isNotNull() | same_line(e))
        )

    def same_line(e: Column) -> Column:
        return e.line.contains(":") & F.substring_index(e.line, ":", 1).rlike(label)

    def value(e: Column) -> Column:
        if strict:
            return next_line(e)
        right = F.substr(e.line, F.instr(e.line, ":") + 1)
        return T.trim(F.when(same_line(e), right).otherwise(next_line(e)))

    return T.let(
        F.get(F.filter(named, usable), F.lit(0)), lambda e: T.let(value(e), T.blank_to_null)
    )


def employment_columns(value: Column, *, legacy_flags: bool = False) -> dict[str, Column]:
    """Full time, part time, remote. ``legacy_flags``: part time implies full time."""
    v = F.coalesce(value, F.lit(""))
    full = v.rlike("(?iu)повна") if legacy_flags else v.rlike(r"(?iuU)\bповна")
    return {
        "full_time": full,
        "part_time": v.rlike("(?iu)неповна"),
        "from_home": v.rlike("(?iu)віддал"),
    }


def age_column(value: Column) -> Column:
    return T.blank_to_null(F.regexp_extract(value, "([0-9]{1,2})", 1)).try_cast("int")


def is_section_title(line: Column) -> Column:
    return line.rlike(_HOLDS_STOP)


def markup_text(html: Column, pattern: str) -> Column:
    """Text of the first element matching ``pattern`` (its group 1)."""
    inner = F.regexp_replace(F.regexp_extract(html, pattern, 1), "<[^>]*>", " ")
    plain = T.let(inner, T.decode_entities)
    return T.trim(F.regexp_replace(plain, T.SPACES + "+", " "))


def clean_name(name: Column) -> Column:
    plain = F.regexp_replace(F.coalesce(name, F.lit("")), _VETERAN, "")
    plain = T.trim(F.regexp_replace(plain, "[ \\t\\u00a0]+", " "))
    return T.let(plain, lambda n: F.when(n == "", V.UNKNOWN_NAME).otherwise(n))


@dataclass(frozen=True)
class Limits:
    """How far fields are searched; None is without limit."""

    name_lines: int | None = V.NAME_SCAN_LINES
    name_words: int | None = V.NAME_MAX_WORDS
    name_chars: int | None = V.NAME_MAX_CHARS
    position_lines: int | None = V.POSITION_SCAN_LINES  # after the name
    position_chars: int | None = V.POSITION_MAX_CHARS
    date_lines: int | None = V.DATE_SCAN_LINES
    salary_lines: int | None = V.SALARY_SCAN_LINES


def _first_lines(lines: Column, count: int | None, skip: Column | int = 0) -> Column:
    start = (F.lit(skip) if isinstance(skip, int) else skip) + 1
    return F.slice(lines, start, F.size(lines) if count is None else F.lit(count))


def name_position_columns(lines: Column, html: Column, has_container: Column, limits: Limits = Limits()) -> Column:
    """``struct<person_name, position>``; markup first, then the first lines."""
    first = F.when(F.contains(F.lower(F.get(lines, F.lit(0))), F.lit("резюме")), 1).otherwise(0)
    whole = None in (limits.name_lines, limits.position_lines)
    reach = None if whole else limits.name_lines + limits.position_lines
    top = F.transform(_first_lines(lines, reach, first), lambda x: T.without_bullet(x))

    def usable(line: Column) -> Column:
        return (line != "") & ~is_section_title(line) & ~F.contains(line, F.lit(":"))

    def name_like(line: Column) -> Column:
        like = usable(line) & line.rlike(_LETTER)
        if limits.name_words is not None:
            like &= F.size(F.split(line, " ")) <= limits.name_words
        return like if limits.name_chars is None else like & (F.length(line) <= limits.name_chars)

    def read(t: Column) -> Column:
        numbered = F.transform(t, lambda x, i: F.struct(i.alias("i"), x.alias("x")))
        hit = F.get(
            F.filter(_first_lines(numbered, limits.name_lines), lambda e: name_like(e.x)), F.lit(0)
        )

        def position(h: Column) -> Column:
            after = F.coalesce(h.i, F.size(t) if reach is None else F.lit(reach)) + 1
            found = F.get(F.filter(_first_lines(t, limits.position_lines, after), usable), F.lit(0))
            return found if limits.position_chars is None else F.left(found, F.lit(limits.position_chars))

        return T.let(hit, lambda h: F.struct(h.x.alias("name"), position(h).alias("position")))

    from_lines = T.let(top, read)
    h1 = F.when(has_container, clean_name(markup_text(html, _H1))).otherwise(F.lit(V.UNKNOWN_NAME))
    h2 = F.when(
        has_container,
        F.coalesce(
            T.let(markup_text(html, _H2_TITLE), T.blank_to_null), T.let(markup_text(html, _H2), T.blank_to_null)
        ),
    )
    def choose(n: Column) -> Column:
        # the first lines are read only when the markup names nobody or nothing
        return T.let(
            F.when((n.h1 == V.UNKNOWN_NAME) | n.h2.isNull(), from_lines),
            lambda top: F.struct(
                F.when(n.h1 != V.UNKNOWN_NAME, n.h1).otherwise(clean_name(top["name"])).alias("person_name"),
                F.coalesce(n.h2, top["position"]).alias("position"),
            ),
        )

    return T.let(F.struct(h1.alias("h1"), h2.alias("h2")), choose)


def date_column(lines: Column, limits: Limits = Limits()) -> Column:
    """First valid ``D month YYYY`` among the first lines."""
    months = T.literal_map({
        name: i
        for names in (V.MONTHS_GENITIVE_UA, V.MONTHS_GENITIVE_RU)
        for i, name in enumerate(names, 1)
    })

    written = rf"([0-9]{{1,2}}\s+{_LETTER}+\s+[0-9]{{4}})"

    def day(line: Column) -> Column:
        return T.let(
            F.split(F.regexp_extract(line, written, 1), r"\s+"),
            lambda p: T.let(
                F.element_at(months, F.lower(F.get(p, F.lit(1)))),
                lambda month: F.when(
                    month.isNotNull(),
                    F.to_date(F.try_to_timestamp(
                        F.concat_ws(
                            "-", F.get(p, F.lit(2)), F.lpad(month.cast("string"), 2, "0"),
                            F.lpad(F.get(p, F.lit(0)), 2, "0"),
                        ),
                        F.lit("yyyy-MM-dd"),
                    )),
                ),
            ),
        )

    dated = F.filter(_first_lines(lines, limits.date_lines), lambda x: x.rlike(written))
    return T.first(F.filter(F.transform(dated, day), lambda d: d.isNotNull()))


def date_attribute_column(html: Column) -> Column:
    """Date of the first ``<time datetime="...">``."""
    value = F.regexp_extract(
        html, r"""(?is)<time\s[^>]*datetime\s*=\s*["']\s*([0-9]{4}-[0-9]{2}-[0-9]{2})""", 1
    )
    return F.to_date(F.try_to_timestamp(value, F.lit("yyyy-MM-dd")))


def _amount(text: Column, pattern: str) -> Column:
    return F.regexp_replace(F.regexp_extract(text, pattern, 1), r"(?U)\s+", "").try_cast("int")


def salary_column(lines: Column, limits: Limits = Limits()) -> Column:
    """First plausible amount before the currency word near the top."""
    amounts = F.transform(
        _first_lines(lines, limits.salary_lines),
        lambda x: F.when(T.holds(x, *_CURRENCY) & x.rlike(_SALARY) & ~is_section_title(x), _amount(x, _SALARY)),
    )
    plausible = F.filter(amounts, lambda a: a.between(V.SALARY_MIN, V.SALARY_MAX))
    return T.first(plausible)


def without_salary_tail(position: Column) -> Column:
    p = T.trim(F.regexp_replace(position, "[ \\t\\u00a0]+", " "))
    p = F.regexp_replace(p, r"(?iuUs)[\s,–—-]*[0-9][0-9\s]{2,}\s*грн\b.*$", "")
    return T.blank_to_null(T.trim(p))


def heading_salary(heading: Column) -> Column:
    """``struct<position, salary>`` of a heading such as ``Водій, 90 000 грн``."""
    t = T.trim(F.regexp_replace(F.coalesce(heading, F.lit("")), "[ \\t\\u00a0]+", " "))
    return T.let(
        t,
        lambda h: F.struct(
            F.when(F.contains(h, F.lit(",")), T.trim(F.substring_index(h, ",", 1)))
            .otherwise(T.trim(F.regexp_replace(h, r"(?iuUs)\s*[0-9][0-9\s]*\s*грн.*$", "")))
            .alias("position"),
            _amount(h, r"(?iuU)([0-9][0-9\s]*)\s*грн").alias("salary"),
        ),
    )


def veteran_column(html: Column) -> Column:
    """Badge word in the first heading, between it and the next one, or as the
    whole text of a span, div or link."""
    h = F.coalesce(html, F.lit(""))
    near = F.regexp_extract(h, r"(?is)(<h1[\s>].*?)(?:<h[2-6][\s>]|$)", 1)
    near = F.regexp_replace(F.regexp_replace(near, T.INVISIBLE, " "), "<[^>]*>", " ")
    badge = (
        r"(?iuU)<(span|div|a)(?:\s[^>]*)?>(?:\s|&nbsp;|<[^/][^>]*>)*+ветеран(?:\s|&nbsp;|<(?!/\1\s*>)[^>]*>)*+</\1\s*>"
    )
    return h.rlike(T.any_case_of(("ветеран",))) & (near.rlike(_VETERAN) | h.rlike(badge))


def section_parts(text: Column, *, exact: bool = False) -> Column:
    """``array<struct<head, part>>``: text from every section title, its line first. A title is
    any line that contains one; ``exact`` asks for whole lines."""
    if exact:
        title = rf"(?iumd)^(?={_BULLET}{_STOP} *:?$)"
    else:
        # a title that contains another is found through the shorter one
        words = [w for w in V.SECTION_STOPS if not any(
            o != w and o.lower() in w.lower() for o in V.SECTION_STOPS)]
        title = rf"(?md)^(?=.*{T.any_case_of(words)})"
    cut = F.split(F.regexp_replace(text, title, T.MARK), T.MARK)
    return T.let(cut, lambda parts: F.transform(
        F.slice(parts, F.lit(2), F.size(parts)),
        lambda p: F.struct(F.substring_index(p, "\n", 1).alias("head"), p.alias("part")),
    ))


def section_column(parts: Column, titles, *, exact: bool = False) -> Column:
    """Lines between the first line with one of the titles and the next section
    title, from :func:`section_parts`; null when empty."""

    def opens(e: Column) -> Column:
        if exact:
            return e["head"].rlike(rf"(?iu)^{_BULLET}{T.any_of(titles)} *:?$")
        return e["head"].rlike(T.any_case_of(titles))

    found = F.get(F.filter(parts, opens), F.lit(0))
    return T.let(
        found, lambda e: T.blank_to_null(T.trim_lines(F.substr(e.part, F.length(e["head"]) + 2)))
    )


def bullet_items(section: Column) -> Column:
    """Distinct bullet-free lines of a section; null when there are none."""
    items = F.array_distinct(
        F.filter(
            F.transform(F.split(section, "\n"), lambda x: T.trim(T.without_bullet(x))),
            lambda x: x != "",
        )
    )
    return F.when(F.size(items) > 0, items)


def first_line(section: Column) -> Column:
    return F.substring_index(section, "\n", 1)


SECTIONS = {
    "work_experience": (V.SECTION_WORK,),
    "education": (V.SECTION_EDUCATION,),
    "additional_education": (V.SECTION_MORE_EDUCATION,),
    "skills": (V.SECTION_SKILLS,),
    "languages": (V.SECTION_LANGUAGES,),
    "recommendations": (V.SECTION_RECOMMENDATIONS,),
    "additional_info": (V.SECTION_MORE_INFO,),
    "disability": (V.SECTION_DISABILITY,),
}


def section_columns(parts: Column, *, exact: bool = False) -> dict[str, Column]:
    made = {name: section_column(parts, titles, exact=exact) for name, titles in SECTIONS.items()}
    made["skills"] = T.let(made["skills"], bullet_items)
    made["languages"] = T.let(made["languages"], bullet_items)
    made["disability"] = first_line(made["disability"])
    return made


# --------------------------------------------------------------------------
# jobs
# --------------------------------------------------------------------------
def _with_text(df: DataFrame, text: str) -> DataFrame:
    """Settle the normal text (``_text``); ``_lines`` are its lines."""
    normal = settle(df, _text=T.normal_text(F.col(text)))
    return normal.withColumn(
        "_lines", F.when(F.col("_text") == "", F.array().cast("array<string>")).otherwise(F.split("_text", "\n"))
    )


def label_value(
    df: DataFrame, labels, *, text: str = "cleaned_text", out: str = "value", strict: bool = False
) -> DataFrame:
    """Add the value of the first line with one of the labels."""
    found = settle(_with_text(df, text), _named=label_lines(F.col("_text"), labels))
    value = label_column(F.col("_named"), labels, strict=strict)
    return found.withColumn(out, value).select(*df.columns, out)


def label_field_columns(named: Column, employment: Column, *, strict: bool, legacy_flags: bool) -> dict[str, Column]:
    """``employment``: the value of its label, settled, as three flags read it."""
    return {
        "city": label_column(named, V.LABELS_CITY, strict=strict),
        "ready_to_work": T.comma_items(label_column(named, V.LABELS_READY)),
        "considered_positions": T.comma_items(label_column(named, V.LABELS_CONSIDERED)),
        **employment_columns(employment, legacy_flags=legacy_flags),
        "age": age_column(label_column(named, V.LABELS_AGE, strict=strict)),
    }


def label_fields(
    df: DataFrame, *, text: str = "cleaned_text", keys: tuple[str, ...] = ("source_url",),
    strict: bool = False, legacy_flags: bool = False,
) -> DataFrame:
    """City, ready-to-work cities, considered positions, employment flags, age."""
    made = label_field_columns(F.col("_named"), F.col("_employment"), strict=strict, legacy_flags=legacy_flags)
    found = settle(_with_text(df, text), _named=label_lines(F.col("_text"), ALL_LABELS))
    found = settle(found, _employment=label_column(F.col("_named"), V.LABELS_EMPLOYMENT, strict=strict))
    return found.select(*keys, *[c.alias(n) for n, c in made.items()])


def name_position(
    df: DataFrame, *, text: str = "cleaned_text", html: str = "raw_html",
    keys: tuple[str, ...] = ("source_url",), limits: Limits = Limits(),
) -> DataFrame:
    """Name and position, from the headings or the first lines."""
    made = name_position_columns(F.col("_lines"), F.col(html), F.col("has_container"), limits)
    return settle(_with_text(df, text), _np=made).select(
        *keys, F.col("_np.person_name"), F.col("_np.position")
    )


def profile_date(
    df: DataFrame, *, text: str = "cleaned_text", html: str = "raw_html",
    keys: tuple[str, ...] = ("source_url",), from_attribute: bool = False, limits: Limits = Limits(),
) -> DataFrame:
    """Publication date from visible text, or from the ``time`` element on request."""
    if from_attribute:
        return df.select(*keys, date_attribute_column(F.col(html)).alias("resume_date"))
    return _with_text(df, text).select(*keys, date_column(F.col("_lines"), limits).alias("resume_date"))


def salary(
    df: DataFrame, *, text: str = "cleaned_text", html: str = "raw_html",
    keys: tuple[str, ...] = ("source_url",), limits: Limits = Limits(),
) -> DataFrame:
    """Salary, and the position without its salary tail."""
    named = name_position_columns(F.col("_lines"), F.col(html), F.col("has_container"), limits)
    return _with_text(df, text).select(
        *keys,
        salary_column(F.col("_lines"), limits).alias("salary"),
        without_salary_tail(named.position).alias("position"),
    )


def veteran(
    df: DataFrame, *, html: str = "raw_html", keys: tuple[str, ...] = ("source_url",)
) -> DataFrame:
    return df.select(*keys, veteran_column(F.col(html)).alias("veteran"))


def sections(
    df: DataFrame, *, text: str = "cleaned_text", keys: tuple[str, ...] = ("source_url",),
    exact: bool = False,
) -> DataFrame:
    """The eight sections; skills and languages as lists, disability as one line."""
    made = section_columns(F.col("_parts"), exact=exact)
    cut = settle(_with_text(df, text), _parts=section_parts(F.col("_text"), exact=exact))
    return cut.select(*keys, *[c.alias(n) for n, c in made.items()])


@reused
def _found(html: str, exact_sections: bool, limits: Limits) -> dict[str, Column]:
    lines = F.col("_lines")
    return {
        "_np": name_position_columns(lines, F.col(html), F.col("has_container"), limits),
        "_named": label_lines(F.col("_text"), ALL_LABELS),
        "_parts": section_parts(F.col("_text"), exact=exact_sections),
    }


@reused
def _employment(strict_labels: bool) -> Column:
    return label_column(F.col("_named"), V.LABELS_EMPLOYMENT, strict=strict_labels)


@reused
def _record(html: str, strict_labels: bool, legacy_flags: bool, exact_sections: bool, limits: Limits) -> Column:
    lines = F.col("_lines")
    labels = label_field_columns(F.col("_named"), F.col("_employed"), strict=strict_labels, legacy_flags=legacy_flags)
    made = {
        "person_name": F.col("_np.person_name"),
        "resume_date": date_column(lines, limits),
        "position": without_salary_tail(F.col("_np.position")),
        "salary": salary_column(lines, limits),
        "veteran": veteran_column(F.col(html)),
        "birthday": F.lit(None).cast("date"),
        **labels,
        **section_columns(F.col("_parts"), exact=exact_sections),
    }
    return F.struct(*[made[n].alias(n) for n in schemas.PARSED.names])


def parse_profiles(
    df: DataFrame, *, text: str = "cleaned_text", html: str = "raw_html",
    strict_labels: bool = False, legacy_flags: bool = False, exact_sections: bool = False,
    limits: Limits = Limits(),
) -> DataFrame:
    """Add ``parsed``, the 20-field record, to cleaned pages. ``limits``: how far fields are
    searched for, None in it for everywhere."""
    staged = settle(_with_text(df, text), **_found(html, exact_sections, limits))
    staged = settle(staged, _employed=_employment(strict_labels))
    record = _record(html, strict_labels, legacy_flags, exact_sections, limits)
    return settle(staged, parsed=record).select(*df.columns, "parsed")
