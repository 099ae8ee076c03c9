"""Explicit schemas of every stage; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, TEXTS = T.StringType(), T.ArrayType(T.StringType())
FLAG, INT, LONG, DOUBLE = T.BooleanType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, TIME = T.DateType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


PAGE = _struct(page_id=LONG, url=TEXT, html=TEXT)

PARSED = _struct(
    person_name=TEXT, resume_date=DATE, position=TEXT, salary=INT,
    full_time=FLAG, part_time=FLAG, from_home=FLAG, city=TEXT,
    ready_to_work=TEXTS, considered_positions=TEXTS, disability=TEXT,
    veteran=FLAG, birthday=DATE, work_experience=TEXT, education=TEXT,
    additional_education=TEXT, skills=TEXTS, languages=TEXTS,
    recommendations=TEXT, additional_info=TEXT,
)
META = _struct(parse_mode=TEXT, warnings=TEXTS, scraped_at=TIME)
WORK_ITEM = _struct(
    title=TEXT, company=TEXT, city=TEXT, industry=TEXT, start=TEXT, end=TEXT,
    months=INT, duties=TEXTS, duties_text=TEXT, block_text=TEXT,
)
EDUCATION_ITEM = _struct(
    place=TEXT, degree=TEXT, specialty=TEXT, start=TEXT, end=TEXT, months=INT, extra=TEXT
)
TITLE_MONTHS = _struct(
    position=TEXT, display_position=TEXT, months=INT, years=DOUBLE, titles=TEXTS
)
PROCESSED = _struct(
    driving_categories=TEXTS,
    normalized_skills=TEXTS,
    skill_months=T.MapType(TEXT, INT),
    work_experience_items=T.ArrayType(WORK_ITEM),
    education_items=T.ArrayType(EDUCATION_ITEM),
    total_work_years=DOUBLE,
    total_edu_years=DOUBLE,
    months_by_position=T.ArrayType(TITLE_MONTHS),
    extractor_warnings=TEXTS,
)
PAYLOAD = _struct(
    schema_version=TEXT, source_url=TEXT, raw_html=TEXT, cleaned_text=TEXT,
    parsed=PARSED, meta=META,
)
STORED = _struct(
    id=LONG, source_url=TEXT, resume_date=DATE, raw_html=TEXT, cleaned_text=TEXT,
    parse_mode=TEXT, warnings=TEXTS, parsed_json=PARSED, processed_json=PROCESSED,
    created_at=TIME, updated_at=TIME,
)
