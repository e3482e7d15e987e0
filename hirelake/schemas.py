"""Declared schemas; nothing is inferred from data."""

from pyspark.sql import types as T

_TEXT, _TEXTS = T.StringType(), T.ArrayType(T.StringType())


def _fields(spec: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in spec.items()])


# Column names and types of the stored tables, here and below.
# Raw postings of board A (missing text is '') and board B (missing text is null).
RAW_A = _fields({
    "job_id": _TEXT, "slug": _TEXT, "title": _TEXT, "job_url": _TEXT, "company_name": _TEXT,
    "company_url": _TEXT, "company_logo": _TEXT, "salary": _TEXT, "job_category": _TEXT,
    "working_model": _TEXT, "location": _TEXT, "skills": _TEXTS, "benefits": _TEXTS,
    "label": _TEXT, "posted_at": _TEXT, "source_page": T.LongType(), "scraped_at": _TEXT,
})
RAW_B = _fields({
    "job_id": _TEXT, "position": _TEXT, "tracking_id": _TEXT, "box_type": _TEXT, "title": _TEXT,
    "job_url": _TEXT, "salary": _TEXT, "city": _TEXT, "experience": _TEXT, "company_name": _TEXT,
    "company_url": _TEXT, "logo_url": _TEXT, "labels": _TEXTS, "visible_tags": _TEXTS,
    "remaining_tags": _TEXT, "posted_time": _TEXT, "updated_time": _TEXT, "apply_text": _TEXT,
    "apply_url": _TEXT, "is_hot": T.BooleanType(), "is_urgent": T.BooleanType(),
    "is_pro_company": T.BooleanType(), "is_verified": T.BooleanType(), "verification_level": _TEXT,
    "is_highlight": T.BooleanType(), "is_flash_job": T.BooleanType(),
    "is_diamond_employer": T.BooleanType(), "source_page": T.LongType(), "scraped_at": _TEXT,
})
# Cleaned postings, one row per job_id.
CLEAN_A = _fields({
    "job_id": _TEXT, "min_salary": T.DoubleType(), "max_salary": T.DoubleType(), "currency": _TEXT,
    "period": _TEXT, "parse_status": _TEXT, "title": _TEXT, "job_url": _TEXT, "company_name": _TEXT,
    "working_model": _TEXT, "location": _TEXT, "skills": _TEXTS, "benefits": _TEXTS,
    "posted_at": _TEXT, "scraped_at": T.TimestampType(),
})
CLEAN_B = _fields({
    "job_id": _TEXT, "job_url": _TEXT, "title": _TEXT, "city": _TEXT, "company_name": _TEXT,
    "apply_url": _TEXT, "verification_level": _TEXT, "salary_min": T.DoubleType(),
    "salary_max": T.DoubleType(), "salary_currency": _TEXT, "salary_period": _TEXT,
    "salary_parse_error": _TEXT, "scraped_at": T.TimestampType(), "role_group": _TEXT,
    "primary_role": _TEXT, "secondary_roles": _TEXTS, "seniority": _TEXT,
    "experience_years": T.DoubleType(), "skills": _TEXTS, "is_multi_role": T.BooleanType(),
    "parse_status": _TEXT, "parse_error": _TEXT,
})
