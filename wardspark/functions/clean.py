"""Cleaning and checking of raw text fields. Every parse is a ``try_*`` form."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wardspark.schemas import DATA_SPLITS, SEXES, STUDY_LABELS

PATIENT_ID_PATTERN = "^PAT-[A-Za-z0-9]{6,12}$"


def category(text: Column) -> Column:
    return F.lower(F.trim(text))


def known(value: Column, allowed: tuple[str, ...]) -> Column:
    """Membership that is false, not null, for a null value."""
    return F.coalesce(value.isin(*allowed), F.lit(False))


def timestamp(text: Column) -> Column:
    """ISO date and time as UTC; an offset or ``Z`` is honoured, bad text gives null.

    Text without an offset counts as session time, which ``build_session`` sets to UTC.
    """
    dated = F.when(text.rlike(r"^\s*\d{4}-\d"), F.trim(text))
    return dated.try_cast("timestamp").cast("timestamp_ntz")


def int_or_zero(text: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(text), F.lit("")).try_cast("int"), F.lit(0))


def shorten(text: Column, length: int = 120) -> Column:
    body = F.coalesce(text, F.lit(""))
    return F.concat(
        F.substring(body, 1, length),
        F.when(F.char_length(body) > length, F.lit("…")).otherwise(F.lit("")),
    )


def study_problems() -> Column:
    """Names of the rules a cleaned study row breaks; an empty array means valid."""
    rules = [
        ("study_id", F.col("study_id").isNull()),
        ("patient_id", F.col("patient_id").isNull()),
        ("file_path", F.col("file_path").isNull()),
        ("label", ~known(F.col("label"), STUDY_LABELS)),
        ("split", ~known(F.col("split"), DATA_SPLITS)),
        ("captured_at", F.col("captured_at").isNull()),
    ]
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules]))


def patient_problems(site_known: Column) -> Column:
    """Names of the rules a patient record breaks. ``site_known``: an active site exists."""
    pid = F.trim(F.coalesce(F.col("patient_id"), F.lit("")))
    name = F.trim(F.coalesce(F.col("display_name"), F.lit("")))
    age = F.trim(F.coalesce(F.col("age_range"), F.lit("")))
    site = F.trim(F.coalesce(F.col("site_code"), F.lit("")))
    sex = F.upper(F.trim(F.coalesce(F.col("sex"), F.lit("X"))))
    rules = [
        ("display_name", (name == "") | (F.char_length(name) > 80)),
        ("patient_id", (F.char_length(pid) > 16) | ~pid.rlike(PATIENT_ID_PATTERN)),
        ("sex", ~sex.isin(*SEXES)),
        ("age_range", (age == "") | (F.char_length(age) > 10)),
        ("site_code", (site == "") | (F.char_length(site) > 16) | ~site_known),
    ]
    return F.array_compact(F.array(*[F.when(bad, F.lit(label)) for label, bad in rules]))


def normal_sex(sex: Column) -> Column:
    first = F.left(F.upper(F.trim(F.coalesce(sex, F.lit("X")))), F.lit(1))
    return F.when(first.isin(*SEXES), first).otherwise(F.lit("X"))


def clamp_age(age: Column) -> Column:
    """Age within 0..120, null kept (``least`` alone would turn null into the limit)."""
    return F.when(age.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(120), age.cast("int"))))


def age_from_range(age_range: Column, age: Column) -> Column:
    """Explicit age clamped to 0..120, else middle of ``lo-hi``, else its digits, else 40."""
    text = F.trim(age_range)
    low = F.nullif(F.regexp_extract(text, r"^(\d{1,3})\s*-\s*(\d{1,3})\+?$", 1), F.lit(""))
    high = F.nullif(F.regexp_extract(text, r"^(\d{1,3})\s*-\s*(\d{1,3})\+?$", 2), F.lit(""))
    middle = F.floor((low.cast("int") + high.cast("int")) / 2).cast("int")
    digits = F.substring(F.regexp_replace(text, "[^0-9]", ""), 1, 3)
    return F.coalesce(
        clamp_age(age),
        middle,
        clamp_age(F.nullif(digits, F.lit("")).try_cast("int")),
        F.lit(40),
    )


def usable_symptoms(symptoms: Column, minimum: int = 3) -> Column:
    return F.coalesce(F.char_length(F.trim(symptoms)) >= minimum, F.lit(False))
