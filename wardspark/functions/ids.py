"""Hash-derived identifiers and object keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wardspark.schemas import AGE_RANGES, SEXES


def hash_int(text: Column, digits: int = 8) -> Column:
    """Leading hex digits of the MD5 of a text as a non-negative bigint."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def sample_id(content_hash: Column, split: Column, variant: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", content_hash, split, variant), 256), 1, 16)


def patient_id_from_path(path: Column) -> Column:
    return F.concat(F.lit("PAT-"), F.substring(F.sha2(path, 256), 1, 10))


def study_id_from_path(path: Column) -> Column:
    return F.concat(F.lit("STU-"), F.substring(F.md5(path), 1, 12))


def study_id_from_content(content: Column) -> Column:
    return F.concat(F.lit("STU-"), F.upper(F.substring(F.md5(content), 1, 12)))


def sex_from_id(patient_id: Column) -> Column:
    values = F.array(*[F.lit(v) for v in SEXES])
    return F.element_at(values, (hash_int(patient_id) % len(SEXES) + 1).cast("int"))


def age_range_from_id(patient_id: Column) -> Column:
    values = F.array(*[F.lit(v) for v in AGE_RANGES])
    return F.element_at(values, (hash_int(patient_id) % len(AGE_RANGES) + 1).cast("int"))


def display_name_from_id(patient_id: Column) -> Column:
    bare = F.replace(patient_id, F.lit("PAT-"), F.lit(""))
    return F.concat(F.lit("Paciente "), F.right(bare, F.lit(6)))


def raw_object_key(content_hash: Column) -> Column:
    return F.concat(F.lit("raw/"), content_hash, F.lit(".jpg"))


def upload_object_key(study_id: Column, extension: Column, prefix: str = "uploads") -> Column:
    """``uploads/<study><ext>``; ``.jpeg`` and unknown extensions are stored as ``.jpg``."""
    ext = F.when(extension == ".png", F.lit(".png")).otherwise(F.lit(".jpg"))
    return F.concat(F.lit(prefix + "/"), study_id, ext)


def run_id(at: Column, kind: Column) -> Column:
    """Name of a run by its start, to the second, and its kind."""
    return F.concat(F.lit("RUN-"), F.date_format(at, "yyyyMMdd-HHmmss"), F.lit("-"), kind)
