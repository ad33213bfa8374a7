"""Checks on file content, all on ``BinaryType`` columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wardspark.schemas import (
    ALLOWED_EXTENSIONS, MAX_UPLOAD_BYTES, MIN_IMAGE_BYTES, MIN_IMAGE_SIDE,
)

# Leading bytes of the accepted formats.
JPEG_MAGIC = "FFD8FF"
PNG_MAGIC = "89504E470D0A1A0A"


def starts_with(content: Column, magic_hex: str) -> Column:
    return F.hex(F.substring(content, 1, len(magic_hex) // 2)) == magic_hex


def is_valid_jpeg(content: Column, min_bytes: int = MIN_IMAGE_BYTES) -> Column:
    """Long enough and starting like a JPEG; a missing content is invalid, not unknown."""
    ok = (F.octet_length(content) >= min_bytes) & starts_with(content, JPEG_MAGIC)
    return F.coalesce(ok, F.lit(False))


def content_format(content: Column) -> Column:
    return (
        F.when(starts_with(content, JPEG_MAGIC), F.lit("jpeg"))
        .when(starts_with(content, PNG_MAGIC), F.lit("png"))
        .otherwise(F.lit("other"))
    )


def upload_problem(
    filename: Column,
    extension: Column,
    content: Column,
    width: Column,
    height: Column,
    max_bytes: int = MAX_UPLOAD_BYTES,
    min_side: int = MIN_IMAGE_SIDE,
) -> Column:
    """First rule an uploaded image breaks, or null when it is accepted.

    A null width or height means that the content could not be decoded.
    """
    size = F.coalesce(F.octet_length(content), F.lit(0))
    return (
        F.when(F.coalesce(filename, F.lit("")).isin("", ".", ".."), F.lit("missing_name"))
        .when(filename.contains(".."), F.lit("bad_name"))
        .when(~extension.isin(*ALLOWED_EXTENSIONS), F.lit("bad_extension"))
        .when(size == 0, F.lit("empty"))
        .when(size > max_bytes, F.lit("too_large"))
        .when(content_format(content) == "other", F.lit("bad_format"))
        .when(width.isNull() | height.isNull(), F.lit("undecodable"))
        .when((width < min_side) | (height < min_side), F.lit("too_small"))
    )
