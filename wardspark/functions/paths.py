"""Path parsing: local paths, split/class folders, watcher routing, key=value parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wardspark.schemas import FOLDER_LABELS, IMAGE_SPLITS


def resolve_local(file_path: Column, data_root: str) -> Column:
    """Logical ``data/...`` path to a path below the data root."""
    return F.concat(F.lit(data_root.rstrip("/") + "/"), F.regexp_replace(file_path, "^data/", ""))


def base_name(path: Column) -> Column:
    """Last part of a path with either kind of slash."""
    return F.element_at(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), -1)


def extension(name: Column) -> Column:
    """Lower-cased extension with its dot; empty when there is none."""
    return F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))


def path_part(path: Column, position: int) -> Column:
    """Part of a slash path counted from its end (-1 is the file name), null if absent."""
    return F.try_element_at(F.split(path, "/"), F.lit(position))


def folder_label(folder: Column) -> Column:
    pairs = [F.lit(v) for item in FOLDER_LABELS.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), folder)


def label_or_folder(label: Column, folder: Column) -> Column:
    """The given label, or the folder's label when the given one is empty."""
    return F.coalesce(F.nullif(label, F.lit("")), folder_label(folder))


def key_value_part(path: Column, key: str) -> Column:
    return F.nullif(F.regexp_extract(path, rf"{key}=([^/]+)", 1), F.lit(""))


def is_jpeg_name(path: Column) -> Column:
    return F.lower(path).rlike(r"\.jpe?g$")


def route(relative_path: Column) -> Column:
    """Decision for a file that arrived in the incoming folder.

    ``keep``: ``split/CLASS/.../file`` with known split and class; ``default``: a bare file
    name, stored below train/NORMAL; ``reject``: any other place; ``ignore``: not a JPEG name.
    """
    parts = F.split(relative_path, "/")
    placed = (
        (F.size(parts) >= 3)
        & F.get(parts, F.lit(0)).isin(*IMAGE_SPLITS)
        & F.get(parts, F.lit(1)).isin(*FOLDER_LABELS)
    )
    return (
        F.when(~F.coalesce(is_jpeg_name(relative_path), F.lit(False)), F.lit("ignore"))
        .when(placed, F.lit("keep"))
        .when(F.size(parts) == 1, F.lit("default"))
        .otherwise(F.lit("reject"))
    )


def routed_split(relative_path: Column, decision: Column) -> Column:
    parts = F.split(relative_path, "/")
    return (
        F.when(decision == "keep", F.get(parts, F.lit(0)))
        .when(decision == "default", F.lit("train"))
    )


def routed_folder(relative_path: Column, decision: Column) -> Column:
    parts = F.split(relative_path, "/")
    return (
        F.when(decision == "keep", F.get(parts, F.lit(1)))
        .when(decision == "default", F.lit("NORMAL"))
    )
