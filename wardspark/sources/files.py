"""File readers: CSV text, manifests, binary content, JSON reports, logs, event lines."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from wardspark.functions import paths
from wardspark.schemas import FOLDER_LABELS, TRAINING_REPORT, WATCHER_EVENT
from wardspark.session import stage


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """The DataFrame itself, or an error that names the first missing column."""
    for name in required:
        if name not in df.columns:
            raise ValueError(f"required column missing: {name}")
    return df


def read_csv_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header as text columns, in the order of the schema.

    The header is read first, so that a file with more or reordered columns is still matched
    by name; no value is inferred.
    """
    header = spark.read.option("header", True).csv(path)
    require_columns(header, schema.fieldNames())
    return header.select(*schema.fieldNames())


CORRUPT = "_corrupt_record"


def malformed_csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with more or fewer cells than the header, whole, as ``_corrupt_record``; the reader pads or cuts them."""
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])
    read = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    parsed = read.option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    # Spark gives the corrupt column only beside the parsed ones, so the rows are stored before it is asked for.
    return stage(parsed, "csv-rows").where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory()


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """A name for the present state of some files or folders: it changes with any file's name, size or time.

    The listing is a Spark job that reads no contents.
    """
    one = F.xxhash64("path", F.unix_micros("modificationTime"), "length")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    count, state = listed.agg(F.count(F.lit(1)), F.bit_xor(one)).first()
    return hashlib.sha256(f"{paths} {count} {state}".encode()).hexdigest()[:20]


def read_first(spark: SparkSession, candidates: list[tuple[str, str]]) -> DataFrame:
    """The first existing candidate (format, path); CSV candidates have a header."""
    for kind, path in candidates:
        if exists(spark, path):
            return spark.read.format(kind).options(**({"header": "true"} if kind == "csv" else {})).load(path)
    raise FileNotFoundError(", ".join(path for _, path in candidates))


def feature_sources(spark: SparkSession, candidates: list[tuple[str, str]], data_root: str) -> DataFrame:
    """Distinct images to build features from; adds label and local path where absent."""
    df = read_first(spark, candidates)
    if "label" not in df.columns and "folder" in df.columns:
        df = df.withColumn("label", paths.folder_label(F.col("folder")))
    if "fs_path" not in df.columns:
        df = df.withColumn("fs_path", paths.resolve_local(F.col("file_path"), data_root))
    if "content_hash" not in df.columns:
        df = df.withColumn("content_hash", F.lit(None).cast("string"))
    return df.select("fs_path", "file_path", "label", "split", "content_hash").distinct()


def list_images(spark: SparkSession, root: str, glob: str = "*.jpg", content: bool = False) -> DataFrame:
    """Files below ``root`` as (fs_path, split, folder, filename, length[, content]).

    Without ``content`` the files are listed but not opened.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).load(root)
    )
    path = F.col("path")
    return files.select(
        path.alias("fs_path"),
        paths.path_part(path, -3).alias("split"),
        paths.path_part(path, -2).alias("folder"),
        paths.path_part(path, -1).alias("filename"),
        F.col("length"),
        *([F.col("content")] if content else []),
    )


def scan_manifest(spark: SparkSession, root: str, logical_root: str) -> DataFrame:
    """Manifest of a ``split/CLASS/*.jpg`` tree; files below other classes are left out."""
    listed = list_images(spark, root).where(F.col("folder").isin(*FOLDER_LABELS))
    return listed.select(
        F.concat_ws("/", F.lit(logical_root), "split", "folder", "filename").alias("file_path"),
        "fs_path", "split", "folder",
        paths.folder_label(F.col("folder")).alias("label"),
        "filename",
    )


def plain_path(path: Column) -> Column:
    """A path without scheme, so that ``file:/x``, ``file:///x`` and ``/x`` are equal."""
    return F.regexp_extract(path, r"^(?:[a-z0-9]+:/*)?(/.*)$", 1)


def attach_files(manifest: DataFrame, listed: DataFrame) -> DataFrame:
    """Manifest rows with the columns of their listed file, null where it is missing.

    Both sides have ``fs_path``; the listed side should carry facts, not contents.
    """
    found = listed.withColumn("_path", plain_path(F.col("fs_path"))).drop("fs_path")
    return manifest.join(found, plain_path(manifest["fs_path"]) == found["_path"], "left").drop("_path")


def read_training_report(spark: SparkSession, candidates: list[str]) -> DataFrame | None:
    """The first existing report; None when there is none. A broken document gives nulls."""
    for path in candidates:
        if exists(spark, path):
            return (
                spark.read.schema(TRAINING_REPORT).option("multiLine", True)
                .option("mode", "PERMISSIVE").json(path)
            )
    return None


def flatten_report(reports: DataFrame) -> DataFrame:
    """Rows (model_version, split, label, metrics...) of training reports."""
    split = reports.select("model_version", F.explode("metrics_by_split").alias("split", "m"))
    return split.select(
        "model_version", "split", "m.n_samples", "m.accuracy", "m.f1_macro",
        F.explode("m.per_class").alias("label", "c"),
    ).select(
        "model_version", "split", "n_samples", "accuracy", "f1_macro", "label",
        "c.precision", "c.recall", "c.f1", "c.support",
    )


def report_cells(reports: DataFrame) -> DataFrame:
    """Confusion cells (model_version, split, actual, predicted, n) of training reports."""
    split = reports.select("model_version", F.explode("metrics_by_split").alias("split", "m"))
    rows = split.select(
        "model_version", "split", F.col("m.labels").alias("labels"),
        F.posexplode("m.confusion_matrix").alias("i", "row"),
    )
    return rows.select(
        "model_version", "split", "labels", "i", F.posexplode("row").alias("j", "n")
    ).select(
        "model_version", "split",
        F.element_at("labels", F.col("i") + 1).alias("actual"),
        F.element_at("labels", F.col("j") + 1).alias("predicted"),
        "n",
    )


def read_log_lines(spark: SparkSession, root: str, glob: str = "*.log") -> DataFrame:
    """Lines of all log files below ``root`` with the path of their file."""
    return (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root)
        .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"))
    )


def read_watcher_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WATCHER_EVENT).json(path)


def read_table_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, parts: int,
    **options: str,
) -> DataFrame:
    """A database table read in parallel ranges of a numeric column."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts,
        properties=options,
    )

