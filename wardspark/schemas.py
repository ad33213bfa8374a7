"""Table schemas and the closed value sets of the clinical data model."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# Closed sets in declaration order (the order is also the sort order).
STUDY_LABELS = ("sana", "neumonia", "covid")
DATA_SPLITS = ("train", "val", "test", "clinical")
RUN_STATUSES = ("pending", "running", "ok", "failed")
SEVERITIES = ("info", "warning", "critical")
ISSUE_TYPES = ("incomplete", "duplicate", "corrupt", "invalid_label", "other")
DIAGNOSES = (
    "sana", "neumonia", "covid", "gripe", "asma", "bronquitis", "epoc", "rinitis_alergica",
)
SEXES = ("M", "F", "X")
AGE_RANGES = ("18-30", "31-45", "46-60", "61-75", "76+")
IMAGE_SPLITS = ("train", "test")
MODEL_SPLITS = ("train", "validation", "test")
FOLDER_LABELS = {"NORMAL": "sana", "PNEUMONIA": "neumonia", "COVID19": "covid"}
# Class order of the image model's probability vector and of its confusion matrices.
MODEL_LABELS = ("covid", "neumonia", "sana")
TRAIN_VARIANTS = ("original", "rotate", "flip", "zoom")
EVAL_VARIANTS = ("original",)

# Limits.
MIN_IMAGE_BYTES = 500
MAX_UPLOAD_BYTES = 10 * 1024 * 1024
MIN_IMAGE_SIDE = 64
ALLOWED_EXTENSIONS = (".jpg", ".jpeg", ".png")
IMAGE_SIZE = 224
VALIDATION_RATIO = 0.15
RANDOM_SEED = 42
FEATURES_VERSION = "v1"


def enum_rank(column: Column | str, values: tuple[str, ...]) -> Column:
    """Position of a value in its declared set; unknown and null sort last."""
    col = F.col(column) if isinstance(column, str) else column
    pos = F.array_position(F.array(*[F.lit(v) for v in values]), col)
    return F.when(pos > 0, pos.cast("int")).otherwise(F.lit(len(values) + 1))


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


MANIFEST_CSV = T.StructType(_text("file_path", "split", "folder", "label", "filename"))

STUDIES_CSV = T.StructType(
    _text("study_id", "patient_id", "file_path", "split", "label",
          "source_dataset", "modality", "body_part", "captured_at")
)

RUN_EVENTS_CSV = T.StructType(
    _text("event_id", "run_id", "stage", "status", "records", "message", "logged_at")
)

RECORDS_CSV = T.StructType(
    _text("record_id", "patient_ref", "display_name", "age", "sex", "symptoms",
          "diagnosis", "recorded_at")
)

WATCHER_EVENT = T.StructType(
    [T.StructField("ts", T.TimestampType())] + _text("event", "path", "split", "folder")
)

FEATURE_INDEX = T.StructType(
    _text("sample_id", "source_path", "output_path", "split", "label", "augment_type")
    + [T.StructField("image_size", T.IntegerType())]
)

_CLASS_METRICS = T.StructType(
    [
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
        T.StructField("support", T.LongType()),
    ]
)

SPLIT_METRICS = T.StructType(
    [
        T.StructField("n_samples", T.LongType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("precision_macro", T.DoubleType()),
        T.StructField("recall_macro", T.DoubleType()),
        T.StructField("f1_macro", T.DoubleType()),
        T.StructField("f1_weighted", T.DoubleType()),
        T.StructField("per_class", T.MapType(T.StringType(), _CLASS_METRICS)),
        T.StructField("confusion_matrix", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("labels", T.ArrayType(T.StringType())),
    ]
)

TRAINING_REPORT = T.StructType(
    [
        T.StructField("model_version", T.StringType()),
        T.StructField("metrics_by_split", T.MapType(T.StringType(), SPLIT_METRICS)),
    ]
)
