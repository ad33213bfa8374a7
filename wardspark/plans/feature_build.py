"""Feature build: split, plan the variants and store their index.

    spark-submit --py-files wardspark.zip -m wardspark.plans.feature_build DATA_ROOT MANIFEST_DIR OUT
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardspark.operators import features
from wardspark.schemas import FEATURES_VERSION, IMAGE_SIZE, RANDOM_SEED, VALIDATION_RATIO
from wardspark.session import build_session, stage
from wardspark.sources import files, sinks


def run(
    spark: SparkSession, data_root: str, manifest_dir: str, out: str, image_size: int = IMAGE_SIZE, limit: int = 0,
) -> DataFrame:
    """Write ``index`` and ``report``; return the counts.

    Every planned sample has its id and output path in the index; a pixel step reads the index and writes
    the files. ``limit`` keeps the first sources by path, 0 all of them.
    """
    sources = files.feature_sources(
        spark,
        [("parquet", f"{manifest_dir}/validated"), ("csv", f"{manifest_dir}/validated_csv"),
         ("csv", f"{manifest_dir}/manifest.csv")],
        data_root,
    )
    split = features.stratified_split(sources, VALIDATION_RATIO, RANDOM_SEED)
    if limit > 0:
        split = split.orderBy("file_path").limit(limit)
    split = stage(split.withColumn("content_hash", F.coalesce("content_hash", F.md5("fs_path"))), "split")
    index = features.feature_index(features.augmentation_plan(split), FEATURES_VERSION, image_size)
    sinks.write_table(index, f"{out}/index", ("split", "label"))
    counts = features.feature_counts(spark.read.parquet(f"{out}/index"))
    sinks.write_report(counts, f"{out}/report")
    return spark.read.json(f"{out}/report")


if __name__ == "__main__":
    run(build_session("feature-build"), *sys.argv[1:4]).show(100)
