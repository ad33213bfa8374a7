"""Stratified splits, augmentation plan and the feature index; row positions in sort order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardspark.functions import ids
from wardspark.schemas import (
    EVAL_VARIANTS, FEATURES_VERSION, IMAGE_SIZE, RANDOM_SEED, TRAIN_VARIANTS, VALIDATION_RATIO,
)
from wardspark.session import checkpoint_root, stage


def quota_split(
    rows: DataFrame,
    key: str,
    stratum: str,
    quotas: list[tuple[str, Column]],
    rest: str,
    seed: int = RANDOM_SEED,
    out: str = "ml_split",
) -> DataFrame:
    """Assign exact shares of every stratum in the order of a seeded hash of a unique key.

    ``quotas`` lists (name, row count as an expression of ``n``); the first quota takes the
    rows with the smallest hashes, the next one follows, all others get ``rest``.

    A stratum may hold most of the table, so it is never ranked as a whole. Rows are counted
    per 16-bit hash prefix; running sums over those counts find the prefix in which a quota
    ends; only the rows of that prefix (about 1/65536 of the stratum) are ranked to find the
    exact hash. Every value of ``stratum`` is a stratum, null too. The rows are written once with their hash
    and read from there.
    """
    keyed = stage(
        rows.withColumn("_g", F.to_json(F.struct(F.col(stratum).alias("s"))))
        .withColumn("_h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key)), 256))
        .withColumn("_b", F.substring("_h", 1, 4)),
        "split-rows",
    )
    by_prefix = keyed.groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("c"))
    ordered = Window.partitionBy("_g").orderBy("_b")
    sums = by_prefix.select(
        "_g", "_b", "c",
        F.sum("c").over(ordered).alias("upto"),
        F.sum("c").over(Window.partitionBy("_g")).alias("n"),
    )
    ends, position = [], F.lit(0).cast("bigint")
    for _, amount in quotas:
        position = position + amount.cast("bigint")
        ends.append(position)
    for i, end in enumerate(ends):
        sums = sums.withColumn(f"end{i}", F.least(end, F.col("n")))
    # For each quota: the prefix in which it ends, and how many of its rows lie there.
    marks = F.array(
        *[
            F.struct(
                F.lit(i).alias("quota"),
                (F.col(f"end{i}") - F.col("upto") + F.col("c")).alias("need"),
            )
            for i in range(len(ends))
        ]
    )
    cuts = stage(
        sums.select("_g", "_b", "c", F.inline(marks))
        .where((F.col("need") > 0) & (F.col("need") <= F.col("c")))
        .select("_g", "_b", "quota", "need"),
        "split-cuts",
    )
    inside = keyed.select("_g", "_b", "_h").join(
        cuts.select("_g", "_b").distinct(), ["_g", "_b"], "left_semi"
    )
    ranked = inside.withColumn(
        "r", F.row_number().over(Window.partitionBy("_g", "_b").orderBy("_h"))
    )
    limits = (
        ranked.join(cuts, ["_g", "_b"])
        .where(F.col("r") == F.col("need"))
        .groupBy("_g")
        .agg(*[
            F.max(F.when(F.col("quota") == i, F.col("_h"))).alias(f"limit{i}")
            for i in range(len(quotas))
        ])
    )
    placed = keyed.join(stage(limits, "split-limits"), "_g", "left")
    choice = F.lit(rest)
    for i in reversed(range(len(quotas))):
        choice = F.when(F.col("_h") <= F.col(f"limit{i}"), F.lit(quotas[i][0])).otherwise(choice)
    return placed.select(*rows.columns, choice.alias(out))


def stratified_split(
    images: DataFrame,
    ratio: float = VALIDATION_RATIO,
    seed: int = RANDOM_SEED,
) -> DataFrame:
    """Original test rows stay test; of the others max(1, floor(ratio * n)) per label validate."""
    test = F.col("split") == "test"
    amount = F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(str(ratio)).cast("decimal(9,8)")))
    learning = quota_split(
        images.where(~F.coalesce(test, F.lit(False))),
        "file_path", "label", [("validation", amount)], "train", seed,
    )
    return learning.unionByName(images.where(test).withColumn("ml_split", F.lit("test")))


def three_way_split(
    records: DataFrame, key: str, stratum: str, seed: int = RANDOM_SEED
) -> DataFrame:
    """80/10/10 per stratum; validation and test get floor(n / 10) rows each."""
    tenth = F.floor(F.col("n") / F.lit(10))
    return quota_split(
        records, key, stratum, [("validation", tenth), ("test", tenth)], "train", seed
    )


def augmentation_plan(images: DataFrame) -> DataFrame:
    """One row per image and variant; a projection with a generator, no shuffle."""
    variants = F.when(
        F.col("ml_split") == "train", F.array(*[F.lit(v) for v in TRAIN_VARIANTS])
    ).otherwise(F.array(*[F.lit(v) for v in EVAL_VARIANTS]))
    return images.select(*images.columns, F.explode(variants).alias("augment_type"))


def feature_index(
    planned: DataFrame, version: str = FEATURES_VERSION, image_size: int = IMAGE_SIZE
) -> DataFrame:
    """Index rows of planned samples (file_path, content_hash, label, ml_split, augment_type)."""
    named = planned.withColumn(
        "sample_id",
        ids.sample_id(F.col("content_hash"), F.col("ml_split"), F.col("augment_type")),
    )
    output = F.concat(
        F.lit(f"data/processed/features/{version}/"), "ml_split", F.lit("/"), "label", F.lit("/"),
        "sample_id", F.lit("_"), "augment_type", F.lit(".jpg"),
    )
    return named.select(
        "sample_id",
        F.col("file_path").alias("source_path"),
        output.alias("output_path"),
        F.col("ml_split").alias("split"),
        "label",
        "augment_type",
        F.lit(image_size).alias("image_size"),
    )


def feature_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("split", "label", "augment_type").agg(F.count(F.lit(1)).alias("samples"))


def row_positions(rows: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Add ``position``: the 0-based place of every row in the global order of unique keys.

    Rows are range-partitioned, sorted and checkpointed, which fixes their partition and place;
    the place comes from ``monotonically_increasing_id`` on that fixed data, and the offset of
    each partition from a count per partition. The broadcast has one row per partition, so
    ``partitions`` bounds it. Starts the checkpoint job.
    """
    spark = rows.sparkSession
    checkpoint_root(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fixed = (
        rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys).checkpoint()
        .withColumn("_m", F.monotonically_increasing_id())
        .withColumn("_p", F.shiftright("_m", 33))
    )
    sizes = fixed.groupBy("_p").agg(F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(
        Window.partitionBy(F.lit(1)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select("_p", F.coalesce(before, F.lit(0)).alias("_offset"))
    place = F.col("_offset") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    return fixed.join(F.broadcast(offsets), "_p").select(*rows.columns, place.alias("position"))


def hourly_capture_time(base: str) -> Column:
    """Capture time of a positioned row: one hour apart, repeating after 720 rows."""
    hours = (F.col("position") % 720).cast("int")
    return F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hours)
