"""Evaluation of class predictions: confusion cells, class metrics, summaries, ranking.

The large input is touched once, by a count per (keys, actual, predicted). Everything after
works on those few counts.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window, functions as F

OTHER = "(other)"


def confusion_cells(
    df: DataFrame,
    labels: tuple[str, ...],
    keys: tuple[str, ...] = (),
    actual: str = "actual",
    predicted: str = "predicted",
    n: Column | None = None,
) -> DataFrame:
    """Rows (keys, actual, predicted, n) for every pair of labels, zero cells included; ``n``: rows that a row stands for.

    Null labels and labels that are not listed count as OTHER, in cells of their own where there are such
    rows, so that the cells add up to all rows.
    """
    listed = lambda c: F.when(F.col(c).isin(*labels), F.col(c)).otherwise(F.lit(OTHER)).alias(c)
    counts = df.groupBy(*keys, listed(actual), listed(predicted)).agg(F.sum(F.lit(1) if n is None else n).alias("n"))
    pairs = list(product((*labels, OTHER), repeat=2))
    cells = [
        F.coalesce(
            F.sum(F.when((F.col(actual) == a) & (F.col(predicted) == p), F.col("n"))), F.lit(0)
        ).cast("bigint").alias(f"c{i}")
        for i, (a, p) in enumerate(pairs)
    ]
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"),
                     F.col(f"c{i}").alias("n"))
            for i, (a, p) in enumerate(pairs)
        ]
    )
    shown = F.filter(rows, lambda c: (c["n"] > 0) | ((c["actual"] != OTHER) & (c["predicted"] != OTHER)))
    return counts.groupBy(*keys).agg(*cells).select(*keys, F.inline(shown))


def confusion_matrix(cells: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """One row per actual label with one column per predicted label; the rest is in cells of OTHER."""
    return cells.groupBy("actual").agg(
        *[
            F.sum(F.when(F.col("predicted") == p, F.col("n"))).cast("bigint").alias(f"pred_{p}")
            for p in labels
        ]
    )


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient that is 0 where the divisor is 0."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(
        top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))
    )


def class_metrics(cells: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows (keys, label, precision, recall, f1, support, correct)."""
    right = (F.col("actual") == F.col("predicted")) & (F.col("actual") != OTHER)
    hit = F.when(right, F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"),
                 zero.alias("claimed"), hit.cast("bigint").alias("correct")),
        F.struct(F.col("predicted").alias("label"), zero.alias("support"),
                 F.col("n").alias("claimed"), zero.alias("correct")),
    )
    sums = cells.select(*keys, F.inline(sides)).groupBy(*keys, "label").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("support", "claimed", "correct")]
    )
    precision = _ratio(F.col("correct"), F.col("claimed"))
    recall = _ratio(F.col("correct"), F.col("support"))
    f1 = _ratio(2 * F.col("correct"), F.col("claimed") + F.col("support"))
    return sums.select(
        *keys, "label", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
        "support", "correct",
    )


def metrics_summary(classes: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Accuracy, macro and weighted averages over the classes of every key.

    Rows of OTHER are samples and errors; macro averages are over the listed classes.
    """
    total = F.sum("support").cast("double")

    def macro(name: str) -> Column:
        return F.avg(F.when(F.col("label") != OTHER, F.col(name))).alias(f"{name}_macro")

    def weighted(name: str) -> Column:
        return _ratio(F.sum(F.col(name) * F.col("support")), total).alias(f"{name}_weighted")

    return classes.groupBy(*keys).agg(
        F.sum("support").cast("bigint").alias("n_samples"),
        _ratio(F.sum("correct"), total).alias("accuracy"),
        macro("precision"), macro("recall"), macro("f1"),
        weighted("precision"), weighted("recall"), weighted("f1"),
    )


def critical_errors(
    cells: DataFrame, actual: str = "neumonia", predicted: str = "sana", keys: tuple[str, ...] = ()
) -> DataFrame:
    """All wrong predictions and those of one named pair, found by label and not by position."""
    named = (F.col("actual") == actual) & (F.col("predicted") == predicted)
    wrong = (F.col("actual") != F.col("predicted")) | (F.col("actual") == OTHER)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")

    return cells.groupBy(*keys).agg(
        total(wrong).alias("misclassified_total"),
        total(named).alias(f"fn_{actual}_to_{predicted}"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (classes * n_class) of every class.

    The window covers the aggregated classes only.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    over = Window.partitionBy(F.lit(1))
    weight = F.sum("n").over(over).cast("double") / (F.count(F.lit(1)).over(over) * F.col("n"))
    return counts.select(label, "n", weight.alias("weight"))


def model_ranking(reports: DataFrame) -> DataFrame:
    """Models (model_name, f1_macro, critical_fn, accuracy) ranked; rank 1 is recommended.

    One row per model, so a single ordered window is enough.
    """
    order = Window.partitionBy(F.lit(1)).orderBy(
        F.col("f1_macro").desc(), F.col("critical_fn"), F.col("accuracy").desc(), "model_name"
    )
    place = F.row_number().over(order)
    return reports.select("*", place.alias("place"), (place == 1).alias("recommended"))


def best_checkpoint(files: DataFrame, name: str = "name") -> DataFrame:
    """The checkpoint with the largest ``val<score>`` in its file name; ties by name."""
    score = F.regexp_extract(F.col(name), r"val([0-9.]+)\.keras$", 1)
    scored = files.select(
        F.col(name).alias("name"), F.nullif(score, F.lit("")).try_cast("double").alias("score")
    ).where(F.col("score").isNotNull())
    return scored.orderBy(F.col("score").desc(), "name").limit(1)


def training_curve(phases: DataFrame) -> DataFrame:
    """Epochs of successive phases (run, phase, epoch, ...) on one continuous axis per run.

    Offsets come from a count per (run, phase), so no window covers the epochs themselves.
    """
    sizes = phases.groupBy("run", "phase").agg(
        F.count(F.lit(1)).alias("size"), F.min("epoch").alias("first_epoch")
    )
    before = F.sum("size").over(
        Window.partitionBy("run").orderBy("phase").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        "run", "phase", F.coalesce(before, F.lit(0)).alias("offset"), "first_epoch",
        (F.sum("size").over(
            Window.partitionBy("run").orderBy("phase").rowsBetween(Window.unboundedPreceding, 0)
        )).alias("phase_end"),
    )
    step = (F.col("offset") + F.col("epoch") - F.col("first_epoch") + 1).cast("bigint")
    return phases.join(offsets, ["run", "phase"]).select(
        *phases.columns, step.alias("step"),
        (step == F.col("phase_end")).alias("is_boundary"),
    )


def evaluation_report(cells: DataFrame, model_version: str) -> DataFrame:
    """One nested row from confusion cells with key ``split``; a few dozen values in all."""
    keys = ("split",)
    classes = class_metrics(cells, keys)
    summary = metrics_summary(classes, keys)
    entry = F.struct("precision", "recall", "f1", "support")
    per_class = classes.groupBy("split").agg(
        F.map_from_entries(F.collect_list(F.struct("label", entry))).alias("per_class")
    )
    listed = cells.where((F.col("actual") != OTHER) & (F.col("predicted") != OTHER))
    rows = listed.groupBy("split", "actual").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("predicted", "n"))), lambda c: c["n"]).alias("row")
    )
    matrix = rows.groupBy("split").agg(
        F.array_sort(F.collect_list(F.struct("actual", "row"))).alias("m")
    ).select(
        "split", F.transform("m", lambda r: r["row"]).alias("confusion_matrix"),
        F.transform("m", lambda r: r["actual"]).alias("labels"),
    )
    body = summary.join(per_class, "split").join(matrix, "split").select(
        "split",
        F.struct("n_samples", "accuracy", "precision_macro", "recall_macro", "f1_macro",
                 "f1_weighted", "per_class", "confusion_matrix", "labels").alias("m"),
    )
    return body.agg(
        F.map_from_entries(F.collect_list(F.struct("split", "m"))).alias("metrics_by_split")
    ).select(F.lit(model_version).alias("model_version"), "metrics_by_split")
