"""Symptom classifier: split, train, store the model, evaluate on each split, report.

    spark-submit --py-files wardspark.zip -m wardspark.plans.symptom_training RECORDS_CSV OUT
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardspark.operators import evaluation as ev, features, symptoms
from wardspark.schemas import RECORDS_CSV
from wardspark.session import build_session, stage
from wardspark.sources import files, sinks


def run(spark: SparkSession, records: DataFrame, out: str, max_iter: int = 400) -> symptoms.SymptomModel:
    training = symptoms.training_set(records)
    split = stage(
        features.three_way_split(training, "record_id", "diagnosis"), "records-split"
    )
    model = symptoms.train(split.where("ml_split = 'train'"), max_iter=max_iter)
    model.save(f"{out}/models")
    truth = split.select("record_id", F.col("diagnosis").alias("actual"), F.col("ml_split").alias("split"))
    scored = symptoms.score(split.drop("ml_split", "diagnosis"), model).select(
        "record_id", F.col("predicted_diagnosis").alias("predicted")
    )
    cells = ev.confusion_cells(scored.join(truth, "record_id"), tuple(model.labels), ("split",))
    sinks.write_report(ev.evaluation_report(cells, symptoms.MODEL_VERSION), f"{out}/report")
    return model


if __name__ == "__main__":
    session = build_session("symptom-training")
    run(session, files.read_csv_text(session, sys.argv[1], RECORDS_CSV), sys.argv[2])
