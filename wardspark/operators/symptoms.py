"""The symptom classifier: features from Spark expressions, training and batch scoring with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from wardspark.functions.clean import clamp_age, normal_sex, usable_symptoms
from wardspark.operators.evaluation import class_weights
from wardspark.operators import text
from wardspark.schemas import SEXES
from wardspark.session import scratch_path, spread_small, stage
from wardspark.sources.files import exists

MODEL_NAME = "symptoms_logreg"
MODEL_VERSION = "v1"
_SPARSE = 0  # Spark ML's mark of a sparse vector


def training_set(records: DataFrame) -> DataFrame:
    """Rows with text and diagnosis, whole-number age, one upper-case letter for sex."""
    return records.dropna(subset=["symptoms", "diagnosis"]).select(
        "record_id",
        "symptoms",
        F.col("age").try_cast("int").alias("age"),
        F.left(F.upper("sex"), F.lit(1)).alias("sex"),
        "diagnosis",
    )


@dataclass
class SymptomModel:
    terms: DataFrame  # term, place, idf: at most 8000 rows, stored
    width: int
    age_mean: float
    age_deviation: float
    labels: list[str]
    classifier: LogisticRegressionModel | None = None

    def person(self) -> list[Column]:
        """Scaled age (the mean where unknown) and one slot per known sex, all zero for any other."""
        age = ((F.col("age") - F.lit(self.age_mean)) / F.lit(self.age_deviation)).cast("double")
        return [F.coalesce(age, F.lit(0.0)), *[F.coalesce(F.col("sex") == s, F.lit(False)).cast("double") for s in SEXES]]

    def save(self, path: str, version: str = MODEL_VERSION) -> None:
        """Write vocabulary, classifier and scaling below ``path``; a version is complete when its last part is."""
        folder = f"{path}/version={version}"
        self.terms.write.mode("overwrite").parquet(f"{folder}/terms")
        self.classifier.write().overwrite().save(f"{folder}/classifier")
        facts = [(self.width, float(self.age_mean), float(self.age_deviation), self.labels)]
        schema = "width int, age_mean double, age_deviation double, labels array<string>"
        self.terms.sparkSession.createDataFrame(facts, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: str = MODEL_VERSION) -> SymptomModel | None:
        """A stored model, or None where this version is not complete."""
        folder = f"{path}/version={version}"
        if not exists(spark, f"{folder}/facts/_SUCCESS"):
            return None
        facts = spark.read.parquet(f"{folder}/facts").first()
        terms = spark.read.schema("term string, place int, idf double").parquet(f"{folder}/terms")
        return cls(terms, facts.width, facts.age_mean, facts.age_deviation, list(facts.labels),
                   LogisticRegressionModel.load(f"{folder}/classifier"))

    def features(self, counted: DataFrame) -> DataFrame:
        """Replace the counts of ``terms`` by ``features``: unit-length text weights, scaled age, one slot per known sex.

        Sparse vectors are written as the struct that stores them and read back as vectors, so no row passes through
        Python, and no row is moved. A document's list has at most as many entries as there are terms.
        """
        person = self.person()
        size = self.width + len(person)
        vector = F.struct(
            F.lit(_SPARSE).cast("tinyint").alias("type"), F.lit(size).alias("size"),
            F.concat(F.transform("terms", lambda t: t["place"]), F.array(*[F.lit(i) for i in range(self.width, size)])).alias("indices"),
            F.concat(F.transform("terms", lambda t: t["w"]), F.array(*person)).alias("values"),
        )
        stored = text.unit_weights(counted, self.terms).withColumn("features", vector).drop("terms")
        spark = counted.sparkSession
        path = scratch_path(spark, "symptom-features")
        stored.write.parquet(path)
        fields = [StructField(f.name, VectorUDT()) if f.name == "features" else f for f in stored.schema]
        return spark.read.schema(StructType(fields)).parquet(path)


def train(training: DataFrame, max_iter: int = 400) -> SymptomModel:
    """Fit the classifier on all rows that have a diagnosis; the classes are those of the rows.

    What reaches the driver is bounded by the model: one weight per class, and the coefficients.
    """
    tokens = text.text_tokens(training.where(F.col("diagnosis").isNotNull()), "symptoms")
    keyed = tokens.drop("words")
    chosen = text.ranked_vocabulary(tokens)
    counted = stage(text.counted_terms(tokens, chosen), "symptom-terms")
    terms = stage(
        text.inverse_frequencies(text.document_frequencies(chosen, counted), keyed).select("term", "place", "idf"),
        "symptom-vocabulary",
    )
    stats = keyed.agg(F.avg("age").alias("m"), F.stddev_pop("age").alias("s")).first()
    weights = {r["diagnosis"]: r for r in class_weights(keyed, "diagnosis").collect()}
    labels = sorted(weights)
    model = SymptomModel(terms, terms.count(), stats["m"] or 0.0, stats["s"] or 1.0, labels)

    pairs = [x for label in labels for x in (F.lit(label), F.lit(weights[label]["weight"]))]
    order_of = F.array(*[F.lit(v) for v in labels])
    ready = (
        model.features(counted)
        .withColumn("weight", F.element_at(F.create_map(*pairs), F.col("diagnosis")))
        .withColumn("target", (F.array_position(order_of, F.col("diagnosis")) - 1).cast("double"))
    )
    rows = sum(r["n"] for r in weights.values())
    model.classifier = LogisticRegression(
        family="multinomial", featuresCol="features", labelCol="target", weightCol="weight",
        maxIter=max_iter, tol=1e-4, regParam=1.0 / rows, standardization=False,
    ).fit(ready)
    return model


def probabilities_of(records: DataFrame, model: SymptomModel) -> DataFrame:
    """The rows without their text, with the label -> probability map, for ages and sexes as they stand."""
    tokens = spread_small(records).withColumn("words", text.words(F.col("symptoms"))).drop("symptoms")
    scored = model.classifier.transform(model.features(text.counted_terms(tokens, model.terms)))
    labels = F.array(*[F.lit(v) for v in model.labels])
    return scored.select(
        *[c for c in records.columns if c != "symptoms"],
        F.map_from_arrays(labels, vector_to_array("probability")).alias("probabilities"),
    )


def score(records: DataFrame, model: SymptomModel) -> DataFrame:
    """Predicted diagnosis and the label -> probability map of every usable record."""
    usable = records.where(usable_symptoms(F.col("symptoms"))).select(
        *[c for c in records.columns if c not in ("age", "sex", "symptoms")],
        F.trim("symptoms").alias("symptoms"),
        clamp_age(F.col("age")).alias("age"),
        normal_sex(F.col("sex")).alias("sex"),
    )
    labels = F.array(*[F.lit(v) for v in model.labels])
    scored = probabilities_of(usable, model)
    most = F.array_max(F.map_values("probabilities"))
    return scored.select(
        *[c for c in usable.columns if c != "symptoms"],
        F.element_at(labels, F.array_position(F.map_values("probabilities"), most).cast("int")).alias("predicted_diagnosis"),
        "probabilities",
        F.lit(MODEL_NAME).alias("model_name"),
        F.lit(MODEL_VERSION).alias("model_version"),
    )


def append_predictions(scored: DataFrame, path: str) -> None:
    """Append scored records to a table of predictions, the probabilities as JSON text."""
    scored.withColumn("prob_json", F.to_json("probabilities")).drop("probabilities").write.mode("append").parquet(path)
