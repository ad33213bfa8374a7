"""Diagnosis names, probability maps and probability vectors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Names shown for the diagnoses.
DIAGNOSIS_NAMES = {
    "sana": "Sin patología destacada",
    "neumonia": "Neumonía",
    "covid": "COVID-19",
    "gripe": "Gripe",
    "asma": "Asma",
    "bronquitis": "Bronquitis",
    "epoc": "EPOC",
    "rinitis_alergica": "Rinitis alérgica",
}


def diagnosis_name(code: Column) -> Column:
    pairs = [F.lit(v) for item in DIAGNOSIS_NAMES.items() for v in item]
    return F.coalesce(
        F.try_element_at(F.create_map(*pairs), code), F.replace(code, F.lit("_"), F.lit(" "))
    )


def probabilities(json_text: Column) -> Column:
    return F.from_json(json_text, "map<string,double>")


def top_entries(probs: Column, n: int = 5) -> Column:
    """The n most probable entries as an array of (label, probability), ties by label."""
    keyed = F.transform(
        F.map_entries(probs), lambda e: F.struct((-e["value"]).alias("k"), e["key"].alias("label"))
    )
    return F.transform(
        F.slice(F.array_sort(keyed), 1, n),
        lambda e: F.struct(e["label"].alias("label"), (-e["k"]).alias("probability")),
    )


def argmax_label(vector: Column, labels: tuple[str, ...]) -> Column:
    """Label of the largest entry; the first one on a tie."""
    position = F.array_position(vector, F.array_max(vector)).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in labels]), position)


def iso_text(timestamp: Column) -> Column:
    """ISO-8601 text; fractional seconds appear only when they are not zero."""
    whole = F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(timestamp, "SSSSSS")
    return F.concat(
        whole, F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros))
    )
