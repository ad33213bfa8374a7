"""The dashboard document as one nested row, shown as (section, item, value) rows."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from wardspark.catalog.clinic import _LATEST, _RECENT_STUDIES
from wardspark.catalog.domain import Domain
from wardspark.catalog.models import _PLAIN_CELLS, _SUMMARY, _evaluated
from wardspark.catalog.operations import ALERTS_SHOWN, _RUNS, _runs, run_checks
from wardspark.catalog.registry import register
from wardspark.operators import dashboard
from wardspark.operators.totals import Partials
from wardspark.session import checkpoint_root, stage
from wardspark.sources import files


class _Files(Domain):
    """The domain with the predictions of some files only."""

    def __init__(self, d: Domain, names: list[str]):
        super().__init__(d.spark, d.folder)
        self.names = names

    def raw(self, name: str) -> DataFrame:
        rows = super().raw(name)
        return self.spark.read.schema(rows.schema).parquet(*self.names) if name == "lineitem" else rows


def _prediction_parts(d: Domain) -> Partials:
    """Kept totals of the predictions. They hold what studies and patients say, so they belong to the state of those tables."""
    state = files.fingerprint(d.spark, [d.path("orders"), d.path("customer")])
    source = d.path("lineitem")
    place = hashlib.sha256(source.encode()).hexdigest()[:12]
    parts = Partials(d.spark, f"{checkpoint_root(d.spark)}/totals/{place}-{state}", source)
    parts.refresh(lambda names: dashboard.load_parts(_Files(d, names).predictions(), d.studies(), d.patients()))
    return parts


@register("dashboard_payload", tables="patients studies predictions run_events evaluated alerts", sql=f"""
with {_RUNS}, {_LATEST}, {_PLAIN_CELLS},
measured as (select {_SUMMARY} from classes),
checks as (select run_id, count(*) filter (where severity = 'critical' and not acknowledged) = 0 ok from alerts group by 1),
recent as ({_RECENT_STUDIES}),
uploads_recent as (
  select p.prediction_id, p.study_id, p.predicted_label, pt.display_name, pt.patient_id
  from predictions p join studies s using (study_id) join patients pt using (patient_id)
  where s.source_dataset = 'api_upload' order by p.inferred_at desc, p.prediction_id desc limit 100)
select 'metrics' section, 'predictions_total' item, cast((select count(*) from predictions) as varchar) "value"
union all select 'metrics', 'api_uploads', cast((select count(*) from studies where source_dataset = 'api_upload') as varchar)
union all select 'metrics', 'patients_total', cast((select count(*) from patients) as varchar)
union all select 'percent', predicted_label,
    cast(round(count(*) * 100::decimal(9,0) / (select count(*) from predictions), 1)::decimal(5,1) as varchar)
    from predictions group by predicted_label
union all select 'runs', 'ok', cast(count(*) filter (where status = 'ok') as varchar) from headers
union all select 'runs', 'running', cast(count(*) filter (where status = 'running') as varchar) from headers
union all select 'runs', 'failed', cast(count(*) filter (where status = 'failed') as varchar) from headers
union all select 'recent_studies', study_id, concat_ws('|', coalesce(predicted_label, '-'), source_dataset, object_key, coalesce(patient_name, '-')) from recent
union all select 'recent_predictions', cast(prediction_id as varchar), concat_ws('|', study_id, predicted_label, display_name, patient_id) from uploads_recent
union all (select 'alerts', cast(alert_id as varchar), concat_ws('|', severity, title, message, run_id) from alerts
           order by created_at desc, alert_id desc limit {ALERTS_SHOWN})
union all select 'health', 'status', case when bool_and(ok) then 'ok' else 'degraded' end from checks
union all select 'health', 'failing', cast(count(*) filter (where not ok) as varchar) from checks
union all select 'evaluation', 'n_samples', cast(n_samples as varchar) from measured
union all select 'evaluation', 'accuracy', cast(accuracy::decimal(9,6) as varchar) from measured
union all select 'evaluation', 'f1_macro', cast(f1_macro::decimal(9,6) as varchar) from measured
union all select 'errors', 'misclassified_total', cast(count(*) as varchar) from evaluated where actual <> predicted
union all select 'errors', 'fn_neumonia_to_sana', cast(count(*) as varchar) from evaluated
    where actual = 'neumonia' and predicted = 'sana'""")
def dashboard_payload(d: Domain) -> DataFrame:
    """The document from kept totals; predictions are read once, when their files are new."""
    document = dashboard.payload_from_parts(
        _prediction_parts(d), d.patients(), d.studies(), _runs(d), d.alerts(), run_checks(d), ALERTS_SHOWN
    )
    one = stage(document, "dashboard")

    def row(section: str, item: str, value) -> Column:
        return F.struct(F.lit(section).alias("section"), F.lit(item).alias("item"), value.cast("string").alias("value"))

    single = F.array(
        *[row("metrics", n, F.col(f"metrics.{n}")) for n in ("predictions_total", "api_uploads", "patients_total")],
        *[row("runs", n, F.col(f"run_summary.{n}")) for n in ("ok", "running", "failed")],
        *[row("errors", n, F.col(f"evaluation.errors.{n}")) for n in ("misclassified_total", "fn_neumonia_to_sana")],
        *[row("health", n, F.col(f"health.{n}")) for n in ("status", "failing")],
        row("evaluation", "n_samples", F.col("evaluation.summary.n_samples")),
        *[row("evaluation", n, F.round(F.col(f"evaluation.summary.{n}"), 6).cast("decimal(9,6)")) for n in ("accuracy", "f1_macro")],
    )
    def many(section: str, array: str, item, value):
        return F.transform(array, lambda e: F.struct(
            F.lit(section).alias("section"), item(e).cast("string").alias("item"),
            value(e).cast("string").alias("value")))

    lists = F.concat(
        single,
        many("percent", "predictions_by_class", lambda e: e["predicted_label"],
             lambda e: e["percent"].cast("decimal(5,1)")),
        many("recent_studies", "recent_studies", lambda e: e["study_id"],
             lambda e: F.concat_ws("|", F.coalesce(e["predicted_label"], F.lit("-")), e["source_dataset"],
                                   e["object_key"], F.coalesce(e["patient_name"], F.lit("-")))),
        many("recent_predictions", "recent_predictions", lambda e: e["prediction_id"],
             lambda e: F.concat_ws("|", e["study_id"], e["predicted_label"], e["patient_name"], e["patient_id"])),
        many("alerts", "alerts", lambda e: e["alert_id"],
             lambda e: F.concat_ws("|", e["severity"], e["title"], e["message"], e["run_id"])),
    )
    return one.select(F.inline(lists))
