"""The given tables seen as the clinical data model. The only place that knows their columns.

Every derivation is a projection of one table (runs and clinical records excepted), so a query
that needs three columns reads only what those three columns are made of.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardspark.catalog.oracle import line_hash
from wardspark.functions import ids
from wardspark.session import ship_package

HEX = "cast(conv(substring(md5({0}), 1, 8), 16, 10) as bigint)"


class Domain:
    """Lazy domain tables over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        ship_package(spark)
        # The tables hold UTC times without zone; windows and epoch seconds rely on that.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def raw(self, name: str) -> DataFrame:
        """The table; its schema is looked up once for a query."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(self.path(name))
        return self._tables[name]

    # -- relational core -------------------------------------------------------------
    def sites(self) -> DataFrame:
        return self.raw("nation").selectExpr(
            "concat('S', cast(n_nationkey as string)) site_code",
            "n_name site_name",
            "n_nationkey % 5 <> 0 active",
        )

    def patients(self) -> DataFrame:
        keyed = self.raw("customer").selectExpr(
            "*", "concat('PAT-', lpad(cast(c_custkey as string), 12, '0')) patient_id"
        )
        return keyed.select(
            "patient_id",
            F.when(F.col("c_acctbal") < -900, F.lit(""))
            .when(F.col("c_acctbal") < -500, ids.display_name_from_id(F.col("patient_id")))
            .otherwise(F.col("c_name")).alias("display_name"),
            ids.sex_from_id(F.col("patient_id")).alias("sex"),
            ids.age_range_from_id(F.col("patient_id")).alias("age_range"),
            F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("site_code"),
        )

    def studies(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "concat('STU-', cast(o_orderkey as string)) study_id",
            "concat('PAT-', lpad(cast(o_custkey as string), 12, '0')) patient_id",
            "concat('data/raw/scans/', cast(o_orderkey as string), '.jpg') file_path",
            "case when o_orderkey % 11 = 0 then null else "
            "concat('raw/', md5(cast(o_orderkey as string)), '.jpg') end object_key",
            "case when o_orderkey % 7 = 0 then 'clinical' when o_orderkey % 7 = 1 then 'test' "
            "when o_orderkey % 7 = 2 then 'val' else 'train' end split",
            "case when o_orderkey % 7 = 0 then null when o_orderstatus = 'O' then 'sana' "
            "when o_orderstatus = 'F' then 'neumonia' else 'covid' end label",
            "case when o_orderkey % 7 = 0 then 'api_upload' else 'xray_archive' end source_dataset",
            "'CR' modality",
            "'chest' body_part",
            "o_orderdate captured_at",
            "o_orderdate + make_dt_interval(0, cast(o_orderkey % 48 as int)) ingested_at",
        )

    def predictions(self) -> DataFrame:
        weights = self.raw("lineitem").selectExpr(
            "*",
            "cast(l_quantity as bigint) wa",
            "l_partkey % 40 + 1 wb",
            "l_suppkey % 30 + 1 wg",
        )
        shares = weights.selectExpr(
            "*",
            "wa * 100000 div (wa + wb + wg) ps",
            "wb * 100000 div (wa + wb + wg) pn",
        ).selectExpr("*", "100000 - ps - pn pc")
        decimal = "cast(cast({0} as decimal(11,0)) * cast(0.00001 as decimal(6,5)) as decimal(6,5))"
        return shares.selectExpr(
            # A row hash: no window over the order key is needed to number the rows.
            line_hash("unix_date(cast(l_shipdate as date))") + " prediction_id",
            "concat('STU-', cast(l_orderkey as string)) study_id",
            "case when ps >= pn and ps >= pc then 'sana' when pn >= pc then 'neumonia' "
            "else 'covid' end predicted_label",
            decimal.format("ps") + " prob_sana",
            decimal.format("pn") + " prob_neumonia",
            decimal.format("pc") + " prob_covid",
            "case l_returnflag when 'A' then 'resnet50' when 'N' then 'densenet121' "
            "else 'baseline_cnn' end model_name",
            "'v1' model_version",
            "l_shipdate inferred_at",
        )

    # -- operations ------------------------------------------------------------------
    def run_events(self) -> DataFrame:
        return self.raw("events").selectExpr(
            "event_id",
            "concat('RUN-', cast(user_id as string)) run_id",
            "event_type stage",
            "case event_type when 'purchase' then 'ok' when 'error' then 'failed' "
            "when 'signup' then 'pending' else 'running' end status",
            "cast(floor(value) as int) records",
            "props message",
            "ts logged_at",
        )

    def quality_issues(self) -> DataFrame:
        return self.raw("events").where("event_type = 'error'").selectExpr(
            "event_id issue_id",
            "concat('RUN-', cast(user_id as string)) run_id",
            "concat('STU-', cast(event_id as string)) study_id",
            "case when value < 10 then 'incomplete' when value < 40 then 'duplicate' "
            "when value < 100 then 'corrupt' when value < 200 then 'invalid_label' "
            "else 'other' end issue_type",
            "props details",
            "ts detected_at",
        )

    def alerts(self) -> DataFrame:
        return self.raw("events").where("event_type = 'error'").selectExpr(
            "event_id alert_id",
            "concat('RUN-', cast(user_id as string)) run_id",
            "case when value < 20 then 'info' when value < 60 then 'warning' "
            "else 'critical' end severity",
            "concat('Run ', cast(user_id as string)) title",
            "props message",
            "event_id % 3 = 0 acknowledged",
            "ts created_at",
        )

    # -- files -----------------------------------------------------------------------
    def manifest(self) -> DataFrame:
        """Documents as stored files; the first bytes depend on the source."""
        placed = self.raw("documents").selectExpr(
            "*",
            "case when source in ('src0', 'src1', 'src2') then 'test' "
            "when source = 'src3' then 'holdout' else 'train' end split",
            "case lang when 'en' then 'NORMAL' when 'fr' then 'PNEUMONIA' "
            "when 'de' then 'COVID19' else 'OTHER' end folder",
        )
        return placed.selectExpr(
            "doc_id",
            "concat('data/raw/scans/', split, '/', folder, '/', cast(doc_id as string), '.jpg') "
            "file_path",
            "concat(cast(doc_id as string), '.jpg') filename",
            "split",
            "folder",
            "case when lang = 'en' then 'sana' when lang = 'es' then 'unknown' else '' end label",
            "concat(case source when 'src4' then unhex('89504E470D0A1A0A') "
            "when 'src5' then unhex('') else unhex('FFD8FF') end, encode(text, 'UTF-8')) content",
        )

    def uploads(self) -> DataFrame:
        """Pages as uploaded files: name and first bytes follow the form of the address; the sides are made up from it."""
        kinds = self.raw("pages").selectExpr(
            "*",
            "case when url like '%.html' then '.JPEG' when url like '%#top' then '.png' "
            "when url like '%/' then '.gif' when url like '%=%' then '.jpg' else '' end ext",
            HEX.format("url") + " h",
        )
        return kinds.selectExpr(
            "page_id",
            "case when h % 17 = 0 then '..' else concat('C:\\\\scans/', 'img', "
            "cast(page_id as string), ext) end path",
            "concat(case when h % 5 = 0 then unhex('') when ext = '.png' "
            "then unhex('89504E470D0A1A0A') else unhex('FFD8FF') end, encode(html, 'UTF-8')) content",
            "cast(h % 300 as int) made_up_width",
            "cast(h % 200 as int) + 30 made_up_height",
            "concat('PAT-', lpad(cast(page_id as string), 12, '0')) patient_id",
        )

    # -- clinical text ---------------------------------------------------------------
    def clinical_records(self, diagnosed: bool = True) -> DataFrame:
        """Records with text and person; their diagnosis comes from a second table, which is read only for it."""
        texts = self.raw("documents").select("doc_id", "text")
        joined = texts.join(self.raw("labels"), "doc_id", "left") if diagnosed else texts.selectExpr(
            "*", "cast(null as int) quality", "cast(null as int) toxic")
        return joined.selectExpr("*", "cast(doc_id as string) k").selectExpr(
            "concat('CR-', substring(md5(k), 1, 12)) record_id",
            "concat('CREF-', substring(md5(k), 13, 10)) patient_ref",
            "cast(" + HEX.format("k") + " % 121 as int) age",
            "case " + HEX.format("k") + " % 4 when 0 then 'm' when 1 then ' F ' when 2 then 'X' "
            "else 'unknown' end sex",
            "text symptoms",
            "case when quality is null then null when quality = 1 and toxic = 0 then 'sana' when quality = 1 then 'gripe' "
            "when toxic = 0 then 'neumonia' else 'covid' end diagnosis",
            "timestamp_ntz'2025-01-01 08:00:00' + doc_id * interval '3' minute recorded_at",
        )

    def clinical_predictions(self) -> DataFrame:
        """A prediction for each user turn; turns of other roles, or of none, are no symptoms and give none."""
        names = "array('sana','neumonia','covid','gripe','asma','bronquitis','epoc','rinitis_alergica')"
        turns = self.raw("conversations").where("role = 'user'").selectExpr(
            "*", HEX.format("text") + " h"
        ).selectExpr(
            "*",
            f"element_at({names}, cast(h % 8 + 1 as int)) d1",
            f"element_at({names}, cast((h + 3) % 8 + 1 as int)) d2",
            f"element_at({names}, cast((h + 6) % 8 + 1 as int)) d3",
            "cast(h % 30 + 60 as string) p1",
            "cast(h % 9 + 1 as string) p2",
        )
        return turns.selectExpr(
            "conv_id * 1000 + turn prediction_id",
            "concat('PAT-', lpad(cast(conv_id as string), 12, '0')) patient_id",
            "text symptoms",
            "d1 predicted_diagnosis",
            "concat('{\"', d1, '\":0.', p1, ',\"', d2, '\":0.0', p2, ',\"', d3, '\":0.02}') prob_json",
            "'symptoms_logreg' model_name",
            "'v1' model_version",
            "timestamp_ntz'2026-04-01 08:00:00' + (turn div 3) * interval '1' minute inferred_at",
        )

    # -- arrivals and logs -----------------------------------------------------------
    def arrivals(self) -> DataFrame:
        """Events as files seen in the incoming folder."""
        return self.raw("events").selectExpr(
            "event_id",
            "ts",
            "case event_type when 'view' then concat('train/NORMAL/', user_id, '.jpg') "
            "when 'click' then concat(user_id, '.JPG') "
            "when 'error' then concat('train/OTHER/', user_id, '.jpg') "
            "when 'purchase' then concat('test/COVID19/', user_id, '.jpeg') "
            "else concat('test/PNEUMONIA/', user_id, '.txt') end path",
        )

    def log_lines(self) -> DataFrame:
        """Events written as log lines of every format, with the file they stand in."""
        return self.raw("events").selectExpr(
            "event_id",
            "case event_type "
            "when 'click' then concat('[', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), '] INFO [api] — ', props) "
            "when 'view' then concat('[', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ',179] {task.py} - ', props) "
            "when 'signup' then concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '+02:00 | WARNING | watcher | ', props) "
            "when 'purchase' then case when value < 5 then '   ' else concat('raw ', props) end "
            "else concat('[', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), '] ERROR [ml] — ', props) end line",
            "concat('/logs/dag_id=ingest/run_id=RUN-', cast(user_id as string), '/task_id=', "
            "event_type, '/attempt.log') path",
        )


Query = Callable[[SparkSession, str], DataFrame]


def query(build: Callable[[Domain], DataFrame]) -> Query:
    """Turn a function of the domain into the registered (spark, folder) form."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Domain(spark, folder))

    run.__doc__ = build.__doc__
    run.__name__ = build.__name__
    return run
