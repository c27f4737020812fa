"""The tables of one source folder, from raw to aggregate, each written once when first needed.

Tables go to the shared folder of the session: later steps read columns from parquet
instead of repeating the work, and a lost executor costs a re-read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlight.operators import aggregates, alerts, caregaps, clustering, dims, events, facts, fraud, highcost, increment, keys, ods, scd, scores, silver, views
from wardlight.session import shared_dir
from wardlight.sources import domain, files, landing

Build = Callable[["Warehouse"], DataFrame]
DIM_LOAD = "1995-01-01 00:00:00"

_VIEWS: dict[str, Build] = {}   # computed wherever they are used
_TABLES: dict[str, Build] = {}  # written once
_PARTITIONS = {"fact_premium": ["year_month"], "fact_capitation": ["year_month"], "landing_parsed": ["_table"]}
# Facts lie by month of this date, events by day: filters on these columns skip files.
_MONTHS = {"fact_encounter": "encounter_date_key", "fact_claim": "claim_date_key", "fact_prescription": "fill_date_key"}


def claim_axes(w: "Warehouse") -> list[clustering.Axis]:
    """Payers by their keys; of dates only the day counts, since months are folders."""
    payers = clustering.edges_of(w["dim_payer"], ["payer_key"])["payer_key"]
    return [(F.col("payer_key"), payers), (F.col("claim_date_key") % 100, range(2, 32))]


_CLUSTERED = {"fact_claim": claim_axes}


def _view(name: str, build: Build) -> None:
    _VIEWS[name] = build


def _table(name: str, build: Build) -> None:
    _TABLES[name] = build


class Warehouse:
    """Tables by name over one folder of source files."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.as_of, self.now = domain.AS_OF, domain.EVENT_AS_OF
        tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:12]
        self.folder = f"{shared_dir(spark)}/wardlight-{spark.sparkContext.applicationId}/{tag}"
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name in domain.SOURCE_TABLES:
            return domain.source(self.spark, self.sf_dir, name)
        if name == "order_lines":  # joined once, read by many
            return self._store(name, domain.batch_table(self.spark, name, self.__getitem__))
        if name in domain.BATCH:
            return domain.batch_table(self.spark, name, self.__getitem__)
        if name in domain.event_sql():
            return self._store(name, self.spark.sql(domain.event_sql()[name], events=self["events"]))
        if name in _VIEWS:
            return _VIEWS[name](self)
        return self._store(name, _TABLES[name](self))

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        stored = self._write(name, df)
        for step in ("rows-staged", "staged"):
            files.delete_folder(self.spark, f"{self.folder}/{name}-{step}")
        return stored

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        path, by = f"{self.folder}/{name}", _PARTITIONS.get(name)
        if name in _MONTHS:
            df, by = df.withColumn(increment.MONTH, increment.month_of_key(_MONTHS[name])), [increment.MONTH]
            if name in _CLUSTERED:
                clustering.save_clustered_by(df, path, _CLUSTERED[name](self), by)  # and within months by payer and day
                return files.read_table(self.spark, path, df.schema)
        elif name in landing.EVENT_TABLES and events.TS in df.columns:
            df, by = df.withColumn(events.DAY, F.to_date(events.TS)), [events.DAY]
        files.save_table(df, path, partition_by=by)
        return files.read_table(self.spark, path, df.schema)

    def staged(self, name: str, df: DataFrame) -> DataFrame:
        """Rows of a table before its last steps, written and read again until the table is stored.

        Shuffles lie on disk until what they are for is written; so those before and after do not lie there together.
        """
        path = f"{self.folder}/{name}-staged"
        files.save_table(df, path)
        files.delete_folder(self.spark, f"{self.folder}/{name}-rows-staged")  # of which these were made
        return files.read_table(self.spark, path, df.schema)

    def pick(self, *names: str) -> dict[str, DataFrame]:
        return {n: self[n] for n in names}

    @property
    def dims(self) -> facts.Dims:
        return {n: self[f"dim_{n}"] for n in ("patient", "provider", "payer", "facility", "medication", "diagnosis", "plan")}


_OPEN: dict[tuple[str, str], Warehouse] = {}


def open_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of a folder in this session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPEN:
        _OPEN[key] = Warehouse(spark, sf_dir)
    return _OPEN[key]


# --- silver ------------------------------------------------------------------------------
for _name in silver.KEYS:
    _table(f"{_name}_clean", lambda w, n=_name: silver.clean(w[f"{n}_raw"], n))

for _name in ("member_enrollment", "premiums", "authorizations", "capitation", "provider_contracts",
              "hedis_compliance", "star_ratings", "risk_adjustment", "claim_appeals"):
    _view(f"{_name}_enriched", lambda w, n=_name: ods.stamp_ods(w[f"{n}_clean"]))

_view("patients_enriched", lambda w: ods.enrich_patients(w["patients_clean"], w.as_of))
_view("providers_enriched", lambda w: ods.enrich_providers(w["providers_clean"], w["ref_facilities"], w.as_of))
_view("encounters_enriched", lambda w: ods.enrich_encounters(w["encounters_clean"], w["patients_clean"], w["providers_clean"], w["ref_facilities"]))
_view("claims_enriched", lambda w: ods.enrich_claims(w["claims_clean"], w["ref_payers"], w.as_of))
_view("prescriptions_enriched", lambda w: ods.enrich_prescriptions(w["prescriptions_clean"], w["ref_medications"]))
_view("diagnoses_enriched", lambda w: ods.enrich_diagnoses(w["diagnoses_clean"], w["ref_icd_codes"], w["encounters_clean"]))

# --- dimensions ----------------------------------------------------------------------------
_table("dim_date", lambda w: dims.dim_date(w["orders"], "o_orderdate"))
_table("dim_patient", lambda w: scd.scd2_init(dims.dim_patient_src(w["patients_enriched"], w.as_of), "patient_id", "patient_key", DIM_LOAD))
_table("dim_provider", lambda w: scd.scd2_init(dims.dim_provider_src(w["providers_enriched"]), "provider_id", "provider_key", DIM_LOAD))
_table("dim_payer", lambda w: dims.dim_payer(dims.dim_payer_src(ref_payers=w["ref_payers"])))
_table("dim_facility", lambda w: dims.dim_ref(dims.dim_facility_src(w["ref_facilities"]), "facility_id", "facility_key"))
_table("dim_medication", lambda w: dims.dim_ref(dims.dim_medication_src(w["ref_medications"]), "rxnorm_code", "medication_key"))
_table("dim_diagnosis", lambda w: dims.dim_ref(dims.dim_diagnosis_src(w["ref_icd_codes"]), "icd_code", "diagnosis_key"))
_table("dim_location", lambda w: dims.dim_ref(dims.dim_location_src(w["ref_locations"]), "location_id", "location_key"))
_table("dim_monitor", lambda w: dims.dim_monitor(dims.dim_monitor_src(w["ref_devices"]), w["dim_facility"], w["dim_location"]))
_table("dim_sdoh", lambda w: dims.dim_ref(dims.dim_sdoh_src(scores.svi_by_zip(w["ref_sdoh_zipcode"])), "zip_code", "sdoh_key"))
_table("dim_plan", lambda w: dims.dim_ref(dims.dim_plan_src(w["ref_plans"]), "plan_id", "plan_key"))

# --- facts ---------------------------------------------------------------------------------
_table("fact_encounter", lambda w: keys.full_keys(facts.fact_encounter(w["encounters_enriched"], w.dims), "encounter_key", "encounter_id", ids=w["encounters_clean"]))
_table("fact_claim", lambda w: w.staged("fact_claim", keys.full_keys(w.staged("fact_claim-rows",
    facts.fact_claim(w["claims_enriched"], w.dims, w["fact_encounter"])), "claim_key", "claim_id", ids=w["claims_clean"])))
_table("fact_prescription", lambda w: w.staged("fact_prescription", keys.full_keys(w.staged("fact_prescription-rows",
    facts.fact_prescription(w["prescriptions_enriched"], w.dims, w["claims_clean"], w["fact_encounter"])), "prescription_key", "prescription_id")))
_table("fact_diagnosis", lambda w: keys.full_keys(w.staged("fact_diagnosis-rows", facts.fact_diagnosis(w["diagnoses_enriched"], w.dims, w["fact_encounter"])), "fact_diagnosis_key", "diagnosis_id", ids=w["diagnoses_clean"]))
_table("fact_premium", lambda w: keys.full_keys(facts.fact_premium(w["premiums_enriched"], w.dims), "premium_key", "premium_id", ids=w["premiums_clean"]))
_table("fact_authorization", lambda w: keys.full_keys(facts.fact_authorization(w["authorizations_enriched"], w.dims), "auth_key", "auth_id", ids=w["authorizations_clean"]))
_table("fact_capitation", lambda w: keys.full_keys(facts.fact_capitation(w["capitation_enriched"], w.dims), "capitation_key", "capitation_id", ids=w["capitation_clean"]))
_table("fact_appeal", lambda w: keys.full_keys(facts.fact_appeal(w["claim_appeals_enriched"], w.dims, w["fact_claim"]), "appeal_key", "appeal_id", ids=w["claim_appeals_clean"]))
_table("bridge_provider_contract", lambda w: facts.bridge_provider_contract(w["provider_contracts_enriched"], w.dims))

# --- aggregates ------------------------------------------------------------------------------
_table("agg_readmission_by_date", lambda w: aggregates.agg_readmission(w["fact_encounter"]))
_table("agg_denial_by_date", lambda w: aggregates.agg_denial_date(w["fact_claim"]))
_table("agg_denial_by_payer", lambda w: aggregates.agg_denial_payer(w["fact_claim"], w["dim_payer"]))
_table("agg_revenue_by_drg", lambda w: aggregates.agg_drg(w["fact_encounter"]))
_table("agg_days_in_ar", lambda w: aggregates.agg_ar(w["fact_claim"], w["dim_payer"]))
_table("agg_appeal_outcomes", lambda w: aggregates.agg_appeals(w["fact_claim"], w["dim_payer"]))
_table("agg_mlr_by_payer_month", lambda w: aggregates.agg_mlr(w["fact_premium"], w["fact_claim"], w["dim_payer"]))
_table("agg_hedis_compliance", lambda w: aggregates.agg_hedis(w["hedis_compliance_enriched"], w["dim_payer"], w["dim_plan"]))
_table("agg_star_rating", lambda w: aggregates.agg_star(w["star_ratings_enriched"], w["dim_payer"]))
_table("agg_star_rating_overall", lambda w: aggregates.agg_star_overall(w["agg_star_rating"]))
_table("agg_raf_score", lambda w: aggregates.agg_raf(w["risk_adjustment_enriched"], w["dim_patient"], w["dim_payer"], w["dim_plan"]))
_table("agg_medication_adherence", lambda w: aggregates.pdc(w["fact_prescription"], w["dim_medication"]))

# --- events ------------------------------------------------------------------------------------
_table("landing_parsed", lambda w: landing.parse_events(w["landing_raw"]))
for _name in landing.EVENT_TABLES:
    _table(_name, lambda w, n=_name: landing.route(w["landing_parsed"], n))

_table("fraud_scores", lambda w: fraud.fraud_scores(w["claims_events"], w["dim_provider"], w["dim_facility"], fraud.provider_baseline(w["fact_claim"], w["dim_provider"])))
_table("care_gap_alerts", lambda w: caregaps.care_gap_alerts(w["adt_events"], w["care_gaps"], w["dim_patient"], w["dim_facility"], w["hedis_measures"]))
_table("highcost_alerts", lambda w: highcost.highcost_alerts(w["claims_events"], w["adt_events"], w["dim_patient"], w["dim_facility"], w.now))

WEEK = "7 days"  # the look-back of the stored persona tables; the functions' own defaults are shorter


def coo_limits(w: Warehouse) -> DataFrame:
    return alerts.thresholds(w["dashboard_thresholds"], alerts.COO_DEFAULTS)


def cto_limits(w: Warehouse) -> DataFrame:
    return alerts.thresholds(w["dashboard_thresholds"], alerts.CTO_DEFAULTS)


_table("provider_alerts", lambda w: alerts.union_alerts(alerts.readmission_alerts(w["readmission_events"], w["dim_provider"]), alerts.quality_drift(w["quality_metric_events"])))
_table("payer_alerts", lambda w: alerts.union_alerts(
    alerts.denial_spikes(w["denial_adjudication_events"], w.now, WEEK), alerts.high_dollar_denials(w["denial_adjudication_events"], w.now, WEEK),
    alerts.ar_breaches(w["ar_snapshot_events"]), alerts.auth_expiring(w["auth_lifecycle_events"])))
_table("coo_alerts", lambda w: alerts.union_alerts(
    alerts.capacity_alerts(w["ops_capacity_events"], coo_limits(w), w.now, WEEK), alerts.staffing_alerts(w["staffing_acuity_events"], coo_limits(w), w.now, WEEK)))
_table("cto_alerts", lambda w: alerts.union_alerts(
    alerts.dq_alerts(w["dq_violation_events"], cto_limits(w), w.now, WEEK), alerts.phi_alerts(w["audit_access_events"], cto_limits(w), w.now, WEEK),
    alerts.drift_alerts(w["model_drift_events"], cto_limits(w), w.now, WEEK)))
_table("all_alerts", lambda w: views.all_alerts(w, w.now, "30 days"))
_view("persona_alerts", lambda w: views.persona_alerts(w))
_view("worklist_alerts", lambda w: views.worklist_alerts(w["fraud_scores"], w["care_gap_alerts"], w["highcost_alerts"], w.now, WEEK))

GOLD = [n for n in _TABLES if n.startswith(("dim_", "fact_", "agg_", "bridge_"))]
