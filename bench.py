"""Time the headline work: building the tables from the source files, then the main queries.

Prints one JSON line. ``BENCH_SF_DIR`` names the source folder, ``BENCH_CPUS`` the cores.
The tables are built from nothing in every run; their time is part of the total.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardlight.plans import catalog  # noqa: E402
from wardlight.plans.warehouse import open_warehouse  # noqa: E402
from wardlight.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Steps of the build in the order they depend on each other.
BUILD = {
    "build_silver": ["patients_clean", "providers_clean", "encounters_clean", "claims_clean", "prescriptions_clean", "diagnoses_clean", "member_enrollment_clean",
                     "premiums_clean", "authorizations_clean", "capitation_clean", "provider_contracts_clean", "hedis_compliance_clean", "star_ratings_clean",
                     "risk_adjustment_clean", "claim_appeals_clean"],
    "build_dims": ["dim_date", "dim_patient", "dim_provider", "dim_payer", "dim_facility", "dim_medication", "dim_diagnosis", "dim_sdoh", "dim_plan"],
    "build_facts": ["fact_encounter", "fact_claim", "fact_prescription", "fact_diagnosis", "fact_premium", "fact_authorization", "fact_capitation", "fact_appeal",
                    "bridge_provider_contract"],
    "build_aggregates": ["agg_readmission_by_date", "agg_denial_by_date", "agg_denial_by_payer", "agg_revenue_by_drg", "agg_days_in_ar", "agg_appeal_outcomes",
                         "agg_mlr_by_payer_month", "agg_medication_adherence"],
    "build_events": ["landing_raw", "landing_parsed", "claims_events", "adt_events", "rx_events", "readmission_events", "denial_adjudication_events"],
    "build_alerts": ["fraud_scores", "care_gap_alerts", "highcost_alerts", "provider_alerts", "payer_alerts", "coo_alerts", "cto_alerts", "all_alerts", "alert_closure_events"],
}

HEADLINE = [
    "b12_dedup_latest", "c01_assign_keys", "c02_full_keys", "c03_scd2_merge", "c05_upsert_claims", "e05_denial_score", "e09_care_gap_eligible", "e11_raf_score", "e13_member_months",
    "e21_ks", "f03_denial_by_payer", "f05_days_in_ar", "f07_mlr_by_payer_month", "f11_medication_adherence", "f12_adherence_exact", "h04_router_stream", "h09_tumbling_5m",
    "h13_window_stream", "j02_velocity", "j06_fraud_scores", "j11_rolling_spend", "j15_highcost_alerts", "j30_all_alerts", "j34_mttr_summary", "l01_measures_by_columns", "l09_snowflake_filter",
    "m057_quality_score", "n12_provider_payer_network", "n13_edge_coverage", "q003_readmission_drivers", "q026_denials_by_payer", "q078_high_risk_by_provider", "r04_table_counts",
]


def timed(step) -> float:
    start = time.perf_counter()
    step()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = build_session("wardlight-bench", f"local[{CPUS}]", **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()
    w, times = open_warehouse(spark, SF_DIR), {}
    for step, tables in BUILD.items():
        times[step] = timed(lambda names=tables: [w[n] for n in names])
    for name in HEADLINE:
        times[name] = timed(lambda n=name: catalog.run(n, spark, SF_DIR).write.format("noop").mode("overwrite").save())
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/"))}))


if __name__ == "__main__":
    main()
