"""All expected results."""

from __future__ import annotations

from oracle import events_queries, increment_queries, metrics_queries, questions, scores_queries, tables, tables_queries, tiles_queries
from oracle.base import QUERIES, full_sql

MODULES = (tables, tables_queries, increment_queries, scores_queries, events_queries, metrics_queries, tiles_queries, questions)


_CLAIM = "billed_amount allowed_amount paid_amount appeal_amount_recovered"
_PREMIUM = "premium_amount subsidy_amount member_paid"
# Queries that give out exact money columns: these are shown as doubles.
MONEY = {
    "l04_filtered_measure": "approved_billed", "n05_denied_claims": "billed_amount", "b13_clean_encounters": "total_charges", "b13_clean_claims": _CLAIM, "b13_clean_prescriptions": "total_cost copay_amount",
    "b14_clean_member_enrollment": "pmpm_premium", "b14_clean_premiums": _PREMIUM, "b14_clean_capitation": "capitation_pmpm", "b14_clean_claim_appeals": "appeal_amount_recovered",
    "a09_clustered_claims": _CLAIM, "c16_fact_encounter": "total_charges total_cost expected_reimbursement", "c17_fact_claim": _CLAIM, "c23_increment_silver": _CLAIM, "c23_increment_claims": _CLAIM, "c17_fact_claim_hashed_denials": _CLAIM, "c18_fact_prescription": "total_cost payer_paid patient_copay",
    "c20_fact_premium": _PREMIUM, "c20_fact_capitation": "capitation_pmpm", "c20_fact_appeal": "appeal_amount_recovered", "d04_encounters": "total_charges", "d05_claims": _CLAIM,
    "c23_increment_encounters": "total_charges total_cost expected_reimbursement", "c23_increment_premiums": _PREMIUM,
    "c23_increment_capitation": "capitation_pmpm", "c23_increment_claim_appeals": "appeal_amount_recovered", "d06_prescriptions": "total_cost copay_amount", "d08_premiums_stamped": _PREMIUM,
}


def _shown(name: str, body: str) -> str:
    if name not in MONEY:
        return body
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MONEY[name].split())
    return f"SELECT * REPLACE ({casts}) FROM ({body}) shown"


def expected() -> dict[str, str]:
    return {name: full_sql(_shown(name, body)) for name, body in QUERIES.items()}
