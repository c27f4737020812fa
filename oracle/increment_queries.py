"""Expected SQL for the incremental load: the full build, with keys of the first load before those of the drop."""

from __future__ import annotations

from oracle.base import q
from oracle.tables import d

_DAY = f"COALESCE({d('submit_date')}, DATE '1990-01-01')"
q("c23_increment_silver", "SELECT * EXCLUDE (_bronze_load_timestamp) FROM claims_clean")
_KEY = "CASE WHEN first THEN 0 ELSE COUNT(*) FILTER (WHERE first) OVER () END + ROW_NUMBER() OVER (PARTITION BY first ORDER BY {id})"
q("c23_increment_claims", f"""SELECT * EXCLUDE (first, loaded_key) REPLACE ({_KEY.format(id='claim_id')} AS claim_key, loaded_key AS encounter_key)
    FROM fact_claim JOIN (SELECT DISTINCT claim_id, {_DAY} < DATE '1998-01-01' AS first FROM claims_raw) t USING (claim_id)
    LEFT JOIN (SELECT encounter_key, {_KEY.format(id='encounter_id')} AS loaded_key
        FROM fact_encounter JOIN (SELECT DISTINCT encounter_id, COALESCE({d('admit_date')}, DATE '1990-01-01') < DATE '1998-01-01' AS first FROM encounters_raw) r USING (encounter_id)) e USING (encounter_key)""")
for _name, _fact, _without in (("encounters", "fact_encounter", "encounter_key"), ("diagnoses", "fact_diagnosis", "fact_diagnosis_key, encounter_key"),
                               ("premiums", "fact_premium", "premium_key"), ("authorizations", "fact_authorization", "auth_key"), ("capitation", "fact_capitation", "capitation_key"),
                               ("claim_appeals", "fact_appeal", "appeal_key, claim_key")):
    q(f"c23_increment_{_name}", f"SELECT * EXCLUDE ({_without}) FROM {_fact}")
for _name in ("readmission_by_date", "denial_by_date", "denial_by_payer", "days_in_ar", "mlr_by_payer_month", "revenue_by_drg", "appeal_outcomes"):
    q(f"c23_increment_{_name}", f"SELECT * FROM agg_{_name}")
