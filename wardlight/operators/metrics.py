"""Named measures over the star schema, evaluated by any dimension column.

A measure belongs to one table; measures of several tables under one grouping are
aggregated apart, each at its own grain, and then brought together on the group keys.
No fact is ever joined with another fact.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlight import reference_data as ref
from wardlight.functions import scalars as s
from wardlight.operators.events import union_all
from wardlight.operators.increment import MONTH

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Measure:
    """Aggregate over one table; ``dims`` are dimensions its expression reads."""

    table: str
    agg: Callable[[], Column]
    dims: tuple[str, ...] = ()
    roles: Mapping[str, str] = field(default_factory=dict)

    def using(self, dim: str, key: str) -> Measure:
        """The same measure related to a dimension through another key."""
        return Measure(self.table, self.agg, self.dims, {**self.roles, dim: key})

    def where(self, cond: Callable[[], Column], value: Callable[[], Column]) -> Measure:
        """Sum of a value over the rows for which the condition holds."""
        return Measure(self.table, lambda: F.sum(F.when(cond(), value())), self.dims, self.roles)


@dataclass(frozen=True)
class Derived:
    """Expression over other measures of the same group."""

    parts: tuple[str, ...]
    expr: Callable[..., Column]


# Many-to-one relationships: table -> dimension -> (column of the table, column of the dimension).
def _keys(**pairs: str) -> dict[str, tuple[str, str]]:
    return {f"dim_{name}": (column, "date_key" if name == "date" else f"{name}_key") for name, column in pairs.items()}


RELATIONS: dict[str, dict[str, tuple[str, str]]] = {
    "fact_encounter": _keys(patient="patient_key", provider="provider_key", date="encounter_date_key", facility="facility_key"),
    "fact_claim": _keys(patient="patient_key", provider="provider_key", payer="payer_key", date="claim_date_key", facility="facility_key"),
    "fact_prescription": _keys(patient="patient_key", provider="provider_key", payer="payer_key", medication="medication_key", date="fill_date_key"),
    "fact_diagnosis": _keys(patient="patient_key", diagnosis="diagnosis_key"),
    "agg_medication_adherence": _keys(patient="patient_key", medication="medication_key"),
    "fact_premium": _keys(patient="member_key", payer="payer_key", plan="plan_key", date="year_month_key"),
    "fact_authorization": _keys(patient="member_key", provider="provider_key", payer="payer_key", date="submit_date_key"),
    "fact_capitation": _keys(patient="member_key", provider="provider_key", payer="payer_key", plan="plan_key"),
    "fact_appeal": _keys(patient="member_key", payer="payer_key", date="submit_date_key"),
    "bridge_provider_contract": _keys(provider="provider_key", payer="payer_key"),
    "agg_mlr_by_payer_month": _keys(payer="payer_key"),
    "agg_hedis_compliance": _keys(payer="payer_key", plan="plan_key"),
    "agg_star_rating": _keys(payer="payer_key"),
    "agg_star_rating_overall": _keys(payer="payer_key"),
    "agg_raf_score": _keys(patient="member_key", payer="payer_key", plan="plan_key"),
    "dim_patient": {"dim_sdoh": ("zip_code", "zip_code")},
}


def _n() -> Column:
    return F.count(F.lit(1))


def _count(cond: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.count_if(cond())


def _share(cond: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: s.ratio(F.count_if(cond()), _n())


def _is(col: str, value) -> Callable[[], Column]:
    return lambda: F.col(col) == value


def _sum(col: str) -> Callable[[], Column]:
    return lambda: F.sum(col).cast("double")


def _mean(col: str) -> Callable[[], Column]:
    return lambda: s.rounded(F.avg(F.col(col).cast("double")), 6)


def distinct_count(col: str) -> Column:
    """Distinct values, a missing value counting as one."""
    return F.countDistinct(col) + F.coalesce(F.max(F.col(col).isNull().cast("int")), F.lit(0))


def _over(numerator: str, denominator: str) -> Derived:
    return Derived((numerator, denominator), s.ratio)


_CLAIM, _ENC, _RX, _DX, _ADH, _PAT, _PRV = ("fact_claim", "fact_encounter", "fact_prescription", "fact_diagnosis", "agg_medication_adherence", "dim_patient", "dim_provider")
_chronic = _is("dim_diagnosis.is_chronic", 1)


def _decided() -> Column:
    return F.coalesce(F.col("auth_outcome"), F.lit("")) != ""


MEASURES: dict[str, Measure | Derived] = {
    "high_risk_denials": Measure(_CLAIM, _count(_is("denial_risk_category", "High"))),
    "adherent_rate": Measure(_ADH, _share(_is("adherence_category", "Adherent"))),
    "avg_pdc_score": Measure(_ADH, _mean("pdc_score")),
    "total_patients": Measure(_PAT, _count(_is("dim_patient.is_current", 1))),
    "chronic_patients": Measure(_DX, lambda: F.countDistinct(F.when(_chronic(), F.col("fact_diagnosis.patient_key"))), ("dim_diagnosis",)),
    "chronic_rate": _over("chronic_patients", "total_patients"),
    "avg_patient_age": Measure(_PAT, _mean("dim_patient.age")),
    "female_patients": Measure(_PAT, _count(lambda: (F.col("dim_patient.is_current") == 1) & (F.col("dim_patient.gender") == "Female"))),
    "male_patients": Measure(_PAT, _count(lambda: (F.col("dim_patient.is_current") == 1) & (F.col("dim_patient.gender") == "Male"))),
    "avg_satisfaction_score": Measure(_PRV, _mean("patient_satisfaction_score")),
    "avg_documentation_score": Measure(_PRV, _mean("documentation_score")),
    "avg_ehr_adoption_score": Measure(_PRV, _mean("ehr_adoption_score")),
    "telehealth_enabled_rate": Measure(_PRV, _share(lambda: F.col("telehealth_enabled"))),
    "board_certified_rate": Measure(_PRV, _share(lambda: F.col("board_certified"))),
    "avg_panel_size": Measure(_PRV, _mean("patient_panel_size")),
    "avg_rvu_target": Measure(_PRV, _mean("annual_rvu_target")),
    "value_based_provider_rate": Measure(_PRV, _share(_is("contract_type", "Value-Based"))),
    "avg_actual_rvu": Measure(_PRV, _mean("actual_rvu")),
    "rvu_attainment_pct": Measure(_PRV, lambda: s.ratio(F.sum("actual_rvu"), F.sum("annual_rvu_target"))),
    "distinct_encounter_patients": Measure(_ENC, lambda: distinct_count("fact_encounter.patient_key")),
    "distinct_providers": Measure(_PRV, lambda: F.countDistinct("dim_provider.provider_key")),
    "actual_panel_count": _over("distinct_encounter_patients", "distinct_providers"),
    "panel_utilization_pct": _over("actual_panel_count", "avg_panel_size"),
    "total_claims": Measure(_CLAIM, _n),
    "denial_rate": Measure(_CLAIM, _share(_is("denial_flag", 1))),
    "total_billed": Measure(_CLAIM, _sum("billed_amount")),
    "total_paid": Measure(_CLAIM, _sum("paid_amount")),
    "collection_rate": Measure(_CLAIM, lambda: s.ratio(F.sum("paid_amount"), F.sum("billed_amount"))),
    "at_risk_revenue": Measure(_CLAIM, lambda: F.coalesce(F.sum(F.when(F.col("denial_risk_category").isin("High", "Medium"), F.col("billed_amount"))), F.lit(0)).cast("double")),
    "avg_denial_risk": Measure(_CLAIM, _mean("denial_risk_score")),
    "avg_days_to_payment": Measure(_CLAIM, _mean("days_to_payment")),
    "net_collection_rate": Measure(_CLAIM, _mean("net_collection_rate")),
    "net_collection_ratio": Measure(_CLAIM, lambda: s.ratio(F.sum("paid_amount"), F.sum("allowed_amount"))),
    "appeal_success_rate": Measure(_CLAIM, lambda: s.ratio(F.count_if(F.col("appeal_outcome").isin("Overturned", "Partial")), F.count("appeal_outcome"))),
    "total_appeal_recovery": Measure(_CLAIM, _sum("appeal_amount_recovered")),
    "unique_diagnoses": Measure(_DX, lambda: distinct_count("fact_diagnosis.diagnosis_key")),
    "chronic_diagnoses": Measure(_DX, lambda: F.countDistinct(F.when(_chronic(), F.col("fact_diagnosis.diagnosis_key"))), ("dim_diagnosis",)),
    "patients_with_chronic_conditions": Measure(_DX, lambda: F.countDistinct(F.when(_chronic(), F.col("fact_diagnosis.patient_key"))), ("dim_diagnosis",)),
    "total_encounters": Measure(_ENC, _n),
    "readmission_rate": Measure(_ENC, _share(_is("readmission_flag", 1))),
    "high_risk_readmissions": Measure(_ENC, _count(_is("readmission_risk_category", "High"))),
    "medium_risk_readmissions": Measure(_ENC, _count(_is("readmission_risk_category", "Medium"))),
    "low_risk_readmissions": Measure(_ENC, _count(_is("readmission_risk_category", "Low"))),
    "avg_length_of_stay": Measure(_ENC, _mean("length_of_stay")),
    "avg_readmission_risk": Measure(_ENC, _mean("readmission_risk_score")),
    "total_charges": Measure(_ENC, _sum("total_charges")),
    "total_cost": Measure(_ENC, _sum("total_cost")),
    "avg_drg_weight": Measure(_ENC, _mean("drg_weight")),
    "total_expected_reimbursement": Measure(_ENC, _sum("expected_reimbursement")),
    "drg_margin": Derived(("total_expected_reimbursement", "total_cost"), lambda r, c: s.rounded(s.ratio(r - c, r), 6)),
    "total_rx_cost": Measure(_RX, _sum("total_cost")),
    "calendar_months": Measure("dim_date", lambda: F.countDistinct("dim_date.year", "dim_date.month_number")),
    "calendar_month_numbers": Measure("dim_date", lambda: F.countDistinct("dim_date.month_number")),
    "pmpm": Derived(("total_cost", "total_rx_cost", "total_patients", "calendar_months"),
                    lambda c, r, p, m: s.rounded(s.ratio(c + F.coalesce(r, F.lit(0.0)), p * F.greatest(m, F.lit(1))), 6)),
    "avg_cost_per_encounter": _over("total_cost", "total_encounters"),
    "inpatient_encounters": Measure(_ENC, _count(_is("encounter_type", "Inpatient"))),
    "emergency_encounters": Measure(_ENC, _count(_is("encounter_type", "Emergency"))),
    "quality_score": Derived(("readmission_rate", "adherent_rate", "denial_rate"), lambda r, a, d: s.rounded(((1 - r) + a + (1 - d)) / 3, 6)),
    "total_fills": Measure(_RX, _n),
    "avg_rx_cost_per_fill": _over("total_rx_cost", "total_fills"),
    "generic_fill_rate": Measure(_RX, _share(_is("is_generic", 1))),
    "payer_rx_cost": Measure(_RX, _sum("payer_paid")),
    "patient_copay_total": Measure(_RX, _sum("patient_copay")),
    "hedis_compliance_pct": Measure("agg_hedis_compliance", lambda: s.ratio(F.sum("numerator_met"), F.sum("denominator_eligible"))),
    "hedis_eligible_members": Measure("agg_hedis_compliance", lambda: F.sum("denominator_eligible")),
    "hedis_numerator_met": Measure("agg_hedis_compliance", lambda: F.sum("numerator_met")),
    "premium_collected": Measure("agg_mlr_by_payer_month", lambda: F.sum(F.col("premium_collected").cast("decimal(18,2)")).cast("double")),
    "medical_paid": Measure("agg_mlr_by_payer_month", lambda: F.sum(F.col("medical_paid").cast("decimal(18,2)")).cast("double")),
    "mlr_pct": _over("medical_paid", "premium_collected"),
    "avg_raf_score": Measure("agg_raf_score", _mean("raf_score")),
    "avg_hcc_count": Measure("agg_raf_score", _mean("hcc_count")),
    "members_with_hccs": Measure("agg_raf_score", lambda: F.countDistinct(F.when(F.col("hcc_count") > 0, F.col("member_key")))),
    "avg_star_score": Measure("agg_star_rating", _mean("star_score")),
    "weighted_star_score": Measure("agg_star_rating", lambda: s.rounded(s.ratio(F.sum("weighted_score"), F.sum("weight")), 6)),
    "overall_star_score": Measure("agg_star_rating_overall", _mean("overall_star_score")),
    "contract_count": Measure("bridge_provider_contract", _n),
    "in_network_contract_rate": Measure("bridge_provider_contract", _share(lambda: F.col("is_in_network"))),
    "total_payers": Measure("dim_payer", _count(_is("dim_payer.is_active", 1))),
    "avg_reimbursement_rate": Measure("dim_payer", _mean("avg_reimbursement_pct")),
    "large_network_payers": Measure("dim_payer", _count(lambda: (F.col("dim_payer.network_size") == "Large") & (F.col("dim_payer.is_active") == 1))),
    "commercial_payers": Measure("dim_payer", _count(lambda: (F.col("dim_payer.payer_type") == "Commercial") & (F.col("dim_payer.is_active") == 1))),
    "government_payers": Measure("dim_payer", _count(lambda: (F.col("dim_payer.payer_type") == "Government") & (F.col("dim_payer.is_active") == 1))),
    "total_plans": Measure("dim_plan", _count(_is("dim_plan.is_active", 1))),
    "capitated_plan_count": Measure("dim_plan", _count(lambda: F.col("dim_plan.is_capitated"))),
    "total_appeals": Measure("fact_appeal", _n),
    "appeal_recovery": Measure("fact_appeal", _sum("appeal_amount_recovered")),
    "appeal_win_rate": Measure("fact_appeal", _share(_is("appeal_outcome", "Won"))),
    "appeal_favourable_rate": Measure("fact_appeal", _share(lambda: F.col("appeal_outcome").isin("Overturned", "Partial"))),
    "total_auths": Measure("fact_authorization", _n),
    "pa_approval_rate": Measure("fact_authorization", lambda: s.ratio(F.count_if(F.col("auth_outcome") == "Approved"), F.count_if(_decided()))),
    "pa_denial_rate": Measure("fact_authorization", lambda: s.ratio(F.count_if(F.col("auth_outcome") == "Denied"), F.count_if(_decided()))),
    "avg_decision_tat": Measure("fact_authorization", _mean("decision_tat_hours")),
    "total_capitation_paid": Measure("fact_capitation", _sum("capitation_pmpm")),
    "avg_capitation_pmpm": Measure("fact_capitation", lambda: s.mean_money("capitation_pmpm")),
    "avg_withhold_pct": Measure("fact_capitation", _mean("withhold_pct")),
    "collection_rate_of_totals": _over("total_paid", "total_billed"),
    "at_risk_revenue_high": Measure(_CLAIM, lambda: F.sum(F.when(F.col("denial_risk_category") == "High", F.col("billed_amount"))).cast("double")),
    "appeal_success_rate_won": Measure(_CLAIM, lambda: s.ratio(F.count_if(F.col("appeal_outcome") == "Won"), F.count("appeal_outcome"))),
    "pmpm_charges": Derived(("total_charges", "distinct_encounter_patients", "calendar_month_numbers"), lambda c, p, m: s.ratio(c, p * m)),
    "total_premium_revenue": Measure("fact_premium", _sum("premium_amount")),
    "member_months": Measure("fact_premium", _n),
    "premium_pmpm": _over("total_premium_revenue", "member_months"),
    "total_subsidy": Measure("fact_premium", _sum("subsidy_amount")),
    "total_member_paid": Measure("fact_premium", _sum("member_paid")),
    "total_providers": Measure(_PRV, _count(_is("dim_provider.is_current", 1))),
    "full_time_providers": Measure(_PRV, _count(lambda: (F.col("fte_status") == "Full-time") & (F.col("dim_provider.is_current") == 1))),
    "avg_years_experience": Measure(_PRV, _mean("years_experience")),
    "high_risk_sdoh_patients": Measure(_PAT, _count(lambda: (F.col("dim_patient.is_current") == 1) & (F.col("dim_sdoh.risk_tier") == "High")), ("dim_sdoh",)),
    "avg_svi": Measure("dim_sdoh", _mean("dim_sdoh.social_vulnerability_index")),
    "provider_denial_count": Measure(_CLAIM, _count(_is("denial_flag", 1))),
    "telehealth_encounters": Measure(_ENC, _count(_is("encounter_type", "Telehealth"))),
    "telehealth_rate": _over("telehealth_encounters", "total_encounters"),
    "unique_medications_prescribed": Measure(_RX, lambda: distinct_count("fact_prescription.medication_key")),
    "inpatient_readmission_rate": Measure(_ENC, lambda: s.ratio(F.count_if((F.col("readmission_flag") == 1) & (F.col("encounter_type") == "Inpatient")), F.count_if(F.col("encounter_type") == "Inpatient"))),
    "revenue_leakage": Measure(_CLAIM, lambda: F.sum(F.when(F.col("claim_status") == "Approved", F.col("billed_amount") - F.col("paid_amount"))).cast("double")),
    "approved_billed": Measure(_CLAIM, _n).where(_is("claim_status", "Approved"), lambda: F.col("billed_amount").cast("decimal(18,2)")),
}
MEASURES["paid_by_payment_date"] = MEASURES["total_paid"].using("dim_date", "payment_date_key")


def _needed(names: list[str]) -> list[str]:
    """Base measures behind the names, in order of first use."""
    out: list[str] = []
    for name in names:
        measure = MEASURES[name]
        out += _needed(list(measure.parts)) if isinstance(measure, Derived) else [name]
    return list(dict.fromkeys(out))


def _dimension_of(column: str) -> str:
    return column.split(".")[0]


def _path(table: str, dim: str) -> list[str] | None:
    """Dimensions to join, nearest first, to reach ``dim`` from the table."""
    if dim == table:
        return []
    direct = RELATIONS.get(table, {})
    if dim in direct:
        return [dim]
    for near in direct:
        if dim in RELATIONS.get(near, {}):
            return [near, dim]
    return None


def _joined(tables: Tables, table: str, dims: list[str], roles: Mapping[str, str]) -> DataFrame:
    """The table with its dimensions, each left-joined: unmatched rows stay in a blank member."""
    df = tables[table].alias(table)
    done: list[str] = []
    for dim in dims:
        source = table
        for step in _path(table, dim) or []:
            if step not in done:
                column, key = RELATIONS[source][step]
                column = roles.get(step, column)
                df = df.join(tables[step].alias(step), F.col(f"{source}.{column}") == F.col(f"{step}.{key}"), "left")
                done.append(step)
            source = step
    return df


def _frame(tables: Tables, table: str, roles: Mapping[str, str], names: list[str], by: list[str], filters: list[tuple[str, Callable[[Column], Column]]]) -> tuple[DataFrame, list[str]]:
    """Measures of one table by the group columns it can reach."""
    reach = [c for c in by if _path(table, _dimension_of(c)) is not None]
    kept = [(c, f) for c, f in filters if c != MONTH and _path(table, _dimension_of(c)) is not None]
    dims = [_dimension_of(c) for c in [*reach, *[c for c, _ in kept]]] + [d for n in names for d in MEASURES[n].dims]
    df = _joined(tables, table, dims, roles)
    if MONTH in tables[table].columns and "dim_date" not in roles:  # the table lies by month of its main date
        for cond in [f for c, f in filters if c == MONTH]:
            df = df.filter(cond(F.col(f"{table}.{MONTH}")))
    for column, cond in kept:
        df = df.filter(cond(F.col(column)))
    keys = [F.col(c).alias(c.split(".")[1]) for c in reach]
    return df.groupBy(*keys).agg(*[MEASURES[n].agg().alias(n) for n in names]), [c.split(".")[1] for c in reach]


def evaluate(tables: Tables, measures: list[str], by: list[str] | None = None, filters: list[tuple[str, Callable[[Column], Column]]] | None = None,
             top: int | None = None, order: str | None = None, ascending: bool = False) -> DataFrame:
    """Measures by dimension columns (``table.column``).

    A table that has no relation to a group column gives the same figure in all its
    groups, as in a star-schema report; a group that only this table has is kept, with
    NULL in the columns it does not reach. Tables without a common group column give
    rows of their own. A filter holds for the tables that can reach its column and is
    passed over by the others, as in such a report. ``order`` and ``top`` give the first
    rows by a measure.
    """
    by, filters = by or [], filters or []
    groups: dict[tuple, list[str]] = {}
    for name in _needed(measures):
        measure = MEASURES[name]
        groups.setdefault((measure.table, tuple(sorted(measure.roles.items()))), []).append(name)
    keys = [c.split(".")[1] for c in by]
    full, partial = [], []
    for (table, roles), names in groups.items():
        df, reached = _frame(tables, table, dict(roles), names, by, filters)
        (full if reached == keys else partial).append((df, reached, names))
    if full and len(full) > 1:
        stacked = [df.select(*keys, *[F.col(n) if n in names else F.lit(None).cast(other.schema[n].dataType).alias(n) for other, _, ns in full for n in ns]) for df, _, names in full]
        out = union_all(stacked).groupBy(*keys).agg(*[F.max(n).alias(n) for _, _, ns in full for n in ns])
        have = keys
    else:
        (out, have, _), partial = (full[0], partial) if full else (partial[0], partial[1:])
    for df, reached, names in partial:
        shared = [k for k in reached if k in have]
        if shared:
            right = df.select(*[F.col(k).alias(f"_{k}") for k in shared], *[k for k in reached if k not in have], *names)
            out = out.join(right, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in shared], "full")
            out = out.withColumns({k: F.coalesce(k, f"_{k}") for k in shared}).drop(*[f"_{k}" for k in shared])
        elif reached:
            out = out.unionByName(df, allowMissingColumns=True)
        else:
            out = out.withColumns({n: df.select(n).scalar() for n in names})
        have = [k for k in keys if k in have or k in reached]
    out = out.withColumns({k: F.lit(None).cast("string") for k in keys if k not in have})
    shown = out.select(*keys, *[_value(n).alias(n) for n in measures])
    if order:
        direction = F.col(order).asc_nulls_last() if ascending else F.col(order).desc_nulls_last()
        shown = shown.orderBy(direction, *[F.col(k).asc_nulls_last() for k in keys])
    return shown.limit(top) if top else shown


def _value(name: str) -> Column:
    measure = MEASURES[name]
    return measure.expr(*[_value(p) for p in measure.parts]) if isinstance(measure, Derived) else F.col(name)


# --- time -----------------------------------------------------------------------------------

def prior_year(df: DataFrame, value: str, year: str = "year", keys: list[str] | None = None) -> DataFrame:
    """The value of the same period a year before, and the growth since."""
    keys = keys or []
    before = df.select((F.col(year) + 1).alias(year), *keys, F.col(value).alias(f"py_{value}"))
    joined = df.join(before, [year, *keys], "left")
    return joined.withColumn("yoy_growth", s.rounded(s.ratio(F.col(value) - F.col(f"py_{value}"), F.col(f"py_{value}")), 6))


def to_date(df: DataFrame, value: str, period: list[str], order: str, name: str) -> DataFrame:
    """Running total within a period; the input has one row per period step."""
    window = Window.partitionBy(*period).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    amount = F.col(value).cast("decimal(18,2)") if dict(df.dtypes)[value] == "double" else F.col(value)
    running = F.sum(amount).over(window)
    return df.withColumn(name, running.cast("double") if dict(df.dtypes)[value] == "double" else running)


# --- reading a measure -------------------------------------------------------------------------

def band(df: DataFrame, metric: str, column: str | None = None, bands: list[tuple] = ref.BENCHMARK_BANDS) -> DataFrame:
    """Green, amber or red by the limits of a metric."""
    value = F.col(column or metric)
    _, green, amber, better = next(b for b in bands if b[0] == metric)
    if better == "lower":
        colour = F.when(value < green, "green").when(value <= amber, "amber").otherwise("red")
    else:
        colour = F.when(value > green, "green").when(value >= amber, "amber").otherwise("red")
    return df.withColumn("band", F.when(value.isNotNull(), colour))


def calibrated_accuracy(labels: DataFrame, calibration: DataFrame) -> DataFrame:
    """Share of passes corrected for the judge's true and false positive rates.

    ``labels`` has judge_label; ``calibration`` has expected_label and judge_label.
    """
    expected, judged = F.col("expected_label") == "pass", F.col("judge_label") == "pass"
    rates = calibration.agg(
        s.ratio(F.count_if(expected & judged), F.greatest(F.count_if(expected), F.lit(1))).alias("tpr"),
        s.ratio(F.count_if(~expected & judged), F.greatest(F.count_if(~expected), F.lit(1))).alias("fpr"))
    seen = labels.agg(s.ratio(F.count_if(judged), F.count(F.lit(1))).alias("observed"))
    out = seen.withColumns({"tpr": rates.select("tpr").scalar(), "fpr": rates.select("fpr").scalar()})
    gap = F.when(F.col("tpr") - F.col("fpr") > 1e-6, F.col("tpr") - F.col("fpr")).otherwise(F.lit(1.0))
    corrected = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("observed") - F.col("fpr")) / gap))
    return out.withColumn("calibrated", s.rounded(corrected, 6)).withColumns({c: s.rounded(c, 6) for c in ("observed", "tpr", "fpr")})
