"""Risk and rule scores over batch rows: readmission, denial, vulnerability, gaps, RAF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlight import reference_data as ref
from wardlight.functions import scalars as s
from wardlight.operators.latest import latest_by
from wardlight.operators.ods import as_date


def tier(value: Column, *cuts: tuple[float, str], otherwise: str, strict: bool = False) -> Column:
    """First label whose limit the value reaches (or exceeds, with ``strict``)."""
    out = None
    for limit, label in cuts:
        hit = value > limit if strict else value >= limit
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(otherwise)


def _points(*rules: tuple[Column, float]) -> Column:
    """First rule that holds gives its points, else 0."""
    out = F.when(rules[0][0], F.lit(rules[0][1]))
    for cond, value in rules[1:]:
        out = out.when(cond, F.lit(value))
    return out.otherwise(F.lit(0.0))


def _clamped(parts: list[Column]) -> Column:
    total = reduce(lambda a, b: a + b, parts)
    return s.rounded(F.least(F.greatest(total, F.lit(0.01)), F.lit(0.99)), 4)


# --- readmission --------------------------------------------------------------------

def readmission_risk(df: DataFrame) -> DataFrame:
    """Given score or a ladder by stay and type, then flag and category."""
    los = F.coalesce(F.col("length_of_stay"), F.lit(1))
    kind = F.lower(F.coalesce(F.col("encounter_type"), F.lit("")))
    ladder = (F.when(los >= 10, 0.80).when((los >= 5) & (kind == "inpatient"), 0.65)
              .when(kind == "emergency", 0.55).when(los >= 3, 0.35).otherwise(0.15))
    given = F.col("readmission_risk") if "readmission_risk" in df.columns else F.lit(None).cast("double")
    df = df.withColumn("readmission_risk_score", F.coalesce(given, ladder))
    score = F.col("readmission_risk_score")
    return df.withColumns({"readmission_flag": F.when(score >= 0.5, 1).otherwise(0),
                           "readmission_risk_category": tier(score, (0.7, "High"), (0.3, "Medium"), otherwise="Low")})


def readmission_score(df: DataFrame, icd: DataFrame) -> DataFrame:
    """Additive score from type, stay, charges, diagnosis and where the patient went."""
    chronic = icd.filter(F.col("is_chronic") == 1).select(F.col("code").alias("primary_diagnosis_code"), F.lit(1).alias("_chronic"))
    df = df.join(chronic, "primary_diagnosis_code", "left")
    los, charges = F.col("length_of_stay"), F.col("total_charges")
    went = F.upper(F.col("discharge_disposition"))
    parts = [
        F.lit(0.15),
        _points((F.col("encounter_type").isin("Inpatient", "Emergency"), 0.10)),
        _points((los > 7, 0.15), (los > 3, 0.08)),
        _points((charges > 50000, 0.10), (charges > 20000, 0.05)),
        _points((F.col("_chronic") == 1, 0.12)),
        _points((F.col("primary_diagnosis_code").isin(ref.SEVERE_ICD), 0.10)),
        _points((went.isin("SNF", "REHAB", "HOME HEALTH"), 0.08), (went == "AMA", 0.20)),
    ]
    return df.withColumn("readmission_score", _clamped(parts)).drop("_chronic")


# --- denial ---------------------------------------------------------------------------

def hash_bucket(col: Column, buckets: int) -> Column:
    """Bucket 0..buckets-1 of a text, the same on every engine that has md5."""
    head = F.conv(F.substring(F.md5(col), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets)).cast("int")


def assign_denial(df: DataFrame, id: str, amt: str, hashed: bool = True) -> DataFrame:
    """``_is_denied``: the stated status, and with ``hashed`` a share of claims by amount."""
    stated = F.coalesce(F.lower(F.col("claim_status")).contains("denied"), F.lit(False))
    denied = stated
    if hashed:
        bucket, amount = hash_bucket(F.col(id), 100), F.coalesce(F.col(amt), F.lit(0))
        denied = stated | ((amount > 50000) & (bucket < 18)) | ((amount > 20000) & (bucket < 12)) | (bucket < 5)
    return df.withColumns({"_is_denied": denied, "_reason_bucket": hash_bucket(F.col(id), 7)})


def denial_risk(df: DataFrame, ml: str | None = "_ml_score") -> DataFrame:
    """Model score where there is one, else by denial and amount; then the category."""
    billed = F.col("billed_amount")
    rules = (F.when(F.col("_is_denied"), 0.75).when(billed > 50000, 0.55).when(billed > 20000, 0.40)
             .when(billed > 10000, 0.30).otherwise(0.15))
    model = F.col(ml).cast("double") if ml and ml in df.columns else F.lit(None).cast("double")
    df = df.withColumn("denial_risk_score", F.coalesce(model, rules))
    return df.withColumn("denial_risk_category", tier(F.col("denial_risk_score"), (0.6, "High"), (0.3, "Medium"), otherwise="Low"))


def denial_score(df: DataFrame) -> DataFrame:
    """Additive score before adjudication. Needs payer_type, cpt_code and claim_type."""
    billed = F.col("billed_amount")
    parts = [
        F.lit(0.08),
        _points((billed > 50000, 0.20), (billed > 20000, 0.10)),
        _points((F.col("cpt_code").isin(ref.HIGH_RISK_CPTS), 0.15)),
        _points((F.col("payer_type").isin("Government", "Medicaid Managed Care"), 0.05)),
        _points((F.col("claim_type") == "Inpatient", 0.05)),
    ]
    df = df.withColumn("denial_score", _clamped(parts))
    return df.withColumn("denial_score_category", tier(F.col("denial_score"), (0.40, "High"), (0.20, "Medium"), otherwise="Low"))


def denial_reason(df: DataFrame) -> DataFrame:
    """Reason and action of denied claims: given, modelled, or by bucket."""
    reasons = F.array(*[F.lit(r) for r, _ in ref.DENIAL_REASONS])
    actions = F.array(*[F.lit(a) for _, a in ref.DENIAL_REASONS])
    place = F.col("_reason_bucket") + 1
    null = F.lit(None).cast("string")
    given = F.col("denial_reason") if "denial_reason" in df.columns else null
    model = F.col("_ml_reason") if "_ml_reason" in df.columns else null
    last = F.col("_reason_bucket") == len(ref.DENIAL_REASONS) - 1
    model_action = F.when(last, F.col("_ml_action")) if "_ml_action" in df.columns else null
    denied = F.col("_is_denied")
    return df.withColumns({
        "primary_denial_reason": F.when(denied, F.coalesce(given, model, F.element_at(reasons, place))),
        "recommended_action": F.when(denied, F.coalesce(model_action, F.element_at(actions, place))),
    })


def payment_metrics(df: DataFrame) -> DataFrame:
    """Days to payment and net collection rate, derived where not given."""
    days = F.datediff(F.coalesce("payment_date", "claim_date"), F.col("claim_date"))
    allowed, paid = F.col("allowed_amount"), F.col("paid_amount")
    rate = F.when(allowed > 0, s.ratio(F.coalesce(paid, F.lit(0)), allowed)).otherwise(F.lit(0.0))
    given_days = F.col("days_to_payment") if "days_to_payment" in df.columns else F.lit(None).cast("int")
    given_rate = F.col("net_collection_rate") if "net_collection_rate" in df.columns else F.lit(None).cast("double")
    return df.withColumns({"days_to_payment": F.coalesce(given_days, days), "net_collection_rate": F.coalesce(given_rate, rate)})


# --- social vulnerability ---------------------------------------------------------------

def svi(df: DataFrame, weights: dict[str, float] = ref.SVI_WEIGHTS, cuts: tuple[float, float] = ref.SVI_CUTS,
        inverse: dict[str, float] | None = None, strict: bool = True, extra: Column | None = None) -> DataFrame:
    """Weighted index of rates; ``inverse`` weights count 1 - rate; then the tier."""
    parts = [F.col(c).cast("double") * F.lit(w) for c, w in weights.items()]
    parts += [(F.lit(1.0) - F.col(c).cast("double")) * F.lit(w) for c, w in (inverse or {}).items()]
    if extra is not None:
        parts.append(extra)
    df = df.withColumn("composite_svi_score", s.rounded(reduce(lambda a, b: a + b, parts), 4))
    return df.withColumn("risk_tier", tier(F.col("composite_svi_score"), (cuts[0], "High"), (cuts[1], "Medium"), otherwise="Low", strict=strict))


def svi_by_zip(sdoh: DataFrame) -> DataFrame:
    """Index from rates and income."""
    income = (F.lit(1.0) - F.col("median_household_income") / F.lit(120000.0)) * F.lit(0.10)
    return svi(sdoh, extra=income)


def svi_index(sdoh: DataFrame) -> DataFrame:
    """Index of the other layout, with its own weights and cut-offs."""
    return svi(sdoh, ref.SVI_INDEX_WEIGHTS, ref.SVI_INDEX_CUTS, ref.SVI_INDEX_INVERSE_WEIGHTS, strict=False)


# --- care gaps and quality --------------------------------------------------------------

def _whole_years(as_of: str | Column, born: str) -> Column:
    return F.floor(F.datediff(as_date(as_of), F.col(born)) / 365).cast("int")


def care_gap_eligible(patients: DataFrame, dx: DataFrame, measures: DataFrame, as_of: str | Column) -> DataFrame:
    """Measures each patient counts for: by age, sex, and one of the target conditions.

    A measure becomes one row for each age it covers. Measures with target conditions are
    joined by age and code, those without any by age.
    """
    people = patients.select("patient_id", "gender", _whole_years(as_of, "date_of_birth").alias("_age"))
    ages = F.explode(F.sequence(F.col("age_min").cast("int"), F.col("age_max").cast("int"))).alias("_age")
    rules = measures.filter("age_min <= age_max").select("measure_id", "measure_name", "target_icd", ages)
    by_code = rules.filter(F.col("target_icd") != "").withColumn("icd_code", F.explode(F.split("target_icd", "[|]")))
    conditions = people.join(dx.select("patient_id", "icd_code").distinct(), "patient_id")
    targeted = conditions.join(by_code, ["icd_code", "_age"]).select("patient_id", "gender", "measure_id", "measure_name").distinct()
    general = people.join(rules.filter(F.col("target_icd") == ""), "_age")
    columns = ["patient_id", "gender", "measure_id", "measure_name"]
    both = targeted.select(*columns).unionByName(general.select(*columns))
    return both.filter((F.col("measure_id") != "BCS") | (F.col("gender") == "Female")).drop("gender")


def latest_enrollment(enrollment: DataFrame) -> DataFrame:
    """Payer and plan of each member's last month."""
    last = latest_by(enrollment, ["member_id"], "year_month", "enrollment_id")
    return last.select("member_id", "payer_id", "plan_id", "year_month")


def hedis_rollup(gaps: DataFrame, enrollment: DataFrame, year: int) -> DataFrame:
    """Eligible and met per payer, plan and measure; members without a plan stay under NULL."""
    plan = latest_enrollment(enrollment).select(F.col("member_id").alias("patient_id"), "payer_id", "plan_id")
    grouped = gaps.join(plan, "patient_id", "left").groupBy("payer_id", "plan_id", "measure_id", "measure_name").agg(
        F.count(F.lit(1)).alias("denominator_eligible"),
        F.count_if(~F.col("is_gap_open").cast("boolean")).alias("numerator_met"))
    return grouped.withColumns({"measurement_year": F.lit(year),
                                "compliance_rate": s.rounded(s.ratio(F.col("numerator_met"), F.col("denominator_eligible")), 4)})


def raf_score(patients: DataFrame, dx: DataFrame, hcc: DataFrame, enrollment: DataFrame, as_of: str | Column) -> DataFrame:
    """Condition categories, demographic baseline and total risk score per enrolled member."""
    weights = hcc.select(F.col("icd_match").alias("icd_code"), "hcc_code", "raf_weight")
    hits = dx.select("patient_id", "icd_code").distinct().join(weights, "icd_code").select("patient_id", "hcc_code", "raf_weight").distinct()
    disease = hits.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("hcc_count"), F.sum("raf_weight").alias("_disease"),
        F.array_join(F.sort_array(F.collect_set("hcc_code")), ",").alias("hcc_codes"))
    age = _whole_years(as_of, "date_of_birth")
    base = F.when(age < 65, F.lit(0.30)).otherwise(F.lit(0.45) + (age - 65) * F.lit(0.012))
    demo = F.coalesce(base, F.lit(0.30)) + F.when(F.col("gender") == "Female", F.lit(0.05)).otherwise(F.lit(0.0))
    members = latest_enrollment(enrollment).select(F.col("member_id").alias("patient_id"), "payer_id", "plan_id")
    df = patients.select("patient_id", "gender", "date_of_birth", demo.alias("_demo")).join(members, "patient_id").join(disease, "patient_id", "left")
    ill = F.coalesce(F.col("_disease"), F.lit(0.0))
    return df.select(
        F.col("patient_id").alias("member_id"), "payer_id", "plan_id", F.coalesce("hcc_count", F.lit(0)).alias("hcc_count"), "hcc_codes",
        s.rounded(F.col("_demo"), 4).alias("demographic_score"), s.rounded(ill, 4).alias("disease_score"), s.rounded(F.col("_demo") + ill, 4).alias("raf_score"))


def drg_reimbursement(df: DataFrame, drg: DataFrame) -> DataFrame:
    """Weight times base rate of the encounter's DRG."""
    rates = drg.select(F.col("drg").alias("drg_code"), "weight", "base_rate")
    return df.join(rates, "drg_code", "left").withColumn("drg_payment", s.rounded(F.col("weight") * F.col("base_rate"), 2))


def member_months(spans: DataFrame, start: str = "coverage_from", end: str = "coverage_to") -> DataFrame:
    """One row per month a member is covered, from first to last day of that month."""
    months = F.sequence(F.trunc(F.col(start), "month"), F.trunc(F.col(end), "month"), F.expr("INTERVAL 1 MONTH"))
    one = spans.withColumn("coverage_start", F.explode(months)).drop(start, end)
    return one.withColumns({"coverage_end": F.last_day("coverage_start"), "year_month": F.date_format("coverage_start", "yyyy-MM")})


# --- operations ---------------------------------------------------------------------------

def revenue_variance(df: DataFrame) -> DataFrame:
    """Actual against expected payment, in dollars and percent."""
    gap = F.col("actual_payment") - F.col("expected_payment")
    pct = F.when(F.col("expected_payment") != 0, s.rounded(s.ratio(gap, F.col("expected_payment")) * 100, 2)).otherwise(F.lit(0.0))
    return df.withColumns({"variance_dollars": s.rounded(gap, 2), "variance_pct": pct})


def underpayments(df: DataFrame, limit: float = -5.0) -> DataFrame:
    return df.filter(F.col("variance_pct") < limit)


def staffing_gap(df: DataFrame) -> DataFrame:
    """Patients per nurse, the target by acuity, and the nurses missing."""
    target = F.when(F.col("acuity_score") < 3.0, 4.0).otherwise(3.0)
    missing = (F.col("patient_count") / target - F.col("nurse_count")).cast("int")
    return df.withColumns({"ratio_actual": s.rounded(s.ratio(F.col("patient_count"), F.col("nurse_count")), 2),
                           "ratio_target": target, "staffing_gap": F.greatest(F.lit(0), missing)})


def rrt_flag(df: DataFrame) -> DataFrame:
    sepsis = (F.col("deterioration_type") == "SEPSIS") & (F.col("sirs_score") >= 2)
    return df.withColumn("requires_rrt", (F.col("news2_score") >= 7) | sepsis)


def hai_severity(df: DataFrame) -> DataFrame:
    return df.withColumn("severity", tier(F.col("cluster_size"), (5, "CRITICAL"), (3, "HIGH"), (1, "MEDIUM"), otherwise="LOW"))


def utilization(df: DataFrame) -> DataFrame:
    share = F.when(F.col("threshold_value") != 0, F.col("current_value") / F.col("threshold_value") * 100).otherwise(F.lit(0.0))
    return df.withColumn("utilization_pct", s.rounded(share, 1))


def dq_violation(df: DataFrame) -> DataFrame:
    """Violations as count and percent of the expected value, with severity."""
    gap = F.abs(F.col("expected_value") - F.col("actual_value"))
    pct = F.when(F.col("expected_value") != 0, s.rounded(gap / F.col("expected_value") * 100, 2)).otherwise(F.lit(0.0))
    df = df.withColumns({"violation_count": gap.cast("int"), "violation_pct": pct})
    return df.withColumn("severity", tier(F.col("violation_pct"), (10, "CRITICAL"), (5, "HIGH"), (1, "MEDIUM"), otherwise="LOW", strict=True))


# --- quality programmes -------------------------------------------------------------------

def hrrp_penalty(enc: DataFrame, expected: DataFrame) -> DataFrame:
    """Observed over expected readmission rate by facility and condition, and the penalty."""
    conditions = expected.withColumnRenamed("icd_code", "primary_diagnosis_code")
    rates = enc.join(conditions, "primary_diagnosis_code").groupBy("facility_key", "hrrp_condition", "expected_rate").agg(
        F.count(F.lit(1)).alias("discharges"), F.sum("readmission_flag").alias("readmissions"))
    excess = s.ratio(s.ratio(F.col("readmissions"), F.col("discharges")), F.col("expected_rate"))
    return rates.withColumn("excess_ratio", s.rounded(excess, 6)).withColumn(
        "penalty", s.rounded(F.least(F.lit(ref.HRRP_MAX_PENALTY), F.greatest(F.lit(0.0), F.col("excess_ratio") - 1)), 6))


def star_from_cutpoints(df: DataFrame, by: list[str], score: str, weight: str = "weight", domain: str = "domain") -> DataFrame:
    """Stars from the percentile of a score among its peers.

    Peers are counted per distinct score first; the running count then orders distinct
    scores, not rows, so a measure with very many rows needs no single big sort.
    """
    counts = df.groupBy(*by, score).agg(F.count(F.lit(1)).alias("_n"))
    below = Window.partitionBy(*by).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.withColumns({"_below": F.coalesce(F.sum("_n").over(below), F.lit(0)), "_all": F.sum("_n").over(Window.partitionBy(*by))})
    pct = F.coalesce(s.ratio(F.col("_below"), F.col("_all") - 1), F.lit(0.0))
    ranks = ranks.select(*by, score, pct.alias("percentile"))
    joined = df.join(ranks, [*by, score], "left")
    cuts = [(limit, str(stars)) for stars, limit in ref.STAR_CUTS]
    return joined.withColumn("stars", tier(F.col("percentile"), *cuts, otherwise="1").cast("int"))


def star_rollup(df: DataFrame, by: list[str], weight: str = "weight") -> DataFrame:
    """Stars weighted by measure, per domain and overall."""
    domain = df.groupBy(*by, "domain").agg(F.sum(F.col("stars") * F.col(weight)).alias("_s"), F.sum(weight).alias("_w"))
    per_domain = domain.select(*by, "domain", s.rounded(s.ratio(F.col("_s"), F.col("_w")), 6).alias("domain_stars"), "_s", "_w")
    overall = per_domain.groupBy(*by).agg(s.rounded(s.ratio(F.sum("_s"), F.sum("_w")), 6).alias("overall_stars"))
    return per_domain.drop("_s", "_w").join(overall, by)
