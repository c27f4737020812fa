"""Queries for the incremental load: a first load of every fact, then a drop with new and corrected rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlight.functions import scalars as s
from wardlight.operators import aggregates, facts, increment, keys, ods, silver
from wardlight.operators.increment import SignedSums, month_of_date, month_of_key
from wardlight.plans.registry import plain, query
from wardlight.plans.warehouse import Warehouse
from wardlight.session import cut_lineage

FIRST_OF_DROP, CORRECTED_FROM, DROP = "1998-01-01", "1997-07-01", "1998"


@dataclass(frozen=True)
class Load:
    """One table of the load: where its rows are split, which rows of half a year come twice, and
    what the first version of those has instead. ``parents`` are tables whose changed rows have
    the rows under their key derived again."""

    raw: str
    day: str
    corrected: Column
    first_version: dict[str, Column]
    month: Column
    fact: Callable[[Warehouse, DataFrame], DataFrame]
    fact_month: Column
    sk: str
    parents: dict[str, str]

    @property
    def bk(self) -> str:
        return silver.KEYS[self.raw]


def _day(col: str) -> Column:
    text = F.trim(F.col(col))
    return F.coalesce(F.try_to_date(F.when(F.length(text) == 7, F.concat(text, F.lit("-01"))).otherwise(text)), F.lit("1990-01-01").cast("date"))


def _earlier(col: str) -> Column:
    return F.date_format(F.date_sub(_day(col), 40), "yyyy-MM-dd")


def _month_of_label(col: str) -> Column:
    return F.coalesce(F.try_to_number(F.regexp_replace(col, "-", ""), F.lit("999999")).cast("int"), F.lit(0))


def _enc(w: Warehouse) -> DataFrame:
    return stored(w, "encounters")


def loads() -> dict[str, Load]:
    """Columns exist in a session only, so the table is made when it is used."""
    none = F.lit(None).cast("string")
    return {
        "encounters": Load("encounters", "admit_date", s.proper("encounter_type") == "Observation", {"admit_date": _earlier("admit_date"), "discharge_disposition": none},
                           month_of_date("encounter_date"),
                           lambda w, rows: facts.fact_encounter(ods.enrich_encounters(rows, w["patients_clean"], w["providers_clean"], w["ref_facilities"]), w.dims),
                           month_of_key("encounter_date_key"), "encounter_key", {}),
        "claims": Load("claims", "submit_date", s.proper("claim_type") == "Pharmacy", {"submit_date": _earlier("submit_date"), "paid_amount": none}, month_of_date("claim_date"),
                       lambda w, rows: facts.fact_claim(ods.enrich_claims(rows, w["ref_payers"], w.as_of), w.dims, _enc(w)),
                       month_of_key("claim_date_key"), "claim_key", {"encounters": "encounter_id"}),
        "diagnoses": Load("diagnoses", "diagnosis_date", s.proper("diagnosis_type") == "Principal", {"present_on_admission": none}, month_of_date("diagnosis_date"),
                          lambda w, rows: facts.fact_diagnosis(ods.enrich_diagnoses(rows, w["ref_icd_codes"], silver_rows(w, "encounters")), w.dims, _enc(w)),
                          month_of_key("diagnosis_date_key"), "fact_diagnosis_key", {"encounters": "encounter_id"}),
        "premiums": Load("premiums", "year_month", F.col("subsidy_amount") == "75.50", {"premium_amount": F.lit("1")}, _month_of_label("year_month"),
                         lambda w, rows: facts.fact_premium(ods.stamp_ods(rows), w.dims), _month_of_label("year_month"), "premium_key", {}),
        "authorizations": Load("authorizations", "submit_date", s.proper("auth_outcome") == "Denied", {"submit_date": _earlier("submit_date"), "auth_outcome": none}, month_of_date("submit_date"),
                               lambda w, rows: facts.fact_authorization(ods.stamp_ods(rows), w.dims), month_of_key("submit_date_key"), "auth_key", {}),
        "capitation": Load("capitation", "year_month", F.col("bonus_eligible") == "true", {"capitation_pmpm": F.lit("2")}, _month_of_label("year_month"),
                           lambda w, rows: facts.fact_capitation(ods.stamp_ods(rows), w.dims), _month_of_label("year_month"), "capitation_key", {}),
        "claim_appeals": Load("claim_appeals", "submit_date", F.trim("appeal_level") == "First", {"submit_date": _earlier("submit_date"), "appeal_outcome": none}, month_of_date("submit_date"),
                              lambda w, rows: facts.fact_appeal(ods.stamp_ods(rows), w.dims, stored(w, "claims")), month_of_key("submit_date_key"), "appeal_key", {"claims": "claim_id"}),
    }


def _at(w: Warehouse, name: str) -> str:
    return f"{w.folder}/increment/{name}"


FIRST = "first"


def stored(w: Warehouse, name: str, after: str | None = None) -> DataFrame:
    """A fact as it stands, or as it was after the first load."""
    return increment.read_months(w.spark, _at(w, f"{name}/fact"), after=after).drop(increment.MONTH)


def silver_rows(w: Warehouse, name: str) -> DataFrame:
    return increment.read_months(w.spark, _at(w, f"{name}/silver")).drop(increment.MONTH)


def _corrected(load: Load) -> Column:
    return load.corrected & (_day(load.day) >= CORRECTED_FROM) & (_day(load.day) < FIRST_OF_DROP)


def first_files(raw: DataFrame, load: Load) -> DataFrame:
    """What was there before the drop, with the first version of rows that are corrected later."""
    twice = F.coalesce(_corrected(load), F.lit(False))
    known = raw.filter(_day(load.day) < FIRST_OF_DROP)
    return known.select(*[F.when(twice, load.first_version[c]).otherwise(F.col(c)).alias(c) if c in load.first_version else F.col(c) for c in raw.columns])


def second_files(raw: DataFrame, load: Load) -> DataFrame:
    return raw.filter((_day(load.day) >= FIRST_OF_DROP) | F.coalesce(_corrected(load), F.lit(False)))


# --- the two loads --------------------------------------------------------------------------------

_FIRST: set[str] = set()
_SECOND: dict[str, list[int]] = {}


def first_load(w: Warehouse, name: str) -> None:
    load, at = loads()[name], _at(w, name)
    if at in _FIRST:
        return
    for parent in load.parents:
        first_load(w, parent)
    increment.save_by_month(silver.clean(first_files(w[f"{name}_raw"], load), name), f"{at}/silver", load.month)
    rows = silver_rows(w, name)
    increment.save_by_month(keys.full_keys(load.fact(w, rows), load.sk, load.bk, ids=rows), f"{at}/fact", load.fact_month)
    _FIRST.add(at)


def _derived(w: Warehouse, name: str) -> DataFrame:
    """Keys and months of silver rows whose fact rows are to be made: those of the drop, and those that hang on changed rows."""
    load, at = loads()[name], _at(w, name)
    ids = increment.changes_of(w.spark, f"{at}/silver", DROP).filter(F.col(increment.SIGN) > 0).select(load.bk, increment.MONTH)
    for parent, key in load.parents.items():
        changed = increment.changes_of(w.spark, f"{_at(w, parent)}/silver", DROP).select(F.col(key).alias("_id"))
        stored = increment.read_months(w.spark, f"{at}/silver").select(load.bk, key, increment.MONTH)
        ids = ids.unionByName(stored.join(changed, F.col(key).eqNullSafe(F.col("_id")), "left_semi").drop(*{key} - {load.bk}))
    return cut_lineage(ids.distinct())


def second_load(w: Warehouse, name: str) -> list[int]:
    """Take the drop into a table and all that it hangs on; gives the months of its fact."""
    load, at = loads()[name], _at(w, name)
    if at in _SECOND:
        return _SECOND[at]
    first_load(w, name)
    for parent in load.parents:
        second_load(w, parent)
    increment.merge_months(w.spark, f"{at}/silver", silver.clean(second_files(w[f"{name}_raw"], load), name), load.bk, load.month, drop_id=DROP)
    ids = _derived(w, name)
    rows = load.fact(w, increment.rows_at(w.spark, f"{at}/silver", ids, load.bk))
    _SECOND[at] = increment.merge_months(w.spark, f"{at}/fact", rows, load.bk, load.fact_month, load.sk, DROP, ids)
    return _SECOND[at]


# --- aggregates -------------------------------------------------------------------------------------

class ByMonth:
    """An aggregate whose groups lie in months of its facts."""

    def __init__(self, name: str, build: Callable[..., DataFrame], month: Callable[[], Column], *facts_of: str):
        self.name, self.build, self.month, self.facts = name, build, month, facts_of

    def _first(self, w: Warehouse, path: str, rows: list[DataFrame]) -> None:
        increment.save_by_month(self.build(w, *rows), path, self.month())

    def _drop(self, w: Warehouse, path: str, months: list[int]) -> None:
        if not increment.applied(w.spark, path, DROP):
            rows = [increment.read_months(w.spark, _at(w, f"{f}/fact"), months).drop(increment.MONTH) for f in self.facts]
            increment.replace_months(self.build(w, *rows).withColumn(increment.MONTH, self.month()), path, months, DROP)

    def _read(self, w: Warehouse, path: str) -> DataFrame:
        return increment.read_months(w.spark, path)

    def read(self, w: Warehouse) -> DataFrame:
        """Built over the first load, then led on by the drop."""
        path = _at(w, f"agg/{self.name}")
        months = sorted({m for f in self.facts for m in second_load(w, f)})
        if path not in _FIRST:
            self._first(w, path, [stored(w, f, FIRST) for f in self.facts])
            _FIRST.add(path)
        self._drop(w, path, months)
        return self._read(w, path)


class BySums(ByMonth):
    """An aggregate of rows of all months, kept as sums."""

    def __init__(self, name: str, sums: Callable[[Warehouse], SignedSums], fact: str):
        self.name, self.sums, self.facts = name, sums, (fact,)

    def _first(self, w: Warehouse, path: str, rows: list[DataFrame]) -> None:
        self.sums(w).start(rows[0], path)

    def _drop(self, w: Warehouse, path: str, months: list[int]) -> None:
        self.sums(w).take(w.spark, path, increment.changes_of(w.spark, _at(w, f"{self.facts[0]}/fact"), DROP), DROP)

    def _read(self, w: Warehouse, path: str) -> DataFrame:
        return self.sums(w).read(w.spark, path)


def _money(df: DataFrame, names: dict[str, str]) -> dict[str, Column]:
    return {f"avg_{n}": s.ratio(F.col(f"sum_{c}"), F.col(f"n_{c}")) for c, n in names.items()}


_DRG_MONEY = {"total_charges": "charges", "total_cost": "cost_to_deliver", "expected_reimbursement": "expected_reimbursement"}


def _drg_figures(df: DataFrame) -> DataFrame:
    means = _money(df, _DRG_MONEY) | {f"avg_{n}": s.rounded(s.ratio(F.col(f"sum_{c}"), F.col(f"n_{c}")), 6) for c, n in {"drg_weight": "drg_weight", "length_of_stay": "los"}.items()}
    df = df.withColumns(means | {f"total_{n}": F.when(F.col(f"n_{c}") > 0, F.col(f"sum_{c}")).cast("double") for c, n in _DRG_MONEY.items()})
    margin, cost = F.col("avg_expected_reimbursement") - F.col("avg_cost_to_deliver"), F.col("avg_cost_to_deliver")
    df = df.withColumns({"margin_per_case": s.rounded(margin, 4), "margin_pct": s.rounded(F.when(cost > 0, margin / cost * 100).otherwise(F.lit(0.0)), 6), "encounter_count": F.col("n")})
    return df.select("drg_code", "drg_description", "encounter_count", *means, *[f"total_{n}" for n in _DRG_MONEY.values()], "margin_per_case", "margin_pct")


def drg_sums(w: Warehouse) -> SignedSums:
    return SignedSums(lambda rows: rows.filter(F.col("drg_code").isNotNull()), ("drg_code", "drg_description"),
                      {c: "decimal(28,2)" for c in _DRG_MONEY} | {"drg_weight": "decimal(28,6)", "length_of_stay": "decimal(28,0)"}, _drg_figures)


def appeal_sums(w: Warehouse) -> SignedSums:
    def rows(claims: DataFrame) -> DataFrame:
        return claims.filter(F.col("appeal_outcome").isNotNull()).join(w["dim_payer"].select("payer_key", "payer_name"), "payer_key", "left").withColumnRenamed("primary_denial_reason", "denial_reason")

    def figures(df: DataFrame) -> DataFrame:
        won = F.when(F.col("n_appeal_amount_recovered") > 0, F.col("sum_appeal_amount_recovered"))
        return df.select("payer_name", "denial_reason", "appeal_outcome", F.col("n").alias("appeal_count"), F.when(F.col("n_billed_amount") > 0, F.col("sum_billed_amount")).cast("double").alias("total_billed"),
                         won.cast("double").alias("total_amount_recovered"), s.ratio(won, F.col("n_appeal_amount_recovered")).alias("avg_amount_recovered"))

    return SignedSums(rows, ("payer_name", "denial_reason", "appeal_outcome"), {"billed_amount": "decimal(28,2)", "appeal_amount_recovered": "decimal(28,2)"}, figures)


def _claim_month() -> Column:
    return month_of_key("claim_date_key")


AGGREGATES: dict[str, ByMonth] = {a.name: a for a in (
    ByMonth("readmission_by_date", lambda w, enc: aggregates.agg_readmission(enc), lambda: month_of_key("encounter_date_key"), "encounters"),
    ByMonth("denial_by_date", lambda w, claims: aggregates.agg_denial_date(claims), _claim_month, "claims"),
    ByMonth("denial_by_payer", lambda w, claims: aggregates.agg_denial_payer(claims, w["dim_payer"]), _claim_month, "claims"),
    ByMonth("days_in_ar", lambda w, claims: aggregates.agg_ar(claims, w["dim_payer"]), _claim_month, "claims"),
    ByMonth("mlr_by_payer_month", lambda w, premium, claims: aggregates.agg_mlr(premium, claims, w["dim_payer"]), lambda: _month_of_label("year_month"), "premiums", "claims"),
    BySums("revenue_by_drg", drg_sums, "encounters"),
    BySums("appeal_outcomes", appeal_sums, "claims"),
)}


# --- queries -------------------------------------------------------------------------------------------

def _fact_after_both(w: Warehouse, name: str, without: list[str]) -> DataFrame:
    second_load(w, name)
    return stored(w, name).drop(*without)


@query("c23_increment_silver")
def _(w):
    second_load(w, "claims")
    return plain(silver_rows(w, "claims"))


# Keys of this table and of those it refers to depend on the order of loads; business ids tell the rows apart.
WITHOUT = {"encounters": ["encounter_key"], "claims": [], "diagnoses": ["fact_diagnosis_key", "encounter_key"],
           "premiums": ["premium_key"], "authorizations": ["auth_key"], "capitation": ["capitation_key"], "claim_appeals": ["appeal_key", "claim_key"]}
for _name, _without in WITHOUT.items():
    query(f"c23_increment_{_name}")(lambda w, name=_name, without=_without: _fact_after_both(w, name, without))
for _name in AGGREGATES:
    query(f"c23_increment_{_name}")(lambda w, name=_name: plain(AGGREGATES[name].read(w)))
