"""Scalar cleaning and calendar expressions. All take and give columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(col: ColumnLike) -> Column:
    return F.col(col) if isinstance(col, str) else col


def proper(col: ColumnLike) -> Column:
    """Trimmed, each word capitalised."""
    return F.initcap(F.trim(_c(col)))


def norm_gender(col: ColumnLike) -> Column:
    """Male, Female or Unknown."""
    value = F.upper(_c(col))
    return F.when(value.isin("M", "MALE"), "Male").when(value.isin("F", "FEMALE"), "Female").otherwise("Unknown")


def code(col: ColumnLike) -> Column:
    """Trimmed upper-case code."""
    return F.upper(F.trim(_c(col)))


def digits(col: ColumnLike) -> Column:
    """Only the digits; leading zeros stay because the column is text."""
    return F.regexp_replace(_c(col).cast("string"), "[^0-9]", "")


def email(col: ColumnLike) -> Column:
    return F.lower(F.trim(_c(col)))


def to_d(col: ColumnLike) -> Column:
    """Date, NULL where the text is no date."""
    return F.try_to_date(_c(col))


def money(col: ColumnLike) -> Column:
    return _c(col).try_cast("decimal(18,2)")


def number(col: ColumnLike) -> Column:
    return _c(col).try_cast("double")


def whole(col: ColumnLike) -> Column:
    return _c(col).try_cast("int")


def flag(col: ColumnLike) -> Column:
    return _c(col).try_cast("boolean")


def flag0(col: ColumnLike) -> Column:
    """Integer flag, 0 when missing."""
    return F.coalesce(whole(col), F.lit(0))


def trimmed(col: ColumnLike) -> Column:
    return F.trim(_c(col))


def is_active(col: ColumnLike) -> Column:
    return F.when(_c(col) == "Active", True).otherwise(False)


def cast_spec(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Cast the named columns, NULL where a value does not fit the type."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in spec.items()})


def length_of_stay(admit: ColumnLike = "encounter_date", discharge: ColumnLike = "discharge_date",
                   given: ColumnLike = "length_of_stay") -> Column:
    """Days between the dates, else the given value."""
    both = _c(admit).isNotNull() & _c(discharge).isNotNull()
    return F.when(both, F.datediff(_c(discharge), _c(admit))).otherwise(whole(given))


def years_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Completed years, a year being 365.25 days."""
    return F.floor(F.datediff(_c(later), _c(earlier)) / F.lit(365.25)).cast("int")


def date_key(col: ColumnLike) -> Column:
    """yyyymmdd as an integer."""
    d = _c(col)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_key(col: ColumnLike) -> Column:
    """First day of a yyyy-MM month as yyyymmdd."""
    return F.regexp_replace(_c(col), "-", "").try_cast("int") * 100 + 1


def ym_label(col: ColumnLike) -> Column:
    """yyyy-MM of a yyyymmdd key."""
    text = _c(col).cast("string")
    return F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2))


def date_of_key(col: ColumnLike) -> Column:
    """Date of a yyyymmdd key."""
    key = _c(col)
    return F.make_date(F.floor(key / 10000).cast("int"), (F.floor(key / 100) % 100).cast("int"), (key % 100).cast("int"))


def text_of(*parts: Column | str) -> Column:
    """Concatenation in which a NULL part counts as empty. Plain strings are literal text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def ratio(numerator: Column, denominator: Column) -> Column:
    """Safe division of two aggregates or columns: NULL when the divisor is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rounded(col: ColumnLike, places: int) -> Column:
    """Half-up rounding of the decimal value a double stands for.

    Twelve decimals are kept first, which takes off the noise of binary sums: figures do
    not depend on the order in which rows were added.
    """
    return F.round(_c(col).cast("decimal(38,12)"), places).cast("double")


def mean_money(col: ColumnLike) -> Column:
    """Mean of a money column through its exact sum."""
    return ratio(F.sum(_c(col)), F.count(_c(col)))


def total(col: ColumnLike) -> Column:
    """Exact sum of a money column, given as a double."""
    return F.sum(_c(col)).cast("double")


def content_id(kind: str | Column, *parts: Column) -> Column:
    """Id that is the same whenever the same thing is described."""
    first = F.lit(kind) if isinstance(kind, str) else kind
    return F.md5(F.concat_ws("|", first, *parts))


def minutes_between(later: Column, earlier: Column) -> Column:
    """Minute boundaries crossed from earlier to later."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", earlier), F.date_trunc("minute", later))


def spark_interval(text: str) -> Column:
    """Interval literal such as '7 days'."""
    return F.expr(f"INTERVAL {text}")
