"""Distinct counts out of daily sketches: exact while they fit, within the bound beyond."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from wardlight.operators import sketches

DAY_0 = datetime.datetime(2024, 3, 1)
LG = 9  # 512 values, so that small sets overflow


def _rows(n, people, seed):
    rng = random.Random(seed)
    hot = [(DAY_0 + datetime.timedelta(days=rng.random() * 10), f"p{rng.randrange(people)}" if i % 3 else "p0", rng.choice("ab")) for i in range(n)]
    return [*hot, (None, "p-untimed", "a"), (DAY_0, None, "b")]


def _count(rows, kinds, first, last):
    days = {k: {p for t, p, kind in rows if t and p and kind == k and first <= (t - DAY_0).days <= last} for k in kinds}
    return {k: len(v) for k, v in days.items()}, len(set.intersection(*days.values())), len(set.union(*days.values()))


@pytest.mark.parametrize("people", [300, 20_000])
@pytest.mark.parametrize("first, last", [(0, 9), (2, 5), (7, 7)])
def test_counts_over_spans_and_shared_values(spark, people, first, last):
    rows = _rows(12_000, people, people)
    stored = sketches.by_day(spark.createDataFrame(rows, "ts timestamp, p string, kind string"), "ts", "p", ["kind"], LG)
    span = stored.filter(F.col("_day").between(F.lit((DAY_0 + datetime.timedelta(days=first)).date()), F.lit((DAY_0 + datetime.timedelta(days=last)).date())))
    each, common, everything = _count(rows, "ab", first, last)

    def off(count, of=None):
        return spark.range(1).select(sketches.allowed(F.lit(count), F.lit(of) if of else None, LG)).first()[0]

    for r in sketches.distinct(span, ["kind"], LG).collect():
        assert abs(r.distinct_count - each[r.kind]) <= off(each[r.kind])
    r = sketches.shared(span, "kind", ["a", "b"], lg=LG).first()
    assert abs(r.shared_count - common) <= off(common, everything) and abs(r.all_count - everything) <= off(everything)
    if people == 300:
        assert (r.shared_count, r.all_count) == (common, everything)


def test_members_that_are_missing_share_nothing(spark):
    stored = sketches.by_day(spark.createDataFrame(_rows(50, 9, 1), "ts timestamp, p string, kind string"), "ts", "p", ["kind"])
    assert sketches.shared(stored, "kind", ["a", "none"]).first().shared_count == 0
    assert sketches.distinct(stored.filter("false"), ["kind"]).collect() == []
