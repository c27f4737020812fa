"""Date filters skip the files of other months and days."""

import os

import pytest

from wardlight.operators import events
from wardlight.plans import questions
from wardlight.plans.warehouse import open_warehouse

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no source tables")


def _partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("PartitionFilters: ")[1].split("], ")[0]


def test_a_quarter_reads_three_months(spark):
    claims = open_warehouse(spark, SF_DIR)["fact_claim"]
    assert ">= 200107" in _partition_filters(claims.filter(questions._in("claim_date_key", questions.THIS_QUARTER)))


def test_a_look_back_reads_its_days(spark):
    w = open_warehouse(spark, SF_DIR)
    assert "_day" in _partition_filters(events.lookback(w["claims_events"], events.TS, w.now, "1 hour"))
