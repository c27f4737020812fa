"""One or two queries of every family against their expected SQL, on the smallest tables.

``python -m tests.check SF_DIR`` compares all of them.
"""

import os

import pytest

import __spark_entry__ as entry
from tests import compare
from wardlight.plans import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = ["a01_load_full", "a12_dead_letters", "b12_dedup_latest", "b13_clean_patients", "c01_assign_keys", "c03_scd2_merge", "c05_upsert_claims", "d05_claims", "e11_raf_score", "e21_ks",
         "f07_mlr_by_payer_month", "f12_adherence_exact", "h06_backfill", "h13_window_stream", "j06_fraud_scores", "j15_highcost_alerts", "j29_payer_alerts", "k08_fraud_by_flag",
         "l01_measures_by_columns", "m057_quality_score", "n11_provider_profile", "q021_top_denying_payers", "q110_top_priorities", "r05_key_coverage"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no source tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_gives_the_expected_rows(spark, con, name):
    assert compare.difference(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None


def test_every_query_of_the_catalogue_has_expected_sql():
    assert set(catalog.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
