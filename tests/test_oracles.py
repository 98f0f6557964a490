"""A cross-section of the registered queries against DuckDB; verify.py runs them all."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from verify import check, oracle

SF = "/root/testdata/sf0.001"
NAMES = [
    "monitoring_by_batch", "drift_metrics", "overall_severity", "top_drift_features", "reference_profile",
    "feature_quantiles", "outlier_univariate", "corr_to_target", "mutual_info_binned", "fe_full",
    "compare_arms", "paired_tests", "canary_stages", "promotion_gate", "durbin_watson", "batch_inference",
    "run_metrics_pivot", "registry_current_alias", "stream_event_drift", "late_label_performance",
]


@pytest.fixture(scope="module")
def duck():
    return oracle(SF)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    assert check(spark, duck, name, SF)[0] == "ok"


def test_contract(spark):
    assert set(oracle_sql()) <= set(queries())
    assert entry(spark).count() > 0
