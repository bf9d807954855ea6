import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry

# A cross-section; tests/oracle_check.py runs all of them.
NAMES = """J1_asof_join J1_asof_join_hot_keys J2_asof_tie_rule J6_lookup_features P1_features_online P2_features_offline P11_skew_report
A9_fit_feature_stats A11_exact_quantiles_disc S1_stratified_split S2_scenario_weights V10_evaluate V11_model_curves E6_convert_raw
N1_parse_feature_payload W5_usable_version F9_amount_bin F28_amount_vs_cust_mean""".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, sf_dir, con, name):
    assert compare(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) == ""


def test_entry_has_the_whole_contract(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 79 and df.count() == 202


def test_every_derived_feature_is_registered():
    keys = set(entry.queries())
    assert all(any(k.startswith(f"F{n}_") for k in keys) for n in range(1, 59))
    assert set(entry.oracle_sql()) <= keys
