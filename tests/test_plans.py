"""What the plans of the registered queries must not contain."""

import os

import pytest

from workload.catalog import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = ("a1_score_and_roll_up", "a2_redelivered_once", "a8_post_share_per_company", "a10_sentiment_share",
         "f1_clean_document", "f5_sentiment_raw", "f5_sentiment_lexicon_table", "j1_last_ticker_of_post",
         "j3_prices_with_polarity", "j6_unmatched_days", "m1_functions_by_name", "p15_positional_sample",
         "t2_worst_writers", "t4_companies_trolled", "w1_sma", "w3_macd", "w4_rsi", "w7_chronological_split")


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")
@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("NestedLoop", "Cartesian", "EvalPython", "InPandas", "MapPartitions"):
        assert word not in plan


@pytest.mark.parametrize("name", ["w1_sma", "w3_macd", "w4_rsi"])
def test_windows_run_per_chunk(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # the only windows over a whole series are the running totals of the monthly counts
    whole = [line for line in windows if "_chunk#" not in line and "_bucket#" not in line]
    assert windows and all("sum(_n#" in line for line in whole)
    assert plan.count("REPARTITION_BY_COL") == 1


def test_text_is_not_shuffled_by_reports(spark):
    plan = QUERIES["t4_companies_trolled"](spark, SF)._jdf.queryExecution().executedPlan()
    shuffles = [line for line in plan.toString().splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles and not any("text#" in line for line in shuffles)
