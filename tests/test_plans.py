"""Plan shape: the physical strategies the design relies on."""

import pytest

from labelfold.plans.catalog import QUERIES
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes_columns(spark):
    p = plan(QUERIES["per_label_metrics"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int" in p
    assert "l_tax" not in p and "l_shipdate" not in p


@pytest.mark.parametrize("name", ["per_label_metrics", "overall_metrics", "threshold_sweep", "roc_auc",
                                  "score_histogram", "per_label_report", "top_label_combinations",
                                  "hard_examples", "evaluation_loss", "dataset_statistics"])
def test_no_cartesian(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_hard_examples_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["hard_examples"](spark, SF_SMALL))


def test_recent_history_partial_limit(spark):
    assert "WindowGroupLimit" in plan(QUERIES["recent_history"](spark, SF_SMALL))


def test_report_broadcasts_dictionary(spark):
    p = plan(QUERIES["per_label_report"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_auc_stays_in_the_jvm(spark):
    # scores meet per (label, bucket) of their written counts; no Python worker, no second read of the input
    p = plan(QUERIES["roc_auc"](spark, SF_SMALL))
    assert "FileScan parquet [label_idx" in p and "lineitem" not in p
    assert "Python" not in p and "Pandas" not in p and "Arrow" not in p


@pytest.mark.parametrize("name", ["best_metric", "best_checkpoint"])
def test_run_log_metric_filter_reaches_scan(spark, name):
    pushed = [ln for ln in plan(QUERIES[name](spark, SF_SMALL)).split("\n") if "PushedFilters" in ln]
    assert pushed and all("event_type" in ln.split("PushedFilters")[1].split("]")[0] for ln in pushed)


@pytest.mark.parametrize("name", ["overall_metrics", "per_label_report", "roc_auc", "roc_auc_continuous"])
def test_auc_reports_share_one_table_of_counts(spark, name):
    """Counts and AUC come from one written table of (label, score) counts, windowed once;
    what is exchanged after it is one row per bucket and label."""
    df = QUERIES[name](spark, SF_SMALL)
    df.collect()  # settle the adaptive plan
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "lineitem" not in final
    # the buckets, then their one-row sums: one exchange where a label is one bucket
    assert 1 <= final.count("Exchange hashpartitioning(label_idx#") <= 2
