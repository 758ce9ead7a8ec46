"""Plan checks: pushdown and pruning reach the scan, expression-only operators
stay in the JVM, no global single-partition window in data-sized operators."""

import __spark_entry__ as E
from conftest import SF_SMALL

Q = E.queries()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_pushed_and_columns_pruned(spark):
    p = _plan(Q["filter_compare"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_quantity)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_discount:double," in p


def test_expression_operators_have_no_python_worker(spark):
    for k in ("date_extract_cascade", "ts_day_bucket", "str_regex_count", "text_tokens", "proj_recode"):
        p = _plan(Q[k](spark, SF_SMALL))
        assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p, k


def test_numbering_has_no_single_partition_window(spark):
    for k in ("win_row_index", "sort_multi", "date_chrono_order"):
        p = _plan(Q[k](spark, SF_SMALL))
        # numbered while the ranges are written: no window, no task that sees all rows
        assert "Window" not in p and "SinglePartition" not in p and "TakeOrdered" not in p, k


def test_no_cross_product_in_library_plans(spark):
    for k in ("clean_impute_mean", "outlier_cap_iqr", "scale_standard", "win_zscore", "join_cross_best"):
        p = _plan(Q[k](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, k
