"""Plan shape guards: column pruning reaches the scans, rollups aggregate
partially before the shuffle, and the monthly history is aggregated before
it meets the credit table."""
from conftest import SF001


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bureau_rollup_plan(spark):
    import __spark_entry__ as E

    df = E.queries()["bureau_rollup"](spark, SF001)
    df.collect()
    text = df._jdf.queryExecution().toString()
    # lineitem is read with only the four columns the view needs
    assert "struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string,l_linestatus:string>" in text
    # partial + final aggregation (map-side combine) for both rollup levels
    assert text.count("partial_count") >= 2


def test_ranking_plan_has_no_single_partition_on_rows(spark):
    import __spark_entry__ as E

    df = E.queries()["ranking_metrics"](spark, SF001)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line]
    # the window over histogram rows is partitioned by (model, range bucket);
    # the model-only windows run over the bounded per-bucket table (_bk_*)
    row_level = [w for w in windows if "sum(pos#" in w]
    assert row_level and all("windowspecdefinition(model#" in w and "_range_bucket#" in w.split("AS _we0")[0]
                             for w in row_level)
    assert all("_bk_" in w for w in windows if w not in row_level)


def test_stored_model_input_moves_no_row(spark):
    from lendspark.plans.q_features import stored_model_input

    text = plan_text(stored_model_input(spark, SF001, 3))
    assert "Exchange" not in text and text.count("SortMergeJoin") == 5
