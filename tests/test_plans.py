"""Plan-shape checks: pushdown, pruning, no cartesian products, partial aggregation."""
import pytest

import __spark_entry__ as E
from feedrank.plans.catalog import all_queries
from conftest import SF001

ONE_ROW_CROSS = {"dashboard_bars", "score_latest_config"}   # broadcast of a one-row aggregate


def plan(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


BATCH = sorted(k for k in all_queries() if not k.startswith(("stream_", "config_running")))


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian(spark, name):
    p = plan(E.queries()[name](spark, SF001))
    assert "CartesianProduct" not in p
    if name not in ONE_ROW_CROSS:
        assert "BroadcastNestedLoopJoin" not in p
    # one Arrow pass flattens documents of unknown depth; nothing else leaves the JVM
    assert "BatchEvalPython" not in p
    assert p.count("ArrowEvalPython (") <= (2 if name.startswith("ingest_") else 0)


@pytest.mark.parametrize("name", ["ingest_raw", "ingest_topic", "ingest_key", "ingest_epoch_millis",
                                  "ingest_route_counts", "ingest_dead_letter", "ingest_click_stream",
                                  "ingest_create_post_stream"])
def test_routed_fields_stay_in_the_jvm(spark, name):
    p = plan(E.queries()[name](spark, SF001))
    assert "Python" not in p and "Pandas" not in p


def test_fixture_scan_is_pruned_and_pushed(spark):
    p = plan(E.queries()["click_counts"](spark, SF001))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,signup)" in p
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in p
    assert "value" not in p.split("ReadSchema")[1].split("\n")[0]


def test_counts_aggregate_is_partial_before_shuffle(spark):
    p = plan(E.queries()["click_counts"](spark, SF001))
    assert "partial_count" in p and "partial_max" in p
    assert "hashpartitioning(properties_shoppable_post_id" in p


def test_bucketed_join_keys_include_bucket(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(E.queries()["click_counts"](spark, SF001))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p or "ShuffledHashJoin" in p
    assert "hashpartitioning(_pid" in p and "_b" in p.split("hashpartitioning(_pid")[1].split(")")[0]


def test_rank_topk_is_take_ordered(spark):
    p = plan(E.queries()["rank_topk"](spark, SF001))
    assert "TakeOrderedAndProject" in p


def test_rtscore_sql_function_is_inlined(spark):
    from feedrank.functions.scoring import register_sql_functions
    register_sql_functions(spark)
    df = spark.sql("SELECT rtscore(id, id) AS r FROM range(10)")
    p = plan(df)
    assert "codegen id" in p and "Python" not in p and "16.666666666666668" in p


@pytest.mark.parametrize("name", ["live_table_as_of", "live_table_window", "rank_topk", "changelog_since"])
def test_time_bounds_reach_every_scan(spark, name):
    scans = [line for line in plan(E.queries()[name](spark, SF001)).split("\n") if "PushedFilters" in line]
    assert scans and all("GreaterThanOrEqual(ts" in line for line in scans)


def test_one_pipeline_behind_dashboard_and_asof(spark):
    for name in ("dashboard_bars", "score_config_asof"):
        p = plan(E.queries()[name](spark, SF001))
        assert p.count("ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>") == 1


@pytest.mark.parametrize("name", ["click_recent", "click_recent_auto_salt", "click_counts_from_left_join"])
def test_one_interval_join_behind_the_left_join(spark, name):
    p = plan(E.queries()[name](spark, SF001))
    joins = [line for line in p.split("\n") if "Join condition" in line and "click_timestamp" in line]
    assert len(joins) == 1
    assert "partial_min(click_timestamp" in p and "LeftAnti" in p
