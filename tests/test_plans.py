"""Plans of the queries that only read: joins are equi-joins, scans read only needed columns."""

import pytest

from tidecart.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
READ_ONLY = [
    "global_kpis", "revenue_by_category", "top5_items", "conversion_rate", "revenue_growth_lag",
    "revenue_growth_calendar", "daily_metrics_last_30_days", "units_by_quarter", "top10_last_4_quarters",
    "top10_named", "top10_slice_latest", "abandoned_carts", "abandoned_cart_rate", "parse_json_events",
    "units_of_touched_quarters", "previous_day_rows_for_batch", "batch_growth_against_history",
    "replace_quarter_frames", "snapshot_retention", "avg_ticket_variation", "revenue_per_user_by_segment",
    "orders_per_customer",
]

# What these broadcast has a fixed bound: k ranked ids for each quarter.
BOUNDED = {"top10_named", "top10_slice_latest"}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_no_pairwise_joins(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for name in READ_ONLY:
            text = plan(QUERIES[name](spark, FOLDER))
            assert "CartesianProduct" not in text and "NestedLoop" not in text, name
            assert "Python" not in text, name
            if threshold == "-1" and name not in BOUNDED:
                assert "BroadcastHashJoin" not in text, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_scans_are_pruned(spark):
    text = plan(QUERIES["revenue_by_category"](spark, FOLDER))
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in text


def test_sketches_stay_close_to_the_exact_counts(spark):
    for name in ("global_kpis_approx", "carts_converted_approx"):
        assert QUERIES[name](spark, FOLDER).first().dentro_do_erro


@pytest.mark.parametrize("name", ["units_of_touched_quarters", "daily_metrics_last_30_days", "top10_last_4_quarters"])
def test_months_are_cut_at_the_scan(spark, name):
    text = plan(QUERIES[name](spark, FOLDER)).split("Initial Plan")[0]
    scans = [part for part in text.split("FileScan")[1:] if "mes#" in part.split("ReadSchema")[0]]
    assert scans and all("mes#" in part.split("PartitionFilters: [")[1].split("]")[0] for part in scans)
    assert "l_orderkey" not in text and "o_orderdate" not in text


@pytest.mark.parametrize("name", ["available_years", "available_quarters", "top10_slice_latest"])
def test_readers_are_served_without_sales(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    assert all("ranking" in file for file in frame.inputFiles())
