"""Plan-shape tests: the properties that matter at scale."""

import re
import tempfile

import pytest

from conftest import SF_SMALL
from flightmart.plans import (
    clean_airports,
    clean_flights,
    count_exchanges,
    jobs,
    physical_plan,
    plan_text,
    read_schemas,
)
from flightmart.sinks import stage_and_verify
from flightmart.sources import raw_airports, raw_flights


@pytest.fixture(scope="module")
def staged(spark):
    path = tempfile.mkdtemp(prefix="flightmart-plan-") + "/stage"
    df, _ = stage_and_verify(drop_cols(raw_flights(spark, SF_SMALL)), path)
    return df


def drop_cols(df):
    return df.drop(*jobs.DROPPED_COLUMNS)


def test_cleaning_is_one_narrow_stage(staged):
    c = clean_flights(staged)
    assert count_exchanges(c) == 0
    text = plan_text(c)
    assert "PythonUDF" not in text and "BatchEvalPython" not in text and "ArrowEval" not in text


def test_required_column_filters_reach_the_scan(staged):
    text = plan_text(clean_flights(staged))
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    for c in ("TaxiIn", "TaxiOut", "CRSElapsedTime"):
        assert f"IsNotNull({c})" in pushed
        assert f"Not(In({c}," in pushed


def test_unused_columns_are_pruned(staged):
    narrow = clean_flights(staged).select("FlightDate", "Origin")
    schema = read_schemas(narrow)[0]
    assert "TailNum" not in schema and "AirTime" not in schema and "Distance" not in schema


def test_audit_is_single_pass(staged):
    from flightmart.operators import missing_audit

    text = physical_plan(missing_audit(staged))
    assert text.count("FileScan parquet") == 1
    assert "Exchange SinglePartition" in text  # one partial row per task, merged once


def test_publish_plan_is_one_rebalance_and_one_sort(staged):
    out = (
        clean_flights(staged)
        .hint("rebalance", *jobs.PARTITION_COLUMNS)
        .sortWithinPartitions(*jobs.PARTITION_COLUMNS, *jobs.CLUSTER_COLUMNS)
    )
    text = plan_text(out, "extended")
    assert count_exchanges(out) == 1
    assert "REBALANCE_PARTITIONS_BY_COL" in text


def test_airport_override_has_no_join_or_shuffle(spark):
    out = clean_airports(raw_airports(spark, SF_SMALL))
    assert count_exchanges(out) == 0
    assert "Join" not in plan_text(out)


def test_flag_counts_uses_partial_aggregation(staged):
    from flightmart.operators import flag_counts, flag_missing

    out = flag_counts(flag_missing(staged, "MissingData", jobs.FLAG_COLUMNS), "MissingData")
    text = plan_text(out, "extended")
    assert text.count("HashAggregate") >= 2  # partial (map side) + final


def test_pushed_filters_helper_keeps_nested_lists(staged):
    from flightmart.plans import pushed_filters

    pushed = pushed_filters(clean_flights(staged))
    assert len(pushed) == 1
    assert "Not(In(TaxiIn, [NA,NULL,NaN,null]))" in pushed[0]
    assert "IsNotNull(CRSElapsedTime)" in pushed[0]


def test_audit_trail_is_one_scan(staged):
    out = jobs.flights_audit_trail(staged)
    plan = physical_plan(out)
    assert plan.count("FileScan parquet") == 1
    # partial counts per keep-group (a few rows per task), then one tiny final sum
    assert count_exchanges(out) == 2
