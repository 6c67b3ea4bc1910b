"""What the plans must look like to hold at scale."""

import re

import pytest

from voltstream.queries import registered


@pytest.fixture(scope="module")
def plan(spark, tables):
    """The physical plan of a query, as for tables too big to broadcast."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"

    def explain(name):
        frame = registered()[name](spark, tables)
        return frame._jdf.queryExecution().executedPlan().toString()

    spark.conf.set(threshold, "-1")
    yield explain
    spark.conf.unset(threshold)


def count(operator, text):
    return len(re.findall(rf"\b{operator}\b", text))


BATCH = [
    "q01_select_where_string", "q03_distinct", "q04_topk_string", "q06_alert_rows",
    "q07_alert_json", "q08_raw_normalise", "q09_tumble60_keyed_avg",
    "q09_plant_json_means", "q10_tumble30_sum_sql", "q11_tumble30_sum_df",
    "q11_device_json_charge", "q12_window_join", "q12_window_join_one_scan",
    "q12_window_join_json_sql",
    "q13_row_function", "q13_row_function_batches", "q13_row_function_rows",
    "q14_tumble10_keyed_avg", "q20_kafka_record_roundtrip",
]
EXCHANGES = {
    "q03_distinct": 1,
    "q09_tumble60_keyed_avg": 1,
    "q09_plant_json_means": 1,
    "q10_tumble30_sum_sql": 1,
    "q11_tumble30_sum_df": 1,
    "q11_device_json_charge": 1,
    # One per side, each split by the window; the join itself adds none.
    "q12_window_join": 2,
    "q12_window_join_json_sql": 2,
    "q12_window_join_one_scan": 1,
    "q14_tumble10_keyed_avg": 1,
    "q20_kafka_record_roundtrip": 1,
}


@pytest.mark.parametrize("name", BATCH)
def test_shuffles(plan, name):
    text = plan(name)
    assert count("Exchange", text) == EXCHANGES.get(name, 0)
    assert "SinglePartition" not in text
    assert not re.search("BroadcastNestedLoop|Cartesian|BroadcastExchange", text)


@pytest.mark.parametrize("name", [n for n, k in EXCHANGES.items() if k])
def test_aggregates_combine_before_the_shuffle(plan, name):
    text = plan(name)
    exchanges = [m.start() for m in re.finditer(r"\bExchange\b", text)]
    for at in exchanges:
        assert re.match(r"[^\n]*\n[^\n]*HashAggregate", text[at:])


@pytest.mark.parametrize(
    "name, filters, columns",
    [
        (
            "q01_select_where_string",
            "GreaterThanOrEqual(o_orderpriority,2)",
            "o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string",
        ),
        (
            "q06_alert_rows",
            "GreaterThan(value,100.0)",
            "ts:timestamp,user_id:bigint,value:double,props:string",
        ),
        ("q03_distinct", None, "user_id:bigint"),
        ("q11_tumble30_sum_df", "IsNotNull(ts)", "ts:timestamp,user_id:bigint,value:double"),
        (
            "q12_window_join",
            "EqualTo(event_type,click)",
            "ts:timestamp,event_type:string,value:double",
        ),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, tables, plan, name, filters, columns):
    text = plan(name)
    if filters:
        assert filters in text
    assert f"ReadSchema: struct<{columns}>"[:100] in text


def test_json_is_parsed_once_for_all_conditions(plan):
    text = plan("q07_alert_json")
    generators = re.findall(r"Generate inline\(array\(from_json", text)
    # The messages, and the alerts read back.
    assert len(generators) == count("from_json", text) == 2


def test_topk_keeps_k_rows_per_task(plan):
    assert "TakeOrderedAndProject(limit=20" in plan("q04_topk_string")


def test_row_function_in_columns_is_generated_code(plan):
    text = plan("q13_row_function")
    assert "Python" not in text and re.search(r"\*\(1\) Project", text)
