"""Plan shapes that must hold at scale."""

import inspect
import re

import pytest
from helpers import readings

from fleetpulse.functions import schemas
from fleetpulse.operators import aggregates, parse, rules, serving
from fleetpulse.plans import dataset as data
from fleetpulse.plans.catalog import CATALOG

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_readings(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("readings") / "r")
    readings(spark, [("V001-FL", n, 150.0 + n, 70.0 + n) for n in range(50)]).drop("ts").write.parquet(path)
    return spark.read.schema(schemas.READING).parquet(path)


@pytest.mark.parametrize("rule_set", [rules.TIERED, rules.MULTI, rules.CASE], ids=lambda r: r.name)
def test_rules_push_limits_into_the_scan_and_never_shuffle(stored_readings, rule_set):
    text = plan(rules.apply_rules(stored_readings, rule_set))
    assert "Exchange" not in text
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "LessThan(pressure_kpa" in pushed and "GreaterThan(temperature_c" in pushed
    assert "battery_voltage" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_aggregate_shuffles_once_after_combining(stored_readings):
    text = plan(aggregates.tumbling_aggregates(parse.with_event_time(stored_readings), exact_scale=2))
    assert text.count("Exchange hashpartitioning") == 1 == text.count("Exchange ")
    assert text.index("Exchange hashpartitioning") < text.index("partial_sum")


def test_message_is_parsed_once(spark):
    messages = spark.createDataFrame([("{}",)], "value string")
    text = plan(rules.apply_rules(parse.parse_tolerant(messages).valid, rules.TIERED))
    assert text.count("from_json") == 1


def test_top_k_limits_groups_before_the_shuffle(stored_readings):
    rows = parse.with_event_time(stored_readings, ts="timestamp")
    text = plan(serving.latest_per_vehicle(rows, ["sensor_id"]))
    assert re.search(r"WindowGroupLimit .*row_number\(\), 10, Partial", text)
    assert "TakeOrderedAndProject" in plan(serving.latest_of_vehicle(rows, "V001", ["sensor_id"]))


def test_newest_reads_one_column(spark):
    rows = data.readings(spark, SF_DIR)
    text = plan(serving.recent_aggregations(data.aggregate_table(rows), serving.newest(rows, "ts")))
    assert "ReadSchema: struct<event_id:bigint>\n" in text + "\n"


# Queries that write while they are built have no plan of their own left to look at.
WRITES = re.compile(r"scratch_path|_table\(|_json_alerts\(")
LAZY = [name for name, query in CATALOG.items() if not WRITES.search(inspect.getsource(query.__wrapped__).replace("data.aggregate_table(", "").replace("data.alert_table(", ""))]


def test_most_queries_are_lazy():
    assert len(LAZY) > 30 and "alerts_tiered" in LAZY and "tumble_agg_1m_stream" not in LAZY


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(CATALOG[name](spark, SF_DIR))
    for word in ("EvalPython", "InPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text
