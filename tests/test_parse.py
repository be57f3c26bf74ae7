import json

from fleetpulse.operators import parse, rules

FULL = {"sensor_id": "V001-FL", "vehicle_id": "V001", "timestamp": 1704067200000, "pressure_kpa": 210.5, "temperature_c": 71.25, "battery_voltage": 3.0}


def changed(**fields):
    return json.dumps({k: v for k, v in (FULL | fields).items() if v != "absent"})


GOOD = json.dumps(FULL)
CASES = {
    "good": GOOD,
    "spaces": f"  {GOOD} ",
    "extra": changed(note={"a": [1, 2]}),
    "no battery": changed(battery_voltage="absent"),
    "missing": changed(pressure_kpa="absent"),
    "null": changed(pressure_kpa=None),
    "text number": changed(pressure_kpa="175.5"),
    "text junk": changed(pressure_kpa="low"),
    "java suffix": changed(pressure_kpa="175.5d"),
    "exponent time": GOOD.replace("1704067200000", "1.7040672e12"),
    "text time": changed(timestamp="1704067200000"),
    "null sensor": changed(sensor_id=None),
    "truncated": GOOD[:-1],
    "trailing text": GOOD + " tail",
    "two objects": GOOD + GOOD,
    "two with comma": GOOD + "," + GOOD,
    "single quotes": GOOD.replace('"', "'"),
    "array": "[1,2]",
    "wrapped": f"[{GOOD}]",
    "string": '"sensor"',
    "number": "5",
    "null literal": "null",
    "empty": "",
    "no text": None,
    "repeated key": GOOD[:-1] + ',"pressure_kpa":190.0}',
    "not a number": GOOD.replace("210.5", "NaN"),
}


def frame(spark):
    return spark.createDataFrame(list(CASES.items()), "name string, value string")


def test_strict(spark):
    out = parse.parse_strict(frame(spark))
    valid = {r.name: r for r in out.valid.collect()}
    assert set(valid) == {
        "good", "spaces", "extra", "no battery", "null", "text number", "text junk", "java suffix",
        "exponent time", "text time", "null sensor", "repeated key", "not a number",
    }
    assert valid["good"].pressure_kpa == 210.5 and valid["good"].ts_ms == 1704067200000
    assert valid["exponent time"].ts_ms == 1704067200000
    assert valid["text number"].pressure_kpa is None and valid["null"].pressure_kpa is None
    assert valid["repeated key"].pressure_kpa == 190.0
    assert valid["no battery"].battery_voltage is None
    rest = {r.name: r.reason for r in out.quarantine.collect()}
    assert set(rest) == set(CASES) - set(valid)
    assert rest["missing"] == "missing_field"
    assert {v for k, v in rest.items() if k != "missing"} == {"malformed"}


def test_tolerant(spark):
    out = parse.parse_tolerant(frame(spark))
    valid = {r.name: r for r in out.valid.collect()}
    assert set(valid) == {"good", "spaces", "extra", "no battery", "text number", "exponent time", "repeated key", "not a number"}
    assert valid["text number"].pressure_kpa == 175.5
    rest = {r.name: r.reason for r in out.quarantine.collect()}
    assert set(rest) == set(CASES) - set(valid)
    assert rest["null"] == rest["text junk"] == rest["missing"] == rest["java suffix"] == "bad_value"
    assert rest["truncated"] == rest["no text"] == "malformed"


def test_valid_and_quarantine_cover_everything_once(spark):
    for split in (parse.parse_strict, parse.parse_tolerant):
        out = split(frame(spark))
        names = [r.name for r in out.valid.select("name").union(out.quarantine.select("name")).collect()]
        assert sorted(names) == sorted(CASES)


def test_smoke_classes(spark):
    texts = {
        "low": changed(pressure_kpa=179.9),
        "hot": changed(temperature_c=80.1),
        "fine": GOOD,
        "pressure absent": changed(pressure_kpa="absent"),
        "pressure null": changed(pressure_kpa=None),
        "temperature absent": changed(temperature_c="absent"),
        "temperature null": changed(temperature_c=None),
        "low, temperature null": changed(pressure_kpa=100.0, temperature_c=None),
        "sensor absent": changed(sensor_id="absent"),
        "low, sensor absent": changed(sensor_id="absent", pressure_kpa=100.0),
        "text pressure": changed(pressure_kpa="100"),
        "bad": "{bad",
    }
    rows = spark.createDataFrame(list(texts.items()), "name string, value string")
    got = {r.name: r["class"] for r in rules.smoke_classes(rows).collect()}
    assert got == {
        "low": "LOW PRESSURE",
        "hot": "HIGH TEMP",
        "fine": None,
        "temperature absent": None,
        "low, temperature null": "LOW PRESSURE",
        "sensor absent": None,
    }


def test_tire_data_times(spark):
    texts = [
        '{"tire_id":"a","pressure":1.5,"temperature":2.5,"timestamp":1704067200.5}',
        '{"tire_id":"b","pressure":1.5,"temperature":2.5,"timestamp":"1704067200"}',
        '{"tire_id":"c","pressure":1.5,"temperature":2.5,"timestamp":"soon"}',
        "{bad",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {r.tire_id: r.ms for r in parse.parse_tire_data(rows).selectExpr("tire_id", "unix_millis(timestamp) ms").collect()}
    assert got == {"a": 1704067200500, "b": 1704067200000}


def test_legacy_and_sql_scans(spark):
    legacy = spark.createDataFrame([('{"vehicle_id":"V1","tire_position":"FL","pressure_psi":80,"temperature_c":70,"timestamp":5}',), ("x",)], "value string")
    assert [tuple(r) for r in parse.parse_legacy(legacy).collect()] == [("V1", "FL", 80.0, 70.0, 5)]
    names = {r.name for r in parse.parse_sql_table(frame(spark)).collect()}
    assert "missing" in names and "truncated" not in names and "array" not in names
