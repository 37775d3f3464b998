import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from klaxon.functions import (
    decode_alerts,
    encode_alerts,
    event_time,
    incident_text,
    payloads_mentioning,
)
from klaxon.schema import ALERT

FIELDS = ALERT.fieldNames()


def decoded(spark, *payloads, **options):
    raw = spark.createDataFrame([(payload,) for payload in payloads], "value string")
    return decode_alerts(raw, **options).collect()


def test_valid_payload_has_typed_event_time(spark):
    (row,) = decoded(
        spark,
        '{"incident_id":"INC1","system":"A","component":"c","alert_type":"t",'
        '"severity":"HIGH","message":"m","timestamp":"2026-01-02T10:10:00.123456"}',
    )
    assert row.asDict() == {
        "incident_id": "INC1",
        "system": "A",
        "component": "c",
        "alert_type": "t",
        "severity": "HIGH",
        "message": "m",
        "timestamp": datetime(2026, 1, 2, 10, 10, 0, 123456),
    }


@pytest.mark.parametrize("payload", ["not json", "", None, "null", "[1, 2]", "5", '"text"'])
def test_payload_without_object_is_a_row_of_nulls(spark, payload):
    (row,) = decoded(spark, payload)
    assert list(row) == [None] * len(FIELDS)


def test_values_of_other_types_become_text_and_unknown_keys_drop(spark):
    (row,) = decoded(spark, '{"system":5,"message":{"a":[1]},"other":true,"severity":null}')
    assert (row.system, row.message, row.severity) == ("5", '{"a":[1]}', None)
    assert row.asDict().keys() == set(FIELDS)


def test_bytes_decode_like_text(spark):
    raw = spark.createDataFrame([(bytearray(b'{"system":"A"}'),)], "value binary")
    assert decode_alerts(raw).first().system == "A"


def test_only_chosen_fields_are_parsed(spark):
    raw = spark.createDataFrame([('{"system":"A","severity":"LOW"}',)], "value string")
    alerts = decode_alerts(raw, columns=("system", "severity"))
    assert alerts.columns == ["system", "severity"]
    assert tuple(alerts.first()) == ("A", "LOW")


@pytest.mark.parametrize("level", ["HIGH", 'a"b', "back\\slash", "größer", "tab\t"])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_no_payload_with_the_text_is_passed_over(spark, level, ascii_only):
    payloads = [json.dumps({"severity": level, "system": "A"}, ensure_ascii=ascii_only)]
    payloads.append("".join(["{", '"severity":"', *(f"\\u{ord(c):04x}" for c in level), '"}']))
    payloads += ['{"severity":"LOW"}', '{"severity":"LOW","system":"a\\nb"}', None, "", "HIGH"]
    raw = spark.createDataFrame([(payload,) for payload in payloads], "value string")
    kept = payloads_mentioning(raw, level)
    wanted = decode_alerts(raw).filter(F.col("severity") == level)
    assert decode_alerts(kept).filter(F.col("severity") == level).count() == wanted.count() == 2
    assert '{"severity":"LOW"}' not in {row.value for row in kept.collect()}


def test_a_severity_that_is_an_object_is_not_passed_over(spark):
    raw = spark.createDataFrame([('{"severity": {"a" : 1}}',), ('{"severity": 5}',)], "value string")
    found = {row.severity for row in decode_alerts(raw).collect()}
    for level in found:
        assert decode_alerts(payloads_mentioning(raw, level)).filter(F.col("severity") == level).count() == 1


def test_each_payload_is_parsed_once(spark):
    raw = spark.createDataFrame([("{}",)], "value string")
    alerts = decode_alerts(raw).filter("severity = 'HIGH' AND timestamp IS NOT NULL")
    plan = alerts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


TIMES = [
    # text, with fraction required, with fraction optional
    ("2026-01-02T10:10:00.123456", 123456, 123456),
    ("2026-01-02T10:10:00.123", 123000, 123000),
    ("2026-01-02T10:10:00.1234567", None, None),
    ("2026-01-02T10:10:00", None, 0),
    ("2026-01-02T10:10:00.123456Z", None, None),
    ("2026-01-02T10:10:00.123456+02:00", None, None),
    ("junk", None, None),
    (None, None, None),
]


@pytest.mark.parametrize("text,required,optional", TIMES)
def test_event_time(spark, text, required, optional):
    def expected(microsecond):
        return None if microsecond is None else datetime(2026, 1, 2, 10, 10, 0, microsecond)

    row = spark.createDataFrame([(text,)], "t string").select(
        event_time("t").alias("required"), event_time("t", "optional").alias("optional")
    ).first()
    assert (row.required, row.optional) == (expected(required), expected(optional))


def test_event_time_rejects_unknown_mode():
    with pytest.raises(ValueError):
        event_time("t", "sometimes")


def test_encode_then_decode_keeps_every_field(spark):
    rows = [
        ("INC1", "A", None, "t", "HIGH", 'quote " and \\', datetime(2026, 1, 2, 10, 10)),
        ("INC2", None, "$c", "t", "LOW", "ümläut\n", datetime(2026, 1, 2, 10, 10, 0, 1)),
        (None, "A", "c", None, None, "", None),
    ]
    alerts = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in FIELDS[:-1]) + ", timestamp timestamp")
    messages = encode_alerts(alerts, key="system")
    assert messages.dtypes == [("key", "string"), ("value", "string")]
    assert {tuple(row) for row in decode_alerts(messages).collect()} == set(rows)


def test_encoded_alert_writes_null_fields(spark):
    alerts = spark.createDataFrame([("INC1", None)], "incident_id string, system string")
    assert encode_alerts(alerts).first().value == '{"incident_id":"INC1","system":null}'


@pytest.mark.parametrize("hole", ["system", "component", "alert_type", "description", None])
def test_incident_text_needs_every_part(spark, hole):
    parts = {"system": "A", "component": "$B", "alert_type": "C", "description": "it broke"}
    if hole:
        parts[hole] = None
    df = spark.createDataFrame([tuple(parts.values())], ", ".join(f"{n} string" for n in parts))
    assert df.select(incident_text()).first()[0] == (None if hole else "A $B C it broke")
