"""Alerts to and from their JSON payload."""

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from klaxon.functions.conversions import EVENT_TIME_PATTERNS, event_time
from klaxon.schema import ALERT


def decode_alerts(
    raw: DataFrame,
    fraction: str = "required",
    columns: Sequence[str] | None = None,
    value: str = "value",
) -> DataFrame:
    """Alerts from a column of JSON bytes or text; works on batches and streams.

    Unknown keys are dropped and missing ones are NULL. A payload that is no JSON object
    becomes a row of NULLs, which the severity filter removes later. ``columns`` limits
    the fields that are parsed, which is cheaper when only some are needed.

    The struct is unpacked with ``inline`` rather than by selecting its fields: the
    optimizer would push filters on those fields below the projection and parse each
    payload once per filter.
    """
    names = list(columns) if columns is not None else ALERT.fieldNames()
    schema = T.StructType([ALERT[name] for name in names])
    payload = F.from_json(F.col(value).cast("string"), schema)
    alerts = raw.select(F.inline(F.array(payload)))
    if "timestamp" in names:
        alerts = alerts.withColumn("timestamp", event_time("timestamp", fraction))
    return alerts


def checked_alerts(raw: DataFrame, fraction: str = "required", value: str = "value") -> DataFrame:
    """Alerts with ``payload``, the text they came from, and ``problem``, NULL for sound ones.

    ``not JSON`` has no alert in it: text that is no JSON, or JSON other than an object, or no
    payload at all. ``no event time`` is an alert whose time is missing or in another form;
    no window would count it.
    """
    corrupt = "_corrupt_record"
    schema = T.StructType([*ALERT.fields, T.StructField(corrupt, T.StringType())])
    payload = F.col(value).cast("string")
    parsed = F.from_json(payload, schema, {"columnNameOfCorruptRecord": corrupt})
    rows = raw.select(payload.alias("payload"), F.inline(F.array(parsed)))
    rows = rows.withColumn("timestamp", event_time("timestamp", fraction))
    # A top-level array of one object would be read as that object.
    is_object = F.coalesce(F.regexp_like("payload", F.lit(r"^\s*\{")), F.lit(False))
    bad = F.col(corrupt).isNotNull() | ~is_object
    problem = F.when(bad, "not JSON").when(F.col("timestamp").isNull(), "no event time")
    return rows.select(*ALERT.fieldNames(), "payload", problem.alias("problem"))


def payloads_mentioning(raw: DataFrame, text: str, value: str = "value") -> DataFrame:
    """Payloads in which some field may equal ``text``, found without parsing them.

    Drops no other payload than those that cannot: JSON spells a text as it is, or with
    escapes, which take a backslash. A text that is JSON itself may also come from a number
    or an object that is spelled in another way; for such a one all payloads stay.
    """
    try:
        json.loads(text)
    except ValueError:
        pass
    else:
        return raw
    payload = F.col(value).cast("string")
    return raw.filter(payload.contains(text) | payload.contains("\\"))


def encode_alerts(alerts: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON object per alert in ``value``, ready for a message sink.

    Event times are written with all six digits, so that decoding never loses one.
    ``key`` names a column whose text becomes the message key. Choose one with many
    values: the key decides the partition, and a hot key makes a hot partition.
    """
    fields = [
        F.date_format(field, EVENT_TIME_PATTERNS["required"]).alias(field)
        if alerts.schema[field].dataType.typeName().startswith("timestamp")
        else F.col(field)
        for field in alerts.columns
    ]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value")
    if key is None:
        return alerts.select(value)
    return alerts.select(F.col(key).cast("string").alias("key"), value)
