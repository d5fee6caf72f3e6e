"""Hand-made log rows."""

import json
from datetime import datetime, timezone
from decimal import Decimal

from bidweave.schema import BID_LOG_SCHEMA


def millis(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


def row(at="2024-01-01 05:10:20", **values):
    payload = values.pop("payload", None)
    if isinstance(payload, dict):
        payload = json.dumps(payload)
    base = {
        "epoch": None if at is None else millis(at),
        "advertiser_id": 1,
        "campaign_group_id": 105,
        "campaign_id": 1050,
        "flight_id": 7,
        "auction_id": "a",
        "has_price": "true",
        "price": Decimal("1.5000"),
        "threshold_failure_reasons": "floor",
        "pacing_debug_data": payload,
    }
    unknown = set(values) - set(base)
    assert not unknown, unknown
    base.update(values)
    return tuple(base[f] for f in BID_LOG_SCHEMA.fieldNames())


def log_of(spark, *rows):
    return spark.createDataFrame(list(rows), BID_LOG_SCHEMA)


def dicts(df):
    return [r.asDict() for r in df.collect()]
