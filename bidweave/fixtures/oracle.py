"""SQL for every query of ``bidweave.fixtures.queries``, on the driver's tables.

The SQL computes payload values directly instead of through JSON, so it checks
the JSON handling as well.
"""

from __future__ import annotations

from bidweave.fixtures.log import COUNTER_MODULUS, EVENT_TYPES, SPEND_COUNTERS
from bidweave.schema import (
    CAMPAIGN_COUNTERS,
    CAMPAIGN_GROUP_COUNTERS,
    GRAINS,
    PAYLOAD_COUNTERS,
    grain_of,
)

EVENTS_INPUTS = """
    SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS epoch,
           98 + user_id % 4 AS campaign_group_id
    FROM events"""

LINEITEM_INPUTS = f"""
    SELECT l_orderkey * 8 + l_linenumber AS event_id,
           l_suppkey AS user_id,
           list_extract({EVENT_TYPES}, CAST(l_linenumber % 5 + 1 AS INTEGER)) AS event_type,
           l_extendedprice AS value,
           1704067200000 + ((l_orderkey * 97 + l_linenumber * 13) % 14400 - 7200
                            + l_orderkey % 3 * 86400) * 1000 AS epoch,
           CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN -98 - user_id % 4
                ELSE 98 + user_id % 4 END AS campaign_group_id
    FROM lineitem"""


def _counter(name: str) -> str:
    text = "spend"
    if name not in SPEND_COUNTERS:
        text = f"CAST(event_id % {COUNTER_MODULUS[name]} AS VARCHAR)"
    return f"CASE WHEN event_id % 13 <> 0 THEN {text} END AS {name}"


def hours_from_midnight(first: int, end: int) -> str:
    """Predicate for whole hours counted from 2024-01-01 00:00."""
    start = 1704067200000
    return f"epoch >= {start + first * 3600000} AND epoch < {start + end * 3600000}"


DAY = hours_from_midnight(0, 24)
HOUR = "epoch // 3600000 % 24"


def log_ctes(inputs: str, kept: str = "true") -> str:
    """The log of the rows that ``kept`` accepts, and its terms."""
    counters = ",\n           ".join(_counter(c) for c in PAYLOAD_COUNTERS)
    return f"""WITH inputs AS ({inputs}
), spent AS (
    SELECT *, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS spend FROM inputs
), log AS (
    SELECT epoch, event_id, spend,
           strftime(make_timestamp(epoch * 1000), '%Y-%m-%d') AS dt,
           CAST(epoch // 3600000 % 24 AS INTEGER) AS hh,
           CAST(epoch // 60000 % 60 AS INTEGER) AS min,
           user_id % 2 AS advertiser_id,
           campaign_group_id,
           (98 + user_id % 4) * 10 + user_id % 3 AS campaign_id,
           CASE WHEN event_id % 11 <> 0 THEN 500 + user_id % 2 END AS flight_id,
           CASE WHEN event_id % 17 <> 0 THEN CAST(event_id AS VARCHAR) END AS auction_id,
           CASE WHEN event_type IN ('purchase', 'click') THEN true
                WHEN event_type <> 'error' THEN false END AS has_price,
           CASE WHEN event_type IN ('purchase', 'click')
                THEN CAST(value AS DECIMAL(12,4)) END AS price,
           CASE WHEN event_type = 'error' THEN 'budget' WHEN event_type = 'view' THEN 'floor'
                WHEN event_type <> 'signup' THEN '' END AS threshold_failure_reasons,
           campaign_group_id % 100 AS cgid_mod,
           CASE WHEN event_id % 13 <> 0 THEN CAST(event_id % 5 AS VARCHAR) END AS picked_term_id,
           CASE WHEN event_id % 13 = 0 THEN NULL
                WHEN event_id % 2 = 0 THEN '[1,2]' ELSE '[3]' END AS eligible_term_id,
           {counters}
    FROM spent WHERE {kept}
), terms AS (
    SELECT dt, hh, min, cgid_mod, advertiser_id, flight_id, campaign_group_id, campaign_id,
           threshold_failure_reasons, auction_id, eligible_term_id, picked_term_id, has_price,
           CAST(event_id % 5 + i AS VARCHAR) AS term_id,
           spend AS term_spend,
           CAST(event_id % 500 AS VARCHAR) AS term_spend_cap,
           CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS spend_capped,
           CASE WHEN event_id % 7 = 0 THEN 'maybe' WHEN event_id % 7 < 3 THEN 'true'
                ELSE 'false' END AS rate_limited,
           CAST(event_id % 100 AS VARCHAR) AS throttling_percentage,
           CASE WHEN i = 0 THEN CAST(event_id * 3 % 100 AS VARCHAR) END AS bid_volume_percentage
    FROM log CROSS JOIN (VALUES (0), (1)) AS t(i)
    WHERE event_id % 13 <> 0 AND i < event_id % 3
)"""


def _count(condition: str, name: str) -> str:
    return f"CAST(count(CASE WHEN {condition} THEN 1 END) AS BIGINT) AS {name}"


VOLUMES = ", ".join(
    [
        "CAST(count(auction_id) AS BIGINT) AS total_bid_requests",
        _count("has_price", "total_bids"),
        _count("NOT has_price", "total_204_bids"),
    ]
)


def _price(grain: str) -> str:
    return f"CAST(sum(price) AS DECIMAL(22,4)) AS {grain_of(grain).price}"


def _maxima(counters: list[str]) -> str:
    return ", ".join(f"max({c}) AS max_{c}" for c in counters)


def _grouped(keys: str, measures: str, source: str = "log") -> str:
    return f"SELECT {keys}, {measures} FROM {source} GROUP BY ALL"


def _g(grain: str) -> str:
    return ", ".join(GRAINS[grain].keys)


def campaign_group_rollup(grain: str) -> str:
    keys = f"{_g(grain)}, campaign_group_id, flight_id, advertiser_id, cgid_mod"
    return _grouped(keys, f"{VOLUMES}, {_price(grain)}, {_maxima(CAMPAIGN_GROUP_COUNTERS)}")


def campaign_rollup(grain: str) -> str:
    keys = f"{_g(grain)}, campaign_group_id, campaign_id, advertiser_id, flight_id, cgid_mod"
    return _grouped(keys, f"{VOLUMES}, {_price(grain)}, {_maxima(CAMPAIGN_COUNTERS)}")


def term_rollup(grain: str) -> str:
    keys = (
        f"{_g(grain)}, cgid_mod, advertiser_id, flight_id, campaign_group_id, campaign_id, "
        "eligible_term_id, picked_term_id, term_id"
    )
    measures = ", ".join(
        [
            VOLUMES,
            _count("TRY_CAST(spend_capped AS BOOLEAN)", "total_spend_capped"),
            _count("TRY_CAST(rate_limited AS BOOLEAN)", "total_rate_limited"),
            "CAST(max(term_spend) AS DECIMAL(10,2)) AS max_term_spend",
            "max(term_spend_cap) AS max_term_spend_cap",
            "max(throttling_percentage) AS throttling_percentage",
            "max(bid_volume_percentage) AS bid_volume_percentage",
        ]
    )
    return _grouped(keys, measures, "terms")


def campaign_group_failure_reasons(grain: str) -> str:
    reason = "threshold_failure_reasons AS cg_threshold_failure_reasons"
    return _grouped(
        f"{_g(grain)}, flight_id, campaign_group_id, {reason}",
        "CAST(count(auction_id) AS BIGINT) AS fail_count_cg_id",
    )


def campaign_failure_reasons(grain: str) -> str:
    reason = "threshold_failure_reasons AS campaign_threshold_failure_reasons"
    return _grouped(
        f"{_g(grain)}, campaign_group_id, campaign_id, {reason}",
        "CAST(count(auction_id) AS BIGINT) AS fail_count_campaign_id",
    )


def campaign_group_report(grain: str) -> str:
    return (
        f"SELECT * FROM ({campaign_group_rollup(grain)}) AS a "
        f"FULL OUTER JOIN ({campaign_group_failure_reasons(grain)}) AS f "
        f"USING ({_g(grain)}, campaign_group_id, flight_id)"
    )


def campaign_report(grain: str) -> str:
    return (
        f"SELECT * FROM ({campaign_rollup(grain)}) AS a "
        f"JOIN ({campaign_failure_reasons(grain)}) AS f "
        f"USING ({_g(grain)}, campaign_group_id, campaign_id)"
    )


def datasets(grains: list[str], own_bucket: bool = True) -> str:
    """All datasets stacked by column name.

    An overwriting run stores each row in its group's ``own_bucket``.
    """
    parts = []
    for grain in grains:
        g = grain_of(grain)
        for stem, body in (
            ("campaign_group", campaign_group_report(grain)),
            ("campaign", campaign_report(grain)),
            ("terms", term_rollup(grain)),
        ):
            bucket = " REPLACE (campaign_group_id % 100 AS cgid_mod)" if own_bucket else ""
            parts.append(f"SELECT '{g.dataset(stem)}' AS dataset, *{bucket} FROM ({body}) AS d")
    return " UNION ALL BY NAME ".join(parts)


def difference(left: str, right: str, grains: list[str]) -> str:
    """Rows of which the runs over two choices of log rows have different numbers."""
    sides = " UNION ALL BY NAME ".join(
        f"SELECT *, {a} AS l, {b} AS r FROM ({log_ctes(LINEITEM_INPUTS, kept)} {datasets(grains)}) AS s"
        for kept, a, b in ((left, 1, 0), (right, 0, 1))
    )
    return f"""SELECT * EXCLUDE (l, r), CAST(sum(l) AS BIGINT) AS left_copies, CAST(sum(r) AS BIGINT) AS right_copies
        FROM ({sides}) AS both_sides GROUP BY ALL HAVING sum(l) <> sum(r)"""


STORED = (
    "epoch, advertiser_id, campaign_group_id, campaign_id, flight_id, auction_id, has_price, "
    "price, threshold_failure_reasons, dt, hh, CAST(cgid_mod AS INTEGER) AS cgid_mod"
)
PAYLOAD = ", ".join([*PAYLOAD_COUNTERS, "picked_term_id", "eligible_term_id"])
IDS = "epoch, advertiser_id, campaign_group_id, campaign_id, flight_id, auction_id"


TRAILING = hours_from_midnight(-3, 3)
#: Rows that each job on the stored log rolls up, and its grains.
JOBS = {
    "run_rollups": (DAY, ["hour", "minute"]),
    "run_daily_hour": (DAY, ["hour"]),
    "run_daily_minute": (DAY, ["minute"]),
    "run_daily_one_hour": (f"{DAY} AND {HOUR} = 22", ["hour"]),
    "run_daily_buckets": (f"{DAY} AND campaign_group_id % 100 IN (98, 0)", ["hour"]),
    "run_daily_hour_and_buckets": (
        f"{DAY} AND {HOUR} = 1 AND campaign_group_id % 100 IN (99, -98)", ["minute"]
    ),
    "run_daily_all_buckets": (f"{DAY} AND {HOUR} = 1", ["hour"]),
    "run_daily_append": (DAY, ["hour"]),
    "run_intraday_hour": (TRAILING, ["hour"]),
    "run_intraday_minute": (TRAILING, ["minute"]),
    "run_intraday_cut": (hours_from_midnight(-1, 5), ["minute"]),
    "run_late_rows": (DAY, ["hour"]),
    "rerun_rollups": (f"{DAY} AND {HOUR} <> 1 AND campaign_group_id % 100 <> 98", ["hour"]),
}
APPENDING = ("run_daily_append",)


def build() -> dict[str, str]:
    events, stored = log_ctes(EVENTS_INPUTS), log_ctes(LINEITEM_INPUTS)
    n_terms = "CASE WHEN event_id % 13 <> 0 THEN CAST(event_id % 3 AS INTEGER) END AS n_terms"
    sql = {
        "normalize_bid_log": f"{events} SELECT {IDS}, has_price, price, "
        f"threshold_failure_reasons, cgid_mod, dt, hh, min, {PAYLOAD}, {n_terms} FROM log",
        "time_buckets": f"{events} SELECT epoch, dt, hh, min FROM log",
        "parse_pacing": f"{events} SELECT {IDS}, {PAYLOAD}, {n_terms} FROM log",
        "flatten_terms": f"{events} SELECT * FROM terms",
    }
    for grain in GRAINS:
        for operator in (
            campaign_group_rollup,
            campaign_rollup,
            term_rollup,
            campaign_group_failure_reasons,
            campaign_failure_reasons,
            campaign_group_report,
            campaign_report,
        ):
            sql[f"{operator.__name__}_{grain}"] = f"{events} {operator(grain)}"
    rows = f"{stored} SELECT {STORED} FROM log"
    sql |= {
        "scan_bid_log": rows,
        "window_day": f"{rows} WHERE dt = '2024-01-01'",
        "window_hour": f"{rows} WHERE dt = '2024-01-01' AND hh = 1",
        "window_mods": f"{rows} WHERE dt = '2024-01-01' AND campaign_group_id % 100 IN (98, 0)",
        "window_all_buckets": f"{rows} WHERE dt = '2024-01-01'",
        "window_default_date": f"{rows} WHERE dt = '2024-01-01'",
        "window_trailing_6h": f"{rows} WHERE {hours_from_midnight(-1, 5)}",
        "missing_partitions": f"""{stored}
            SELECT DATE '2024-01-01' AS dt, CAST(h AS INTEGER) AS hh, CAST(m AS INTEGER) AS cgid_mod
            FROM range(24) AS hours(h) CROSS JOIN (VALUES (98), (99), (0), (1), (2)) AS mods(m)
            WHERE NOT EXISTS (SELECT 1 FROM log
                WHERE log.dt = '2024-01-01' AND log.hh = h AND log.cgid_mod = m)""",
        "write_rollups": f"{stored} {datasets(['minute'], own_bucket=False)}",
        "archive_aged_partitions": f"""{stored}
            SELECT dt, hh, CAST(cgid_mod AS INTEGER) AS cgid_mod,
                   CASE WHEN dt <= '2024-01-01' THEN 'archive' ELSE 'log' END AS place,
                   CAST(count(*) AS BIGINT) AS log_rows,
                   CAST(count(auction_id) AS BIGINT) AS auctions,
                   CAST(sum(price) AS DECIMAL(22,4)) AS price
            FROM log GROUP BY ALL""",
    }
    both = ["hour", "minute"]
    around = log_ctes(LINEITEM_INPUTS, TRAILING)
    sql |= {
        "incremental_rollups": f"{stored} {datasets(both)}",
        "incremental_job": f"{stored} {datasets(['minute'])}",
        "stream_rollups": f"{around} {datasets(['minute'])}",
        "stream_late_rows": f"{around} {datasets(both)}",
        "diff_rollups": difference(DAY, f"{DAY} AND NOT ({HOUR} = 1 AND user_id % 2 = 0)", both),
    }
    for name, (kept, grains) in JOBS.items():
        bucket = name not in APPENDING
        sql[name] = f"{log_ctes(LINEITEM_INPUTS, kept)} {datasets(grains, bucket)}"
    return sql
