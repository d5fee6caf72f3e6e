"""Queries that look at the log and its rollups from other sides, with their SQL."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidweave.fixtures import oracle
from bidweave.fixtures.log import events_log, lineitem_log
from bidweave.fixtures.oracle import EVENTS_INPUTS, LINEITEM_INPUTS, VOLUMES, log_ctes
from bidweave.fixtures.queries import Query, bid_source, stored_log, term_source
from bidweave.operators import rollups as R
from bidweave.operators.distinct import ERROR, estimated, exact_distinct, merged, sketches
from bidweave.operators.intervals import range_totals
from bidweave.operators.normalize import normalize_bid_log, publish
from bidweave.operators.reports import campaign_group_report, groups_with_null_key
from bidweave.operators.slices import as_of_join, gap_sessions, running_total, slice_width, trailing_total
from bidweave.operators.totals import top_with_ties, totals_by_level
from bidweave.plans.base import stage_base
from bidweave.schema import CAMPAIGN_COUNTERS, CAMPAIGN_GROUP_COUNTERS, GRAINS, TERM_PAYLOAD_FIELDS
from bidweave.session import new_shared_path, staged
from bidweave.sources.bid_log import scan_bid_log
from bidweave.sources.lines import good_rows, parsed_lines, read_lines, rejected_lines

MINUTES = 60_000
GAP, SPAN = 40_000, 10 * MINUTES


def q_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bid with the pacing term its campaign last reported."""
    log = lineitem_log(spark, sf_dir)
    timed = normalize_bid_log(log, TERM_PAYLOAD_FIELDS)
    states = timed.select("campaign_id", "epoch", F.explode("terms").alias("term")).select(
        "campaign_id", "epoch", *[F.col("term")[k].alias(n) for k, n in
                                  (("id", "term_id"), ("spend", "term_spend"), ("spend_cap", "term_spend_cap"))]
    )
    bids = timed.where("has_price").select("epoch", "campaign_id", "auction_id", "price")
    return as_of_join(bids, states, ["campaign_id"], "epoch", ["term_id", "term_spend", "term_spend_cap"])


AS_OF = """, exploded AS (
    SELECT log.campaign_id, log.epoch, CAST(event_id % 5 + i AS VARCHAR) AS term_id, spend AS term_spend,
           CAST(event_id % 500 AS VARCHAR) AS term_spend_cap
    FROM log CROSS JOIN (VALUES (0), (1)) AS t(i) WHERE event_id % 13 <> 0 AND i < event_id % 3
), states AS (
    SELECT * FROM exploded QUALIFY row_number() OVER (
        PARTITION BY campaign_id, epoch ORDER BY term_id DESC, term_spend DESC, term_spend_cap DESC) = 1
)
SELECT b.epoch, b.campaign_id, b.auction_id, b.price, s.term_id, s.term_spend, s.term_spend_cap
FROM (SELECT * FROM log WHERE has_price) AS b
ASOF LEFT JOIN states AS s ON b.campaign_id = s.campaign_id AND b.epoch >= s.epoch"""


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights of an advertiser, a few seconds to days long, overlapping, some open on a side."""
    part = F.col("p_partkey")
    start = F.lit(1704060000000) + part * 7919 % 180000 * 1000
    seconds = F.when(part % 40 == 0, part * 31 % 100000).otherwise(part * 37 % 50)
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(
        part.alias("booking_id"),
        (part % 2).alias("advertiser_id"),
        F.when(part % 300 != 0, start).alias("starts_at"),
        F.when(part % 310 != 0, start + seconds * 1000).alias("ends_at"),
    )


def q_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows and spend of each booking."""
    log = lineitem_log(spark, sf_dir).select("epoch", "advertiser_id", "campaign_id", "price")
    measures = {
        "log_rows": (F.count("*"), F.sum), "price": (F.sum("price"), F.sum), "last_at": (F.max("epoch"), F.max)
    }
    return range_totals(
        log, flights(spark, sf_dir), "epoch", "starts_at", "ends_at", ["advertiser_id"], ["campaign_id"], measures
    )


RANGE = """, flights AS (
    SELECT p_partkey AS booking_id, p_partkey % 2 AS advertiser_id,
           1704060000000 + p_partkey * 7919 % 180000 * 1000 AS start,
           CASE WHEN p_partkey % 40 = 0 THEN p_partkey * 31 % 100000 ELSE p_partkey * 37 % 50 END AS seconds,
           CASE WHEN p_partkey % 300 <> 0 THEN start END AS starts_at,
           CASE WHEN p_partkey % 310 <> 0 THEN start + seconds * 1000 END AS ends_at
    FROM part
)
SELECT f.booking_id, f.advertiser_id, f.starts_at, f.ends_at, log.campaign_id, CAST(count(*) AS BIGINT) AS log_rows,
       CAST(sum(price) AS DECIMAL(22,4)) AS price, max(epoch) AS last_at
FROM log JOIN flights AS f ON log.advertiser_id = f.advertiser_id
     AND epoch BETWEEN coalesce(starts_at, epoch) AND coalesce(ends_at, epoch)
GROUP BY ALL"""


def spend_cap(log: DataFrame) -> DataFrame:
    """Priced log rows with the daily spend cap of their payload as a number."""
    priced = normalize_bid_log(log, ["daily_campaign_spend_cap"]).where("price IS NOT NULL")
    cap = F.col("daily_campaign_spend_cap").try_cast("decimal(12,2)")
    return priced.select("epoch", "campaign_id", "auction_id", "price", cap.alias("spend_cap"))


def q_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running spend of each campaign, its share of the last ten minutes, and whether it is over the cap."""
    # The payload is parsed once, for the slices' width and both totals.
    rows, keys = staged(spend_cap(lineitem_log(spark, sf_dir)), "priced"), ["campaign_id"]
    width = slice_width(rows, keys, "epoch")
    running = running_total(rows, keys, "epoch", "price", "running_spend", width)
    moving = trailing_total(running, keys, "epoch", "price", "recent_spend", SPAN, width)
    return moving.withColumn("over_cap", F.col("running_spend") > F.col("spend_cap") * 1000)


VELOCITY = f"""
SELECT epoch, campaign_id, auction_id, price,
       CASE WHEN event_id % 13 <> 0 THEN CAST(event_id % 310 AS DECIMAL(12,2)) END AS spend_cap,
       CAST(sum(price) OVER w AS DECIMAL(22,4)) AS running_spend,
       CAST(sum(price) OVER (PARTITION BY campaign_id ORDER BY epoch
                             RANGE BETWEEN {SPAN} PRECEDING AND CURRENT ROW) AS DECIMAL(22,4)) AS recent_spend,
       sum(price) OVER w > CASE WHEN event_id % 13 <> 0 THEN event_id % 310 * 1000 END AS over_cap
FROM log WHERE price IS NOT NULL
WINDOW w AS (PARTITION BY campaign_id ORDER BY epoch RANGE UNBOUNDED PRECEDING)"""


def q_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spells of each flight's priced bids without a break of more than forty seconds."""
    log = lineitem_log(spark, sf_dir).where("price IS NOT NULL")
    measures = [F.count("*").alias("bids"), F.sum("price").alias("price")]
    return gap_sessions(log, ["campaign_group_id", "flight_id", "campaign_id"], "epoch", GAP, measures)


SESSIONS = f""", linked AS (
    SELECT campaign_group_id, flight_id, campaign_id, epoch, price, epoch - lag(epoch) OVER w AS idle
    FROM log WHERE price IS NOT NULL WINDOW w AS (PARTITION BY campaign_group_id, flight_id, campaign_id ORDER BY epoch)
), marked AS (
    SELECT *, CASE WHEN idle IS NULL OR idle > {GAP} THEN 1 ELSE 0 END AS starts FROM linked
), numbered AS (
    SELECT *, CAST(sum(starts) OVER (PARTITION BY campaign_group_id, flight_id, campaign_id ORDER BY epoch
                                     RANGE UNBOUNDED PRECEDING) AS BIGINT) AS session FROM marked
)
SELECT campaign_group_id, flight_id, campaign_id, session, min(epoch) AS started, max(epoch) AS ended,
       max(CASE WHEN starts = 1 THEN idle END) AS idle_before, CAST(count(*) AS BIGINT) AS bids,
       CAST(sum(price) AS DECIMAL(22,4)) AS price
FROM numbered GROUP BY ALL"""


def q_levels(grain: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all levels of ids from the staged base of the stored log."""
    raw = scan_bid_log(spark, stored_log(spark, sf_dir))
    base = stage_base(spark, raw, "minute", new_shared_path(spark, "levels"))
    return publish(totals_by_level(base.bids, grain))


def levels_sql(grain: str) -> str:
    g = GRAINS[grain]
    time, ids = ", ".join(g.keys), ["advertiser_id", "campaign_group_id", "campaign_id"]
    sets = ", ".join(f"({', '.join([*g.keys, *ids[:n]])})" for n in (3, 2, 1, 0))
    level = " - ".join(["3", *(f"CAST(grouping({c}) AS INTEGER)" for c in ids)])
    return f"""
SELECT {time}, {", ".join(ids)}, CAST({level} AS INTEGER) AS level, {VOLUMES},
       CAST(sum(price) AS DECIMAL(22,4)) AS {g.price}
FROM log GROUP BY GROUPING SETS ({sets})"""


DISTINCT_KEYS = ["dt", "hh", "campaign_group_id"]


def q_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(exact_distinct(normalize_bid_log(lineitem_log(spark, sf_dir), []), DISTINCT_KEYS))


DISTINCT = """
SELECT dt, hh, campaign_group_id, CAST(count(DISTINCT auction_id) AS BIGINT) AS auctions FROM log GROUP BY ALL"""


def _close(estimate: Column, exact: Column) -> Column:
    """Within the stated error, or one of a small number."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * ERROR)


def q_distinct_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days' distinct auctions from minutes' sketches, next to the exact numbers."""
    log = normalize_bid_log(lineitem_log(spark, sf_dir), [])
    path = new_shared_path(spark, "sketches")
    sketches(log, ["dt", "hh", "min", "campaign_group_id"]).write.parquet(path)
    hours = merged(spark.read.parquet(path), DISTINCT_KEYS)
    days = estimated(merged(hours, ["dt", "campaign_group_id"]), "estimate")
    exact = exact_distinct(log, ["dt", "campaign_group_id"]).select(
        F.col("dt").alias("d"), F.col("campaign_group_id").alias("g"), "auctions"
    )
    same = F.col("dt").eqNullSafe(F.col("d")) & F.col("campaign_group_id").eqNullSafe(F.col("g"))
    close = _close(F.col("estimate"), F.col("auctions")).alias("within_error")
    return publish(days.join(exact, same).select("dt", "campaign_group_id", "auctions", close))


DISTINCT_SKETCHED = """
SELECT dt, campaign_group_id, CAST(count(DISTINCT auction_id) AS BIGINT) AS auctions, true AS within_error
FROM log GROUP BY ALL"""


def q_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most frequent failure reasons of a campaign in each hour, with all ties."""
    log = lineitem_log(spark, sf_dir)
    reasons = R.campaign_failure_reasons(bid_source(log, []), "hour")
    return publish(top_with_ties(reasons, ["dt", "hh"], "fail_count_campaign_id", 3))


TOP = f"""
SELECT *, CAST(rank() OVER (PARTITION BY dt, hh ORDER BY fail_count_campaign_id DESC) AS INTEGER) AS rank
FROM ({oracle.campaign_failure_reasons("hour")}) AS r QUALIFY rank <= 3"""


#: Seconds, of 97, whose lines are torn, have a bad time or none, or are too long.
PARTS, BROKEN = 97, (17, 29, 37, 41)
LONGEST = 900


def text_log(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """The log as lines of text, some torn, some with a bad number, some without a time, some too long."""
    log = lineitem_log(spark, sf_dir)
    n = F.expr("epoch div 1000") % PARTS
    fields = [F.col(c).cast("string").alias(c) for c in log.columns if c != "pacing_debug_data"]
    torn, bad, none, long = BROKEN
    epoch = F.when(n == bad, F.lit("soon")).when(n != none, F.col("epoch").cast("string")).alias("epoch")
    cells = [epoch, *fields[1:], F.when(n == long, F.repeat(F.lit("x"), LONGEST)).alias("pacing_debug_data")]
    line = F.to_json(F.struct(*cells))
    if kind == "csv":
        line = F.array_join(F.array(*[F.coalesce(c, F.lit("")) for c in cells]), "\t")
        line = F.when(n == torn, F.substring_index(line, "\t", 4)).otherwise(line)
    else:
        line = F.when(n == torn, F.substring(line, 1, 30)).otherwise(line)
    path = new_shared_path(spark, f"lines-{kind}")
    log.select(line.alias("value")).write.text(path)
    return path


def q_lines(kind: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows and rejected lines of a log of text lines, counted by hour and by reason."""
    parsed = parsed_lines(read_lines(spark, text_log(spark, sf_dir, kind)), kind, most_chars=LONGEST)
    path = new_shared_path(spark, "quarantine")
    rejected_lines(parsed).write.partitionBy("reason").parquet(path)
    rows = normalize_bid_log(good_rows(parsed), [])
    good = rows.groupBy("dt", "hh").agg(
        F.count("*").alias("lines"), F.count("auction_id").alias("auctions"), F.sum("price").alias("price")
    )
    bad = spark.read.parquet(path).groupBy("reason").agg(F.count("*").alias("lines"))
    return publish(good.unionByName(bad, allowMissingColumns=True))


def lines_sql(torn: str) -> str:
    return f"""
, marked AS (
    SELECT *, CASE epoch // 1000 % {PARTS} WHEN {BROKEN[0]} THEN '{torn}' WHEN {BROKEN[1]} THEN 'bad epoch'
              WHEN {BROKEN[2]} THEN 'no epoch' WHEN {BROKEN[3]} THEN 'line too long' END AS reason FROM log
)
SELECT dt, hh, CAST(count(*) AS BIGINT) AS lines, CAST(count(auction_id) AS BIGINT) AS auctions,
       CAST(sum(price) AS DECIMAL(22,4)) AS price, NULL AS reason FROM marked WHERE reason IS NULL GROUP BY ALL
UNION ALL
SELECT NULL, NULL, CAST(count(*) AS BIGINT), NULL, NULL, reason FROM marked WHERE reason IS NOT NULL GROUP BY ALL"""


# Choices of the rollups and reports


def q_null_safe(grain: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign-group report in which NULL flights match each other."""
    log = events_log(spark, sf_dir)
    rollup = R.campaign_group_rollup(bid_source(log, CAMPAIGN_GROUP_COUNTERS), grain)
    bids = bid_source(log, [])
    reasons = R.campaign_group_failure_reasons(bids, grain)
    lone = groups_with_null_key(bids, grain)
    return publish(campaign_group_report(rollup, reasons, lone, grain, null_safe=True))


def null_safe_sql(grain: str) -> str:
    keys = [*GRAINS[grain].keys, "campaign_group_id", "flight_id"]
    same = " AND ".join(f"a.{k} IS NOT DISTINCT FROM f.{k}" for k in keys)
    return f"""
SELECT a.*, f.cg_threshold_failure_reasons, f.fail_count_cg_id
FROM ({oracle.campaign_group_failure_reasons(grain)}) AS f
LEFT JOIN ({oracle.campaign_group_rollup(grain)}) AS a ON {same}"""


def q_numeric(kind: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollups whose maxima compare numbers."""
    log = events_log(spark, sf_dir)
    if kind == "terms":
        return publish(R.term_rollup(term_source(log), "hour", numeric_max=True))
    if kind == "campaign":
        return publish(R.campaign_rollup(bid_source(log, CAMPAIGN_COUNTERS), "hour", numeric_max=True))
    return publish(R.campaign_group_rollup(bid_source(log, CAMPAIGN_GROUP_COUNTERS), "hour", numeric_max=True))


def numeric_sql(rollup: str, texts: list[str]) -> str:
    """The SQL of a rollup with text maxima turned into those of the greatest number."""
    for text in sorted(texts, key=len, reverse=True):
        rollup = rollup.replace(f"max({text})", f"max_by({text}, CAST({text} AS DECIMAL(38,6)))")
    return rollup


def q_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign rollup of a log whose files hold BOOLEAN has_price and DOUBLE price."""
    log = lineitem_log(spark, sf_dir)
    path = new_shared_path(spark, "typed-log")
    typed = {"has_price": F.col("has_price").cast("boolean"), "price": F.col("price").cast("double")}
    log.withColumns(typed).write.parquet(path)
    found = R.campaign_rollup(bid_source(scan_bid_log(spark, path), CAMPAIGN_COUNTERS), "hour")
    price = F.col("bid_price_per_hour")
    return publish(found.withColumn("bid_price_per_hour", price.cast("decimal(22,4)")))


def build() -> dict[str, Query]:
    return {
        "bids_with_term_state": q_as_of,
        "rows_of_bookings": q_range,
        "spend_velocity": q_velocity,
        "bid_sessions": q_sessions,
        "totals_by_level_hour": partial(q_levels, "hour"),
        "totals_by_level_minute": partial(q_levels, "minute"),
        "distinct_auctions": q_distinct,
        "distinct_auctions_sketched": q_distinct_sketched,
        "top_failure_reasons": q_top,
        "json_lines_log": partial(q_lines, "json"),
        "text_lines_log": partial(q_lines, "csv"),
        "campaign_group_report_null_safe_hour": partial(q_null_safe, "hour"),
        "campaign_group_report_null_safe_minute": partial(q_null_safe, "minute"),
        "campaign_group_rollup_numeric": partial(q_numeric, "group"),
        "campaign_rollup_numeric": partial(q_numeric, "campaign"),
        "term_rollup_numeric": partial(q_numeric, "terms"),
        "campaign_rollup_typed_log": q_typed,
    }


def sql() -> dict[str, str]:
    stored, events = log_ctes(LINEITEM_INPUTS), log_ctes(EVENTS_INPUTS)
    terms = ["term_spend", "term_spend_cap", "throttling_percentage", "bid_volume_percentage"]
    found = {
        "bids_with_term_state": AS_OF,
        "rows_of_bookings": RANGE,
        "spend_velocity": VELOCITY,
        "bid_sessions": SESSIONS,
        "totals_by_level_hour": levels_sql("hour"),
        "totals_by_level_minute": levels_sql("minute"),
        "distinct_auctions": DISTINCT,
        "distinct_auctions_sketched": DISTINCT_SKETCHED,
        "top_failure_reasons": TOP,
        "json_lines_log": lines_sql("broken line"),
        "text_lines_log": lines_sql("wrong number of fields"),
        "campaign_rollup_typed_log": oracle.campaign_rollup("hour"),
    }
    by_events = {
        "campaign_group_report_null_safe_hour": null_safe_sql("hour"),
        "campaign_group_report_null_safe_minute": null_safe_sql("minute"),
        "campaign_group_rollup_numeric": numeric_sql(oracle.campaign_group_rollup("hour"), CAMPAIGN_GROUP_COUNTERS),
        "campaign_rollup_numeric": numeric_sql(oracle.campaign_rollup("hour"), CAMPAIGN_COUNTERS),
        "term_rollup_numeric": numeric_sql(oracle.term_rollup("hour"), terms),
    }
    return {n: f"{stored} {q}" for n, q in found.items()} | {n: f"{events} {q}" for n, q in by_events.items()}
