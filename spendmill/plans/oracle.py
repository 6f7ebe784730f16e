"""The expected result of each query as SQL over the given tables, written independently of the
operators (windows instead of struct maxima, a full rebuild instead of an incremental refresh)."""

from __future__ import annotations

_PRELUDE = """
WITH base AS (SELECT *, event_id % 2 AS ver FROM events),
raw AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 5 THEN 'N/A' WHEN event_id % 89 = 3 THEN NULL
         WHEN ver = 0 THEN concat(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), 'Z')
         ELSE concat(strftime(ts + INTERVAL '330' MINUTE, '%Y-%m-%dT%H:%M:%S.%f'), '+05:30') END AS event_time,
    ts AS ingest_time, user_id AS advertiser_id,
    CASE WHEN event_id % 83 = 7 THEN NULL WHEN user_id % 3 = 0 THEN 'INR' ELSE 'USD' END AS currency,
    CASE WHEN ver = 0 AND event_id % 79 <> 2
         THEN CASE WHEN event_id % 73 = 4 THEN -value ELSE value END END AS spend,
    CASE WHEN ver = 1 AND event_id % 79 <> 2
         THEN CASE WHEN event_id % 73 = 4 THEN -value ELSE value END END AS media_cost,
    CASE WHEN ver = 1 THEN value / 500 END AS viewability
  FROM base),
allr AS (
  SELECT * FROM raw
  UNION ALL SELECT * FROM raw WHERE event_id % 41 = 1
  UNION ALL SELECT event_id, event_time, ingest_time + INTERVAL '1' HOUR, advertiser_id, currency,
                   spend * 2, media_cost * 2, viewability
            FROM raw WHERE event_id % 53 = 6),
tagged AS (
  SELECT *, CASE WHEN event_id % 2 = 0 THEN 'v1' ELSE 'v2' END AS schema_version,
            CASE WHEN event_id % 2 = 0 THEN 'events_v1.csv' ELSE 'events_v2.csv' END AS source_file FROM allr),
uni AS (
  SELECT *, coalesce(spend, media_cost) AS cost_raw,
    try_cast(left(event_time, 26) AS TIMESTAMP)
      - CASE WHEN event_time LIKE '%+05:30' THEN INTERVAL '330' MINUTE ELSE INTERVAL '0' MINUTE END AS event_time_utc
  FROM tagged),
tag AS (
  SELECT *, CASE WHEN event_time_utc IS NULL THEN 'malformed_timestamp'
                 WHEN cost_raw < 0 THEN 'negative_cost'
                 WHEN currency IS NULL THEN 'missing_currency'
                 WHEN cost_raw IS NULL THEN 'missing_cost' END AS reason FROM uni),
good AS (SELECT * EXCLUDE (reason) FROM tag WHERE reason IS NULL),
rk AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingest_time DESC, coalesce(cost_raw, -1) DESC) AS rn
  FROM good),
dim AS (
  SELECT c_custkey AS advertiser_id, CASE WHEN c_custkey % 11 = 5 THEN NULL ELSE c_name END AS advertiser_name
  FROM customer WHERE c_custkey % 10 <> 9),
silver AS (
  SELECT * EXCLUDE (rn), CASE currency WHEN 'INR' THEN cost_raw / 83.0 WHEN 'USD' THEN cost_raw END AS cost_usd
  FROM rk WHERE rn = 1),
named AS (
  SELECT s.*, coalesce(d.advertiser_name, 'UNKNOWN') AS advertiser_name,
         d.advertiser_id IS NULL AS is_unmapped_advertiser
  FROM silver s LEFT JOIN dim d ON s.advertiser_id = d.advertiser_id),
gold AS (
  SELECT CAST(event_time_utc AS DATE) AS event_date, advertiser_id, advertiser_name, is_unmapped_advertiser,
         CAST(sum(CAST(cost_usd AS DECIMAL(28, 10))) AS DOUBLE) AS total_spend_usd, count(*) AS event_count
  FROM named GROUP BY 1, 2, 3, 4),
runs AS (
  SELECT advertiser_id, count(*) AS streak_length, min(event_date) AS streak_start, max(event_date) AS streak_end
  FROM (SELECT *, event_date - CAST(row_number() OVER (PARTITION BY advertiser_id ORDER BY event_date) AS INTEGER) AS m
        FROM (SELECT DISTINCT advertiser_id, event_date FROM gold WHERE event_count >= 1) d) i
  GROUP BY advertiser_id, m),
tgt AS (
  SELECT * FROM (
    SELECT event_id, ingest_time, advertiser_id, currency, coalesce(spend, media_cost) AS cost_raw,
      try_cast(left(event_time, 26) AS TIMESTAMP)
        - CASE WHEN event_time LIKE '%+05:30' THEN INTERVAL '330' MINUTE ELSE INTERVAL '0' MINUTE END AS event_time_utc
    FROM raw) x
  WHERE event_time_utc IS NOT NULL AND currency IS NOT NULL AND cost_raw >= 0),
cor AS (
  SELECT event_id, ingest_time + INTERVAL '1' HOUR * (event_id % 3 - 1) AS ingest_time, advertiser_id, currency,
         cost_raw * 2 AS cost_raw,
         event_time_utc + INTERVAL '1' DAY * (CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END) AS event_time_utc
  FROM (SELECT * FROM tgt UNION ALL SELECT * REPLACE (event_id + 1000000007 AS event_id) FROM tgt WHERE event_id % 7 = 1) t
  WHERE CAST(event_time_utc AS DATE) IN (DATE '2024-01-10', DATE '2024-01-11') AND (event_id % 3 < 2 OR event_id > 1000000000)),
ups AS (
  SELECT * EXCLUDE (rn, prio) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingest_time DESC, prio) AS rn
    FROM (SELECT *, 0 AS prio FROM tgt UNION ALL SELECT *, 1 AS prio FROM cor) u) v
  WHERE rn = 1),
amd AS (
  SELECT event_id, ingest_time + INTERVAL '1' HOUR AS ingest_time, advertiser_id, currency, cost_raw * 3 AS cost_raw,
         event_time_utc + INTERVAL '1' DAY * (CASE WHEN event_id % 3 = 0 THEN 2 ELSE 0 END) AS event_time_utc
  FROM (SELECT * FROM tgt WHERE event_id % 4 IN (1, 2)
        UNION ALL SELECT * REPLACE (event_id + 1000000007 AS event_id) FROM tgt WHERE event_id % 29 = 1) t
  WHERE advertiser_id % 4 = 0),
amended AS (
  SELECT * EXCLUDE (rn, prio) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingest_time DESC, prio) AS rn
    FROM (SELECT *, 0 AS prio FROM tgt UNION ALL SELECT *, 1 AS prio FROM amd) u) v
  WHERE rn = 1),
rates AS (
  SELECT DATE '2024-01-01' + CAST(3 * g AS INTEGER) AS rate_date, 'INR' AS ccy, 80 + (1 + 3 * g) / 10.0 AS rate
  FROM range(10) r(g))
"""

_BEFORE = "lag(total_spend_usd) OVER (PARTITION BY advertiser_id ORDER BY event_date)"
_PCT = f"round(round((total_spend_usd - {_BEFORE}) / nullif({_BEFORE}, 0) * 100, 2), 4)"
_TREND = f"""SELECT event_date, advertiser_id, advertiser_name, round(total_spend_usd, 4) AS total_spend_usd,
  round(avg(total_spend_usd) OVER (PARTITION BY advertiser_id ORDER BY event_date
        ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS rolling_7day_avg_spend,
  {_PCT} AS pct_change_vs_prior_day FROM gold"""

_CALENDAR_TREND = f"""SELECT event_date, advertiser_id, advertiser_name,
        round(total_spend_usd, 4) AS total_spend_usd,
        round(avg(total_spend_usd) OVER (PARTITION BY advertiser_id ORDER BY event_date
              RANGE BETWEEN INTERVAL '6' DAY PRECEDING AND CURRENT ROW), 4) AS rolling_7day_avg_spend,
        CASE WHEN event_date - lag(event_date) OVER (PARTITION BY advertiser_id ORDER BY event_date) = 1
             THEN {_PCT} END AS pct_change_vs_prior_day FROM gold"""
_CORRECTED_GOLD = """SELECT CAST(u.event_time_utc AS DATE) AS event_date, u.advertiser_id,
        coalesce(d.advertiser_name, 'UNKNOWN') AS advertiser_name, d.advertiser_id IS NULL AS is_unmapped_advertiser,
        CAST(sum(CAST(CASE currency WHEN 'INR' THEN cost_raw / 83.0 WHEN 'USD' THEN cost_raw END AS DECIMAL(28, 10))) AS DOUBLE) AS total_spend_usd,
        count(*) AS event_count
        FROM ups u LEFT JOIN dim d ON u.advertiser_id = d.advertiser_id GROUP BY 1, 2, 3, 4"""
_AMENDED_GOLD = _CORRECTED_GOLD.replace("FROM ups u", "FROM amended u")

_DOUBLED = "SELECT * FROM silver UNION ALL SELECT * FROM silver WHERE event_id % 500 = 2"
_TROUBLED = """SELECT * REPLACE (CASE WHEN event_id % 101 <> 9 THEN event_id END AS event_id,
        CASE WHEN event_id % 103 = 4 AND currency IS NOT NULL THEN 'EUR' ELSE currency END AS currency) FROM tag"""

_NULL_RATE = """SELECT 'null_rate' AS rule, 'currency' AS "column", CAST(0.05 AS DOUBLE) AS threshold,
  round(v, 6) AS actual_value, v <= 0.05 AS passed
  FROM (SELECT count(*) FILTER (WHERE currency IS NULL) / CAST(count(*) AS DOUBLE) AS v FROM allr) q"""
_UNIQUE_CURRENCY = """SELECT 'uniqueness' AS rule, 'currency' AS "column", CAST(NULL AS DOUBLE) AS threshold,
  CAST(v AS DOUBLE) AS actual_value, v = n AS passed
  FROM (SELECT (SELECT count(*) FROM (SELECT DISTINCT currency FROM allr) c) AS v, (SELECT count(*) FROM allr) AS n) q"""
_UNIQUE_ID = _UNIQUE_CURRENCY.replace("currency", "event_id")
_FRESH = """SELECT 'freshness' AS rule, 'event_time' AS "column", CAST(24 AS DOUBLE) AS threshold,
  round(v, 6) AS actual_value, v <= 24 AS passed
  FROM (SELECT date_diff('microsecond', max(event_time_utc), TIMESTAMP '2024-01-31 00:00:00') / 3600000000.0 AS v
        FROM uni) q"""


def _check(name: str, expected: str, actual: str, tolerance: float = 0.0) -> str:
    agree = f"abs(e - a) < {tolerance}" if tolerance else "e = a"
    return f"""SELECT '{name}' AS check_name, round(e, 2) AS expected, round(a, 2) AS actual, {agree} AS passed
  FROM (SELECT CAST(({expected}) AS DOUBLE) AS e, CAST(({actual}) AS DOUBLE) AS a) q"""


_CHECKS = {
    "bronze_rows": _check(
        "bronze_rows",
        "SELECT (SELECT count(*) FROM allr WHERE event_id % 2 = 0) + (SELECT count(*) FROM allr WHERE event_id % 2 = 1)",
        "SELECT count(*) FROM tagged",
    ),
    "quarantine_split": _check(
        "quarantine_split",
        "SELECT count(*) FROM uni",
        "SELECT (SELECT count(*) FROM tag WHERE reason IS NOT NULL) + (SELECT count(*) FROM good)",
    ),
    "dedup_arithmetic": _check(
        "dedup_arithmetic",
        "SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM good GROUP BY event_id) x",
        "SELECT (SELECT count(*) FROM good) - (SELECT count(*) FROM silver)",
    ),
    "na_rows_in_silver": _check("na_rows_in_silver", "0", "SELECT count(*) FROM silver WHERE event_time = 'N/A'"),
    "null_currency_in_silver": _check(
        "null_currency_in_silver", "0", "SELECT count(*) FROM silver WHERE currency IS NULL"
    ),
    "duplicate_dimension_keys": _check(
        "duplicate_dimension_keys",
        "0",
        "SELECT count(*) FROM (SELECT advertiser_id FROM dim GROUP BY 1 HAVING count(*) > 1) x",
    ),
    "unmapped_equals_orphans": _check(
        "unmapped_equals_orphans",
        "SELECT count(DISTINCT advertiser_id) FROM silver WHERE advertiser_id NOT IN (SELECT advertiser_id FROM dim)",
        "SELECT count(DISTINCT advertiser_id) FROM gold WHERE is_unmapped_advertiser",
    ),
    "undated_gold_rows": _check("undated_gold_rows", "0", "SELECT count(*) FROM gold WHERE event_date IS NULL"),
    "spend_conservation": _check(
        "spend_conservation", "SELECT sum(cost_usd) FROM silver", "SELECT sum(total_spend_usd) FROM gold", 0.01
    ),
    "event_conservation": _check(
        "event_conservation", "SELECT count(*) FROM silver", "SELECT sum(event_count) FROM gold"
    ),
}

_SELECTS = {
    "scan_events": "SELECT * FROM raw",
    "scan_dim": "SELECT c_custkey AS advertiser_id, c_name AS advertiser_name FROM customer",
    "load_events_clean": """SELECT DISTINCT event_id, event_time, ingest_time, advertiser_id, currency, cost_raw AS spend
        FROM uni u WHERE cost_raw IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM uni n WHERE n.event_id = u.event_id AND n.cost_raw < 0)""",
    "bronze_tagged": """SELECT event_id, ingest_time, schema_version, source_file,
        TIMESTAMP '2024-02-01 00:00:00' AS ingested_at FROM tagged""",
    "bronze_detect_version": """SELECT event_id, ingest_time,
        CASE WHEN media_cost IS NOT NULL OR viewability IS NOT NULL THEN 'v2' ELSE 'v1' END AS schema_version FROM allr""",
    "bronze_union": "SELECT * FROM allr",
    "bronze_rescue": """SELECT a.event_id, a.spend, a.media_cost, e.props AS rescued_props
        FROM allr a JOIN events e ON a.event_id = e.event_id""",
    "bronze_payload": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "schema_version_population": """SELECT schema_version, count(spend) AS spend_populated,
        count(media_cost) AS media_cost_populated, count(viewability) AS viewability_populated FROM tagged GROUP BY 1""",
    "rows_by_version": "SELECT schema_version, count(*) AS n FROM tagged GROUP BY 1",
    "rows_by_currency": "SELECT currency, count(*) AS n FROM tagged GROUP BY 1",
    "distinct_event_time_sample": """SELECT DISTINCT event_time, schema_version, source_file FROM tagged
        ORDER BY event_time NULLS LAST, schema_version, source_file LIMIT 10""",
    "silver_unify_cost": "SELECT event_id, spend, media_cost, cost_raw FROM uni",
    "silver_event_time_utc": "SELECT event_id, event_time, event_time_utc FROM uni",
    "offset_spot_check": "SELECT event_time, event_time_utc FROM uni WHERE contains(event_time, '+05:30')",
    "silver_quarantine": """SELECT event_id, event_time, cost_raw, currency, reason AS quarantine_reason
        FROM tag WHERE reason IS NOT NULL""",
    "silver_good": "SELECT event_id, event_time_utc, cost_raw, currency FROM good",
    "quarantine_by_reason": """SELECT reason AS quarantine_reason, count(*) AS n
        FROM tag WHERE reason IS NOT NULL GROUP BY 1""",
    "exact_dedup": "SELECT DISTINCT * FROM allr",
    "purge_negative_event_ids": """SELECT event_id, ingest_time, cost_raw FROM uni u
        WHERE NOT EXISTS (SELECT 1 FROM uni n WHERE n.event_id = u.event_id AND n.cost_raw < 0)""",
    "duplicate_keys": "SELECT event_id, count(*) AS n FROM good GROUP BY 1 HAVING count(*) > 1",
    "silver_dedup": """SELECT event_id, ingest_time, advertiser_id, currency, cost_raw, event_time_utc, schema_version
        FROM silver""",
    "silver_time_range": "SELECT min(event_time_utc) AS first_event, max(event_time_utc) AS last_event FROM silver",
    "na_rows": """SELECT count(*) FILTER (WHERE reason IS NOT NULL) AS in_quarantine,
        count(*) FILTER (WHERE reason IS NULL) AS in_silver FROM tag WHERE event_time = 'N/A'""",
    "gold_cost_usd": "SELECT event_id, currency, round(cost_usd, 4) AS cost_usd FROM silver",
    "inr_spot_check": "SELECT event_id, cost_raw, round(cost_usd, 4) AS cost_usd FROM silver WHERE currency = 'INR'",
    "gold_cost_usd_daily_rate": """SELECT event_id, currency, round(CASE currency WHEN 'USD' THEN cost_raw
        ELSE cost_raw / (SELECT max_by(rate, rate_date) FROM rates
                         WHERE ccy = s.currency AND rate_date <= CAST(s.event_time_utc AS DATE)) END, 4) AS cost_usd
        FROM silver s""",
    "gold_join_dim": "SELECT event_id, advertiser_id, advertiser_name, is_unmapped_advertiser FROM named",
    "orphan_advertisers": """SELECT DISTINCT advertiser_id FROM silver
        WHERE advertiser_id NOT IN (SELECT advertiser_id FROM dim)""",
    "dim_duplicate_keys": """SELECT count(*) AS n FROM (SELECT advertiser_id
        FROM (SELECT * FROM dim UNION ALL SELECT * FROM dim WHERE advertiser_id % 13 = 1) d GROUP BY 1 HAVING count(*) > 1) x""",
    "dim_unknown_names": "SELECT advertiser_id FROM dim WHERE advertiser_name IS NULL OR advertiser_name = 'UNKNOWN'",
    "gold_daily_spend": """SELECT event_date, advertiser_id, advertiser_name, is_unmapped_advertiser,
        round(total_spend_usd, 4) AS total_spend_usd, event_count FROM gold""",
    "unmapped_gold_rows": "SELECT count(*) AS n FROM gold WHERE is_unmapped_advertiser",
    "rolling_spend": f"{_TREND} ORDER BY advertiser_id, event_date",
    "rolling_spend_calendar": _CALENDAR_TREND,
    "rolling_spend_one_advertiser": f"""SELECT * FROM ({_TREND}) x WHERE advertiser_id = 7
        ORDER BY event_date LIMIT 10""",
    "active_days": "SELECT DISTINCT advertiser_id, event_date FROM gold WHERE event_count >= 1",
    "streaks": "SELECT * FROM runs",
    "longest_streak": """SELECT advertiser_id, longest_streak_days, streak_start, streak_end FROM (
        SELECT advertiser_id, streak_length AS longest_streak_days, streak_start, streak_end,
               row_number() OVER (PARTITION BY advertiser_id ORDER BY streak_length DESC, streak_start) AS rn
        FROM runs) x WHERE rn = 1 ORDER BY advertiser_id""",
    "silver_upsert": "SELECT event_id, ingest_time, advertiser_id, currency, cost_raw, event_time_utc FROM ups",
    "touched_days": """SELECT CAST(t.event_time_utc AS DATE) AS event_date
        FROM tgt t JOIN cor c ON t.event_id = c.event_id AND c.ingest_time > t.ingest_time
        UNION SELECT CAST(c.event_time_utc AS DATE)
        FROM cor c LEFT JOIN tgt t ON t.event_id = c.event_id
        WHERE t.event_id IS NULL OR c.ingest_time > t.ingest_time""",
    "gold_incremental": f"SELECT * REPLACE (round(total_spend_usd, 4) AS total_spend_usd) FROM ({_CORRECTED_GOLD}) g",
    "gold_delta": f"SELECT * REPLACE (round(total_spend_usd, 4) AS total_spend_usd) FROM ({_AMENDED_GOLD}) g",
    "rolling_spend_incremental": _TREND.replace("FROM gold", f"FROM ({_AMENDED_GOLD}) g"),
    "rolling_spend_calendar_incremental": _CALENDAR_TREND.replace("FROM gold", f"FROM ({_AMENDED_GOLD}) g"),
    "streaks_incremental": f"""SELECT advertiser_id, count(*) AS streak_length, min(event_date) AS streak_start, max(event_date) AS streak_end
        FROM (SELECT advertiser_id, event_date,
                     event_date - CAST(row_number() OVER (PARTITION BY advertiser_id ORDER BY event_date) AS INTEGER) AS m
              FROM ({_AMENDED_GOLD}) g WHERE event_count >= 1) i
        GROUP BY advertiser_id, m""",
    "changed_event_keys": """SELECT coalesce(t.event_id, u.event_id) AS event_id, CAST(t.event_id IS NOT NULL AS BIGINT) AS left_rows,
        CAST(u.event_id IS NOT NULL AS BIGINT) AS right_rows, CASE WHEN t.event_id IS NULL THEN 'extra' ELSE 'changed' END AS status
        FROM tgt t FULL JOIN amended u ON t.event_id = u.event_id
        WHERE (t.ingest_time, t.advertiser_id, t.currency, t.cost_raw, t.event_time_utc)
              IS DISTINCT FROM (u.ingest_time, u.advertiser_id, u.currency, u.cost_raw, u.event_time_utc)""",
    "dedup_difference_keys": """SELECT event_id, count(*) AS left_rows, CAST(1 AS BIGINT) AS right_rows, 'copies' AS status
        FROM good GROUP BY event_id HAVING count(*) > 1""",
    "bronze_payload_fields": """SELECT 'event_type' AS field, 'STRING' AS type, count(*) AS n
        FROM allr a JOIN events e ON a.event_id = e.event_id WHERE e.event_type IS NOT NULL
        UNION ALL SELECT 'props', 'STRING', count(*) FROM allr a JOIN events e ON a.event_id = e.event_id WHERE e.props IS NOT NULL
        UNION ALL SELECT 'props.' || k, CASE json_type(e.props, '$.' || k) WHEN 'UBIGINT' THEN 'BIGINT' ELSE json_type(e.props, '$.' || k) END, count(*)
        FROM allr a JOIN events e ON a.event_id = e.event_id, unnest(json_keys(e.props)) AS t(k) GROUP BY 1, 2""",
    "dq_uniqueness_by_sketch": """SELECT 'event_id' AS "column", count(*) AS rows, count(*) = count(DISTINCT event_id) AS passed,
        'exact' AS decided_by FROM allr
        UNION ALL SELECT 'currency', count(*), count(*) = count(DISTINCT coalesce(currency, '-')), 'sketch' FROM allr""",
    "troubled_quarantine": f"""SELECT coalesce(reason, 'missing_event_id') AS quarantine_reason, count(*) AS n FROM ({_TROUBLED}) t
        WHERE reason IS NOT NULL OR event_id IS NULL GROUP BY 1""",
    "troubled_gold": f"""SELECT CAST(event_time_utc AS DATE) AS event_date, s.advertiser_id, coalesce(d.advertiser_name, 'UNKNOWN') AS advertiser_name,
        d.advertiser_id IS NULL AS is_unmapped_advertiser,
        round(CAST(sum(CAST(CASE currency WHEN 'INR' THEN cost_raw / 83.0 WHEN 'USD' THEN cost_raw END AS DECIMAL(28, 10))) AS DOUBLE), 4) AS total_spend_usd,
        count(*) AS event_count
        FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingest_time DESC, coalesce(cost_raw, -1) DESC) AS rn
              FROM ({_TROUBLED}) t WHERE reason IS NULL AND event_id IS NOT NULL) s
        LEFT JOIN dim d ON s.advertiser_id = d.advertiser_id WHERE rn = 1 GROUP BY 1, 2, 3, 4""",
    "damaged_reconciliation": " UNION ALL ".join(_CHECKS.values()).replace("FROM tagged", "FROM tagged WHERE event_id % 200 <> 3")
    .replace("SELECT count(*) FROM uni", "SELECT count(*) FROM tagged WHERE event_id % 200 <> 3")
    .replace("FROM silver", f"FROM ({_DOUBLED}) silver").replace("FROM gold", "FROM (SELECT * FROM gold WHERE advertiser_id % 20 <> 9) gold"),
    "dq_null_rate": _NULL_RATE,
    "dq_uniqueness": _UNIQUE_CURRENCY,
    "dq_freshness": _FRESH,
    "dq_report": " UNION ALL ".join([_NULL_RATE, _UNIQUE_ID, _UNIQUE_CURRENCY, _FRESH]),
    "check_bronze_rows": _CHECKS["bronze_rows"],
    "check_quarantine_split": _CHECKS["quarantine_split"],
    "check_dedup_arithmetic": _CHECKS["dedup_arithmetic"],
    "check_null_currency": f"{_CHECKS['null_currency_in_silver']} UNION ALL {_CHECKS['na_rows_in_silver']}",
    "check_spend_conservation": _CHECKS["spend_conservation"],
    "check_event_conservation": _CHECKS["event_conservation"],
    "check_unmapped_equals_orphans": _CHECKS["unmapped_equals_orphans"],
    "reconciliation_report": " UNION ALL ".join(_CHECKS.values()),
}

ORACLE = {name: f"{_PRELUDE.strip()}\n{select}" for name, select in _SELECTS.items()}
