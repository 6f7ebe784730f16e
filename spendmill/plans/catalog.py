"""Every query by name. A query is a function of (spark, folder of tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators import (
    active_days,
    beating,
    changed_activity,
    daily_spend,
    days_of_change,
    dedup_latest,
    detect_version,
    dq_report,
    duplicate_keys,
    exact_dedup,
    first_days,
    held_rows,
    join_dimension,
    keep_payload,
    label_quarantine,
    layer_differences,
    longest_streak,
    merge_state,
    normalise,
    orphans,
    parse_event_time,
    payload_fields,
    purge_keys,
    refresh_days,
    refresh_rolling,
    refresh_streaks,
    replaced_rows,
    replace_rows,
    rescue_unknown,
    rolling_spend,
    spend_of_state,
    spend_state,
    split,
    state_changes,
    streaks,
    to_usd,
    to_usd_daily,
    touched_days,
    unify_columns,
    uniqueness,
    union_versions,
    unknown_names,
    upsert_latest,
    value_sketches,
    with_offset,
)
from ..sources.interim import settle
from ..sources.readers import clean_events
from ..sources.schemas import EVENTS_V1, EVENTS_V2
from ..sources.vendor import EVENTS, given_events, inr_rates, vendor_feeds
from .layers import Layers, build_silver

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NOW = "2024-01-31T00:00:00Z"


def query(build: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
    """Register ``build`` under its name (less the ``_query`` that sets it apart from an operator)."""
    QUERIES[build.__name__.removesuffix("_query")] = lambda spark, sf_dir: build(Layers(spark, sf_dir))
    return build


def rounded(name: str, digits: int = 4) -> Column:
    """Sums of doubles differ in their last bits between runs; compare what is meant."""
    return F.round(name, digits).alias(name)


def utc(name: str) -> Column:
    """An instant as the UTC wall-clock time."""
    return F.col(name).cast("timestamp_ntz").alias(name)


def gold_columns(gold: DataFrame) -> DataFrame:
    return gold.withColumns({"total_spend_usd": F.round("total_spend_usd", 4)})


# -- scans ------------------------------------------------------------------------------------


@query
def scan_events(x: Layers) -> DataFrame:
    return x.first_delivery


@query
def scan_dim(x: Layers) -> DataFrame:
    return x.all_advertisers


@query
def load_events_clean(x: Layers) -> DataFrame:
    rows = unify_columns(x.sent, {"spend": ("spend", "media_cost")}).drop("media_cost", "viewability")
    return clean_events(rows)


# -- raw layer --------------------------------------------------------------------------------


@query
def bronze_tagged(x: Layers) -> DataFrame:
    return x.bronze.select("event_id", "ingest_time", "schema_version", "source_file", utc("ingested_at"))


@query
def bronze_detect_version(x: Layers) -> DataFrame:
    return detect_version(x.sent).select("event_id", "ingest_time", "schema_version")


@query
def bronze_union(x: Layers) -> DataFrame:
    return x.sent


@query
def bronze_rescue(x: Layers) -> DataFrame:
    v1, v2 = vendor_feeds(x.spark, x.sf_dir, extra=("props",))
    both = union_versions(rescue_unknown(v1, EVENTS_V1.names), rescue_unknown(v2, EVENTS_V2.names))
    props = F.get_json_object("_rescued_data", "$.props").alias("rescued_props")
    return both.select("event_id", "spend", "media_cost", props)


@query
def bronze_payload(x: Layers) -> DataFrame:
    events = keep_payload(given_events(x.spark, x.sf_dir))
    return events.select(F.from_json("_payload", EVENTS).alias("row")).select("row.*")


@query
def schema_version_population(x: Layers) -> DataFrame:
    return C.version_population(x.bronze)


@query
def rows_by_version(x: Layers) -> DataFrame:
    return C.rows_by(x.bronze, "schema_version")


@query
def rows_by_currency(x: Layers) -> DataFrame:
    return C.rows_by(x.bronze, "currency")


@query
def distinct_event_time_sample(x: Layers) -> DataFrame:
    return C.distinct_sample(x.bronze, ["event_time", "schema_version", "source_file"])


# -- clean layer ------------------------------------------------------------------------------


@query
def silver_unify_cost(x: Layers) -> DataFrame:
    return unify_columns(x.sent).select("event_id", "spend", "media_cost", "cost_raw")


@query
def silver_event_time_utc(x: Layers) -> DataFrame:
    return parse_event_time(x.sent).select("event_id", "event_time", utc("event_time_utc"))


@query
def offset_spot_check(x: Layers) -> DataFrame:
    return with_offset(parse_event_time(x.sent)).select("event_time", utc("event_time_utc"))


@query
def silver_quarantine(x: Layers) -> DataFrame:
    return x.quarantine.select("event_id", "event_time", "cost_raw", "currency", "quarantine_reason")


@query
def silver_good(x: Layers) -> DataFrame:
    return x.good.select("event_id", utc("event_time_utc"), "cost_raw", "currency")


@query
def quarantine_by_reason(x: Layers) -> DataFrame:
    return C.rows_by(x.quarantine, "quarantine_reason")


@query
def exact_dedup_query(x: Layers) -> DataFrame:
    return exact_dedup(x.sent)


@query
def purge_negative_event_ids(x: Layers) -> DataFrame:
    rows = unify_columns(x.sent).select("event_id", "ingest_time", "cost_raw")
    return purge_keys(rows, "event_id", "cost_raw < 0")


@query
def duplicate_keys_query(x: Layers) -> DataFrame:
    return duplicate_keys(x.good, "event_id")


@query
def silver_dedup(x: Layers) -> DataFrame:
    return x.silver.select(
        "event_id", "ingest_time", "advertiser_id", "currency", "cost_raw", utc("event_time_utc"), "schema_version"
    )


@query
def silver_time_range(x: Layers) -> DataFrame:
    return C.time_range(x.spend_events).select(utc("first_event"), utc("last_event"))


@query
def na_rows(x: Layers) -> DataFrame:
    reason = F.col("quarantine_reason")
    return x.labelled.where(F.col("event_time") == "N/A").agg(
        F.count_if(reason.isNotNull()).alias("in_quarantine"), F.count_if(reason.isNull()).alias("in_silver")
    )


# -- daily layer ------------------------------------------------------------------------------


@query
def gold_cost_usd(x: Layers) -> DataFrame:
    return x.spend_events.select("event_id", "currency", rounded("cost_usd"))


@query
def inr_spot_check(x: Layers) -> DataFrame:
    return x.spend_events.where(F.col("currency") == "INR").select("event_id", "cost_raw", rounded("cost_usd"))


@query
def gold_cost_usd_daily_rate(x: Layers) -> DataFrame:
    return to_usd_daily(x.spend_events.drop("cost_usd"), inr_rates(x.spark)).select("event_id", "currency", rounded("cost_usd"))


@query
def gold_join_dim(x: Layers) -> DataFrame:
    return join_dimension(x.spend_events, x.dim).select(
        "event_id", "advertiser_id", "advertiser_name", "is_unmapped_advertiser"
    )


@query
def orphan_advertisers(x: Layers) -> DataFrame:
    return orphans(x.spend_events, x.dim)


@query
def dim_duplicate_keys(x: Layers) -> DataFrame:
    return duplicate_keys(x.dim_deliveries, "advertiser_id").agg(F.count(F.lit(1)).alias("n"))


@query
def dim_unknown_names(x: Layers) -> DataFrame:
    return unknown_names(x.dim)


@query
def gold_daily_spend(x: Layers) -> DataFrame:
    return gold_columns(x.gold)


@query
def unmapped_gold_rows(x: Layers) -> DataFrame:
    return x.gold.agg(F.count_if("is_unmapped_advertiser").alias("n"))


# -- questions over the daily layer -----------------------------------------------------------


def _trend_columns(trend: DataFrame) -> DataFrame:
    return trend.withColumns(
        {c: F.round(c, 4) for c in ("total_spend_usd", "rolling_7day_avg_spend", "pct_change_vs_prior_day")}
    )


@query
def rolling_spend_query(x: Layers) -> DataFrame:
    return _trend_columns(rolling_spend(x.gold)).orderBy("advertiser_id", "event_date")


@query
def rolling_spend_calendar(x: Layers) -> DataFrame:
    return _trend_columns(rolling_spend(x.gold, calendar=True))


@query
def rolling_spend_one_advertiser(x: Layers) -> DataFrame:
    return _trend_columns(first_days(rolling_spend(x.gold), 7))


@query
def active_days_query(x: Layers) -> DataFrame:
    return active_days(x.gold)


@query
def streaks_query(x: Layers) -> DataFrame:
    return streaks(x.gold)


@query
def longest_streak_query(x: Layers) -> DataFrame:
    return longest_streak(x.gold).orderBy("advertiser_id")


# -- late corrections -------------------------------------------------------------------------


@query
def silver_upsert(x: Layers) -> DataFrame:
    return upsert_latest(x.before_corrections, x.corrections).select(
        "event_id", "ingest_time", "advertiser_id", "currency", "cost_raw", utc("event_time_utc")
    )


@query
def touched_days_query(x: Layers) -> DataFrame:
    return touched_days(x.before_corrections, x.corrections)


@query
def gold_incremental(x: Layers) -> DataFrame:
    old = x.before_corrections
    incoming = settle(dedup_latest(x.corrections, tie_breakers=x.config.tie_breakers))
    held = settle(held_rows(old, incoming))
    won = beating(incoming, held)
    gold = daily_spend(to_usd(old), x.dim)
    corrected = to_usd(replace_rows(old, won))
    return gold_columns(refresh_days(gold, corrected, x.dim, days_of_change(held, won)))


class Amended:
    """Stored sums per day and advertiser before and after the amendments, and the signed changes between them."""

    def __init__(self, x: Layers):
        old = x.before_corrections
        incoming = settle(dedup_latest(x.amendments, tie_breakers=x.config.tie_breakers))
        won = settle(to_usd(beating(incoming, held_rows(old, incoming))))
        self.changes = settle(state_changes(to_usd(replaced_rows(old, won)), won))
        self.before = settle(spend_state(to_usd(old)))
        self.after = merge_state(self.before, self.changes)


@query
def gold_delta(x: Layers) -> DataFrame:
    return gold_columns(spend_of_state(Amended(x).after, x.dim))


@query
def rolling_spend_incremental(x: Layers) -> DataFrame:
    c = Amended(x)
    trend = settle(rolling_spend(spend_of_state(c.before, x.dim)))
    return _trend_columns(refresh_rolling(trend, settle(spend_of_state(c.after, x.dim)), c.changes))


@query
def rolling_spend_calendar_incremental(x: Layers) -> DataFrame:
    c = Amended(x)
    trend = settle(rolling_spend(spend_of_state(c.before, x.dim), calendar=True))
    return _trend_columns(refresh_rolling(trend, settle(spend_of_state(c.after, x.dim)), c.changes, calendar=True))


@query
def streaks_incremental(x: Layers) -> DataFrame:
    c = Amended(x)
    appeared, vanished = changed_activity(c.before, settle(c.after), c.changes)
    return refresh_streaks(settle(streaks(c.before)), settle(appeared), settle(vanished))


# -- where layers differ ----------------------------------------------------------------------

COMPARED = ("event_id", "ingest_time", "advertiser_id", "currency", "cost_raw", "event_time_utc")


@query
def changed_event_keys(x: Layers) -> DataFrame:
    """Which events a late batch changed, found by comparing the layer before and after it."""
    after = settle(upsert_latest(x.before_corrections, x.amendments).select(*COMPARED))
    return layer_differences(x.before_corrections.select(*COMPARED), after, COMPARED)


@query
def dedup_difference_keys(x: Layers) -> DataFrame:
    """The keys behind the difference that ``check_dedup_arithmetic`` only counts."""
    good = settle(x.good.select(*COMPARED))
    return layer_differences(good, settle(build_silver(good, x.config)), COMPARED)


# -- data quality -----------------------------------------------------------------------------


def _report(x: Layers, *rules: dict) -> DataFrame:
    report = dq_report(x.bronze, list(rules), NOW)
    return report.select("rule", "column", "threshold", rounded("actual_value", 6), "passed")


# The keys of a rule; columns and limits suit the given tables.
NULL_RATE = {"type": "null_rate", "column": "currency", "max_rate": 0.05}
UNIQUE_ID = {"type": "uniqueness", "column": "event_id"}
UNIQUE_CURRENCY = {"type": "uniqueness", "column": "currency"}
FRESH = {"type": "freshness", "column": "event_time", "max_age_hours": 24}


@query
def dq_null_rate(x: Layers) -> DataFrame:
    return _report(x, NULL_RATE)


@query
def dq_uniqueness(x: Layers) -> DataFrame:
    return _report(x, UNIQUE_CURRENCY)


@query
def dq_freshness(x: Layers) -> DataFrame:
    return _report(x, FRESH)


@query
def dq_report_query(x: Layers) -> DataFrame:
    return _report(x, NULL_RATE, UNIQUE_ID, UNIQUE_CURRENCY, FRESH)


def _check(measures: list[DataFrame], *names: str) -> DataFrame:
    return C.compare(measures, C.pick(*names)).select(
        "check_name", rounded("expected", 2), rounded("actual", 2), "passed"
    )


@query
def check_bronze_rows(x: Layers) -> DataFrame:
    return _check([C.source_measures(x.feeds), C.rows_of("bronze_rows", x.bronze)], "bronze_rows")


@query
def check_quarantine_split(x: Layers) -> DataFrame:
    parts = [C.rows_of("bronze_rows", x.bronze), C.quarantine_measures(x.quarantine), C.rows_of("good_rows", x.good)]
    return _check(parts, "quarantine_split")


@query
def check_dedup_arithmetic(x: Layers) -> DataFrame:
    return _check([C.good_measures(x.good), C.rows_of("silver_rows", x.silver)], "dedup_arithmetic")


@query
def check_null_currency(x: Layers) -> DataFrame:
    return _check([C.silver_measures(x.silver_usd)], "null_currency_in_silver", "na_rows_in_silver")


@query
def check_spend_conservation(x: Layers) -> DataFrame:
    return _check([C.spend_measures(x.spend_events), C.gold_measures(x.gold)], "spend_conservation")


@query
def check_event_conservation(x: Layers) -> DataFrame:
    return _check([C.spend_measures(x.spend_events), C.gold_measures(x.gold)], "event_conservation")


@query
def check_unmapped_equals_orphans(x: Layers) -> DataFrame:
    parts = [C.gold_measures(x.gold), C.rows_of("orphan_advertisers", orphans(x.spend_events, x.dim))]
    return _check(parts, "unmapped_equals_orphans")


@query
def reconciliation_report(x: Layers) -> DataFrame:
    read_by_checks = (x.config.key, x.config.order, *x.config.tie_breakers, "event_time", "quarantine_reason")
    good, rejected = split(settle(x.labelled.select(*read_by_checks)))
    silver = settle(to_usd(build_silver(good, x.config)))
    report = C.reconcile(x.feeds, x.bronze, rejected, good, silver, daily_spend(silver, x.dim), x.dim)
    return report.select("check_name", rounded("expected", 2), rounded("actual", 2), "passed")


# -- what the given tables are too clean to show ----------------------------------------------


@query
def bronze_payload_fields(x: Layers) -> DataFrame:
    """Fields that no schema declares, in the payload as sent and in the JSON text it carries along."""
    sent = union_versions(*vendor_feeds(x.spark, x.sf_dir, extra=("event_type", "props")))
    top = payload_fields(keep_payload(sent), known={*EVENTS_V1.names, *EVENTS_V2.names})
    return top.unionByName(payload_fields(sent, "props", prefix="props."))


@query
def dq_uniqueness_by_sketch(x: Layers) -> DataFrame:
    columns = ["event_id", "currency"]
    sketches = settle(value_sketches(x.bronze, columns, F.to_date("ingest_time")))
    return uniqueness(x.bronze, sketches, columns)


@query
def troubled_quarantine(x: Layers) -> DataFrame:
    """All five reasons: the feed also has rows without a key."""
    labelled = label_quarantine(normalise(x.troubled, x.config.cost_aliases, x.config.strict_offset))
    return C.rows_by(split(labelled)[1], "quarantine_reason")


@query
def troubled_gold(x: Layers) -> DataFrame:
    """Daily spend with a currency that has no rate: its events count, their amounts do not."""
    good = split(label_quarantine(normalise(x.troubled, x.config.cost_aliases, x.config.strict_offset)))[0]
    c = x.config
    events = to_usd(build_silver(good.select(c.key, c.order, *c.tie_breakers), c), c.usd_rates)
    return gold_columns(daily_spend(events, x.dim))


@query
def damaged_reconciliation(x: Layers) -> DataFrame:
    """The checks over layers that lost raw rows, hold clean rows twice and lack daily rows: most must fail."""
    read_by_checks = (x.config.key, x.config.order, *x.config.tie_breakers, "event_time", "quarantine_reason")
    good, rejected = split(settle(x.labelled.select(*read_by_checks)))
    silver = settle(to_usd(build_silver(good, x.config)))
    gold = daily_spend(silver, x.dim).where("advertiser_id % 20 <> 9")
    doubled = silver.unionByName(silver.where("event_id % 500 = 2"))
    report = C.reconcile(x.feeds, x.bronze.where("event_id % 200 <> 3"), rejected, good, doubled, gold, x.dim)
    return report.select("check_name", rounded("expected", 2), rounded("actual", 2), "passed")
