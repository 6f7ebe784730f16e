from __future__ import annotations

import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spendmill import dedup_latest, merge_statement, touched_days, upsert_latest, winning_rows
from spendmill.operators.upsert import TIES

SCHEMA = "event_id string, ingest_time timestamp, cost_raw double, currency string, advertiser_id string, event_time_utc timestamp"
T0 = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    full = [(k, None if h is None else T0 + dt.timedelta(hours=h), c, "USD", "a", T0 + dt.timedelta(days=d)) for k, h, c, d in rows]
    return spark.createDataFrame(full, SCHEMA)


def content(df):
    return sorted(map(repr, df.select("event_id", "ingest_time", "cost_raw", "event_time_utc").collect()))


def newest(rows, held=()):
    """Brute force: per key the greatest (ingest, cost, day); a held row also wins ties of ingest."""
    best = {}
    for k, h, c, d in held:
        best[k] = (h, c, d)
    incoming = {}
    low = lambda v: (v is not None, v if v is not None else 0)
    for k, h, c, d in rows:
        if k not in incoming or (low(h), c, d) > (low(incoming[k][0]), *incoming[k][1:]):
            incoming[k] = (h, c, d)
    for k, row in incoming.items():
        if k not in best or low(row[0]) > low(best[k][0]):
            best[k] = row
    return [(k, *row) for k, row in best.items()]


ROW = st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(0, 3)), st.sampled_from([1.0, 2.0]), st.integers(0, 2))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=st.lists(ROW, max_size=6), batches=st.lists(st.lists(ROW, min_size=1, max_size=6), min_size=1, max_size=2))
def test_upsert_against_brute_force(spark, first, batches):
    held = newest(first)
    target = frame(spark, held)
    for rows in batches:
        source = frame(spark, rows)
        after = newest(rows, held)
        changed = set(held) ^ set(after)
        want_days = {(T0 + dt.timedelta(days=r[3])).date() for r in changed}
        # A winner equal to the row it replaces in day and cost differs at least in ingest time.
        assert {r.event_date for r in touched_days(target, source).collect()} == want_days
        result = upsert_latest(target, source)
        assert content(result) == content(frame(spark, after))
        assert content(upsert_latest(result, source)) == content(result)
        held, target = after, frame(spark, after)


def test_batches_commute(spark):
    rng = random.Random(3)
    rows = lambda n: [(str(rng.randrange(20)), rng.randrange(10**6), 1.0, rng.randrange(5)) for _ in range(n)]
    base, one, two = frame(spark, newest(rows(20))), frame(spark, rows(15)), frame(spark, rows(15))
    assert content(upsert_latest(upsert_latest(base, one), two)) == content(upsert_latest(upsert_latest(base, two), one))


def test_new_columns_of_a_batch_appear(spark):
    base = frame(spark, [("a", 1, 1.0, 0)])
    source = frame(spark, [("b", 1, 1.0, 0)]).selectExpr("*", "3 AS clicks")
    assert {r.event_id: r.clicks for r in upsert_latest(base, source).collect()} == {"a": None, "b": 3}


def test_small_source_leaves_the_target_unshuffled(spark, tmp_path):
    big, small = str(tmp_path / "big"), str(tmp_path / "small")
    frame(spark, [(str(i), 1, 1.0, 0) for i in range(500)]).write.parquet(big)
    frame(spark, [("1", 2, 1.0, 0)]).write.parquet(small)
    result = upsert_latest(spark.read.parquet(big), spark.read.parquet(small))
    assert result.count() == 500
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    # The only hash exchange is the one that reduces the source to one row per key.
    for line in plan.splitlines():
        if "hashpartitioning" in line:
            assert "event_id" in line


def test_large_source_works_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(str(i), 1, 1.0, 0) for i in range(200)]
        fixes = [(str(i), i % 3, 2.0, 1) for i in range(100, 300)]
        assert content(upsert_latest(frame(spark, rows), frame(spark, fixes))) == content(frame(spark, newest(fixes, rows)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_winners_are_unique_and_strictly_newer(spark):
    target = frame(spark, [("a", 2, 1.0, 0), ("n", None, 1.0, 0)])
    source = frame(spark, [("a", 2, 9.0, 0), ("a", 1, 9.0, 0), ("n", 0, 5.0, 0), ("b", None, 3.0, 0), ("b", None, 4.0, 0)])
    assert sorted((r.event_id, r.cost_raw) for r in winning_rows(target, source).collect()) == [("b", 4.0), ("n", 5.0)]


def test_merge_statement_parses_and_reduces_the_source(spark):
    columns = ["event_id", "ingest_time", "cost_raw", "currency", "advertiser_id", "event_time_utc"]
    sql = merge_statement("silver.events", "corrections", columns)
    spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    rows = [("a", 1, 1.0, 0), ("a", 3, 2.0, 1), ("b", 1, 5.0, 0)]
    frame(spark, rows).createOrReplaceTempView("corrections")
    using = sql[sql.index("USING (") + len("USING (") : sql.index(") AS s\n")]
    got = spark.sql(using).select("event_id", "cost_raw").collect()
    assert sorted((r.event_id, r.cost_raw) for r in got) == [("a", 2.0), ("b", 5.0)]
    assert content(spark.sql(using)) == content(dedup_latest(frame(spark, rows), tie_breakers=TIES))
    spark.catalog.dropTempView("corrections")
