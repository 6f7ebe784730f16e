"""Changes alone keep sums, frames and streaks equal to a rebuild; fingerprints name the keys that differ.

Every advertiser is a case of its own: hundreds of random histories are compared in one run.
"""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from spendmill import (
    changed_activity,
    daily_spend,
    differing_nodes,
    fingerprints,
    layer_differences,
    merge_state,
    refresh_rolling,
    refresh_streaks,
    replace_rows,
    replaced_rows,
    rolling_spend,
    spend_of_state,
    spend_state,
    stale_frames,
    state_changes,
    streaks,
)

EVENTS = "event_id string, event_time_utc timestamp, advertiser_id long, cost_usd double"
FIRST = dt.datetime(2024, 1, 1, 9)
ordered = lambda frame: sorted(map(repr, frame.collect()))


@pytest.fixture(scope="module")
def cases(spark):
    """(events before, winners, dim): new, changed, moved and unconverted events, days that come, go and stay."""
    rng, before, winners = random.Random(4), [], []
    when = lambda: FIRST + dt.timedelta(days=rng.randrange(24), minutes=rng.randrange(600))
    cost = lambda: None if rng.random() < 0.1 else round(rng.random() * 100, 3)
    for a in range(300):
        who = None if a == 7 else a
        mine = [(f"{a}-{i}", when(), who, cost()) for i in range(rng.randrange(1, 30))]
        before += mine
        if a % 3:
            changed = rng.sample(mine, min(len(mine), rng.randrange(4)))
            winners += [(i, when() if rng.random() < 0.6 else t, w if rng.random() < 0.8 else 299, cost()) for i, t, w, _ in changed]
            winners += [(f"{a}-new{i}", when(), who, cost()) for i in range(rng.randrange(3))]
    dim = spark.createDataFrame([(a, None if a % 5 == 0 else f"name {a}") for a in range(0, 300, 2)], "advertiser_id long, advertiser_name string")
    return spark.createDataFrame(before, EVENTS), spark.createDataFrame(winners, EVENTS), dim


@pytest.fixture(scope="module")
def states(cases):
    before, winners, _ = cases
    state = spend_state(before).cache()
    changes = state_changes(replaced_rows(before, winners), winners).cache()
    return state, changes, merge_state(state, changes).cache()


def test_merged_sums_equal_a_rebuild(cases, states):
    before, winners, dim = cases
    assert ordered(spend_of_state(states[2], dim)) == ordered(daily_spend(replace_rows(before, winners), dim))
    assert ordered(spend_of_state(states[0], dim)) == ordered(daily_spend(before, dim))
    assert ordered(merge_state(states[0], states[1].limit(0))) == ordered(states[0])


@pytest.mark.parametrize("days,calendar", [(7, False), (7, True), (1, False), (3, True)])
def test_refreshed_frames_equal_a_rebuild(cases, states, days, calendar):
    dim = cases[2]
    old, new = (spend_of_state(s, dim) for s in (states[0], states[2]))
    found = refresh_rolling(rolling_spend(old, days, calendar), new, states[1], days, calendar)
    assert ordered(found) == ordered(rolling_spend(new, days, calendar))


def test_only_affected_advertisers_are_looked_at(cases, states):
    new = spend_of_state(states[2], cases[2])
    looked_at = stale_frames(new, states[1])
    touched = {r.advertiser_id for r in states[1].select("advertiser_id").distinct().collect()}
    assert {r.advertiser_id for r in looked_at.select("advertiser_id").distinct().collect()} <= touched
    one = stale_frames(new.where("advertiser_id = 4"), states[1].limit(0).union(states[0].where("advertiser_id = 4").orderBy("event_date").limit(1)))
    rows = new.where("advertiser_id = 4").count()
    assert one.where("_stale").count() == min(7, rows) and one.count() <= min(13, rows)


def test_refreshed_streaks_equal_a_rebuild(states):
    appeared, vanished = changed_activity(states[0], states[2], states[1])
    assert not appeared.isEmpty() and not vanished.isEmpty()
    assert ordered(refresh_streaks(streaks(states[0]), appeared, vanished)) == ordered(streaks(states[2]))


def test_streaks_are_cut_and_joined(spark):
    day = lambda n: dt.date(2024, 1, n)
    stored = spark.createDataFrame([(1, 3, day(1), day(3)), (1, 5, day(6), day(10)), (1, 1, day(20), day(20))], "advertiser_id long, streak_length long, streak_start date, streak_end date")
    days = lambda *n: spark.createDataFrame([(1, day(i)) for i in n], "advertiser_id long, event_date date")
    found = refresh_streaks(stored, days(4, 5, 21, 30), days(2, 10))
    assert sorted((r.streak_start.day, r.streak_end.day, r.streak_length) for r in found.collect()) == [(1, 1, 1), (3, 9, 7), (20, 21, 2), (30, 30, 1)]


COMPARED = ("event_id", "event_time_utc", "advertiser_id", "cost_usd")


def test_differing_keys_are_named(spark, cases):
    left = cases[0].limit(2000)
    doubled = left.where("event_id = '5-0'")
    changed = left.where("event_id = '11-0'").withColumn("cost_usd", F.when(F.col("cost_usd").isNull(), 0.0))
    moved = left.where("event_id = '12-0'").withColumn("event_time_utc", F.expr("event_time_utc + INTERVAL 1 MICROSECOND + INTERVAL 3 DAY"))
    right = left.where("event_id NOT IN ('9-0', '11-0', '12-0')").unionByName(doubled).unionByName(changed).unionByName(moved)
    right = right.unionByName(spark.createDataFrame([(None, FIRST, 1, 1.0), ("new", None, None, None)], EVENTS))
    found = {r.event_id: (r.left_rows, r.right_rows, r.status) for r in layer_differences(left, right, COMPARED).collect()}
    assert found == {"5-0": (1, 2, "copies"), "9-0": (1, 0, "missing"), "11-0": (1, 1, "changed"), "12-0": (1, 1, "changed"), None: (0, 1, "extra"), "new": (0, 1, "extra")}
    assert layer_differences(left, left.repartition(3), COMPARED).isEmpty()
    assert layer_differences(left.limit(0), left.limit(0), COMPARED).isEmpty()


def test_fingerprints_tell_null_from_position_and_find_few_nodes(spark, cases):
    rows = lambda *v: spark.createDataFrame([("k", FIRST, *v)], "event_id string, event_time_utc timestamp, a string, b string")
    for one, other in ((("x", None), (None, "x")), (("", None), (None, "")), ((None, None), ("", ""))):
        assert layer_differences(rows(*one), rows(*other), ["a", "b"]).count() == 1
    before = fingerprints(cases[0], COMPARED)
    after = fingerprints(cases[0].where("event_id <> '5-0'"), COMPARED)
    assert differing_nodes(before, after).count() == 1
