"""The mix: targets by plain water filling, draws near their rates, nulls, repeated rows and empty tables."""

from __future__ import annotations

import collections
import math
import re

import pytest

from spendmill.llm.mixing import mix, mixed, ranked_sources, repetitions, targets

SCHEMA = "doc_id long, text string, source string, rate double, key string, size string, rank int, _n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 0.5, "x", "y", 1, 1) for i, t, s in rows], SCHEMA).repartition(3)


def plain_targets(sizes: dict, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    held: set = set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in held)
        free = sum(weight[s] for s in names if s not in held)
        now = {s: most * sizes[s] if s in held else weight[s] * left / free for s in names}
        over = {s for s in names if s not in held and now[s] >= most * sizes[s]}
        if not over or len(over | held) == len(names):
            return now
        held |= over


@pytest.mark.parametrize(
    "sizes",
    [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 10, "c": 10, None: 5}, {"z": 7, "é": 3, "Z": 900, "\U0001f600": 1, "￿": 2}, {"a": 0, "b": 50}, {"one": 12}],
)
def test_targets_are_those_of_plain_water_filling(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r for r in targets(frame).collect()}
    assert {s: r["target"] for s, r in found.items()} == pytest.approx(plain_targets(sizes))
    assert all(r["target"] <= 3 * r["source_size"] and 0 <= r["rate"] <= 3 for r in found.values())
    assert sum(r["target"] for r in found.values()) == pytest.approx(sum(sizes.values()))


def test_many_sources_are_ranked_by_code_point(spark):
    names = [f"s{i % 977:03d}x{i}" for i in range(5000)] + [None]
    found = ranked_sources(spark.createDataFrame([(n,) for n in names], "source string").repartition(5)).collect()
    want = {s: n for n, s in enumerate(sorted(names, key=lambda s: (s is None, (s or "").encode())))}
    assert {r["source"]: r["rank"] for r in found} == want


def test_mix_of_edges(edges, nothing, spark):
    found = mixed(edges).collect()
    count = collections.Counter((r["doc_id"], r["size"]) for r in found)
    want = collections.Counter((r["doc_id"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in edges.collect())
    assert count == want
    assert all(r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0) for r in found)
    assert mixed(nothing).count() == mix(nothing).count() == 0
    blank = frame(spark, [(1, None, "a"), (2, "", None), (None, " \t", "b")])
    assert [(r["target"], r["taken"]) for r in mixed(blank).collect()] == [(0.0, 0)] * 3


def test_repeated_rows_draw_apart_and_reruns_agree(spark):
    rows = [(7, "same words here", "a")] * 3000 + [(None, "no id", "b")] * 900 + [(i, f"text {i}", "c") for i in range(3000)]
    found = repetitions(frame(spark, rows))
    got = found.collect()
    totals = collections.Counter()
    for r in got:
        totals[r["source"]] += r["copies"] * r["size"]
        assert math.floor(r["rate"]) <= r["copies"] <= math.floor(r["rate"]) + 1
    for r in got:
        assert abs(totals[r["source"]] - r["target"]) < 0.06 * r["target"]
    key = lambda rows: collections.Counter((r["doc_id"], r["key"], r["copies"]) for r in rows)
    again = repetitions(frame(spark, list(reversed(rows))).repartition(7)).collect()
    assert key(again) == key(got)
    emitted = collections.Counter((r["doc_id"], r["text"]) for r in mix(frame(spark, rows)).collect())
    want = collections.Counter()
    for (i, k, n), times in key(got).items():
        want[i, k] += n * times
    assert sorted(emitted.values()) == sorted(n for n in want.values() if n)


def test_mix_over_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = repetitions(docs).collect()
    by = collections.defaultdict(lambda: [0, 0.0, 0.0])
    for r in rows:
        share = r["rate"] - math.floor(r["rate"])
        by[r["source"]][0] += r["copies"] * r["size"]
        by[r["source"]][1] = r["target"]
        by[r["source"]][2] += r["size"] ** 2 * share * (1 - share)
    # within five standard deviations of independent draws
    assert all(abs(taken - target) <= 5 * math.sqrt(spread) + 1e-6 for taken, target, spread in by.values())
