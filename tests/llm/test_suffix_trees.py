"""Maximal repeats against brute force, and the words that follow from them against the removal."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from spendmill.llm.substring_dedup import remove_repeats
from spendmill.llm.suffix_trees import maximal_repeats

SCHEMA = "doc_id long, text string"
LAST = float("inf")


def number(doc):
    return LAST if doc is None else doc


def brute(docs, window):
    """{words: sorted [(document, first word)]} of all maximal repeats of several documents."""
    split = [(i, (t or "").split()) for i, t in docs]
    places = defaultdict(list)
    for row, (_, words) in enumerate(split):
        for lo in range(len(words)):
            for hi in range(lo + window, len(words) + 1):
                places[tuple(words[lo:hi])].append((row, lo, hi))
    found = {}
    for words, at in places.items():
        documents = {split[r][0] for r, _, _ in at}
        before = {split[r][1][lo - 1] if lo else ("start", r) for r, lo, _ in at}
        after = {split[r][1][hi] if hi < len(split[r][1]) else ("end", r) for r, _, hi in at}
        if len(documents) > 1 and len(before) > 1 and len(after) > 1:
            found[words] = sorted((number(split[r][0]), lo) for r, lo, _ in at)
    return found


def by_trees(spark, docs, window, **options):
    trees = maximal_repeats(spark.createDataFrame(docs, SCHEMA).repartition(3), window, **options)
    texts = defaultdict(list)
    for i, t in docs:
        texts[i].append((t or "").split())
    places = defaultdict(list)
    for r in trees.occurrences().collect():
        places[r["repeat_id"]].append((r["doc_id"], r["start"], r["end"]))
    found = {}
    for r in trees.repeats().collect():
        at = places.pop(r["repeat_id"])
        doc, lo, hi = min(at, key=lambda x: (number(x[0]), x[1]))
        words = next(tuple(w[lo:hi]) for w in texts[doc] if len(w) >= hi)
        assert (r["n_words"], r["n_occurrences"]) == (hi - lo, len(at))
        assert (r["first_doc"], r["last_doc"]) == (doc, max((x[0] for x in at), key=number))
        found.setdefault(words, []).append(sorted((number(d), a) for d, a, _ in at))
    assert not places and all(len(x) == 1 for x in found.values())  # every repeat is in one group, once
    return {words: at[0] for words, at in found.items()}


def corpus(seed):
    draw = random.Random(seed)
    docs = []
    for i in range(25):
        words = [draw.choice("abc") for _ in range(draw.randrange(25))]
        if docs and draw.random() < 0.5:  # a near copy
            words = docs[draw.randrange(len(docs))][1].split()
            for _ in range(draw.randrange(3)):
                words[draw.randrange(len(words) + 1) :] = draw.choices("abcd", k=draw.randrange(6))
        docs.append((i, " ".join(words)))
    return docs


@pytest.mark.parametrize(("seed", "options"), [(1, {}), (2, {"group_words": 60, "group_suffixes": 20, "cells": 16}), (3, {"group_words": 1, "cells": 64})])
def test_repeats_equal_brute_force(spark, seed, options):
    docs = corpus(seed)
    want = brute(docs, 4)
    assert len(want) > 20
    assert by_trees(spark, docs, 4, **options) == want


def test_passages_that_touch_are_two_repeats(spark):
    a, b = [f"a{i}" for i in range(20)], [f"b{i}" for i in range(20)]
    docs = [(1, " ".join(["x", *a, "y"])), (2, " ".join(["z", *b])), (3, " ".join(["q", *a, *b, "r"]))]
    assert by_trees(spark, docs, 13) == {tuple(a): [(1, 1), (3, 1)], tuple(b): [(2, 1), (3, 21)]}
    assert remove_repeats(spark.createDataFrame(docs, SCHEMA)).where("doc_id = 3").first()["repeats"] == [(1, 21), (21, 41)]


def test_repeats_of_null_empty_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(8))
    docs = [(None, text), (None, text + " more"), (5, text), (5, text), (7, None), (8, ""), (9, "w1 w2"), (4, "own " + text + " own")]
    docs += [(20 + i, text) for i in range(4)]
    assert by_trees(spark, docs, 5) == brute(docs, 5)
    twice = [(1, text), (1, text), (2, "w1")]  # one document alone is no repeat
    assert by_trees(spark, twice, 5) == {}
    assert maximal_repeats(spark.createDataFrame([], SCHEMA)).repeats().count() == 0


def test_removed_words_are_those_of_repeats_that_a_smaller_document_has(spark):
    docs = corpus(4)
    frame = spark.createDataFrame(docs, SCHEMA)
    trees = maximal_repeats(frame, 4, group_words=200, cells=64)
    first = {r["repeat_id"]: r["first_doc"] for r in trees.repeats().collect()}
    gone = defaultdict(set)
    for r in trees.occurrences().collect():
        if first[r["repeat_id"]] < r["doc_id"]:
            gone[r["doc_id"]].update(range(r["start"], r["end"]))
    removed = {r["doc_id"]: r["n_removed"] for r in remove_repeats(frame, 4).collect()}
    assert removed == {i: len(gone[i]) for i, _ in docs} and any(removed.values())
