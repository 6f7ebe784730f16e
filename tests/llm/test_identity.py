"""Words, sets and rows are told apart: patterned words, many rows under one id, large ids."""

from __future__ import annotations

import collections
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from spendmill.llm.substring_dedup import remove_repeats
from spendmill.llm.words import PLACES, alphanumeric, visible, word_slices


def hashes(texts, alphabet):
    return np.concatenate([w.hashes for w in word_slices(pa.array(texts), alphabet)]).tolist()


def test_patterned_words_do_not_collide():
    swap = str.maketrans("ab", "ba")
    for turns in (10, 12, 16):
        word = "a"
        for _ in range(turns):
            word += word.translate(swap)
        one, other = hashes([word, word.translate(swap)], visible())
        assert one != other


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbé9 \n-", max_size=2 * PLACES), min_size=1, max_size=8))
def test_equal_words_have_equal_hashes_wherever_they_are(texts):
    for alphabet, words in ((visible(), lambda t: re.findall(r"[^ \t-\r]+", t)), (alphanumeric(), lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.replace("A", "a")))):
        found = hashes([*texts, " ".join(texts)], alphabet)
        listed = [w for t in [*texts, " ".join(texts)] for w in words(t)]
        assert len(found) == len(listed)
        by_hash = collections.defaultdict(set)
        for h, w in zip(found, listed, strict=True):
            by_hash[h].add(w)
        assert all(len(x) == 1 for x in by_hash.values()) and len(by_hash) == len(set(listed))


def test_rows_under_one_id_spread_and_keep_their_own_words(spark):
    base = [f"w{i}" for i in range(40)]
    rows = [(None, " ".join(base[i % 7 :] + [f"own{i}"])) for i in range(60)] + [(5, " ".join(base[3:30]))] * 20
    rows += [((1 << 63) - 1, " ".join(base[:20]))] + [(i, f"lone {i}") for i in range(100, 160)] + [(6, None), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    order = lambda i: (1 << 63) - 1 if i is None else i
    first = {}
    for i, t in rows:
        w = (t or "").split()
        for p in range(len(w) - 12):
            at = tuple(w[p : p + 13])
            first[at] = min(first.get(at, (1 << 63)), order(i))
    want = collections.Counter()
    for i, t in rows:
        w = (t or "").split()
        gone = {q for p in range(len(w) - 12) if first[tuple(w[p : p + 13])] < order(i) for q in range(p, p + 13)}
        want[i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)] += 1
    for options in ({}, {"documents_per_bucket": 3}, {"bytes_per_bucket": 300, "group_suffixes": 40, "cells": 16}):
        found = remove_repeats(frame, **options)
        assert collections.Counter(tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "kept").collect()) == want
