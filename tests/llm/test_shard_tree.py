"""The k-d tree of shards against exact weighted medians, node by node, and the rows that follow from it."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendmill.llm.sharding import DIMENSIONS, KEY_BITS, RECORD_BYTES, TOLERANCE, VALUE_BITS, _groups, build_tree, shard_documents

SHARDS = 24


@pytest.fixture(scope="module")
def some(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def groups(some):
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = some.select("doc_id", (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"), F.unhex(F.sha2(text, 256)).alias("digest"), "lang", "source")
    return _groups(rows)


def test_every_split_is_the_weighted_median_of_the_widest_dimension(groups):
    rows = groups.toPandas()
    weight, tie = rows["weight"].to_numpy(np.int64), rows["tie"].to_numpy(np.int64)
    keys = {d: (rows[d].to_numpy(np.int64) << (KEY_BITS - VALUE_BITS)) | tie for d in DIMENSIONS}
    splits = []

    def walk(node, mine):
        if node.dimension is None:
            assert node.shards == 1 or len(mine) <= 1
            return {node.first: int(weight[mine].sum())}
        spread = {d: int(np.ptp(rows[d].to_numpy(np.int64)[mine])) for d in DIMENSIONS}
        assert spread[node.dimension] == max(spread.values())
        key = keys[node.dimension][mine]
        order = np.argsort(key, kind="stable")
        below = np.cumsum(weight[mine][order])[:-1][np.diff(key[order]) > 0]  # what lies below each possible split
        total = int(weight[mine].sum())
        want = total * (node.shards // 2) / node.shards
        left = int(weight[mine][key < node.key].sum())
        assert abs(left - want) <= np.abs(below - want).min() + TOLERANCE * total
        share = min(max(round(node.shards * left / total), 1), node.shards - 1)
        assert (node.left.shards, node.right.shards) == (share, node.shards - share)
        assert (node.left.first, node.right.first) == (node.first, node.first + share)
        splits.append(node.dimension)
        return walk(node.left, mine[key < node.key]) | walk(node.right, mine[key >= node.key])

    sizes = walk(build_tree(groups, SHARDS), np.arange(len(rows)))
    assert len(sizes) == SHARDS and len(splits) == SHARDS - 1 and len(set(splits)) > 1
    assert max(sizes.values()) <= sum(sizes.values()) / SHARDS + 2 * weight.max()


def test_rows_follow_their_law(some):
    texts = {r["doc_id"]: r["text"] for r in some.select("doc_id", "text").collect()}
    found = shard_documents(some, SHARDS).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    shards, slots, size = {}, {}, Counter()
    for r in found:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + RECORD_BYTES, zlib.crc32(raw), "bytes", None)
        assert shards.setdefault(hashlib.sha256(raw).digest(), r["shard"]) == r["shard"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        size[r["shard"]] += r["size"]
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sorted(slots) == list(range(SHARDS))
    assert max(size.values()) <= 1.1 * sum(size.values()) / SHARDS
