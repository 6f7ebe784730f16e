"""Shards of near equal bytes by a k-d tree over document metadata.

Texts that are equal stay together: the tree splits groups of them, weighted by their bytes. A node that stands for
k shards is split along its widest dimension where the weights divide as its halves' shards do. The split value is
found by distributed histograms of a 48-bit key (24 bits of the dimension, then 24 of a hash of the text, which
parts ties), refined bit by bit; all nodes of a level share each pass, and only histogram bins reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored

SHARDS = 24
RECORD_BYTES = 8
TOLERANCE = 0.0005
ROWS_PER_BLOCK = 50_000
KEY_BITS, VALUE_BITS, STEP_BITS = 48, 24, 8
DIMENSIONS = ("by_lang", "by_source", "by_length", "by_id")


@dataclass
class Node:
    """Shards ``first`` to ``first + shards - 1``; once split, a dimension, a key and two children."""

    first: int
    shards: int
    number: int = 0
    dimension: str | None = None
    key: int = 0
    left: Node | None = None
    right: Node | None = None

    def value(self, leaf) -> Column:
        """``leaf(node)`` of the leaf that a group falls into."""
        if self.dimension is None:
            return leaf(self)
        return F.when(composite(self.dimension) < self.key, self.left.value(leaf)).otherwise(self.right.value(leaf))

    def leaves(self) -> list[Node]:
        return [self] if self.dimension is None else self.left.leaves() + self.right.leaves()


def composite(dimension: str) -> Column:
    """The dimension's value and the tie hash as one 48-bit number."""
    return F.shiftleft(F.col(dimension), KEY_BITS - VALUE_BITS).bitwiseOR(F.col("tie"))


def _scaled(value: Column, low: float | None, high: float | None) -> Column:
    """``value`` as 24 bits between the table's extremes; null counts as lowest."""
    if low is None or high is None or high <= low:
        return F.lit(0).cast("long")
    unit = (value.cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low))
    return F.coalesce(F.greatest(F.least(F.floor(unit * ((1 << VALUE_BITS) - 1)), F.lit((1 << VALUE_BITS) - 1)), F.lit(0)), F.lit(0)).cast("long")


def _groups(rows: DataFrame) -> DataFrame:
    """One row per distinct text: weight, tie hash and scaled metadata (the least of its copies')."""
    raw = rows.groupBy("digest").agg(
        F.sum("size").alias("weight"),
        F.min(F.crc32(F.coalesce("lang", F.lit("")).cast("binary"))).alias("lang"),
        F.min(F.crc32(F.coalesce("source", F.lit("")).cast("binary"))).alias("source"),
        F.log1p(F.min("size")).alias("length"),
        F.min("doc_id").alias("id"),
    )
    raw = stored(raw, "groups")
    names = dict(zip(DIMENSIONS, ("lang", "source", "length", "id"), strict=True))
    ends = raw.agg(*(f(c).alias(f"{c}_{n}") for c in names.values() for n, f in (("low", F.min), ("high", F.max)))).first()
    tie = F.pmod(F.xxhash64("digest"), F.lit(1 << (KEY_BITS - VALUE_BITS)))
    scaled = [_scaled(F.col(c), ends[f"{c}_low"], ends[f"{c}_high"]).alias(d) for d, c in names.items()]
    return stored(raw.select("digest", "weight", tie.alias("tie"), *scaled), "scaled")


def _widest(groups: DataFrame, root: Node, open_nodes: list[Node]) -> dict[int, int]:
    """Set each open node's widest dimension; the nodes' weights. Nodes with one key only stay leaves."""
    at = root.value(lambda n: F.lit(n.number if n in open_nodes else -1))
    spread = [(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]
    rows = groups.withColumn("node", at).where("node >= 0").groupBy("node").agg(F.sum("weight").alias("weight"), F.count("*").alias("n"), *spread).collect()
    found = {r["node"]: r for r in rows}
    weights = {}
    for node in open_nodes:
        row = found.get(node.number)
        if row is not None and row["n"] > 1:
            node.dimension = max(DIMENSIONS, key=lambda d, r=row: (r[d], d))  # ties go by the dimension's name
            weights[node.number] = row["weight"]
    return weights


def _split_keys(groups: DataFrame, at: Column, nodes: list[Node], weights: dict[int, int]) -> dict[int, tuple[int, int]]:
    """(key, weight below it) nearest to each node's wanted weight."""
    low = {n.number: 0 for n in nodes}  # the wanted key lies in [low, low + 2**bits)
    below = {n.number: 0 for n in nodes}
    want = {n.number: weights[n.number] * (n.shards // 2) / n.shards for n in nodes}
    best: dict[int, tuple[int, int]] = {}
    live, bits = list(nodes), KEY_BITS
    while live and bits:
        bits -= STEP_BITS
        keys = reduce(lambda c, n: c.when(F.col("node") == n.number, composite(n.dimension) - low[n.number]), live, F.when(F.lit(False), F.lit(0).cast("long")))
        bins = F.shiftright(keys, bits)
        rows = (
            groups.select(at.alias("node"), "weight", "tie", *DIMENSIONS)
            .select("node", "weight", bins.alias("bin"))
            .where((F.col("bin") >= 0) & (F.col("bin") < 1 << STEP_BITS))
            .groupBy("node", "bin").agg(F.sum("weight").alias("weight")).collect()
        )
        again = []
        for node in live:
            k, so_far = node.number, below[node.number]
            for bin_, weight in sorted((r["bin"], r["weight"]) for r in rows if r["node"] == k):
                start = low[k] + (bin_ << bits)
                for key, total in ((start, so_far), (start + (1 << bits), so_far + weight)):
                    if 0 < total < weights[k] and (k not in best or abs(total - want[k]) < abs(best[k][1] - want[k])):
                        best[k] = (key, total)
                if so_far + weight > want[k]:
                    if weight > TOLERANCE * weights[k]:
                        low[k], below[k] = start, so_far
                        again.append(node)
                    break
                so_far += weight
        live = again
    return best


def build_tree(groups: DataFrame, shards: int) -> Node:
    """Split until every leaf is one shard, that is a target of total / shards bytes, or a single group."""
    root = Node(0, shards)
    number = 0
    open_nodes = [root] if shards > 1 else []
    while open_nodes:
        at = root.value(lambda n: F.lit(n.number))
        weights = _widest(groups, root, open_nodes)
        nodes = [n for n in open_nodes if n.number in weights]
        keys = _split_keys(groups, at, nodes, weights)
        following = []
        for node in nodes:
            if node.number not in keys:  # equal keys in every bit: it cannot be split
                node.dimension = None
                continue
            node.key, left = keys[node.number]
            share = min(max(round(node.shards * left / weights[node.number]), 1), node.shards - 1)
            node.left, node.right = Node(node.first, share, number + 1), Node(node.first + share, node.shards - share, number + 2)
            number += 2
            following += [n for n in (node.left, node.right) if n.shards > 1]
        open_nodes = following
    return root


def heavy_groups(groups: DataFrame, shards: int) -> list[bytes]:
    """Digests of the groups that outweigh an even share of what lighter groups leave; they fill shards alone.

    At most ``shards - 1``, the heaviest first, so one shard is left for the others.
    """
    heavy: list[bytes] = []
    while len(heavy) < shards - 1:
        rest = groups.where(~F.col("digest").isin(heavy)) if heavy else groups
        total = rest.agg(F.sum("weight")).first()[0] or 0
        over = rest.where(F.col("weight") > total / (shards - len(heavy))).orderBy(F.desc("weight"), "digest")
        new = [bytes(r["digest"]) for r in over.select("digest").limit(shards - 1 - len(heavy)).collect()]
        if not new:
            break
        heavy += new
    return heavy


def numbered(rows: DataFrame, *, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``slot`` from 0 without gaps in each shard: blocks of a shard are numbered apart and then lined up."""
    blocks = max(1, -(-rows.count() // rows_per_block))
    rows = stored(rows.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int")), "blocks")
    sizes = rows.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32"))
    return rows.withColumn("within", within).join(offsets, ["shard", "block"]).withColumn("slot", F.col("offset") + F.col("within") - 1).drop("block", "offset", "within")


def shard_documents(docs: DataFrame, shards: int = SHARDS, *, record_bytes: int = RECORD_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law ``bytes``: sizes (UTF-8 bytes plus ``record_bytes``) are near equal, off by no more than the texts at the
    splits, unless one group of equal texts outweighs a shard: it then fills one, and the others share the rest
    evenly. Null texts have no bytes and are one group; ids, lang and source may be null or repeat. Fewer groups
    than shards leave shards empty. Reads doc_id, text, lang and source only.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + record_bytes).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        "lang",
        "source",
    )
    rows = stored(rows, "rows")
    groups = _groups(rows)
    heavy = heavy_groups(groups, shards)
    tree = build_tree(groups.where(~F.col("digest").isin(heavy)) if heavy else groups, shards - len(heavy))
    shard = tree.value(lambda n: F.lit(n.first))
    for k, digest in enumerate(heavy):
        shard = F.when(F.col("digest") == F.lit(digest), shards - 1 - k).otherwise(shard)
    placed = groups.select("digest", shard.alias("shard"))
    sharded = numbered(rows.select("doc_id", "size", "text_crc32", "digest").join(placed, "digest").drop("digest"))
    none = F.lit(None).cast("int").alias("grown_shard")
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), none)
