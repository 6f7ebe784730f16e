"""Near-duplicate join on word n-grams: MinHash banding, then exact Jaccard on the full n-gram sets.

The numbers of bands and rows follow from the threshold and the target recall. Equal n-gram sets are one node with
a count, so copies are neither banded nor compared. Nodes that share a band are tied to the band's least node, and
a connected group of such ties is compared inside one task; a group too large for that is compared block against
block. Tasks return each node's links and a spanning forest of them, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .storage import stored
from .words import Words, alphanumeric, mix, whole_windows, window_sums, word_slices

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
MAX_HASHES = 320
BLOCK_NODES = 512
BLOCK_SHINGLES = 1_000_000
COLUMNS = 4096
_SIGNATURE = "doc_id long, row long, node binary, n int, bands array<long>"


def bands_and_rows(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """The most rows per band, and as many bands, as reach ``recall`` at ``threshold`` with ``max_hashes`` hashes."""
    best = (max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)) if threshold < 1 else 1
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    return best


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds by row) of each row's n-grams, repeats included; fewer words than ``n`` are one n-gram."""
    at = whole_windows(words, n)
    rows, hashes = words.row[at], mix(window_sums(words.hashes, n)[at]) if len(at) else np.empty(0, dtype=np.uint64)
    short = np.flatnonzero((words.counts() > 0) & (words.counts() < n))
    if len(short):
        few = [mix(window_sums(words.hashes[a:b], b - a))[0] for a, b in zip(words.bounds[short], words.bounds[short + 1], strict=True)]
        rows, hashes = np.concatenate([rows, short]), np.concatenate([hashes, np.array(few, dtype=np.uint64)])
        order = np.argsort(rows, kind="stable")
        rows, hashes = rows[order], hashes[order]
    return hashes, np.searchsorted(rows, np.arange(words.rows + 1))


def _set_id(distinct: np.ndarray) -> bytes:
    """128 bits that stand for a set of hashes."""
    second = mix(distinct ^ np.uint64(0x94D049BB133111EB))
    return np.array([distinct.sum(dtype=np.uint64), second.sum(dtype=np.uint64)]).tobytes()


def _minhash(hashes: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands): each band's hash of ``rows`` minimum hashes."""
    generator = np.random.default_rng(20240101)
    factors = generator.integers(1 << 32, size=(2, bands * rows), dtype=np.uint32)
    short, work = (hashes >> np.uint64(32)).astype(np.uint32), np.empty(len(hashes), dtype=np.uint32)
    out = np.zeros((len(starts), bands), dtype=np.uint64)
    for k in range(bands * rows):
        np.multiply(short, factors[0, k] | np.uint32(1), out=work)
        np.add(work, factors[1, k], out=work)
        lowest = np.minimum.reduceat(work, starts).astype(np.uint64)
        band = k // rows
        out[:, band] = mix(out[:, band] ^ (lowest + np.uint64(band << 40)))
    return out


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, row, node, n, bands) of every row; without words node and bands are null and n is 0."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in word_slices(batch["text"], alphanumeric()):
                hashes, bounds = shingles(words, n)
                full = np.flatnonzero(np.diff(bounds))
                table = iter(_minhash(hashes, bounds[:-1][full], bands, rows).view(np.int64)) if len(full) else iter(())
                nodes, sizes, listed = [], [], []
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    distinct = np.unique(hashes[a:b])
                    sizes.append(len(distinct))
                    nodes.append(_set_id(distinct) if b > a else None)
                    listed.append(next(table) if b > a else None)
                columns = [batch[c][words.first : words.first + words.rows] for c in ("doc_id", "row")]
                columns += [pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()), pa.array(listed, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "node", "n", "bands"])

    return docs.select("doc_id", "row", "text").mapInArrow(sign, _SIGNATURE)


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """(node, shingles): the distinct n-gram hashes of each row with words."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in word_slices(batch["text"], alphanumeric()):
                hashes, bounds = shingles(words, n)
                distinct = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                columns = [pa.array([_set_id(x) if len(x) else None for x in distinct], pa.binary())]
                columns.append(pa.array([x.tobytes() for x in distinct], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["node", "shingles"])

    return docs.select("text").mapInArrow(collect, "node binary, shingles binary").where("node is not null")


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of ``left`` and ``right`` sets: a product of incidence matrices, by column blocks."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.full(len(values), -1)
    shared = np.flatnonzero(times > 1)
    number[shared] = np.arange(len(shared))
    column = number[column]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    for lo in range(0, len(shared), COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        matrix = np.zeros((len(sets), min(COLUMNS, len(shared) - lo)), dtype=np.float32)
        matrix[owner[a:b], column[a:b] - lo] = 1
        total += matrix[left] @ matrix[right].T
    return total


def _compare(members: list[tuple], threshold: float) -> list[tuple[int, int, int]]:
    """(node, a linked node that spans, links counted by copies) for the members of one group or block pair."""
    first = members[0]
    sets = [np.frombuffer(m[6], dtype=np.uint64) for m in members]
    nodes, copies = np.array([m[4] for m in members]), np.array([m[5] for m in members])
    block = np.array([m[3] for m in members])
    within = first[1] == first[2]
    left, right = (np.arange(len(members)),) * 2 if within else (np.flatnonzero(block == first[1]), np.flatnonzero(block == first[2]))
    if not len(left) or not len(right):
        return []
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    common = _overlaps(sets, left, right).astype(np.float64)
    linked = common / (sizes[left][:, None] + sizes[right][None, :] - common) >= threshold
    if within:
        np.fill_diagonal(linked, False)
    links = np.zeros(len(members), dtype=np.int64)
    links[left] += linked @ copies[right]
    if not within:
        links[right] += copies[left] @ linked
    # A spanning forest: each row's first link, and links that tie rows to columns reached before.
    parent = list(range(len(members)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for r, c in np.argwhere(linked).tolist():
        a, b = root(int(left[r])), root(int(right[c]))
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(int(nodes[k]), int(nodes[root(k)]), int(links[k])) for k in np.flatnonzero(links).tolist()]


def _verify(threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (group, i, j); each run of equal ones is compared as a whole."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            yield from zip(*columns, strict=True)

    held: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = [pa.array([x[k] for x in held], pa.int64()) for k in range(3)]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "links"])

    for _, members in groupby(rows(), key=lambda m: m[:3]):
        unique = list({m[4]: m for m in members}.values())
        held += _compare(unique, threshold)
        if len(held) > 10_000:
            yield flush()
            held.clear()
    yield flush()


def candidate_groups(nodes: DataFrame) -> DataFrame:
    """(id, group): nodes tied through shared bands. ``nodes`` has id and bands; only ids and band hashes move."""
    rows = nodes.select(F.col("id"), F.explode("bands").alias("band"))
    hubs = rows.groupBy("band").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1").select("band", "hub")
    ties = rows.join(hubs, "band").where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    return components(ties).select(F.col("node").alias("id"), F.col("label").alias("group"))


def near_duplicates(
    docs: DataFrame,
    *,
    n: int = WORDS,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    row_col: str | None = None,
    block_nodes: int = BLOCK_NODES,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, n_links, n_shingles.

    Two texts are linked if their sets of ``n``-word shingles (lower-cased words; a shorter text is one shingle)
    have a Jaccard similarity of at least ``threshold``. class_id is the least doc_id that links lead to (nulls
    last), n_links the number of other rows linked to this one, copies included. Texts without words are linked to
    nothing. Rows with the same set are copies, whatever their ids. Only doc_id and text are read.

    ``row_col`` names a column with a number of its own for each row. The result then has it, and kept, which is true
    for exactly one row of each class: of the least doc_id's rows the one with the least number.
    """
    bands, rows = bands_and_rows(threshold, recall)
    row = F.col(row_col) if row_col else F.lit(None)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row.cast("long").alias("row"), "text")
    signed = stored(signatures(docs, n, bands, rows), "signatures")
    full = signed.where("node is not null")
    # A node's number, fixed when it is stored, stands for its set in candidates, blocks and links.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    nodes = full.groupBy("node").agg(first, F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    nodes = stored(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    groups = stored(candidate_groups(nodes), "candidates")
    size = groups.join(nodes.select("id", "n"), "id").groupBy("group").agg(F.count("*").alias("members"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("members") / block_nodes), F.ceil(F.col("total") / block_shingles)).cast("int")
    wanted = groups.join(size.select("group", blocks.alias("blocks")), "group").join(nodes.select("id", "node", "first", "copies"), "id")
    by = "row" if row_col else "doc_id"
    texts = docs.select(by, "text").join(wanted.select(F.col("first")[by].alias("first_key")).distinct(), F.col(by).eqNullSafe(F.col("first_key")), "left_semi")
    members = _sets(texts, n).join(wanted.drop("first"), "node")
    members = members.withColumn("block", F.pmod(F.col("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = members.withColumn("other", other).select(
        "group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "copies", "shingles"
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _verify(threshold, batches)

    dealt = pairs.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")
    found = stored(dealt.mapInArrow(verify, "a long, b long, links long"), "links")
    labels = components(found.select("a", "b"))
    linked = found.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "id")
    known = nodes.select("node", "id", "first", "copies").join(labels.withColumnRenamed("node", "id"), "id", "left").join(linked, "id", "left")
    known = known.where("copies > 1 or links is not null").withColumn("label", F.coalesce("label", "id"))
    classes = known.groupBy("label").agg(F.min("first").alias("class"))
    known = known.join(classes, "label").select("node", "class", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.lit(True).alias("known"))
    joined = signed.select("doc_id", "row", "node", "n").join(known, "node", "left")
    return joined.select(
        *([F.col("row").alias(row_col)] if row_col else []),
        "doc_id",
        F.when(F.col("known"), F.col("class")["doc_id"]).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.col("n").cast("long").alias("n_shingles"),
        *([(F.col("known").isNull() | (F.col("row") == F.col("class")["row"])).alias("kept")] if row_col else []),
    )
