"""Hard negatives by inner product, found on lists that a cluster of anchors shares.

Anchors are clustered by angle. In a task a cluster's list holds a block of candidates, sorted once by an upper bound on
their products with any member: candidate norm x cos(max(0, angle to the cluster's centre - widest member angle)). Each
member walks that list and stops where the bound, times its own norm, falls below what it still needs; ties at that
value are walked too, so the stop is certified and results are exact. A first walk finds the positives, a second one the
negatives, whose range of scores the positives set.

Anchors are a query set taken in blocks, sorted by cluster and angle; each block is sent to all tasks, and is bounded by
``ANCHORS_PER_BLOCK``. Tasks carry what a member has found from list to list and return that at their end, so at most
(positives x negatives) rows of an anchor leave a task, and Spark ranks them by anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from .storage import new_folder, stored
from .vectors import list_matrix, padded, products, whole_vectors

POSITIVES, NEGATIVES, LOW_PERCENT, HIGH_PERCENT, SCALE = 5, 10, 30, 90, 256
CLUSTERS, SAMPLE, ANCHORS_PER_BLOCK, LIST_ROWS, STEP = 32, 4_096, 8_192, 32_768, 2_048
#: Angles are taken this much apart and bounds this much larger than computed, far beyond the error of doubles.
ANGLE_SLACK, BOUND_SLACK = 1e-6, 1e-9
PREPARED = "vec_id long, label long, vector array<int>, is_anchor boolean"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass
class Member:
    """An anchor; ``found`` holds (score, id, id is missing) of what may still be part of its result, best first."""

    uid: int
    label: int
    vector: np.ndarray
    windows: list[tuple[int, int]] = field(default_factory=list)  # (lowest, highest) score of each wanted range
    found: tuple[np.ndarray, np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    needs: float = -np.inf  # no lower score can enter; inf: nothing can

    def take(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray, most: int) -> None:
        """Merge more rows; of each range the ``most`` best stay, ties by smaller id and null ids last."""
        scores, ids, missing = (np.concatenate(x) for x in zip(self.found, (scores, ids, missing), strict=True))
        order = np.lexsort((ids, missing, -scores))
        scores, ids, missing = scores[order], ids[order], missing[order]
        keep, needs = np.zeros(len(scores), dtype=bool), []
        for lowest, highest in self.windows:
            if lowest > highest:
                continue
            start = int(np.searchsorted(-scores, -highest))  # scores fall
            end = min(start + most, int(np.searchsorted(-scores, -lowest, side="right")))
            keep[start:end] = True
            needs.append(int(scores[end - 1]) if end - start == most else lowest)
        self.found = scores[keep], ids[keep], missing[keep]
        self.needs = min(needs, default=np.inf)


@dataclass
class Cluster:
    centre: np.ndarray  # of length one
    members: list[Member]

    def walk(self, rows: Candidates, same_label: bool, most: int) -> None:
        """Every member walks the list of ``rows``, sorted here once for all of them."""
        width = len(self.centre)
        vectors = np.stack([m.vector for m in self.members])
        norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        widest = angles(vectors, norms, self.centre).max()
        apart = np.maximum(0, angles(rows.vectors, rows.norms, self.centre) - widest - ANGLE_SLACK)
        bounds = rows.norms * (np.cos(apart) + BOUND_SLACK)
        order = np.argsort(-bounds, kind="stable")
        walking = np.arange(len(self.members))
        for start in range(0, len(order), STEP):
            top = bounds[order[start]]
            walking = walking[[norms[m] * top + BOUND_SLACK >= self.members[m].needs for m in walking]]
            if not len(walking):
                return
            part = order[start : start + STEP]
            scores = products(vectors[walking], rows.vectors[part].reshape(-1, width))
            for m, own in zip(walking, scores, strict=True):
                member = self.members[m]
                fits = (rows.labels[part] == member.label) == same_label
                if same_label:
                    fits &= rows.uids[part] != member.uid
                fits &= (own >= member.needs) & (own <= member.windows[0][1])
                if fits.any():
                    at = part[fits]
                    member.take(own[fits], rows.ids[at], rows.missing[at], most)


@dataclass
class Candidates:
    """Rows of one list: numbers of their own, ids (0 where ``missing``), labels, vectors and norms."""

    uids: np.ndarray
    ids: np.ndarray
    missing: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray

    @staticmethod
    def of(table: pa.Table, width: int) -> Candidates:
        table = table.combine_chunks()
        column = lambda n: table.column(n).combine_chunks() if table.num_rows else pa.array([], table.schema.field(n).type)
        vectors = list_matrix(column("vector"), width)
        ids = column("vec_id")
        return Candidates(
            column("uid").to_numpy(zero_copy_only=False),
            ids.fill_null(0).to_numpy(zero_copy_only=False),
            ids.is_null().to_numpy(zero_copy_only=False),
            column("label").to_numpy(zero_copy_only=False),
            vectors,
            np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1)),
        )


def angles(vectors: np.ndarray, norms: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Angle of each vector to ``centre``; a zero vector, whose products are all 0, has angle 0."""
    cosine = vectors.astype(np.float64) @ centre / np.where(norms > 0, norms, 1)
    return np.where(norms > 0, np.arccos(np.clip(cosine, -1, 1)), 0)


def _prepared(rows: DataFrame, anchor: Column, scale: int) -> DataFrame:
    """The rows that take part, as whole numbers and with a number of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, vectors = whole_vectors(batch.column(2), scale)
            labelled = np.flatnonzero(batch.column(1).is_valid().to_numpy(zero_copy_only=False)[at])
            at, vectors = pa.array(at[labelled]), [vectors[i] for i in labelled]
            ends = np.concatenate([[0], np.cumsum([len(v) for v in vectors], dtype=np.int64)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *vectors]).astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, flat)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), lists, batch.column(3).take(at)], names=["vec_id", "label", "vector", "is_anchor"])

    chosen = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding", F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    return stored(chosen.mapInArrow(run, PREPARED).withColumn("uid", F.monotonically_increasing_id()), "vectors")


def _centres(anchors: DataFrame, clusters: int, width: int) -> np.ndarray:
    """Directions fitted on at most ``SAMPLE`` anchors, chosen by hash; how good they are decides speed, not results."""
    rows = anchors.orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE).select("vector").collect()
    sample = padded([np.array(r["vector"], dtype=np.int64) for r in rows], width).astype(np.float64)
    sample = sample / np.maximum(np.sqrt((sample**2).sum(axis=1, keepdims=True)), 1e-300)
    centres = sample[: max(1, min(clusters, len(sample) // 8))]
    for _ in range(8):
        owner = (sample @ centres.T).argmax(axis=1)
        sums = np.stack([sample[owner == c].sum(axis=0) if (owner == c).any() else centres[c] for c in range(len(centres))])
        lengths = np.sqrt((sums**2).sum(axis=1, keepdims=True))
        centres = np.where(lengths > 1e-9, sums / np.maximum(lengths, 1e-300), centres)
    return centres


def _with_cluster(anchors: DataFrame, centres: np.ndarray) -> DataFrame:
    """``anchors`` with the nearest centre and the angle to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = list_matrix(batch.column(batch.schema.get_field_index("vector")), centres.shape[1])
            owner = (vectors.astype(np.float64) @ centres.T).argmax(axis=1)
            norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
            angle = np.zeros(len(vectors))
            for c in np.unique(owner):
                angle[owner == c] = angles(vectors[owner == c], norms[owner == c], centres[c])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(owner.astype(np.int32)), pa.array(angle)], names=[*batch.schema.names, "cluster", "angle"])

    schema = "uid long, vec_id long, label long, vector array<int>, cluster int, angle double"
    return anchors.select("uid", "vec_id", "label", "vector").mapInArrow(run, schema)


def _blocks(anchors: DataFrame, size: int) -> Iterator[list[Row]]:
    """All anchors by cluster and angle, ``size`` at a time; the driver holds one block and one partition."""
    block: list[Row] = []
    for row in stored(anchors, "anchors").orderBy("cluster", "angle", "uid").toLocalIterator():
        block.append(row)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def _walk(rows: DataFrame, new_clusters: Callable[[], list[Cluster]], same_label: bool, most: int, width: int, list_rows: int) -> DataFrame:
    """(uid, window, score, id): for each member and range, a task's ``most`` best rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clusters, held, n = new_clusters(), [], 0

        def walk() -> None:
            candidates = Candidates.of(pa.Table.from_batches(held), width)
            for cluster in clusters:
                cluster.walk(candidates, same_label, most)

        for batch in batches:
            for start in range(0, batch.num_rows, list_rows):
                held.append(batch.slice(start, list_rows))
                n += held[-1].num_rows
                if n >= list_rows:
                    walk()
                    held, n = [], 0
        if held:
            walk()
        for cluster in clusters:
            columns: list[list] = [[], [], [], []]
            for member in cluster.members:
                scores, ids, missing = member.found
                for number, (lowest, highest) in enumerate(member.windows):
                    at = np.flatnonzero((scores >= lowest) & (scores <= highest))[:most]
                    columns[0] += [member.uid] * len(at)
                    columns[1] += [number] * len(at)
                    columns[2] += scores[at].tolist()
                    columns[3] += [None if gone else i for i, gone in zip(ids[at].tolist(), missing[at], strict=True)]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["uid", "window", "score", "id"])

    parts = rows.select("uid", "vec_id", "label", "vector").mapInArrow(run, "uid long, window int, score long, id long")
    best = F.row_number().over(Window.partitionBy("uid", "window").orderBy(F.desc("score"), F.col("id").asc_nulls_last()))
    return parts.withColumn("rank", best).where(F.col("rank") <= most)


def _searched(rows: DataFrame, block: list[Row], centres: np.ndarray, options: dict) -> DataFrame:
    """The result of one block of anchors."""
    width, list_rows = centres.shape[1], options["list_rows"]
    plain = [(r["uid"], r["label"], np.array(r["vector"], dtype=np.int64), r["cluster"]) for r in block]

    def clusters(windows: dict[int, list[tuple[int, int]]]) -> Callable[[], list[Cluster]]:
        def new() -> list[Cluster]:
            members: dict[int, list[Member]] = {}
            for uid, label, vector, c in plain:
                if windows.get(uid):
                    member = Member(uid, label, padded([vector], width)[0], windows[uid])
                    member.take(*member.found, 1)
                    members.setdefault(c, []).append(member)
            return [Cluster(centres[c], m) for c, m in members.items()]

        return new

    every = [(-(1 << 62), 1 << 62)]
    found = _walk(rows, clusters({r["uid"]: every for r in block}), True, options["positives"], width, list_rows).collect()
    positives: dict[int, list[tuple[int, int | None]]] = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        positives.setdefault(r["uid"], []).append((r["score"], r["id"]))
    low, high = options["low_percent"], options["high_percent"]
    # 100 x score between low x positive and high x positive; highest first, as positives are sorted
    ranges = {uid: [(-((-low * s) // 100), (high * s) // 100) for s, _ in p] for uid, p in positives.items()}
    ids = {r["uid"]: r["vec_id"] for r in block}
    pairs = [(uid, n, ids[uid], i, s) for uid, p in positives.items() for n, (s, i) in enumerate(p)]
    pairs = rows.sparkSession.createDataFrame(pairs, "uid long, window int, anchor_id long, positive_id long, positive_score long")
    negatives = _walk(rows, clusters(ranges), False, options["negatives"], width, list_rows)
    joined = negatives.join(pairs, ["uid", "window"])
    return joined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(
    rows: DataFrame, anchor: Column, *, positives: int = POSITIVES, negatives: int = NEGATIVES, low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT, scale: int = SCALE, clusters: int = CLUSTERS, anchors_per_block: int = ANCHORS_PER_BLOCK, list_rows: int = LIST_ROWS,
) -> DataFrame:
    """Of each anchor and positive the best rows of another label whose score lies in a band of the positive's score.

    ``rows`` has vec_id, embedding and label; ``anchor`` says which rows are anchors (null: no). Components become
    floor(scale * x) and a score is the inner product of such vectors; missing components of a shorter vector count as 0.
    Positives are the anchor's ``positives`` best other rows of its label, negatives the ``negatives`` best of other
    labels with low % x positive score <= 100 % x score <= high % x positive score (none where that band is empty, as
    for a negative positive score). Higher scores come first, then smaller ids, null ids last. Rows with a null label,
    a null vector or a null or non-finite component take no part; null and repeated ids do, each row on its own, and an
    anchor's copies are other rows. An empty table, no anchor, or one label only give no row. A component beyond 2**27
    after scaling is an error. Reads the three columns and what ``anchor`` names only.
    """
    prepared = _prepared(rows, anchor, scale)
    spark: SparkSession = rows.sparkSession
    anchors = prepared.where("is_anchor")
    if anchors.isEmpty():
        return spark.createDataFrame([], RESULT)
    width = max(1, prepared.agg(F.max(F.size("vector")).alias("w")).first()["w"])
    centres = _centres(anchors, clusters, width)
    options = {"positives": positives, "negatives": negatives, "low_percent": low_percent, "high_percent": high_percent, "list_rows": list_rows}
    folder = new_folder(spark, "negatives")
    for number, block in enumerate(_blocks(_with_cluster(anchors, centres), anchors_per_block)):
        _searched(prepared, block, centres, options).write.parquet(f"{folder}/block={number}")
    return spark.read.schema(RESULT).parquet(folder).select(*[c.split()[0] for c in RESULT.split(", ")])
