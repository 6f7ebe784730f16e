"""Maximal repeats of a corpus, from prefix-partitioned suffix trees.

A window of words that several documents have is shared; a run is a longest row of shared windows in one text. No
repeat reaches beyond a run, so suffixes end with their run, and runs of equal words are one run with members. Where
all occurrences of a window follow the same word, no maximal repeat begins with it: a tree holds only the suffixes that
begin otherwise (an exact copy of a long text has one). These are dealt to groups by a prefix of theirs, as short as
keeps the words of a group in memory and up to a window long. A group orders its suffixes by doubling, takes the longest common
prefix of neighbours, and the internal nodes that this gives are the maximal repeats. A node is a range of the ordered
leaves, so the tree takes no more room than its leaves, however many occurrences its nodes have together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .packing import pack, smallest, unpack
from .storage import stored
from .shared_windows import (
    BYTES_PER_BUCKET,
    CELLS,
    DOCUMENTS_PER_BUCKET,
    GROUP_SUFFIXES,
    NO_ID,
    SLICE_BYTES,
    WINDOW,
    Partition,
    _cells,
    _runs,
    pack_texts,
    prefix_lengths,
    prefix_sums,
    shared_windows,
)
from .words import Words, mix, visible, whole_windows, word_slices

GROUP_WORDS = 12_000_000
_ALONE = np.uint64(0x9E3779B97F4A7C15)
_RUN = "bucket int, doc_id long, uid long, start int, words binary, before long, after long"
_TREE = "node boolean, group int, first int, last int, run long, at int, n_words int, n_occurrences long, first_doc long, last_doc long, covered int"


def _bits(values: np.ndarray) -> np.ndarray:
    """The same bits as signed numbers, which Spark can hold."""
    return np.ascontiguousarray(values).view(np.int64)


def _shared_runs(window: int, docs: pa.Table, flags: pa.Table) -> pa.Table:
    """The runs of a bucket's rows, with the words around them; an end of the text is like no other word."""
    parts: dict[int, list[np.ndarray]] = {}
    for blob in flags["flags"]:
        uids, n, keys = unpack(blob.as_buffer())
        for i, own in zip(uids.tolist(), np.split(keys, np.cumsum(n)[:-1]), strict=True):
            parts.setdefault(i, []).append(own)
    found: list[tuple] = []
    for bucket, blob in zip(docs["bucket"].to_pylist(), docs["texts"], strict=True):
        uids, ids, known, sizes, data = unpack(blob.as_buffer())
        ends = np.cumsum(sizes)
        rows = [r for r, i in enumerate(uids.tolist()) if i in parts]
        texts = [data[ends[r] - sizes[r] : ends[r]].tobytes() for r in rows]
        for words in word_slices(pa.array(texts, pa.large_binary()).view(pa.large_string()), visible(), SLICE_BYTES):
            at = whole_windows(words, window)
            keys = prefix_sums(words, window)[-1]
            begin = np.searchsorted(at, words.bounds)
            for i in range(words.rows):
                row, own = rows[words.first + i], slice(begin[i], begin[i + 1])
                uid = int(uids[row])
                shared = at[own][np.isin(keys[own], np.concatenate(parts[uid]))]
                edge = np.uint64(2 * uid) ^ _ALONE
                for part in np.split(shared, np.flatnonzero(np.diff(shared) > 1) + 1):
                    lo, hi = int(part[0]), int(part[-1]) + window
                    before = words.hashes[lo - 1] if lo > words.bounds[i] else mix(np.array([edge]))[0]
                    after = words.hashes[hi] if hi < words.bounds[i + 1] else mix(np.array([edge + np.uint64(1)]))[0]
                    doc = int(ids[row]) if known[row] else int(NO_ID)
                    found.append((bucket, doc, uid, lo - int(words.bounds[i]), words.hashes[lo:hi].tobytes(), before.view(np.int64).item(), after.view(np.int64).item()))
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    columns = zip(*found, strict=True) if found else [()] * len(kinds)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["bucket", "doc_id", "uid", "start", "words", "before", "after"])


def buckets_of(docs: DataFrame, documents_per_bucket: int = DOCUMENTS_PER_BUCKET, bytes_per_bucket: int = BYTES_PER_BUCKET) -> int:
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    return max(1, -(-size["n"] // documents_per_bucket), -(-(size["bytes"] or 0) // bytes_per_bucket))


def packed(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, texts): the rows of ``docs`` by bucket of their numbers."""

    def pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return pack_texts(buckets, batches)

    return docs.mapInArrow(pack_batches, "bucket int, texts binary")


def shared_runs(docs: DataFrame, buckets: int, window: int, group_suffixes: int, cells: int) -> DataFrame:
    """One row per run of shared windows: doc_id (a null id as ``NO_ID``), uid and its bucket, start, word hashes, the words around."""
    flags = shared_windows(docs, buckets, window, group_suffixes=group_suffixes, cells=cells)
    flags = stored(flags, "windows", release=True)

    def runs(texts: pa.Table, flags: pa.Table) -> pa.Table:
        return _shared_runs(window, texts, flags)

    return packed(docs, buckets).groupBy("bucket").cogroup(flags.groupBy("bucket")).applyInArrow(runs, _RUN)


def distinct_runs(runs: DataFrame) -> DataFrame:
    """Runs of equal words as one row: its number, members, and the least and greatest document and word before."""
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("doc_id", "before") for f in (F.min, F.max)]
    rows = runs.groupBy("digest").agg(F.min("words").alias("words"), F.count("*").alias("members"), *ends)
    return rows.withColumn("run", F.monotonically_increasing_id())


def _joined(column: pa.Array) -> tuple[Words, np.ndarray]:
    """The words of a batch of runs one after another, and where each run begins, with the end."""
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int32, count=len(column) + 1, offset=4 * column.offset).astype(np.int64)
    hashes = np.frombuffer(what.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes(), dtype=np.uint64) if len(column) else np.empty(0, dtype=np.uint64)
    bounds = (offsets - offsets[0]) // 8
    row, none = np.repeat(np.arange(len(column)), np.diff(bounds)), np.empty(0, dtype=np.int64)
    return Words(0, len(column), np.empty(0, dtype=np.uint8), none, none, row, hashes, bounds), bounds


def _windows(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, at, key, a word before, another one) of every window of the distinct runs; the last is null where there is none."""
    for batch in batches:
        words, bounds = _joined(batch["words"])
        at = whole_windows(words, window)
        keys = prefix_sums(words, window)[-1]
        run = words.row[at]
        place = at - bounds[run]
        before = _bits(words.hashes)[at - 1].copy()
        first = place == 0
        low, high = (batch[c].to_numpy(zero_copy_only=False) for c in ("min_before", "max_before"))
        before[first] = low[run[first]]
        other = np.where(first, high[run], 0)
        columns = [batch["run"].to_numpy(zero_copy_only=False)[run], place.astype(np.int32), _bits(keys), before]
        columns = [*map(pa.array, columns), pa.array(other, mask=~first | (other == before))]
        yield pa.RecordBatch.from_arrays(columns, ["run", "at", "key", "lo", "hi"])


def runs_with_starts(distinct: DataFrame, window: int) -> DataFrame:
    """``distinct`` with ``starts``: where windows begin that follow different words in different places."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _windows(window, batches)

    places = distinct.select("run", "words", "min_before", "max_before")
    places = places.mapInArrow(windows, "run long, at int, key long, lo long, hi long")
    varied = places.groupBy("key").agg(F.min("lo").alias("lo"), F.max(F.coalesce("hi", "lo")).alias("hi")).where("lo <> hi").select("key")
    starts = places.join(varied, "key").groupBy("run").agg(F.sort_array(F.collect_list("at")).alias("starts"))
    return distinct.join(starts, "run")


def _suffixes(batch: pa.RecordBatch, window: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(words, run bounds, run of each start, its place in the words, hashes of the prefixes) of a batch of runs."""
    words, bounds = _joined(batch["words"])
    run = np.repeat(np.arange(len(batch)), batch["starts"].value_lengths().to_numpy(zero_copy_only=False))
    start = bounds[run] + batch["starts"].flatten().to_numpy(zero_copy_only=False)
    which = np.searchsorted(whole_windows(words, window), start)
    return words, bounds, run, start, [p[which] for p in prefix_sums(words, window)]


def count_words(runs: DataFrame, window: int, cells: int) -> np.ndarray:
    """Words of suffixes by prefix length and cell of the prefix: a table of fixed size, summed over all runs."""
    levels = len(prefix_lengths(window))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((levels, cells), dtype=np.int64)
        for batch in batches:
            _, bounds, run, start, heads = _suffixes(batch, window)
            for level, hashes in enumerate(heads):
                table[level] += np.bincount(_cells(hashes, cells), bounds[run + 1] - start, cells).astype(np.int64)
        level, cell = np.nonzero(table)
        columns = [pa.array(level.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(table[level, cell])]
        yield pa.RecordBatch.from_arrays(columns, ["level", "cell", "n"])

    rows = runs.select("words", "starts").mapInArrow(count, "level int, cell int, n long")
    table = np.zeros((levels, cells), dtype=np.int64)
    for r in rows.groupBy("level", "cell").agg(F.sum("n").alias("n")).toLocalIterator():
        table[r["level"], r["cell"]] = r["n"]
    return table


_MEMBER = ("run", "members", "min_doc_id", "max_doc_id", "max_before")


def _deal(window: int, partition: Partition, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, blob): a run once for each group that one of its suffixes goes to, from the first such suffix on.

    A blob holds a batch's runs for a group: their words, numbers of words and of suffixes, ``_MEMBER`` columns, and
    each suffix's place and the word before it.
    """
    for batch in batches:
        words, bounds, run, start, heads = _suffixes(batch, window)
        group = partition.of(heads)
        order = np.lexsort((start, run, group))
        group, run, start = group[order], run[order], start[order]
        place = start - bounds[run]
        low = batch["min_before"].to_numpy(zero_copy_only=False)
        before = np.where(place == 0, low[run], _bits(words.hashes)[start - 1])
        member = [batch[c].to_numpy(zero_copy_only=False) for c in _MEMBER]
        for a, b in _spans(group):
            first = a + _runs(run[a:b])
            own, begin = run[first], start[first]
            end = bounds[own + 1]
            text = np.concatenate([words.hashes[x:y] for x, y in zip(begin.tolist(), end.tolist(), strict=True)])
            sizes = smallest(end - begin), smallest(np.diff(np.append(first, b)))
            blob = pack(text, *sizes, *(m[own] for m in member), smallest(place[a:b]), before[a:b])
            yield pa.RecordBatch.from_arrays([pa.array([group[a]], pa.int32()), pa.array([blob], pa.binary())], ["group", "suffixes"])


def _spans(sorted_values: np.ndarray) -> Iterator[tuple[int, int]]:
    starts = _runs(sorted_values).tolist()
    return zip(starts, [*starts[1:], len(sorted_values)][: len(starts)], strict=True)


def ordered_suffixes(words: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of ``starts`` by the words up to each one's end, common prefix of each with the next in that order).

    ``ends`` gives for every word where its run ends.
    """
    n = len(words)
    ranks = [(np.unique(words, return_inverse=True)[1] + 1).astype(np.int32)]
    place, step = np.arange(n), 1
    longest = int((ends - place).max()) if n else 0
    while step < longest:
        here, ahead = ranks[-1], place + step
        inside = ahead < ends
        pair = here.astype(np.int64) * (n + 1)
        pair[inside] += here[ahead[inside]]
        ranks.append((np.unique(pair, return_inverse=True)[1] + 1).astype(np.int32))
        step *= 2
    order = np.argsort(ranks[-1][starts], kind="stable")
    a, b = starts[order][:-1], starts[order][1:]
    common, room = np.zeros(len(a), dtype=np.int64), np.minimum(ends[a] - a, ends[b] - b)
    for level in range(len(ranks) - 1, -1, -1):
        going = np.flatnonzero(common < room)
        same = going[ranks[level][a[going] + common[going]] == ranks[level][b[going] + common[going]]]
        common[same] += 1 << level
    return order, np.minimum(common, room)


def internal_nodes(lengths: list[int], common: list[int], least: int, leaves: list[tuple], covered: list[int]) -> Iterator[tuple]:
    """(first leaf, last leaf, depth, members, least and greatest document, least and greatest word before) of each node.

    ``leaves`` are the ordered suffixes' (members, documents, words before), ``common`` the prefix each shares with
    the next. A suffix whose run has several members is a node itself. ``covered`` receives for each leaf the depth of
    its deepest node with a document before the leaf's own least one.
    """
    open_: list[list] = []  # the last field: the leaves of the node's least document, not covered yet
    for i, leaf in enumerate(leaves):
        ahead = common[i] if i < len(common) and common[i] >= least else 0
        node = [i, i, lengths[i], *leaf, [i]]
        if open_ and open_[-1][2] == lengths[i]:
            _merge(open_[-1], node, covered)
        else:
            open_.append(node)
        while open_ and open_[-1][2] > ahead:
            node = open_.pop()
            yield tuple(node[:-1])
            if open_ and open_[-1][2] >= ahead:
                _merge(open_[-1], node, covered)
            elif ahead:
                node[2] = ahead
                open_.append(node)


def _merge(into: list, node: list, covered: list[int]) -> None:
    if node[4] == into[4]:
        into[8], node[8] = (into[8], node[8]) if len(into[8]) >= len(node[8]) else (node[8], into[8])
        into[8] += node[8]
    else:
        later, into[8] = (node[8], into[8]) if into[4] < node[4] else (into[8], node[8])
        for leaf in later:
            covered[leaf] = into[2]
    into[0], into[1] = min(into[0], node[0]), max(into[1], node[1])
    into[3] += node[3]
    for low in (4, 6):
        into[low], into[low + 1] = min(into[low], node[low]), max(into[low + 1], node[low + 1])


def _tree(window: int, table: pa.Table) -> pa.Table:
    """A group's leaves in order, and the nodes that several documents have and that follow different words."""
    blobs = [unpack(blob.as_buffer()) for blob in table["suffixes"]]
    words, sizes, n, run, members, least, greatest, other, place, before = (np.concatenate(c) for c in zip(*blobs, strict=True))
    blobs.clear()
    stops = np.cumsum(sizes, dtype=np.int64)
    ends = np.repeat(stops, sizes)
    piece = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n, dtype=np.int64) - n
    place = place.astype(np.int64)
    starts = (stops - sizes)[piece] + place - place[first][piece]
    order, common = ordered_suffixes(words, ends, starts)
    of = piece[order]
    place, before = place[order], before[order]
    # The word before a run's first suffix depends on the member.
    after = np.where(place == 0, other[of], before)
    leaves = list(zip(*(c.tolist() for c in (members[of], least[of], greatest[of], before, after)), strict=True))
    group = table["group"][0].as_py()
    lengths = (ends[starts] - starts)[order].tolist()
    covered = [0] * len(order)
    nodes = [x for x in internal_nodes(lengths, common.tolist(), window, leaves, covered) if x[4] != x[5] and x[6] != x[7]]
    lo, hi, depth, count, doc, last, *_ = zip(*nodes, strict=True) if nodes else [()] * 8
    m, k = len(nodes), len(order)
    columns = {
        "node": (pa.bool_(), [True] * m, [False] * k),
        "group": (pa.int32(), [group] * m, [group] * k),
        "first": (pa.int32(), lo, np.arange(k)),
        "last": (pa.int32(), hi, None),
        "run": (pa.int64(), None, run[of]),
        "at": (pa.int32(), None, place),
        "n_words": (pa.int32(), depth, None),
        "n_occurrences": (pa.int64(), count, None),
        "first_doc": (pa.int64(), doc, None),
        "last_doc": (pa.int64(), last, None),
        "covered": (pa.int32(), None, covered),
    }

    def column(kind: pa.DataType, of_nodes: Sequence | None, of_leaves: Sequence | None) -> pa.ChunkedArray:
        halves = ((of_nodes, m), (of_leaves, k))
        return pa.chunked_array([pa.nulls(size, kind) if x is None else pa.array(x, kind) for x, size in halves], kind)

    return pa.table({name: column(*parts) for name, parts in columns.items()})


@dataclass(frozen=True)
class RepeatTrees:
    """Stored suffix trees: nodes as ranges of ordered leaves, leaves as places in distinct runs, runs as places in texts."""

    tree: DataFrame
    members: DataFrame  # (run, length, least_doc, bucket, doc_id, uid, start)

    def repeats(self) -> DataFrame:
        """One row per maximal repeat: repeat_id, n_words, n_occurrences, first_doc and last_doc (a null id is the last)."""
        last = F.when(F.col("last_doc") != int(NO_ID), F.col("last_doc")).alias("last_doc")
        return self.tree.where("node").select(_repeat_id(), "n_words", "n_occurrences", "first_doc", last)

    def occurrences(self, condition: str = "true") -> DataFrame:
        """(repeat_id, doc_id, uid, start, end) of the repeats for which ``condition`` on (n_words, n_occurrences,
        first_doc, last_doc) holds: word ranges in the texts. Nested repeats each list theirs, so this can be much larger
        than the trees."""
        nodes = self.tree.where("node").where(condition).select(_repeat_id(), "group", "n_words", F.explode(F.sequence("first", "last")).alias("first"))
        leaves = self.tree.where("NOT node").select("group", "first", "run", "at")
        places = nodes.join(leaves, ["group", "first"]).join(self.members, "run")
        start = F.col("start") + F.col("at")
        doc = F.when(F.col("doc_id") != int(NO_ID), F.col("doc_id")).alias("doc_id")
        return places.select("repeat_id", doc, "uid", start.alias("start"), (start + F.col("n_words")).alias("end"))


    def known_before(self) -> DataFrame:
        """(bucket, uid, start, end): word ranges that a document with a smaller id has too, the longest from each start.

        Of a run's members all but those of the least document repeat it whole; those repeat what a tree's nodes with
        smaller documents cover.
        """
        later = self.members.where("doc_id > least_doc").selectExpr("bucket", "uid", "start", "start + length AS end")
        leaves = self.tree.where("NOT node AND covered > 0").select("run", "at", "covered")
        least = self.members.where("doc_id = least_doc").join(leaves, "run")
        return later.unionByName(least.selectExpr("bucket", "uid", "start + at AS start", "start + at + covered AS end"))


def _repeat_id() -> Column:
    return F.concat_ws("-", "group", "first", "last", "n_words").alias("repeat_id")


def maximal_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    *,
    group_suffixes: int = GROUP_SUFFIXES,
    group_words: int = GROUP_WORDS,
    cells: int = CELLS,
) -> RepeatTrees:
    """The word sequences of ``window`` words or more that occur in several documents and cannot be made longer.

    Words are what ASCII white space separates. A sequence is maximal if its occurrences do not all follow the same word,
    nor all precede the same; the ends of each text count as words of their own. Rows with one id are one document,
    a null id is an id like another and comes last. Null and short texts have no repeats; an empty table gives none. Only doc_id and text
    are read. A run is held by each group that a suffix of it goes to; a window that begins very many *different* runs
    cannot be split further than by its own words (equal runs are one).
    """
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text").withColumn("uid", F.monotonically_increasing_id())
    rows = stored(rows, "rows")
    return trees_of(rows, buckets_of(rows), window, group_suffixes=group_suffixes, group_words=group_words, cells=cells)


def trees_of(rows: DataFrame, buckets: int, window: int, *, group_suffixes: int, group_words: int, cells: int) -> RepeatTrees:
    """``maximal_repeats`` of stored rows (doc_id long, text, uid)."""
    runs = shared_runs(rows, buckets, window, group_suffixes, cells).withColumn("digest", F.unhex(F.sha2("words", 256)))
    runs = stored(runs, "runs", release=True)
    distinct = stored(distinct_runs(runs), "distinct-runs", release=True)
    started = stored(runs_with_starts(distinct, window), "starts", release=True)
    partition = Partition(count_words(started, window, cells), group_words)
    shared = rows.sparkSession.sparkContext.broadcast(partition)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _deal(window, shared.value, batches)

    def tree(table: pa.Table) -> pa.Table:
        return _tree(window, table)

    trees = started.mapInArrow(deal, "group int, suffixes binary").groupBy("group").applyInArrow(tree, _TREE)
    known = distinct.selectExpr("digest", "run", "cast(length(words) / 8 as int) length", "min_doc_id least_doc")
    members = runs.select("digest", "bucket", "doc_id", "uid", "start").join(known, "digest").drop("digest")
    return RepeatTrees(stored(trees, "trees", release=True), members)
