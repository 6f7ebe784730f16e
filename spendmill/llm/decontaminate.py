"""Benchmark decontamination over a distributed positional inverted index.

The index is a stored table with one row per slice of documents: the slice's terms in order, and for each the
positions at which it occurs. A slice holds all postings of its documents, so position lists are intersected where
they lie and none is shuffled; a term that is in every document costs each slice its own share only.

Queries are blocks of at most ``BLOCK_WINDOWS`` phrases, which bounds what is sent to the tasks; every block is
run against every slice. A phrase starts from the list of its rarest term, shifted by the term's offset, and is
narrowed by the lists of its other terms in order of rarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .packing import pack, smallest, unpack
from .storage import stored
from .words import alphanumeric, word_slices

WINDOW = 10
SLICE_BYTES = 1 << 21
BLOCK_WINDOWS = 100_000
_SLICE = "doc_ids array<long>, n_words array<int>, postings binary"
_FOUND = "slice long, ordinal int, doc_id long, n_words int, hits array<struct<start:int,end:int>>, items array<long>"
_NEAR = "doc_id long, item_id long, start int"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in word_slices(batch["text"], alphanumeric(), SLICE_BYTES):
            # Documents are one position apart, so that no phrase runs from one into the next.
            position = np.arange(len(words.hashes)) + words.row
            order = np.argsort(words.hashes, kind="stable")
            terms, counts = np.unique(words.hashes, return_counts=True)
            steps = np.diff(position[order], prepend=0)
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.empty(0, dtype=np.int64)
            steps[starts] = position[order][starts]
            blob = pack(terms, smallest(counts), smallest(steps))
            ids = batch["doc_id"][words.first : words.first + words.rows].to_pylist()
            columns = [pa.array([ids], pa.list_(pa.int64())), pa.array([words.counts().tolist()], pa.list_(pa.int32())), pa.array([blob])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_ids", "n_words", "postings"])


class Slice:
    """Postings of one slice: ``keys`` are term number and position in one sorted number."""

    def __init__(self, postings: bytes, n_words: list[int]) -> None:
        self.terms, counts, steps = unpack(postings)
        self.counts, steps = counts.astype(np.int64), steps.astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(self.counts)])
        total = np.cumsum(steps)
        before = np.concatenate([[0], total])[starts[:-1]]
        self.positions = total - np.repeat(before, self.counts)
        self.starts = starts
        self.keys = (np.repeat(np.arange(len(self.terms)), self.counts) << 32) | self.positions
        self.n_words = np.array(n_words, dtype=np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.n_words + 1)])  # of documents, one position apart

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(term numbers, whether the slice has the term)."""
        if not len(self.terms):
            return np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=bool)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return at, self.terms[at] == hashes

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = (term << 32) | position
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (position >= 0) & (self.keys[at] == key)

    def anchors(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``term``, position) of every posting of the given terms."""
        n = self.counts[term]
        which = np.repeat(np.arange(len(term)), n)
        within = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return which, self.positions[self.starts[term][which] + within]

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, position, side="right") - 1


@dataclass
class Phrases:
    """A block of phrases of one length: rows of indexes into the block's terms, and the items they come from."""

    terms: np.ndarray
    windows: np.ndarray
    items: np.ndarray
    no_id: np.ndarray  # whether the item's id is null (``items`` is 0 there)

    def in_slice(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """(phrases all of whose terms the slice has, their term numbers in order of the phrase)."""
        at, there = part.look_up(self.terms)
        which = np.flatnonzero(there[self.windows].all(axis=1))
        return which, at[self.windows[which]]

    def exact(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, position) of every occurrence."""
        which, terms = self.in_slice(part)
        if not len(which):
            return which, which
        rarity = np.argsort(part.counts[terms], axis=1, kind="stable")
        near, start = part.anchors(np.take_along_axis(terms, rarity[:, :1], axis=1)[:, 0])
        start = start - rarity[near, 0]
        for k in range(1, terms.shape[1]):
            offset = rarity[near, k]
            stay = part.has(terms[near, offset], start + offset)
            near, start = near[stay], start[stay]
        stay = start >= 0
        return which[near[stay]], start[stay]

    def close(self, part: Slice, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, position of its first word) of every stretch of length + ``slop`` words of one document that
        begins with a term of the phrase and holds all its terms, in any order."""
        which, terms = self.in_slice(part)
        if not len(which):
            return which, which
        width = terms.shape[1] + slop
        rarest = np.argmin(part.counts[terms], axis=1)
        near, anchor = part.anchors(terms[np.arange(len(which)), rarest])
        back = np.arange(width)
        near, start = np.repeat(near, width), (anchor[:, None] - back).ravel()
        document = np.repeat(part.document(anchor), width)
        stay = start >= part.begins[document]
        near, start, document = near[stay], start[stay], document[stay]
        last = np.minimum(start + width, part.begins[document + 1] - 1) - 1
        first_word = np.zeros(len(start), dtype=bool)
        for k in range(terms.shape[1]):
            term = terms[near, k]
            at = np.minimum(np.searchsorted(part.keys, (term << 32) | start), len(part.keys) - 1)
            stay = (part.keys[at] >= (term << 32) | start) & (part.keys[at] <= (term << 32) | last)
            first_word |= part.keys[at] == (term << 32) | start
            near, start, last, first_word = near[stay], start[stay], last[stay], first_word[stay]
        found = np.unique(np.stack([which[near[first_word]], start[first_word]], axis=1), axis=0)
        return found[:, 0], found[:, 1]


@dataclass
class Block:
    """Phrases of the benchmark items that are run in one pass."""

    phrases: list[Phrases] = field(default_factory=list)

    @staticmethod
    def of(hashes: dict[int, list[np.ndarray]]) -> Block:
        """From (length -> rows of whether the item's id is null, item id and hashes)."""
        block = Block()
        for rows in hashes.values():
            table = np.stack(rows)
            terms, windows = np.unique(table[:, 2:], return_inverse=True)
            block.phrases.append(Phrases(terms, windows.reshape(len(rows), -1), table[:, 1].view(np.int64), table[:, 0] > 0))
        return block


def query_blocks(items: DataFrame, window: int, block_windows: int = BLOCK_WINDOWS, null_ids: bool = False) -> Iterator[Block]:
    """Distinct phrases of the items, block by block; no more than a block is held by the driver."""
    held: dict[int, dict[bytes, np.ndarray]] = {}
    rows = items.selectExpr("cast(item_id as long) item_id", "text", "item_id is null no_id")
    rows = rows if null_ids else rows.where("not no_id")
    for row in rows.toLocalIterator():
        for words in word_slices(pa.array([row["text"]], pa.string()), alphanumeric()):
            length = min(window, len(words.hashes))
            for i in range(len(words.hashes) - length + 1 if length else 0):
                item = np.array([row["no_id"], row["item_id"] or 0], dtype=np.int64).view(np.uint64)
                phrase = np.concatenate([item, words.hashes[i : i + length]])
                held.setdefault(length, {})[phrase.tobytes()] = phrase
        if sum(map(len, held.values())) >= block_windows:
            yield Block.of({k: list(v.values()) for k, v in held.items()})
            held = {}
    if held:
        yield Block.of({k: list(v.values()) for k, v in held.items()})


def _find(block: Block, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            part = Slice(row["postings"], row["n_words"])
            size = int(part.begins[-1]) + 1
            covered = np.zeros(size + 1, dtype=np.int64)
            pairs = []
            for phrases in block.phrases:
                phrase, start = phrases.exact(part)
                np.add.at(covered, start, 1)
                np.add.at(covered, start + phrases.windows.shape[1], -1)
                pairs.append(np.stack([part.document(start), phrases.no_id[phrase], phrases.items[phrase]], axis=1))
            inside = np.diff((np.cumsum(covered) > 0).astype(np.int8), prepend=0)
            starts, ends = np.flatnonzero(inside == 1), np.flatnonzero(inside == -1)
            n = len(row["doc_ids"])
            hits, items = [[] for _ in range(n)], [[] for _ in range(n)]
            for d, lo, hi in zip(part.document(starts).tolist(), starts.tolist(), ends.tolist(), strict=True):
                first = int(part.begins[d])
                hits[d].append({"start": lo - first, "end": hi - first})
            for d, no_id, item in np.unique(np.concatenate(pairs), axis=0).tolist() if pairs else ():
                items[d].append(None if no_id else item)
            spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            columns = [pa.array([row["slice"]] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(row["doc_ids"], pa.int64())]
            columns += [pa.array(row["n_words"], pa.int32()), pa.array(hits, spans), pa.array(items, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["slice", "ordinal", "doc_id", "n_words", "hits", "items"])


def _find_close(block: Block, slop: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            part = Slice(row["postings"], row["n_words"])
            for phrases in block.phrases:
                phrase, start = phrases.close(part, slop)
                document = part.document(start)
                ids = pa.array([row["doc_ids"][d] for d in document.tolist()], pa.int64())
                columns = [ids, pa.array(phrases.items[phrase], mask=phrases.no_id[phrase]), pa.array((start - part.begins[document]).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "start"])


class PositionalIndex:
    """Postings of all words of all documents; built once, queried with any number of benchmarks."""

    def __init__(self, slices: DataFrame) -> None:
        self.slices = slices

    @staticmethod
    def build(docs: DataFrame) -> PositionalIndex:
        """Index (doc_id, text) of every row; null texts have no words. Rows may repeat, ids may be null."""
        rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
        slices = rows.mapInArrow(_index, _SLICE).withColumn("slice", F.monotonically_increasing_id())
        return PositionalIndex(stored(slices, "postings"))

    def _run(self, function, block: Block, schema: str, *more: object) -> DataFrame:
        shared = self.slices.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return function(shared.value, *more, batches)

        return self.slices.mapInArrow(run, schema)

    def phrases(self, items: DataFrame, window: int = WINDOW, *, block_windows: int = BLOCK_WINDOWS, null_ids: bool = False) -> DataFrame:
        """One row per document: slice, ordinal, doc_id, n_words, hits (word ranges that phrases cover), items.

        A phrase is ``window`` consecutive words of an item; an item of fewer words is one phrase, one without
        words is none. Items with a null id are searched with ``null_ids`` only; they are one null among a document's
        items.
        """
        parts = [self._run(_find, b, _FOUND) for b in query_blocks(items, window, block_windows, null_ids)]
        if len(parts) <= 1:
            return parts[0] if parts else self._run(_find, Block(), _FOUND)
        all_parts = parts[0]
        for part in parts[1:]:
            all_parts = all_parts.union(part)
        merged = {c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))) for c in ("hits", "items")}
        return all_parts.groupBy("slice", "ordinal").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), *(v.alias(k) for k, v in merged.items()))

    def close(self, items: DataFrame, window: int = WINDOW, slop: int = 5, *, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
        """(doc_id, item_id, start) of every stretch of ``window + slop`` words with all words of a phrase, in any
        order, that begins with one of them."""
        parts = [self._run(_find_close, b, _NEAR, slop) for b in query_blocks(items, window, block_windows)]
        found = self._run(_find_close, Block(), _NEAR, slop)
        for part in parts:
            found = found.union(part)
        return found.distinct()


def covered_words(hits: Column) -> Column:
    """Number of words in the union of ranges that are sorted by start."""
    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("upto"))

    def add(so_far: Column, hit: Column) -> Column:
        more = F.greatest(F.lit(0), hit["end"] - F.greatest(so_far["upto"], hit["start"])).cast("long")
        return F.struct((so_far["total"] + more).alias("total"), F.greatest(so_far["upto"], hit["end"]).alias("upto"))

    return F.aggregate(hits, zero, add, lambda x: x["total"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hits.

    ``items`` has item_id and text; other columns of either table are not read. Empty tables are allowed: without
    items nothing is contaminated. The words of items with a null id count as any other's; all such items together
    are one in n_items and have no name in items_sha256, the digest of the ids as text in their order.
    """
    found = PositionalIndex.build(docs).phrases(items, window, null_ids=True)
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        covered_words(F.col("hits")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        "hits",
    )
