"""Substring deduplication: words of repeats that a document with a smaller id has too are removed.

The repeats come from prefix-partitioned suffix trees (``suffix_trees``): a leaf is covered as far as its deepest
internal node with a smaller document goes. Two repeats that follow each other directly stay two ranges.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import unpack
from .shared_windows import BYTES_PER_BUCKET, CELLS, DOCUMENTS_PER_BUCKET, GROUP_SUFFIXES, WINDOW
from .storage import stored
from .suffix_trees import GROUP_WORDS, buckets_of, packed, trees_of


def longest_ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The ranges (start, end) that lie in no other, in order."""
    order = np.lexsort((-ends, starts))
    ranges = np.stack([starts[order], ends[order]], axis=1)
    reached = np.maximum.accumulate(ranges[:, 1])
    return ranges[np.concatenate([[True], ranges[1:, 1] > reached[:-1]])]


def _cut_bucket(digest: bool, docs: pa.Table, ranges: pa.Table) -> pa.Table:
    """The rows of a bucket without the words of ``ranges`` (uid, start, end)."""
    uid, starts, ends = (ranges[c].to_numpy() for c in ("uid", "start", "end"))
    order = np.argsort(uid, kind="stable")
    numbers, first = np.unique(uid[order], return_index=True)
    of_row = dict(zip(numbers.tolist(), np.split(order, first[1:]), strict=True)) if len(order) else {}
    rows: list[tuple] = []
    for blob in docs["texts"]:
        uids, ids, known, sizes, data = unpack(blob.as_buffer())
        text_ends = np.cumsum(sizes)
        for row, (a, b) in enumerate(zip((text_ends - sizes).tolist(), text_ends.tolist(), strict=True)):
            words = data[a:b].tobytes().split()
            kept, spans = words, np.empty((0, 2), dtype=np.int64)
            mine = of_row.get(int(uids[row]))
            if mine is not None:
                spans = longest_ranges(starts[mine], ends[mine])
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(edges, spans[:, 0], 1)
                np.subtract.at(edges, spans[:, 1], 1)
                kept = list(compress(words, (np.cumsum(edges)[:-1] == 0).tolist()))
            text = b" ".join(kept)
            what = (hashlib.sha256(text).hexdigest(),) if digest else (text.decode(), [{"start": x, "end": y} for x, y in spans.tolist()])
            rows.append((int(ids[row]) if known[row] else None, len(words), len(words) - len(kept), *what))
    kinds = [pa.int64()] * 3 + [pa.string()] + [pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))] * (not digest)
    names = ["doc_id", "n_words", "n_removed", *(["kept_sha256"] if digest else ["kept", "repeats"])]
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    *,
    group_suffixes: int = GROUP_SUFFIXES,
    group_words: int = GROUP_WORDS,
    cells: int = CELLS,
    documents_per_bucket: int = DOCUMENTS_PER_BUCKET,
    bytes_per_bucket: int = BYTES_PER_BUCKET,
    digest: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, the kept text and the removed repeats as word ranges.

    With ``digest`` the text's SHA-256 is returned in place of text and ranges. Words are what ASCII white space
    separates. A sequence of ``window`` words or more is removed if a document with a smaller id has it (a null id is
    larger than all; rows with one id do not repeat each other). Null texts have no words; an empty table gives no row.
    Only doc_id and text are read. Rows are stored with a number each; texts and ranges meet in buckets of numbers.
    """
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text").withColumn("uid", F.monotonically_increasing_id())
    rows = stored(rows, "rows")
    buckets = buckets_of(rows, documents_per_bucket, bytes_per_bucket)
    trees = trees_of(rows, buckets, window, group_suffixes=group_suffixes, group_words=group_words, cells=cells)

    def cut(texts: pa.Table, ranges: pa.Table) -> pa.Table:
        return _cut_bucket(digest, texts, ranges)

    kept = "kept_sha256 string" if digest else "kept string, repeats array<struct<start:int,end:int>>"
    schema = f"doc_id long, n_words long, n_removed long, {kept}"
    ranges = trees.known_before().groupBy("bucket")
    return packed(rows, buckets).groupBy("bucket").cogroup(ranges).applyInArrow(cut, schema)
