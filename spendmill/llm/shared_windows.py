"""Windows of words that several documents have, found in groups of suffixes partitioned by prefixes.

A suffix starts at every word that begins a whole window of ``WINDOW`` words. Suffixes are dealt to groups by a
prefix of theirs, one word long where that prefix is rare enough for memory and 2, 4, 8 or ``WINDOW`` words long
where it is not; suffixes that share a window share their group. A group compares the hashes of its windows: those
of several documents are shared. This is the suffix trees' upper part; ``suffix_trees`` goes on from the shared windows.

Windows are 64-bit hashes inside a group that another hash chose. A task sends each window of a slice once, with the
rows of the slice's least and greatest document; the slice's documents are known to share it, however many they are.
Rows are numbered, and texts and flags meet in buckets of row numbers: rows with null or repeated ids spread like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import pack, smallest, unpack
from .words import Words, extend, mix, text_buffers, visible, whole_windows, word_slices

WINDOW = 13
GROUP_SUFFIXES = 1_500_000
CELLS = 1 << 14
SLICE_BYTES = 1 << 21
DOCUMENTS_PER_BUCKET = 2_000
BYTES_PER_BUCKET = 1 << 25
NO_ID = np.iinfo(np.int64).max  # stands for a null id: it comes after every other
_SALT = np.uint64(0xA0761D6478BD642F)


def prefix_lengths(window: int) -> list[int]:
    return [n for n in (1, 2, 4, 8, 16, 32, 64) if n < window] + [window]


def prefix_sums(words: Words, window: int) -> list[np.ndarray]:
    """Hashes of the prefixes of every suffix that has ``window`` words, by ``prefix_lengths``."""
    at = whole_windows(words, window)
    lengths = prefix_lengths(window)
    sums, power = {1: words.hashes}, 1
    while 2 * power <= window:
        sums[2 * power] = extend(sums[power], sums[power], power)
        power *= 2
    if window not in sums:
        total, have = sums[power], power
        while have < window:
            power //= 2
            if have + power <= window:
                total, have = extend(total, sums[power], have), have + power
        sums[window] = total
    return [mix(sums[n][at]) for n in lengths]


def _cells(hashes: np.ndarray, cells: int) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) & (cells - 1)


class Partition:
    """Which prefix length a suffix goes by, and its group."""

    def __init__(self, counts: np.ndarray, group_suffixes: int) -> None:
        """From the number of suffixes by (prefix length, cell of the prefix's hash)."""
        self.heavy = counts > group_suffixes
        self.heavy[-1] = False
        self.cells = counts.shape[1]
        # A bound on what is left for each length: every suffix in a heavy cell of the length before.
        upper = [counts[0].sum(), *(counts[i][self.heavy[i]].sum() for i in range(len(counts) - 1))]
        self.groups = np.array([max(1, -(-int(n) // group_suffixes)) for n in upper])
        self.first = np.concatenate([[0], np.cumsum(self.groups)])

    def of(self, prefixes: list[np.ndarray]) -> np.ndarray:
        group = np.full(len(prefixes[0]), -1, dtype=np.int64)
        left = np.arange(len(group))
        for level, hashes in enumerate(prefixes):
            rest = hashes[left]
            heavy = self.heavy[level][_cells(rest, self.cells)]
            mine = left[~heavy]
            spread = mix(rest[~heavy] ^ _SALT) % np.uint64(self.groups[level])
            group[mine] = self.first[level] + spread.astype(np.int64)
            left = left[heavy]
        return group


def count_prefixes(docs: DataFrame, window: int, cells: int) -> np.ndarray:
    """Suffixes by prefix length and cell: a table of fixed size, summed over all documents."""
    levels = len(prefix_lengths(window))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((levels, cells), dtype=np.int64)
        for batch in batches:
            for words in word_slices(batch["text"], visible(), SLICE_BYTES):
                for level, hashes in enumerate(prefix_sums(words, window)):
                    table[level] += np.bincount(_cells(hashes, cells), minlength=cells)
        level, cell = np.nonzero(table)
        columns = [pa.array(level.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(table[level, cell])]
        yield pa.RecordBatch.from_arrays(columns, ["level", "cell", "n"])

    rows = docs.select("text").mapInArrow(count, "level int, cell int, n long").groupBy("level", "cell").agg(F.sum("n").alias("n"))
    table = np.zeros((levels, cells), dtype=np.int64)
    for r in rows.toLocalIterator():
        table[r["level"], r["cell"]] = r["n"]
    return table


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])) if len(sorted_values) else np.empty(0, dtype=np.int64)


def _shared(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by key, whether an entry's key has several documents, whether its document is the least or greatest)."""
    order = np.argsort(keys, kind="stable")
    starts = _runs(keys[order])
    if not len(starts):
        return order, np.empty(0, dtype=bool), np.empty(0, dtype=bool)
    size, docs = np.diff(np.append(starts, len(keys))), docs[order]
    least, greatest = (np.repeat(f.reduceat(docs, starts), size) for f in (np.minimum, np.maximum))
    return order, least != greatest, (docs == least) | (docs == greatest)


def _bucket(rows: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(rows.astype(np.uint64) ^ _SALT) % np.uint64(buckets)).astype(np.int64)


def _by(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, where it is) for each distinct value."""
    order = np.argsort(values, kind="stable")
    starts = _runs(values[order])
    for lo, hi in zip(starts, np.append(starts[1:], len(order))[: len(starts)], strict=True):
        yield int(values[order[lo]]), order[lo:hi]


def _flag_rows(rows: np.ndarray, keys: np.ndarray, buckets: int) -> tuple[list[int], list[bytes]]:
    """(buckets, blobs of row numbers with the keys of their shared windows)."""
    numbers, blobs = [], []
    for bucket, mine in _by(_bucket(rows, buckets)):
        mine = mine[np.lexsort((keys[mine], rows[mine]))]
        starts = _runs(rows[mine])
        numbers.append(bucket)
        blobs.append(pack(rows[mine][starts], smallest(np.diff(np.append(starts, len(mine)))), keys[mine]))
    return numbers, blobs


def _suffixes(partition: Partition, window: int, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, blob of suffixes) and, under any group, (bucket, blob of windows shared inside a slice)."""
    last_group = int(partition.first[-1])
    for batch in batches:
        for words in word_slices(batch["text"], visible(), SLICE_BYTES):
            at = whole_windows(words, window)
            if not len(at):
                continue
            own_rows = slice(words.first, words.first + words.rows)
            ids = batch["doc_id"].fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)[own_rows]
            uids = batch["uid"].to_numpy(zero_copy_only=False)[own_rows]
            prefixes = prefix_sums(words, window)
            group, keys = partition.of(prefixes), prefixes[-1]
            docs = ids[words.row[at]]
            order, told, outer = _shared(keys, docs)
            sorted_keys, sorted_rows = keys[order], words.row[at][order]
            # A row that has a window several times stands for it once.
            again = (np.diff(sorted_rows, prepend=-1) == 0) & (np.diff(sorted_keys, prepend=np.uint64(0)) == 0)
            kept = np.flatnonzero(outer & ~again)
            kept_keys, kept_rows, kept_group = sorted_keys[kept], sorted_rows[kept], group[order][kept]
            by_group = np.argsort(kept_group, kind="stable")  # within a group by key
            bounds = _runs(kept_group[by_group])
            groups, blobs = [], []
            for lo, hi in zip(bounds, np.append(bounds[1:], len(by_group)), strict=True):
                own = by_group[lo:hi]
                table, which = np.unique(kept_rows[own], return_inverse=True)
                blobs.append(pack(np.diff(kept_keys[own], prepend=np.uint64(0)), uids[table], ids[table], smallest(which)))
                groups.append(int(kept_group[own[0]]))
            told &= ~again
            numbers, flags = _flag_rows(uids[sorted_rows[told]], sorted_keys[told], buckets)
            n, m = len(groups), len(flags)
            spread = [(words.first + i) * 7919 % last_group for i in range(m)]
            columns = [pa.array(groups + spread, pa.int32()), pa.array(blobs + [None] * m, pa.binary())]
            columns += [pa.array([None] * n + numbers, pa.int32()), pa.array([None] * n + flags, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["group", "suffixes", "bucket", "flags"])


def _group(table: pa.Table, buckets: int) -> pa.Table:
    """(bucket, blob of windows that another document has) of a group's suffixes, and the rows known before."""
    keys, docs, rows = [np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    for blob in table["suffixes"]:
        if blob.is_valid:
            steps, uids, ids, which = unpack(blob.as_buffer())
            keys.append(np.cumsum(steps))
            docs.append(ids[which])
            rows.append(uids[which])
    keys, docs, rows = np.concatenate(keys), np.concatenate(docs), np.concatenate(rows)
    order, told, _ = _shared(keys, docs)
    numbers, flags = _flag_rows(rows[order][told], keys[order][told], buckets)
    known = table.filter(table["flags"].is_valid()).select(["bucket", "flags"])
    found = pa.table({"bucket": pa.array(numbers, pa.int32()), "flags": pa.array(flags, pa.binary())})
    return pa.concat_tables([known, found])


def shared_windows(docs: DataFrame, buckets: int, window: int = WINDOW, *, group_suffixes: int = GROUP_SUFFIXES, cells: int = CELLS) -> DataFrame:
    """(bucket, flags): by bucket of rows, the hashes of windows that another document has too.

    ``docs`` has doc_id, text and uid, a stored number of each row.
    """
    partition = Partition(count_prefixes(docs, window, cells), group_suffixes)
    shared = docs.sparkSession.sparkContext.broadcast(partition)

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _suffixes(shared.value, window, buckets, batches)

    def group(table: pa.Table) -> pa.Table:
        return _group(table, buckets)

    dealt = docs.mapInArrow(suffixes, "group int, suffixes binary, bucket int, flags binary")
    return dealt.groupBy("group").applyInArrow(group, "bucket int, flags binary")


def pack_texts(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, blob of row numbers, ids and texts): compressed together, texts take half of what a shuffle makes of them."""
    for batch in batches:
        uids, known = batch["uid"].to_numpy(zero_copy_only=False), batch["doc_id"].is_valid().to_numpy(zero_copy_only=False)
        ids = batch["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)
        for bucket, mine in _by(_bucket(uids, buckets)):
            data, offsets = text_buffers(batch["text"].take(pa.array(mine)))
            blob = pack(uids[mine], ids[mine], known[mine].astype(np.uint8), np.diff(offsets), data, level=3)
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([blob], pa.binary())], ["bucket", "texts"])
