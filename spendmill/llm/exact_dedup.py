"""Exact deduplication over a cuckoo-filter index of live digests.

The digests are dealt to index buckets by their leading bytes. Each bucket owns a cuckoo filter and the keys
behind it: a filter miss proves a digest new, a hit is verified against the bucket's keys, and a filter that
overflows is rebuilt larger from those keys. Buckets are rows of a stored table, so the index takes later
batches of insertions and deletions, and a lost executor only repeats its buckets.

Copies are combined before they are shuffled (one row per digest and task), so a digest with a third of all
rows costs its bucket no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import stored

SLOTS = 4
LOAD = 0.9
KICKS = 500
KEYS_PER_BUCKET = 200_000
COMBINE = 50_000
NO_ID = np.iinfo(np.int64).max  # stands for a null id: it comes after every other

_GROUP = "digest binary, keep_id long, n_cp long, group_size long"
_STATE = "bucket int, slots binary, keys binary, ids binary, lengths binary, copies binary"


class CuckooFilter:
    """16-bit fingerprints in buckets of four; every key has two buckets. Vectorised over arrays of 64-bit keys.

    ``insert`` returns False on overflow and then leaves a table that must be rebuilt from the keys.
    The same key may be inserted more than once and is deleted as often.
    """

    def __init__(self, capacity: int = 64, table: np.ndarray | None = None) -> None:
        rows = 1 << max(3, int(capacity / (SLOTS * LOAD)).bit_length())
        self.table = np.zeros((rows, SLOTS), dtype=np.uint16) if table is None else table

    @property
    def capacity(self) -> int:
        return int(self.table.size * LOAD)

    def _place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = (keys >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (keys & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, at: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return at ^ ((prints.astype(np.int64) * 0x5BD1E995) & (len(self.table) - 1))

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, at = self._place(keys)
        other = self._other(at, prints)
        return ((self.table[at] == prints[:, None]) | (self.table[other] == prints[:, None])).any(axis=1)

    def _fill(self, prints: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Put what finds a free slot of bucket ``at``; True where it did."""
        order = np.argsort(at, kind="stable")
        sorted_at = at[order]
        rank = np.arange(len(at)) - np.searchsorted(sorted_at, sorted_at)
        free = self.table[sorted_at] == 0
        fits = rank < free.sum(axis=1)
        slot = np.argmax(np.cumsum(free, axis=1) == (rank + 1)[:, None], axis=1)
        self.table[sorted_at[fits], slot[fits]] = prints[order][fits]
        done = np.zeros(len(at), dtype=bool)
        done[order[fits]] = True
        return done

    def insert(self, keys: np.ndarray) -> bool:
        prints, at = self._place(keys)
        for _ in range(2):  # first bucket, then the other
            left = ~self._fill(prints, at)
            prints, at = prints[left], self._other(at[left], prints[left])
        for mark, spot in zip(prints.tolist(), at.tolist(), strict=True):
            for kick in range(KICKS):
                row = self.table[spot]
                empty = np.flatnonzero(row == 0)
                if len(empty):
                    row[empty[0]] = mark
                    break
                mark, row[kick % SLOTS] = int(row[kick % SLOTS]), mark
                spot = int(self._other(np.array([spot]), np.array([mark], dtype=np.uint16))[0])
            else:
                return False
        return True

    def delete(self, keys: np.ndarray) -> None:
        """Take out one fingerprint of each key; only keys that were inserted may be deleted."""
        prints, at = self._place(keys)
        for mark, one, two in zip(prints, at, self._other(at, prints), strict=True):
            row = self.table[one] if (self.table[one] == mark).any() else self.table[two]
            row[np.flatnonzero(row == mark)[0]] = 0


class Bucket:
    """One index bucket: the filter, and for each live digest its survivor's id and length and its copies."""

    def __init__(self, keys=b"", ids=b"", lengths=b"", copies=b"", slots: bytes | None = None) -> None:
        self.keys = np.frombuffer(keys, dtype="V32").copy()
        self.ids, self.lengths, self.copies = (np.frombuffer(x, dtype=np.int64).copy() for x in (ids, lengths, copies))
        self.resized = 0
        self._sort()
        if slots is None:
            self._rebuild(len(self.keys))
        else:
            self.filter = CuckooFilter(table=np.frombuffer(slots, dtype=np.uint16).reshape(-1, SLOTS).copy())

    def _sort(self) -> None:
        """Lookups go by the first eight bytes; ties are settled on all 32."""
        heads = _heads(self.keys)
        self.order = np.argsort(heads, kind="stable")
        self.heads = heads[self.order]

    def _rebuild(self, room: int) -> None:
        self.filter = CuckooFilter(room)
        while not self.filter.insert(_prints(self.keys)):
            self.resized += 1
            self.filter = CuckooFilter(2 * self.filter.capacity)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each digest among the stored ones, -1 where a filter hit proves false or there is none."""
        found = np.full(len(keys), -1)
        hits = np.flatnonzero(self.filter.contains(_prints(keys)))
        spot = np.searchsorted(self.heads, _heads(keys[hits]))
        pending = np.ones(len(hits), dtype=bool)
        while pending.any():
            pending &= spot < len(self.heads)
            pending[pending] = self.heads[spot[pending]] == _heads(keys[hits[pending]])
            where = self.order[np.minimum(spot, len(self.order) - 1)] if len(self.order) else spot
            same = pending.copy()
            same[pending] = self.keys[where[pending]] == keys[hits[pending]]
            found[hits[same]] = where[same]
            pending &= ~same
            spot[pending] += 1
        return found

    def insert(self, keys: np.ndarray, ids: np.ndarray, lengths: np.ndarray, copies: np.ndarray) -> np.ndarray:
        """Add distinct digests or further copies of live ones; True where the digest was live before."""
        at = self.find(keys)
        old, new = at >= 0, at < 0
        hit = at[old]
        better = (lengths[old] > self.lengths[hit]) | ((lengths[old] == self.lengths[hit]) & (ids[old] < self.ids[hit]))
        self.ids[hit] = np.where(better, ids[old], self.ids[hit])
        self.lengths[hit] = np.where(better, lengths[old], self.lengths[hit])
        self.copies[hit] += copies[old]
        if new.any():
            self.keys = np.concatenate([self.keys, keys[new]])
            self.ids = np.concatenate([self.ids, ids[new]])
            self.lengths = np.concatenate([self.lengths, lengths[new]])
            self.copies = np.concatenate([self.copies, copies[new]])
            self._sort()
            if len(self.keys) > self.filter.capacity or not self.filter.insert(_prints(keys[new])):
                self.resized += 1
                self._rebuild(2 * len(self.keys))
        return old

    def delete(self, keys: np.ndarray) -> np.ndarray:
        """Remove distinct digests; True where the digest was live."""
        at = self.find(keys)
        live = at >= 0
        self.filter.delete(_prints(keys[live]))
        stay = np.ones(len(self.keys), dtype=bool)
        stay[at[live]] = False
        self.keys, self.ids, self.lengths, self.copies = (
            x[stay] for x in (self.keys, self.ids, self.lengths, self.copies)
        )
        self._sort()
        return live

    def row(self, number: int) -> dict:
        parts = {"slots": self.filter.table, "keys": self.keys, "ids": self.ids}
        parts |= {"lengths": self.lengths, "copies": self.copies}
        return {"bucket": number} | {k: v.tobytes() for k, v in parts.items()}


def _heads(keys: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(keys).view(">u8").reshape(-1, 4)[:, 0].astype(np.uint64)


def _prints(keys: np.ndarray) -> np.ndarray:
    """Filter keys: other bytes of the digest than those that chose the index bucket."""
    return np.ascontiguousarray(keys).view("<u8").reshape(-1, 4)[:, 1]


def _digest_array(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, where, what = column.buffers()
    lo, hi = np.frombuffer(where, dtype=np.int32, count=len(column) + 1, offset=4 * column.offset)[[0, -1]]
    return np.frombuffer(what, dtype=np.uint8)[lo:hi].view("V32") if hi > lo else np.empty(0, dtype="V32")


def _combine(keys: np.ndarray, ids: np.ndarray, lengths: np.ndarray, copies: np.ndarray) -> tuple:
    """One entry per digest: the longest original, then the smallest id, and the sum of copies."""
    words = keys.view(">u8").reshape(-1, 4)
    order = np.lexsort((ids, -lengths, words[:, 3], words[:, 2], words[:, 1], words[:, 0]))
    keys, words = keys[order], words[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = (words[1:] != words[:-1]).any(axis=1)
    starts = np.flatnonzero(first)
    return keys[starts], ids[order][starts], lengths[order][starts], np.add.reduceat(copies[order], starts)


def _columns(table: pa.Table | pa.RecordBatch) -> tuple:
    ids = table["keep_id"].fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
    others = (table[c].to_numpy(zero_copy_only=False) for c in ("n_cp", "group_size"))
    return (_digest_array(table["digest"]), ids, *others)


def _group_batch(keys: np.ndarray, ids: np.ndarray, lengths: np.ndarray, copies: np.ndarray) -> pa.Table:
    keys = np.ascontiguousarray(keys)
    offsets = pa.py_buffer(np.arange(0, 32 * len(keys) + 1, 32, dtype=np.int32).tobytes())
    digest = pa.Array.from_buffers(pa.binary(), len(keys), [None, offsets, pa.py_buffer(keys.tobytes())])
    owners = pa.array(ids, pa.int64(), mask=ids == NO_ID)
    return pa.table({"digest": digest, "keep_id": owners, "n_cp": lengths, "group_size": copies})


def _combine_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's copies of a digest become one row; at most ``COMBINE`` digests more than a batch are held."""
    held = None
    for batch in batches:
        if batch.num_rows:
            new = _columns(batch)
            held = _combine(*new if held is None else (np.concatenate(x) for x in zip(held, new, strict=True)))
            if len(held[0]) >= COMBINE:
                yield from _group_batch(*held).to_batches()
                held = None
    if held is not None:
        yield from _group_batch(*held).to_batches()


def _index_bucket(table: pa.Table) -> pa.Table:
    """Insert a bucket's rows batch by batch into its filter; the live digests with their survivors."""
    bucket = Bucket()
    for batch in table.to_batches():
        if batch.num_rows:
            bucket.insert(*_combine(*_columns(batch)))
    return _group_batch(bucket.keys, bucket.ids, bucket.lengths, bucket.copies)


def _change_bucket(change: str, key: tuple, incoming: pa.Table, state: pa.Table) -> pa.Table:
    number = key[0].as_py()
    bucket = Bucket(**{k: v for k, v in state.to_pylist()[0].items() if k != "bucket"}) if state.num_rows else Bucket()
    live = np.empty(0, dtype=bool)
    rows = _combine(*_columns(incoming)) if incoming.num_rows else None
    if rows is not None:
        live = bucket.insert(*rows) if change == "insert" else bucket.delete(rows[0])
    new_state = pa.Table.from_pylist([bucket.row(number) | {"digest": None, "was_live": None}])
    answers = [{"bucket": number, "digest": d.tobytes(), "was_live": bool(x)} for d, x in zip(rows[0] if rows else [], live, strict=True)]
    schema = pa.schema(
        [("bucket", pa.int32()), *((c, pa.binary()) for c in ("slots", "keys", "ids", "lengths", "copies", "digest")), ("was_live", pa.bool_())]
    )
    none = dict.fromkeys(schema.names)
    return pa.Table.from_pylist([none | x for x in new_state.to_pylist() + answers], schema=schema)


class LiveDigests:
    """The stored index: insert, delete and look up digests in batches; each change writes a new generation.

    Batches are frames with ``digest`` (32 bytes), ``id`` and ``n_cp``; null digests are left out. ``insert`` and
    ``delete`` return ``(digest, was_live)`` per distinct digest. ``rows()`` gives the live digests.
    """

    def __init__(self, spark: SparkSession, buckets: int = 16) -> None:
        self.spark, self.buckets = spark, buckets
        self.state = spark.createDataFrame([], _STATE)

    def _apply(self, change: str, batch: DataFrame) -> DataFrame:
        batch = batch.where(F.col("digest").isNotNull())
        rows = combined_copies(batch).withColumn("bucket", bucket_of(F.col("digest"), self.buckets))
        out = stored(
            rows.groupBy("bucket").cogroup(self.state.groupBy("bucket")).applyInArrow(
                partial(_change_bucket, change), f"{_STATE}, digest binary, was_live boolean"
            ),
            "cuckoo",
        )
        self.state = out.where("slots is not null").drop("digest", "was_live")
        return out.where("slots is null").select("digest", "was_live")

    def insert(self, batch: DataFrame) -> DataFrame:
        return self._apply("insert", batch)

    def delete(self, batch: DataFrame) -> DataFrame:
        return self._apply("delete", batch)

    def rows(self) -> DataFrame:
        def live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    bucket = Bucket(**{k: v for k, v in row.items() if k != "bucket"})
                    yield from _group_batch(bucket.keys, bucket.ids, bucket.lengths, bucket.copies).to_batches()

        return self.state.mapInArrow(live, _GROUP)


def bucket_of(digest: Column, buckets: int) -> Column:
    return F.pmod(F.conv(F.substring(F.hex(digest), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def combined_copies(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, n_cp, group_size) with at most a row per digest and task, before any shuffle."""
    one = F.lit(1).cast("long")
    narrow = rows.select("digest", F.col("id").cast("long").alias("keep_id"), F.col("n_cp").cast("long").alias("n_cp"), one.alias("group_size"))
    return narrow.mapInArrow(_combine_task, _GROUP)


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(id, digest, n_cp) per row: SHA-256 of the text without ASCII white space, code points of the original.

    With ``row_col`` also that column, as row.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.unhex(F.sha2(bare.cast("binary"), 256)).alias("digest"),
        F.char_length(text).cast("long").alias("n_cp"),
        *([F.col(row_col).cast("long").alias("row")] if row_col else []),
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, row_col: str | None = None, keys_per_bucket: int = KEYS_PER_BUCKET
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts equal without white space form a group (null counts as empty; empty texts are a group); the longest
    original, then the smallest id stays. A null id comes last. Rows that repeat both the survivor's id and its
    length are the same document and all kept; group_size counts rows. No other column of ``docs`` is read, so
    names cannot clash. An empty table gives an empty result.

    ``row_col`` names a column with a number of its own for each row. It is carried into the result, and exactly one
    row of each group is kept: of the rows that would be, the one with the smallest number.
    """
    rows = stored(text_digests(docs, id_col, text_col, row_col), "digests")
    buckets = max(1, -(-rows.count() // keys_per_bucket))
    placed = combined_copies(rows).withColumn("bucket", bucket_of(F.col("digest"), buckets))
    groups = placed.groupBy("bucket").applyInArrow(_index_bucket, _GROUP)
    several = groups.where("group_size > 1").select("digest", "keep_id", F.col("n_cp").alias("keep_cp"), "group_size")
    joined = rows.join(several, "digest", "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("id")).otherwise(F.col("keep_id"))
    kept = alone | (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("n_cp") == F.col("keep_cp")))
    if row_col:
        # The group's first row is marked by its number, so that no group's rows meet in one task.
        firsts = joined.where(~alone & kept).groupBy("digest").agg(F.min("row").alias("first")).select("first")
        joined = joined.join(firsts, F.col("row") == F.col("first"), "left")
        kept = alone | F.col("first").isNotNull()
    return joined.select(
        *([F.col("row").alias(row_col)] if row_col else []),
        F.col("id").alias("doc_id"),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        kept.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
