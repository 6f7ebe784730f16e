"""Stupid-backoff scores of every document under a bigram model of all other documents.

The model's counts are the corpus's less the document's own, so a document is never scored by itself and backing off
means that no other document has the bigram. Documents explode into (context, word, document) entries that are dealt
by a hash of the context; there they meet the counts of their group, bigrams no other document has go on to the
group of their word, and each group returns sums per document. Rows are packed columns, one per slice of documents
and group.

Keys with a large share of the corpus (``hot_keys``; at most 1 / ``LEAST_SHARE`` of each kind) are counted before and
sent to all tasks: hot bigrams are scored where they are read, and a hot context's others are dealt by the bigram.
Logarithms are summed as whole millionths, so the order of summation changes nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import pack, smallest, unpack
from .storage import stored
from .words import Words, alphanumeric, mix, word_slices

ALPHA = 0.4
GROUP_ENTRIES = 1_600_000
BYTES_PER_WORD = 6
LEAST_SHARE = 1e-5
SLICE_BYTES = 1 << 21
MILLION = 1_000_000
_SALT = np.uint64(0xE7037ED1A0B428DB)
_ROW = "group int, slice long, kind int, data binary"
ENTRIES, COUNTS, FIRST, DOCS, SUMS, TABLE, QUERIES = range(7)


def log_units(values: np.ndarray) -> np.ndarray:
    """Natural logarithms of positive numbers in whole millionths."""
    return np.rint(np.log(values) * MILLION).astype(np.int64)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first ^ _SALT) + second)


@dataclass
class Counts:
    """Sorted keys and their counts."""

    keys: np.ndarray
    counts: np.ndarray

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The keys' counts, 0 where there is none."""
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)

    @staticmethod
    def summed(keys: np.ndarray, counts: np.ndarray) -> Counts:
        distinct, where = np.unique(keys, return_inverse=True)
        return Counts(distinct, np.bincount(where, counts, len(distinct)).astype(np.int64))


@dataclass
class Setting:
    groups: int
    alpha: float
    words: Counts  # hot ones, with their counts in the whole corpus
    pairs: Counts

    def __post_init__(self) -> None:
        self.penalty = int(log_units(np.array([self.alpha]))[0])

    def group(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys ^ _SALT) % np.uint64(self.groups)).astype(np.int64)

    def unigrams(self, total: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Units for words by count in other documents; a word no other document has counts as ``alpha``."""
        left = total - own
        return np.where(left > 0, log_units(np.maximum(left, 1)), self.penalty)


def _bigrams(words: Words) -> np.ndarray:
    """Indexes of words whose next word is of the same text."""
    return np.flatnonzero(words.row[:-1] == words.row[1:])


def hot_keys(docs: DataFrame, share: float) -> tuple[Counts, Counts]:
    """Exact counts of the words and bigrams that are at least ``share`` of all words.

    Such a key has that share of at least one slice; those of any slice are counted over all documents.
    """

    def run(function) -> DataFrame:
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]
            total = 0
            for batch in batches:
                for words in word_slices(batch["text"], alphanumeric(), SLICE_BYTES):
                    at = _bigrams(words)
                    total += len(words.hashes)
                    for kind, keys in enumerate((words.hashes, pair_keys(words.hashes[at], words.hashes[at + 1]))):
                        held[kind].append(function(kind, *np.unique(keys, return_counts=True), len(words.hashes)))
                        if len(held[kind]) >= 16:
                            held[kind] = [_added(held[kind])]
            for kind in (0, 1):
                keys, counts = _added(held[kind]) if held[kind] else (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))
                columns = [pa.array(np.full(len(keys), kind, dtype=np.int32)), pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["kind", "key", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.array([0], pa.int64()), pa.array([total], pa.int64())], ["kind", "key", "n"])

        rows = docs.select("text").mapInArrow(each, "kind int, key long, n long")
        return rows.groupBy("kind", "key").agg(F.sum("n").alias("n"))

    def frequent(kind: int, keys: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        some = counts >= max(2, share * size)
        return keys[some], counts[some]

    def columns(rows: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
        table = rows.toArrow().sort_by("key")
        out = []
        for kind in (0, 1):
            part = table.filter(pa.compute.equal(table["kind"], kind))
            keys, counts = (part[c].to_numpy() for c in ("key", "n"))
            order = np.argsort(keys.view(np.uint64))
            out.append((keys.view(np.uint64)[order], counts[order]))
        return out

    candidates = docs.sparkSession.sparkContext.broadcast([k for k, _ in columns(run(frequent).where("kind < 2"))])

    def known(kind: int, keys: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        some = np.isin(keys, candidates.value[kind], assume_unique=True)
        return keys[some], counts[some]

    exact = stored(run(known), "hot")
    total = exact.where("kind = 2").agg(F.sum("n")).first()[0] or 0
    words, pairs = columns(exact.where((F.col("kind") < 2) & (F.col("n") >= share * total)))
    return Counts(*words), Counts(*pairs)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    total = Counts.summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
    return total.keys, total.counts


def _table(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(steps between the distinct values, index of each into them)."""
    distinct, where = np.unique(values, return_inverse=True)
    return np.diff(distinct, prepend=distinct[:0].dtype.type(0)) if len(distinct) else distinct, smallest(where)


def _untable(steps: np.ndarray, where: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=steps.dtype)[where]


def _by_group(group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.diff(group[order], prepend=-1))
    if not len(order):
        return
    for lo, hi in zip(starts, np.append(starts[1:], len(order)), strict=True):
        yield int(group[order[lo]]), order[lo:hi]


class _Rows:
    def __init__(self) -> None:
        self.rows: list[tuple[int, int, int, bytes]] = []

    def add(self, group: int, part: int, kind: int, *columns: np.ndarray) -> None:
        self.rows.append((group, part, kind, pack(*columns)))

    def table(self) -> pa.Table:
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary())
        columns = zip(*self.rows, strict=True) if self.rows else [()] * 4
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["group", "slice", "kind", "data"])


def _explode(setting: Setting, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, task = 0, TaskContext.get().partitionId()
    for batch in batches:
        for words in word_slices(batch["text"], alphanumeric(), SLICE_BYTES):
            ids = batch["doc_id"][words.first : words.first + words.rows]
            yield from _explode_slice(setting, words, ids, (task << 32) | number).to_batches()
            number += 1


def _explode_slice(setting: Setting, words: Words, ids: pa.Array, part: int) -> pa.Table:
    out = _Rows()
    keys, word = np.unique(words.hashes, return_inverse=True)
    bits = max(1, int(words.rows - 1).bit_length())

    def of_document(which: np.ndarray, document: np.ndarray) -> np.ndarray:
        return (which << bits) | document

    in_document, own = np.unique(of_document(word, words.row), return_counts=True)
    times = lambda which, document: own[np.searchsorted(in_document, of_document(which, document))]
    sums, backed = np.zeros(words.rows, dtype=np.int64), np.zeros(words.rows, dtype=np.int64)
    hot_total = setting.words.of(keys)

    # The first word of a text has no context.
    first = words.bounds[:-1][words.counts() > 0]
    document, which = words.row[first], word[first]
    hot = hot_total[which] > 0
    sums[document[hot]] += setting.unigrams(hot_total[which[hot]], times(which[hot], document[hot]))
    backed[document] += 1
    document, which = document[~hot], which[~hot]
    for group, mine in _by_group(setting.group(keys[which])):
        steps, where = _table(keys[which[mine]])
        out.add(group, part, FIRST, steps, where, smallest(document[mine]), smallest(times(which[mine], document[mine])))

    at = _bigrams(words)
    entries, n = np.unique(of_document(word[at] * len(keys) + word[at + 1], words.row[at]), return_counts=True)
    document = entries & ((1 << bits) - 1)
    context, follower = np.divmod(entries >> bits, max(1, len(keys)))
    pair = pair_keys(keys[context], keys[follower])
    total = setting.pairs.of(pair)
    hot = total > 0
    own_context, own_follower = times(context, document), times(follower, document)
    left = total[hot] - n[hot]
    # A bigram that is hot has a hot context and a hot word.
    seen = log_units(np.maximum(left, 1)) - log_units(np.maximum(hot_total[context[hot]] - own_context[hot], 1))
    unseen = setting.penalty + setting.unigrams(hot_total[follower[hot]], own_follower[hot])
    np.add.at(sums, document[hot], n[hot] * np.where(left > 0, seen, unseen))
    np.add.at(backed, document[hot], n[hot] * (left == 0))
    rest = np.flatnonzero(~hot)
    group = np.where(hot_total[context[rest]] > 0, setting.group(pair[rest]), setting.group(keys[context[rest]]))
    for g, mine in _by_group(group):
        mine = rest[mine]
        columns = (*_table(keys[context[mine]]), *_table(keys[follower[mine]]), *(smallest(x[mine]) for x in (document, n, own_context, own_follower)))
        out.add(g, part, ENTRIES, *columns)

    cold = np.flatnonzero(hot_total == 0)
    occurrences = np.bincount(word, minlength=len(keys))
    for g, mine in _by_group(setting.group(keys[cold])):
        mine = cold[mine]
        out.add(g, part, COUNTS, np.diff(keys[mine], prepend=np.uint64(0)), smallest(occurrences[mine]))
    valid = ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8)
    numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
    out.add(part % setting.groups, part, DOCS, numbers, valid, words.counts(), sums, backed)
    return out.table()


def _sum_rows(out: _Rows, group: int, parts: np.ndarray, part: np.ndarray, document: np.ndarray, units: np.ndarray, backed: np.ndarray) -> None:
    """A row of sums per slice, from entries' units and counts of backing off."""
    where, which = np.unique((part.astype(np.int64) << 32) | document, return_inverse=True)
    total, n = np.zeros(len(where), dtype=np.int64), np.zeros(len(where), dtype=np.int64)
    np.add.at(total, which, units)
    np.add.at(n, which, backed)
    for p, mine in _by_group(where >> 32):
        out.add(group, int(parts[p]), SUMS, smallest(np.diff(where[mine] & 0xFFFFFFFF, prepend=0)), total[mine], smallest(n[mine]))


def _columns(table: pa.Table, kind: int) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """(slices, unpacked columns) of the rows of a kind."""
    rows = table.filter(pa.compute.equal(table["kind"], kind))
    return rows["slice"].to_numpy(), [unpack(x.as_buffer()) for x in rows["data"]]


def _joined(lists: list[list[np.ndarray]], kinds: list[type]) -> list[np.ndarray]:
    """Columns of several rows, one after the other. ``lists`` is emptied on the way, so that nothing is held twice."""
    out = []
    for kind in reversed(kinds):
        out.append(np.concatenate([np.empty(0, dtype=kind), *(x.pop().astype(kind, copy=False) for x in lists)]))
    return out[::-1]


def _times(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each entry the sum of ``n`` over entries with its key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, dtype=np.int64)
    del keys
    out = np.empty(len(n), dtype=np.int64)
    if len(n):
        out[order] = np.repeat(np.add.reduceat(n[order], starts, dtype=np.int64), np.diff(np.append(starts, len(n))))
    return out


def _score_bigrams(setting: Setting, table: pa.Table) -> pa.Table:
    """Scores of a group's entries; what backs off goes to the group of its word, with that group's counts."""
    out = _Rows()
    me = table["group"][0].as_py()
    _, counted = _columns(table, COUNTS)
    keys, n = _joined([[np.cumsum(k, dtype=np.uint64), c] for k, c in counted], [np.uint64, np.int64])
    known = Counts.summed(keys, n)
    out.add(me, 0, TABLE, known.keys, smallest(known.counts))

    parts, firsts = _columns(table, FIRST)
    key, document, own = _joined([[_untable(s, w), d, o] for s, w, d, o in firsts], [np.uint64, np.int64, np.int64])
    part = np.repeat(np.arange(len(firsts)), [len(x[1]) for x in firsts])
    _sum_rows(out, me, parts, part, document, setting.unigrams(known.of(key), own), np.zeros(len(key), dtype=np.int64))

    parts, entries = _columns(table, ENTRIES)
    part = np.repeat(np.arange(len(entries), dtype=np.int64), [len(x[1]) for x in entries])
    # The columns of numbers are taken first; then the keys are spelled out, one column at a time.
    document, n, own_context, own_word = _joined([x[4:] for x in entries], [np.int32] * 4)
    word, context = (np.concatenate([np.empty(0, dtype=np.uint64), *(_untable(x[k], x[k + 1]) for x in entries)]) for k in (2, 0))
    del entries
    left = _times(pair_keys(context, word), n) - n
    in_context = np.maximum(known.of(context), setting.words.of(context)) - own_context
    del context
    # Other documents' bigrams are other documents' words, so a seen one has a context.
    units = np.where(left > 0, log_units(np.maximum(left, 1)) - log_units(np.maximum(in_context, 1)), setting.penalty)
    back = left == 0
    hot = setting.words.of(word)
    here = back & (hot > 0)
    units[here] += setting.unigrams(hot[here], own_word[here])
    _sum_rows(out, me, parts, part, document, units * n, n * back)
    rest = np.flatnonzero(back & (hot == 0))
    for g, mine in _by_group(setting.group(word[rest])):
        mine = rest[mine]
        mine = mine[np.argsort(word[mine], kind="stable")]
        slices, where = np.unique(parts[part[mine]], return_inverse=True)
        out.add(g, 0, QUERIES, *_table(word[mine]), slices, smallest(where), *(smallest(x[mine]) for x in (document, n, own_word)))
    for part_, (columns) in zip(*_columns(table, DOCS), strict=True):
        out.add(me, int(part_), DOCS, *columns)
    return out.table()


def _score_unigrams(setting: Setting, table: pa.Table) -> pa.Table:
    out = _Rows()
    me = table["group"][0].as_py()
    _, tables = _columns(table, TABLE)
    known = Counts(*tables[0]) if tables else Counts(np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))
    known.counts = known.counts.astype(np.int64)
    _, queries = _columns(table, QUERIES)
    unpacked = [[_untable(a, b), slices[where], *rest] for a, b, slices, where, *rest in queries]
    word, part, document, n, own = _joined(unpacked, [np.uint64, np.int64, np.int64, np.int64, np.int64])
    parts, where = np.unique(part, return_inverse=True)
    _sum_rows(out, me, parts, where, document, n * setting.unigrams(known.of(word), own), np.zeros(len(n), dtype=np.int64))
    kept = table.filter(pa.compute.is_in(table["kind"], pa.array([DOCS, SUMS], pa.int32())))
    return pa.concat_tables([out.table(), kept.select(["group", "slice", "kind", "data"])])


def _total(table: pa.Table) -> pa.Table:
    _, documents = _columns(table, DOCS)
    ids, valid, n, sums, backed = documents[0]
    sums, backed = sums.copy(), backed.copy()
    for steps, units, times in _columns(table, SUMS)[1]:
        document = np.cumsum(steps, dtype=np.int64)
        sums[document] += units
        backed[document] += times
    return pa.table({"doc_id": pa.array(ids, mask=valid == 0), "n_tokens": n.astype(np.int64), "units": sums, "n_backed": backed})


def score_documents(docs: DataFrame, *, alpha: float = ALPHA, group_entries: int = GROUP_ENTRIES, hot_share: float | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_backoff, log_score, mean_log_score.

    Words are lower-cased runs of letters and digits. With counts c over all other rows and N their words, a word w
    after v scores c(v w) / c(v), or ``alpha`` c(w) / N where c(v w) is 0; c(w) is ``alpha`` where it is 0. A text's
    first word scores c(w) / N. log_score sums the natural logarithms in millionths; n_backoff counts the words that
    backed off. Texts that are null or without words score 0 with a null mean. Repeated rows are documents of their
    own, so a copy is scored by the other. Only doc_id and text are read.
    """
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, math.ceil(size / BYTES_PER_WORD / group_entries))
    share = hot_share or max(LEAST_SHARE, group_entries / 8 / max(1, size / BYTES_PER_WORD))
    setting = docs.sparkSession.sparkContext.broadcast(Setting(groups, alpha, *hot_keys(rows, min(1.0, share))))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _explode(setting.value, batches)

    def bigrams(table: pa.Table) -> pa.Table:
        return _score_bigrams(setting.value, table)

    def unigrams(table: pa.Table) -> pa.Table:
        return _score_unigrams(setting.value, table)

    entries = rows.mapInArrow(explode, _ROW)
    scored = entries.groupBy("group").applyInArrow(bigrams, _ROW).groupBy("group").applyInArrow(unigrams, _ROW)
    sums = stored(scored.groupBy("slice").applyInArrow(_total, "doc_id long, n_tokens long, units long, n_backed long"), "scores")
    every = sums.agg(F.sum("n_tokens").alias("every"))
    left = F.greatest(F.col("every") - F.col("n_tokens"), F.lit(1))
    units = F.col("units") - F.col("n_backed") * F.rint(F.log(left) * MILLION).cast("long")
    # The one row of the total is the only thing joined to all rows.
    return sums.join(F.broadcast(every)).select(
        "doc_id",
        "n_tokens",
        (F.col("n_backed") - F.when(F.col("n_tokens") > 0, 1).otherwise(0)).alias("n_backoff"),
        (units / MILLION).alias("log_score"),
        F.when(F.col("n_tokens") > 0, F.round(units / MILLION / F.col("n_tokens"), 6)).alias("mean_log_score"),
    )
