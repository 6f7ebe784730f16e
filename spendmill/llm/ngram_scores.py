"""Stupid-backoff scores of any order, relationally: counts of n-grams joined to the n-grams of each document.

Documents explode into their distinct n-grams of 1 to ``order`` words with the number of times they hold them. Summed
by n-gram these are the corpus counts, dealt by hash; joined back they give each document what all *other* documents
hold of its n-grams, and the document adds up its words. ``lm_scores`` computes order two with far fewer bytes shuffled.

An n-gram in very many documents is one row of the count table, so its join only spreads: adaptive execution splits
the documents' side. N-grams that no other document has end at the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lm_scores import ALPHA, MILLION, SLICE_BYTES, log_units, pair_keys
from .storage import stored
from .words import Words, alphanumeric, word_slices

_ENTRIES = "uid long, gram long, own long"
_SUMS = "doc_id long, n_tokens long, n_backoff long, n_alone long, units long"


def grams(words: Words, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length from 1 to ``order``: where n-grams of one text end, and their keys."""
    at, keys = np.arange(len(words.hashes)), words.hashes
    yield at, keys
    for _ in range(order - 1):
        going = np.zeros(len(at), dtype=bool)
        inner = at + 1 < len(words.row)
        going[inner] = words.row[at[inner]] == words.row[at[inner] + 1]
        keys, at = pair_keys(keys[going], words.hashes[at[going] + 1]), at[going] + 1
        yield at, keys


def _explode(order: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        uid = batch["uid"].to_numpy()
        for words in word_slices(batch["text"], alphanumeric(), SLICE_BYTES):
            for at, keys in grams(words, order):
                row = words.row[at]
                sort = np.lexsort((keys, row))
                row, keys = row[sort], keys[sort]
                first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (keys[1:] != keys[:-1])])) if len(row) else np.empty(0, dtype=np.int64)
                own = np.diff(np.append(first, len(row)))
                columns = (uid[words.first + row[first]], keys[first].view(np.int64), own)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["uid", "gram", "own"])


def score_text(lengths: list[tuple[np.ndarray, np.ndarray]], known: np.ndarray, left: np.ndarray, alpha: float) -> tuple[int, int, int]:
    """(units, words that backed off, words scored by their count alone) of one text.

    ``lengths`` holds, for each length, the indexes in the text where its n-grams end, and their keys; ``left`` is how
    often other texts hold each key of ``known`` (sorted).
    """

    def others(keys: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(keys), dtype=np.int64)
        where = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return np.where(known[where] == keys, left[where], 0)

    n = len(lengths[0][0])
    penalty = int(log_units(np.array([alpha]))[0])
    counts = [others(keys) for _, keys in lengths]
    longest = np.minimum(np.arange(n) + 1, len(lengths))
    used = np.ones(n, dtype=np.int64)
    units = np.where(counts[0] > 0, log_units(np.maximum(counts[0], 1)), penalty)
    for k in range(2, len(lengths) + 1):  # a longer n-gram that others have takes precedence
        ends, _ = lengths[k - 1]
        seen = counts[k - 1] > 0
        # The context is the n-gram before, one word shorter: it ends one word earlier.
        context = counts[k - 2][ends[seen] - 1 - (k - 2)]
        units[ends[seen]] = log_units(counts[k - 1][seen]) - log_units(np.maximum(context, 1))
        used[ends[seen]] = k
    units += penalty * (longest - used)
    return int(units.sum()), int((used < longest).sum()), int((used == 1).sum())


def _score(order: int, alpha: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for words in word_slices(batch["text"], alphanumeric(), SLICE_BYTES):
            by_length = list(grams(words, order))
            for i in range(words.rows):
                lo, hi = words.bounds[i], words.bounds[i + 1]
                mine = []
                for at, keys in by_length:
                    a, b = np.searchsorted(at, (lo, hi))
                    mine.append((at[a:b] - lo, keys[a:b]))
                found = batch["found"][words.first + i].values
                known, left = (found.field(c).to_numpy() for c in ("gram", "left")) if found is not None else (np.empty(0, dtype=np.int64),) * 2
                known = known.view(np.uint64)
                sort = np.argsort(known)
                units, backed, alone = score_text(mine, known[sort], left[sort], alpha)
                out.append((int(hi - lo), backed, alone, units))
        columns = zip(*out, strict=True) if out else [()] * 4
        arrays = [batch["doc_id"], *(pa.array(c, pa.int64()) for c in columns)]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "n_backoff", "n_alone", "units"])


def score_ngrams(docs: DataFrame, order: int = 3, *, alpha: float = ALPHA) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_backoff, log_score, mean_log_score, as ``score_documents``.

    With counts c over all other rows and N their words, a word w after the words v scores c(v w) / c(v) for the longest
    v of up to ``order`` - 1 words before it in its text for which c(v w) is not 0, times ``alpha`` for each word that v
    is shorter than it could be; without any v it scores c(w) / N, where a c(w) of 0 counts as ``alpha``. n_backoff
    counts the words whose v is shorter than it could be. Null texts and texts without words score 0 with a null mean, an
    empty table gives no row, and ids may be null or repeat: rows are told apart by a number. Only doc_id and text are
    read. N-grams are told apart by 64-bit hashes.
    """
    if order < 1:
        raise ValueError("order must be 1 or more")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(rows.withColumn("uid", F.monotonically_increasing_id()), "texts")  # a fixed number for each row

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _explode(order, batches)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _score(order, alpha, batches)

    entries = stored(rows.select("uid", "text").mapInArrow(explode, _ENTRIES), "entries")
    totals = entries.groupBy("gram").agg(F.sum("own").alias("total"), F.count("*").alias("holders")).where("holders > 1")
    left = entries.join(totals, "gram").select("uid", F.struct("gram", (F.col("total") - F.col("own")).alias("left")).alias("one"))
    found = left.groupBy("uid").agg(F.collect_list("one").alias("found"))  # as long as one text's words, at most ``order`` times
    sums = stored(rows.join(found, "uid", "left").select("doc_id", "text", "found").mapInArrow(score, _SUMS), "sums")
    every = sums.agg(F.sum("n_tokens").alias("every"))
    others = F.greatest(F.col("every") - F.col("n_tokens"), F.lit(1))
    units = F.col("units") - F.col("n_alone") * F.rint(F.log(others) * MILLION).cast("long")
    mean = F.when(F.col("n_tokens") > 0, F.round(units / MILLION / F.col("n_tokens"), 6))
    # The one row of the total is the only thing joined to all rows.
    return sums.join(F.broadcast(every)).select("doc_id", "n_tokens", "n_backoff", (units / MILLION).alias("log_score"), mean.alias("mean_log_score"))
