"""SentencePiece BPE encoding and decoding with numpy.

Texts are split where white space follows other characters: no piece of the vocabulary spans such a place (this is
checked when the model is read). Words not met before are encoded together in merge rounds over one flat symbol
array: each round finds the best pair rank of every word, merges all its occurrences from the left, compacts the
array and goes on with the words that still have a pair. A word of more than ``LONG_WORD`` characters (a text without
spaces may be one) merges the same pairs in the same order off a heap, since a round costs its whole length.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import uuid
from collections.abc import Callable, Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

from .words import remembered, text_groups

SPACE = "▁"
CACHED_WORDS = 500_000
#: Beyond so many characters a word goes by a heap of its pairs: merge rounds over it would rescan it for each merge.
LONG_WORD = 128
CACHED_CHARS = 256
_WORD = re.compile(f"[ {SPACE}]*[^ {SPACE}]+|[ {SPACE}]+")
_NONE = np.iinfo(np.int64).max


class PieceModel:
    """Vocabulary, pair table and byte pieces of a SentencePiece BPE model with byte fallback.

    Symbols are piece ids; a character that is no piece is ``size`` plus its code point until the end.
    """

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]) -> None:
        self.size = len(pieces)
        self.ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == "normal"}
        self.byte_ids = np.array([i for i, k in enumerate(kinds) if k == "byte"])
        if len(self.byte_ids) != 256:
            raise ValueError("only models with byte fallback are supported")
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece has white space after another character: words cannot be split there")
        self.surface = [
            bytes([int(p[1:-1], 16)]) if k == "byte" else {"control": b"", "unknown": " ⁇ ".encode()}.get(k, p.replace(SPACE, " ").encode())
            for p, k in zip(pieces, kinds, strict=True)
        ]
        self.kinds = kinds
        self.decimal = [str(i) for i in range(self.size)]
        self.control = np.array([k == "control" for k in kinds])
        self.opens = np.array([k == "normal" and p.startswith(SPACE) for p, k in zip(pieces, kinds, strict=True)])
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in self.ids.values()}, reverse=True))}
        table = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.symbol(piece[:cut]), self.symbol(piece[cut:])
                if left is not None and right is not None:
                    table[left, right] = (order[scores[i]], i)
        pairs = np.array(sorted(table), dtype=np.int64).reshape(-1, 2)
        ranks = np.array([table[tuple(p)] for p in pairs.tolist()], dtype=np.int64).reshape(-1, 2)
        self.pairs = self._pair(pairs[:, 0], pairs[:, 1])
        self.rank, self.merged = ranks[:, 0], ranks[:, 1]
        self.table = table
        # A merge is eager if no pair that it may create ranks before it: then all its occurrences can go at once.
        best = np.full(self.size, _NONE)
        for side in (0, 1):
            inside = pairs[:, side] < self.size
            np.minimum.at(best, pairs[inside, side], self.rank[inside])
        self.eager = best[self.merged] > self.rank

    def symbol(self, text: str) -> int | None:
        return self.ids.get(text, self.size + ord(text) if len(text) == 1 else None)

    @staticmethod
    def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 22) | right

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of each word's) for non-empty words, spaces already replaced."""
        long = [k for k, w in enumerate(words) if len(w) > LONG_WORD]
        if not long:
            return self._encode_rounds(words)
        short = [w for w in words if len(w) <= LONG_WORD]
        ids, sizes = self._encode_rounds(short) if short else (np.empty(0, np.int32), np.empty(0, np.int64))
        parts = iter(np.split(ids, np.cumsum(sizes)[:-1]))
        at = set(long)
        parts = [self._encode_long(w) if k in at else next(parts) for k, w in enumerate(words)]
        return np.concatenate(parts), np.array([len(x) for x in parts], dtype=np.int64)

    def _encode_long(self, word: str) -> np.ndarray:
        """The ids of one word, merging the best pair, leftmost first, off a heap: n log n in its length."""
        ids, size, table = self.ids, self.size, self.table
        symbols = [ids.get(c, size + ord(c)) for c in word]
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(*found, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if (found := table.get((a, b)))]
        heap = [(rank, i, merged, a, b) for rank, merged, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, merged, a, b = heapq.heappop(heap)
            j = after[i] if symbols[i] == a else n
            if j >= n or symbols[j] != b:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = merged, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := table.get((merged, symbols[k])):
                    heapq.heappush(heap, (found[0], i, found[1], merged, symbols[k]))
            if (h := before[i]) >= 0 and (found := table.get((symbols[h], merged))):
                heapq.heappush(heap, (found[0], h, found[1], symbols[h], merged))
        return self._bytes(np.array([x for x in symbols if x >= 0], dtype=np.int64))[0]

    def _encode_rounds(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        characters = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        uniques, where = np.unique(characters, return_inverse=True)
        symbols = np.array([self.symbol(chr(c)) for c in uniques.tolist()], dtype=np.int64)[where]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            pair = self._pair(symbols[:-1], symbols[1:])
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            known = (self.pairs[at] == pair) & (word[:-1] == word[1:])
            rank = np.full(len(symbols), _NONE)
            rank[:-1][known] = self.rank[at[known]]
            heads = np.flatnonzero(np.diff(word, prepend=-1))
            lowest = np.minimum.reduceat(rank, heads)
            active = np.repeat(lowest != _NONE, np.diff(heads, append=len(word)))
            if not active.all():
                done.append((word[~active], symbols[~active]))
                keep = np.flatnonzero(active)
                symbols, word, rank = symbols[keep], word[keep], rank[keep]
                at = np.append(at, 0)[keep]
                if not len(symbols):
                    break
                heads = np.flatnonzero(np.diff(word, prepend=-1))
                lowest = lowest[lowest != _NONE]
            else:
                at = np.append(at, 0)
            best = np.flatnonzero(rank == np.repeat(lowest, np.diff(heads, append=len(word))))
            # Of a run of neighbours that overlap (aaa), every other one merges, from the left.
            run = np.flatnonzero(np.diff(best, prepend=-2) != 1)
            within = np.arange(len(best)) - np.repeat(run, np.diff(run, append=len(best)))
            first = np.diff(word[best], prepend=-1) != 0
            best = best[(within % 2 == 0) & (self.eager[at[best]] | first)]
            symbols[best] = self.merged[at[best]]
            stay = np.ones(len(symbols), dtype=bool)
            stay[best + 1] = False
            symbols, word = symbols[stay], word[stay]
        words_of, flat = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(words_of, kind="stable")
        flat, times = self._bytes(flat[order])
        return flat, np.bincount(np.repeat(words_of[order], times), minlength=len(words))

    def _bytes(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no piece become the pieces of their UTF-8 bytes; and how many each symbol becomes."""
        kinds, where = np.unique(symbols, return_inverse=True)
        parts = [self.byte_ids[list(chr(x - self.size).encode())].tolist() if x >= self.size else [x] for x in kinds.tolist()]
        sizes = np.array([len(x) for x in parts], dtype=np.int64)
        flat, begins = np.array(list(chain.from_iterable(parts)), dtype=np.int32), np.cumsum(sizes) - sizes
        times = sizes[where]
        starts = np.cumsum(times) - times
        return flat[np.arange(int(times.sum())) + np.repeat(begins[where] - starts, times)], times

    def decode(self, ids: np.ndarray) -> str:
        """The text of one sequence; in a run of byte pieces, bytes that make no UTF-8 become U+FFFD one by one."""
        listed = ids.tolist()
        seen = next((i for i in listed if self.kinds[i] != "control"), None)
        skip = int(seen is not None and self.opens[seen])  # the space that encoding put before the text
        try:
            if not self.control[ids].any():
                return b"".join(map(self.surface.__getitem__, listed))[skip:].decode()
        except UnicodeDecodeError:
            pass
        runs = groupby(listed, key=lambda i: self.kinds[i] == "byte")
        return "".join(_lenient(b"".join(map(self.surface.__getitem__, run))) for _, run in runs)[skip:]


def _lenient(raw: bytes) -> str:
    out = []
    while raw:
        try:
            return "".join([*out, raw.decode()])
        except UnicodeDecodeError as bad:
            out.append(raw[: bad.start].decode() + "\ufffd")
            raw = raw[bad.start + 1 :]
    return "".join(out)


def read_model(path: str) -> tuple[list[str], list[float], list[str]]:
    """Pieces, scores and kinds of a .model file, checked to be of the sort handled here."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    everything = range(model.get_piece_size())
    if any(model.is_unused(i) for i in everything):
        raise ValueError("unused pieces are not supported")
    sample = "  a  Ａ "
    if model.decode(model.encode(sample)) != sample or not model.encode("a", out_type=str)[0].startswith(SPACE):
        raise ValueError("only models that add a space in front and change nothing else are supported")

    def kind(i: int) -> str:
        tests = {"byte": model.is_byte, "control": model.is_control, "unknown": model.is_unknown}
        return next((k for k, test in tests.items() if test(i)), "normal")

    return [model.id_to_piece(i) for i in everything], [model.get_score(i) for i in everything], [kind(i) for i in everything]


class Encoder:
    """Encodes texts; the ids of words met before are kept, up to ``CACHED_WORDS`` of them."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.long_words = False  # huge words are let go with the next new ones
        self.flat, self.starts = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _learn(self, words: list[str]) -> None:
        ids, sizes = self.model.encode_words([w.replace(" ", SPACE) for w in words])
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words)), strict=True))
        self.flat = np.concatenate([self.flat, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets); every text but an empty one begins with a space of its own."""
        split = [_WORD.findall(f" {t}") if t else [] for t in texts]
        new = set(chain.from_iterable(split)).difference(self.index)
        if new and (len(self.index) + len(new) > CACHED_WORDS or self.long_words):
            self._forget()
            new = set(chain.from_iterable(split))
        if new:
            self._learn(list(new))
            self.long_words = any(len(w) > CACHED_CHARS for w in new)
        at = np.array(list(map(self.index.__getitem__, chain.from_iterable(split))), dtype=np.int64)
        sizes = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(self.starts[at] - (ends - sizes), sizes)]
        words_before = np.cumsum([0, *map(len, split)])
        return ids, np.concatenate([[0], ends])[words_before]


def _mapped(docs: DataFrame, model_path: str, columns: list[tuple[str, pa.DataType]], row: Callable) -> DataFrame:
    """doc_id and what ``row(model, ids)`` gives for each text, with the model's tables sent to the tasks once."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    key = f"pieces-{uuid.uuid4().hex}"
    schema = pa.schema([("doc_id", pa.int64()), *columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = remembered(key, lambda: Encoder(PieceModel(*shared.value)))
        for batch in batches:
            texts = [x or "" for x in batch["text"].to_pylist()]
            for lo, hi in text_groups(texts):
                ids, offsets = encoder.encode(texts[lo:hi])
                rows = [row(encoder.model, ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                arrays = [pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), columns, strict=True)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"][lo:hi], *arrays], schema=schema)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, from_arrow_schema(schema))


def encode_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids) of each row, without begin and end ids. Null texts count as empty and have no ids."""
    return _mapped(docs, model_path, [("ids", pa.list_(pa.int32()))], lambda model, ids: (ids,))


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null and empty ids give the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_model(model_path))
    key = f"decoder-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = remembered(key, lambda: PieceModel(*shared.value))
        for batch in batches:
            texts = [model.decode(np.array(x or [], dtype=np.int32)) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.selectExpr("cast(doc_id as long) doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def piece_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row: encoded, then decoded from the ids.

    One row per row of ``docs``; null texts count as empty, ids may be null or repeat, other columns are not read.
    """

    def row(model: PieceModel, ids: np.ndarray) -> tuple:
        listed = ",".join(map(model.decimal.__getitem__, ids.tolist())).encode()
        decoded = model.decode(ids).encode()
        return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(decoded).hexdigest()

    columns = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    return _mapped(docs, model_path, columns, row)
