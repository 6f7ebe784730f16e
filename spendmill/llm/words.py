"""Words of whole texts as numpy arrays: positions and 64-bit hashes, without a Python object per word.

A word's hash is the sum of random values for each of its bytes at its place in the word, read off one running sum,
and mixed at the end: unlike a polynomial modulo 2**64, no pattern of bytes cancels out. Texts are taken in slices of about a megabyte; a longer text is a slice of its own, never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
GROUP_CHARS = 1 << 19
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
PLACES = 64  # places whose values are looked up; further ones are computed
_PLACE = np.uint64(0xBF58476D1CE4E5B9 ^ 0x5851F42D4C957F2D | 1)
_WINDOW = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass(frozen=True)
class Alphabet:
    """Which bytes belong to words, and what each stands for."""

    member: np.ndarray
    value: np.ndarray  # of a byte
    placed: np.ndarray  # of a byte at each of the first places, flat


def _alphabet(member: np.ndarray, fold: np.ndarray) -> Alphabet:
    values = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)[fold]
    return Alphabet(member, values, _placed(values[:, None], np.arange(PLACES)[None, :]).reshape(-1))


def _placed(value: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix(value ^ ((place.astype(np.uint64) + np.uint64(1)) * _PLACE))


@lru_cache
def visible() -> Alphabet:
    """Words are runs of anything but ASCII white space (space, tab to carriage return), unchanged."""
    code = np.arange(256)
    return _alphabet(~((code == 0x20) | ((code >= 0x09) & (code <= 0x0D))), code)


@lru_cache
def alphanumeric() -> Alphabet:
    """Words are runs of ASCII digits and letters and of all other characters, A-Z lower-cased."""
    code = np.arange(256)
    fold = np.where((code >= 65) & (code <= 90), code + 32, code)
    member = ((fold >= 0x30) & (fold <= 0x39)) | ((fold >= 0x61) & (fold <= 0x7A)) | (fold >= 0x80)
    return _alphabet(member, fold)


@dataclass
class Words:
    """Words of consecutive rows ``first`` to ``first + rows - 1`` of a column."""

    first: int
    rows: int
    data: np.ndarray  # the rows' bytes
    starts: np.ndarray  # byte positions in data
    ends: np.ndarray
    row: np.ndarray  # row of each word, from 0
    hashes: np.ndarray
    bounds: np.ndarray  # word index where each row begins, and the end

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def split_words(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet, first: int = 0) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i+1]]``; ``offsets[0]`` is 0."""
    n = len(data)
    inside = alphabet.member[data]
    opens, closes = inside.copy(), inside.copy()
    if n:
        edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)]
        same = np.ones(n, dtype=bool)
        same[edge] = False  # the byte before belongs to another text
        opens[1:] &= ~(inside[:-1] & same[1:])
        closes[:-1] &= ~(inside[1:] & same[1:])
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    begins = np.zeros(n, dtype=np.int64)
    begins[starts] = starts
    place = np.arange(n) - np.maximum.accumulate(begins) if n else begins
    values = alphabet.placed[data.astype(np.int64) * PLACES + np.minimum(place, PLACES - 1)]
    far = np.flatnonzero(inside & (place >= PLACES))
    if len(far):
        values[far] = _placed(alphabet.value[data[far]], place[far])
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values, out=total[1:])
    hashes = mix(total[ends] - total[starts] + (ends - starts).astype(np.uint64))
    bounds = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    return Words(first, len(offsets) - 1, data, starts, ends, row, hashes, bounds)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64, count=len(column) + 1, offset=8 * column.offset)
    data = np.frombuffer(what, dtype=np.uint8) if what is not None else np.empty(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_slices(column: pa.Array, alphabet: Alphabet, slice_bytes: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of a column, slice after slice; every row is in exactly one slice."""
    _REMEMBERED.clear()
    if not len(column):
        return
    data, offsets = text_buffers(column)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offsets, offsets[lo] + slice_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        yield split_words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], alphabet, lo)
        lo = hi


def extend(short: np.ndarray, after: np.ndarray, k: int) -> np.ndarray:
    """Sums over the window that is ``short``'s (k words) followed by ``after``'s, at every start."""
    n = max(0, len(after) - k)
    with np.errstate(over="ignore"):
        return short[:n] + np.uint64(pow(int(_WINDOW), k, 1 << 64)) * after[k : k + n]


def window_sums(hashes: np.ndarray, k: int) -> np.ndarray:
    """A sum for every run of ``k`` consecutive words that tells the runs' words and order apart (see ``mix``)."""
    total, have, part, size = None, 0, hashes, 1
    while True:  # binary digits of k, so that a window takes log k additions
        if k & size:
            total = part if total is None else extend(total, part, have)
            have += size
        if have == k:
            return total
        part, size = extend(part, part, size), 2 * size


def whole_windows(words: Words, k: int) -> np.ndarray:
    """Word indexes at which a window of ``k`` words of one row starts."""
    n = max(0, len(words.hashes) - k + 1)
    return np.flatnonzero(words.row[:n] == words.row[k - 1 : k - 1 + n]) if n else np.empty(0, dtype=np.int64)


#: What this Python worker remembers between tasks: of one operator at a time, since workers outlive jobs.
_REMEMBERED: dict[str, object] = {}


def remembered(key: str, make: Callable[[], object]) -> object:
    """The worker's object for ``key``, made at first use; whatever was remembered for another key is let go."""
    if key not in _REMEMBERED:
        _REMEMBERED.clear()
        _REMEMBERED[key] = make()
    return _REMEMBERED[key]


def text_groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``GROUP_CHARS`` characters; a longer text is a range of its own."""
    lo, size = 0, 0
    for i, text in enumerate(texts):
        if i > lo and size + len(text) > GROUP_CHARS:
            yield lo, i
            lo, size = i, 0
        size += len(text)
    if texts:
        yield lo, len(texts)
