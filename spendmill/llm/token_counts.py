"""Token counts of whole texts; huge texts are encoded in overlapping pieces and spliced.

A text over ``piece_chars`` becomes pieces that any task may encode. Neighbouring pieces share an overlap that is
widened until it holds a certain boundary: a position that no token of the whole text spans. What such positions are
depends on the tokenizer (``Boundaries``), and a tokenizer for which none are known is refused when it is read. A token
that starts there in both encodings is a boundary of the whole text's encoding too: left of it the earlier piece counts,
right of it the later one. A text without such a position stays one piece. Where neighbouring pieces all the same fail to
align, the text is cut again with wider overlaps, until they do or it is one piece. Shorter texts are cut at every such position where white space carries no token.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored
from .words import remembered, text_groups

PIECE_CHARS = 32_768
OVERLAP_CHARS = 256
WIDEN = 8
KNOWN_PARTS = 1_000_000
REMEMBERED_CHARS = 64
_START = re.compile(r"(?<=[ \t\n\r\x0b\x0c])[\w!-~]")
_SPACED = re.compile(r"(?<=[!-~]) (?=[!-~])")
_BREAK = re.compile(r"[ \t\n\r\x0b\x0c]+(?=[\w!-~])")
_PIECES = "uid long, doc_id long, n_bytes long, number int, begins long, shared long, next long, piece string"
_COUNTS = "uid long, doc_id long, n_bytes long, number int, total long, head array<long>, head_tokens array<long>, tail array<long>, tail_tokens array<long>"


@lru_cache(maxsize=2)
def _tokenizer(definition: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


#: Texts on which a tokenizer is tried: words that are joined by white space of all sorts, marks, digits and long runs.
_TRIALS = ("a", "it's we'll", "B-52", "x" * 40, "1234567", "é", "!?", "Straße", "漢字", "́a", "don't", "<b>", "A.B.", "😀!")


class Boundaries:
    """Which positions of a text no token spans, as a pattern, and whether the white space between words has tokens.

    * White space dropped: it ends every pre-token, takes no part in composition and is in no special token; words that
      follow it start a token. This is tried on joined words with every sort of ASCII white space.
    * Byte-level BPE with the usual pattern and no prefix space: a single space between two ASCII signs starts a token.

    Any other tokenizer is an error: counts of cut texts would be guesses.
    """

    def __init__(self, definition: str) -> None:
        told, tokenizer = json.loads(definition), _tokenizer(definition)
        if any(re.search(r"\s", t["content"]) or t.get("lstrip") or t.get("rstrip") for t in told.get("added_tokens", [])):
            raise ValueError("an added token holds or takes up white space: texts cannot be cut there")
        if self._drops_space(tokenizer):
            self.start, self.cut_words = _START, True
        elif self._byte_level(told):
            self.start, self.cut_words = _SPACED, False
        else:
            raise ValueError("no certain boundaries are known for this tokenizer: only ones that drop white space, and byte-level BPE")

    @staticmethod
    def _drops_space(tokenizer) -> bool:
        ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        pairs = [(_TRIALS[i], _TRIALS[(i + step) % len(_TRIALS)]) for i in range(len(_TRIALS)) for step in (0, 1, 5)]
        spaces = (" ", "\t", "\n", "\r", "\x0b", "\x0c", "  ", " \t\n ")
        # A word that starts with a mark is no boundary (see the pattern) and is only tried in front.
        apart = all(ids(f"{a}{w}{b}") == ids(a) + ids(b) for a, b in pairs for w in spaces if _START.match(f" {b}", 1))
        return apart and not any(ids(w) for w in spaces)

    @staticmethod
    def _byte_level(told: dict) -> bool:
        split = told.get("pre_tokenizer") or {}
        usual = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
        return bool(usual) and told.get("normalizer") is None

    def starts(self, text: str, lo: int, hi: int) -> list[int]:
        """Certain boundaries in [lo, hi)."""
        return [m.start() for m in self.start.finditer(text, lo, hi)]


def cut(text: str, piece_chars: int, overlap: int, start: re.Pattern = _START) -> Iterator[tuple[int, int, int, int]]:
    """(begins, end of the part shared with the piece before, start of the next piece, end) of each piece."""
    n, begins, shared = len(text), 0, 0
    while True:
        following = max(begins + piece_chars, shared)
        end, width = following + overlap, overlap
        while end < n and not start.search(text, following + 1, end):
            width *= 2  # no certain boundary in the overlap: widen it
            end = following + width
        if end >= n:
            yield begins, shared, n, n
            return
        yield begins, shared, following, end
        begins, shared = following, end


class _Counter:
    """Tokens of texts cut at every certain boundary; each distinct part is encoded once while it is remembered."""

    def __init__(self, definition: str) -> None:
        self.encode = _tokenizer(definition).encode_batch_fast
        self.cut_words = Boundaries(definition).cut_words
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        if not self.cut_words:
            return [len(x) for x in self.encode(texts, add_special_tokens=False)]
        parts = [_BREAK.split(t) for t in texts]
        new = set(chain.from_iterable(parts)).difference(self.known)
        if len(self.known) + len(new) > KNOWN_PARTS:
            self.known.clear()
            new = set(chain.from_iterable(parts))
        listed = list(new)
        for lo in range(0, len(listed), 20_000):
            some = listed[lo : lo + 20_000]
            self.known.update(zip(some, map(len, self.encode(some, add_special_tokens=False)), strict=True))
        counts = [sum(map(self.known.__getitem__, words)) for words in parts]
        for part in listed:
            if len(part) > REMEMBERED_CHARS:
                del self.known[part]
        return counts


def _count(definition, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = remembered("counter-" + hashlib.md5(definition.value.encode()).hexdigest(), lambda: _Counter(definition.value))
    for batch in batches:
        texts = [x or "" for x in batch["text"].to_pylist()]
        counts = [n for lo, hi in text_groups(texts) for n in counter.count(texts[lo:hi])]
        columns = [batch["doc_id"], batch["n_bytes"], pa.array(counts, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])


def _slice(piece_chars: int, overlap: int, start: re.Pattern, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.strip().split(" ")[0] for x in _PIECES.split(",")]
    for batch in batches:
        for row in batch.to_pylist():
            text = row["text"]
            for number, (begins, shared, following, end) in enumerate(cut(text, piece_chars, overlap, start)):
                values = (row["uid"], row["doc_id"], row["n_bytes"], number, begins, shared, following, text[begins:end])
                kinds = [pa.int64()] * 3 + [pa.int32()] + [pa.int64()] * 3 + [pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)


def _encode_pieces(definition, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokenizer, boundaries = _tokenizer(definition.value), Boundaries(definition.value)
    for batch in batches:
        for row in batch.to_pylist():
            text, begins = row["piece"], row["begins"]
            encoding = tokenizer.encode(text, add_special_tokens=False)
            first_at: dict[int, int] = {}
            for k, (lo, _) in enumerate(encoding.offsets):
                first_at.setdefault(lo, k)
            out = []
            for lo, hi in ((0, row["shared"] - begins), (row["next"] - begins, len(text))):
                at = [p for p in boundaries.starts(text, max(lo, 0), max(hi, 0)) if p in first_at]
                out += [[p + begins for p in at], [first_at[p] for p in at]]
            values = (row["uid"], row["doc_id"], row["n_bytes"], row["number"], len(encoding), *out)
            kinds = [pa.int64()] * 3 + [pa.int32(), pa.int64()] + [pa.list_(pa.int64())] * 4
            names = ["uid", "doc_id", "n_bytes", "number", "total", "head", "head_tokens", "tail", "tail_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)


def _with(function: Callable, *values: object) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return function(*values, batches)

    return run


def spliced(pieces: DataFrame) -> DataFrame:
    """(uid, doc_id, n_bytes, n_tokens) from the pieces' counts: each junction is the first boundary both sides have.

    n_tokens is null where two pieces have none in common.
    """
    order = Window.partitionBy("uid").orderBy("number")
    junction = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    rows = pieces.withColumns({"has_next": F.lead("number").over(order).isNotNull(), "at": junction})
    rows = rows.withColumn("before", F.lag("at").over(order))

    def tokens_at(side: str, at: str) -> Column:
        return F.element_at(f"{side}_tokens", F.nullif(F.array_position(side, F.col(at)), F.lit(0)).cast("int"))

    upto = F.when(F.col("has_next"), tokens_at("tail", "at")).otherwise(F.col("total"))
    since = F.when(F.col("number") > 0, tokens_at("head", "before")).otherwise(0)
    known = F.when(F.count("*") == F.count(upto - since), F.sum(upto - since))
    return rows.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), known.alias("n_tokens"))


def rejoined(pieces: DataFrame) -> DataFrame:
    """(uid, doc_id, n_bytes, text) put together again from pieces."""
    own = F.struct("number", F.expr("substring(piece, 1, cast(next - begins as int))").alias("part"))
    parts = pieces.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.sort_array(F.collect_list(own)).alias("parts"))
    return parts.select("uid", "doc_id", "n_bytes", F.array_join("parts.part", "").alias("text"))


def counted_in_pieces(texts: DataFrame, definition, start: re.Pattern, piece_chars: int, overlap: int, encode: Callable = _encode_pieces) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of ``texts`` (uid, doc_id, n_bytes, text), each encoded in overlapping pieces.

    Texts whose pieces do not align are cut again with overlaps ``WIDEN`` times as wide. An overlap as long as the text
    makes one piece of it, which needs no alignment, so this ends after a few rounds and leaves no text out.
    """
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # stated, as pieces are few bytes and much work
    found = None
    while True:
        sliced = texts.mapInArrow(_with(_slice, piece_chars, overlap, start), _PIECES)
        pieces = stored(sliced.repartition(tasks, "uid", "number"), "pieces")
        counted = stored(spliced(pieces.mapInArrow(_with(encode, definition), _COUNTS)), "spliced")
        aligned = counted.where("n_tokens is not null").drop("uid")
        found = aligned if found is None else found.union(aligned)
        apart = counted.where("n_tokens is null").select("uid")
        if apart.isEmpty():
            return found
        texts, overlap = rejoined(pieces.join(apart, "uid", "left_semi")), overlap * WIDEN


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    limit: int = 2048,
    piece_chars: int = PIECE_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    ``tokenizer_path`` is a ``tokenizers`` JSON file that the driver can read, of a sort that ``Boundaries`` knows (else
    it is an error). Null texts count as empty: no bytes, no tokens. Ids may be null or repeat; an empty table gives no
    row. Only doc_id and text are read, so other names cannot clash.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        told = file.read()
    start = Boundaries(told).start
    definition = spark.sparkContext.broadcast(told)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    # Bytes bound characters, and reading them costs no scan of the text.
    huge = F.col("n_bytes") > piece_chars
    whole = rows.where(~huge).mapInArrow(_with(_count, definition), "doc_id long, n_bytes long, n_tokens long")
    texts = rows.where(huge).select(F.monotonically_increasing_id().alias("uid"), "doc_id", "n_bytes", "text")
    found = counted_in_pieces(texts, definition, start, piece_chars, overlap)
    return whole.union(found).withColumn("over_limit", F.col("n_tokens") > limit)
