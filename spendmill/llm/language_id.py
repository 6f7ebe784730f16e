"""Language identification by words first, then by ever shorter character n-grams for words never seen.

The model is fitted on a bounded sample of labelled documents and holds bounded tables (``Bounds``), so what is sent to
the tasks does not grow with the corpus. Prediction reads every word of every text.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stored
from .words import remembered, text_groups

LONGEST_GRAM = 4
SMOOTHING = 0.5
CACHED_WORDS = 200_000
UNKNOWN = "und"
_RUN = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    runs = _RUN.findall(text.lower())
    if all(map(str.isalpha, runs)):
        return runs
    # Numerals such as one half pass the pattern but are no letters.
    return [w for r in runs for w in "".join(c if c.isalpha() else " " for c in r).split()]


def grams_of(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass(frozen=True)
class Bounds:
    """What a model is fitted on and how large it gets; None lifts a bound.

    ``documents``: sampled labelled documents of a language. ``words``, ``grams``: the most frequent that are kept; any
    other word falls back to its n-grams. ``least_count``: how often a word must be seen in a language to be known in
    it. ``letters``: longer words are not kept as words (their n-grams are).
    """

    documents: int | None = 4_000
    words: int | None = 100_000
    grams: int | None = 60_000
    least_count: int = 2
    letters: int | None = 63


@dataclass(frozen=True)
class LanguageModel:
    """Log frequencies per language: of words, and of n-grams of each length."""

    languages: tuple[str, ...]
    words: dict[str, tuple[float, ...]]
    grams: dict[str, tuple[float, ...]]

    def score_word(self, word: str) -> np.ndarray:
        """A word's log frequencies; of an unseen word the mean over the longest n-grams of it that are known."""
        if word in self.words:
            return np.array(self.words[word])
        for n in range(LONGEST_GRAM, 0, -1):
            known = [self.grams[g] for g in grams_of(word, n) if g in self.grams]
            if known:
                return np.array(known).sum(axis=0) / n  # every letter is in n of them
        return np.zeros(len(self.languages))


def is_held_out(id_col: str = "doc_id") -> Column:
    """Whether the row is kept from training: crc32 of the id as text leaves 2 when divided by 4 (null: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            counts.setdefault(lang, Counter()).update(words_of(text))
    for lang, words in counts.items():
        columns = [pa.array([lang] * len(words)), pa.array(words.keys()), pa.array(words.values(), pa.int64())]
        if words:
            yield pa.RecordBatch.from_arrays(columns, ["lang", "token", "n"])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for lang, word, n in zip(*(batch[c].to_pylist() for c in ("lang", "token", "n")), strict=True):
            for size in range(1, LONGEST_GRAM + 1):
                for gram in grams_of(word, size):
                    counts[lang, gram] += n
    langs, grams = zip(*counts, strict=True) if counts else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(grams, pa.string()), pa.array(list(counts.values()), pa.int64())], ["lang", "token", "n"])


def _most_frequent(counts: DataFrame, most: int | None) -> list[tuple[str, dict[str, int]]]:
    """The ``most`` most frequent tokens with their counts by language (bounded by ``most``, else by the sample)."""
    entry = F.map_from_entries(F.collect_list(F.struct("lang", "n")))
    rows = counts.groupBy("token").agg(entry.alias("by_lang"), F.sum("n").alias("n"))
    if most is not None:
        rows = rows.orderBy(F.desc("n"), "token").limit(most)
    return [(r["token"], r["by_lang"]) for r in rows.collect()]


def _log_frequencies(tokens: list[tuple[str, dict[str, int]]], languages: tuple[str, ...], totals: dict) -> dict[str, tuple]:
    kinds = Counter(len(t) for t, _ in tokens) if None not in totals else None
    table = {}
    for token, by_lang in tokens:
        key = None if kinds is None else len(token)
        every = totals[key]
        size = len(tokens) if kinds is None else kinds[key]
        table[token] = tuple(float(np.log((by_lang.get(x, 0) + SMOOTHING) / (every[x] + SMOOTHING * size))) for x in languages)
    return table


def fit_languages(docs: DataFrame, *, bounds: Bounds = Bounds()) -> LanguageModel:
    """Learn from (text, lang) of rows with both, at most about ``bounds.documents`` of each language.

    The sample is drawn by a hash of the row, at a rate that a count of the labels gives (copies count one by one). Languages without a
    letter in their texts are not learned; without any labelled row the model has no language.
    """
    rows = docs.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in docs.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LanguageModel((), {}, {})
    # Rates only below 1: a language with fewer documents is taken whole.
    rates = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, 1.0 if bounds.documents is None else min(1.0, bounds.documents / n))))
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < rates[F.col("lang")] * 1_000_000)
    counts = drawn.mapInArrow(_count_words, "lang string, token string, n long").groupBy("lang", "token").agg(F.sum("n").alias("n"))
    counts = stored(counts, "words")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = tuple(sorted(totals))
    if not languages:
        return LanguageModel((), {}, {})
    grams = counts.mapInArrow(_count_grams, "lang string, token string, n long").groupBy("lang", "token").agg(F.sum("n").alias("n"))
    top_grams = _most_frequent(grams, bounds.grams)
    by_size: dict = {n: dict.fromkeys(languages, 0) for n in range(1, LONGEST_GRAM + 1)}
    for gram, by_lang in top_grams:
        for lang, n in by_lang.items():
            by_size[len(gram)][lang] += n
    known = counts.where(F.col("n") >= bounds.least_count)
    if bounds.letters is not None:
        known = known.where(F.length("token") <= bounds.letters)
    words = _most_frequent(known, bounds.words)
    return LanguageModel(languages, _log_frequencies(words, languages, {None: totals}), _log_frequencies(top_grams, languages, by_size))


class Scorer:
    """Scores texts; the vectors of words met before are kept, up to ``CACHED_WORDS`` of them."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.vectors = np.empty((0, len(self.model.languages)))

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(posterior of each language, number of words) for each text."""
        split = [words_of(t) for t in texts]
        new = set(chain.from_iterable(split)).difference(self.index)
        if len(self.index) + len(new) > CACHED_WORDS:
            self._forget()
            new = set(chain.from_iterable(split))
        if new:
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.vectors = np.concatenate([self.vectors, [self.model.score_word(w) for w in new]])
        at = np.array(list(map(self.index.__getitem__, chain.from_iterable(split))), dtype=np.int64)
        n = np.array([len(words) for words in split])
        row = np.repeat(np.arange(len(texts)), n)
        sums = [np.bincount(row, self.vectors[at, k], len(texts)) for k in range(len(self.model.languages))]
        total = np.stack(sums, axis=1)
        weight = np.exp(total - total.max(axis=1, keepdims=True))
        return weight / weight.sum(axis=1, keepdims=True), n


def predict_languages(docs: DataFrame, model: LanguageModel, row_col: str | None = None) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of each row: the likeliest language (ties: the first by name), its posterior.

    ``und`` with score 0 where the text is null or has no letter, or the model knows no language; rejected is true
    for the former alone, whatever the model knows. Only doc_id and
    text are read, and ``row_col``, a column of numbers that is carried into the result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = f"languages-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = remembered(key, lambda: Scorer(shared.value))
        for batch in batches:
            texts = [x or "" for x in batch["text"].to_pylist()]
            for lo, hi in text_groups(texts):
                names, scores = [UNKNOWN] * (hi - lo), np.zeros(hi - lo)
                if not scorer.model.languages:
                    n = np.array([len(words_of(t)) for t in texts[lo:hi]])
                else:
                    posterior, n = scorer.score(texts[lo:hi])
                    best = posterior.argmax(axis=1)
                    names = [scorer.model.languages[k] if some else UNKNOWN for k, some in zip(best, n, strict=True)]
                    scores = np.where(n > 0, posterior[np.arange(hi - lo), best], 0.0)
                carried = [batch[c][lo:hi] for c in numbers]
                found = [pa.array(names), pa.array(scores), pa.array(n == 0)]
                yield pa.RecordBatch.from_arrays([*carried, *found], [*numbers, "lang_pred", "score", "rejected"])

    numbers = [row_col, "doc_id"] if row_col else ["doc_id"]
    read = docs.select(*(F.col(c).cast("long").alias(c) for c in numbers), "text")
    return read.mapInArrow(run, "".join(f"`{c}` long, " for c in numbers) + "lang_pred string, score double, rejected boolean")


def identify_languages(docs: DataFrame, *, row_col: str | None = None, bounds: Bounds = Bounds()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected): learned from rows that are not held out, predicted for all rows.

    Rows with a null id are not held out and not learned from. Repeated rows each get their prediction, with the
    row's number where ``row_col`` names a column that has it.
    """
    seen = docs.where(F.col("doc_id").isNotNull() & ~is_held_out())
    model = fit_languages(seen, bounds=bounds)
    number = [row_col] if row_col else []
    return predict_languages(docs, model, row_col).select(*number, "doc_id", is_held_out().alias("held_out"), "lang_pred", "score", "rejected")
