"""The language model against a plain rebuild, and its bounds."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from spendmill.llm.language_id import LONGEST_GRAM, SMOOTHING, Bounds, fit_languages, identify_languages, is_held_out

FREE = Bounds(documents=None, words=None, grams=None, least_count=1, letters=None)


def split(text):
    return [w for run in re.findall(r"[^\W\d_]+", text.lower()) for w in "".join(c if c.isalpha() else " " for c in run).split()]


def grams(word, n):
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Plain:
    """Counts in dictionaries, scores word by word."""

    def __init__(self, rows, bounds):
        counts = defaultdict(Counter)
        for r in rows:
            if r["text"] is not None and r["lang"] is not None:
                counts[r["lang"]].update(split(r["text"]))
        self.languages = sorted(x for x in counts if counts[x])
        pieces = defaultdict(Counter)
        for lang in self.languages:
            for word, n in counts[lang].items():
                for size in range(1, LONGEST_GRAM + 1):
                    for g in grams(word, size):
                        pieces[lang][g] += n
        some = {x: {w: n for w, n in counts[x].items() if n >= bounds.least_count and (bounds.letters is None or len(w) <= bounds.letters)} for x in self.languages}
        words = self.most(some, bounds.words)
        kept = self.most(pieces, bounds.grams)
        every = {x: sum(counts[x].values()) for x in self.languages}
        self.words = {w: [math.log((some[x].get(w, 0) + SMOOTHING) / (every[x] + SMOOTHING * len(words))) for x in self.languages] for w in words}
        self.grams = {}
        for size in range(1, LONGEST_GRAM + 1):
            mine = [g for g in kept if len(g) == size]
            total = {x: sum(pieces[x][g] for g in mine) for x in self.languages}
            for g in mine:
                self.grams[g] = [math.log((pieces[x][g] + SMOOTHING) / (total[x] + SMOOTHING * len(mine))) for x in self.languages]

    @staticmethod
    def most(counts, bound):
        total = Counter()
        for one in counts.values():
            total.update(one)
        return sorted(total, key=lambda t: (-total[t], t.encode()))[:bound]

    def of_word(self, word):
        if word in self.words:
            return self.words[word]
        for n in range(LONGEST_GRAM, 0, -1):
            known = [self.grams[g] for g in grams(word, n) if g in self.grams]
            if known:
                return [sum(column) / n for column in zip(*known, strict=True)]
        return [0.0] * len(self.languages)

    def predict(self, text):
        words = split(text or "")
        if not words:
            return "und", 0.0
        total = [sum(column) for column in zip(*map(self.of_word, words), strict=True)]
        weights = [math.exp(x - max(total)) for x in total]
        best = max(range(len(total)), key=lambda k: (total[k], -k))
        return self.languages[best], weights[best] / sum(weights)


@pytest.mark.parametrize("bounds", [Bounds(), FREE, Bounds(words=40, grams=300, least_count=3, letters=5)])
def test_predictions_equal_a_plain_rebuild(documents, bounds):
    rows = documents.select("doc_id", "text", "lang").collect()
    learned = [r for r in rows if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    assert len(learned) < 4_000  # the sample is all of them
    plain = Plain(learned, bounds)
    found = identify_languages(documents, bounds=bounds).collect()
    assert len(found) == len(rows)
    texts = {r["doc_id"]: r["text"] for r in rows}
    for r in found:
        lang, score = plain.predict(texts[r["doc_id"]])
        assert r["score"] == pytest.approx(score, abs=1e-9)
        assert r["lang_pred"] == lang or score == pytest.approx(1 / 2, abs=1e-9)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_bounds_bound_the_model(documents):
    seen = documents.where(~is_held_out())
    free = fit_languages(seen, bounds=FREE)
    small = fit_languages(seen, bounds=Bounds(documents=50, words=40, grams=300, letters=5))
    assert len(small.words) == 40 and len(small.grams) == 300 and max(map(len, small.words)) <= 5
    assert len(free.words) > 40 and set(small.words) <= set(free.words)
    assert free.languages == small.languages == tuple(sorted(r["lang"] for r in seen.where("lang is not null").select("lang").distinct().collect()))


def test_long_words_fall_back_to_their_grams(spark):
    rows = [(i, "gut" * 30, "de") for i in range(20)] + [(i, "bon" * 30, "fr") for i in range(20, 40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert fit_languages(frame).words == {} and len(fit_languages(frame, bounds=FREE).words) == 2
    for bounds in (Bounds(), FREE):
        found = identify_languages(frame, bounds=bounds)
        assert found.join(frame, "doc_id").where(F.col("lang_pred") != F.col("lang")).count() == 0
