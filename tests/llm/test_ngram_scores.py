"""Scores of any order against counting in dictionaries, and order two against the bigram operator."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from spendmill.llm.lm_scores import score_documents
from spendmill.llm.ngram_scores import score_ngrams
from tests.llm.conftest import EDGES

COLUMNS = ("doc_id", "n_tokens", "n_backoff", "log_score", "mean_log_score")
key = lambda row: tuple((v is None, str(v)) for v in row)


def rows(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=key)


def million(x):
    return round(math.log(x) * 1_000_000)


def words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def counted(some, order):
    return Counter(tuple(some[i : i + k]) for k in range(1, order + 1) for i in range(len(some) - k + 1))


def plain(texts, order, alpha=0.4):
    split = [words(t) for t in texts]
    own = [counted(w, order) for w in split]
    every = sum(own, Counter())
    out = []
    for w, mine in zip(split, own, strict=True):
        units = backed = 0
        for i in range(len(w)):
            longest = min(order, i + 1)
            for k in range(longest, 0, -1):
                gram = tuple(w[i - k + 1 : i + 1])
                left = every[gram] - mine[gram]
                if k > 1 and left > 0:
                    units += million(left) - million(every[gram[:-1]] - mine[gram[:-1]])
                elif k == 1:
                    units += (million(left) if left > 0 else million(alpha)) - million(max(1, sum(map(len, split)) - len(w)))
                else:
                    units += million(alpha)
                    continue
                backed += k < longest
                break
        out.append((len(w), backed, units / 1e6, round(units / 1e6 / len(w), 6) if w else None))
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_scores_equal_counting_in_dictionaries(edges, order):
    want = [(e[0], *x) for e, x in zip(EDGES, plain([e[1] for e in EDGES], order), strict=True)]
    assert rows(score_ngrams(edges, order)) == sorted(want, key=key)


def test_trigrams_of_documents(documents):
    texts = documents.select("doc_id", "text").collect()
    want = [(r["doc_id"], *x) for r, x in zip(texts, plain([r["text"] for r in texts], 3), strict=True)]
    found, want = rows(score_ngrams(documents)), sorted(want, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in want]
    # A mean that ends in a half of its last digit may be rounded either way.
    assert all(a[4] == b[4] or abs(a[4] - b[4]) < 1.5e-6 for a, b in zip(found, want, strict=True))


def test_order_two_is_the_bigram_operator(documents):
    assert rows(score_ngrams(documents, 2)) == rows(score_documents(documents))


def test_nothing_and_no_order(nothing):
    assert score_ngrams(nothing).count() == 0
    with pytest.raises(ValueError, match="order"):
        score_ngrams(nothing, 0)
