"""The pipeline against a plain rebuild, and what its stages return."""

from __future__ import annotations

import hashlib
import re

import public_tokenizers
import sentencepiece

import corpus_pipeline as cp

SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def test_pipeline_equals_a_plain_rebuild(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = {i: t for i, t in docs.items() if any(c.isalpha() for c in t)}
    best = {}
    for i, t in docs.items():
        bare = re.sub(r"[ \t-\r]", "", t)
        best[bare] = min(best.get(bare, (1, 0)), (-len(t), i))
    docs = {i: docs[i] for _, i in best.values()}
    sets = {i: {tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4))} for i, t in docs.items() if (w := words(t))}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    parent = {i: i for i in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    common = {}
    for ids in holders.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                common[a, b] = common.get((a, b), 0) + 1
    for (a, b), n in common.items():
        if n / (len(sets[a]) + len(sets[b]) - n) >= 0.8:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    docs = {i: t for i, t in docs.items() if root(i) == i}
    phrases = {tuple(q[p : p + min(10, len(q))]) for q in items for p in range(max(1, len(q) - 9))}
    clean = {i: t for i, t in docs.items() if not any(tuple(w[p : p + 10]) in phrases for w in [words(t)] for p in range(len(w)))}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = sorted((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))) for i, t in clean.items() for ids in [library.encode(t)])
    assert 0 < len(clean) < len(docs)
    assert sorted(map(tuple, cp.run(spark, SF).collect())) == want


def test_stages_take_edges_and_nothing(spark, edges, nothing):
    for frame in (edges, nothing):
        docs = frame
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            assert name == cp.STAGES[-1][0] or tuple(out.columns) == cp.COLUMNS
            docs = spark.createDataFrame(out.collect(), out.schema)
        left = [r["doc_id"] for r in docs.collect()]
        # Null ids stay together: one of the two rows has a text without a language, the other's decision holds.
        assert sorted(x for x in left if x is not None) == ([2, 6, 7, 9, 10] if frame is edges else [])
