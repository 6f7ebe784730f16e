"""The pipeline's decisions by row: null and repeated ids, and tables without labels."""

from __future__ import annotations

import zlib

import corpus_pipeline as cp

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LEAK = "one two three four five six seven eight nine ten"
FIRST = "the quick brown fox jumps over the lazy dog and runs away from all the hounds of the old hunter"


def survivors(spark, tmp_path, docs, items=((1, LEAK),)):
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        frame = cp.stored(stage(spark, frame, str(tmp_path)), "stage")
    return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=str)


def rows(*pairs, lang="en"):
    return [(i, t, lang, "a", len(t or "")) for i, t in pairs]


def test_null_and_repeated_ids_have_decisions_of_their_own(spark, tmp_path):
    other, third = "a wholly different text about cooking rice", "yet another text that nobody has copied"
    for ident, folder in ((None, "null"), (7, "same")):
        near = f"{FIRST} today"
        docs = rows((1, "labelled text to learn from"), (2, "more labelled text for the model"), (3, "some further words"))
        docs += rows(*((ident, t) for t in (FIRST, FIRST, near, other, other, "12 34", None, f"so {LEAK} it is", third)))
        got = survivors(spark, tmp_path / folder, docs)
        assert [t for i, t in got if i == ident and t not in (FIRST, near)] == sorted([other, third])
        assert len([t for i, t in got if t in (FIRST, near)]) == 1
        assert [i for i, _ in got if i != ident] == [1, 2, 3]


def test_a_fully_repeated_row_stays_once(spark, tmp_path):
    got = survivors(spark, tmp_path, rows((1, FIRST), (1, FIRST), (1, FIRST), (2, "another labelled text"), (3, "more words")))
    assert [i for i, _ in got] == [1, 2, 3]


def test_a_table_without_labels_passes_the_language_stage(spark, tmp_path):
    texts = rows((1, FIRST), (2, "12 34"), (3, None), (4, "words of no known language"), lang=None)
    assert [i for i, _ in survivors(spark, tmp_path / "null", texts)] == [1, 4]
    held = [(i, f"held out text number {w}", "en", "a", 20) for i, w in zip(range(400), "ab" * 200) if zlib.crc32(str(i).encode()) % 4 == 2]
    frame = cp.language_stage(spark, spark.createDataFrame(held, SCHEMA), str(tmp_path))
    assert frame.count() == len(held) > 0
