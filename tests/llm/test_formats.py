"""Archives, tokenizers and words as they come from elsewhere: many gzip members, other tokenizers, texts without spaces."""

from __future__ import annotations

import base64
import gzip
import json
import random
import time

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from spendmill.llm import warc
from spendmill.llm.pieces import LONG_WORD, Encoder, PieceModel, read_model
from spendmill.llm.token_counts import Boundaries, _encode_pieces, counted_in_pieces, cut, token_counts
from spendmill.llm.warc import captures, parse_records, read_records, unpacked, write_archives

PIECES = public_tokenizers.path("piece_bpe_32k.model")


# -- 4 ----------------------------------------------------------------------------------------


def _record(kind: str, number: int, block: bytes) -> bytes:
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{number}>\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


RECORDS = [_record("warcinfo", 0, b"software: x"), *(_record("resource", i, bytes([65 + i]) * n) for i, n in enumerate((0, 1, 70_000, 3_000_000, 5), 1))]


@pytest.mark.parametrize("members", ["one for each record", "one", "cut inside records", "padded"])
def test_archives_of_many_members_keep_every_record(spark, tmp_path, members):
    whole = b"".join(RECORDS)
    parts = {"one for each record": RECORDS, "one": [whole], "cut inside records": [whole[i : i + 50_001] for i in range(0, len(whole), 50_001)], "padded": RECORDS}[members]
    data = (b"\0" * 3 * (members == "padded")).join(gzip.compress(p) for p in parts)
    (tmp_path / "a.warc.gz").write_bytes(data)
    found = read_records(spark, str(tmp_path)).orderBy("record_id").collect()
    assert [(r["record_id"], r["warc_type"]) for r in found] == [(f"<{i}>", "warcinfo" if i == 0 else "resource") for i in range(6)]
    assert [bytes(r["payload"]) for r in found[1:]] == [bytes([65 + i]) * n for i, n in enumerate((0, 1, 70_000, 3_000_000, 5), 1)]
    assert [h["warc-record-id"] for h, _ in parse_records(unpacked(data, 17))] == [[f"<{i}>"] for i in range(6)] if members == "one" else True
    with pytest.raises(ValueError, match="cut off"):
        list(parse_records(unpacked(data[:-12])))


def test_files_of_large_payloads_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LARGE_BYTES", 1000)
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    pages = [(i, "http://a", "y" * (9_000 + i) if i % 2 else f"small {i}") for i in range(40)] + [(99, "http://a", "y" * 9_001)]
    write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"), compression="none")
    sizes = sorted(f.stat().st_size for f in (tmp_path / "w").glob("part-*"))
    assert len(sizes) >= 11 and sizes[-2] < 30_000
    found = captures(read_records(spark, str(tmp_path / "w"))).collect()
    assert len(found) == 41 and [(r["refers_to"], r["payload_bytes"]) for r in found if r["record_type"] == "revisit"] == [(1, 9_001)]


# -- 5 ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PieceModel(*read_model(PIECES)))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.mark.parametrize("kind", ["letters", "base64", "chinese", "one letter", "spaces"])
def test_words_of_a_megabyte(encoder, library, kind):
    rng = random.Random(3)
    text = {
        "letters": lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)),
        "base64": lambda: base64.b64encode(rng.randbytes(750_000)).decode(),
        "chinese": lambda: "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(340_000)),
        "one letter": lambda: "a" * 1_000_000,
        "spaces": lambda: " " * 1_000_000,
    }[kind]()
    began = time.process_time()
    ids, _ = encoder.encode([text])
    took = time.process_time() - began
    assert ids.tolist() == library.encode(text, num_threads=1)
    assert took < 30


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aberntsh é漢0=", min_size=LONG_WORD - 5, max_size=3 * LONG_WORD))
def test_heap_and_rounds_agree_with_the_library(encoder, library, text):
    assert encoder.encode([text])[0].tolist() == library.encode(text)
    bare = text.replace(" ", "") or "a"
    assert encoder.model._encode_long(bare).tolist() == encoder.model._encode_rounds([bare])[0].tolist()


# -- 7 ----------------------------------------------------------------------------------------

ODD = ["hello   world  again\t\tx", "<|endoftext|>a " * 30, "x" * 500, " " * 500, "a　b\x1c c  d " * 40, "it's we'll 12 é ́ " * 30, "\n\n a\n b " * 60, "", " lead", "trail ", "漢字 漢 😀 " * 50]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize(("chars", "overlap"), [(32_768, 256), (64, 4)])
def test_counts_equal_the_library_for_either_tokenizer(spark, name, chars, overlap):
    path = public_tokenizers.path(name)
    tokenizer = Tokenizer.from_file(path)
    texts = ODD + [" ".join(ODD), "plain words and more of them, " * 300]
    found = token_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, piece_chars=chars, overlap=overlap)
    assert {r["doc_id"]: r["n_tokens"] for r in found.collect()} == {i: len(tokenizer.encode(t, add_special_tokens=False)) for i, t in enumerate(texts)}


@pytest.mark.parametrize("seen_from", [40, 10**9])
def test_pieces_that_do_not_align_are_cut_with_wider_overlaps(spark, seen_from):
    """An encoder that hides boundaries of overlaps under ``seen_from`` characters; at the most every text ends as one piece."""
    path = public_tokenizers.path("word_bpe_49k.json")
    told, tokenizer = open(path, encoding="utf-8").read(), Tokenizer.from_file(path)
    texts = ["plain words and more of them, " * 30, "it's we'll 12 é ́ " * 30, "x" * 500, "short"]
    rounds = spark.sparkContext.accumulator(0)

    def hiding(definition, batches):
        for batch in _encode_pieces(definition, batches):
            row = batch.to_pylist()[0]
            rounds.add(1)
            for side in ("head", "tail"):
                if row[side] and row[side][-1] - row[side][0] < seen_from:
                    row[side], row[f"{side}_tokens"] = [], []
            yield pa.RecordBatch.from_pylist([row], batch.schema)

    frame = spark.createDataFrame([(i, i, len(t.encode()), t) for i, t in enumerate(texts)], "uid long, doc_id long, n_bytes long, text string")
    found = counted_in_pieces(frame, spark.sparkContext.broadcast(told), Boundaries(told).start, 64, 4, hiding)
    assert {r["doc_id"]: r["n_tokens"] for r in found.collect()} == {i: len(tokenizer.encode(t, add_special_tokens=False)) for i, t in enumerate(texts)}
    once = sum(len(list(cut(t, 64, 4))) for t in texts)
    assert rounds.value > once


def test_tokenizers_without_certain_boundaries_are_refused():
    told = json.loads(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    assert not Boundaries(json.dumps(told)).cut_words
    with pytest.raises(ValueError, match="no certain boundaries"):
        Boundaries(json.dumps(told | {"pre_tokenizer": told["pre_tokenizer"] | {"add_prefix_space": True}}))
    with pytest.raises(ValueError, match="white space"):
        Boundaries(json.dumps(told | {"added_tokens": [told["added_tokens"][0] | {"content": "two words"}]}))
