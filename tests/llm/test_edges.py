"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names in every operator."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from spendmill.llm.decontaminate import PositionalIndex, contamination
from spendmill.llm.exact_dedup import CuckooFilter, LiveDigests, exact_dedup, text_digests
from spendmill.llm.language_id import fit_languages, identify_languages, words_of
from spendmill.llm.lm_scores import score_documents
from spendmill.llm.ngram_join import bands_and_rows, near_duplicates
from spendmill.llm.pieces import Encoder, PieceModel, decode_pieces, encode_pieces, piece_digests, read_model
from spendmill.llm.sharding import shard_documents
from spendmill.llm.substring_dedup import remove_repeats
from spendmill.llm.token_counts import cut, token_counts
from spendmill.llm.warc import assemble, captures, parse_records, read_records, write_archives
from tests.llm.conftest import EDGES, WORDS

PIECES = public_tokenizers.path("piece_bpe_32k.model")
COUNTED = public_tokenizers.path("word_bpe_49k.json")
sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
key = lambda row: tuple((v is None, str(v)) for v in row)


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=key)


# -- 1 ----------------------------------------------------------------------------------------


def test_language_of_edges(edges):
    found = {r["doc_id"]: r for r in identify_languages(edges).collect() if r["doc_id"] is not None}
    assert {i for i, r in found.items() if r["lang_pred"] == "und"} == {3, 4, 5, 12}
    assert all((r["score"] == 0) == (r["lang_pred"] == "und") and 0 <= r["score"] <= 1 for r in found.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    assert identify_languages(edges).count() == len(EDGES)


def test_language_without_labels(nothing, spark):
    assert identify_languages(nothing).count() == 0
    frame = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert rows(identify_languages(frame), "lang_pred", "score") == [("und", 0.0)]
    assert fit_languages(frame).languages == ()


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right = found.where("lang = lang_pred").count() / found.count()
    assert right > 0.98
    assert words_of("½x²Ab_c 1é") == ["x", "ab", "c", "é"]


def test_held_out_labels_teach_nothing(spark):
    docs = [(i, "uno dos tres", "es") for i in range(40)]
    held = {i for i, *_ in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    docs = [(i, t, "xx" if i in held else lang) for i, t, lang in docs]
    found = identify_languages(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in found.collect()} == {"es"}


# -- 2 ----------------------------------------------------------------------------------------


def test_exact_groups_of_edges(edges, nothing):
    found = rows(exact_dedup(edges, keys_per_bucket=3), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    bare = lambda t: re.sub(r"[ \t-\r]", "", t or "")
    groups = collections.defaultdict(list)
    for i, t, *_ in EDGES:
        groups[bare(t)].append((-len(t or ""), i is None, i or 0, i))
    want = []
    for i, t, *_ in EDGES:
        best = min(groups[bare(t)])
        want.append((i, best[3], len(groups[bare(t)]), (i, -len(t or "")) == (best[3], best[0]), sha(bare(t))))
    assert found == sorted(want, key=key)
    assert exact_dedup(nothing).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 200)), max_size=400))
def test_cuckoo_filter_never_forgets(steps):
    keys = np.random.default_rng(1).integers(1 << 62, size=201).astype(np.uint64)
    filt, live = CuckooFilter(8), collections.Counter()
    for add, k in steps:
        if add:
            live[k] += 1
            while not filt.insert(keys[[k]]):
                filt = CuckooFilter(2 * filt.capacity)
                if filt.insert(keys[[k for k, n in live.items() for _ in range(n - (k == steps[-1][1]))]]):
                    break
        elif live[k]:
            live[k] -= 1
            filt.delete(keys[[k]])
        if len(live) > 60:
            break
    there = [k for k, n in live.items() if n > 0]
    if there and max(live.values()) < 4:
        assert filt.contains(keys[there]).all()


def test_index_takes_batches_and_deletions(spark, documents):
    digests = text_digests(documents)
    distinct = digests.select("digest").distinct().count()
    index = LiveDigests(spark, buckets=3)
    first = index.insert(digests.where("id < 100"))
    assert first.where("was_live").isEmpty()
    again = index.insert(digests)
    assert again.where("was_live").count() == first.count() and again.count() == distinct
    gone = index.delete(digests.where("id < 50"))
    assert gone.where("not was_live").isEmpty()
    assert index.rows().count() == distinct - gone.count()
    assert index.delete(digests.where("id < 50")).where("was_live").isEmpty()
    index.insert(digests.where("id < 50"))
    assert index.rows().count() == distinct


# -- 3 ----------------------------------------------------------------------------------------


def plain_scores(texts, alpha=0.4):
    units = lambda x: int(np.rint(np.log(x) * 1e6))
    split = [re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    one = [collections.Counter(w) for w in split]
    two = [collections.Counter(zip(w, w[1:], strict=False)) for w in split]
    all_one, all_two = sum(one, collections.Counter()), sum(two, collections.Counter())
    for k, w in enumerate(split):
        left = max(sum(map(len, split)) - len(w), 1)
        total = backed = 0
        for i, x in enumerate(w):
            others = all_one[x] - one[k][x]
            word = (units(others) if others else units(alpha)) - units(left)
            pair = (w[i - 1], x)
            if i and all_two[pair] > two[k][pair]:
                total += units(all_two[pair] - two[k][pair]) - units(all_one[pair[0]] - one[k][pair[0]])
            else:
                total, backed = total + word + (units(alpha) if i else 0), backed + (i > 0)
        yield len(w), backed, total / 1e6, round(total / 1e6 / len(w), 6) if w else None


@pytest.mark.parametrize(("entries", "share"), [(2_000_000, None), (500, 0.01), (2_000, 0.002)])
def test_scores_of_edges(edges, entries, share):
    found = rows(score_documents(edges, group_entries=entries, hot_share=share), "doc_id", "n_tokens", "n_backoff", "log_score", "mean_log_score")
    want = [(e[0], *x) for e, x in zip(EDGES, plain_scores([e[1] for e in EDGES]), strict=True)]
    assert found == sorted(want, key=key)


def test_scores_of_nothing(nothing):
    assert score_documents(nothing).count() == 0


# -- 4 ----------------------------------------------------------------------------------------

PAGES = [
    (5, "http://a/b?c", "same"),
    (3, "with space", "same"),
    (3, "with space", "same"),
    (None, None, None),
    (9, "http://[bad", ""),
    (7, "é", "WARC/1.1\r\n\r\nWARC-Type: x\r\n\r\n"),
    (7, "é", "same"),
    (8, None, "x" * 300_000),
]


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_round_trip(spark, tmp_path, compression):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS equal", "3 AS capture")
    write_archives(pages.repartition(3), str(tmp_path / "w"), compression=compression, records_per_file=4)
    records = read_records(spark, str(tmp_path / "w"))
    assert records.count() == 3 * len(PAGES)
    assert sorted(bytes(r["payload"]).decode() for r in records.where("warc_type = 'response'").collect()) == sorted({h or "" for _, _, h in PAGES})
    found = rows(captures(records), "page_id", "payload_bytes", "record_type", "refers_to")
    want = [(3, 4, "response", None), (3, 4, "revisit", 3), (5, 4, "revisit", 3), (7, 4, "revisit", 3), (8, 300_000, "response", None)]
    want += [(7, len(PAGES[5][2]), "response", None), (9, 0, "response", None), (None, 0, "revisit", 9)]
    assert found == sorted(want, key=key)
    nested = assemble(records).collect()
    assert all(len(r["requests"]) == len(r["metadata"]) == 1 for r in nested)
    assert {r["metadata"][0]["fields"].get("page-id") for r in nested} == {"3", "5", "7", "8", "9", None}


def test_small_payloads_are_all_responses(spark, tmp_path):
    write_archives(spark.createDataFrame(PAGES, "page_id long, url string, html string"), str(tmp_path / "w"), smallest=5)
    assert captures(read_records(spark, str(tmp_path / "w"))).where("record_type = 'revisit'").isEmpty()


def test_transactions_tied_in_other_ways(spark):
    schema = "record_id string, warc_type string, concurrent_to array<string>, refers_to string, fields map<string,string>"
    records = [("<h1>", "response", [], None, {}), ("<r1>", "request", ["<h1>"], None, {}), ("<m1>", "metadata", ["<r1>"], None, {})]
    records += [("<h2>", "resource", ["<m2>"], None, {}), ("<m2>", "metadata", [], None, {}), ("<lost>", "metadata", ["<none>"], None, {})]
    found = {r["capture_id"]: r for r in assemble(spark.createDataFrame(records, schema)).collect()}
    ids = lambda x: [y["record_id"] for y in x]
    assert {k: (ids(r["requests"]), ids(r["metadata"])) for k, r in found.items()} == {"<h1>": (["<r1>"], ["<m1>"]), "<h2>": ([], ["<m2>"])}


def test_damaged_archives_are_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="cut off"):
        list(parse_records(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))
    with pytest.raises(ValueError, match="no WARC record"):
        list(parse_records(b"HTTP/1.1 200 OK\r\n\r\n"))
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert read_records(spark, str(tmp_path / "w")).count() == 0


# -- 5 ----------------------------------------------------------------------------------------

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)
MODEL = PieceModel(*read_model(PIECES))
ODD = ["a", "b", "the", "ing", " ", "  ", "▁", "\n", "é", "é", "漢", "1", "!!", "\x00", "\U0001f600", "<s>", "<unk>", "<0x0A>", "aaaa", "İ"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40) | st.lists(st.sampled_from(ODD), max_size=40).map("".join), max_size=8))
def test_pieces_are_the_librarys(texts):
    ids, offsets = Encoder(MODEL).encode(texts)
    for text, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
        assert ids[a:b].tolist() == LIBRARY.encode(text)
        assert MODEL.decode(ids[a:b]) == LIBRARY.decode(LIBRARY.encode(text))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 300) | st.integers(0, 31_999), max_size=12))
def test_any_ids_decode_as_in_the_library(ids):
    assert MODEL.decode(np.array(ids, dtype=np.int32)) == LIBRARY.decode(ids)


def test_pieces_of_edges(edges, nothing):
    found = rows(piece_digests(edges, PIECES), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = []
    for i, t, *_ in EDGES:
        ids = LIBRARY.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))))
    assert found == sorted(want, key=key)
    back = rows(decode_pieces(encode_pieces(edges, PIECES), PIECES), "doc_id", "text")
    assert back == sorted(((i, t or "") for i, t, *_ in EDGES), key=key)
    assert piece_digests(nothing, PIECES).count() == 0


# -- 6 ----------------------------------------------------------------------------------------


def words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


ITEMS = [(1, " ".join(WORDS[5:25])), (2, "GAMMA delta"), (3, None), (4, "..."), (None, "alpha beta"), (2, "gamma delta"), (10, " ".join(WORDS[40:52])), (5, "long1 long2 long3")]


@pytest.mark.parametrize("block", [100_000, 3])
def test_contamination_of_edges(spark, edges, nothing, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS slice", "2 AS hits")
    found = PositionalIndex.build(edges).phrases(items, block_windows=block)
    got = sorted(((r["doc_id"], r["n_words"], sum(h["end"] - h["start"] for h in _union(r["hits"])), tuple(sorted(set(r["items"])))) for r in found.collect()), key=key)
    want = []
    for i, t, *_ in EDGES:
        w, hit, names = words(t), set(), set()
        for item, text in ITEMS:
            q = words(text)
            n = min(10, len(q))
            for a in range(len(q) - n + 1 if q and item is not None else 0):
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == q[a : a + n]:
                        hit |= set(range(p, p + n))
                        names.add(item)
        want.append((i, len(w), len(hit), tuple(sorted(names))))
    assert got == sorted(want, key=key)
    digests = {r["doc_id"]: r for r in contamination(edges, items).collect()}
    assert digests[8]["items_sha256"] == sha("1,10") and digests[3]["items_sha256"] == sha("") and not digests[3]["contaminated"]
    assert contamination(nothing, items).count() == 0
    assert contamination(edges, spark.createDataFrame([], "item_id long, text string")).where("contaminated").isEmpty()


def _union(hits):
    out = []
    for h in sorted(hits):
        if out and h["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], h["end"])
        else:
            out.append({"start": h["start"], "end": h["end"]})
    return out


def test_close_matches(spark):
    docs = [(1, "a b x c d"), (2, "d c b a"), (3, "a b x x x x c d"), (4, "a b"), (5, "c d"), (6, None), (7, "a b c d a")]
    items = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    found = rows(PositionalIndex.build(frame).close(items, window=4, slop=2), "doc_id", "item_id", "start")
    want = []
    for i, t in docs:
        w = words(t)
        want += [(i, 1, s) for s in range(len(w)) if w[s] in "abcd" and set("abcd") <= set(w[s : s + 6])]
    assert found == sorted(want, key=key)


# -- 7 ----------------------------------------------------------------------------------------


@pytest.mark.parametrize(("chars", "overlap"), [(32_768, 256), (64, 4)])
def test_token_counts_of_edges(spark, edges, nothing, chars, overlap):
    tokenizer = Tokenizer.from_file(COUNTED)
    odd = ["<|endoftext|>a " * 30, "x" * 500, " " * 500, "a　b\x1c c  d " * 40, "it's we'll 12 é ́ " * 30]
    texts = [(e[0], e[1]) for e in EDGES] + list(enumerate(odd, 100))
    frame = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 AS uid", "2 AS number")
    found = rows(token_counts(frame.repartition(3), COUNTED, piece_chars=chars, overlap=overlap), "doc_id", "n_bytes", "n_tokens", "over_limit")
    counts = [len(tokenizer.encode(t or "", add_special_tokens=False)) for _, t in texts]
    assert found == sorted(((i, len((t or "").encode()), n, n > 2048) for (i, t), n in zip(texts, counts, strict=True)), key=key)
    assert token_counts(nothing, COUNTED).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \n'é", max_size=300))
def test_pieces_of_a_text_cover_it(text):
    parts = list(cut(text, 20, 3))
    assert parts[0][0] == 0 and parts[-1][3] == len(text)
    assert all(a[2] == b[0] and a[3] == b[1] and b[0] <= a[3] for a, b in zip(parts, parts[1:], strict=False))


# -- 8 ----------------------------------------------------------------------------------------


@pytest.mark.parametrize(("suffixes", "cells"), [(1_500_000, 1 << 14), (40, 16), (500, 64)])
def test_repeats_of_edges(edges, nothing, suffixes, cells):
    found = rows(remove_repeats(edges, group_suffixes=suffixes, cells=cells), "doc_id", "n_words", "n_removed", "kept")
    split = [(e[0], re.findall(r"[^ \t-\r]+", e[1] or "")) for e in EDGES]
    first = {}
    for i, w in split:
        for p in range(len(w) - 12):
            at = tuple(w[p : p + 13])
            first[at] = min(first.get(at, np.inf), np.inf if i is None else i)
    want = []
    for i, w in split:
        gone = {q for p in range(len(w) - 12) if first[tuple(w[p : p + 13])] < (np.inf if i is None else i) for q in range(p, p + 13)}
        want.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    assert found == sorted(want, key=key)
    assert remove_repeats(nothing).count() == 0


# -- 9 ----------------------------------------------------------------------------------------


@pytest.mark.parametrize(("nodes", "shingles"), [(512, 1_000_000), (2, 50)])
def test_near_duplicates_of_edges(spark, edges, nothing, nodes, shingles):
    base = [f"v{i}" for i in range(80)]
    more = [(100 + k, " ".join(base[:k] + ["changed"] + base[k + 1 :])) for k in range(0, 80, 9)]
    frame = edges.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    found = rows(near_duplicates(frame, block_nodes=nodes, block_shingles=shingles), "doc_id", "class_id", "n_links")
    sets = []
    for i, t in [(e[0], e[1]) for e in EDGES] + more:
        w = words(t)
        sets.append((i, {tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4))} if w else set()))
    links = [{b for b, (_, y) in enumerate(sets) if a != b and x and y and len(x & y) / len(x | y) >= 0.8} for a, (_, x) in enumerate(sets)]
    want = []
    for a, (i, _) in enumerate(sets):
        seen, todo = {a}, [a]
        while todo:
            todo += (new := links[todo.pop()] - seen)
            seen |= new
        want.append((i, min((sets[b][0] for b in seen if sets[b][0] is not None), default=None), len(links[a])))
    assert found == sorted(want, key=key)
    assert near_duplicates(nothing).count() == 0


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.999), (0.5, 0.9), (0.9, 0.99)):
        bands, size = bands_and_rows(threshold, recall)
        assert 1 - (1 - threshold**size) ** bands >= recall and bands * size <= 320


# -- 10 ---------------------------------------------------------------------------------------


def test_shards_of_edges(edges, nothing):
    found = shard_documents(edges, 4).collect()
    assert sorted(r["size"] for r in found) == sorted(len((e[1] or "").encode()) + 8 for e in EDGES)
    by_shard = collections.defaultdict(list)
    for r in found:
        by_shard[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 4
    assert all(sorted(x) == list(range(len(x))) for x in by_shard.values())
    shards = collections.defaultdict(set)
    for r in found:
        shards[r["text_crc32"]].add(r["shard"])
    assert max(map(len, shards.values())) == 1
    assert shard_documents(nothing).count() == 0


def test_shards_are_near_equal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    sizes = [r["n"] for r in shard_documents(docs).groupBy("shard").agg({"size": "sum"}).withColumnRenamed("sum(size)", "n").collect()]
    assert len(sizes) == 24 and max(sizes) / min(sizes) < 1.05


def test_a_heavy_group_leaves_the_rest_even(spark):
    heavy = [(i, "x" * 100, "en", "s") for i in range(1000)]
    others = [(1000 + i, f"{i:06d}" * (5 + i % 7), "en", f"s{i % 3}") for i in range(2000)]
    frame = spark.createDataFrame(heavy + others, "doc_id long, text string, lang string, source string")
    found = shard_documents(frame, 8)
    sizes = {r["shard"]: r["n"] for r in found.groupBy("shard").agg({"size": "sum"}).withColumnRenamed("sum(size)", "n").collect()}
    alone = found.where("doc_id = 0").first()["shard"]
    rest = [n for s, n in sizes.items() if s != alone]
    assert len(rest) == 7 and max(rest) / min(rest) < 1.25
