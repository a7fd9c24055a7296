import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece

from backsight.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


def plain_viterbi(text, table, longest, fallback, octets):
    """Over the whole text, without words: the greatest sum of scores, ties to the longer last piece."""
    if not text:
        return []
    text = "▁" + text.replace(" ", "▁")
    best = [(0.0, 0, [])]
    for stop in range(1, len(text) + 1):
        found = None
        for start in range(max(0, stop - longest), stop):
            part = text[start:stop]
            if part in table:
                i, score = table[part]
                edge = (best[start][0] + score, start, [i])
            elif stop - start == 1:
                edge = (best[start][0] + fallback, start, [octets[b] for b in part.encode()])
            else:
                continue
            if found is None or edge[0] > found[0]:
                found = edge
        best.append(found)
    out, at = [], len(text)
    while at:
        out = best[at][2] + out
        at = best[at][1]
    return out


def texts():
    rng = random.Random(1)
    parts = ["Hello", "world", "  ", "\n", "été", "日本語", "🎉", "a" * 200, "don't", "1234.5", ",", "&&&", "ｆｕｌｌ", "\x00", "▁", "internationalisation", "Straße"]
    return [" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(40)] + [None, "", " ", "   ", "\n", "x" * 3000, "a b" * 50]


@pytest.mark.parametrize("most_words", [1_000_000, 10])
def test_equals_plain_viterbi_and_comes_back(spark, most_words):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, ids string").repartition(3)
    model = pieces.Pieces(PATH)
    table = {p: (i, s) for p, i, s in model.normal}
    decoded = pieces.decode(pieces.encode(docs, PATH, most_words=most_words), PATH)
    found = {r.row.row.doc_id: (list(r.row.ids), r.row.n_tokens, r.row.ids_crc32, r.row.round_trip, r.decoded) for r in decoded.collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert len(found) == len(rows)
    for i, text in rows:
        ids = plain_viterbi(text, table, model.longest, model.fallback, model.bytes)
        expected = (text or "").replace("▁", " ")
        assert found[i] == (ids, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True, expected)
        assert library.decode(ids) == expected


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.decode(pieces.encode(empty, PATH), PATH).collect() == []


def test_long_words(spark):
    rng = random.Random(2)
    rows = ["e" * 100_000, "".join(rng.choice("abest") for _ in range(30_000)), "=" * 8_193, "e" * 8_192, "e" * 64, "e" * 65]
    model = pieces.Pieces(PATH)
    table = {p: (i, s) for p, i, s in model.normal}
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.row.doc_id: (list(r.ids), r.round_trip) for r in pieces.encode(docs, PATH).collect()}
    assert found == {i: (plain_viterbi(t, table, model.longest, model.fallback, model.bytes), True) for i, t in enumerate(rows)}


def test_a_task_sends_a_word_once(spark):
    """Many texts of a task hold the same and other words: each distinct word is a row, counted over all of them."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgh日🎉é") for _ in range(8)) for _ in range(40_000)]
    texts = [" ".join(rng.choices(vocabulary, k=4000)) for _ in range(80)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    sent = pieces.distinct_words(docs, PATH)
    model = pieces.Pieces(PATH)
    expected = {}
    for t in texts:
        codes, starts, ends, _, _ = model.words(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]), 0)
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            word = codes[a:b].tobytes().decode("utf-32-le")
            expected[word] = expected.get(word, 0) + 1
    assert {r.word: r.n for r in sent.collect()} == expected


def test_merging_words_keeps_each_once():
    def made(words, counts):
        codes = np.array([ord(c) for w in words for c in w], np.uint32)
        ends = np.cumsum([len(w) for w in words])
        strings = pieces._strings(codes, np.concatenate(([0], ends[:-1])), ends)
        return np.array([hash(w) for w in words], np.int64), strings, np.array(counts)

    batch = pieces._word_batch(pieces._merged([made(["a", "日本", "🎉é"], [1, 2, 3]), made(["🎉é", "x" * 300], [4, 5])]))
    assert {r["word"]: r["n"] for r in batch.to_pylist()} == {"a": 1, "日本": 2, "🎉é": 7, "x" * 300: 5}


def test_dictionary_is_loaded_in_place(tmp_path):
    """The peak of a load is near the size of what is kept; unsorted or missing words are refused."""
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(-(2**63), 2**63 - 1, 300_000))
    sizes = rng.integers(1, 6, len(keys))
    ids = rng.integers(0, 65_536, sizes.sum())
    at = np.concatenate(([0], np.cumsum(sizes)))
    for k, (a, b) in enumerate([(0, 100_000), (100_000, 100_000), (100_000, 170_000), (170_000, len(keys))]):
        lists = pa.ListArray.from_arrays(pa.array((at[a : b + 1] - at[a]).astype(np.int32)), pa.array(ids[at[a] : at[b]].astype(np.int32)))
        pq.write_table(pa.table({"hash": keys[a:b], "ids": lists}), tmp_path / f"part-{k:05d}.parquet")
    tracemalloc.start()
    known = pieces._Dictionary(str(tmp_path), len(keys), len(ids), np.uint16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.25 * (known.keys.nbytes + known.at.nbytes + known.flat.nbytes)
    chosen = rng.permutation(len(keys))[:1000]
    place = known.find(np.concatenate((keys[chosen], [0])).view(np.uint64))
    assert place.tolist() == [*chosen.tolist(), -1]
    assert (pieces._gathered(known.flat, known.at, place[:-1])[0] == np.concatenate([ids[at[c] : at[c + 1]] for c in chosen])).all()
    with pytest.raises(ValueError):
        pieces._Dictionary(str(tmp_path), len(keys) + 1, len(ids), np.uint16)
    (tmp_path / "part-00000.parquet").rename(tmp_path / "part-00009.parquet")
    with pytest.raises(ValueError):
        pieces._Dictionary(str(tmp_path), len(keys), len(ids), np.uint16)


@pytest.mark.parametrize(("most", "expected"), [(2, [1]), (3, [1, 2, 3]), (4, [1, 2, 3]), (5, [1, 2, 3, 4, 5]), (0, [])])
def test_common_words_are_not_ranked(spark, most, expected):
    words = spark.createDataFrame([(1, 9), (2, 5), (3, 5), (4, 1), (5, 1)], "hash long, n long")
    found = pieces._common(words, most)
    assert sorted(r.hash for r in found.collect()) == expected
    assert "Limit" not in found._jdf.queryExecution().optimizedPlan().toString()
