"""The registered queries without SQL against brute force, on the smallest given tables, and the pipeline's stages."""

import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from test_decontaminate import plain as plain_decontaminate
from test_pieces import plain_viterbi
from test_simhash import plain_components, plain_fingerprint
from test_substrings import plain as plain_substrings
from tokenizers import Tokenizer

import corpus_pipeline
from backsight.llm import pieces, queries
from backsight.storage import settle

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def expected_ids(rows):
    model = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    table = {p: (i, s) for p, i, s in model.normal}
    known = {}

    def ids(text):
        # Words between spaces are segmented alone; no piece goes on after a space.
        out = []
        for word in (text or "").replace("▁", " ").split(" ") if text else []:
            if word not in known:
                known[word] = plain_viterbi(word, table, model.longest, model.fallback, model.bytes) if word else None
            out += known[word] or []
        return out

    return {k: ids(t) for k, t in rows.items()}


def test_op2(spark, texts):
    rows = {k: t for k, t in texts.items() if t and "  " not in t and not t.startswith(" ") and not t.endswith(" ")}
    found = {r.doc_id: (r.n_tokens, r.ids_crc32, r.round_trip) for r in queries.QUERIES["op2_pieces"](spark, SF).collect()}
    assert set(found) == set(texts) and len(rows) > 100
    for k, ids in expected_ids(rows).items():
        assert found[k] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True)


def test_op5(spark, texts):
    tokenizer, start, expected = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, {}
    for k in sorted(texts):
        ids = [*tokenizer.encode(texts[k] or "", add_special_tokens=False).ids, 2]
        expected[k] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op5_token_files"](spark, SF).collect()} == expected


def test_op9(spark, texts):
    prints = {k: plain_fingerprint(t) for k, t in texts.items()}
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op9_simhash"](spark, SF).collect()}
    components = plain_components(prints)
    assert found == {k: (f"{p:016x}", components[k]) for k, p in prints.items()}


def test_op6_and_op8(spark, texts):
    judged = queries.QUERIES["op6_quality"](spark, SF).collect()
    assert {r.doc_id for r in judged} == set(texts) and all(0 <= r.p_toxic <= 1 and 0 <= r.p_low_quality <= 1 for r in judged)
    named = queries.QUERIES["op8_language"](spark, SF).collect()
    assert {r.doc_id for r in named} == set(texts)


def test_pipeline_stages(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(settle(stage(spark, tables[-1], SF), name.replace(" ", "-")))
        if len(tables) <= len(corpus_pipeline.STAGES):
            assert tables[-1].schema.simpleString() == docs.schema.simpleString()
    good, single, cut, clean, encoded = ({r.doc_id: r for r in t.collect()} for t in tables[1:])
    assert set(good) <= set(texts) and {k: r.text for k, r in good.items()} == {k: texts[k] for k in good}
    components = plain_components({k: plain_fingerprint(r.text) for k, r in good.items()})
    assert set(single) == {k for k in good if components[k] == k}
    for key, _, removed, _ in plain_substrings([(k, r.text) for k, r in sorted(single.items())], 50):
        assert (cut[key].text != single[key].text) == (removed > 0) and cut[key].n_chars == len(cut[key].text)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    some = sorted(cut)[::8]
    assert [k in clean for k in some] == [not plain_decontaminate(cut[k].text, bench, 13)[4] for k in some]
    assert set(encoded) == set(clean) and all(r.round_trip and r.n_tokens == len(r.ids) for r in encoded.values())
