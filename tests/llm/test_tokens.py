import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from backsight.llm import files, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
ENCODER, PLAIN = tokens.Encoder(PATH), Tokenizer.from_file(PATH)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "don't", "Él", "12", "...", "'s", " ", "　", "\x1c", "<|endoftext|>", "x" * 20, "日本", "'"]), max_size=14).map("".join))
def test_encoder_equals_whole_texts(text):
    assert ENCODER.encode([text]) == [np.array(PLAIN.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]


def test_query_equals_library(spark, tmp_path):
    rows = [(7, "a b  c\n d"), (3, None), (None, "no id"), (5, ""), (9, "word " * 30000), (7, "a b"), (-4, "Ünïcode 日本 <|endoftext|> x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    written = tokens.write_ids(docs, PATH)
    found = [tuple(r) for r in tokens.checked(tokens.read_ids(written)).collect()]
    start, expected = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*PLAIN.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(found, key=lambda r: r[1]) == expected
    system, path = files.opened(written.first()["file"])
    with zstandard.ZstdDecompressor().stream_reader(system.open_input_stream(path, compression=None), read_across_frames=True) as plain:
        assert len(plain.read()) % 4 == 0


def test_random_access_and_damage(tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "FRAME", 8)
    address = f"file://{tmp_path}/x.ids.zst"
    out = tokens.FileWriter(address)
    documents = [np.arange(n, dtype="<u4").tobytes() for n in (3, 0, 40, 8, 1)]
    for k, ids in enumerate(documents):
        out.add(k if k else None, ids)
    out.close()
    found = tokens.FileReader(address)
    assert found.keys == [None, 1, 2, 3, 4]
    assert [found.ids(k) for k in (4, 2, 0, 1, 3)] == [documents[k] for k in (4, 2, 0, 1, 3)]
    data = bytearray((tmp_path / "x.ids.zst").read_bytes())
    found.frames = found.frames.copy()
    found.frames[0, 2] ^= 1
    found.kept = (-1, b"")
    with pytest.raises(ValueError, match="damaged"):
        found.ids(0)
    (tmp_path / "y").write_bytes(data[:-1])
    with pytest.raises(ValueError, match="seek table"):
        tokens.FileReader(f"{tmp_path}/y")


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.checked(tokens.read_ids(tokens.write_ids(empty, PATH))).collect() == []


def test_known_words_are_looked_up_once():
    class Counted(dict):
        looked = 0

        def get(self, key, default=None):
            Counted.looked += 1
            return super().get(key, default)

        def __getitem__(self, key):
            Counted.looked += 1
            return super().__getitem__(key)

    coder = tokens.Encoder(PATH)
    known = [f"word{k}" for k in range(500)]
    coder.encode([" ".join(["first", *known])])
    coder.first, coder.rest = Counted(coder.first), Counted(coder.rest)
    text = " ".join(["first", *known, "novel", "another"])
    plain = coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert coder.encode([text, text]) == 2 * [np.array(plain, "<u4").tobytes()]
    assert Counted.looked < 2 * 510  # two new words do not make the others be looked up again
