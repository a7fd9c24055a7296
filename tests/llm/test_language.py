import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from backsight.llm import language
from backsight.llm.buffers import text_bytes


def plain_model(texts):
    """Interpolated Kneser-Ney of order four, from the definition, over strings."""
    grams = Counter()
    for t in texts:
        padded = "   " + " ".join("".join(c.lower() if c.isalpha() else " " for c in t).split()) + " "
        grams.update(padded[i : i + 4] for i in range(len(padded) - 3))
    levels = {4: grams}
    for n in (3, 2, 1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    discount = {n: (lambda a, b: a / (a + 2 * b) if a and b else 0.5)(sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())) for n, c in levels.items()}

    def probability(gram):
        p = 1 / (len(levels[1]) + 1)
        for n in (1, 2, 3, 4):
            part = gram[-n:]
            context = {g: v for g, v in levels[n].items() if g[:-1] == part[:-1]}
            if context:
                total = sum(context.values())
                p = max(context.get(part, 0) - discount[n], 0) / total + discount[n] * len(context) / total * p
        return p

    return probability


def test_probabilities_equal_the_definition(spark):
    texts = ["Das Haus ist da.", "der Hund und das Haus", "Übung macht den Meister"]
    rows = spark.createDataFrame([("de", t) for t in texts], "lang string, text string")
    keys, counts = language.bounded_counts(language.count_grams(rows), 10_000)["de"]
    model, plain = language.KneserNey(keys, counts), plain_model(texts)
    for gram in ("das ", "hau ", "   d", "xyzq", "über", "as z"):
        key = sum(ord(c) << 16 * k for k, c in enumerate(reversed(gram)))
        assert math.isclose(model.probabilities(np.array([key], np.uint64))[0], plain(gram), rel_tol=1e-9)


def test_given_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_no_count_is_left_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 300")
    odd = [(-1, None, "de"), (-2, "12 3!", "en"), (-3, "qzx jkq wvx qqq", "fr"), (-4, "plain words", None), (None, "some text", "en")]
    docs = docs.select("doc_id", "text", "lang").union(spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    whole = {r.doc_id: r for r in language.identify(docs).collect()}
    few = {r.doc_id: r for r in language.identify(docs, most_grams=40).collect()}
    assert set(whole) == set(few) and len(whole) > 200
    for k, r in whole.items():
        assert (few[k].lang_pred, few[k].held_out, few[k].accepted) == (r.lang_pred, r.held_out, r.accepted)
        assert math.isclose(few[k].score, r.score, rel_tol=1e-9)


def test_odd_rows(spark):
    rows = [(i, f"le chat {i} est la" if i % 2 else f"the cat {i} is here", "fr" if i % 2 else "en", "clash") for i in range(60)]
    rows += [(70, None, "fr", ""), (71, "123 !", "en", ""), (72, "the cat", None, ""), (None, "le chat est", "fr", ""), (73, "𝒳𝒴", "en", ""), (0, rows[0][1], "en", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    found = language.identify(docs).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    assert by[70].lang_pred == by[71].lang_pred == "und" and by[70].score == 0 and by[72].lang_pred == "en" and by[None].lang_pred == "fr"
    untaught = language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in untaught} == {("und", 0.0)}
    assert language.identify(docs.limit(0)).collect() == []


def test_bytes_of_sliced_columns():
    column = pa.array(["skip", "é", None, "b"]).slice(1)
    data, offsets = text_bytes(column)
    assert data.tobytes() == "éb".encode() and offsets.tolist() == [0, 2, 2, 3]
