"""Language identification: interpolated Kneser-Ney character models, one per language, in sorted key arrays.

Texts become letters in lower case with single spaces for all else. An n-gram of four characters is a 64-bit key of four
16-bit characters, so a suffix is a mask and a context a shift. Tasks count 4-grams per language; all lower orders follow
from the distinct 4-grams (continuation counts), as Kneser-Ney smoothing wants it. Each order has one discount per
language from its counts of counts. A text's score in a language is the cross-entropy per character; the least wins.

Calibration: documents kept out of the counts give, over bins of the margin between the two best languages, how often
the best one is right; a logistic curve through these bins turns a margin into ``score``. A prediction is ``accepted``
if its score reaches the least bin score at which at least ``precision`` of the calibration documents were right.

No count is left out. Up to ``most_grams`` 4-grams in all languages together, the model is broadcast. Beyond, the counts
stay in tables: the distinct n-grams of the texts are joined to them, order by order, and give one row of bits per 4-gram;
the most frequent of these rows are broadcast, and a text's other 4-grams, counted per text, are joined to theirs.

Cases: a null text, or one without letters, is ``und`` with score 0; rows with a null language or a null id teach
nothing; with no language learned every text is ``und``; with one, every text with letters is that one, score 1. Ties go
to the first language in order. A character beyond 16 bits counts as one unknown letter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

from backsight.llm.buffers import chunks, text_bytes
from backsight.llm.components import write

ORDER, BINS = 4, 200
_SPACE, _OTHER = 0x20, 0xFFFF
_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For every code point its lower-case letter in 16 bits, or a space. Built once per worker from str's own rules."""
    if not _TABLE:
        table = np.full(0x110000, _SPACE, np.uint16)
        for point in range(0x110000):
            c = chr(point)
            if c.isalpha():
                low = c.lower()
                table[point] = ord(low) if len(low) == 1 and ord(low) < _OTHER else _OTHER if point >= _OTHER else point
        _TABLE.append(table)
    return _TABLE[0]


def grams_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(4-gram keys, text of each, texts with a letter). Texts are padded by three spaces before and one after."""
    texts = data.tobytes()
    codes = [np.frombuffer(texts[a:b].decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    pad, end = np.full(ORDER - 1, _SPACE, np.uint16), np.full(1, _SPACE, np.uint16)
    table, rows, parts, lettered = _letters(), [], [], np.zeros(len(codes), bool)
    for k, code in enumerate(codes):
        plain = table[code]
        dark = plain != _SPACE
        lettered[k] = dark.any()
        if lettered[k]:
            after = np.concatenate(([False], dark[:-1]))
            plain = np.concatenate((pad, plain[dark | after], end[: int(dark[-1])])).astype(np.uint64)
            keys = plain[ORDER - 1 :].copy()
            for step in range(1, ORDER):
                keys |= plain[ORDER - 1 - step : len(plain) - step] << np.uint64(16 * step)
            parts.append(keys)
            rows.append(np.full(len(keys), k))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), lettered
    return np.concatenate(parts), np.concatenate(rows), lettered


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of ``docs`` (lang, text); tasks hold distinct n-grams only."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, pd.Series] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in sorted(set(langs)):
                data, offsets = text_bytes(batch.column(1).filter(pa.array(langs == lang)))
                for a, b in chunks(offsets):
                    keys, _, _ = grams_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    codes, distinct = pd.factorize(keys.view(np.int64))
                    made = pd.Series(np.bincount(codes, minlength=len(distinct)), index=distinct)
                    counts[lang] = counts[lang].add(made, fill_value=0) if lang in counts else made
        for lang, found in counts.items():
            columns = [pa.array([lang] * len(found)), pa.array(found.index.to_numpy(np.int64)), pa.array(found.to_numpy().astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    counted = docs.mapInArrow(work, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def bounded_counts(counts: DataFrame, most_grams: int) -> dict[str, tuple[np.ndarray, np.ndarray]] | None:
    """Sorted keys and counts per language, or None if there are more than ``most_grams`` of them in all."""
    if counts.count() > most_grams:
        return None
    found = counts.select("lang", "gram", "n").toArrow()
    langs = np.array(found.column("lang").to_pylist(), object)
    grams, n = found.column("gram").to_numpy().view(np.uint64), found.column("n").to_numpy().astype(np.float64)
    model = {}
    for lang in sorted(set(langs)):
        own = np.flatnonzero(langs == lang)
        order = own[np.argsort(grams[own])]
        model[lang] = (grams[order], n[order])
    return model


class KneserNey:
    """One language: for each order sorted keys of contexts and n-grams with what the interpolation needs of them."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.levels = []
        for order in range(ORDER, 0, -1):
            ones, twos = (counts == 1).sum(), (counts == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            contexts, at = np.unique(keys >> np.uint64(16), return_inverse=True)
            total, kinds = np.bincount(at, counts), np.bincount(at)
            self.levels.append((keys, np.maximum(counts - discount, 0), contexts, total, discount * kinds / np.maximum(total, 1e-300)))
            if order > 1:
                keys, at = np.unique(keys & np.uint64((1 << 16 * (order - 1)) - 1), return_inverse=True)
                counts = np.bincount(at).astype(np.float64)
        self.unseen = 1.0 / (len(self.levels[-1][0]) + 1)

    def probabilities(self, grams: np.ndarray) -> np.ndarray:
        """P(last character | the three before) of each 4-gram key."""
        found = np.full(len(grams), self.unseen)
        for order in range(1, ORDER + 1):
            keys, weight, contexts, total, backoff = self.levels[ORDER - order]
            part = grams & np.uint64((1 << 16 * order) - 1) if order < ORDER else grams
            context = part >> np.uint64(16)
            c = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            known = contexts[c] == context
            g = np.minimum(np.searchsorted(keys, part), len(keys) - 1)
            own = np.where(keys[g] == part, weight[g], 0.0)
            found = np.where(known, own / total[c] + backoff[c] * found, found)
        return found


class Model:
    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        counts = {lang: c for lang, c in counts.items() if len(c[0])}
        self.langs = sorted(counts)
        self.models = [KneserNey(*counts[lang]) for lang in self.langs]

    def entropies(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Cross-entropy per character of each text in each language; NaN for texts without letters."""
        out = np.full((len(offsets) - 1, len(self.langs)), np.nan)
        for a, b in chunks(offsets):
            keys, rows, lettered = grams_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            if not len(keys):
                continue
            codes, distinct = pd.factorize(keys.view(np.int64))
            size = np.bincount(rows, minlength=b - a)
            for k, model in enumerate(self.models):
                bits = -np.log2(model.probabilities(distinct.view(np.uint64)))
                out[a:b, k] = np.where(lettered, np.bincount(rows, bits[codes], minlength=b - a) / np.maximum(size, 1), np.nan)
        return out

    def scored(self, rows: DataFrame) -> DataFrame:
        """(row, entropies) of ``rows`` (row, text)."""
        shared = SparkContext._active_spark_context.broadcast(self)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                entropies = shared.value.entropies(*text_bytes(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists(entropies)], ["row", "entropies"])

        return rows.mapInArrow(work, rows.select("row").schema.add("entropies", ArrayType(DoubleType())))


def _lists(table: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(table) + 1, dtype=np.int32) * table.shape[1], pa.int32()), pa.array(table.ravel()))


def _ragged(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(values.astype(np.int64)))


def _chance(discounts: Column):
    """The interpolation in language k of one order, with ``own``, ``known`` and the shorter n-gram's probability."""

    def one(less: Column, k: Column) -> Column:
        at, own, d = F.try_element_at("known", k), F.coalesce(F.try_element_at("own", k), F.lit(0)), F.get(discounts, k)
        return F.when(at.isNull(), less).otherwise(F.greatest(own - d, F.lit(0.0)) / at["total"] + d * at["kinds"] / at["total"] * less)

    return one


class TableModel:
    """The same model with its counts in tables: nothing but discounts, a few numbers per language, reaches the driver."""

    def __init__(self, counts: DataFrame, most_grams: int):
        self.most_grams, self.levels = most_grams, []
        self.langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
        names = F.create_map(*[x for k, lang in enumerate(self.langs) for x in (F.lit(lang), F.lit(k))])
        level = counts.select(names[F.col("lang")].alias("k"), "gram", "n")
        for order in range(ORDER, 0, -1):
            level, _ = write(level, f"level-{order}")
            kinds = {r["k"]: r for r in level.groupBy("k").agg(F.count("*").alias("all"), F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect()}
            kinds = [kinds[k] for k in range(len(self.langs))]
            discounts = [r["ones"] / (r["ones"] + 2 * r["twos"]) if r["ones"] and r["twos"] else 0.5 for r in kinds]
            by_gram = level.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("own"))
            contexts = level.groupBy("k", F.shiftrightunsigned("gram", 16).alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
            contexts = contexts.groupBy("context").agg(F.map_from_entries(F.collect_list(F.struct("k", F.struct("total", "kinds")))).alias("known"))
            self.levels.append((by_gram, contexts, discounts))
            if order > 1:
                level = level.groupBy("k", F.col("gram").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1)).alias("gram")).agg(F.count("*").alias("n"))
        self.unseen = [1.0 / (r["all"] + 1) for r in kinds]

    def bits(self, asked: DataFrame) -> DataFrame:
        """(gram, f, bits) of the 4-grams ``asked`` (gram, f): minus the logarithm of each probability, per language."""
        lower = None
        for order in range(1, ORDER + 1):
            by_gram, contexts, discounts = self.levels[ORDER - order]
            mask = F.lit((1 << 16 * order) - 1) if order < ORDER else F.lit(-1)
            parts = asked if order == ORDER else asked.select(F.col("gram").bitwiseAND(mask).alias("gram")).distinct()
            parts = parts.withColumn("context", F.shiftrightunsigned("gram", 16)).join(by_gram, "gram", "left").join(contexts, "context", "left")
            if lower is None:
                parts = parts.withColumn("less", F.array(*map(F.lit, self.unseen)))
            else:
                parts = parts.withColumn("shorter", F.col("gram").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1))).join(lower, "shorter")
            parts = parts.withColumn("p", F.transform("less", _chance(F.array(*map(F.lit, discounts)))))
            if order < ORDER:
                lower, _ = write(parts.select(F.col("gram").alias("shorter"), F.col("p").alias("less")), f"chances-{order}")
        found, _ = write(parts.select("gram", "f", F.transform("p", lambda p: -F.log2(p)).alias("bits")), "gram-bits")
        return found

    def scored(self, rows: DataFrame) -> DataFrame:
        """(row, entropies) of ``rows`` (row, text)."""
        asked, _ = write(count_grams(rows.where("text is not null").select(F.lit("").alias("lang"), "text")).select("gram", F.col("n").alias("f")), "asked-grams")
        found, width = self.bits(asked), len(self.langs)
        head = found.orderBy(F.desc("f"), "gram").limit(max(1, self.most_grams // width))
        head = head.select("gram", *[F.get("bits", F.lit(k)).alias(f"b{k}") for k in range(width)]).toArrow()
        keys = head.column("gram").to_numpy()
        order = np.argsort(keys)
        shared = SparkContext._active_spark_context.broadcast((keys[order], [head.column(f"b{k}").to_numpy()[order] for k in range(width)]))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, bits = shared.value
            for batch in batches:
                data, offsets = text_bytes(batch.column(1))
                for a, b in chunks(offsets):
                    grams, texts, _ = grams_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    grams, sums = grams.view(np.int64), np.zeros((b - a, width))
                    at = np.searchsorted(keys, grams)
                    here = at < len(keys)
                    here[here] = keys[at[here]] == grams[here]
                    for k in range(width):
                        sums[:, k] = np.bincount(texts[here], bits[k][at[here]], minlength=b - a)
                    rest = pd.DataFrame({"text": texts[~here], "gram": grams[~here]}).groupby(["text", "gram"]).size()
                    sizes = np.bincount(rest.index.get_level_values(0).to_numpy(np.int64), minlength=b - a)
                    columns = [batch.column(0).slice(a, b - a), pa.array(np.bincount(texts, minlength=b - a)), _lists(sums)]
                    columns += [_ragged(rest.index.get_level_values(1).to_numpy(np.int64), sizes), _ragged(rest.to_numpy(), sizes)]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "size", "sums", "grams", "times"])

        schema = rows.select("row").schema.add("size", "long").add("sums", ArrayType(DoubleType())).add("grams", ArrayType(LongType())).add("times", ArrayType(LongType()))
        parts, _ = write(rows.mapInArrow(work, schema).withColumn("number", F.monotonically_increasing_id()), "gram-parts")
        rest = parts.select("number", F.explode(F.arrays_zip("grams", "times")).alias("g")).select("number", F.col("g.grams").alias("gram"), F.col("g.times").alias("times"))
        rest = rest.join(found.select("gram", "bits"), "gram").groupBy("number")
        rest = rest.agg(F.array(*[F.sum(F.get("bits", F.lit(k)) * F.col("times")) for k in range(width)]).alias("rest"))
        whole = F.transform("sums", lambda x, k: F.when(F.col("size") > 0, (x + F.coalesce(F.get("rest", k), F.lit(0.0))) / F.col("size")).otherwise(F.lit(float("nan"))))
        return parts.join(rest, "number", "left").select("row", whole.alias("entropies"))


def _margins(entropies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the best language or -1, how much better than the second it is per character)."""
    if not entropies.shape[1]:
        return np.full(len(entropies), -1), np.zeros(len(entropies))
    none = np.isnan(entropies[:, 0])
    best = np.where(none, -1, np.argmin(np.where(np.isnan(entropies), np.inf, entropies), axis=1))
    if entropies.shape[1] == 1:
        return best, np.where(none, 0.0, np.inf)
    two = np.sort(np.where(none[:, None], 0.0, entropies), axis=1)
    return best, two[:, 1] - two[:, 0]


def _bins(margins: np.ndarray) -> np.ndarray:
    return np.minimum((np.minimum(margins, 1e6) * 100).astype(np.int64), BINS - 1)


class Calibration:
    """P(right) = 1 / (1 + exp(-(a + b * margin))), fitted to the bins by Newton steps with a little shrinkage."""

    def __init__(self, right: np.ndarray, total: np.ndarray, precision: float):
        x = (np.arange(BINS) + 0.5) / 100
        self.a, self.b = 0.0, 10.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(self.a + self.b * x, -30, 30)))
            g = np.array([(right - total * p).sum(), ((right - total * p) * x).sum() - 1e-3 * (self.b - 10)])
            w = total * p * (1 - p)
            h = np.array([[w.sum() + 1e-3, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1e-3]])
            step = np.linalg.solve(h, g)
            self.a, self.b = self.a + float(np.clip(step[0], -2, 2)), self.b + float(np.clip(step[1], -20, 20))
        self.b = max(self.b, 0.0)
        above_right, above = np.cumsum(right[::-1])[::-1], np.cumsum(total[::-1])[::-1]
        good = np.flatnonzero((above > 0) & (above_right >= precision * above))
        self.least = float(self.score((good[0] if len(good) else BINS) / 100)) if above[0] else 0.0

    def score(self, margins):
        return 1 / (1 + np.exp(-np.clip(self.a + self.b * np.minimum(margins, 1e6), -30, 30)))


def _table(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def train(docs: DataFrame, most_grams: int = 2_000_000, precision: float = 0.99) -> tuple[Model | TableModel, Calibration]:
    """``docs``: (lang, text, calibrate). Rows with ``calibrate`` are scored, the others counted; none is left out."""
    known = docs.where("lang is not null and text is not null")
    counts, _ = write(count_grams(known.where("not calibrate").select("lang", "text")), "gram-counts")
    small = bounded_counts(counts, most_grams)
    model = TableModel(counts, most_grams) if small is None else Model(small)
    langs = model.langs

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, total = np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
        for batch in batches:
            best, margins = _margins(_table(batch.column(1), len(langs)))
            names = np.array([*langs, None], object)[best]
            judged = best >= 0
            total += np.bincount(_bins(margins[judged]), minlength=BINS)
            right += np.bincount(_bins(margins[judged & (names == np.array(batch.column(0).to_pylist(), object))]), minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), pa.array(right), pa.array(total)], ["bin", "right", "total"])

    scored = model.scored(known.where("calibrate").select(F.struct("lang").alias("row"), "text"))
    bins = scored.select("row.lang", "entropies").mapInArrow(work, "bin long, right long, total long")
    right, total = np.zeros(BINS), np.zeros(BINS)
    for r in bins.groupBy("bin").agg(F.sum("right"), F.sum("total")).collect():
        right[r[0]], total[r[0]] = r[1], r[2]
    return model, Calibration(right, total, precision)


def predict(docs: DataFrame, model: Model | TableModel, calibration: Calibration, text: str = "text") -> DataFrame:
    """The rows of ``docs`` as ``row``, with lang_pred, score, accepted and the cross-entropy per character in bits."""
    scored, langs = model.scored(docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))), model.langs

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entropies = _table(batch.column(1), len(langs))
            best, margins = _margins(entropies)
            names = np.array([*langs, "und"], object)[best]
            score = np.where(best >= 0, np.where(np.isinf(margins), 1.0, calibration.score(margins)), 0.0)
            least = entropies[np.arange(len(best)), best] if len(langs) else np.full(len(best), np.nan)
            columns = [batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array((best >= 0) & (score >= calibration.least)), pa.array(least, mask=np.isnan(least))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "lang_pred", "score", "accepted", "entropy"])

    schema = scored.select("row").schema.add("lang_pred", "string").add("score", "double").add("accepted", "boolean").add("entropy", "double")
    return scored.mapInArrow(work, schema)


def identify(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5, most_grams: int = 2_000_000) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted): fold 0 of the ids' checksums is held out, the last one calibrates."""
    fold = F.crc32(F.col(doc).cast("string").cast("binary")) % folds
    taught = docs.where(fold != 0).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"), (fold == folds - 1).alias("calibrate"))
    model, calibration = train(taught, most_grams=most_grams)
    known = docs.select(F.col(doc).alias("doc_id"), F.coalesce(fold == 0, F.lit(False)).alias("held_out"), F.col(text).cast("string").alias("text"))
    found = predict(known, model, calibration)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score", "accepted")
