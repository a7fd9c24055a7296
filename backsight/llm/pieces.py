"""SentencePiece encoding and decoding: a relational lattice over the distinct words, folded by Viterbi.

Texts get a leading word mark and marks for spaces. Between two characters that stand together in no piece no edge can
pass, so texts are cut there; the parts are the words of the lattice, and each distinct word is encoded once. Substrings
of at most the longest piece's length are exploded and equi-joined to the piece table; a character that no piece spells
falls back to its bytes. The edges of a word are grouped and folded in order of their ends with a higher-order aggregate
that keeps the best score and last edge of every position; a second fold walks back. Distinct words are shuffled once by
their hash; explode, join and grouping keep that partitioning.

The best path has the greatest sum of piece scores, ties go to the longer last piece. For a model of kind BPE, whose
scores are the negated ranks of its merges, this is the best segmentation by rank sum, not the order of merges.

The dictionary of encoded words lies in the shared folder; its ``most_words`` most frequent words are written in order of
their hashes, and tasks load them as arrays. Rarer words, and those as frequent as the first of these, are joined to the
texts that hold them. The hash is redrawn if two words share one.

Cases: null and empty texts have no ids; the word mark itself in a text decodes to a space, as in the model's own
library; repeated rows are encoded alone; other columns, whatever their names, are kept in ``row``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from backsight.llm import files
from backsight.llm.buffers import chunks, give_back, mixed, run_hashes, text_bytes
from backsight.llm.components import write
from backsight.storage import drop_path

MARK = "▁"
#: Characters that a long word is cut into, first and then, and edges that are folded at once.
PART = 8192
BLOCK = 64
SLICE = 256
#: Distinct words that a task holds before it sends them.
MOST_HELD = 100_000
#: Bytes of text that a worker takes at once.
AT_ONCE = 1 << 19


class Pieces:
    """The piece table of a model: normal pieces with scores, byte pieces, and which characters stand together."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        if size > 1_000_000:
            raise ValueError("the piece table is broadcast; a million pieces is the bound")
        names = [model.id_to_piece(i) for i in range(size)]
        byte = {int(names[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.bytes = [byte.get(b, model.unk_id()) for b in range(256)]
        self.normal = [(names[i], i, model.get_score(i)) for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.longest = max((len(p) for p, _, _ in self.normal), default=1)
        self.fallback = min((s for _, _, s in self.normal), default=0.0) - 10
        letters = sorted({c for p, _, _ in self.normal for c in p})
        self.number = np.zeros(0x110000, np.uint16)
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.together = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for p, _, _ in self.normal:
            at = self.number[[ord(c) for c in p]]
            self.together[at[:-1], at[1:]] = True
        normal = {i: p.encode() for p, i, _ in self.normal}
        back = {i: bytes([b]) for b, i in byte.items()}
        spelled = [normal.get(i, back.get(i, b"")) for i in range(size)]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_at = np.concatenate(([0], np.cumsum([len(s) for s in spelled])))

    def words(self, data: np.ndarray, offsets: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(code points with marks, word starts, word ends, word hashes, first word of each text and the total)."""
        codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
        codes = np.where(codes == 0x20, np.uint32(ord(MARK)), codes)
        some = np.diff(chars) > 0
        codes = np.insert(codes, chars[:-1][some], ord(MARK))
        begin = chars + np.concatenate(([0], np.cumsum(some)))
        number = self.number[codes]
        first = np.ones(len(codes), bool)
        first[1:] = ~self.together[number[:-1], number[1:]]
        first[begin[:-1][some]] = True
        starts = np.flatnonzero(first)
        ends = np.concatenate((starts[1:], [len(codes)])) if len(starts) else starts
        hashes = run_hashes(mixed(codes.astype(np.uint64) + np.uint64(1 + (salt << 32))), starts, ends)
        return codes, starts, ends, hashes, np.searchsorted(starts, begin)

    def decode(self, ids: np.ndarray) -> bytes:
        joined = _gathered(self.spelled, self.spelled_at, ids)[0].tobytes().replace(MARK.encode(), b" ")
        return joined[1:] if joined[:1] == b" " else joined


_LOADED: dict = {}


def _pieces(path: str) -> Pieces:
    if _LOADED.get("path") != path:
        _LOADED.update(path=path, pieces=Pieces(path))
    return _LOADED["pieces"]


def _gathered(flat: np.ndarray, at: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows ``chosen`` of a ragged array, end to end, and their lengths."""
    size = at[chosen + 1] - at[chosen]
    ends = np.cumsum(size)
    where = np.repeat(at[chosen] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    return flat[where], size


def distinct_words(docs: DataFrame, model: str, text: str = "text", salt: int = 0) -> DataFrame:
    """(hash, word, n): every word of every text with its number of occurrences; tasks send each word a few times only."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, held, room = _pieces(model), [], 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for a, b in chunks(offsets, AT_ONCE):
                codes, starts, ends, hashes, _ = pieces.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], salt)
                if not len(starts):
                    continue
                distinct, first, count = np.unique(hashes.view(np.int64), return_index=True, return_counts=True)
                held.append((distinct, _strings(codes, starts[first], ends[first]), count))
                room += len(distinct)
                if room > 2 * MOST_HELD:
                    held = [_merged(held)]
                    room = len(held[0][0])
                    if room > MOST_HELD:
                        yield _word_batch(held[0])
                        held, room = [], 0
        if held:
            yield _word_batch(_merged(held))

    # A word has some dozens of edges, so the words are dealt to more partitions than their own size asks for.
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(size >> 20, 20_000))
    counted = docs.select(F.col(text).cast("string")).mapInArrow(work, "hash long, word string, n long").repartition(parts, "hash")
    return counted.groupBy("hash", "word").agg(F.sum("n").alias("n"))


def _strings(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The runs of code points as strings, without a Python object for each."""
    sizes = ends - starts
    stops = np.cumsum(sizes)
    chosen = codes[np.repeat(starts - (stops - sizes), sizes) + np.arange(stops[-1])]
    data = chosen.tobytes().decode("utf-32-le").encode()
    width = 1 + (chosen > 0x7F) + (chosen > 0x7FF) + (chosen > 0xFFFF)
    at = np.concatenate(([0], np.cumsum(width)))[np.concatenate(([0], stops))]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))


def _merged(held: list[tuple]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(hashes, words, numbers) of several such, each word once; a hash stands for one word, as it does for a text."""
    if len(held) == 1:
        return held[0]
    hashes, first, place = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
    counts = np.zeros(len(hashes), np.int64)
    np.add.at(counts, place, np.concatenate([h[2] for h in held]))
    return hashes, pa.concat_arrays([h[1] for h in held]).take(pa.array(first)), counts


def _word_batch(words: tuple[np.ndarray, pa.Array, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(words[0]), words[1].cast(pa.string()), pa.array(words[2].astype(np.int64))], ["hash", "word", "n"])


def lattice(words: DataFrame, pieces: Pieces) -> DataFrame:
    """(hash, second, n, edges): the edges (stop, start, score, ids) of each word, in order of their ends.

    Rows are keyed by the word's hash and a second hash of it; no row carries the word itself beyond its first cuts.
    """
    table = words.sparkSession.createDataFrame([(p, i, float(s)) for p, i, s in pieces.normal], "piece string, id int, score double")
    span = pieces.longest
    key = [F.col("hash"), F.col("second"), F.col("n")]
    # Long words are cut twice with an overlap, so that the work is in proportion to their length and no substring is cut
    # from a long string.
    numbers = lambda of, size: F.explode(F.sequence(F.lit(0), F.floor((of - 1) / size).cast("int")))
    parts = words.select("hash", F.xxhash64("word").alias("second"), "n", "word", F.length("word").alias("long")).select("*", numbers(F.col("long"), PART).alias("number"))
    parts = parts.select(*key, (F.col("number") * PART).alias("from"), F.least(F.lit(PART), F.col("long") - F.col("number") * PART).alias("own"), F.substring("word", F.col("number") * PART + 1, F.lit(PART + span - 1)).alias("word"))
    blocks = parts.select(*key, "from", "own", "word", numbers(F.col("own"), BLOCK).alias("block"))
    blocks = blocks.select(*key, (F.col("from") + F.col("block") * BLOCK).alias("from"), F.least(F.lit(BLOCK), F.col("own") - F.col("block") * BLOCK).alias("own"), F.substring("word", F.col("block") * BLOCK + 1, F.lit(BLOCK + span - 1)).alias("part"))
    starts = blocks.select(*key, "from", "part", F.explode(F.sequence(F.lit(0), F.col("own") - 1)).alias("at"))
    sizes = F.explode(F.sequence(F.lit(1), F.least(F.lit(span), F.length("part") - F.col("at"))))
    cuts = starts.select(*key, "part", "at", (F.col("from") + F.col("at")).alias("start"), sizes.alias("size"))
    cuts = cuts.select(*key, "start", "size", F.substring("part", F.col("at") + 1, F.col("size")).alias("piece"))
    found = cuts.join(F.broadcast(table), "piece", "left").where("id is not null or size = 1")
    edge = F.struct(
        (F.col("start") + F.col("size")).alias("stop"),
        "start",
        F.coalesce("score", F.lit(pieces.fallback)).alias("score"),
        # A character that no piece spells: its code point, as a negative number.
        F.coalesce("id", -1 - F.ascii("piece")).alias("id"),
    )
    return found.groupBy(*key).agg(F.sort_array(F.collect_list(edge)).alias("edges"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def viterbi(edges: Column, span: int) -> Column:
    """The ids on the best path, as a fold over edges in order of their ends and a fold back.

    Every position has an edge of one character, so ends are consecutive, and an edge starts at most ``span`` positions
    before its end: the state holds the scores of the last ``span`` settled positions, and the start and id of the best
    last edge of each position. Edges are folded in slices, whose positions are joined slice by slice, so that the state
    that is copied at each position stays small and the work is in proportion to the length.
    """
    best = lambda score, start, id: F.struct(score.alias("score"), start.alias("start"), id.alias("id"))  # noqa: E731, A002
    state = lambda scores, backs, stop, now: F.struct(scores.alias("scores"), backs.alias("backs"), stop.alias("stop"), now.alias("now"))
    none, no_backs = F.array().cast("array<double>"), F.array().cast("array<struct<start:int,id:int>>")

    def step(acc: Column, e: Column) -> Column:
        now = acc["now"]
        reached = lambda scores: F.element_at(scores, e["start"] - e["stop"]) + e["score"]
        last = lambda scores: best(reached(scores), e["start"], e["id"])
        # The first edge that ends at a position is its best so far; most of the others leave the state as it is.
        recent = F.when(F.size(acc["scores"]) < span, acc["scores"]).otherwise(F.slice(acc["scores"], 2, span - 1))
        back = F.struct(now["start"].alias("start"), now["id"].alias("id"))
        opened = _let(F.concat(recent, F.array(now["score"])), lambda scores: state(scores, F.concat(acc["backs"], F.array(back)), e["stop"], last(scores)))
        better = state(acc["scores"], acc["backs"], acc["stop"], last(acc["scores"]))
        return F.when(e["stop"] > acc["stop"], opened).when(reached(acc["scores"]) > now["score"], better).otherwise(acc)

    def part(acc: Column, first: Column) -> Column:
        begin = state(acc["scores"], no_backs, acc["stop"], best(acc["now"]["score"], acc["now"]["start"], acc["now"]["id"]))
        done = F.aggregate(F.slice(edges, first, SLICE), begin, step)
        return _let(done, lambda s: state(s["scores"], F.concat(acc["backs"], F.array(s["backs"])), s["stop"], best(s["now"]["score"], s["now"]["start"], s["now"]["id"])))

    start = state(none, F.array().cast("array<array<struct<start:int,id:int>>>"), F.lit(0), best(F.lit(0.0), F.lit(-1), F.lit(-1)))
    last = lambda acc: F.concat(acc["backs"], F.array(F.array(F.struct(acc["now"]["start"].alias("start"), acc["now"]["id"].alias("id")))))
    firsts = F.sequence(F.lit(1), F.size(edges), F.lit(SLICE))

    def walk(slices: Column) -> Column:
        path = lambda want, at, ids: F.struct(want.alias("want"), at.alias("at"), ids.alias("ids"))
        no_ids = F.array().cast("array<int>")
        back = lambda acc, b: F.when(
            (acc["at"] > 0) & (acc["want"] == acc["at"]), path(b["start"], acc["at"] - 1, F.concat(acc["ids"], F.array(b["id"])))
        ).otherwise(path(acc["want"], acc["at"] - 1, acc["ids"]))

        def through(acc: Column, backs: Column) -> Column:
            done = F.aggregate(F.reverse(backs), path(acc["want"], acc["at"], no_ids), back)
            return _let(done, lambda s: path(s["want"], s["at"], F.concat(acc["ids"], F.array(s["ids"]))))

        # The first entry stands for position 0, before all edges.
        size = F.aggregate(slices, F.lit(-1), lambda n, x: n + F.size(x))
        begin = path(size, size, F.array().cast("array<array<int>>"))
        return F.aggregate(F.reverse(slices), begin, through, lambda acc: F.reverse(F.flatten(acc["ids"])))

    return _let(F.aggregate(firsts, start, part, last), walk)


def with_bytes(ids: Column, pieces: Pieces) -> Column:
    """Negative ids, which stand for characters, as the pieces of their bytes."""
    octet = lambda x: F.element_at(F.array(*map(F.lit, pieces.bytes)), x.cast("int") + 1)

    def spelled(point: Column) -> Column:
        tail = lambda shift: F.lit(0x80) + F.shiftright(point, shift) % 64
        return (
            F.when(point < 0x80, F.array(point))
            .when(point < 0x800, F.array(0xC0 + F.shiftright(point, 6), tail(0)))
            .when(point < 0x10000, F.array(0xE0 + F.shiftright(point, 12), tail(6), tail(0)))
            .otherwise(F.array(0xF0 + F.shiftright(point, 18), tail(12), tail(6), tail(0)))
        )

    whole = lambda found: F.flatten(F.transform(found, lambda i: F.when(i >= 0, F.array(i)).otherwise(F.transform(spelled(-1 - i), octet))))
    return _let(ids, lambda found: F.when(F.exists(found, lambda i: i < 0), whole(found)).otherwise(found))


#: Groups that a task may hold before it sorts instead; a group is a word with some dozens of edges.
_GROUPS = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"


def dictionary(docs: DataFrame, model: str, text: str = "text", groups: int = 50_000) -> tuple[DataFrame, str, int]:
    """(hash, n, ids) of every distinct word, where it is written, and the salt of its hashes."""
    spark, pieces = docs.sparkSession, _pieces(model)
    before = spark.conf.get(_GROUPS)
    spark.conf.set(_GROUPS, str(groups))
    try:
        for salt in range(100):
            words = lattice(distinct_words(docs, model, text, salt), pieces)
            made, path = write(words.select("hash", "n", with_bytes(viterbi(F.col("edges"), pieces.longest), pieces).alias("ids")), "encoded-words")
            if made.groupBy("hash").count().where("count > 1").isEmpty():
                return made, path, salt
    finally:
        spark.conf.set(_GROUPS, before)
    raise ValueError("no hash keeps the words apart")


def _offsets(sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out.astype(np.int32) if out[-1] < 2**31 else out


class _Dictionary:
    """The frequent words as sorted hashes and ragged ids, read in order into arrays of their final size."""

    def __init__(self, path: str, words: int, ids: int, kind: type):
        system, folder = files.opened(path)
        self.keys, self.flat = np.empty(words, np.int64), np.empty(ids, kind)
        self.at = np.zeros(words + 1, np.int32 if ids < 2**31 else np.int64)
        # The files of a sorted table are named in its order.
        row = 0
        for part in sorted(f.path for f in system.get_file_info(files.fs.FileSelector(folder)) if f.path.endswith(".parquet")):
            with system.open_input_file(part) as source:
                for batch in pq.ParquetFile(source, pre_buffer=False).iter_batches(1 << 16, columns=["hash", "ids"], use_threads=False):
                    lists, end = batch.column("ids"), row + len(batch)
                    self.keys[row:end] = batch.column("hash").to_numpy()
                    self.at[row + 1 : end + 1] = self.at[row] + np.cumsum(lists.value_lengths().to_numpy())
                    self.flat[self.at[row] : self.at[end]] = lists.flatten().to_numpy()
                    row = end
        if row != words or self.at[-1] != ids or not (self.keys[1:] > self.keys[:-1]).all():
            raise ValueError("the written words are not whole or not in order")
        give_back()

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        distinct, order = np.unique(hashes.view(np.int64), return_inverse=True)
        place = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
        return np.where(self.keys[place] == distinct, place, -1)[order]


def _dictionary(written: tuple) -> _Dictionary:
    if _LOADED.get("dictionary_of") != written:
        _LOADED.update(dictionary_of=written, dictionary=_Dictionary(*written))
    return _LOADED["dictionary"]


def _sorted(words: DataFrame, model: str) -> tuple:
    """The words, written in order of their hashes: what ``_dictionary`` needs to load them without sorting or copying."""
    made, path = write(words.select("hash", "ids").orderBy("hash"), "sorted-words")
    count, ids = made.agg(F.count("*"), F.sum(F.size("ids").cast("long"))).first()
    return path, count, ids or 0, np.uint16 if len(_pieces(model).spelled_at) <= 1 << 16 else np.int32


def _common(words: DataFrame, most: int) -> DataFrame:
    """The words that occur as often as the least bound that leaves at most ``most``; only the few different numbers are ranked."""
    numbers = words.groupBy("n").agg(F.count("*").alias("words"))
    running = numbers.select("n", F.sum("words").over(Window.orderBy(F.desc("n"))).alias("so_far"))
    bound = running.where(F.col("so_far") <= most).agg(F.min("n")).first()[0]
    return words.where(F.col("n") >= F.lit(bound).cast("long"))


def encode(docs: DataFrame, model: str, text: str = "text", most_words: int = 8_000_000, keep: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` as ``row`` (the columns of ``keep``, or all), with the ids of the text and facts about them.

    ids (array<int>), n_tokens, ids_crc32 (of 32-bit little-endian ids), and round_trip: whether the ids, decoded, give
    the text again.
    """
    words, path, salt = dictionary(docs, model, text)
    whole = docs.select(F.struct(*(keep or ["*"])).alias("row"), F.col(text).cast("string").alias("text"))
    if words.count() <= most_words:
        written = _sorted(words, model)
        drop_path(docs.sparkSession, path)
        rows = whole.withColumn("rare", F.lit(None).cast("map<bigint,array<int>>"))
    else:
        written = _sorted(_common(words, most_words), model)
        rows = _with_rare(whole, words, written, model, salt)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = _pieces(model), _dictionary(written)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets, AT_ONCE):
                part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                _, _, _, hashes, first = pieces.words(part, at, salt)
                place = known.find(hashes)
                flat, spans = known.flat, known.at
                if (place < 0).any():
                    place, flat, spans = _with_own(batch.column(2).slice(a, b - a).to_pylist(), hashes, first, place, flat, spans)
                ids, size = _gathered(flat, spans, place)
                ids = ids.astype(np.int32)
                edge = np.concatenate(([0], np.cumsum(size)))[first]
                raw, edges = ids.astype("<u4").tobytes(), edge.tolist()
                sums = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(edges[:-1], edges[1:], strict=True)]
                texts = part.tobytes()
                back = [
                    pieces.decode(ids[x:y]) == texts[p:q].replace(MARK.encode(), b" ")
                    for x, y, p, q in zip(edges[:-1], edges[1:], at[:-1].tolist(), at[1:].tolist(), strict=True)
                ]
                lists = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(ids))
                columns = [batch.column(0).slice(a, b - a), lists, pa.array(np.diff(edge).astype(np.int64)), pa.array(sums, pa.int64()), pa.array(back, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "ids", "n_tokens", "ids_crc32", "round_trip"])
        # The worker outlives its task: the dictionary goes, the piece table stays.
        del known
        _LOADED.pop("dictionary_of", None)
        _LOADED.pop("dictionary", None)
        give_back()

    schema = whole.select("row").schema.add("ids", T.ArrayType(T.IntegerType())).add("n_tokens", "long")
    return rows.mapInArrow(work, schema.add("ids_crc32", "long").add("round_trip", "boolean"))


def _with_own(own: list, hashes: np.ndarray, first: np.ndarray, place: np.ndarray, flat: np.ndarray, at: np.ndarray):
    """Words that the dictionary lacks are taken from their row's own map."""
    extra, where = [], {}
    place, found = place.copy(), place >= 0
    # Of the dictionary only the words that occur here are copied.
    used, place[found] = np.unique(place[found], return_inverse=True)
    flat, size = _gathered(flat, at, used)
    at = _offsets(size)
    row = np.searchsorted(first, np.flatnonzero(place < 0), "right") - 1
    for k, r in zip(np.flatnonzero(place < 0).tolist(), row.tolist(), strict=True):
        h = int(hashes[k : k + 1].view(np.int64)[0])
        if h not in where:
            where[h] = len(at) - 1 + len(extra)
            extra.append(dict(own[r])[h])
        place[k] = where[h]
    sizes = np.cumsum([len(x) for x in extra])
    return place, np.concatenate((flat, np.concatenate(extra).astype(flat.dtype))), np.concatenate((at, at[-1] + sizes))


def _with_rare(whole: DataFrame, words: DataFrame, written: tuple, model: str, salt: int) -> DataFrame:
    """Each row with a map of its words that the common dictionary lacks, found by a join on the word's hash."""

    def missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = _pieces(model), _dictionary(written)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for a, b in chunks(offsets, AT_ONCE):
                _, _, _, hashes, first = pieces.words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], salt)
                rare = np.flatnonzero(known.find(hashes) < 0)
                row = a + np.searchsorted(first, rare, "right") - 1
                yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(row)), pa.array(hashes[rare].view(np.int64))], ["key", "hash"])

    keyed = whole.withColumn("key", F.sha2("text", 256))
    pairs = keyed.select("text", "key").mapInArrow(missing, "key string, hash long").distinct()
    maps = pairs.join(words.select("hash", "ids"), "hash").groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("hash", "ids"))).alias("rare"))
    return keyed.join(maps, "key", "left").select("row", "text", "rare")


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """The rows of ``encoded`` as ``row``, with the text that their ids spell as ``decoded``."""
    rows = encoded.select(F.struct("*").alias("row"), F.col(ids).cast("array<int>").alias("ids"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for batch in batches:
            lists = batch.column(1)
            out = [pieces.decode(x.values.to_numpy()).decode("utf-8", "replace") if x.is_valid else None for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["row", "decoded"])

    return rows.mapInArrow(work, rows.select("row").schema.add("decoded", "string"))

