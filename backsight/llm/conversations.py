"""Repair of the turn structure of conversations at the least cost, by Four-Russians block tables.

The rows of a conversation, in order, are symbols: the first letter of the role (system, user, assistant or other) and the row's
first fault (blank, duplicate, truncated or none). Edits make the roles read ``(s?(ua)+)?``: Keep 0, Rerole to user or
assistant 1, Delete 2 (blank and duplicate rows must go), Insert an empty user or assistant turn 5; a truncated row that stays
costs 5. What is left to pay from a row on depends on which of four states the roles before it have reached: nothing yet,
system, user, assistant. These four numbers, less their least, take few values; a table holds, for each of them and each block of
``BLOCK`` symbols, the numbers before the block and how much the least one rises. A conversation is read backward, block by
block, by lookup. The cheapest edits are then traced forward: each block is expanded backward from the numbers behind it,
and at each row the least of the letters D, I, K, R that keeps the cost is taken, so that ties have one answer.

Spark's part: rows are numbered along (turn, role, text) in ranges, so that a conversation of any size is cut; duplicates are
rows after the first of their (conversation, role, digest of the text), found by one aggregation; the symbols travel as strings of at most
65,536 rows; the backward pass goes over these, one byte per row. The forward pass streams a conversation's rows by,
one piece in memory at a time. It is one task for each conversation, as a SHA-256 of the joined rows has to be taken in order.

Cases: a null role or text is one space, in damage a null conv_id or turn, too; rows of a null conv_id are a conversation;
null turns come first; rows of one turn go by role and text, repeated rows side by side; a role without a known first letter
cannot be kept, but reroled; a conversation without rows is whole and empty; very long texts stay in their row. Empty tables
give none. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backsight.llm.components import write
from backsight.operators.ordering import join_on, numbered

#: The costs of the edits.
REROLE, DELETE, TRUNCATED, INSERT = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
SOUND, BLANK, DUPLICATE, CUT = range(4)
#: The state that an inserted or reroled turn leads to.
NEXT = [USER, USER, ASSISTANT, USER]
BLOCK, PIECE = 4, 65_536
WHITE = r"[^\x20\x09-\x0D]"


def symbol(code: int) -> tuple[int, int]:
    """(state that the role leads to, 0 for others; fault) of a symbol, a number below 16."""
    return code >> 2, code & 3


def kept_state(state: int, role: int) -> int | None:
    """Where a kept row leads: a system row only at the start, the others in turn."""
    if role == SYSTEM:
        return SYSTEM if state == START else None
    return role if role in (USER, ASSISTANT) and NEXT[state] == role else None


def before(code: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """What is left to pay in each state before a row, from what is left after it."""
    role, fault = symbol(code)
    stay = TRUNCATED if fault == CUT else 0
    here = []
    for state in range(4):
        options = [DELETE + after[state]]
        if fault not in (BLANK, DUPLICATE):
            options.append(REROLE + stay + after[NEXT[state]])
            kept = kept_state(state, role)
            if kept is not None:
                options.append(stay + after[kept])
        here.append(min(options))
    return with_inserts(here)


def with_inserts(here: list[int]) -> tuple[int, ...]:
    """Turns may be inserted first; after two of them the same states come again."""
    for _ in range(3):
        here = [min(here[q], INSERT + here[NEXT[q]]) for q in range(4)]
    return tuple(here)


#: Rows that must go are alike whatever their role, and a sound row stands for its role; so 16 symbols are nine kinds.
KIND_OF = np.array([0 if code & 3 in (BLANK, DUPLICATE) else 1 + 2 * (code >> 2) + (code & 3 == CUT) for code in range(16)])
CODE_OF = [int(np.flatnonzero(KIND_OF == kind)[0]) for kind in range(9)]
KINDS = len(CODE_OF)

#: What is left to pay behind the last row: nothing where the roles may end.
AT_END = with_inserts([0, 10**6, 10**6, 0])


class Tables:
    """The normalised cost vectors, and the transitions of single symbols and of blocks between them."""

    def __init__(self):
        least = min(AT_END)
        self.vectors = [tuple(x - least for x in AT_END)]
        number, rows = {self.vectors[0]: 0}, []
        for vector in self.vectors:  # grows while it is read
            row = []
            for code in CODE_OF:
                found = before(code, vector)
                shape = tuple(x - min(found) for x in found)
                if shape not in number:
                    number[shape] = len(self.vectors)
                    self.vectors.append(shape)
                row.append((number[shape], min(found)))
            rows.append(row)
        single = np.array(rows)
        self.to, self.rise = single[..., 0], single[..., 1]
        to, rise = self.to, self.rise
        for _ in range(BLOCK - 1):
            # one more symbol in front: its number is the highest digit of the block's
            rise = (rise[..., None] + self.rise[to]).swapaxes(1, 2).reshape(len(to), -1)
            to = self.to[to].swapaxes(1, 2).reshape(len(to), -1)
        self.block_to, self.block_rise = to, rise
        self.block_to_list, self.block_rise_list = to.tolist(), rise.tolist()

    def backward(self, kinds: np.ndarray, shape: int) -> tuple[list[int], int, int]:
        """The vector numbers behind each block, the first block first, the one before all rows, and the total rise.

        The rows in front that do not fill a block are a block of their own.
        """
        front = len(kinds) % BLOCK
        blocks = (kinds[front:].reshape(-1, BLOCK) @ (KINDS ** np.arange(BLOCK - 1, -1, -1))).tolist()
        behind, total = [], 0
        for block in reversed(blocks):
            behind.append(shape)
            total += self.block_rise_list[shape][block]
            shape = self.block_to_list[shape][block]
        if front:
            behind.append(shape)
            for kind in reversed(kinds[:front].tolist()):
                total += int(self.rise[shape, kind])
                shape = int(self.to[shape, kind])
        return behind[::-1], shape, total

    def trace(self, codes: np.ndarray, shape: int, state: int, ends: bool) -> tuple[list[tuple[str, ...]], int]:
        """The letters of each row (inserts in front of it, and its own), the least ones, and the state behind the rows.

        ``shape`` is the vector behind the last row. Inserts behind the last row are one more entry where ``ends``.
        """
        behind, _, _ = self.backward(KIND_OF[codes], shape)
        starts = [0, *range(len(codes) % BLOCK or BLOCK, len(codes), BLOCK)]
        out: list[tuple[str, ...]] = []
        for start, end, number in zip(starts, [*starts[1:], len(codes)], behind, strict=True):
            after, part = [self.vectors[number]], codes[start:end].tolist()
            for code in reversed(part):
                after.append(before(code, after[-1]))
            for code, here, later in zip(part, after[:0:-1], after[-2::-1], strict=True):
                letters, state = _row_edits(code, here, later, state)
                out.append(letters)
        if ends:
            letters = ()
            while AT_END[state]:
                letters, state = (*letters, "I"), NEXT[state]
            out.append(letters)
        return out, state


def _row_edits(code: int, here: tuple[int, ...], after: tuple[int, ...], state: int) -> tuple[tuple[str, ...], int]:
    """The least letters up to and with this row's own, and the state behind it."""
    role, fault = symbol(code)
    stay, letters = TRUNCATED if fault == CUT else 0, ()
    while True:
        if here[state] == DELETE + after[state]:
            return (*letters, "D"), state
        if here[state] == INSERT + here[NEXT[state]]:
            letters, state = (*letters, "I"), NEXT[state]
            continue
        kept = kept_state(state, role)
        if kept is not None and fault not in (BLANK, DUPLICATE) and here[state] == stay + after[kept]:
            return (*letters, "K"), kept
        return (*letters, "R"), NEXT[state]


@cache
def tables() -> Tables:
    return Tables()


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations (conv_id, turn, role, text) with faults dealt by the checksum of conv_id and turn."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    kind = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind")).where("kind <> 0")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return kind.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def coded(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (conv_id, pos, turn, role, text), numbered, and their symbols in pieces (conv_id, piece, codes)."""
    placed, _ = write(numbered(rows, ["conv_id"], ["turn", "role", "text"], "pos"), "numbered-turns")
    dark = F.regexp_extract("text", rf"({WHITE})[\x20\x09-\x0D]*\z", 1)
    slim = placed.select("conv_id", "pos", F.substring("role", 1, 1).alias("initial"), F.md5(F.encode("role", "UTF-8")).alias("role"), F.md5(F.encode("text", "UTF-8")).alias("digest"), F.length("text").alias("size"), dark.alias("last"))
    same = ["conv_id", "role", "digest", "size"]
    slim, _ = write(slim, "slim-turns")
    again = slim.where("last <> ''").groupBy(*same).agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    judged = join_on(slim, again, same, "left")
    fault = F.when(F.col("last") == "", BLANK).when(F.col("pos") > F.col("first"), DUPLICATE).when(~F.col("last").isin(".", "!", "?"), CUT).otherwise(SOUND)
    role = F.when(F.col("initial") == "s", SYSTEM).when(F.col("initial") == "u", USER).when(F.col("initial") == "a", ASSISTANT).otherwise(START)
    codes = judged.select("conv_id", "pos", F.floor((F.col("pos") - 1) / PIECE).alias("piece"), F.chr((role * 4 + fault + 65).cast("long")).alias("code"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]), "")
    return placed, codes.groupBy("conv_id", "piece").agg(joined.alias("codes"))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8).astype(np.int64) - 65


def with_costs(pieces: DataFrame) -> DataFrame:
    """Each piece with the number of the cost vector behind it; the first piece of a conversation also has the whole cost."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, now, shape, total, fresh = tables(), None, 0, 0, True
        for batch in batches:
            rows = []
            for conv, piece, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if fresh or conv != now:
                    now, shape, total, fresh = conv, 0, min(AT_END), False
                _, entry, rise = made.backward(KIND_OF[_codes(text)], shape)
                total += rise
                cost = total + made.vectors[entry][START] if piece == 0 else None
                rows.append((conv, piece, text, shape, cost))
                shape = entry
            columns = zip(*rows, strict=True)
            types = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv_id", "piece", "codes", "shape", "cost"])

    ordered = pieces.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("piece").cast("long").alias("piece"), "codes").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("piece"))
    return ordered.mapInArrow(work, "conv_id long, piece long, codes string, shape int, cost long")


class _Repair:
    """One conversation as its pieces and rows stream by."""

    LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}

    def __init__(self, conv, cost: int):
        self.conv, self.cost, self.state, self.counts, self.illegal = conv, cost, START, [0] * 4, 0
        self.last, self.audit, self.sum, self.any, self.edits, self.at = None, [], hashlib.sha256(), False, [], 0

    def piece(self, text: str, shape: int, ends: bool) -> None:
        codes = _codes(text)
        for fault, n in zip(*np.unique(codes & 3, return_counts=True), strict=True):
            self.counts[fault] += int(n)
        roles = codes >> 2
        if self.last is not None:
            roles = np.concatenate(([self.last], roles))
        pairs = roles[:-1] * 4 + roles[1:]
        self.illegal += len(pairs) - int(np.isin(pairs, [a * 4 + b for a, b in self.LEGAL]).sum())
        self.last = int(roles[-1])
        entry = self.state
        self.edits, self.state = tables().trace(codes, shape, self.state, ends)
        self.audit.append("".join(letter for letters in self.edits for letter in letters))
        self.at, self.role = 0, entry
        self.codes = codes

    def _put(self, role: str, text: str) -> None:
        self.sum.update(((("\n" if self.any else "") + role + ":") + text).encode())
        self.any = True

    def row(self, role: str, text: str) -> None:
        for letter in self.edits[self.at]:
            if letter == "I":
                self._insert()
            elif letter == "R":
                self.role = NEXT[self.role]
                self._put("user" if self.role == USER else "assistant", text)
            elif letter == "K":
                self.role = kept_state(self.role, int(self.codes[self.at]) >> 2)
                self._put(role, text)
        self.at += 1

    def _insert(self) -> None:
        self.role = NEXT[self.role]
        self._put("user" if self.role == USER else "assistant", "")

    def result(self) -> tuple:
        for _ in self.edits[-1]:  # inserts behind the last row
            self._insert()
        return (self.conv, *self.counts[1:], self.illegal, self.cost, "".join(self.audit), self.sum.hexdigest())


def repaired(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """(conv_id, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of conversations with rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 6 + [pa.string()] * 2
        names = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        now = None
        for batch in batches:
            done = []
            for conv, piece, _, role, text, shape, cost, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shape is None:
                    now.row(role, text)
                    continue
                if piece == 0:
                    if now is not None:
                        done.append(now.result())
                    now = _Repair(conv, cost)
                now.piece(text, shape, last)
            if done:
                yield out(done)
        if now is not None:
            yield out([now.result()])

    most = pieces.groupBy("conv_id").agg(F.max("piece").alias("most"))
    heads = join_on(pieces, most, ["conv_id"]).select(
        "conv_id", "piece", F.lit(0).cast("long").alias("pos"), F.lit("").alias("role"), F.col("codes").alias("text"), "shape", "cost", (F.col("piece") == F.col("most")).alias("last")
    )
    rows = placed.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.floor((F.col("pos") - 1) / PIECE).cast("long").alias("piece"), "pos", "role", "text",
        F.lit(None).cast("int").alias("shape"), F.lit(None).cast("long").alias("cost"), F.lit(None).cast("boolean").alias("last"),
    )
    ordered = heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "piece", "pos")
    return ordered.mapInArrow(work, ", ".join(f"{n} {'string' if n in ('audit', 'repaired_sha256') else 'long'}" for n in ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]))


def repair(rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text): gaps and faults, and the repair, after ``damaged``."""
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    placed, pieces = coded(damaged(rows))
    pieces, _ = write(with_costs(pieces), "costed-pieces")
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = placed.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))
    found = join_on(join_on(rows.select("conv_id").distinct(), gaps, ["conv_id"], "left"), repaired(placed, pieces), ["conv_id"], "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
