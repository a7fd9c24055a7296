import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from backsight.llm import conversations, queries

SF = "/root/testdata/sf0.001"
WHITE = " \t\n\v\f\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, kind = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain_repair(turns):
    """Faults and the cheapest edits of one conversation, by a plain search over whole suffixes."""
    faults, seen = [], set()
    for _, role, text in turns:
        dark = text.strip(WHITE)
        faults.append("blank" if not dark else "duplicate" if (role, text) in seen else "truncated" if dark[-1] not in ".!?" else "")
        seen.add((role, text))
    following = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    inserted = {"": "u", "s": "u", "u": "a", "a": "u"}
    ahead = {"": (0, ""), "a": (0, ""), "u": (5, "I"), "s": (10, "II")}
    table = [ahead]
    for (_, role, _), fault in reversed(list(zip(turns, faults, strict=True))):
        own, extra, must = {}, 5 * (fault == "truncated"), fault in ("blank", "duplicate")
        for state in following:
            options = [(2 + ahead[state][0], "D" + ahead[state][1])]
            if not must:
                to = following[state].get(role[:1])
                if to:
                    options.append((extra + ahead[to][0], "K" + ahead[to][1]))
                to = inserted[state]
                options.append((1 + extra + ahead[to][0], "R" + ahead[to][1]))
            own[state] = min(options)
        for _ in range(3):
            own = {q: min(own[q], (5 + own[inserted[q]][0], "I" + own[inserted[q]][1])) for q in own}
        ahead = own
        table.append(own)
    cost, audit = ahead[""]
    state, left, out = "", list(turns), []
    for letter in audit:
        row = left.pop(0) if letter != "I" else (None, "", "")
        if letter == "D":
            continue
        state = following[state][row[1][:1]] if letter == "K" else inserted[state]
        out.append((row[1] if letter == "K" else {"u": "user", "a": "assistant"}[state]) + ":" + row[2])
    assert not left
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(turns)]
    count = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (*count, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def plain(rows):
    found = []
    after = plain_damage(rows)
    for conv in {r[0] for r in rows}:
        turns = sorted(((t, r, x) for c, t, r, x in after if c == conv), key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        found.append((conv, gaps, *plain_repair(turns)))
    return sorted(found, key=repr)


def invented(seed, count, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut", "", " \t", "Yes.", "long. text", "é?\n", "end.  "]
    rows = []
    for conv in range(count):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((rng.choice([conv, conv, conv, None]) if conv % 9 == 0 else conv, rng.choice([turn, turn, turn, turn // 2, None]), role, rng.choice([*texts, None])))
    return rows


def test_registered_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert sorted((tuple(r) for r in queries.QUERIES["op11_conversations"](spark, SF).collect()), key=repr) == plain(rows)


@pytest.mark.parametrize("piece", [65_536, 5])
def test_cases(spark, piece, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE", piece)
    rows = invented(1, 120, 30)
    rows += rows[5:9] + [(700, 3, "user", "x" * 300_000 + "."), (701, None, "user", "Hi."), (701, None, "assistant", "Hi.")]
    rows += [(800, t, "user", "All dropped.") for t in range(300) if zlib.crc32(f"800:{t}".encode()) % 20 == 0][:3]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, pos string, cost int").repartition(3)
    found = conversations.repair(frame)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain(rows)
    assert conversations.repair(frame.limit(0)).collect() == []


def test_block_tables_equal_single_steps():
    made = conversations.tables()
    assert made.block_to.shape == (len(made.vectors), conversations.KINDS**conversations.BLOCK)
    rng = np.random.default_rng(2)
    for length in (0, 1, 3, 4, 5, 8, 50, 203):
        codes = rng.integers(0, 16, length)
        vector = conversations.AT_END
        for code in codes[::-1].tolist():
            vector = conversations.before(code, vector)
        _, shape, rise = made.backward(conversations.KIND_OF[codes], 0)
        assert tuple(x + rise for x in made.vectors[shape]) == vector


def test_a_hot_conversation_is_cut(spark, monkeypatch):
    """Ranges of rows and pieces of symbols give what one list gives."""
    from backsight.operators import ordering

    monkeypatch.setattr(ordering, "ROWS_PER_CHUNK", 40)
    monkeypatch.setattr(ordering.numbered, "__defaults__", (40,))
    monkeypatch.setattr(conversations, "PIECE", 16)
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "B", "C!", ""])) for t in range(500)] + invented(5, 10, 9)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    assert sorted((tuple(r) for r in conversations.repair(frame).collect()), key=repr) == plain(rows)
