"""Conversation repair against plain enumeration and a plain dynamic program."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F
from treelens.llm import repair as R

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
LEGAL = re.compile("(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults(rows):
    """b, d, t or a blank for every row of one conversation in order."""
    seen, out = set(), []
    for _, _, role, text in rows:
        end = text.rstrip(WHITE)
        out.append("b" if not end else "d" if (role, text) in seen else " " if end[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, letters) by a program over rows and states that carries whole strings."""

    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for state, (cost, letters) in list(best.items()):
                after = "a" if state == "u" else "u"
                best[after] = min(best.get(after, (10**9, "")), (cost + 5, letters + "I"))
        return best

    best = {"": (0, "")}
    for (_, _, role, _), fault in zip(rows, faults(rows)):
        new = {}
        for state, (cost, letters) in inserted(best).items():
            free = "a" if state == "u" else "u"
            ways = [(state, 2, "D")]
            if fault not in "bd":
                late = 5 if fault == "t" else 0
                ways.append((free, 1 + late, "R"))
                if role[:1] == free or (role[:1] == "s" and state == ""):
                    ways.append((role[:1], late, "K"))
            for after, more, letter in ways:
                new[after] = min(new.get(after, (10**9, "")), (cost + more, letters + letter))
        best = new
    return min(v for k, v in inserted(best).items() if k in ("", "a"))


def enumerated(rows):
    """The same by trying all edits with up to two insertions in every gap."""
    found = []
    marks = faults(rows)
    for gaps in itertools.product(("", "I", "II"), repeat=len(rows) + 1):
        for letters in itertools.product("DKR", repeat=len(rows)):
            if any(letter != "D" and mark in "bd" for letter, mark in zip(letters, marks)):
                continue
            audit = "".join(g + letter for g, letter in zip(gaps, letters)) + gaps[-1]
            if not LEGAL.fullmatch("".join(m[0][:1] or "?" for m in written(rows, audit))):
                continue
            cost = 5 * audit.count("I") + 2 * audit.count("D") + audit.count("R")
            cost += 5 * sum(letter != "D" and mark == "t" for letter, mark in zip(letters, marks))
            found.append((cost, audit))
    return min(found)


def written(rows, audit):
    out, rows, state = [], iter(rows), ""
    for letter in audit:
        row = next(rows) if letter != "I" else None
        if letter == "D":
            continue
        free = "assistant" if state == "u" else "user"
        out.append((row[2], row[3]) if letter == "K" else (free, "" if letter == "I" else row[3]))
        state = out[-1][0][:1]
    return out


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    marks = faults(rows)
    cost, audit = cheapest(rows)
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    text = "\n".join(f"{role}:{text}" for role, text in written(rows, audit))
    return (gaps, marks.count("b"), marks.count("d"), marks.count("t"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def by_conversation(rows, ids):
    return {c: expected([r for r in rows if r[0] == c]) for c in ids}


def answers(done):
    report = done.conversations.withColumn("conv", R._key("conv_id")).join(R.digests(done.segments), "conv").drop("conv")
    rows = [tuple(r) for r in report.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def some_rows(seed, conversations, most):
    rng = random.Random(seed)
    texts = ["One.", "Two!", "three", "", " \t", None, "Four? ", "five \n", "Six.\nseven", "Ü."]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "Sam", "sue", None])
            rows.append((None if conv == 7 else conv, rng.choice([turn, turn, turn, turn + 3, None]), role, rng.choice(texts)))
    return rows


def test_plain_program_equals_enumeration():
    for seed in range(150):
        rows = [(0, t, r or " ", x or " ") for _, t, r, x in some_rows(seed, 1, 4)]
        assert cheapest(rows) == enumerated(rows)


@pytest.mark.parametrize("segment_rows", [3, R.SEGMENT_ROWS])
def test_repair_equals_plain_program(spark, segment_rows):
    rows = some_rows(1, 300, 12)
    # Insertions run over borders of segments; a very long conversation, and one of copies of one row.
    rows += [(1000, t, random.Random(t).choice(["user", "assistant"]), f"{t % 700}.") for t in range(5000)]
    rows += [(1001, 4, "user", "Same.")] * 4000 + [(1002, None, "user", "Same.")] * 40
    df = spark.createDataFrame(rows, SCHEMA).withColumn("audit", F.lit(1)).withColumn("copies", F.lit("x"))
    got = answers(R.repair(df, segment_rows=segment_rows))
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got == by_conversation(plain, {r[0] for r in rows})


def test_query_equals_plain_program(spark):
    import os

    sf_dir = os.environ.get("TREELENS_SF_DIR", "/root/testdata/sf0.001")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in R.op11_conversation_repair(spark, sf_dir).collect()}
    left = damaged(rows)
    assert got == by_conversation(left, {r[0] for r in rows})


def test_dropped_and_empty(spark):
    rows = [(c, t, "user", None) for c in range(40) for t in [None, 0]]
    df = spark.createDataFrame(rows, SCHEMA)
    got = answers(R.repair(R.damage(df), copies="copies"))
    assert got == by_conversation(damaged(rows), range(40))
    none = hashlib.sha256(b"").hexdigest()
    assert answers(R.repair(df.withColumn("copies", F.lit(0)), copies="copies")) == {c: (0, 0, 0, 0, 0, 0, "", none) for c in range(40)}
    empty = R.repair(df.limit(0))
    assert answers(empty) == {} and empty.messages().count() == 0


def test_messages(spark):
    rows = [("a", 0, "assistant", "Hello."), ("a", 1, "user", "x" * 200_000 + "."), ("a", 2, "assistant", "Yes."), ("b", 0, "user", "Why?"), ("b", 1, "user", "Long " * 60_000 + ".")]
    done = R.repair(spark.createDataFrame(rows, SCHEMA.replace("conv_id bigint", "conv_id string")))
    got = [(r.conv_id, r.role, len(r.text), r.edit) for r in done.messages().orderBy("conv_id", "part", "segment", "place").collect()]
    assert got == [("a", "user", 200_001, "K"), ("a", "assistant", 4, "K"), ("b", "user", 4, "K"), ("b", "assistant", 300_001, "R")]


def test_rules_expand_to_their_sequences():
    rng = random.Random(5)
    sequences = ["".join(rng.choice(R.SYMBOLS[:4]) for _ in range(rng.randint(1, 90))) for _ in range(60)] + ["u" * 301, "ua" * 200]
    rules, parts = R.re_pair(sequences)
    assert rules

    def expand(symbol):
        return R.SYMBOLS[symbol] if symbol < len(R.SYMBOLS) else "".join(map(expand, rules[symbol - len(R.SYMBOLS)]))

    assert ["".join(map(expand, part)) for part in parts] == sequences
