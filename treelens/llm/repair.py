"""Conversation structure repair by dynamic programming over a grammar of fault sequences.

Each row becomes one of nine symbols: must go (blank or duplicate), or its role (system,
user, assistant, other), whole or truncated. The cheapest edits of a sequence are a product
of min-plus matrices over four states (nothing written, a system row, a user row, an
assistant row); an entry is a cost and the letters of the edits, ties by the least letters.

1. Rows are cut into segments of bounded size in the order of the conversation, by range, so
   that a conversation of any length is spread over tasks.
2. Within a task, the distinct symbol sequences of many segments are compressed with Re-Pair.
   Every rule has one transfer matrix, made from those of its two halves and shared by all
   sequences in which it occurs. The letters of an entry are a rope: two halves, joined to a
   string only where a tie or the result asks for it.
3. Per conversation the matrices of its segments are folded in order. Only costs and letters
   are read there, not the texts. Letters that end with an edit of a row are no prefixes of
   one another, so a comparison of what came before decides ties for good.
4. With its entry state and its letters, every segment writes its repaired rows.

Steps 1, 2 and 4 do not depend on the length of a conversation. Step 3 is one pass over a
conversation's segments, as is a digest of its whole text.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from treelens.llm import frames
from treelens.plans.materialize import measured

_BLANKS = " \t\n\x0b\x0c\r"
SEGMENT_ROWS, SEGMENT_BYTES = 1024, 1 << 20
BLOCK_SYMBOLS = 1 << 15
_MEMORY = 100_000
_INFINITE = np.iinfo(np.int32).max
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs; keeping is free
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: Must go; roles of whole rows; roles of truncated rows. "o" is any role but the three.
SYMBOLS = "xsuaoSUAO"


class Rope:
    """Letters as two halves, joined when first read."""

    __slots__ = ("_left", "_right", "_text")

    def __init__(self, text=None, left=None, right=None):
        self._text, self._left, self._right = text, left, right

    def __str__(self) -> str:
        if self._text is None:
            parts, todo = [], [self]
            while todo:
                rope = todo.pop()
                if rope._text is not None:
                    parts.append(rope._text)
                else:
                    todo += (rope._right, rope._left)
            self._text, self._left, self._right = "".join(parts), None, None
        return self._text


Matrix = list[list["tuple[int, Rope] | None"]]


def _product(x: Matrix, y: Matrix) -> Matrix:
    out: Matrix = [[None] * 4 for _ in range(4)]
    for p in range(4):
        for q in range(4):
            best = None
            for mid in range(4):
                a, b = x[p][mid], y[mid][q]
                if a is None or b is None:
                    continue
                cost = a[0] + b[0]
                if best is None or cost < best[0]:
                    best = (cost, Rope(None, a[1], b[1]))
                elif cost == best[0]:
                    rope = Rope(None, a[1], b[1])
                    if str(rope) < str(best[1]):
                        best = (cost, rope)
            out[p][q] = best
    return out


def _next_role(state: int) -> int:
    """The state after a row whose role is free to choose between user and assistant."""
    return _ASSISTANT if state == _USER else _USER


def _insertions() -> Matrix:
    """Any number of inserted rows; more than two come back to a state already reached."""
    out: Matrix = [[None] * 4 for _ in range(4)]
    for p in range(4):
        state, letters = p, ""
        while out[p][state] is None:
            out[p][state] = (INSERT * len(letters), Rope(letters))
            state, letters = _next_role(state), letters + "I"
    return out


def _edits(symbol: str) -> Matrix:
    """The edits of one row."""
    out: Matrix = [[None] * 4 for _ in range(4)]
    late = TRUNCATED if symbol.isupper() else 0
    keeps = {"s": {_START: _SYSTEM}, "u": {_START: _USER, _SYSTEM: _USER, _ASSISTANT: _USER}, "a": {_USER: _ASSISTANT}}
    for p in range(4):
        out[p][p] = (DELETE, Rope("D"))
        if symbol == "x":
            continue
        # Rerole and keep lead to the same state only where keep is legal, and then keep is cheaper.
        out[p][_next_role(p)] = (REROLE + late, Rope("R"))
        if (q := keeps.get(symbol.lower(), {}).get(p)) is not None:
            out[p][q] = (late, Rope("K"))
    return out


INSERTIONS = _insertions()
LETTERS = {symbol: _product(INSERTIONS, _edits(symbol)) for symbol in SYMBOLS}
EMPTY: Matrix = [[(0, Rope("")) if p == q else None for q in range(4)] for p in range(4)]


def re_pair(sequences: list[str], least: int = 4) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Rules (left, right) and the compressed sequences.

    Symbols are the places in ``SYMBOLS``; rule i is symbol len(SYMBOLS) + i. In every round the
    pair found most often (the smallest, if several) becomes a rule, until none is found
    ``least`` times.
    """
    place = np.full(128, -1, np.int64)
    place[[ord(c) for c in SYMBOLS]] = np.arange(len(SYMBOLS))
    flat = place[np.frombuffer("\0".join(sequences).encode(), np.uint8)]  # -1 between sequences
    rules: list[tuple[int, int]] = []
    while len(flat) > 1:
        inside = np.flatnonzero((flat[:-1] >= 0) & (flat[1:] >= 0))
        if not len(inside):
            break
        size = len(SYMBOLS) + len(rules)
        code, count = np.unique(flat[inside] * size + flat[inside + 1], return_counts=True)
        best = int(np.argmax(count))
        if count[best] < least:
            break
        left, right = divmod(int(code[best]), size)
        at = np.flatnonzero((flat[:-1] == left) & (flat[1:] == right))
        if left == right:  # in a run every second pair counts
            fresh = np.ones(len(at), bool)
            fresh[1:] = at[1:] != at[:-1] + 1
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
        flat[at] = size
        flat = np.delete(flat, at + 1)
        rules.append((left, right))
    cuts = np.flatnonzero(flat < 0)
    return rules, [part[part >= 0].tolist() for part in np.split(flat, cuts)]


class Evaluator:
    """Transfer matrices of symbol sequences; remembers those of whole sequences between blocks."""

    def __init__(self):
        self.known: dict[str, Matrix] = {"": EMPTY}

    def __call__(self, sequences: list[str]) -> list[Matrix]:
        new = sorted({s for s in sequences if s not in self.known})
        if len(self.known) + len(new) > _MEMORY:
            self.known = {"": EMPTY}
            new = sorted({s for s in sequences if s})
        if new:
            rules, parts = re_pair(new)
            matrices = [LETTERS[symbol] for symbol in SYMBOLS]
            for left, right in rules:  # halves come before the rules made of them
                matrices.append(_product(matrices[left], matrices[right]))
            for sequence, part in zip(new, parts):
                out = matrices[part[0]]
                for symbol in part[1:]:
                    out = _product(out, matrices[symbol])
                self.known[sequence] = out
        return [self.known[s] for s in sequences]


class _Segment:
    """Rows of one conversation that follow one another."""

    def __init__(self, conv, conv_id):
        self.conv, self.conv_id, self.rows, self.bytes = conv, conv_id, 0, 0
        self.symbols, self.roles, self.texts = [], [], []
        self.first = self.last = ""  # initials of the roles
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None

    def room(self, rows: int) -> int:
        return 0 if self.bytes >= SEGMENT_BYTES else rows - self.rows

    def add(self, turn, role: str, text: str, symbol: str, copies: int) -> None:
        """``copies`` equal rows; the first counts as ``symbol`` says, "b" blank and "d" duplicate, the rest as duplicates."""
        initial = _INITIALS.get(role[:1], "o")
        self.illegal += copies - 1 + (self.rows > 0 and self.last + initial not in _LEGAL)
        self.rows += copies
        self.first, self.last = self.first or initial, initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if symbol == "b":
            self.blank += copies
            self.symbols.append("x" * copies)
        else:
            self.duplicate += copies - (symbol != "d")
            self.truncated += symbol.isupper()
            self.symbols.append(("x" if symbol == "d" else symbol) + "x" * (copies - 1))
            if symbol != "d":
                self.roles.append(role)
                self.texts.append(text)
                self.bytes += len(text) + len(role)


_INITIALS = {c: c for c in "sua"}
_LEGAL = {"su", "ua", "au"}
_FACTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
_SEGMENT = (
    "conv string, part bigint, segment bigint, symbols string, roles array<string>, texts array<string>, first string, last string, "
    "low bigint, high bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, costs array<int>, letters array<string>"
)


def _cut(batches, conv_type: pa.DataType, segment_rows: int):
    """Segments of sorted rows, each with its transfer matrix."""
    part, number = TaskContext.get().partitionId(), 0
    evaluate, waiting, waiting_rows, open_ = Evaluator(), [], 0, None

    def written():
        nonlocal number, waiting, waiting_rows
        symbols = ["".join(s.symbols) for s in waiting]
        entries = [[e for row in m for e in row] for m in evaluate(symbols)]
        columns = {
            "conv_id": pa.array([s.conv_id for s in waiting], conv_type),
            "conv": pa.array([s.conv for s in waiting], pa.string()),
            "part": pa.array([part] * len(waiting), pa.int64()),
            "segment": pa.array(range(number, number + len(waiting)), pa.int64()),
            "symbols": pa.array(symbols, pa.string()),
            "roles": pa.array([s.roles for s in waiting], pa.list_(pa.string())),
            "texts": pa.array([s.texts for s in waiting], pa.list_(pa.string())),
            "first": pa.array([s.first for s in waiting], pa.string()),
            "last": pa.array([s.last for s in waiting], pa.string()),
            "low": pa.array([s.low for s in waiting], pa.int64()),
            "high": pa.array([s.high for s in waiting], pa.int64()),
            **{f: pa.array([getattr(s, f) for s in waiting], pa.int64()) for f in _FACTS},
            "costs": pa.array([[_INFINITE if e is None else e[0] for e in m] for m in entries], pa.list_(pa.int32())),
            "letters": pa.array([["" if e is None else str(e[1]) for e in m] for m in entries], pa.list_(pa.string())),
        }
        number, waiting, waiting_rows = number + len(waiting), [], 0
        return pa.RecordBatch.from_pydict(columns)

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "conv", "turn", "role", "text", "symbol", "copies")))
        for conv_id, conv, turn, role, text, symbol, copies in rows:
            if open_ is not None and open_.conv != conv:
                waiting.append(open_)
                waiting_rows += 1 + open_.rows
                open_ = None
                if waiting_rows >= BLOCK_SYMBOLS:
                    yield written()
            if open_ is None:
                open_ = _Segment(conv, conv_id)
            while copies:
                if (room := open_.room(segment_rows)) <= 0:
                    waiting.append(open_)
                    waiting_rows += 1 + open_.rows
                    open_ = _Segment(conv, conv_id)
                    if waiting_rows >= BLOCK_SYMBOLS:
                        yield written()
                    continue
                now = min(copies, room)
                open_.add(turn, role, text, symbol, now)
                copies -= now
                symbol = symbol if symbol == "b" else "d"  # the rest of the copies
    if open_ is not None:
        waiting.append(open_)
    if waiting:
        yield written()


class _Reached(NamedTuple):
    cost: int
    place: int  # order among the letters of all states reached after the same segment
    before: int  # state before the segment


class _Fold:
    """Matrices of one conversation, one after the other; keeps a few numbers and the letters chosen from."""

    def __init__(self, conv, conv_id):
        self.conv, self.conv_id = conv, conv_id
        self.states: dict[int, _Reached] = {_START: _Reached(0, 0, _START)}
        self.steps = []  # (part, segment, state before by state after, letters by state after)
        self.facts = dict.fromkeys(_FACTS, 0)
        self.low = self.high = None
        self.last = ""

    def add(self, row: dict) -> None:
        for f in _FACTS:
            self.facts[f] += row[f]
        if row["first"]:
            self.facts["illegal"] += bool(self.last) and self.last + row["first"] not in _LEGAL
            self.last = row["last"]
        if row["low"] is not None:
            self.facts["turns"] -= row["low"] == self.high
            self.low, self.high = row["low"] if self.low is None else self.low, row["high"]
        best = {}
        for q in range(4):
            ways = [(s.cost + row["costs"][4 * p + q], s.place, p) for p, s in self.states.items() if row["costs"][4 * p + q] != _INFINITE]
            if ways:
                best[q] = min(ways)
        order = sorted(best, key=lambda q: (best[q][1], row["letters"][4 * best[q][2] + q]))
        self.states = {q: _Reached(best[q][0], order.index(q), best[q][2]) for q in best}
        self.steps.append((row["part"], row["segment"], {q: s.before for q, s in self.states.items()}, {q: row["letters"][4 * s.before + q] for q, s in self.states.items()}))

    def result(self):
        """Conversation facts, and (part, segment, state, letters) of every segment."""
        ends = [(s.cost + INSERTIONS[q][end][0], s.place, str(INSERTIONS[q][end][1]), q) for q, s in self.states.items() for end in (_START, _ASSISTANT) if INSERTIONS[q][end]]
        cost, _, tail, q = min(ends)
        path = []
        for part, segment, before, letters in reversed(self.steps):
            path.append((part, segment, before[q], letters[q]))
            q = before[q]
        path.reverse()
        if tail:
            part, segment, state, letters = path[-1]
            path[-1] = (part, segment, state, letters + tail)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.facts["turns"]
        return cost, gaps, "".join(letters for *_, letters in path), path


_PATH = "conv string, part bigint, segment bigint, state int, letters string, whole boolean, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _folded(batches, conv_type: pa.DataType):
    """Of segments sorted by conversation: a row for each segment, and one (``whole``) for each conversation."""
    names = ["conv_id", *(c.split(" ")[0] for c in _PATH.split(", "))]
    types = [conv_type, pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), *[pa.int64()] * 6, pa.string()]
    fold, out = None, []

    def close():
        cost, gaps, audit, path = fold.result()
        for step in path:
            out.append((fold.conv_id, fold.conv, *step, False, *[None] * 7))
        facts = [fold.facts[f] for f in _FACTS[:4]]
        out.append((fold.conv_id, fold.conv, None, None, None, None, True, gaps, *facts, cost, audit))

    def written():
        rows, out[:] = list(zip(*out)), []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=names)

    for batch in batches:
        for row in batch.to_pylist():
            if fold is not None and fold.conv != row["conv"]:
                close()
                fold = None
                if len(out) >= 4096:
                    yield written()
            if fold is None:
                fold = _Fold(row["conv"], row["conv_id"])
            fold.add(row)
    if fold is not None:
        close()
    if out:
        yield written()


def _repaired(symbols: str, roles, texts, state: int, letters: str):
    """(role, text, edit) of the rows that a segment writes."""
    out, row, kept = [], 0, 0
    for letter in letters:
        if letter != "I":
            has_text = symbols[row] != "x"
            own = kept
            kept += has_text
            row += 1
        if letter == "D":
            continue
        if letter == "K":
            role = symbols[row - 1].lower()
            state = _SYSTEM if role == "s" else _USER if role == "u" else _ASSISTANT
            out.append({"role": roles[own], "text": texts[own], "edit": letter})
            continue
        state = _next_role(state)
        role = "user" if state == _USER else "assistant"
        out.append({"role": role, "text": "" if letter == "I" else texts[own], "edit": letter})
    return out


_MESSAGES = "array<struct<role:string,text:string,edit:string>>"


def _rewritten(symbols: pa.Array, roles: pa.Array, texts: pa.Array, state: pa.Array, letters: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]))
    columns = (c.to_pylist() for c in (symbols, roles, texts, state, letters))
    return pa.array([_repaired(*row) for row in zip(*columns)], kind)


def _key(column: str) -> Column:
    """A conversation id as text that no other id has; null has one of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _arrow_type(rows: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema[column].dataType)


class Repaired(NamedTuple):
    """``conversations``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    ``segments``: conv_id, part, segment, and messages, the repaired rows in order as (role, text, edit).
    """

    conversations: DataFrame
    segments: DataFrame

    def messages(self) -> DataFrame:
        """conv_id, part, segment, place, role, text, edit of every repaired row; ordered by these."""
        rows = self.segments.select("conv_id", "part", "segment", F.posexplode("messages").alias("place", "message"))
        return rows.select("conv_id", "part", "segment", F.col("place").cast("bigint").alias("place"), "message.*")


def repair(rows: DataFrame, copies: str | None = None, segment_rows: int = SEGMENT_ROWS) -> Repaired:
    """Cheapest repair of every conversation to the roles ``(system? (user assistant)+)?``.

    ``rows`` needs conv_id (any type that can be grouped), turn (an integer), role and text;
    other columns are ignored. ``copies`` names an integer column that tells how often a row
    stands there; a conversation all of whose rows have 0 is reported as empty. ``segment_rows``
    bounds the rows of a segment and does not change results.

    Rows are taken by turn, nulls first, then role, then text. A null role or text counts as
    one space; a null conv_id is a conversation of its own. A row's first fault counts: blank,
    duplicate (role and text seen earlier), truncated (last visible character none of ".!?").
    Blank and duplicate rows must go. Keeping costs 0, another role 1, deleting 2, an inserted
    empty row 5, a truncated row left in 5 more. ``illegal`` counts neighbouring rows whose
    role initials are none of su, ua, au; ``gaps`` turns missing between the first and last.

    An empty table gives no rows. A conversation of any number of rows, copies of one row, and
    texts of any length are handled in segments; only its audit and its segments' letters pass
    one task. The tables behind the result stay in the shared folder.
    """
    n = F.lit(1).cast("bigint") if copies is None else F.col(copies).cast("bigint")
    space = F.lit(" ")
    plain = rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), n.alias("copies")
    )
    plain = plain.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("conv", _key("conv_id"))
    seen = F.sha2("text", 256)
    # Few texts stand in several turns of a conversation; only those are joined.
    again = plain.filter("copies > 0").groupBy("conv", "role", seen.alias("seen")).agg(F.min(F.struct("turn")).alias("earliest"), F.count(F.lit(1)).alias("n"))
    again, small = measured(again.filter("n > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), "seen", "earliest"))
    again = F.broadcast(again) if small else again
    joined = plain.join(again, (F.col("conv") == F.col("c")) & (F.col("role") == F.col("r")) & (seen == F.col("seen")), "left")
    trimmed = F.rtrim("text", F.lit(_BLANKS))
    initial = F.substring("role", 1, 1)
    symbol = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    fault = (
        F.when(trimmed == "", "b")
        .when(F.col("earliest").isNotNull() & ~F.col("earliest.turn").eqNullSafe(F.col("turn")), "d")
        .when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), F.upper(symbol))
        .otherwise(symbol)
    )
    ready = joined.select("conv_id", "conv", "turn", "role", "text", fault.alias("symbol"), "copies")
    # The beginning of a text orders like the text, and keeps the bounds of ranges short.
    ordered = ready.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions("conv", "turn", "role", "text")
    conv_type = _arrow_type(rows, "conv_id")
    id_type = rows.schema["conv_id"].dataType.simpleString()
    segments = frames.stored(ordered.mapInArrow(lambda batches: _cut(batches, conv_type, segment_rows), f"conv_id {id_type}, {_SEGMENT}"))
    narrow = segments.drop("symbols", "roles", "texts").repartition("conv").sortWithinPartitions("conv", "part", "segment")
    folded = frames.stored(narrow.mapInArrow(lambda batches: _folded(batches, conv_type), f"conv_id {id_type}, {_PATH}"))
    path = folded.filter("not whole").select("part", "segment", "state", F.col("letters").alias("chosen"))
    path, small = measured(path)
    path = F.broadcast(path) if small else path
    chosen = segments.join(path, ["part", "segment"])
    messages = F.arrow_udf(_rewritten, _MESSAGES)("symbols", "roles", "texts", "state", "chosen")
    report = folded.filter("whole").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return Repaired(report, chosen.select("conv_id", "part", "segment", messages.alias("messages")))


def damage(rows: DataFrame) -> DataFrame:
    """Known faults by crc32 of ``conv_id:turn`` modulo 20, nulls as one space; ``copies`` is 0, 1 or 2."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    role = F.when(kind == 4, "user").otherwise(blank("role"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def digests(segments: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): lines ``role:text`` of a conversation, streamed in order through one digest."""

    def rows(batches):
        conv, digest, begun = None, None, False
        for batch in batches:
            done = []
            for key, messages in zip(batch.column("conv").to_pylist(), batch.column("messages").to_pylist()):
                if key != conv:
                    if conv is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest, begun = key, hashlib.sha256(), False
                if messages:
                    lines = "\n".join(f"{m['role']}:{m['text']}" for m in messages)
                    digest.update((("\n" if begun else "") + lines).encode())
                    begun = True
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], names=["conv", "repaired_sha256"])
        if conv is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([digest.hexdigest()])], names=["conv", "repaired_sha256"])

    ordered = segments.withColumn("conv", _key("conv_id")).repartition("conv").sortWithinPartitions("conv", "part", "segment")
    return ordered.select("conv", "messages").mapInArrow(rows, "conv string, repaired_sha256 string")


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    done = repair(damage(rows), copies="copies")
    report = done.conversations.withColumn("conv", _key("conv_id"))
    return report.join(digests(done.segments), "conv").drop("conv")
