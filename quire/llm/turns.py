"""Conversation structure repair: the cheapest edits that turn a conversation
into an optional system turn followed by user and assistant turns in pairs.

A turn becomes a symbol of its role's initial and its first fault (blank,
duplicate, truncated).  Keep costs nothing, Rerole to user or assistant 2,
Delete 3 (required for blank and duplicate turns), Insert of an empty user or
assistant turn 2; a truncated turn that stays costs 1.  The role pattern has
four states (nothing yet, after system, after user, after assistant), so a
symbol is a 4 x 4 matrix over (min, +).  Equal consecutive symbols are a run;
a run is advanced by cached binary powers of its matrix, from the end of the
conversation to its start.  Then the choices are unrolled from the start: at
every turn the smallest initial (D, I, K, R) among those that reach the least
cost.  State and initial fix the next state, so this is the least audit.

Distribution: one range shuffle by (conversation, turn, role and text) sorts
the turns; whatever shares a conversation lies in one task or in consecutive
ones.  Conversations that end inside a task are finished there.  The first and
the last one of each task, and any of more than ``BLOCK`` bytes, go through
blocks of turns: equal turns are found by one aggregation of hashes, every
block gives the matrix of its runs, a scan over the blocks of a conversation
(16 numbers each) gives the cost behind every block, each block unrolls its
choices for all four entry states, a second scan picks the entry states, and
the blocks' texts are hashed in order.  So a conversation may hold any share of
all rows: no task holds more than one block of it.

Defined results: null roles and texts count as one blank (and so does a null
in ``conv_id:turn``); rows of one turn are ordered by role, then text's MD5;
null turns come first and don't count as turns; a null conv_id is a
conversation of its own; the initial of an empty role is empty and, like all
but s, u and a, legal nowhere; ``gaps`` beyond a long is cut to its maximum; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from quire.llm.base import stash, table

BLOCK = 1 << 20              # text bytes of a block, about
BLOCK_ROWS = 10_000          # turns of a block at most
SIZE = 32 << 20              # text bytes of a range, about
INF = 1 << 60
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}              # state after an inserted or reroled turn
LEGAL = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
PAIRS = {"su", "ua", "au"}
END = (0, 4, 2, 0)                           # cost of the inserts that complete a conversation
LONG = (1 << 63) - 1
RESULT = ("conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")


# ---- the DP over symbols --------------------------------------------------

def moves(symbol: str) -> list:
    """Per state: (initial, cost, next state, turns taken), D < I < K < R.
    ``symbol`` is 'x' for a turn that must go, else an initial ('-' for any
    other) with 't' behind it if the turn is truncated."""
    out = []
    for s in range(4):
        m = [("D", DELETE, s, 1), ("I", INSERT, NEXT[s], 0)]
        if symbol != "x":
            late = TRUNCATED if symbol.endswith("t") else 0
            if (s, symbol[0]) in LEGAL:
                m.append(("K", KEEP + late, LEGAL[s, symbol[0]], 1))
            m.append(("R", REROLE + late, NEXT[s], 1))
        out.append(m)
    return out


SYMBOLS = ["x"] + [i + t for i in "sua-" for t in ("", "t")]
MOVES = {s: moves(s) for s in SYMBOLS}
AT_END = [[("I", INSERT, NEXT[s], 0)] for s in range(4)]


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) product of matrices, or of a matrix and a vector."""
    if b.ndim == 1:
        return np.minimum((a + b).min(axis=1), INF)
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), INF)


def matrix(symbol: str) -> np.ndarray:
    """Cost from the state before a turn to the state behind it."""
    ins = np.full((4, 4), INF, dtype=np.int64)
    step = np.full((4, 4), INF, dtype=np.int64)
    for s in range(4):
        at, cost = s, 0
        for _ in range(4):                                   # more inserts come back to a state already reached
            ins[s, at] = min(ins[s, at], cost)
            at, cost = NEXT[at], cost + INSERT
        for _, cost, to, taken in MOVES[symbol][s]:
            if taken:
                step[s, to] = min(step[s, to], cost)
    return times(ins, step)


class Powers(dict):
    """(symbol, k) -> matrix of 2 ** k turns of the symbol."""

    def __missing__(self, key):
        symbol, k = key
        out = self[key] = matrix(symbol) if not k else times(self[symbol, k - 1], self[symbol, k - 1])
        return out

    def advance(self, symbol: str, length: int, v: np.ndarray) -> np.ndarray:
        """Costs before ``length`` turns of the symbol from those behind them
        (a vector, or the matrix of what follows)."""
        k = 0
        while length:
            if length & 1:
                v = times(self[symbol, k], v)
            length >>= 1
            k += 1
        return v


def runs(symbols: list) -> list:
    out: list = []
    for s in symbols:
        if out and out[-1][0] == s:
            out[-1][1] += 1
        else:
            out.append([s, 1])
    return out


def unroll(coded: list, after, state: int, powers: Powers):
    """Initials of the least of the cheapest audits of the runs when ``after``
    are the costs behind them, and the state it ends in."""
    after = np.asarray(after, dtype=np.int64)
    behind = [after]
    for symbol, length in reversed(coded):                   # costs at the start of every run
        behind.append(powers.advance(symbol, length, behind[-1]))
    behind.reverse()
    audit = []
    for r, (symbol, length) in enumerate(coded):
        left, step, options = [behind[r + 1].tolist()], powers[symbol, 0], MOVES[symbol]
        v, settled = behind[r + 1], 0
        for _ in range(length):                              # costs inside the run
            new = times(step, v)
            left.append(new.tolist())
            v = new
        at = length
        while at:
            here, there = left[at], left[at - 1]
            for initial, cost, to, taken in options[state]:
                if cost + (there if taken else here)[to] == here[state]:
                    audit.append(initial)
                    state, at = to, at - taken
                    break
    return "".join(audit), state


def finish(state: int) -> str:
    """Inserts that complete the conversation from a state."""
    return "I" * (END[state] // INSERT)


def repaired(rows, audit: str, state: int):
    """``role:text`` of the turns that stay or come in, in order."""
    out, at = [], iter(rows)
    for c in audit:
        if c == "I":
            state = NEXT[state]
            out.append(("user:" if state == 2 else "assistant:"))
            continue
        role, text = next(at)
        if c == "K":
            state = LEGAL[state, role[:1]]
            out.append(f"{role}:{text}")
        elif c == "R":
            state = NEXT[state]
            out.append(("user:" if state == 2 else "assistant:") + text)
    return out, state


# ---- turns and their faults -----------------------------------------------

def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, n`` after planted faults by the checksum of
    ``conv_id:turn``; ``n`` is 0 for a dropped turn, 2 for a repeated one."""
    blank = F.lit(" ")
    fault = F.crc32(F.concat(F.coalesce(F.col(conv).cast("string"), blank), F.lit(":"),
                             F.coalesce(F.col(turn).cast("string"), blank)).cast("binary")) % 20
    r, t = F.coalesce(F.col(role).cast("string"), blank), F.coalesce(F.col(text).cast("string"), blank)
    return rows.select(F.col(conv).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                       F.when(fault == 4, F.lit("user")).otherwise(r).alias("role"),
                       F.when(fault <= 1, F.lit("")).when(fault == 2, F.translate(t, ".!?", "")).otherwise(t).alias("text"),
                       F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("n"))


def body(text: str) -> str:
    return text.rstrip(" \t\n\v\f\r")


class Tally:
    """Counts of a conversation, or of consecutive turns of it; ``add`` joins
    what follows."""
    __slots__ = ("rows", "blank", "duplicate", "truncated", "illegal", "first", "last", "turns", "low", "high", "low_seen")

    def __init__(self):
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def turn(self, turn, initial):
        if self.rows:
            self.illegal += self.last + initial not in PAIRS
        else:
            self.first = initial
        self.last = initial
        self.rows += 1
        if turn is not None:
            if self.high is None or turn != self.high:       # turns come in order
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def add(self, o):
        if not o.rows:
            return
        if self.rows:
            self.illegal += self.last + o.first not in PAIRS
        else:
            self.first = o.first
        self.last = o.last
        self.illegal += o.illegal
        self.turns += o.turns - (self.high is not None and self.high == o.low)
        self.low = o.low if self.low is None else self.low
        self.high = self.high if o.high is None else o.high
        for f in ("rows", "blank", "duplicate", "truncated"):
            setattr(self, f, getattr(self, f) + getattr(o, f))

    @property
    def gaps(self):
        return 0 if self.low is None else min(self.high - self.low + 1 - self.turns, LONG)

    FIELDS = ("rows", "blank", "duplicate", "truncated", "illegal", "first", "last", "turns", "low", "high")

    def pack(self):
        return [getattr(self, f) for f in self.FIELDS]

    @classmethod
    def unpack(cls, values):
        t = cls()
        for f, v in zip(cls.FIELDS, values):
            setattr(t, f, v)
        return t


def coded(rows, fresh):
    """Runs and tally of turns (turn, role, text); ``fresh`` says of each turn
    whether its role and text are new in the conversation."""
    tally, symbols = Tally(), []
    for (turn, role, text), new in zip(rows, fresh):
        initial, core = role[:1], body(text)
        tally.turn(turn, initial)
        if not core:
            tally.blank += 1
            symbols.append("x")
        elif not new:
            tally.duplicate += 1
            symbols.append("x")
        else:
            s = initial if initial and initial in "sua" else "-"
            if core[-1] in ".!?":
                symbols.append(s)
            else:
                tally.truncated += 1
                symbols.append(s + "t")
    return runs(symbols), tally


def repair_rows(rows, powers: Powers):
    """Result columns of a whole conversation (turn, role, text)."""
    seen, fresh = set(), []
    for _, role, text in rows:
        fresh.append((role, text) not in seen)
        seen.add((role, text))
    code, tally = coded(rows, fresh)
    audit, state = unroll(code, END, 0, powers) if rows else ("", 0)
    cost = np.asarray(END)
    for symbol, length in reversed(code):
        cost = powers.advance(symbol, length, cost)
    audit += finish(state)
    out, _ = repaired([r[1:] for r in rows], audit, 0)
    digest = hashlib.sha256("\n".join(out).encode("utf-8", "surrogatepass")).hexdigest()
    return [tally.gaps, tally.blank, tally.duplicate, tally.truncated, tally.illegal, int(cost[0]), audit, digest]


# ---- distribution ---------------------------------------------------------

def _kind(role: str, text: str) -> str:
    """Symbol of a turn that is no duplicate."""
    return coded([(None, role, text)], [True])[0][0][0]


def pieces(rows: DataFrame) -> DataFrame:
    """Finished conversations (``block`` null), and blocks of the others."""
    import pyarrow as pa
    spark = rows.sparkSession
    kind = dict(rows.dtypes)["conv_id"]
    size = rows.select(F.sum(F.octet_length("text") + F.octet_length("role") + F.lit(16))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size // SIZE + 1))
    key = ["conv_id", "turn", "tie"]
    x = rows.withColumn("tie", F.md5(F.concat("role", F.lit(":"), "text").cast("binary"))).withColumn("spread", F.monotonically_increasing_id())
    x = x.repartitionByRange(ranges, *key, "spread").sortWithinPartitions(*key).select("conv_id", "turn", "role", "text", "n")
    ddl = (RESULT.format(kind=kind) + ", part int, block int, turns array<bigint>, roles array<string>, texts array<string>, "
           "kinds array<string>")

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        powers, number = Powers(), 0
        done, held, weight = [], [], 0                       # finished rows; turns of the open conversation
        conv, opened, long_ = None, 0, False                 # conversations opened so far
        schema = None

        def flush():
            nonlocal done
            cols = list(zip(*done))
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)
            done = []
            return out

        def block():
            nonlocal held, weight, number
            done.append([conv, *[None] * 8, part, number, [r[0] for r in held], [r[1] for r in held], [r[2] for r in held],
                         [_kind(r[1], r[2]) for r in held]])
            held, weight, number = [], 0, number + 1

        for b in batches:
            if schema is None:
                text = pa.list_(pa.string())
                longs = [pa.int64()] * 6
                schema = pa.schema([pa.field(n, t) for n, t in zip(
                    ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "part",
                     "block", "turns", "roles", "texts", "kinds"],
                    [b.schema.types[0], *longs, pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64()), text, text, text])])
            for c, turn, role, text_, n in zip(*(x.to_pylist() for x in b.columns)):
                if not opened or c != conv:
                    if opened:
                        if long_ or opened == 1:             # the first one may come from the task before
                            block()
                        else:
                            done.append([conv, *repair_rows(held, powers), *[None] * 6])
                            held, weight = [], 0
                    conv, opened, long_ = c, opened + 1, False
                for _ in range(n):
                    held.append((turn, role, text_))
                    weight += len(role) + len(text_)
                    if weight > BLOCK or len(held) >= BLOCK_ROWS:
                        block()
                        long_ = True
                        yield flush()
                if len(done) >= 2048:
                    yield flush()
        if opened:
            block()                                          # the last one may go on in the next task
            yield flush()

    return stash(x.mapInArrow(run, ddl), "turns")


AT = ["part", "block"]


def _fresh(blocks: DataFrame) -> DataFrame:
    """Positions in each block whose role and text occur in the conversation
    for the first time."""
    x = blocks.select("conv_id", *AT, F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "r"))
    text = F.concat(F.length("r.roles").cast("string"), F.lit(":"), "r.roles", "r.texts")
    place = F.shiftleft(F.col("part").cast("bigint"), 39) + F.shiftleft(F.col("block").cast("bigint"), 15) + F.col("pos")
    first = x.groupBy("conv_id", F.sha2(text.cast("binary"), 256).alias("k")).agg(F.min(place).alias("p"))
    first = first.select(F.shiftright("p", 39).cast("int").alias("part"),
                         F.shiftright("p", 15).bitwiseAND((1 << 24) - 1).cast("int").alias("block"),
                         F.col("p").bitwiseAND((1 << 15) - 1).cast("int").alias("pos"))
    return first.groupBy(*AT).agg(F.collect_list("pos").alias("fresh"))                # at most the turns of a block


def _coded(blocks: DataFrame) -> DataFrame:
    """Runs, matrix and tally of every block."""
    import json

    import pyarrow as pa
    x = blocks.select(*AT, "turns", F.transform("roles", lambda r: F.substring(r, 1, 1)).alias("initials"), "kinds")
    x = x.join(_fresh(blocks), AT, "left")

    def run(batches):
        powers = Powers()
        for b in batches:
            out = []
            for part, number, turns, initials, kinds, fresh in zip(*(c.to_pylist() for c in b.columns)):
                new, tally, symbols = set(fresh or ()), Tally(), []
                for i, (t, r, k) in enumerate(zip(turns, initials, kinds)):
                    tally.turn(t, r)
                    tally.blank += k == "x"
                    tally.duplicate += k != "x" and i not in new
                    tally.truncated += i in new and k.endswith("t")
                    symbols.append(k if i in new else "x")
                code = runs(symbols)
                m = np.where(np.eye(4) > 0, 0, INF).astype(np.int64)
                for s, length in reversed(code):
                    m = powers.advance(s, length, m)
                out.append([part, number, json.dumps(code), m.ravel().tolist(), json.dumps(tally.pack())])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.string()))], names=[*AT, "code", "matrix", "tally"])

    return x.mapInArrow(run, "part int, block int, code string, matrix array<bigint>, tally string")


def _walk(x: DataFrame, order: list, begin, step, column: str, out: str) -> DataFrame:
    """A state carried over the blocks of each conversation, in order: ``step``
    turns (state, value of ``column``) into the next one; a block gets the
    state before it, as the column ``out``."""
    import pyarrow as pa
    ddl = f"part int, block int, {out} " + ("array<bigint>" if isinstance(begin, list) else "int")
    types = [pa.int32(), pa.int32(), pa.list_(pa.int64()) if isinstance(begin, list) else pa.int32()]

    def run(batches):
        conv, state, any_ = None, None, False
        for b in batches:
            rows = []
            for c, part, number, value in zip(*(v.to_pylist() for v in b.columns)):
                if not any_ or c != conv:
                    conv, state, any_ = c, begin, True
                rows.append([part, number, state])
                state = step(state, value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[*AT, out])

    x = x.select("conv_id", *AT, column).repartition("conv_id").sortWithinPartitions("conv_id", *order)
    return x.mapInArrow(run, ddl)


def long_way(blocks: DataFrame, kind: str) -> DataFrame:
    """Result rows of the conversations that are cut into blocks."""
    import json

    import pyarrow as pa
    code = stash(_coded(blocks), "turns-code")
    ids = blocks.select("conv_id", *AT)

    def back(v, m):
        return times(np.array(m, dtype=np.int64).reshape(4, 4), np.array(v, dtype=np.int64)).tolist()

    after = _walk(ids.join(code, AT), [F.desc("part"), F.desc("block")], list(END), back, "matrix", "after")
    code = code.join(after, AT)

    def leave(batches):
        powers = Powers()
        for b in batches:
            out = []
            for part, number, c, v in zip(*(x.to_pylist() for x in b.columns)):
                out.append([part, number, [unroll(json.loads(c), v, s, powers)[1] for s in range(4)]])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.list_(pa.int32())))],
                                             names=[*AT, "leave"])

    code = stash(code, "turns-after")
    ends = code.select(*AT, "code", "after").mapInArrow(leave, "part int, block int, leave array<int>")
    enter = _walk(ids.join(ends, AT), [F.asc("part"), F.asc("block")], 0, lambda s, to: to[s], "leave", "enter")
    side = code.join(enter, AT)
    x = blocks.select("conv_id", *AT, "roles", "texts").join(side, AT)

    def rewrite(batches):
        powers = Powers()
        for b in batches:
            out = []
            for conv, part, number, roles, texts, c, m, tally, v, s in zip(*(x.to_pylist() for x in b.columns)):
                audit, _ = unroll(json.loads(c), v, s, powers)
                lines, end = repaired(list(zip(roles, texts)), audit, s)
                out.append([conv, part, number, audit, "\n".join(lines) if lines else None, end, back(v, m)[0], tally])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                b.schema.types[0], pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string()))],
                names=["conv_id", *AT, "audit", "lines", "end", "cost", "tally"])

    x = x.select("conv_id", *AT, "roles", "texts", "code", "matrix", "tally", "after", "enter")
    x = x.mapInArrow(rewrite, f"conv_id {kind}, part int, block int, audit string, lines string, end int, cost bigint, tally string")
    x = x.repartition("conv_id").sortWithinPartitions("conv_id", *AT)

    def gather(batches):
        conv, any_ = None, False
        total = digest = None
        audit, empty, cost, end = [], True, 0, 0

        def line(text):
            nonlocal empty
            digest.update((("" if empty else "\n") + text).encode("utf-8", "surrogatepass"))
            empty = False

        def close(kind_):
            tail = finish(end)
            audit.append(tail)
            out, _ = repaired([], tail, end)
            for t in out:
                line(t)
            row = [conv, total.gaps, total.blank, total.duplicate, total.truncated, total.illegal, cost, "".join(audit), digest.hexdigest()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [kind_, *[pa.int64()] * 6, pa.string(), pa.string()])],
                                              names=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                                     "repaired_sha256"])

        kind_ = None
        for b in batches:
            kind_ = b.schema.types[0]
            for i in range(b.num_rows):                      # block by block: a block's text is held once
                c, _, _, a, text, e, h, t = (col[i].as_py() for col in b.columns)
                if not any_ or c != conv:
                    if any_:
                        yield close(kind_)
                    conv, any_, total, digest, audit, empty, cost = c, True, Tally(), hashlib.sha256(), [], True, h
                audit.append(a)
                total.add(Tally.unpack(json.loads(t)))
                end = e
                if text is not None:
                    line(text)
        if any_:
            yield close(kind_)

    return x.mapInArrow(gather, RESULT.format(kind=kind))


def repair(rows: DataFrame) -> DataFrame:
    """One result row per conversation of ``conv_id, turn, role, text, n``
    (``n``: how often the turn stands there; 0 keeps the conversation only)."""
    kind = dict(rows.dtypes)["conv_id"]
    got = pieces(rows)
    names = [f.split()[0] for f in RESULT.split(", ")]
    return got.where("block is null").select(*names).unionByName(long_way(got.where("block is not null"), kind))


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair(damage(table(spark, sf_dir, "conversations")))
