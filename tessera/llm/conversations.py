"""Conversation structure repair by a grammar-compressed dynamic programme.

Every row becomes a symbol of its role and fault, so a conversation is a string. Re-Pair turns the pairs that are most
frequent over all conversations into rules, some pairs in each round. A symbol acts on the four states of the grammar
``(s?(ua)+)?`` as a min-plus matrix of (cost, audit); the audit of a rule is a rope of those of its two parts. Matrices
of rules are made bottom-up, once, and serve every conversation. Rows lie in ranges of (conversation, turn), cut into
chunks, so a conversation of any length spreads over tasks; what follows it through the chunks are one matrix each.

An audit of chunks has as many letters other than I as there are rows and ends in one, as inserts stand before the row
they precede. So no audit is a beginning of another of the same rows, and the least of two stays the least whatever
follows: (cost, audit) may be minimized chunk by chunk.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare
from tessera.session import checkpoint_dir

#: Rows of a chunk, and characters of their texts from which it is closed.
CHUNK_ROWS, CHUNK_CHARS = 256, 4 << 20
#: Rounds of Re-Pair, and rules of a round: they decide how much work is shared, not what comes out.
ROUNDS, ROUND_RULES = 6, 8
#: Strings of up to 16 symbols whose matrices a worker remembers.
KNOWN = 100_000

_INK = re.compile(r"[^\x20\x09-\x0D]")
_LAST = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")
#: Symbols: x must be deleted; s, u, a, o (another initial) are whole rows, capitals truncated ones.
FORCED = "x"

BEGIN, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = (USER, USER, ASSISTANT, USER)  # the state after an inserted row, or one with a new role
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_KEEPS = {("s", BEGIN): SYSTEM, ("u", BEGIN): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
#: Inserts with which a conversation can end, by state.
_CLOSE = {BEGIN: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

Rope = str | tuple
Matrix = list[list[tuple[int, Rope] | None]]


def spell(rope: Rope) -> str:
    out, todo = [], [rope]
    while todo:
        if isinstance(top := todo.pop(), str):
            out.append(top)
        else:
            todo += [top[1], top[0]]
    return "".join(out)


def _less(a: tuple[int, Rope], b: tuple[int, Rope] | None) -> bool:
    if b is None or a[0] != b[0]:
        return b is None or a[0] < b[0]
    return a[1] is not b[1] and spell(a[1]) < spell(b[1])


def terminal(symbol: str) -> Matrix:
    """Inserts and then the edit of one row, between any two states."""
    out: Matrix = [[None] * 4 for _ in range(4)]
    cut = int(symbol.isupper())
    for start in range(4):
        state = start
        for inserts in range(4):
            ways = [(3, "D", state)]
            if symbol != FORCED:
                ways.append((2 + cut, "R", _NEXT[state]))
                if (kept := _KEEPS.get((symbol.lower(), state))) is not None:
                    ways.append((cut, "K", kept))
            for cost, letter, to in ways:
                new = 2 * inserts + cost, "I" * inserts + letter
                if _less(new, out[start][to]):
                    out[start][to] = new
            state = _NEXT[state]
    return out


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product: first ``a``, then ``b``."""
    out: Matrix = [[None] * 4 for _ in range(4)]
    for p in range(4):
        for r, first in enumerate(a[p]):
            if first is not None:
                for q, second in enumerate(b[r]):
                    if second is not None and _less(new := (first[0] + second[0], (first[1], second[1])), out[p][q]):
                        out[p][q] = new
    return out


class Grammar:
    """Re-Pair rules, the matrix of each, and of the strings met so far."""

    def __init__(self):
        self.rules: list[tuple[str, str]] = []
        self.matrices = {s: terminal(s) for s in "xsuaoSUAO"}
        self.known: dict[str, tuple[list, list]] = {}

    def add(self, pair: str) -> None:
        """A rule for two symbols in a row; its matrix comes from those of its parts."""
        name = chr(0xE000 + len(self.rules))
        self.rules.append((pair, name))
        self.matrices[name] = times(self.matrices[pair[0]], self.matrices[pair[1]])

    def rewrite(self, text: str) -> str:
        for pair, name in self.rules:
            text = text.replace(pair, name)
        return text

    def matrix(self, symbols: str, repeat: int = 1) -> Matrix:
        parts = [self.matrices[s] for s in self.rewrite(symbols)]
        out = parts[0]
        for m in parts[1:]:
            out = times(out, m)
        power, out = out, None
        while repeat:  # squares
            if repeat & 1:
                out = power if out is None else times(out, power)
            power, repeat = times(power, power) if repeat > 1 else power, repeat >> 1
        return out

    def entries(self, symbols: str, repeat: int) -> tuple[list, list]:
        """Costs and audits of a string's matrix, row by row; those of short strings are remembered."""
        if repeat == 1 and symbols in self.known:
            return self.known[symbols]
        cells = [e for row in self.matrix(symbols, repeat) for e in row]
        out = [e and e[0] for e in cells], [e and spell(e[1]) for e in cells]
        if repeat == 1 and len(symbols) <= 16 and len(self.known) < KNOWN:
            self.known[symbols] = out
        return out


def learn(strings: DataFrame) -> Grammar:
    """Re-Pair over (symbols, count), all of them, in rounds.

    A round takes the most frequent pair, then further ones that share no symbol with those taken, so that rules of
    a round do not compete for a place. A round's pairs are at most the square of the symbols in use.
    """
    grammar = Grammar()
    for _ in range(ROUNDS):
        rules = list(grammar.rules)

        def count(batches: Iterator[pa.RecordBatch], rules=rules) -> Iterator[pa.RecordBatch]:
            for b in batches:
                text = "\n".join(b.column(0).to_pylist())
                lines = np.array([len(s) for s in b.column(0).to_pylist()])
                each = np.repeat(b.column(1).to_numpy(), lines + 1)[: len(text)]
                for pair, name in rules:
                    at = [m.start() for m in re.finditer(re.escape(pair), text)]
                    each = np.delete(each, np.array(at, np.int64) + 1)
                    text = text.replace(pair, name)
                code = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
                inside = (code[:-1] != 10) & (code[1:] != 10)
                pairs, place = np.unique((code[:-1] << 32 | code[1:])[inside], return_inverse=True)
                n = np.bincount(place, each[:-1][inside], len(pairs)).astype(np.int64)
                names = [chr(p >> 32) + chr(p & 0xFFFFFFFF) for p in pairs.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(n)], names=["pair", "n"])

        counted = strings.mapInArrow(count, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1").collect()
        used: set[str] = set()
        for r in sorted(counted, key=lambda r: (-r["n"], r["pair"])):
            if not used & set(r["pair"]) and len(grammar.rules) - len(rules) < ROUND_RULES:
                used |= set(r["pair"])
                grammar.add(r["pair"])
        if len(grammar.rules) == len(rules):
            break
    return grammar


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows with the faults of the exercise put in; nulls are one space."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return rows.select("conv_id", "turn", "role", "text", kind.alias("kind")).where("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def counted(rows: DataFrame) -> DataFrame:
    """Equal rows of a conversation as one with their number, and whether role and text were seen at an earlier turn."""
    made = _written(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "conversations")
    by = ["conv_id", "role", F.sha2("text", 256).alias("digest")]
    place = F.struct(F.col("turn").isNotNull().alias("some"), F.coalesce("turn", F.lit(0)).alias("turn"))
    seen = made.groupBy(*by).agg(F.min(place).alias("first"), F.count("*").alias("turns")).where("turns > 1")
    m, s = made.withColumn("digest", F.sha2("text", 256)).alias("m"), seen.alias("s")
    same = F.col("m.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("m.role") == F.col("s.role")) & (F.col("m.digest") == F.col("s.digest"))
    later = F.coalesce(F.struct(F.col("m.turn").isNotNull(), F.coalesce("m.turn", F.lit(0))) > F.col("s.first"), F.lit(False))
    return m.join(s, same, "left").select("m.conv_id", "m.turn", "m.role", "m.text", "copies", later.alias("seen"))


class _Chunk:
    """Rows in a row of one conversation."""

    def __init__(self, conv):
        self.conv, self.symbols, self.roles, self.texts, self.chars, self.repeat = conv, [], [], [], 0, 1
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = None
        self.first_turn = self.last_turn = None

    def row(self, turn, role: str, text: str, copies: int, symbol: str, fault: str, repeat: int = 1) -> None:
        """``copies`` equal rows, the first of which is ``symbol``; the others are deleted ones."""
        self.symbols.append(symbol + FORCED * (copies // repeat - 1))
        kept = symbol != FORCED
        self.roles += [role if kept else None] + [None] * (copies // repeat - 1)
        self.texts += [text if kept else None] + [None] * (copies // repeat - 1)
        self.chars += len(text)
        self.repeat = repeat
        self.blank += copies if fault == "blank" else 0
        self.duplicate += 0 if fault == "blank" else copies if fault == "duplicate" else copies - 1
        self.truncated += fault == "truncated"
        initial = role[:1]
        self.illegal += copies - 1
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.last = initial
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn


_STATS = ["blank", "duplicate", "truncated", "illegal", "turns", "first", "last", "first_turn", "last_turn"]


def chunks(rows: DataFrame) -> DataFrame:
    """Rows in order, in chunks numbered (part, seq); equal rows beyond a chunk are a chunk that repeats a symbol."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, part int, seq bigint, symbols string, repeat bigint, roles array<string>, texts array<string>, blank bigint, "
        "duplicate bigint, truncated bigint, illegal bigint, turns bigint, first string, last string, first_turn bigint, last_turn bigint"
    )
    from pyspark.sql.conversion import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, chars, now = TaskContext.get().partitionId(), 0, [], 0, None

        def close(c: _Chunk | None) -> None:
            nonlocal seq, chars
            if c is not None and c.symbols:
                held.append([c.conv, part, seq, "".join(c.symbols), c.repeat, c.roles, c.texts, *[getattr(c, k) for k in _STATS]])
                seq, chars = seq + 1, chars + c.chars

        def batch() -> pa.RecordBatch:
            nonlocal chars
            out = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), arrow)], schema=arrow)
            held.clear()
            chars = 0
            return out

        for b in batches:
            for conv, turn, role, text, copies, seen in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or conv != now.conv or len(now.roles) >= CHUNK_ROWS or now.chars >= CHUNK_CHARS:
                    close(now)
                    now = _Chunk(conv)
                ink = _LAST.search(text) if _INK.search(text) else None
                fault = "blank" if ink is None else "duplicate" if seen else "truncated" if ink[1] not in ".!?" else ""
                initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
                symbol = FORCED if fault in ("blank", "duplicate") else initial.upper() if fault else initial
                more = copies - 1 if copies > CHUNK_ROWS else 0
                now.row(turn, role, text, copies - more, symbol, fault)
                if more:
                    close(now)
                    now = _Chunk(conv)
                    now.row(turn, role, text, more, FORCED, "blank" if fault == "blank" else "duplicate", more)
                    close(now)
                    now = _Chunk(conv)
                if len(held) >= 1000 or chars >= CHUNK_CHARS:
                    yield batch()
        close(now)
        if held:
            yield batch()

    order = ["conv_id", "turn", "role", "text"]
    ranged = rows.repartitionByRange("conv_id", "turn", "role", F.xxhash64("text"))
    return ranged.sortWithinPartitions(*order).select(*order, "copies", "seen").mapInArrow(each, schema)


def matrices(made: DataFrame, grammar: Grammar) -> DataFrame:
    """The matrix of each chunk: costs and audits from state to state, row by row."""
    shared = made.sparkSession.sparkContext.broadcast(grammar)
    kind = made.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "part", "seq", "symbols", "repeat", *_STATS]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shared.value.entries(s, n) for s, n in zip(b.column(3).to_pylist(), b.column(4).to_pylist())]
            costs, audits = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], *b.columns[5:], pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))],
                names=[*names[:3], *_STATS, "costs", "audits"],
            )

    return made.select(*names).mapInArrow(
        each,
        f"conv_id {kind}, part int, seq bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, "
        "first string, last string, first_turn bigint, last_turn bigint, costs array<bigint>, audits array<string>",
    )


class _Path:
    """The cheapest audits of a conversation up to a chunk, by state, as lists of pieces linked backwards."""

    def __init__(self):
        self.best: list[tuple[int, tuple | None] | None] = [(0, None), None, None, None]

    @staticmethod
    def _first(a: tuple, b: tuple) -> bool:
        """Whether the pieces of ``a`` come before those of ``b``; both have as many."""
        left, right = [], []
        while a is not b:
            left.append(a[1])
            right.append(b[1])
            a, b = a[0], b[0]
        return "".join(reversed(left)) < "".join(reversed(right))

    def step(self, costs: list, audits: list) -> None:
        new: list = [None] * 4
        for p, sofar in enumerate(self.best):
            for q in range(4):
                if sofar is None or costs[4 * p + q] is None:
                    continue
                cost, node = sofar[0] + costs[4 * p + q], (sofar[1], audits[4 * p + q], p)
                if new[q] is None or cost < new[q][0] or cost == new[q][0] and self._first(node, new[q][1]):
                    new[q] = cost, node
        self.best = new

    def end(self) -> tuple[int, list[tuple[str, int]]]:
        """The cost, and of each chunk the audit and the state before it."""
        ends = [(b[0] + 2 * len(_CLOSE[q]), (b[1], _CLOSE[q], q)) for q, b in enumerate(self.best) if b is not None]
        best = ends[0]
        for e in ends[1:]:
            if e[0] < best[0] or e[0] == best[0] and self._first(e[1], best[1]):
                best = e
        node, pieces = best[1][0], []
        while node is not None:
            pieces.append([node[1], node[2]])
            node = node[0]
        pieces[0][0] += best[1][1]
        return best[0], [tuple(p) for p in reversed(pieces)]


def _by_conversation(df: DataFrame) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")


def paths(mats: DataFrame) -> DataFrame:
    """Of each chunk its piece of the cheapest audit and the state before it; with the last one, the sums."""
    kind = mats.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, part int, seq bigint, piece string, state int, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
        "illegal bigint, cost bigint"
    )
    from pyspark.sql.conversion import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, places, path, sums, last = [], None, [], _Path(), None, None

        def close() -> None:
            nonlocal places, path, sums, last
            if places:
                cost, pieces = path.end()
                span = 0 if sums["low"] is None else sums["high"] - sums["low"] + 1 - sums["turns"]
                for k, ((part, seq), (piece, state)) in enumerate(zip(places, pieces)):
                    ends = k + 1 == len(places)
                    out.append([conv, part, seq, piece, state, *([span, sums["blank"], sums["duplicate"], sums["truncated"], sums["illegal"], cost] if ends else [None] * 6)])
            places, path, last = [], _Path(), None
            sums = {"low": None, "high": None, **dict.fromkeys(_STATS[:5], 0)}

        close()
        for b in batches:
            for r in b.to_pylist():
                if places and r["conv_id"] != conv:
                    close()
                conv = r["conv_id"]
                places.append((r["part"], r["seq"]))
                for k in _STATS[:5]:
                    sums[k] += r[k]
                if last is not None:
                    sums["illegal"] += last + r["first"] not in ("su", "ua", "au")
                last = r["last"]
                if r["first_turn"] is not None:
                    sums["turns"] -= r["first_turn"] == sums["high"]
                    sums["low"] = r["first_turn"] if sums["low"] is None else sums["low"]
                    sums["high"] = r["last_turn"]
                path.step(r["costs"], r["audits"])
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), arrow)], schema=arrow)
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), arrow)], schema=arrow)

    return _by_conversation(mats).mapInArrow(each, schema)


def apply_edits(piece: str, state: int, roles: list, texts: list) -> list[str]:
    """The repaired ``role:text`` of a chunk's rows under its piece of an audit."""
    out, row = [], 0
    for letter in piece:
        if letter == "I":
            state = _NEXT[state]
            out.append(f"{_NAMES[state]}:")
            continue
        if letter == "K":
            state = _KEEPS[roles[row][:1], state]
            out.append(f"{roles[row]}:{texts[row]}")
        elif letter == "R":
            state = _NEXT[state]
            out.append(f"{_NAMES[state]}:{texts[row]}")
        row += 1
    return out


def edited(made: DataFrame, found: DataFrame) -> DataFrame:
    """Chunks with their repaired lines."""
    kind = made.schema["conv_id"].dataType.simpleString()
    both = found.join(made.select("part", "seq", "roles", "texts", "repeat"), ["part", "seq"])
    sums = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    names = ["conv_id", "part", "seq", "piece", *sums]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = []
            for piece, state, roles, texts, repeat in zip(*(b.column(k).to_pylist() for k in ("piece", "state", "roles", "texts", "repeat"))):
                lines.append(apply_edits(piece, state, roles, texts) if repeat == 1 else apply_edits(piece, state, [], []))
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in names], pa.array(lines, pa.list_(pa.string()))], names=[*names, "lines"])

    return both.mapInArrow(each, f"conv_id {kind}, part int, seq bigint, piece string, {', '.join(f'{s} bigint' for s in sums)}, lines array<string>")


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation; a digest runs over a conversation's chunks in order, one chunk in memory at a time."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    sums = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    names = ["conv_id", *sums, "audit", "repaired_sha256"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, digest, lines = [], hashlib.sha256(), False
        for b in batches:
            out = []
            for r in b.to_pylist():
                audit.append(r["piece"])
                if r["lines"]:
                    digest.update((("\n" if lines else "") + "\n".join(r["lines"])).encode())
                    lines = True
                if r["cost"] is not None:  # the last chunk
                    out.append([r["conv_id"], *[r[s] for s in sums], "".join(audit), digest.hexdigest()])
                    audit, digest, lines = [], hashlib.sha256(), False
            types = [b.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)], names=names)

    return _by_conversation(repaired).select("conv_id", "piece", "lines", *sums).mapInArrow(
        each, f"conv_id {kind}, {', '.join(f'{s} bigint' for s in sums)}, audit string, repaired_sha256 string"
    )


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cheapest edits and the digest of the repaired text, a row for each ``conv_id`` of ``rows``.

    ``rows`` are (conv_id, turn, role, text) of conversations as they are; ``repair_damaged`` puts faults in first.

    * Null role or text: one space, so such a text is blank and such a role has to be changed or deleted.
    * Null ``turn``: before all others, counted in no gap. Null ``conv_id``: a conversation of its own.
    * Rows of one turn: by role, then text. Equal rows: all but the first are duplicates, whatever their number.
    * An empty role has no initial, so it cannot be kept.
    * Very long texts are read whole; a chunk is closed once it has ``CHUNK_CHARS`` characters.
    * An empty table gives no rows; other columns are not read, whatever their names.
    """
    space = F.lit(" ")
    whole = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), F.lit(1).cast("bigint").alias("copies"))
    return _repaired(whole, rows.select("conv_id"))


def repair_damaged(rows: DataFrame) -> DataFrame:
    """``repair`` of rows with faults put in (``damage``), for every ``conv_id`` of ``rows``.

    A conversation without rows after that has zeros, an empty audit and the digest of the empty string.
    """
    return _repaired(damage(rows), rows.select("conv_id"))


def _repaired(rows: DataFrame, ids: DataFrame) -> DataFrame:
    prepare(rows.sparkSession)
    made = _written(chunks(counted(rows)), "chunks")
    strings = made.where("repeat = 1").groupBy("symbols").count()
    found = _written(paths(matrices(made, learn(_written(strings, "symbols")))), "paths")
    done = digests(edited(made, found)).alias("d")
    ids = ids.distinct().alias("i")
    sums = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(done, F.col("i.conv_id").eqNullSafe(F.col("d.conv_id")), "left").select(
        "i.conv_id",
        *[F.coalesce(f"d.{s}", F.lit(0).cast("bigint")).alias(s) for s in sums],
        F.coalesce("d.audit", F.lit("")).alias("audit"),
        F.coalesce("d.repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


_ORACLE = r"""
WITH RECURSIVE
bits(v, value, left_bits) AS (
  SELECT range, range, 8 FROM range(256)
  UNION ALL
  SELECT v, xor(value >> 1, 3988292384 * (value & 1)), left_bits - 1 FROM bits WHERE left_bits > 0),
crc_table AS (SELECT list(value ORDER BY v) AS steps FROM bits WHERE left_bits = 0),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(range(1, length(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')) + 1),
      lambda i: CAST(ascii(substr(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), i, 1)) AS BIGINT)) AS bytes
  FROM conversations),
kinds AS (
  SELECT conv_id, turn, role, text,
    xor(list_reduce(bytes, lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS kind
  FROM keyed, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds WHERE kind <> 0),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place FROM damaged),
faulty AS (
  SELECT *, left(role, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY place) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
sums AS (
  SELECT conv, any_value(conv_id) AS conv_id, max(place) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(initial) OVER (PARTITION BY conv ORDER BY place) AS before FROM faulty) GROUP BY conv),
inserts(state, letters, reached, lines) AS (VALUES
  (0, '', 0, []::VARCHAR[]), (0, 'I', 2, ['user:']), (0, 'II', 3, ['user:', 'assistant:']), (0, 'III', 2, ['user:', 'assistant:', 'user:']),
  (1, '', 1, []), (1, 'I', 2, ['user:']), (1, 'II', 3, ['user:', 'assistant:']), (1, 'III', 2, ['user:', 'assistant:', 'user:']),
  (2, '', 2, []), (2, 'I', 3, ['assistant:']), (2, 'II', 2, ['assistant:', 'user:']), (2, 'III', 3, ['assistant:', 'user:', 'assistant:']),
  (3, '', 3, []), (3, 'I', 2, ['user:']), (3, 'II', 3, ['user:', 'assistant:']), (3, 'III', 2, ['user:', 'assistant:', 'user:'])),
edits(letter, initial, state, next, price) AS (VALUES
  ('K', 's', 0, 1, 0), ('K', 'u', 0, 2, 0), ('K', 'u', 1, 2, 0), ('K', 'u', 3, 2, 0), ('K', 'a', 2, 3, 0),
  ('R', NULL, 0, 2, 2), ('R', NULL, 1, 2, 2), ('R', NULL, 2, 3, 2), ('R', NULL, 3, 2, 2),
  ('D', NULL, 0, 0, 3), ('D', NULL, 1, 1, 3), ('D', NULL, 2, 2, 3), ('D', NULL, 3, 3, 3)),
best(conv, place, state, way) AS (
  SELECT conv, CAST(0 AS BIGINT), 0, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': []::VARCHAR[]} FROM sums
  UNION ALL
  SELECT b.conv, f.place, e.next, min({
    'cost': CAST(b.way.cost + 2 * length(i.letters) + e.price + CASE WHEN f.fault = 'truncated' AND e.letter <> 'D' THEN 1 ELSE 0 END AS BIGINT),
    'audit': b.way.audit || i.letters || e.letter,
    'lines': list_concat(list_concat(b.way.lines, i.lines), CASE e.letter WHEN 'K' THEN [f.role || ':' || f.text]
      WHEN 'R' THEN [CASE e.next WHEN 2 THEN 'user:' ELSE 'assistant:' END || f.text] ELSE []::VARCHAR[] END)})
  FROM best b JOIN faulty f ON f.conv = b.conv AND f.place = b.place + 1 JOIN inserts i ON i.state = b.state
    JOIN edits e ON e.state = i.reached AND coalesce(e.initial, f.initial) = f.initial
      AND (e.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
  GROUP BY b.conv, f.place, e.next),
ends AS (
  SELECT conv, min({'cost': CAST(way.cost + 2 * length(letters) AS BIGINT), 'audit': way.audit || letters, 'lines': list_concat(way.lines, inserts.lines)}) AS way
  FROM best JOIN sums USING (conv) JOIN inserts ON inserts.state = best.state WHERE place = n AND reached IN (0, 3) GROUP BY conv)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0) AS cost, coalesce(way.audit, '') AS audit,
  sha256(coalesce(array_to_string(way.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN (sums JOIN ends USING (conv)) s ON i.conv_id IS NOT DISTINCT FROM s.conv_id
"""


def oracle_sql() -> str:
    """The programme row by row, in a recursive query."""
    return _ORACLE
