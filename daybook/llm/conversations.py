"""Faults of conversations, and the cheapest repair of their turn structure.

A conversation's rows are taken by turn (null turns first, equal turns by their
``role:text`` line). The first fault of a row counts: *blank* (nothing but white
space), *duplicate* (role and text seen earlier), *truncated* (the last
character that is not white space does not end a sentence). A repair keeps,
re-roles or deletes each row and inserts empty rows anywhere, so that the roles'
initials read ``(s?(ua)+)?``; blank and duplicate rows must go. The cheapest
repair wins, of equally cheap ones that with the ASCII-least audit, the string
of the edits' initials.

Method: a dynamic program over the rows with four states (nothing yet, a system
row, a user row, an assistant row last). Audits are linked nodes that share
their prefixes; each knows its ancestors at powers of two and a rolling hash of
the string it ends. A tie is decided at the first character after the longest
common prefix, searched by hashes; equal strings are one node, so what the
hashes say is checked by comparing nodes.

Rows are dealt by ranges of (conversation, turn, line), so a conversation of any
length is spread over tasks. Each task solves the conversations that lie within
it. Of one that may reach beyond, it gives the cheapest audit between every pair
of states; these are joined end to end, and the rows of such a conversation are
then read once more, in order, for their digest. SHA-256 of one value is
sequential by nature; that pass holds one row and the audit at a time.

Null roles and texts count as one space; a null conversation id is a
conversation of its own. Equal rows are counted before they are dealt; all but
the first are duplicates. An empty table gives an empty result. The audit is
one value, which bounds a conversation to 2 GB of edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.rows import column
from daybook.workspace import materialize

REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = frozenset({"su", "ua", "au"})
# Inserts between rows: (from, to, how many). More than these never pay.
_INSERTS = (
    *((s, s, 0) for s in STATES),
    (START, USER, 1), (START, ASSISTANT, 2), (SYSTEM, USER, 1), (SYSTEM, ASSISTANT, 2),
    (USER, ASSISTANT, 1), (ASSISTANT, USER, 1),
)
# What may follow: the state before and after an accepted initial.
_ACCEPT = {"s": ((START, SYSTEM),), "u": ((START, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
ENDS = ((START, ""), (ASSISTANT, ""), (USER, "I"), (SYSTEM, "II"))
_MOD, _BASE = (1 << 61) - 1, 911_382_323
_NULL = " "


def last_character(text: str) -> str:
    """The last character that is not white space; empty without one."""
    stripped = text.rstrip("\x20\t\n\x0b\x0c\r")
    return stripped[-1:]


def edits_of(initial: str, fault: str) -> dict[int, list[tuple[int, int, str]]]:
    """For each state after a row: (state before, cost, edits) of the best ways there."""
    best: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(before: int, after: int, cost: int, edits: str) -> None:
        if (cost, edits) < best.get((before, after), (1 << 60, "")):
            best[before, after] = (cost, edits)

    more = CUT if fault == "truncated" else 0
    for before, mid, n in _INSERTS:
        offer(before, mid, n * INSERT + DELETE, "I" * n + "D")
        if fault in ("blank", "duplicate"):
            continue
        for at, after in _ACCEPT.get(initial, ()):
            if at == mid:
                offer(before, after, n * INSERT + more, "I" * n + "K")
        for role in "ua":
            for at, after in _ACCEPT[role]:
                if at == mid:
                    offer(before, after, n * INSERT + REROLE + more, "I" * n + "R")
    ways: dict[int, list[tuple[int, int, str]]] = {s: [] for s in STATES}
    for (before, after), (cost, edits) in best.items():
        ways[after].append((before, cost, edits))
    return ways


class Audits:
    """Strings of edits as linked nodes; node 0 is the empty one."""

    def __init__(self) -> None:
        self.char, self.depth, self.hash, self.up = [""], [0], [0], [[]]
        self._next: dict[tuple[int, str], int] = {}

    def add(self, node: int, edits: str) -> int:
        for c in edits:
            found = self._next.get((node, c))
            if found is None:
                found = self._next[node, c] = len(self.char)
                up = [node]
                while len(self.up[up[-1]]) >= len(up):
                    up.append(self.up[up[-1]][len(up) - 1])
                self.char.append(c)
                self.depth.append(self.depth[node] + 1)
                self.hash.append((self.hash[node] * _BASE + ord(c)) % _MOD)
                self.up.append(up)
            node = found
        return node

    def _ancestor(self, node: int, depth: int) -> int:
        drop = self.depth[node] - depth
        while drop:
            j = drop.bit_length() - 1
            node = self.up[node][j]
            drop -= 1 << j
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether the string of `a` comes before that of `b`."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._ancestor(a, depth), self._ancestor(b, depth)
        if x == y:
            return self.depth[a] < self.depth[b]
        first = self._parting(x, y, self.hash)
        if self.up[first[0]][0] != self.up[first[1]][0]:  # a hash deceived; nodes do not
            first = self._parting(x, y, range(len(self.char)))
        return self.char[first[0]] < self.char[first[1]]

    def _parting(self, x: int, y: int, key) -> tuple[int, int]:
        """The first nodes in which two different strings of equal length differ, as `key` tells."""
        for j in range(len(self.up[x]) - 1, -1, -1):
            if j < len(self.up[x]) and key[self.up[x][j]] != key[self.up[y][j]]:
                x, y = self.up[x][j], self.up[y][j]
        return x, y

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.char[node])
            node = self.up[node][0]
        return "".join(reversed(out))


_ways: dict[tuple[str, str], dict[int, list[tuple[int, int, str]]]] = {}


def solve(kinds: Iterable[tuple[str, str]], start: int = START) -> list[tuple[int, str] | None]:
    """Cost and audit of the best way from `start` to each state; (initial, fault) of each row."""
    audits = Audits()
    now: list[tuple[int, int] | None] = [None] * len(STATES)
    now[start] = (0, 0)
    for kind in kinds:
        ways = _ways.get(kind)
        if ways is None:
            ways = _ways[kind] = edits_of(*kind)
        then: list[tuple[int, int] | None] = []
        for after in STATES:
            cost, node = None, -1
            for before, more, edits in ways[after]:
                if now[before] is None:
                    continue
                total = now[before][0] + more
                if cost is None or total < cost:
                    cost, node = total, audits.add(now[before][1], edits)
                elif total == cost:
                    other = audits.add(now[before][1], edits)
                    if audits.less(other, node):
                        node = other
            then.append(None if cost is None else (cost, node))
        now = then
    return [None if found is None else (found[0], audits.text(found[1])) for found in now]


def finish(found: list[tuple[int, str] | None]) -> tuple[int, str]:
    """Cost and audit with the inserts at the end."""
    return min((found[s][0] + INSERT * len(more), found[s][1] + more) for s, more in ENDS if found[s] is not None)


class Repaired:
    """Digest of a repaired conversation, row by row."""

    def __init__(self, audit: str) -> None:
        self._audit, self._at, self._last, self._digest = audit, 0, START, hashlib.sha256()
        self._written = 0

    def _write(self, role: str, text: str, state: int) -> None:
        line = f"{role}:{text}"
        self._digest.update((("\n" if self._written else "") + line).encode("utf-8", "surrogatepass"))
        self._written, self._last = 1, state

    def _other(self) -> int:
        return ASSISTANT if self._last == USER else USER

    def _inserts(self) -> None:
        while self._audit[self._at : self._at + 1] == "I":
            self._write(NAMES[self._other()], "", self._other())
            self._at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self._audit[self._at]
        self._at += 1
        if edit == "R":
            self._write(NAMES[self._other()], text, self._other())
        elif edit == "K":
            self._write(role, text, {"s": SYSTEM, "u": USER}.get(role[0], ASSISTANT))

    def end(self) -> str:
        self._inserts()
        return self._digest.hexdigest()


COUNTS = ("blank", "duplicate", "truncated", "illegal")
_PART = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("edge", T.BooleanType()),
        *(T.StructField(c, T.LongType()) for c in COUNTS),
        *(T.StructField(c, T.LongType()) for c in ("least_turn", "most_turn", "turns", "cost")),
        T.StructField("audit", T.StringType()),
        T.StructField("repaired_sha256", T.StringType()),
        T.StructField("first_initial", T.StringType()),
        T.StructField("last_initial", T.StringType()),
        T.StructField("costs", T.ArrayType(T.LongType())),
        T.StructField("audits", T.ArrayType(T.StringType())),
    ]
)


class Part:
    """The rows of a conversation that one task has."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.rows: list[tuple[str, str, str]] = []  # role, text, fault
        self.counts = dict.fromkeys(COUNTS, 0)
        self.least = self.most = self.turn = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, copies: int, first: bool) -> None:
        if copies and turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.most = self.turn = turn
            self.turns += 1
        for n in range(copies):
            end = last_character(text)
            fault = (
                "blank" if not end
                else "duplicate" if n or not first
                else "truncated" if end not in ".!?"
                else ""
            )
            if fault:
                self.counts[fault] += 1
            if self.rows and self.rows[-1][0][:1] + role[:1] not in LEGAL:
                self.counts["illegal"] += 1
            self.rows.append((role, text, fault))

    def result(self, part: int, edge: bool) -> dict:
        kinds = [(role[:1], fault) for role, _, fault in self.rows]
        between = [solve(kinds, s) for s in (STATES if edge else (START,))]
        cost, audit = finish(between[0])
        repaired = Repaired(audit)
        for role, text, _ in self.rows:
            repaired.row(role, text)
        ends = [found for row in between for found in row] if edge else None
        return {
            "conv_id": self.conv, "part": part, "edge": edge, **self.counts,
            "least_turn": self.least, "most_turn": self.most, "turns": self.turns,
            "cost": cost, "audit": audit, "repaired_sha256": repaired.end(),
            "first_initial": self.rows[0][0][:1] if self.rows else None,
            "last_initial": self.rows[-1][0][:1] if self.rows else None,
            "costs": ends and [None if e is None else e[0] for e in ends],
            "audits": ends and [None if e is None else e[1] for e in ends],
        }


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in range(batch.num_columns)))


def _solve_parts(schema: pa.Schema):
    """Solve the conversations of a task; the first and the last may reach beyond it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        done: list[dict] = []
        size, now, first = 0, None, True
        for conv, turn, role, line, copies, is_first in _rows(batches):
            if now is None or conv != now.conv:
                if now is not None:
                    done.append(now.result(number, first))
                    first = False
                    size += len(now.rows)
                    if size > 20_000:
                        yield pa.RecordBatch.from_pylist(done, schema)
                        done, size = [], 0
                now = Part(conv)
            now.add(turn, role, line[len(role) + 1 :], copies, is_first)
        if now is not None:
            done.append(now.result(number, True))
        yield pa.RecordBatch.from_pylist(done, schema)

    return run


def join_parts(parts: list[dict]) -> dict:
    """The parts of one conversation, in order, end to end."""
    counts = {c: sum(p[c] for p in parts) for c in COUNTS}
    turns, last_turn, last_initial = 0, None, None
    told: list[str] = []
    now: list[tuple[int, str] | None] = [(0, ""), None, None, None]
    for p in parts:
        if p["first_initial"] is not None:
            if last_initial is not None and last_initial + p["first_initial"] not in LEGAL:
                counts["illegal"] += 1
            last_initial = p["last_initial"]
        if p["turns"]:
            turns += p["turns"] - (last_turn == p["least_turn"])
            last_turn = p["most_turn"]
        ways = list(zip(p["costs"], p["audits"]))
        now = [
            min(
                (
                    (now[s][0] + ways[len(STATES) * s + t][0], now[s][1] + ways[len(STATES) * s + t][1])
                    for s in STATES
                    if now[s] is not None and ways[len(STATES) * s + t][0] is not None
                ),
                default=None,
            )
            for t in STATES
        ]
        # What all of them begin with is settled.
        same = len(commonprefix([found[1] for found in now if found is not None]))
        told.append(next(found[1][:same] for found in now if found is not None))
        now = [None if found is None else (found[0], found[1][same:]) for found in now]
    cost, rest = finish(now)
    seen = [p for p in parts if p["turns"]]
    return {
        **counts, "cost": cost, "audit": "".join([*told, rest]), "turns": turns,
        "least_turn": seen[0]["least_turn"] if seen else None, "most_turn": seen[-1]["most_turn"] if seen else None,
    }


def _digests(schema: pa.Schema):
    """Digest of each conversation from rows in order, its audit before them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found = None, {"conv_id": [], "repaired_sha256": []}

        def close() -> None:
            if now is not None:
                found["conv_id"].append(now[0])
                found["repaired_sha256"].append(now[1].end())

        for conv, is_row, _, role, line, copies in _rows(batches):
            if not is_row:
                close()
                now = (conv, Repaired(line))
            else:
                for _ in range(copies):
                    now[1].row(role, line[len(role) + 1 :])
        close()
        yield pa.RecordBatch.from_pydict(found, schema)

    return run


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _prepared(rows: DataFrame) -> DataFrame:
    """Equal rows once, with their number and whether their text is new there."""
    line = F.concat("role", F.lit(":"), "text")
    mark = F.sha2(F.concat(F.octet_length("role").cast("string"), line), 256)
    once = (
        rows.withColumn("line", line)
        .withColumn("mark", mark)
        .groupBy("conv_id", "turn", "role", "mark", "present")
        .agg(F.any_value("line").alias("line"), F.count("*").alias("n"))
    )
    once = materialize(once.withColumn("copies", F.when(F.col("present"), F.col("n")).otherwise(F.lit(0))).drop("n"), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    earliest = (
        once.where("present")
        .groupBy(F.col("conv_id").alias("c"), F.col("mark").alias("m"))
        .agg(F.min(place).alias("earliest"))
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("mark") == F.col("m"))
    return once.join(earliest, same, "left").select(
        "conv_id", "turn", "role", "line", "copies", F.coalesce(F.col("earliest") == place, F.lit(True)).alias("first")
    )


def repair(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
) -> DataFrame:
    """One row per conversation.

    Returns `conv_id`, `gaps` (missing turn numbers), the counts `blank`,
    `duplicate`, `truncated` and `illegal` (neighbouring roles out of order),
    `cost`, `audit` and `repaired_sha256` over the repaired ``role:text`` lines.
    Rows that are not `present` only name their conversation.
    """
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    kept = lambda c, other: F.when(F.col("present"), c).otherwise(other)
    plain = rows.select(
        column(conv_col).alias("conv_id"),
        column(turn_col).cast("long").alias("turn"),
        F.coalesce(column(role_col).cast("string"), F.lit(_NULL)).alias("role"),
        F.coalesce(column(text_col).cast("string"), F.lit(_NULL)).alias("text"),
        here.alias("present"),
    ).select(
        "conv_id", kept(F.col("turn"), F.lit(None)).alias("turn"), kept(F.col("role"), F.lit("")).alias("role"),
        kept(F.col("text"), F.lit("")).alias("text"), "present",
    )
    ready = _prepared(plain)
    ordered = ready.repartitionByRange("conv_id", "turn", F.substring("line", 1, 64)).sortWithinPartitions(
        "conv_id", "turn", "line"
    )
    schema = T.StructType([ready.schema["conv_id"], *_PART])
    parts = materialize(ordered.mapInArrow(_solve_parts(_arrow(schema)), schema), "conversation-parts")
    out = ["conv_id", *COUNTS, "least_turn", "most_turn", "turns", "cost", "audit", "repaired_sha256"]
    whole = parts.where(~F.col("edge")).select(*out)

    # At most two conversations of a task may reach beyond it.
    edges = parts.where("edge")
    split = edges.groupBy("conv_id").agg(F.count("*").alias("n"))
    alone = split.where("n = 1").select(F.col("conv_id").alias("c"))
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    whole = whole.unionByName(edges.join(alone, same, "left_semi").select(*out))
    spread = split.where("n > 1").select(F.col("conv_id").alias("c"))
    joined_schema = T.StructType([schema["conv_id"], *(schema[c] for c in out[1:-1])])

    def together(parts: pa.Table) -> pa.Table:
        found = join_parts(parts.sort_by("part").to_pylist())
        return pa.Table.from_pylist([{"conv_id": parts["conv_id"][0].as_py(), **found}], _arrow(joined_schema))

    joined = edges.join(spread, same, "left_semi").groupBy("conv_id").applyInArrow(together, joined_schema)
    joined = materialize(joined, "conversation-joins")
    again = ready.join(F.broadcast(joined.select(F.col("conv_id").alias("c"))), same, "left_semi")
    lines = (
        joined.select(
            "conv_id", F.lit(0).alias("is_row"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
            F.col("audit").alias("line"), F.lit(0).cast("long").alias("copies"),
        )
        .unionByName(again.select("conv_id", F.lit(1).alias("is_row"), "turn", "role", "line", "copies"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "is_row", "turn", "line")
    )
    digest_schema = T.StructType([schema["conv_id"], schema["repaired_sha256"]])
    digests = lines.mapInArrow(_digests(_arrow(digest_schema)), digest_schema).withColumnRenamed("conv_id", "c")
    far = joined.join(digests, same).select(*out)
    gaps = F.coalesce(F.col("most_turn") - F.col("least_turn") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return whole.unionByName(far).select("conv_id", gaps.alias("gaps"), *COUNTS, "cost", "audit", "repaired_sha256")


def damage(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """`conv_id`, `turn`, `role`, `text`, `present` after a fixed damage by CRC-32 of ``conv_id:turn``.

    Of 20 remainders, 0 drops the row (`present` is false), 1 empties its text,
    2 takes the ends of its sentences, 3 repeats it, 4 gives it to the user.
    """
    told = lambda c: F.coalesce(column(c).cast("string"), F.lit(_NULL))
    kind = F.crc32(F.concat(told(conv_col), F.lit(":"), told(turn_col)).cast("binary")) % 20
    marked = rows.select(
        column(conv_col).alias("conv_id"), column(turn_col).alias("turn"), told(role_col).alias("role"),
        told(text_col).alias("text"), kind.alias("kind"),
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return marked.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), (F.col("kind") != 0).alias("present"),
        F.explode(F.expr("sequence(1, if(kind = 3, 2, 1))")).alias("copy"),
    ).drop("copy")
