"""Repair the order of roles in conversations, at least cost.

A generalised LR parser reads the roles of a conversation. Where a plain parser
would stop at a role that the grammar does not allow, this one also deletes the
turn, gives it another role, or inserts an empty turn, each at a price. All
parses go on side by side as tops of one graph-structured stack; equal tops merge,
and the cheaper one stays, or of equal cost the one whose audit, the initials of
its edits, comes first. The tables of the parser are made from the grammar.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from larderline.llm.common import BLANKS, equip, stored

# The sequences of role initials that are in order: s?(ua)+ or nothing.
START = "dialogue"
GRAMMAR = (
    (START, ()),
    (START, ("answered",)),
    ("answered", ("asked", "a")),
    ("asked", ("u",)),
    ("asked", ("s", "u")),
    ("asked", ("answered", "u")),
)
LEGAL_PAIRS = ("su", "ua", "au")
# Roles that an edit may give a turn, by initial.
ROLES = {"u": "user", "a": "assistant"}

REROLE_COST = 2
DELETE_COST = 3
INSERT_COST = 2
TRUNCATED_COST = 1

_MOST = 2**63 - 1

# A stack is its top state and the stack below it; parses share what they have
# in common. A state is a set of rules with the place that parsing is at.
Stack = tuple


def _closed(items: frozenset) -> frozenset:
    """The items, and those of the rules that may begin where one of them is at."""
    found, new = set(items), set(items)
    while new:
        wanted = {
            GRAMMAR[rule][1][at] for rule, at in new if at < len(GRAMMAR[rule][1])
        }
        new = {(n, 0) for n, (left, _) in enumerate(GRAMMAR) if left in wanted} - found
        found |= new
    return frozenset(found)


@functools.cache
def _goto(state: frozenset, symbol: str) -> frozenset:
    moved = {
        (rule, at + 1) for rule, at in state if GRAMMAR[rule][1][at : at + 1] == (symbol,)
    }
    return _closed(frozenset(moved))


def _complete(state: frozenset) -> list[int]:
    return [rule for rule, at in state if at == len(GRAMMAR[rule][1])]


def _reduced(stack: Stack, rule: int) -> Stack:
    left, right = GRAMMAR[rule]
    for _ in right:
        stack = stack[1]
    return (_goto(stack[0], left), stack)


_BOTTOM: Stack = (_closed(frozenset((n, 0) for n, r in enumerate(GRAMMAR) if r[0] == START)), None)


@functools.cache
def _shifted(stack: Stack, symbol: str) -> Stack | None:
    """The stack after a role, with all reduced that leaves no choice."""
    state = _goto(stack[0], symbol)
    if not state:
        return None
    stack = (state, stack)
    while len(stack[0]) == 1 and _complete(stack[0]):
        stack = _reduced(stack, _complete(stack[0])[0])
    return stack


@functools.cache
def _accepts(stack: Stack) -> bool:
    """Whether a dialogue may end here."""
    return any(
        GRAMMAR[rule][0] == START and _reduced(stack, rule)[1] == _BOTTOM
        for rule in _complete(stack[0])
    )


@functools.cache
def _by_inserts(stack: Stack) -> dict[Stack, str]:
    """Stacks that inserted turns lead to, with the fewest of them."""
    found = {stack: ""}
    new = [stack]
    while new:
        before, new = new, []
        for one in before:
            for symbol in ROLES:
                after = _shifted(one, symbol)
                if after is not None and after not in found:
                    found[after] = found[one] + symbol
                    new.append(after)
    return found


@functools.cache
def _moves(stack: Stack, initial: str) -> list[tuple[str, str, str, Stack]]:
    """Inserted roles, edit, role the turn has then, and the stack after it, for
    each way to take a turn in. Inserts before a deleted turn are left to the
    next one: that is as cheap, and its audit comes first."""
    moves = []
    for before, inserted in _by_inserts(stack).items():
        kept = _shifted(before, initial) if initial else None
        if kept is not None:
            moves.append((inserted, "K", "", kept))
        for symbol in ROLES:
            given = _shifted(before, symbol)
            if given is not None:
                moves.append((inserted, "R", symbol, given))
    return moves


class _Conversation:
    """What is known of a conversation while its turns go by in order.

    Each top has its cost, its rank among the tops by audit, the audit as a
    chain of its parts, and a digest of the repaired turns so far. Audits of two
    tops that took the same turns in never begin one another, so ranks and new
    letters compare them.
    """

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.tops = {_BOTTOM: (0, 0, None, hashlib.sha256())}
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before = None
        self.first_turn = self.last_turn = None
        self.turns = 0

    def take(self, turn, role, text, blank, seen, truncated, copies):
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.turns += 1
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before + initial not in LEGAL_PAIRS
        self.illegal += copies - 1
        self.before = initial
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies if seen else copies - 1
        if blank or seen:
            self._delete(copies)
        else:
            self.truncated += truncated
            self._edit(role, initial, text, int(truncated))
            self._delete(copies - 1)

    def _delete(self, turns: int) -> None:
        if turns:
            letters, price = "D" * turns, DELETE_COST * turns
            self.tops = {
                top: (cost + price, rank, (audit, letters), digest)
                for top, (cost, rank, audit, digest) in self.tops.items()
            }

    def _edit(self, role: str, initial: str, text: str, truncated: int) -> None:
        best = {}

        def offer(top, key, source, lines):
            if top not in best or key < best[top][0]:
                best[top] = (key, source, lines)

        for top, (cost, rank, _, _) in self.tops.items():
            offer(top, (cost + DELETE_COST, rank, "D"), top, ("", None))
            for inserted, edit, given, after in _moves(top, initial):
                price = cost + INSERT_COST * len(inserted) + truncated
                price += REROLE_COST if edit == "R" else 0
                key = (price, rank, "I" * len(inserted) + edit)
                offer(after, key, top, (inserted, ROLES.get(given, role)))
        self._replace(best, text)

    def _replace(self, best: dict, text: str) -> None:
        ordered = sorted(best.items(), key=lambda item: item[1][0][1:])
        tops = {}
        for rank, (top, ((cost, _, letters), source, (inserted, role))) in enumerate(ordered):
            _, _, audit, digest = self.tops[source]
            lines = [ROLES[symbol] + ":" for symbol in inserted]
            if role is not None:
                lines.append(f"{role}:{text}")
            if lines:
                # Only the bottom of the stack has no turn yet.
                joined = "\n".join(lines if source == _BOTTOM else ["", *lines])
                digest = digest.copy()
                digest.update(joined.encode("utf-8", "surrogatepass"))
            tops[top] = (cost, rank, (audit, letters), digest)
        self.tops = tops

    def row(self) -> tuple:
        best = {}
        for top, (cost, rank, _, _) in self.tops.items():
            for after, inserted in _by_inserts(top).items():
                if _accepts(after):
                    key = (cost + INSERT_COST * len(inserted), rank, "I" * len(inserted))
                    if START not in best or key < best[START][0]:
                        best[START] = (key, top, (inserted, None))
        self._replace(best, "")
        cost, _, audit, digest = self.tops[START]
        parts = []
        while audit is not None:
            audit, letters = audit
            parts.append(letters)
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return (
            self.conv_id, min(gaps, _MOST), self.blank, self.duplicate, self.truncated,
            self.illegal, cost, "".join(reversed(parts)), digest.hexdigest(),
        )


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_TURN = ("turn", "role", "text", "blank", "seen", "truncated", "copies")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    arrays = [pa.array(values, kind.type) for values, kind in zip(columns, schema, strict=True)]
    return pa.record_batch(arrays, schema=schema)


def _plans(schema: pa.Schema):
    """Reads turns sorted by conversation; one may span batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in batches:
            rows = []
            columns = [batch.column(name).to_pylist() for name in ("conv_id", *_TURN)]
            for conv_id, *turn in zip(*columns, strict=True):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        rows.append(current.row())
                    current = _Conversation(conv_id)
                if turn[-1]:
                    current.take(*turn)
            yield _batch(rows, schema)
        if current is not None:
            yield _batch([current.row()], schema)

    return run


def _in_order(turns: DataFrame) -> DataFrame:
    """Each conversation in one task, its turns in order. A turn that is there
    several times is one row with their number."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def marked_turns(
    turns: DataFrame, copies: Column | None = None, spare: str = " "
) -> DataFrame:
    """The turns with their faults, stored.

    ``copies`` says how often a row counts, none by 0. Equal rows are counted in
    map tasks, so many copies of a turn are no heavy group.
    """
    counted = (
        turns.select(
            "conv_id",
            "turn",
            F.coalesce("role", F.lit(spare)).alias("role"),
            F.coalesce("text", F.lit(spare)).alias("text"),
            (F.lit(1) if copies is None else copies).cast("long").alias("copies"),
        )
        .groupBy("conv_id", "turn", "role", "text")
        .agg(F.sum("copies").alias("copies"))
    )
    digested = stored(counted.withColumn("digest", F.sha2("text", 256)), "turns")
    # NULL turns come first.
    place = F.struct(F.col("turn").isNotNull(), "turn")
    said = ("conv_id", "role", "digest")
    firsts = (
        digested.filter("copies > 0")
        .groupBy(*said)
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(*[F.col(name).alias(f"first_{name}") for name in said], "first")
    )
    same = [F.col(name).eqNullSafe(F.col(f"first_{name}")) for name in said]
    bare = F.btrim("text", F.lit(BLANKS))
    return digested.join(firsts, same[0] & same[1] & same[2], "left").select(
        "conv_id",
        "turn",
        "role",
        "text",
        (bare == "").alias("blank"),
        F.coalesce(place != F.col("first"), F.lit(False)).alias("seen"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"),
        "copies",
    )


def plan_repairs(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """A row for each ``conv_id``: its faults, and its cheapest repair.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are
    left out, NULL roles and texts are one space. Turns stand in order of
    ``turn``, NULL first, then of role and text; a NULL ``conv_id`` is a
    conversation too. The first of these faults counts: ``blank`` (no character
    but ASCII blanks), ``duplicate`` (role and text were there before),
    ``truncated`` (last character none of ``.!?``). ``gaps`` are missing turn
    numbers, ``illegal`` counts neighbours whose roles may not follow each other.
    ``audit`` has a letter for each edit: Keep, Rerole, Delete, Insert; blank and
    duplicate turns have to be deleted. ``repaired_sha256`` is of the repaired
    turns, ``role:text``, joined by line feeds.

    A conversation whose turns all count 0 times is an empty one; an empty table
    gives no rows. A conversation is hashed whole and in order, so a single task
    reads it, as a stream: in memory are a batch and, for each of the four tops,
    a digest and its edits.
    """
    equip(turns.sparkSession)
    kind = turns.schema["conv_id"].dataType
    fields = [T.StructField("conv_id", kind)]
    fields += [T.StructField(name, T.LongType()) for name in _COUNTS]
    fields += [T.StructField(name, T.StringType()) for name in ("audit", "repaired_sha256")]
    schema = T.StructType(fields)
    ordered = _in_order(marked_turns(turns, copies))
    return ordered.mapInArrow(_plans(to_arrow_schema(schema)), schema)


def _applied(schema: pa.Schema):
    """Reads turns in order with the audit of their conversation in each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, edits, messages = None, None, []
        number = at = opened = 0

        def put(role, text):
            nonlocal number
            messages.append((conv_id, number, role, text))
            number += 1

        def wanted():
            return ROLES["ua"[(number - opened) % 2]]

        def insert():
            nonlocal at
            while edits[at : at + 1] == "I":
                put(wanted(), "")
                at += 1

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "audit", "role", "text", "copies")]
            for own, audit, role, text, copies in zip(*columns, strict=True):
                if edits is None or own != conv_id:
                    conv_id, edits, number, at, opened = own, audit, 0, 0, 0
                    insert()
                for _ in range(copies):
                    edit = edits[at]
                    at += 1
                    if edit == "K":
                        opened += number == 0 and role[:1] == "s"
                        put(role, text)
                    elif edit == "R":
                        put(wanted(), text)
                    insert()
            yield _batch(messages, schema)
            messages.clear()

    return run


def repaired_turns(
    turns: DataFrame, plans: DataFrame, copies: Column | None = None
) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``turn`` from 0, ``role``, ``text``.

    ``plans`` are those of the same turns. Inserted turns have an empty text. A
    conversation that loses all its turns has no rows.
    """
    equip(turns.sparkSession)
    kind = turns.schema["conv_id"].dataType
    schema = T.StructType(
        [
            T.StructField("conv_id", kind),
            T.StructField("turn", T.LongType()),
            T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    )
    audits = plans.select(F.col("conv_id").alias("planned"), "audit")
    marked = marked_turns(turns, copies).filter("copies > 0")
    met = marked.join(audits, F.col("conv_id").eqNullSafe(F.col("planned")))
    return _in_order(met).mapInArrow(_applied(to_arrow_schema(schema)), schema)


def damaged(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """Turns with planted faults, and how often each of them counts.

    By the remainder of a checksum of ``conv_id:turn`` (NULL: one space) a turn
    is dropped (0), emptied (1), robbed of its full stops (2), told twice (3) or
    given the role of the user (4).
    """

    def written(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat_ws(":", written("conv_id"), written("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(written("text"), ".!?", ""))
    turns = conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(written("role")).alias("role"),
        text.otherwise(written("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"),
    )
    return turns, F.col("times")
