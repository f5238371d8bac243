"""Conversation structure repair with a persistent audit of edits.

A conversation has to be an optional system turn and then pairs of user and assistant turns.  Dynamic programming over
its rows and the four states of that rule finds the cheapest edits; of equally cheap ones the audit (the edits'
initials) that is first in ASCII order wins.  Audits share their beginnings: each is a chain of linked nodes with
binary-lifting ancestors and rolling hashes, and two are compared by searching their longest common prefix.

Rows travel without texts until the audits are known.  They are cut into ranges of (conversation, turn), so a
conversation of any length is worked on by many tasks: each piece gives its cheapest audits between all states, and
pieces are put together afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import ASCII_SPACE, small, written

# Fixed values of the contract: what edits cost, and the rule as (state, role initial) -> state.
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (ASSISTANT, "u"): USER,
    (USER, "a"): ASSISTANT,
}
LEGAL_NEIGHBOURS = {"su", "ua", "au"}
ROLES = {USER: "user", ASSISTANT: "assistant"}

# A row's symbol: a letter for its role's initial (others are "x") and its first fault.
INITIALS = "suax"
FINE, CUT, BLANK, REPEATED = range(4)
PIECE_ROWS = 1 << 14  # rows of a conversation worked on at once: bounds the nodes in memory
CACHED_ROWS, CACHED_ANSWERS = 64, 1 << 15

_MODULUS, _BASE = (1 << 61) - 1, 0x1F3D_5B79_8642_0ACE


def symbol(initial: str, fault: int) -> str:
    return chr(97 + 4 * INITIALS.index(initial) + fault)


class AuditTree:
    """Audits as nodes that share their beginnings; node 0 is the empty audit."""

    def __init__(self) -> None:
        self.last = [""]
        self.depth = [0]
        self.hash = [0]
        self.ancestors: list[list[int]] = [[]]  # 1, 2, 4, ... steps up, as far as there are any

    def longer(self, node: int, edit: str) -> int:
        """A new node: the audit of ``node`` and one edit more."""
        ups = [node]
        while len(ups) <= len(self.ancestors[ups[-1]]):
            ups.append(self.ancestors[ups[-1]][len(ups) - 1])
        self.last.append(edit)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * _BASE + ord(edit)) % _MODULUS)
        self.ancestors.append(ups)
        return len(self.last) - 1

    def text(self, node: int) -> str:
        edits = []
        while node:
            edits.append(self.last[node])
            node = self.ancestors[node][0]
        return "".join(reversed(edits))

    def _cut(self, node: int, depth: int) -> int:
        """The ancestor of ``node`` at ``depth``."""
        above = self.depth[node] - depth
        while above:
            step = above.bit_length() - 1
            node = self.ancestors[node][step]
            above -= 1 << step
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two audits of one length are equal; equal hashes are verified, up to where the chains meet."""
        if a == b:
            return True
        if self.hash[a] != self.hash[b]:
            return False
        while a != b:
            if self.last[a] != self.last[b]:
                return False
            a, b = self.ancestors[a][0], self.ancestors[b][0]
        return True

    def precedes(self, a: int, b: int) -> bool:
        """Whether the audit of ``a`` is before that of ``b`` in ASCII order."""
        shorter = min(self.depth[a], self.depth[b])
        x, y = self._cut(a, shorter), self._cut(b, shorter)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        # Climb as long as the audits still differ: what is left is the first edit that differs.
        for step in reversed(range(len(self.ancestors[x]))):
            if step < len(self.ancestors[x]) and not self.same(self.ancestors[x][step], self.ancestors[y][step]):
                x, y = self.ancestors[x][step], self.ancestors[y][step]
        return self.last[x] < self.last[y]


def _moves(code: str) -> dict[int, list[tuple[int, int, str]]]:
    """From each state: (state after, cost, edit) for a row of this symbol."""
    initial, fault = INITIALS[(ord(code) - 97) // 4], (ord(code) - 97) % 4
    moves: dict[int, list[tuple[int, int, str]]] = {}
    for state in range(4):
        found = [(state, DELETE, "D")]
        if fault in (FINE, CUT):
            extra = TRUNCATED * (fault == CUT)
            if (state, initial) in STEPS:
                found.append((STEPS[state, initial], extra, "K"))
            found.append((USER if state != USER else ASSISTANT, RELABEL + extra, "R"))
        moves[state] = found
    return moves


MOVES = {chr(97 + k): _moves(chr(97 + k)) for k in range(16)}


def _cheapest(symbols: str, start: int) -> list[tuple[int, str] | None]:
    """For each state after the rows: the least cost from ``start`` and the first audit of that cost.

    Audits of one state after one row that cost the same are never each other's beginnings (the longer one would
    have paid for insertions more), so the first of them stays first whatever follows.
    """
    tree = AuditTree()
    layer: dict[int, tuple[int, int]] = {start: (0, 0)}

    def better(held: tuple[int, int] | None, cost: int, node: int, edit: str) -> tuple[int, int] | None:
        """The new entry, if it is before ``held``."""
        if held is not None and cost > held[0]:
            return None
        new = tree.longer(node, edit)
        if held is not None and cost == held[0] and not tree.precedes(new, held[1]):
            return None
        return cost, new

    for code in symbols:
        # Insertions before the row: a user turn where one may come, then an assistant turn.
        for target, sources in ((USER, (START, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            for source in sources:
                if source in layer:
                    cost, node = layer[source]
                    entry = better(layer.get(target), cost + INSERT, node, "I")
                    if entry is not None:
                        layer[target] = entry
        following: dict[int, tuple[int, int]] = {}
        moves = MOVES[code]
        for state, (cost, node) in layer.items():
            for target, price, edit in moves[state]:
                entry = better(following.get(target), cost + price, node, edit)
                if entry is not None:
                    following[target] = entry
        layer = following
    return [(layer[s][0], tree.text(layer[s][1])) if s in layer else None for s in range(4)]


_cheapest_cached = lru_cache(CACHED_ANSWERS)(_cheapest)


def cheapest_audits(symbols: str, start: int = START) -> list[tuple[int, str] | None]:
    return (_cheapest_cached if len(symbols) <= CACHED_ROWS else _cheapest)(symbols, start)


def put_together(before: list[tuple[int, str] | None], piece: list[list[tuple[int, str] | None]]) -> list[tuple[int, str] | None]:
    """Audits up to a piece, from each state continued by those of the piece."""
    after: list[tuple[int, str] | None] = [None] * 4
    for head, tails in zip(before, piece):
        if head is None:
            continue
        for state, tail in enumerate(tails):
            if tail is not None:
                cost = head[0] + tail[0]
                if after[state] is None or cost <= after[state][0]:
                    audit = head[1] + tail[1]
                    if after[state] is None or (cost, audit) < after[state]:
                        after[state] = (cost, audit)
    return after


def closed(audits: list[tuple[int, str] | None]) -> tuple[int, str]:
    """The cheapest audit once the turns that are missing at the end are inserted."""
    missing = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
    return min((a[0] + INSERT * missing[s], a[1] + "I" * missing[s]) for s, a in enumerate(audits) if a is not None)


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) with faults put in by the CRC-32 of ``conv_id:turn``, modulo 20.

    NULLs count as one space.  Returns conv_id, turn, role, text and how many ``copies`` of the row there are: 0 drops
    it, and its conversation is still known.
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fate == 4, "user").otherwise(shown("role")).alias("role"),
        text.alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


# Rows of one turn are ordered by this digest; rows with one digest are equal.
def _digest() -> Column:
    content = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return F.unhex(F.substring(F.sha2(content, 256), 1, 32))


def _ordered(names: tuple[str, ...] = ("conv_id", "turn", "digest")) -> list[Column]:
    return [F.col(name).asc_nulls_first() for name in names]


def _faults(rows: DataFrame) -> DataFrame:
    """Distinct rows as conv_id, turn, digest, copies, ``symbol`` (of the first copy) and ``rest`` (of the others)."""
    bare = F.rtrim("text", F.lit(ASCII_SPACE.decode()))
    fault = F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(CUT)
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    short = rows.select("conv_id", "turn", _digest().alias("digest"), fault.alias("fault"), place.alias("initial"), "copies")
    distinct = written(
        short.groupBy("conv_id", "turn", "digest", "fault", "initial").agg(F.sum("copies").alias("copies")), "turns"
    )
    # Where a text was seen first in its conversation: only texts of several turns, as a table of its own.
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = written(
        distinct.where((F.col("copies") > 0) & (F.col("fault") != BLANK))
        .groupBy(F.col("conv_id").alias("first_conv"), F.col("digest").alias("first_digest"))
        .agg(F.min(when).alias("first"), F.count("*").alias("turns"))
        .where("turns > 1")
        .drop("turns"),
        "firsts",
    )
    joined = distinct.join(
        firsts, distinct["conv_id"].eqNullSafe(F.col("first_conv")) & (distinct["digest"] == F.col("first_digest")), "left"
    )
    seen = F.coalesce((F.col("fault") != BLANK) & (when > F.col("first")), F.lit(False))
    rest = F.when(F.col("fault") == BLANK, BLANK).otherwise(REPEATED)

    def letter(kind: Column) -> Column:
        return F.char(97 + 4 * F.col("initial") + kind)

    return joined.select(
        "conv_id",
        "turn",
        "digest",
        "copies",
        letter(F.when(seen, REPEATED).otherwise(F.col("fault"))).alias("symbol"),
        letter(rest).alias("rest"),
    )


PIECES = (
    "conv_id long, turn long, digest binary, symbols_first string, symbols_last string, low long, high long, turns long,"
    " blank long, duplicate long, truncated long, illegal long, costs array<long>, audits array<string>"
)
_PIECE_NAMES = [part.split()[0] for part in PIECES.split(", ")]
_PIECE_TYPES = pa.schema(
    [
        ("conv_id", pa.int64()), ("turn", pa.int64()), ("digest", pa.binary()), ("symbols_first", pa.string()),
        ("symbols_last", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()), ("blank", pa.int64()),
        ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("costs", pa.list_(pa.int64())),
        ("audits", pa.list_(pa.string())),
    ]
)


def _illegal(left: str, right: str) -> bool:
    return INITIALS[(ord(left) - 97) // 4] + INITIALS[(ord(right) - 97) // 4] not in LEGAL_NEIGHBOURS


class _Piece:
    """Rows of one conversation, in order, as symbols and the turns they have."""

    def __init__(self, conv_id: int | None, turn: int | None, digest: bytes):
        self.key = (conv_id, turn, digest)
        self.parts: list[str] = []
        self.rows = 0
        self.low: int | None = None
        self.high: int | None = None
        self.turns = 0

    def add(self, turn: int | None, symbols: str) -> None:
        self.parts.append(symbols)
        self.rows += len(symbols)
        if turn is not None and turn != self.high:  # turns ascend
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1

    def row(self, whole: bool) -> tuple:
        """The piece summed up; of a whole conversation only the audits from the start are needed."""
        symbols = "".join(self.parts)
        faults = [sum(map(symbols.count, (symbol(i, fault) for i in INITIALS))) for fault in (BLANK, REPEATED, CUT)]
        illegal = sum(map(_illegal, symbols, symbols[1:]))
        found = [a for start in ((START,) if whole else range(4)) for a in cheapest_audits(symbols, start)]
        return (
            *self.key, symbols[:1], symbols[-1:], self.low, self.high, self.turns, *faults, illegal,
            [a and a[0] for a in found], [a and a[1] for a in found],
        )


def _pieces(piece_rows: int):
    """Rows in order in; pieces out.  The first and the last conversation of a task may go on in another one."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, is_first, is_cut, found = None, True, False, []

        def packed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _PIECE_TYPES.types)], _PIECE_NAMES)
            found.clear()
            return batch

        for batch in batches:
            for conv_id, turn, digest, copies, one, rest in zip(*(column.to_pylist() for column in batch.columns)):
                if piece is not None and piece.key[0] != conv_id:
                    found.append(piece.row(whole=not is_first and not is_cut))
                    piece, is_first, is_cut = None, False, False
                left = copies
                while True:  # copies of a row may fill several pieces
                    if piece is not None and piece.rows >= piece_rows:
                        found.append(piece.row(whole=False))
                        piece, is_cut = None, True
                    if piece is None:
                        piece = _Piece(conv_id, turn, digest)
                    if not left:
                        break
                    now = min(left, piece_rows - piece.rows)
                    piece.add(turn, (one if left == copies else rest) + rest * (now - 1))
                    left -= now
                    if not left:
                        break
                if len(found) >= 1_024:
                    yield packed()
        if piece is not None:
            found.append(piece.row(whole=False))
        if found:
            yield packed()

    return pieces


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order in; conversations out."""
    current, state = (), None
    found: list[tuple] = []

    def summed() -> tuple:
        audits, low, high, turns, counts, _ = state
        cost, audit = closed(audits)
        gaps = high - low + 1 - turns if high is not None else 0
        return (*current, gaps if gaps < 2**63 else None, *counts, cost, audit)

    def packed() -> pa.RecordBatch:
        types = [pa.int64()] * 7 + [pa.string()]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*found), types)],
            ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"],
        )
        found.clear()
        return batch

    for batch in small(batches):
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            (conv_id, _, _, first, last, low, high, turns, *counts, costs, audits) = row
            if current != (conv_id,):
                if current:
                    found.append(summed())
                current, state = (conv_id,), ([(0, ""), None, None, None], None, None, 0, [0, 0, 0, 0], "")
            pairs = [None if cost is None else (cost, audit) for cost, audit in zip(costs, audits)]
            table = [pairs[k : k + 4] for k in range(0, len(pairs), 4)]
            held, held_low, held_high, held_turns, held_counts, held_last = state
            counts = [a + b for a, b in zip(held_counts, counts)]
            if held_last and first:
                counts[3] += _illegal(held_last, first)
            if low is not None:
                turns = held_turns + turns - (low == held_high)
                held_low, held_high, held_turns = low if held_low is None else held_low, high, turns
            state = (put_together(held, table), held_low, held_high, held_turns, counts, last or held_last)
        if len(found) >= 1_024:
            yield packed()
    if current:
        found.append(summed())
    if found:
        yield packed()


AUDITS = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)


def audit_conversations(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, copies): its faults, the least cost and the audit.

    Rows are taken by turn, NULL turns first, those of one turn by a digest of role and text.  ``copies`` of a row
    follow each other; conversations all of whose rows have none get zeros and an empty audit.  A NULL conv_id is
    a conversation of its own.  ``gaps`` is NULL where it is no long.  An empty table gives an empty one.
    """
    ranged = _faults(rows).repartitionByRange(*_ordered()).sortWithinPartitions(*_ordered())
    pieces = ranged.select("conv_id", "turn", "digest", "copies", "symbol", "rest").mapInArrow(_pieces(piece_rows), PIECES)
    return pieces.repartition("conv_id").sortWithinPartitions(*_ordered()).mapInArrow(_put_together, AUDITS)


_SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
EDITS = (
    "conv_id long, place long, edit string, turn long, role string, text string,"
    " summary struct<gaps: long, blank: long, duplicate: long, truncated: long, illegal: long, cost: long, audit: string>"
)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation its summary and then its rows in; its summary (place 0) and its edits out."""
    audit, place, state, current = "", 0, START, None
    summary_type = None
    columns: list[list] = [[] for _ in range(7)]

    def emit(*values) -> None:
        for column, value in zip(columns, values):
            column.append(value)

    def inserted() -> None:
        nonlocal place, state
        while place < len(audit) and audit[place] == "I":
            state, place = (ASSISTANT if state == USER else USER), place + 1
            emit(current, place, "I", None, ROLES[state], "", None)

    def packed() -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), summary_type]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], ["conv_id", "place", "edit", "turn", "role", "text", "summary"]
        )
        for column in columns:
            column.clear()
        return batch

    for batch in small(batches):
        summary_type = batch.schema.field("summary").type
        for conv_id, summary, turn, role, text, copies in zip(*(column.to_pylist() for column in batch.columns)):
            if summary is not None:
                inserted()
                audit, place, state, current = summary["audit"], 0, START, conv_id
                emit(conv_id, 0, None, None, None, None, summary)
                continue
            for _ in range(copies):
                inserted()
                edit, place = audit[place], place + 1
                if edit == "K":
                    state = STEPS[state, role[:1]]
                elif edit == "R":
                    state = ASSISTANT if state == USER else USER
                    role = ROLES[state]
                emit(conv_id, place, edit, turn, None if edit == "D" else role, None if edit == "D" else text, None)
                if len(columns[0]) >= 1_024:
                    yield packed()
        yield packed()
    inserted()
    if columns[0]:
        yield packed()


def _edits(rows: DataFrame, piece_rows: int) -> DataFrame:
    """Summary rows and edits, partitioned by conversation and in order."""
    audits = audit_conversations(rows, piece_rows).select(
        "conv_id", F.struct(*_SUMMARY).alias("summary"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies"),
    )
    texts = rows.where("copies > 0").select(
        "conv_id", F.lit(None).cast(audits.schema["summary"].dataType).alias("summary"), "turn", _digest().alias("digest"), "role", "text", "copies"
    )
    both = audits.union(texts).repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("summary").isNull(), *_ordered(("turn", "digest"))
    )
    return both.select("conv_id", "summary", "turn", "role", "text", "copies").mapInArrow(_apply, EDITS)


def repair_conversations(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The edits that repair each conversation of ``rows``, in order: conv_id, place (from 1), edit, turn, role, text.

    ``edit`` is K (kept), R (given another role), D (deleted: role and text are NULL) or I (inserted: no turn, an empty text).
    The rows of a conversation stream through one task; nothing is held but its audit, a letter a row.
    """
    return _edits(rows, piece_rows).where("place > 0").drop("summary")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summaries and edits in order in; each summary with the hash of the repaired conversation out."""
    waiting, digest, started = None, None, False
    for batch in batches:
        ids, done, hashes, summaries = [], [], [], batch.column(4).to_pylist()
        rows = zip(*(batch.column(k).to_pylist() for k in range(4)))
        for (conv_id, edit, role, text), summary in zip(rows, summaries):
            if summary is not None:
                if waiting is not None:
                    ids.append(waiting[0]), done.append(waiting[1]), hashes.append(digest.hexdigest())
                waiting, digest, started = (conv_id, summary), hashlib.sha256(), False
            elif edit != "D":
                digest.update(("\n" if started else "").encode() + f"{role}:{text}".encode())
                started = True
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(done, batch.schema.field("summary").type), pa.array(hashes)],
                ["conv_id", "summary", "repaired_sha256"],
            )
        summary_type = batch.schema.field("summary").type
    if waiting is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([waiting[0]], pa.int64()), pa.array([waiting[1]], summary_type), pa.array([digest.hexdigest()])],
            ["conv_id", "summary", "repaired_sha256"],
        )


def conversation_digests(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Per conversation of ``rows`` what ``audit_conversations`` finds, and ``repaired_sha256``.

    The hash is SHA-256 of the repaired ``role:text``, joined by newlines.  It is one chain over the whole conversation,
    so its texts pass through one task, as a stream.
    """
    summary = EDITS.split(" summary ")[1]
    hashed = _edits(rows, piece_rows).select("conv_id", "edit", "role", "text", "summary").mapInArrow(
        _hashed, f"conv_id long, summary {summary}, repaired_sha256 string"
    )
    return hashed.select("conv_id", *(F.col("summary")[name].alias(name) for name in _SUMMARY), "repaired_sha256")
