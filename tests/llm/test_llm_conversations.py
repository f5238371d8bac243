"""Conversation repair against its rules written plainly."""

import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import conversations as c, registry

SF_DIR = "/root/testdata/sf0.01"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def damaged(rows):
    """Rows (conv_id, turn, role, text) after damage, by conversation."""
    found = {}
    for conv_id, turn, role, text in rows:
        kept = found.setdefault(conv_id, [])
        shown = [" " if v is None else str(v) for v in (conv_id, turn, role, text)]
        fate = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2:]
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        kept += [(turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return found


def repaired(rows):
    """What the contract asks of one conversation's damaged rows, by plain strings."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()[:16]))
    counts, seen, faults = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
    for _, role, text in rows:
        bare = SPACE.sub("", text)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        counts[fault] = counts.get(fault, 0) + 1
        seen.add((role, text))
        faults.append(fault)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [(a[1][:1], b[1][:1]) for a, b in zip(rows, rows[1:])]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in pairs)
    best = {("", ""): (0, "", ())}  # by the last initial and whether anything came before

    def offer(table, key, entry):
        if key not in table or entry[:2] < table[key][:2]:
            table[key] = entry

    def may(key, initial):
        return initial == "u" and key[0] in ("", "s", "a") or initial == "a" and key[0] == "u" or initial == "s" and key[0] == ""

    def inserted(table):
        for _ in range(3):
            for key, (cost, audit, out) in list(table.items()):
                for role in ("user", "assistant"):
                    if may(key, role[0]):
                        offer(table, (role[0], "x"), (cost + 5, audit + "I", out + (f"{role}:",)))
        return table

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for key, (cost, audit, out) in inserted(best).items():
            offer(after, key, (cost + 2, audit + "D", out))
            if fault in ("", "truncated"):
                more = 5 * (fault == "truncated")
                if may(key, role[:1]):
                    offer(after, (role[:1], "x"), (cost + more, audit + "K", out + (f"{role}:{text}",)))
                for new in ("user", "assistant"):
                    if may(key, new[0]):
                        offer(after, (new[0], "x"), (cost + 1 + more, audit + "R", out + (f"{new}:{text}",)))
        best = after
    cost, audit, out = min(entry for key, entry in inserted(best).items() if key[0] in ("", "a"))
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


HARD = [
    (1, 0, "user", "Hello."), (1, 1, "assistant", "Yes."), (1, 2, "user", "Hello."), (1, 3, "assistant", "cut off"),
    (2, None, "user", "No turn."), (2, None, "assistant", "No turn."), (2, 7, "tool", None), (2, 9, None, "x" * 100_000 + "!"),
    (None, None, None, None), (None, 3, "system", "Only."), (3, 0, "user", ""), (3, 1, "user", " \t\x0b"), (4, 5, "", "Empty role."),
    (5, 0, "assistant", "Twice."), (5, 0, "assistant", "Twice."), (5, 1, "user", "Twice."), (5, 1, "user", "Other."),
    (6, -3, "system", "Rules."), (6, -2, "user", "Ja?\n"), (6, 4, "assistant", "Ja!"), (7, 2**62, "user", "Far."), (7, -(2**62), "user", "Apart."),
] + [(8, k, ("user", "assistant")[k % 2], f"Line {k % 5}.") for k in range(60)]


def found(spark, rows, piece_rows=c.PIECE_ROWS):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("copies", "digest", "symbol", "summary", "place"):
        df = df.withColumn(name, F.lit("own"))
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {row.conv_id: tuple(row[n] for n in names) for row in c.conversation_digests(c.damage(df), piece_rows).collect()}


@pytest.mark.parametrize("piece_rows", [c.PIECE_ROWS, 3])
def test_hard_conversations_equal_the_rules(spark, piece_rows):
    assert found(spark, HARD, piece_rows) == {conv_id: repaired(rows) for conv_id, rows in damaged(HARD).items()}


def test_empty_table(spark):
    assert found(spark, []) == {}


def test_query_equals_the_rules(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    result = {r.conv_id: tuple(r)[1:] for r in registry.op11_audit_repair(spark, SF_DIR).collect()}
    assert result == {conv_id: repaired(kept) for conv_id, kept in damaged(rows).items()}


def test_repaired_rows_hold_texts_and_edits(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.", 1), (1, 1, "user", "What?", 1)], "conv_id long, turn long, role string, text string, copies long")
    assert [tuple(r) for r in c.repair_conversations(rows).orderBy("place").collect()] == [
        (1, 1, "K", 0, "user", "Hi."),
        (1, 2, "R", 1, "assistant", "What?"),
    ]


SYMBOLS = st.text(alphabet=[chr(97 + k) for k in range(16)], max_size=5)


@settings(max_examples=150, deadline=None)
@given(SYMBOLS)
def test_audits_are_the_least_of_all_that_are_allowed(symbols):
    def audits(rows, state, left=2):
        """All (cost, audit) with at most ``left`` insertions between two rows."""
        if not rows and state in (c.START, c.ASSISTANT):
            yield 0, ""
        if left:
            for cost, audit in audits(rows, c.ASSISTANT if state == c.USER else c.USER, left - 1):
                yield cost + c.INSERT, "I" + audit
        if rows:
            for after, price, edit in c.MOVES[rows[0]][state]:
                for cost, audit in audits(rows[1:], after):
                    yield cost + price, edit + audit

    best = min(audits(symbols, c.START))
    assert c.closed(c._cheapest(symbols, c.START)) == best
    for cut in range(len(symbols) + 1):
        pieces = [[c._cheapest(part, s) for s in range(4)] for part in (symbols[:cut], symbols[cut:])]
        together = c.put_together(c.put_together([(0, ""), None, None, None], pieces[0]), pieces[1])
        assert c.closed(together) == best


@given(st.lists(st.tuples(st.integers(0, 40), st.sampled_from("DIKR")), min_size=1, max_size=60))
def test_audits_compare_as_their_texts_even_where_hashes_collide(steps):
    for base in (c._BASE, 0):  # with base 0 the hash is the last letter: almost all collide
        tree = c.AuditTree()
        old, c._BASE = c._BASE, base
        try:
            nodes = [0]
            for parent, edit in steps:
                nodes.append(tree.longer(nodes[parent % len(nodes)], edit))
        finally:
            c._BASE = old
        for a, b in itertools.product(nodes[-12:], repeat=2):
            if tree.text(a) != tree.text(b):
                assert tree.precedes(a, b) == (tree.text(a) < tree.text(b))
