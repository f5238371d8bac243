"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that ends its encoding.  ``PrefixCode``
stores that token for each prefix, so an encoding is read off backwards, appended bytes only extend
the table, and an edit recomputes the table until it falls into step with the old one again.

A token may follow another one exactly if BPE, run over the bytes of the two, gives the two back;
an encoding is right exactly if that holds for each two neighbours.  So the last token of a prefix is
the one token ending there that may follow the last token of the prefix before it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import blobs, small

CACHED_PIECES = 1 << 19


class PrefixVocabulary:
    """Ranks of a byte-level BPE with, for each token, the two tokens it was merged from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.ranks: dict[bytes, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}
        self.longest = 1
        self.ending: ahocorasick.Automaton | None = None
        self._pairs: dict[int, bool] = {}  # by the left token times 2 ** 32 plus the right one
        # In order of rank: a token's halves are its encoding by the tokens before it.
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            if len(token) == 1:
                self.halves[rank] = (rank, rank)
            else:
                parts = PrefixCode(self, token).ids()
                if len(parts) == 2:
                    self.halves[rank] = (parts[0], parts[1])
                    self.merges[parts[0], parts[1]] = rank
                else:  # no merge makes it; it stands only for a piece that equals it
                    continue
            self.ranks[token] = rank
            self.longest = max(self.longest, len(token))
            self._pairs.clear()
        self.whole = ranks
        # Finds all tokens that end at a place, longest first, in one pass; bytes as characters 0 to 255.
        self.ending = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.ending.add_word(token.decode("latin-1"), (len(token), rank))
        if self.ranks:
            self.ending.make_automaton()

    @classmethod
    def from_file(cls, path: str) -> PrefixVocabulary:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def may_follow(self, left: int, right: int) -> bool:
        """Whether BPE leaves ``left`` and ``right`` apart: no merge across their border comes first."""
        pair = left << 32 | right
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) > CACHED_PIECES:
                self._pairs.clear()
            known = self._pairs[pair] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        # Undo the merges of both sides, latest first.  A merge across the border wins if it ranks before
        # the merge undone last: on a tie of place the left one is made first, hence the added one.
        made = None
        while True:
            across = self.merges.get((left, right))
            if across is not None and (made is None or across < made):
                return False
            left_whole = self.halves[left][0] == left
            right_whole = self.halves[right][0] == right
            if left_whole and right_whole:
                return True
            if not left_whole and (right_whole or left > right):
                made, left = left, self.halves[left][1]
            else:
                made, right = right + 1, self.halves[right][0]

    def encode(self, piece: bytes) -> list[int]:
        rank = self.whole.get(piece)
        return [rank] if rank is not None else PrefixCode(self, piece).ids()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PrefixCode:
    """The last token of every prefix of ``data``; ``append`` and ``replace`` keep it exact."""

    def __init__(self, vocabulary: PrefixVocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def append(self, more: bytes) -> None:
        vocabulary, last = self.vocabulary, self.last
        at = max(0, len(last) + 1 - vocabulary.longest)
        self.data += more
        if vocabulary.ending is None:  # the vocabulary itself is being made
            for end in range(len(last) + 1, len(self.data) + 1):
                last.append(self._last_token(end))
            return
        may_follow, pairs, before, done = vocabulary.may_follow, vocabulary._pairs, at + 1, len(last)
        for place, (length, token) in vocabulary.ending.iter(self.data[at:].decode("latin-1")):
            end = place + before
            if end <= done:
                continue
            if end > done + 1:
                break
            if length < end:
                left = last[end - length - 1]
                apart = pairs.get(left << 32 | token)
                if not (may_follow(left, token) if apart is None else apart):
                    continue
            last.append(token)
            done = end
        if done < len(self.data):
            raise ValueError(f"no token for byte {self.data[len(last)]}")

    def _last_token(self, end: int) -> int:
        ranks, may_follow, data, last = self.vocabulary.ranks, self.vocabulary.may_follow, self.data, self.last
        for start in range(max(0, end - self.vocabulary.longest), end):
            token = ranks.get(data[start:end])
            if token is not None and (start == 0 or may_follow(last[start - 1], token)):
                return token
        raise ValueError(f"no token for byte {data[end - 1]}")

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of ``data[start:stop]``; return how many prefixes were computed anew.

        Every token ends within the longest token's length of the prefix it follows: once so many
        prefixes in a row have their old last tokens, all later ones have them too.
        """
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[:start]
        agreed, computed = 0, 0
        for end in range(start + 1, len(self.data) + 1):
            token = self._last_token(end)
            self.last.append(token)
            computed += 1
            agreed = agreed + 1 if end > start + len(new) and token == old[end - shift - 1] else 0
            if agreed >= self.vocabulary.longest:
                self.last += old[end - shift :]
                break
        return computed

    def ids(self) -> list[int]:
        found, end = [], len(self.last)
        while end:
            found.append(self.last[end - 1])
            end -= len(self.vocabulary.bytes_of[found[-1]])
        return found[::-1]


@lru_cache(maxsize=4)
def _vocabulary(path: str) -> PrefixVocabulary:
    return PrefixVocabulary.from_file(path)


@lru_cache(maxsize=4)
def _pieces_of(path: str) -> dict[str, tuple[str, int, bytes]]:
    """Per process: what is known of pieces met before; emptied when full."""
    return {}


def encode_text(path: str, pattern: regex.Pattern, text: str) -> list[tuple[str, int, bytes]]:
    """Of each match of ``pattern``: its ids as text, their number, and the bytes they decode to."""
    known, pieces = _pieces_of(path), pattern.findall(text)
    try:
        return list(map(known.__getitem__, pieces))
    except KeyError:
        pass
    vocabulary = _vocabulary(path)
    if len(known) > CACHED_PIECES:
        known.clear()
    found = []
    for piece in pieces:
        entry = known.get(piece)
        if entry is None:
            ids = vocabulary.encode(piece.encode())
            entry = known[piece] = (",".join(map(str, ids)), len(ids), vocabulary.decode(ids))
        found.append(entry)
    return found


def bpe_encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text, and the bytes that decoding the ids gives.

    Returns ``id_col``, ``ids`` (binary: decimal ids joined by commas), ``n_tokens`` and ``decoded``
    (binary).  No row is moved: one task encodes its own rows, one text at a time.

    A NULL text counts as empty (no ids, no bytes); a NULL id stays NULL; repeated rows give repeated
    results; an empty table gives an empty one; other columns of ``docs`` are not looked at.
    """
    source = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in small(batches):
            ids, counts, decoded = [], [], []
            for text in blobs(batch.column(1)):
                entries = encode_text(path, compiled, (text or b"").decode("utf-8", "replace"))
                ids.append(",".join([e[0] for e in entries]).encode())
                counts.append(sum([e[1] for e in entries]))
                decoded.append(b"".join([e[2] for e in entries]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(counts, pa.int64()), pa.array(decoded, pa.binary())],
                ["id", "ids", "n_tokens", "decoded"],
            )

    found = source.mapInArrow(encode, "id long, ids binary, n_tokens long, decoded binary")
    return found.withColumnRenamed("id", id_col)
