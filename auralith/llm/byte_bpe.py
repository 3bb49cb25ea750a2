"""Byte-level BPE encoding and decoding.

Each match of the split pattern is encoded on its own. An automaton over all tokens, bytes mapped to Latin-1 characters, gives the
longest token at every byte in one scan; tokens are laid from the left, and a token stays only if the merges could leave it next to
its left neighbour (tested by undoing merges across their border, memoised for each pair). Otherwise shorter tokens are tried, then the
left neighbour is taken back and the position marked dead, so that each position is left at most once: time is linear in the piece.
The one laying in which all neighbours are compatible is the one that the merges produce.

Cases: null and empty texts have no ids and decode to no bytes; a piece may be as long as the text; repeated rows and ties are
encoded alike; an empty table gives an empty result; further columns pass through, but for those with the names of the results.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auralith.llm.common import map_texts, map_values

RANKS = "byte_bpe_50k.tiktoken"
#: Entries of a generation of a worker's memo of pieces, and of its memo of pairs, which is emptied when full.
PIECES, PAIRS = 200_000, 1_000_000


class Pieces(dict):
    """Memo from a piece to its ids, in two generations: a full one becomes the old one, from which pieces in use come back."""

    def __init__(self, codec: Codec) -> None:
        super().__init__()
        self.codec = codec
        self.old: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if (ids := self.old.get(piece)) is None:
            ids = self.codec.encode_piece(piece.encode())
        if len(piece) < 100:
            if len(self) >= PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encoder and decoder for a file of ranks: lines of a token in base64 and its rank, merges in the order of their ranks."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.ids = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.lengths = [len(t) for t in self.tokens]
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: list[tuple[int, int]] = [(i, i) for i in range(len(self.tokens))]
        self.shorter = [-1] * len(self.tokens)
        self.known: dict[tuple[int, int], bool] = {}
        automaton, unreached = ahocorasick.Automaton(), set()
        for i, token in enumerate(self.tokens):
            if not token:
                continue
            for cut in range(len(token) - 1, 0, -1):
                left = ranks.get(token[:cut])
                if left is None or left in unreached:
                    continue
                if self.shorter[i] < 0:
                    self.shorter[i] = left
                right = ranks.get(token[cut:])
                # the merge that makes a token joins the two earlier tokens that stand side by side before it
                if right is not None and left < i and right < i and self._compatible(left, right):
                    self.merged[left, right] = i
                    self.halves[i] = (left, right)
                    break
            if len(token) > 1 and self.halves[i] == (i, i):
                unreached.add(i)  # no merges lead to it: it is an id only where it is a whole piece
            else:
                automaton.add_word(token.decode("latin-1"), i)
        automaton.make_automaton()
        self.automaton = automaton
        self.split = regex.compile(pattern).findall
        self.pieces = Pieces(self)

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the merges can end with these two side by side: no merge across their border comes before those inside them.

        Only the parts that touch the border matter: on the left each token's right halves, on the right the left halves. A part stands at the border
        from the merge that makes it (its own rank) until the merge that takes it up (the rank of the part around it). Two parts that stand there at the same
        time must have no merge, or one that comes after either is taken up; of two merges of one rank the left one comes first.
        """
        ranks = len(self.tokens)
        lefts, rights = self._border(left, 1), self._border(right, 0)
        for a, a_end in lefts:
            for b, b_end in rights:
                made = self.merged.get((a, b))
                if made is not None and made < (a_end if a_end is not None else ranks) and made <= (b_end if b_end is not None else ranks):
                    return False
        return True

    def _border(self, token: int, side: int) -> list[tuple[int, int | None]]:
        """The parts of a token that touch its right (side 1) or left (side 0) end, each with the token that takes it up (none for the whole)."""
        out, around = [(token, None)], token
        while (part := self.halves[around][side]) != around:
            out.append((part, around))
            around = part
        return out

    def compatible(self, left: int, right: int) -> bool:
        pair = (left, right)
        known = self.known.get(pair)
        if known is None:
            if len(self.known) >= PAIRS:
                self.known.clear()
            known = self.known[pair] = self._compatible(left, right)
        return known

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        if (whole := self.ids.get(piece)) is not None:
            return (whole,)
        if not piece:
            return ()
        lengths, shorter, compatible, n = self.lengths, self.shorter, self.compatible, len(piece)
        longest = [0] * n
        for end, token in self.automaton.iter(piece.decode("latin-1")):  # of those that begin at a byte, the longest ends last
            longest[end + 1 - lengths[token]] = token
        # the last of the laid tokens is on trial; a position whose tokens all failed is never tried again
        laid, starts, failed = [longest[0]], [0], bytearray(n + 1)
        while True:
            end = starts[-1] + lengths[laid[-1]]
            if not failed[end] and (len(laid) == 1 or compatible(laid[-2], laid[-1])):
                if end == n:
                    return tuple(laid)
                starts.append(end)
                laid.append(longest[end])
                continue
            while shorter[laid[-1]] < 0:
                failed[starts.pop()] = 1
                laid.pop()
            laid[-1] = shorter[laid[-1]]

    def encode(self, text: str) -> np.ndarray:
        return np.fromiter(chain.from_iterable(map(self.pieces.__getitem__, self.split(text))), np.int32)

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the ids; none for those that the file doesn't have."""
        if len(ids) and not (min(ids) >= 0 and max(ids) < len(self.tokens)):
            ids = [i for i in ids if 0 <= i < len(self.tokens)]
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(2)
def codec(path: str) -> Codec:
    """One for each worker process and file."""
    return Codec(path)


def encode(df: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    """Appends the ids of each whole text."""
    path = path or public_tokenizers.path(RANKS)

    def work(texts: list[str]) -> list[pa.Array]:
        return [_lists([codec(path).encode(t) for t in texts])]

    return map_texts(df, text, f"{ids} array<int>", work)


def round_trip(df: DataFrame, text: str = "text", ids: str = "ids", decoded: str = "decoded", path: str | None = None) -> DataFrame:
    """Appends the ids of each whole text and the bytes that these ids decode to."""
    path = path or public_tokenizers.path(RANKS)

    def work(texts: list[str]) -> list[pa.Array]:
        c = codec(path)
        made = [c.encode(t) for t in texts]
        return [_lists(made), pa.array([c.decode(x.tolist()) for x in made], pa.binary())]

    return map_texts(df, text, f"{ids} array<int>, {decoded} binary", work)


def decode(df: DataFrame, ids: str = "ids", decoded: str = "decoded", path: str | None = None) -> DataFrame:
    """Appends the bytes of each list of ids (null list: no bytes; an id that the file doesn't have, or null: none for it)."""
    path = path or public_tokenizers.path(RANKS)

    def work(lists: list) -> list[pa.Array]:
        return [pa.array([codec(path).decode([i for i in x or () if i is not None]) for x in lists], pa.binary())]

    return map_values(df, ids, f"{decoded} binary", work)


def _lists(made: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(made) + 1, np.int32)
    np.cumsum([len(x) for x in made], out=offsets[1:])
    values = np.concatenate(made) if made else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def digests(df: DataFrame, more: list[str] | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of round_trip's rows, and the columns of more."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return df.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"), *(more or []))
