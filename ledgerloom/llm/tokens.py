"""Encoding of texts with a public byte-level BPE tokenizer, as a monoid tree reduction."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where the ranks of the tokenizer lie on every machine; a parameter of all functions below.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the tokenizer cuts text into words before any merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of a leaf of the tree, and the first boundary window on either side.
LEAF, WINDOW = 1024, 64

_LETTER = "A-Za-zÀ-ÖØ-öΑ-Ρα-ωА-яぁ-ゖァ-ヺ一-龥가-힣"
_SIGN = "!-&(-/:-@[-`{-~、。，！？；：「」（）"  # no apostrophe: it may begin a contraction
#: A place where a word ends whatever follows, and the next begins whatever came before: no alternative of PATTERN goes
#: from a character that isn't blank into a blank, from a letter into a sign, or from a sign (but an apostrophe) into a
#: letter, and none looks behind. The sets hold only characters whose class is the same in all versions of Unicode.
SAFE = re.compile(f"(?<=[{_LETTER}{_SIGN}0-9])(?=[ \n])|(?<=[{_LETTER}])(?=[{_SIGN}])|(?<=[{_SIGN}])(?=[{_LETTER}])")


class Encoder:
    """A text's ids, by halves: encode leaves, then join neighbours up the tree."""

    def __init__(self, ranks: str = RANKS, pattern: str = PATTERN, leaf: int = LEAF) -> None:
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.leaf = leaf
        self.bytes = [b""] * (max(table.values()) + 1)
        for token, rank in table.items():
            self.bytes[rank] = token
        self.sizes = [len(b) for b in self.bytes]
        self._encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary

    def encode(self, text: str | None) -> list[int]:
        """The ids of text without special tokens; none for null and empty text."""
        return self._tree(text, 0, len(text)) if text else []

    def _tree(self, text: str, lo: int, hi: int) -> list[int]:
        if hi - lo <= self.leaf:
            return self._encode(text[lo:hi])
        mid = (lo + hi) // 2
        return self.join(text, lo, mid, hi, self._tree(text, lo, mid), self._tree(text, mid, hi))

    def join(self, text: str, lo: int, mid: int, hi: int, left: list[int], right: list[int]) -> list[int]:
        """ids of text[lo:hi] from those of text[lo:mid] and text[mid:hi].

        A window around mid grows until both its ends are places where words are sure to end (or ends of the text):
        tokens outside can't change then, and only the window is encoded again.
        """
        a, w = lo, WINDOW
        while mid - w > lo:
            cuts = [m.start() for m in SAFE.finditer(text, mid - w, min(mid + 1, hi)) if mid - w < m.start() <= mid]
            if cuts:
                a = cuts[-1]
                break
            w *= 4
        b, w = hi, WINDOW
        while mid + w < hi:
            if cut := next((m.start() for m in SAFE.finditer(text, mid, mid + w) if m.start() > mid), None):
                b = cut
                break
            w *= 4
        if a == mid:
            return left + right
        return self._drop(left, text[a:mid], -1) + self._encode(text[a:b]) + self._drop(right, text[mid:b], 1)

    def _drop(self, ids: list[int], text: str, side: int) -> list[int]:
        """ids without those that spell text at their end (side -1) or beginning (side 1)."""
        rest, n = len(text.encode()), 0
        while rest > 0:
            rest -= self.sizes[ids[n if side == 1 else -n - 1]]
            n += 1
        if rest:
            raise AssertionError("a token crosses a place where words end")
        return ids[n:] if side == 1 else ids[: len(ids) - n]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: spellings are concatenated, which is the same up any tree."""
        return b"".join([self.bytes[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(ranks: str = RANKS) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(ranks)


def token_ids(text: Column, ranks: str = RANKS) -> Column:
    """array<int> of the ids of each text, without special tokens; an empty array for null and empty texts.

    Texts go through Arrow in batches; there is no shuffle. A long text is encoded leaf by leaf in bounded windows.
    """

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(ranks)
        for texts in batches:
            yield pd.Series([enc.encode(t) for t in texts], dtype=object)

    return encode(text)


def token_text(ids: Column, ranks: str = RANKS) -> Column:
    """The text of ids; null for null."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(ranks)
        for rows in batches:
            yield pd.Series([None if r is None else enc.decode(r) for r in rows], dtype=object)

    return decode(ids)
