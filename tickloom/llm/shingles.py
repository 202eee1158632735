"""Hashes of word shingles for many texts at once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from tickloom.llm.decontaminate import plain

#: An odd base, so that its powers can be undone modulo 2**64.
BASE = 0x5851F42D4C957F2D
#: Distinct shingles are told apart by so many bits within a text.
BITS = 48


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash (the finaliser of splitmix64; its constants are fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(count: int, base: int) -> np.ndarray:
    powers = np.full(count, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def words_of(text: str | None) -> bytes:
    """The words of a text in lower case, one blank between two."""
    return b" ".join(plain((text or "").lower().encode()).split())


@dataclass
class Shingles:
    """Distinct shingles of some texts: whose they are, their hash, how often they occur."""

    owner: np.ndarray
    value: np.ndarray
    count: np.ndarray


def shingles_of(texts: list[bytes], size: int) -> Shingles:
    """Shingles of ``size`` words of texts given by ``words_of``. A text of fewer words,
    but not none, is one shingle."""
    buffer = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(lengths + 1) - lengths - 1
    room = 1 << max(20, int(len(buffer)).bit_length())
    powers, back = _powers(room, BASE), _powers(room, pow(BASE, -1, 2**64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * powers[: len(buffer)])])
    blanks = np.flatnonzero(buffer == 0x20)
    # Words of all texts: an empty text adds a word of no length, left out here.
    word_begin = np.concatenate([[0], blanks[:-1] + 1]) if len(blanks) else np.zeros(0, np.int64)
    full = blanks > word_begin
    word_begin, word_end = word_begin[full], blanks[full]
    of_text = np.searchsorted(begins, word_begin, side="right") - 1
    words = np.bincount(of_text, minlength=len(texts))
    first = np.cumsum(words) - words
    shingles = np.where(words > 0, np.maximum(1, words - size + 1), 0)
    owner = np.repeat(np.arange(len(texts)), shingles)
    start = np.repeat(first - (np.cumsum(shingles) - shingles), shingles) + np.arange(len(owner))
    last = np.minimum(start + size, (first + words)[owner]) - 1
    a, b = word_begin[start], word_end[last]
    value = mixed((total[b] - total[a]) * back[a]) >> np.uint64(64 - BITS)
    # Few enough texts at a time that owner and hash fit one number.
    both = np.sort((owner.astype(np.uint64) << np.uint64(BITS)) | value)
    edge = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
    distinct = both[edge]
    return Shingles(
        (distinct >> np.uint64(BITS)).astype(np.int64),
        distinct & np.uint64((1 << BITS) - 1),
        np.diff(np.concatenate([edge, [len(both)]])),
    )


#: Texts that ``shingles_of`` may take at a time.
MOST_TEXTS = 1 << (64 - BITS)
