"""The merge table of a byte-level BPE vocabulary, and what follows from it."""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache
from itertools import groupby

import numpy as np
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

NEVER = np.iinfo(np.int32).max
#: Ends a word, in vocabularies whose last symbol of a word carries a suffix.
END = "Ā"
#: Words of more symbols are merged one by one; shorter ones together.
LONG_WORD = 256


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes
    of Latin-1 stand for themselves, the others for the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    shown = set(plain)
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


#: Letters and digits lie in the first planes.
PLANES = 0x40000


@lru_cache(maxsize=2)
def category_ranges(initial: str) -> list[tuple[int, int]]:
    """First and last of each run of code points whose general category begins so, as the
    tokenizers library has them: its tables of Unicode are not those of Python."""
    points = [*range(0xD800), *range(0xE000, PLANES)]
    found = Split(Regex(f"\\p{{{initial}}}+"), "removed", invert=True).pre_tokenize_str("".join(map(chr, points)))
    return [(points[a], points[b - 1]) for _, (a, b) in found]


def _class(ranges: list[tuple[int, int]]) -> str:
    return "".join(f"\\U{first:08x}-\\U{last:08x}" for first, last in ranges)


@lru_cache(maxsize=2)
def category_class(initial: str) -> str:
    """The letters whose general category begins so, as ranges of a regular expression."""
    return _class(category_ranges(initial))


def unknown_to_python() -> str:
    """Code points without a place in Python's tables, as ranges of a regular expression."""
    numbers = (i for i in range(PLANES) if unicodedata.category(chr(i)) == "Cn")
    runs = ([n for _, n in run] for _, run in groupby(enumerate(numbers), lambda x: x[1] - x[0]))
    return _class([(run[0], run[-1]) for run in runs])


class MergeTable:
    """Tokens and merges of a vocabulary file.

    A word is given as text of its UTF-8 bytes read as Latin-1 (``as_bytes``), in a
    vocabulary with a suffix followed by ``END``. ``rank[t]`` is the rank of the merge
    that makes token ``t`` (-1 for a single symbol), ``left[t]`` and ``right[t]`` are its
    parts.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        model = parsed["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        self.end = END if suffix else ""
        self.specials = {x["content"]: x["id"] for x in parsed["added_tokens"] if x["special"]}
        self.size = size = 1 + max([*vocab.values(), *self.specials.values()])
        self.tokens = [""] * size
        for token, number in (vocab | self.specials).items():
            self.tokens[number] = token
        back = str.maketrans({letter: chr(b) for b, letter in enumerate(byte_letters())})
        self.spelling = {
            number: (token.removesuffix(suffix) if suffix else token).translate(back)
            + END * bool(suffix and token.endswith(suffix))
            for token, number in vocab.items()
        }
        self.vocab = {text: number for number, text in self.spelling.items()}
        self.rank = np.full(size, -1, np.int32)
        self.left = np.zeros(size, np.int32)
        self.right = np.zeros(size, np.int32)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            x, y, made = vocab[a], vocab[b], vocab[a + b]
            self.merges[x, y] = rank, made
            self.rank[made], self.left[made], self.right[made] = rank, x, y
        self._place_pairs()
        letters = [chr(b) for b in range(256)]
        self._symbol = np.array([self.vocab.get(x, -1) for x in letters], np.int64)
        self._last_symbol = np.array([self.vocab.get(x + self.end, -1) for x in letters], np.int64)
        self._alone = np.full(size, -1, np.int8)

    def _place_pairs(self) -> None:
        """Pairs by a hashed slot; the few that share one are searched by order."""
        keys = np.array([x * self.size + y for x, y in self.merges], np.int64)
        order = np.argsort(keys)
        found = np.array(list(self.merges.values()), np.int32)[order]
        self._keys, self._ranks, self._made = keys[order], found[:, 0], found[:, 1]
        slots = self._slot(self._keys)
        self._slots = np.zeros(1 << 21, np.int32)
        self._slots[slots] = np.arange(len(slots))
        self._shared = np.bincount(slots, minlength=1 << 21) > 1

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(43)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of the merge of each pair; rank NEVER if there is none."""
        wanted = a * self.size + b
        slots = self._slot(wanted)
        at = self._slots[slots]
        if (shared := self._shared[slots]).any():
            exact = np.searchsorted(self._keys, wanted[shared])
            at[shared] = np.minimum(exact, len(self._keys) - 1)
        return np.where(self._keys[at] == wanted, self._ranks[at], NEVER), self._made[at]

    def as_word(self, word: str) -> str:
        return word.encode().decode("latin-1") + self.end

    def symbols(self, word: str) -> list[int]:
        """One token for each byte, the last with the word's end."""
        if not self.end or not word.endswith(END):
            return [self.vocab[x] for x in word]
        return [*(self.vocab[x] for x in word[:-2]), self.vocab[word[-2:]]]

    def merge_exactly(self, word: str) -> list[int]:
        """Merge by rank, from the left among equal ranks: the definition of BPE."""
        ids = self.symbols(word)
        after = [*range(1, len(ids)), -1]
        before = [-1, *range(len(ids) - 1)]
        due = [
            (found[0], i, *pair)
            for i, pair in enumerate(zip(ids, ids[1:]))
            if (found := self.merges.get(pair))
        ]
        heapq.heapify(due)
        while due:
            _, i, a, b = heapq.heappop(due)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.merges[a, b][1], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else -1
                if y >= 0 and (found := self.merges.get((ids[x], ids[y]))):
                    heapq.heappush(due, (found[0], x, ids[x], ids[y]))
        return [x for x in ids if x >= 0]

    def merge_together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``merge_exactly`` of many words, in each step every word's next merge; ids
        and the word of each, not ordered by word."""
        long = [i for i, word in enumerate(words) if len(word) > LONG_WORD]
        done_ids, done_words = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in long:
            done_ids.append(np.array(self.merge_exactly(words[i]), np.int64))
            done_words.append(np.full(len(done_ids[-1]), i))
        word_of = np.setdiff1d(np.arange(len(words)), long)
        bare = [words[i].removesuffix(self.end) for i in word_of.tolist()]
        sizes = np.fromiter(map(len, bare), np.int64, len(bare))
        letters = np.frombuffer("".join(bare).encode("latin-1"), np.uint8)
        ids = self._symbol[letters]
        if len(sizes):
            ends = np.cumsum(sizes) - 1
            ids[ends] = self._last_symbol[letters[ends]]
        while len(sizes):
            starts = np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(sizes)), sizes)
            ranks = np.full(len(ids), NEVER, np.int32)
            made = np.zeros(len(ids), np.int32)
            inside = np.flatnonzero(owner[:-1] == owner[1:])
            ranks[inside], made[inside] = self.pairs(ids[inside], ids[inside + 1])
            best = np.minimum.reduceat(ranks, starts)
            done = best == NEVER
            over = done[owner]
            done_ids.append(ids[over])
            done_words.append(word_of[owner[over]])
            hit = np.flatnonzero((ranks == best[owner]) & ~over)
            first = hit[np.concatenate([[True], owner[hit][1:] != owner[hit][:-1]])] if len(hit) else hit
            ids[first] = made[first]
            keep = ~over
            keep[first + 1] = False
            ids = ids[keep]
            sizes, word_of = sizes[~done] - 1, word_of[~done]
        return np.concatenate(done_ids), np.concatenate(done_words)

    def stand_alone(self, tokens: np.ndarray) -> np.ndarray:
        """Whether BPE makes of each token's own text that one token."""
        for token in tokens[self._alone[tokens] < 0].tolist():
            text = self.spelling.get(token, "")
            self._alone[token] = bool(text) and self.merge_exactly(text) == [token]
        return self._alone[tokens] == 1

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether BPE leaves each pair of neighbouring tokens as it is.

        Merges are undone from the last one back, on both sides of the seam. While two
        pieces touched there, their own merge must not have come first: before the merge
        that made the left piece part of more, and before or with (from the left) the
        one that made the right piece part of more.
        """
        result = np.ones(len(first), bool)
        at = np.arange(len(first))
        a, b = first.astype(np.int64), second.astype(np.int64)
        end_a = np.full(len(a), NEVER, np.int32)
        end_b = np.full(len(b), NEVER, np.int32)
        while len(at):
            seam, _ = self.pairs(a, b)
            broken = (seam < end_a) & (seam <= end_b) & (seam != NEVER)
            result[at[broken]] = False
            go = ~broken & ((self.rank[a] >= 0) | (self.rank[b] >= 0))
            at, a, b, end_a, end_b = at[go], a[go], b[go], end_a[go], end_b[go]
            rank_a, rank_b = self.rank[a], self.rank[b]
            undo_a = rank_a > rank_b
            end_a = np.where(undo_a, rank_a, end_a)
            end_b = np.where(undo_a, end_b, rank_b)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return result


def merge_table(path: str) -> MergeTable:
    """The table of a file."""
    return MergeTable(path)
