"""Token counts by finite-state transducers compiled from a byte-level BPE vocabulary.

Two deterministic transducers do the work:

* one over classes of letters marks where the vocabulary's pattern cuts a text. A run of
  texts is cut into equal chunks; all chunks are read in step, each from every state at
  once, which gives a map of states for each chunk. The maps compose, so a parallel prefix
  scan yields the state every chunk begins in, and a second reading marks the cuts;
* one over bytes reads what lies between two cuts. A transition carries how many tokens
  the encoding grows by, and a state holds all that later bytes can ask for: the longest
  ending that may be the begin of a token and, for each place in it, the last token before
  and the count there. States are compiled when first met and forgotten when too many,
  also within a word. A long word is cut into chunks, whose maps, of the state after them
  and the growth of the count, are composed by a prefix scan as well.

Nothing is shuffled; a task holds one Arrow batch and tables of bounded size.

Cases: null counts as the empty text: 0 tokens. A special string inside a text is one
token and cuts it. Texts of any length are read whole. Equal rows give equal counts; an
empty table gives an empty one. A column called like the result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.bpe_codec import runs
from tickloom.llm.bpe_tables import NEVER, MergeTable, category_ranges, merge_table
from tickloom.llm.workers import hand_back, one_table, stretches

TOKENIZER = "byte_bpe_50k.json"
CHUNK = 128
KNOWN_WORDS = 400_000
KNOWN_STATES = 150_000
# Longer words are counted in chunks of so many bytes, so many chunks at a time; a state is
# guessed from the bytes before a chunk; so many maps of chunks are remembered.
LONG_WORD, CHUNKS_AT_ONCE, WARM_UP, KNOWN_CHUNKS = 256, 1_024, 64, 4_096

# Classes of letters. Letters that contractions are made of have their own.
SPACE, WHITE, LETTER, NUMBER, OTHER, QUOTE, STMD, R, V, E, L, END = range(12)
LETTERS = (LETTER, STMD, R, V, E, L)

# States: what the last letters are part of.
DONE, ONE_SPACE, ONE_WHITE, SPACES, WHITES, WORD, DIGITS, SIGNS, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L = range(12)

# What a transition says: a token begins at this letter, or began at the one before.
HERE, BEFORE = 1, 2


def _begin(letter: int) -> int:
    """The state after the first letter of a token."""
    if letter in LETTERS:
        return WORD
    return {SPACE: ONE_SPACE, WHITE: ONE_WHITE, NUMBER: DIGITS, OTHER: SIGNS, QUOTE: QUOTED}[letter]


def _transition(state: int, letter: int) -> tuple[int, int]:
    """Next state and cuts, by the pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+|
    ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` (a fixed value of the vocabulary)."""
    pending = state in (QUOTED_R, QUOTED_V, QUOTED_L)
    if letter == END:  # also the end of every text
        return DONE, HERE | BEFORE * pending
    joined = SIGNS if letter in (OTHER, QUOTE) else DIGITS if letter == NUMBER else WORD
    if state in (ONE_SPACE, ONE_WHITE, SPACES, WHITES):
        if letter in (SPACE, WHITE):
            return (SPACES if letter == SPACE else WHITES), 0
        if state == ONE_SPACE:
            return joined, 0
        if state == SPACES:  # the last blank goes with what follows
            return joined, BEFORE
        return _begin(letter), HERE | BEFORE * (state == WHITES)
    if state == joined and letter not in (SPACE, WHITE):
        return state, 0
    if state == QUOTED:
        if letter == STMD:
            return DONE, 0
        if letter in (R, V, L):
            return {R: QUOTED_R, V: QUOTED_V, L: QUOTED_L}[letter], 0
        if letter in (OTHER, QUOTE):
            return SIGNS, 0
    if pending:
        if letter == (L if state == QUOTED_L else E):
            return DONE, 0
        if letter in LETTERS:  # the quote stood alone; a word began after it
            return WORD, BEFORE
        return _begin(letter), BEFORE | HERE
    return _begin(letter), HERE


STATES = 12
_TABLE = [[_transition(s, c) for s in range(STATES)] for c in range(END + 1)]
NEXT = np.array([[x[0] for x in row] for row in _TABLE], np.uint8).ravel()
CUTS = np.array([[x[1] for x in row] for row in _TABLE], np.uint8).ravel()


@lru_cache(maxsize=1)
def letter_classes() -> np.ndarray:
    """The class of each code point."""
    classes = np.full(0x110000, OTHER, np.uint8)
    for initial, kind in (("L", LETTER), ("N", NUMBER)):
        for first, last in category_ranges(initial):
            classes[first : last + 1] = kind
    classes[[i for i in range(0x10000) if chr(i).isspace() and not 0x1C <= i <= 0x1F]] = WHITE
    for letters, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", STMD), ("r", R), ("v", V), ("e", E), ("l", L)):
        for letter in letters:
            classes[ord(letter)] = kind
    return classes


def entry_states(maps: np.ndarray) -> np.ndarray:
    """The state each chunk begins in: an inclusive scan of the composed maps."""
    scan, step = maps.copy(), 1
    while step < len(scan):
        scan[step:] = np.take_along_axis(scan[step:], scan[:-step], axis=1)
        step *= 2
    return np.concatenate([[DONE], scan[:-1, DONE]]).astype(np.int64)


def cut_places(classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Where tokens of the pattern begin, and every END, in a run of classes."""
    rows = -(-len(classes) // chunk)
    padded = np.full(rows * chunk, END, np.uint8)
    padded[: len(classes)] = classes
    # By letter in a chunk, then chunk: each step reads one stretch of memory.
    steps = np.ascontiguousarray(padded.reshape(rows, chunk).T).astype(np.int64) * STATES
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (rows, 1))
    for letters in steps:
        maps = NEXT[letters[:, None] + maps]
    state = entry_states(maps)
    cuts = np.empty((chunk, rows), np.uint8)
    for i, letters in enumerate(steps):
        at = letters + state
        cuts[i] = CUTS[at]
        state = NEXT[at].astype(np.int64)
    flat = cuts.T.ravel()[: len(classes)]
    marked = (flat & HERE) > 0
    marked[:-1] |= (flat[1:] & BEFORE) > 0
    return np.flatnonzero(marked)


#: The state at the beginning of a word.
START = ("", (-1,), (0,))


class CountTransducer:
    """Counts the BPE tokens of a word while reading its bytes once."""

    def __init__(self, table: MergeTable, known_states: int = KNOWN_STATES):
        self.table = table
        self.limit = known_states
        self.begins = {text[:i] for text in table.vocab for i in range(1, len(text) + 1)}
        self.rank, self.left, self.right = table.rank.tolist(), table.left.tolist(), table.right.tolist()
        self.own: dict[int, bool] = {}
        self.forget()

    def forget(self) -> None:
        # A state: the ending, the last token at each place of it (-1: none), the counts
        # there less the count at its end.
        self.states = [START]
        self.numbers = {START: 0}
        self.moves: dict[int, int] = {}
        self.fitting: dict[tuple[int, int], bool] = {}

    def alone(self, token: int) -> bool:
        if (known := self.own.get(token)) is None:
            known = self.own[token] = bool(self.table.stand_alone(np.array([token]))[0])
        return known

    def fits(self, a: int, b: int) -> bool:
        """``MergeTable.compatible`` for one pair; no token before always fits."""
        if a < 0:
            return True
        if (known := self.fitting.get((a, b))) is not None:
            return known
        x, y, end_x, end_y = a, b, NEVER, NEVER
        result = True
        while True:
            seam = self.table.merges.get((x, y))
            if seam and seam[0] < end_x and seam[0] <= end_y:
                result = False
                break
            if self.rank[x] < 0 and self.rank[y] < 0:
                break
            if self.rank[x] > self.rank[y]:
                end_x, x = self.rank[x], self.right[x]
            else:
                end_y, y = self.rank[y], self.left[y]
        self.fitting[a, b] = result
        return result

    def compile(self, number: int, letter: str) -> int:
        """The move from a state by a byte: the next state, and the count's growth."""
        ending, last, counts = self.states[number]
        text = ending + letter
        for at in range(len(text)):
            token = self.table.vocab.get(text[at:])
            if token is not None and self.fits(last[at], token) and self.alone(token):
                break
        grown = counts[at] + 1
        keep = next(i for i in range(len(text)) if text[i:] in self.begins)
        state = (text[keep:], (*last[keep:], token), (*(c - grown for c in counts[keep:]), 0))
        if (follows := self.numbers.get(state)) is None:
            follows = self.numbers[state] = len(self.states)
            self.states.append(state)
        move = self.moves[number << 8 | ord(letter)] = follows << 16 | grown + 32768
        return move

    def read(self, state: tuple, part: bytes) -> tuple[tuple, int]:
        """The map of a chunk at one state: the state after it, and the count's growth."""
        if len(self.states) > self.limit:
            self.forget()
        if (number := self.numbers.get(state)) is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
        total = 0
        find = self.moves.get
        for byte in part:
            move = find(number << 8 | byte)
            if move is None:
                move = self.compile(number, chr(byte))
            number = move >> 16
            total += (move & 0xFFFF) - 32768
        return self.states[number], total

    def count(self, word: bytes) -> int:
        return self.read(START, word)[1] if len(word) <= LONG_WORD else self.count_long(word)

    def count_long(self, word: bytes, chunk: int = LONG_WORD) -> int:
        """The count of a word of any length, chunk by chunk.

        Each chunk has a map: from the state it is entered in to the state after it and the
        count's growth. What a state holds depends on the last bytes, so a chunk is first
        read from the state that the bytes before it lead to from the start. The maps are
        then composed by a scan; a chunk that turns out to be entered in another state is
        read again from there. Equal chunks entered in equal states are read once.
        """
        known: dict[tuple[tuple, bytes], tuple[tuple, int]] = {}

        def mapped(state: tuple, part: bytes) -> tuple[tuple, int]:
            if (found := known.get((state, part))) is None:
                if len(known) > KNOWN_CHUNKS:
                    known.clear()
                found = known[state, part] = self.read(state, part)
            return found

        total, state, stretch = 0, START, chunk * CHUNKS_AT_ONCE
        for first in range(0, len(word), stretch):
            parts = [word[i : i + chunk] for i in range(first, min(len(word), first + stretch), chunk)]
            entries = [state, *(mapped(START, part[-WARM_UP:])[0] for part in parts[:-1])]
            maps = [(entry, *mapped(entry, part)) for entry, part in zip(entries, parts)]
            _, state, grown = composed(maps, lambda at, entry, parts=parts: mapped(entry, parts[at]))[-1]
            total += grown
        return total


def composed(
    maps: list[tuple[tuple, tuple, int]], again: Callable[[int, tuple], tuple[tuple, int]]
) -> list[tuple[tuple, tuple, int]]:
    """An inclusive prefix scan of (entry, exit, count) of chunks: two maps that meet compose
    to one over both. Where a chunk was read from another state than the one before ends in,
    it is read again first."""
    found, step = list(maps), 1
    for i in range(1, len(found)):
        if found[i][0] != found[i - 1][1]:
            found[i] = (found[i - 1][1], *again(i, found[i - 1][1]))
    while step < len(found):
        found = found[:step] + [(a[0], b[1], a[2] + b[2]) for a, b in zip(found, found[step:])]
        step *= 2
    return found


class TokenCounter:
    """Token counts of whole texts, for one vocabulary file in one process."""

    def __init__(self, table: MergeTable, known_words: int = KNOWN_WORDS):
        self.transducer = CountTransducer(table)
        self.specials = re.compile("|".join(map(re.escape, table.specials)) or "(?!)")
        self.special_texts = list(table.specials)
        self.limit = known_words
        self.known: dict[bytes, int] = {}

    def parts(self, text: str) -> list[str]:
        if any(special in text for special in self.special_texts):
            return self.specials.split(text)
        return [text]

    def counts(self, texts: list[str]) -> list[int]:
        return list(chain.from_iterable(self._run(texts[a:b]) for a, b in runs(texts)))

    def _run(self, texts: list[str]) -> list[int]:
        split = [self.parts(text) for text in texts]
        parts = list(chain.from_iterable(split))
        # A letter after each part, whose class is END.
        stream = "\n".join([*parts, ""])
        points = np.frombuffer(stream.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        classes = letter_classes()[points]
        classes[ends] = END
        places = cut_places(classes)
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        offset = np.concatenate([[0], np.cumsum(width)])
        first, past = places, np.append(places[1:], len(points))
        inside = classes[first] != END
        first, past = first[inside], past[inside]
        buffer = stream.encode()
        words = list(map(buffer.__getitem__, map(slice, offset[first].tolist(), offset[past].tolist())))
        total = np.concatenate([[0], np.cumsum(self._word_counts(words))])
        up_to = total[np.searchsorted(first, ends)]
        per_part = np.diff(np.concatenate([[0], up_to]))
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        of_text = np.repeat(np.arange(len(split)), sizes)
        # Between two parts of a text stands one special token.
        return (np.bincount(of_text, per_part, len(split)).astype(np.int64) + sizes - 1).tolist()

    def _word_counts(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.limit:
            self.known.clear()
        find = self.known.get
        counts = [find(word, -1) for word in words]
        result = np.array(counts, np.int64)
        for i in np.flatnonzero(result < 0).tolist():
            word = words[i]
            if (count := find(word)) is None:
                count = self.transducer.count(word)
                if len(word) <= LONG_WORD:
                    self.known[word] = count
            result[i] = count
        return result


@one_table
def counter(path: str) -> TokenCounter:
    return TokenCounter(merge_table(path))


def count_tokens(df: DataFrame, text: str = "text", result: str = "n_tokens", tokenizer: str | None = None) -> DataFrame:
    """Add the number of tokens of each whole text."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)

    @F.arrow_udf("bigint")
    def counted(texts: pa.Array) -> pa.Array:
        count = counter(path).counts
        found = [n for _, part in stretches(texts) for n in count(part)]
        hand_back()
        return pa.array(found, pa.int64())

    return df.withColumn(result, counted(F.col(text)))
