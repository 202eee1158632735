"""BPE encoding and decoding: propose tokens, verify every seam, merge only the rest.

Words are proposed by greedy longest match. A proposal is right if each token is what BPE
makes of its own text and BPE leaves every pair of neighbours as it is; all pairs of a
batch are tested together with arrays. Only words that fail are merged exactly.

Nothing is shuffled; a task holds one Arrow batch and a bounded table of known words.

Cases: null encodes as the empty text, which has no tokens and decodes to the empty text.
Special strings inside a text become their one token. Text of any length is encoded whole.
Equal rows give equal results; an empty table gives an empty one. A column of the input
called like a column of the result is replaced.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.normalizers import NFC, Lowercase, Sequence

from tickloom.llm.bpe_tables import MergeTable, category_class, merge_table, unknown_to_python
from tickloom.llm.workers import handed_back, one_table, stretches

TOKENIZER = "word_bpe_49k.json"
# A process forgets the words it knows when they are more than this.
KNOWN_WORDS = 200_000

# White space for str.split() that the pattern of the vocabulary counts as other letters.
NOT_SPACE = re.compile(r"[\x1c-\x1f]")
SPACED = re.compile(r"(?:[\x1c-\x1f]|\S)+")


@lru_cache(maxsize=1)
def word_pattern() -> re.Pattern:
    """How the vocabulary's file cuts a text into words."""
    letters, digits = category_class("L"), category_class("N")
    return re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{letters}]+|[{digits}]|(?:[\x1c-\x1f]|[^\s{letters}{digits}])+")


@lru_cache(maxsize=1)
def newer_letters() -> tuple[re.Pattern, Sequence]:
    """What Python's tables do not know, and how the library composes and lowers letters."""
    return re.compile(f"[{unknown_to_python()}]"), Sequence([NFC(), Lowercase()])


def in_latin_1(text: str) -> bool:
    """Whether a text has letters of Latin-1 alone, which all tables know."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def gather(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` at ``begins``, one after another."""
    before = np.cumsum(sizes) - sizes
    return values[np.repeat(begins - before, sizes) + np.arange(int(sizes.sum()))]


class Spelling:
    """Bytes of each token, to write many tokens at once."""

    def __init__(self, texts: list[str]):
        spelled = [f"{text} ".encode() for text in texts]
        self.sizes = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        """The texts of some tokens with blanks between them."""
        return gather(self.bytes, self.begins[ids], self.sizes[ids])[:-1].tobytes()


class WordCodec:
    """Ids of texts and texts of ids, for one vocabulary file in one process."""

    def __init__(self, table: MergeTable, known_words: int = KNOWN_WORDS):
        self.table = table
        self.limit = known_words
        self.numbers = Spelling([str(i) for i in range(table.size)])
        # The file names no decoder: tokens stand as they are, with blanks between them.
        self.texts = Spelling(table.tokens)
        self.specials = re.compile("|".join(map(re.escape, table.specials)) or "(?!)")
        self.longest_match = ahocorasick.Automaton()
        for text, token in table.vocab.items():
            self.longest_match.add_word(text, token)
        self.longest_match.make_automaton()
        self.seen = self.failed = 0
        self.forget()

    def forget(self) -> None:
        # Where each known piece is in the tables below.
        self.index: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.begins = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)

    def pieces(self, text: str) -> list[str]:
        """Runs without white space, in order; special strings are pieces of their own."""
        if not any(special in text for special in self.table.specials):
            return self._plain_pieces(text)
        found, begin = [], 0
        for special in self.specials.finditer(text):
            found += self._plain_pieces(text[begin : special.start()])
            found.append(special[0])
            begin = special.end()
        return found + self._plain_pieces(text[begin:])

    @staticmethod
    def _plain_pieces(text: str) -> list[str]:
        if not in_latin_1(text):
            newer, library = newer_letters()
            if newer.search(text):
                text = library.normalize_str(text)
        # Lower case letter by letter: no final form of sigma.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return SPACED.findall(text) if NOT_SPACE.search(text) else text.split()

    def propose(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy longest match: the tokens of all words, the word of each, and whether
        a word's end is part of its last token.

        Words stand one after another and no token goes beyond a word's end, so one scan
        serves them all.
        """
        matches = np.array(list(self.longest_match.iter_long("".join(words))), np.int64)
        last, tokens = matches.reshape(-1, 2).T
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        owner = np.searchsorted(ends, last, side="right")
        holds_end = np.zeros(len(words), bool)
        holds_end[owner[last == ends[owner] - 1]] = True
        return tokens, owner, holds_end

    def words_to_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Speculate, verify, and merge exactly where that fails: ids and their words."""
        table = self.table
        tokens, owner, holds_end = self.propose(words)
        good = holds_end
        good[owner[~table.stand_alone(tokens)]] = False
        seams = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, where = np.unique(tokens[seams] * table.size + tokens[seams + 1], return_inverse=True)
        fits = table.compatible(pairs // table.size, pairs % table.size)
        good[owner[seams[~fits[where]]]] = False
        failed = np.flatnonzero(~good)
        self.seen += len(words)
        self.failed += len(failed)
        merged, of_failed = table.merge_together([words[i] for i in failed.tolist()])
        keep = good[owner]
        ids = np.concatenate([tokens[keep], merged])
        owner = np.concatenate([owner[keep], failed[of_failed]])
        order = np.argsort(owner, kind="stable")
        return ids[order], owner[order]

    def learn(self, pieces: list[str]) -> None:
        """Work out the ids of pieces that are not known."""
        specials, cut_up, as_word = self.table.specials, word_pattern().findall, self.table.as_word
        cut = [[p] if p in specials else cut_up(p) for p in pieces]
        number = {word: i for i, word in enumerate(dict.fromkeys(chain.from_iterable(cut)))}
        own = [as_word(word) for word in number if word not in specials]
        # Special strings end the list of words; each is one token.
        listed = [word for word in number if word in specials]
        place = {word: i for i, word in enumerate([w for w in number if w not in specials] + listed)}
        ids, owner = self.words_to_ids(own) if own else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        ids = np.concatenate([ids, np.array([specials[w] for w in listed], np.int64)])
        owner = np.concatenate([owner, len(own) + np.arange(len(listed))])
        sizes = np.bincount(owner, minlength=len(place))
        begins = np.cumsum(sizes) - sizes
        parts = np.fromiter(map(len, cut), np.int64, len(cut))
        words = np.fromiter(map(place.__getitem__, chain.from_iterable(cut)), np.int64, int(parts.sum()))
        per_piece = np.zeros(len(pieces), np.int64)
        np.add.at(per_piece, np.repeat(np.arange(len(pieces)), parts), sizes[words])
        known = len(self.index)
        self.index.update(zip(pieces, range(known, known + len(pieces))))
        self.begins = np.concatenate([self.begins, len(self.ids) + np.cumsum(per_piece) - per_piece])
        self.sizes = np.concatenate([self.sizes, per_piece])
        self.ids = np.concatenate([self.ids, gather(ids, begins[words], sizes[words]).astype(np.int32)])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text; unknown words are learnt for a few texts at a time."""
        for begin, end in runs(texts):
            if len(self.index) > self.limit:
                self.forget()
            cut = [self.pieces(text) for text in texts[begin:end]]
            counts = np.fromiter(map(len, cut), np.int64, len(cut))
            flat = list(chain.from_iterable(cut))
            find = self.index.get
            at = np.array([find(piece, -1) for piece in flat], np.int64)
            if len(unknown := np.flatnonzero(at < 0)):
                new = [flat[i] for i in unknown.tolist()]
                self.learn(list(dict.fromkeys(new)))
                at[unknown] = np.fromiter(map(self.index.__getitem__, new), np.int64, len(new))
            sizes = self.sizes[at]
            ids = gather(self.ids, self.begins[at], sizes)
            of_text = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
            yield from np.split(ids, of_text[1:-1])

    def decode(self, ids: np.ndarray) -> bytes:
        return self.texts.join(ids)

    def spelled(self, ids: np.ndarray) -> bytes:
        return self.numbers.join(ids)


def runs(texts: list[str], letters: int = 500_000) -> Iterator[tuple[int, int]]:
    """Cut a list of texts into runs of about so many letters."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= letters:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


@one_table
def codec(path: str) -> WordCodec:
    return WordCodec(merge_table(path))


def bpe_encode(df: DataFrame, text: str = "text", ids: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """Add the token ids of each whole text as an array column."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)

    @F.pandas_udf("array<int>")
    def encoded(texts: pd.Series) -> pd.Series:
        return pd.Series(list(codec(path).encode(texts.fillna("").tolist())), dtype=object)

    return df.withColumn(ids, encoded(F.col(text)))


def bpe_decode(df: DataFrame, ids: str = "ids", text: str = "decoded", tokenizer: str | None = None) -> DataFrame:
    """Add the text of each array of ids; null decodes to the empty text."""
    path = tokenizer or public_tokenizers.path(TOKENIZER)

    @F.pandas_udf("string")
    def decoded(arrays: pd.Series) -> pd.Series:
        decode = codec(path).decode
        return pd.Series(
            [decode(np.array([] if a is None else a, np.int64)).decode() for a in arrays], dtype=object
        )

    return df.withColumn(text, decoded(F.col(ids)))


def bpe_round_trip(df: DataFrame, key: str, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Encode each text, decode its ids, and return the key with digests of both.

    Ids and decoded texts are several times the size of the text; here they stay inside
    the task that made them.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    rows = df.select(F.col(key), F.col(text).alias(f"{key}_text"))
    kind = f"`{key}` {df.schema[key].dataType.simpleString()}"

    @handed_back
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = codec(path)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for _, texts in stretches(batch.column(1)):
                for ids in words.encode(texts):
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(words.spelled(ids)).hexdigest())
                    of_text.append(hashlib.sha256(words.decode(ids)).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(digests, f"{kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
