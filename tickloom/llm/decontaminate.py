"""Passages of benchmark questions and answers inside documents.

Both sides are normalised alike: A-Z in lower case, then words of digits, letters and
everything beyond ASCII. A window is ``WINDOW`` words in a row of an item; a shorter item
is one window. One Aho-Corasick automaton holds all windows, each with a blank before and
after; a document is scanned once, whatever the number of items, and the matches are
mapped back to words and to letters of the original text.

Nothing is shuffled. The automaton grows with the benchmark, not with the documents, and
is cut into blocks of ``BLOCK_LETTERS`` letters of windows: documents are scanned once for
each block, with a written table in between, so a benchmark of any size fits a task.

Cases: null and empty texts, of documents or items, have no words, so nothing is hit.
Items with equal windows all count; rows with the same item id count once. An item without
an id marks words but is not listed. Without items, or without documents, the result says
so with zeros or no rows. A column called like the result is replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.frames import free_name
from tickloom.llm.workers import hand_back, one_table, stretches
from tickloom.workspace import settle

WINDOW = 10
# Letters of all windows in one automaton, which takes some 60 bytes for each.
BLOCK_LETTERS = 2_000_000

#: What becomes of each byte: A-Z turn into lower case, what is no part of a word a blank.
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)

SPAN = pa.struct([(x, pa.int64()) for x in ("first_word", "end_word", "begin", "end")])
FOUND = pa.struct(
    [("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(SPAN)), ("items", pa.list_(pa.string()))]
)
FOUND_SQL = (
    "struct<n_words:bigint,n_hit:bigint,"
    "spans:array<struct<first_word:bigint,end_word:bigint,begin:bigint,end:bigint>>,items:array<string>>"
)

Window = tuple[bytes, int, tuple[str, ...]]


def plain(text: bytes) -> bytes:
    """The text as its words in lower case, blanks elsewhere; as long as before."""
    return text.translate(_BYTES)


def windows_of(text: bytes, size: int = WINDOW) -> Iterator[tuple[bytes, int]]:
    """Windows of an item, with a blank on both sides, and their number of words."""
    words = plain(text).split()
    for i in range(max(1, len(words) - size + 1) if words else 0):
        part = words[i : i + size]
        yield b" " + b" ".join(part) + b" ", len(part)


def window_blocks(
    items: DataFrame, item_id: str, text: str, size: int = WINDOW, letters: int = BLOCK_LETTERS
) -> Iterator[list[Window]]:
    """Windows of all items with the ids of the items that have them, in blocks.

    Items come to the driver a few at a time, in the order of windows, so that equal
    windows meet in one block; it never holds more than a block.
    """
    id_text = F.col(item_id).cast("string")
    rows = items.select(id_text.alias("id"), F.col(text).cast("binary").alias("text"))
    rows = rows.filter(F.col("text").isNotNull()).mapInArrow(_windows(size), "id string, window binary, words int")
    block: dict[bytes, tuple[int, list[str]]] = {}
    held = 0
    for row in rows.distinct().orderBy("window", "id").toLocalIterator():
        window = bytes(row["window"])
        if window not in block:
            if held > letters:
                yield [(w, n, tuple(ids)) for w, (n, ids) in block.items()]
                block, held = {}, 0
            block[window] = row["words"], []
            held += len(window)
        if row["id"] is not None:
            block[window][1].append(row["id"])
    yield [(w, n, tuple(ids)) for w, (n, ids) in block.items()]


def _windows(size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (number, window, words)
                for number, text in zip(*(column.to_pylist() for column in batch.columns))
                for window, words in windows_of(text, size)
            ]
            columns = [list(column) for column in zip(*rows)] or [[], [], []]
            kinds = (pa.string(), pa.binary(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], ["id", "window", "words"])

    return cut


class Scanner:
    """The automaton of a block of windows."""

    def __init__(self, windows: list[Window]):
        self.windows = windows
        self.automaton = ahocorasick.Automaton()
        for i, (window, _, _) in enumerate(windows):
            self.automaton.add_word(window.decode("latin-1"), i)
        self.automaton.make_automaton()

    def scan(self, text: bytes, before: dict | None = None) -> dict:
        """Words, hit words, their spans and the items, with those found ``before``."""
        same_length = plain(text)
        words = same_length.split()
        found = {"n_words": len(words), "n_hit": 0, "spans": [], "items": []}
        if before:
            found |= {k: before[k] for k in ("n_hit", "spans", "items")}
        if not words or not self.windows:
            return found
        line = b" " + b" ".join(words) + b" "
        matches = list(self.automaton.iter(line.decode("latin-1")))
        if not matches:
            return found
        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
        index = np.fromiter((i for _, i in matches), np.int64, len(matches))
        ends = np.searchsorted(blanks, np.fromiter((at for at, _ in matches), np.int64, len(matches)))
        sizes = np.fromiter((self.windows[i][1] for i in index.tolist()), np.int64, len(index))
        # How many windows begin, less those that end, up to each word.
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, ends - sizes, 1)
        np.add.at(depth, ends, -1)
        hit = np.cumsum(depth)[:-1] > 0
        for span in found["spans"]:
            hit[span["first_word"] : span["end_word"]] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))).reshape(-1, 2)
        begin, end = word_bounds(same_length, text)
        found["n_hit"] = int(hit.sum())
        found["spans"] = [
            {"first_word": int(a), "end_word": int(b), "begin": int(begin[a]), "end": int(end[b - 1])}
            for a, b in edges
        ]
        items = {item for i in set(index.tolist()) for item in self.windows[i][2]}
        found["items"] = sorted(items.union(found["items"]))
        return found


def word_bounds(same_length: bytes, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First letter and end of each word, counted in letters of the original text."""
    letter = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    number = np.concatenate([[0], np.cumsum(letter)])
    inside = np.concatenate([[False], np.frombuffer(same_length, np.uint8) != 0x20, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
    return number[edges[:, 0]], number[edges[:, 1]]


@one_table
def _scanner(windows: Broadcast) -> Scanner:
    return Scanner(windows.value)


def find_passages(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    result: str = "contamination",
    window: int = WINDOW,
    block_letters: int = BLOCK_LETTERS,
) -> DataFrame:
    """Add a struct: ``n_words``, ``n_hit``, ``spans`` (words and letters from and to),
    and the sorted ``items`` whose windows occur."""
    nothing = F.lit(None).cast(FOUND_SQL)
    found = docs.withColumn(result, nothing) if result not in docs.columns else docs.drop(result).withColumn(result, nothing)
    context = docs.sparkSession.sparkContext
    for i, block in enumerate(window_blocks(items, item_id, item_text, window, block_letters)):
        if i:
            found = settle(found, "passages")
        found = found.withColumn(result, _scan_udf(context.broadcast(block))(F.col(text).cast("binary"), F.col(result)))
    return found


def _scan_udf(windows: Broadcast):
    @F.arrow_udf(FOUND_SQL)
    def scan(texts: pa.Array, before: pa.Array) -> pa.Array:
        scanner = _scanner(windows)
        parts = []
        for first, some in stretches(texts):
            known = before.slice(first, len(some)).to_pylist()
            parts.append(pa.array([scanner.scan(x, y) for x, y in zip(some, known)], FOUND))
        hand_back()
        return pa.concat_arrays(parts) if parts else pa.array([], FOUND)

    return scan


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text", **names: str) -> DataFrame:
    """The documents without a word of any window."""
    found = free_name(docs, "contamination")
    return find_passages(docs, items, text, result=found, **names).filter(F.col(f"{found}.n_hit") == 0).drop(found)
