"""What a Python worker holds: the tables of one operator, and texts a few at a time.

Spark uses its Python workers again, for other tasks and other operators. So a worker keeps
the tables of the operator it last worked for and no others, turns Arrow's texts into
Python's a stretch at a time, and hands memory back when a task ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

T = TypeVar("T")

# Bytes of text a worker looks at together.
STRETCH = 500_000

_held: list = [None, None]


def hand_back() -> None:
    """Give memory that Arrow and the allocator keep for later back to the system."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def begin(operator: str) -> None:
    """Work for this operator begins: tables of another one go."""
    _hold((operator,), lambda: None)


def _hold(key: tuple, make: Callable[[], T]) -> T:
    if _held[0] != key:
        _held[:] = [None, None]
        hand_back()
        _held[:] = [key, make()]
    return _held[1]


def one_table(make: Callable[..., T]) -> Callable[..., T]:
    """A function that makes an operator's table: made once for the same arguments, as long
    as the worker serves no other operator."""

    @wraps(make)
    def table(*args):
        return _hold((make.__module__, make.__qualname__, args), lambda: make(*args))

    return table


def stretches(texts: pa.Array, size: int = STRETCH, most: int | None = None) -> Iterator[tuple[int, list]]:
    """The texts of a column some at a time, about ``size`` bytes, at most ``most`` texts:
    the number of the first, and the texts; null is the empty text."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    stretch = np.cumsum(lengths) // size
    nothing = b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else ""
    edges = [0, *(np.flatnonzero(np.diff(stretch)) + 1).tolist(), len(lengths)]
    for a, b in zip(edges, edges[1:]):
        for first in range(a, b, most or max(1, b - a)):
            part = texts.slice(first, min(most or b, b - first) if most else b - first)
            yield first, [nothing if x is None else x for x in part.to_pylist()]


def handed_back(of_batches: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a task that hands memory back when the task ends."""

    @wraps(of_batches)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from of_batches(batches)
        finally:
            hand_back()

    return run
