"""Words of whole Arrow batches of texts, without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task splits into words at a time; a longer text is a block of its own.
BLOCK_BYTES = 4_000_000


class Split(NamedTuple):
    """The words of some texts, one after another: text `i` has those from `offsets[i]` to `offsets[i + 1]`."""

    words: pa.Array
    offsets: np.ndarray

    def owners(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def blocks_of(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """The texts, nulls as empty ones, in blocks of so many bytes, or one text, with the number of the first."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    block = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False) + 1) // BLOCK_BYTES
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(texts)]):
        yield int(start), texts[start:end]


def bytes_of(texts: pa.Array) -> np.ndarray:
    """All bytes of texts (large strings without nulls), one text after another."""
    _, offsets, data = texts.buffers()
    if data is None:
        return np.zeros(0, np.uint8)
    offsets = np.frombuffer(offsets, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[texts.offset] : offsets[texts.offset + len(texts)]]


def with_bytes(texts: pa.Array, data: np.ndarray) -> pa.Array:
    """Texts of the same lengths with other bytes."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(data))


def split(texts: pa.Array) -> Split:
    """Runs of characters other than blank and the ASCII controls from tab to carriage return."""
    lists = pc.ascii_split_whitespace(texts)
    found = lists.flatten()
    full = pc.greater(pc.binary_length(found), 0)  # blanks at the ends of a text give empty words
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    ends = lists.offsets.to_numpy()
    return Split(found.filter(full), before[ends - ends[0]])
