"""Words of a text: runs of characters other than blank and the five ASCII controls from tab to carriage return."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: As a regular expression, for Java, DuckDB and Python.
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """The words in UTF-8, with A-Z in lower case if asked for.

    `bytes.split` knows exactly these six separators, and `bytes.lower` only A-Z.
    """
    if not text:
        return []
    encoded = text.encode("utf-8", "surrogatepass")
    return encoded.lower().split() if lower else encoded.split()


def n_words(text: Column) -> Column:
    """Number of words; 0 for null.

    The separators become blanks, runs of them one, and blanks are counted: no array of the words is built.
    """
    blanks = F.trim(F.regexp_replace(F.translate(text, "\t\n\x0b\x0c\r", "     "), " +", " "))
    between = F.length(blanks) - F.length(F.replace(blanks, F.lit(" "), F.lit("")))
    return F.when(F.length(blanks) > 0, between + 1).otherwise(0).cast("long")


_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_FINAL = np.uint64(0xBF58476D1CE4E5B9)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _FINAL
    return values ^ (values >> np.uint64(31))


#: Bytes that a word is hashed by, and of a longer one a cryptographic digest is taken.
STEP, LONG = 8, 64
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(STEP + 1)], np.uint64)


class Words(NamedTuple):
    """The hashed words of some texts, in order, with the text and the line (counted over all texts) each is in."""

    token: np.ndarray
    text: np.ndarray
    line: np.ndarray
    #: The first line of each text.
    first_line: np.ndarray


def hashed_words(texts: list[str], lower: bool = False) -> Words:
    """All words at a time, as `hashes` has them."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*encoded, bytes(STEP)]), np.uint8)
    if lower:
        data = _LOWER[data]
    apart = _IS_SEPARATOR[data[:-STEP]]
    change = np.flatnonzero(np.diff(apart, prepend=True))
    starts, lengths = change[::2], np.diff(change)[::2]  # every text ends with a separator
    text_ends = np.cumsum([len(e) + 1 for e in encoded], dtype=np.int64)
    text = np.searchsorted(text_ends, starts, side="right")
    breaks = np.flatnonzero(data[:-STEP] == 10)
    line = np.searchsorted(breaks, starts)
    first_line = np.searchsorted(breaks, text_ends - 1) + 1
    first_line = np.concatenate([[0], first_line])[: len(texts)]
    return Words(hashes(data, starts, lengths), text, line, first_line)


def hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of the bytes from each start on. Behind the last ones STEP more bytes follow.

    Eight bytes at a time are added and mixed in. A step is one-to-one in these, so words of up to eight bytes and one
    length never share a hash; words of more than LONG bytes are hashed by their digest.
    """
    eights = np.ndarray(len(data) - STEP + 1, np.uint64, data.data, strides=(1,))
    value = lengths.astype(np.uint64) * _FACTOR
    left, done = np.arange(len(starts)), 0
    while len(left) and done < LONG:
        rest = lengths[left] - done
        eight = eights[starts[left] + done] & _MASKS[np.minimum(rest, STEP)]
        value[left] = mixed(value[left] * _FACTOR + eight)
        left, done = left[rest > STEP], done + STEP
    for i in left:
        word = data[starts[i] : starts[i] + lengths[i]].tobytes()
        value[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return mixed(value)
