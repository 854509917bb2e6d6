"""Byte-pair encoding and decoding with a given public vocabulary.

A word is a doubly linked list of symbols. A priority queue holds the neighbouring pairs that the vocabulary can
merge, lowest rank first and leftmost of equals. Merging a pair makes queued pairs of its neighbours stale; those are
skipped when they come up. Decoding concatenates the vocabulary strings of the ids.

The vocabulary is read by the driver from a tokenizer file and broadcast; its size is that of the file. Python runs
over Arrow batches, nothing is shuffled, and whole texts are encoded. A memo of encoded chunks, of bounded size, saves
most of the work, as words repeat.

Composition, lower case and the classes of letters and numbers come from Unicode tables, and Python, its regex package
and the tokenizers library have those of different years: the library orders some marks as they are that Python sorts,
and does not know the newest letters. Chunks beyond ASCII are therefore composed, lowered and split by the library's
steps of these names. Merging is done here for all.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendaria.llm.memo import Memo

#: Entries of each generation of a worker's two memos: about 150 MB if all are full.
MEMO_SIZE = 1 << 18

#: Characters encoded before rows are handed on, so that a batch of long texts is not held as ids all at once.
OUTPUT_CHARS = 1_000_000

_NOT_SPACE = regex.compile(r"\S+")
_SEPARATORS = regex.compile("[\x1c-\x1f]")  # Python's split() takes these for white space, the file's pattern doesn't


def _byte_symbols() -> list[str]:
    """A printable character for each byte: itself where it is one, else the next free one from 256 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    free = iter(range(256, 512))
    return [chr(b if b in printable else next(free)) for b in range(256)]


def _library_pieces(pattern: str) -> Callable[[str], list[str]]:
    """Composes, lowers and splits by the tokenizers library's Unicode tables."""
    from tokenizers import Regex, normalizers, pre_tokenizers

    lower = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
    split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
    return lambda chunk: [piece for piece, _ in split.pre_tokenize_str(lower.normalize_str(chunk))]


class WordBpe:
    """A vocabulary of byte-level symbols with a word-end suffix, as in a tokenizers JSON file."""

    def __init__(self, vocab: dict[str, int], merges: list, pattern: str, suffix: str, special: dict[str, int]):
        self.vocab, self.suffix, self.special = vocab, suffix, special
        self._merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self._merge[vocab[a], vocab[b]] = rank, vocab[a + b]
        self._pieces = pattern
        self.strings = {i: s for s, i in [*vocab.items(), *special.items()]}

    @classmethod
    def from_json(cls, text: str) -> WordBpe:
        """From a tokenizer file's text. Refuses one whose steps are other than those that this class takes."""
        spec = json.loads(text)
        model, (split, byte_level) = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if (steps, split["type"], byte_level["type"]) != (["NFC", "Replace", "Lowercase"], "Split", "ByteLevel"):
            raise ValueError("not a word-level tokenizer file")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        return cls(model["vocab"], model["merges"], split["pattern"]["Regex"], model["end_of_word_suffix"], special)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_c_")}

    def _compiled(self):
        if not hasattr(self, "_c_pieces"):
            self._c_pieces = regex.compile(self._pieces)
            self._c_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
            self._c_bytes = _byte_symbols()
            self._c_library = _library_pieces(self._pieces)
        return self._c_pieces, self._c_special, self._c_bytes

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge neighbours by rank until no pair of the vocabulary is left."""
        n = len(symbols)
        if n < 2:
            return symbols
        rules = self._merge
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        alive = list(symbols)
        queue = []
        for i in range(n - 1):
            if found := rules.get((alive[i], alive[i + 1])):
                queue.append((found[0], i, alive[i], alive[i + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, a, b, merged = heapq.heappop(queue)
            j = after[i]
            if alive[i] != a or j < 0 or alive[j] != b:
                continue  # stale: one of the two has been merged meanwhile
            alive[i], alive[j] = merged, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (found := rules.get((alive[left], alive[right]))):
                    heapq.heappush(queue, (found[0], left, alive[left], alive[right], found[1]))
        return [s for s in alive if s >= 0]

    def pieces(self, chunk: str) -> list[str]:
        """The words and marks of a text without white space or special tokens, in lower case."""
        ascii_pieces = self._compiled()[0]
        return ascii_pieces.findall(chunk.lower()) if chunk.isascii() else self._c_library(chunk)

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        to_symbol = self._compiled()[2]
        symbols = [to_symbol[b] for b in piece.encode()]
        symbols[-1] += self.suffix
        return tuple(self.merge([self.vocab[s] for s in symbols]))

    def parts(self, text: str) -> Iterator[str]:
        """A text's special tokens and its chunks between white space, in order. No piece reaches over either."""
        _, special, _ = self._compiled()
        if special is None or not any(s in text for s in self.special):
            yield from _chunks(text)
            return
        at = 0
        for found in special.finditer(text):
            yield from _chunks(text[at : found.start()])
            yield found.group()
            at = found.end()
        yield from _chunks(text[at:])

    def packed_encoder(self, memo_size: int = MEMO_SIZE) -> Callable[[str | None], bytes]:
        """A function from text to ids, as 32-bit numbers in a row.

        It remembers chunks, and fewer of the pieces that new chunks are made of.
        """
        known = Memo(lambda piece: _packed(self.encode_piece(piece)), max(1, memo_size // 2))

        def encode_part(part: str) -> bytes:
            if part in self.special:
                return _packed((self.special[part],))
            return b"".join([known[piece] for piece in self.pieces(part)])

        parts = Memo(encode_part, memo_size)
        return lambda text: b"".join([parts[p] for p in self.parts(text)]) if text else b""

    def encoder(self, memo_size: int = MEMO_SIZE) -> Callable[[str | None], list[int]]:
        """A function from text to ids."""
        packed = self.packed_encoder(memo_size)
        return lambda text: _unpacked(packed(text)).tolist()

    def decode(self, ids) -> str:
        """The vocabulary strings of the ids, joined by a blank: the file names no decoder that would do more."""
        return " ".join(map(self.strings.__getitem__, ids))


def _packed(ids: tuple[int, ...]) -> bytes:
    return array("i", ids).tobytes()


def _unpacked(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, np.int32)


def _chunks(text: str) -> list[str]:
    return _NOT_SPACE.findall(text) if _SEPARATORS.search(text) else text.split()


def load_tokenizer(path: str) -> WordBpe:
    """Read on the driver: the file belongs to the installation, not to the input."""
    with open(path, encoding="utf-8") as file:
        return WordBpe.from_json(file.read())


def encode(
    docs: DataFrame,
    bpe: WordBpe,
    text_col: str = "text",
    ids_col: str = "token_ids",
    decoded_col: str | None = None,
    memo_size: int = MEMO_SIZE,
) -> DataFrame:
    """Add the token ids of each whole text and, if a name is given, their decoded text.

    Every row stays, in place. A null text counts as empty and has no ids. Columns of the new names are replaced,
    the others kept. Very long texts are split into chunks like any other; no text is cut. A smaller memo takes less
    memory and more time.
    """
    kept = [f for f in docs.schema.fields if f.name not in (ids_col, decoded_col)]
    added = [T.StructField(ids_col, T.ArrayType(T.IntegerType()))]
    if decoded_col:
        added.append(T.StructField(decoded_col, T.StringType()))
    shared = docs.sparkSession.sparkContext.broadcast(bpe)
    # Columns go by number, as their names may hold anything.
    copied = [f"c{i}" for i in range(len(kept))]
    fields = [T.StructField(c, f.dataType, f.nullable) for c, f in zip(copied, kept, strict=True)]
    schema = T.StructType([*fields, *[T.StructField(f"new{i}", f.dataType) for i, f in enumerate(added)]])

    # The text is sent once: as the column that is kept, if it is one.
    at = next((i for i, f in enumerate(kept) if f.name == text_col and f.dataType == T.StringType()), len(kept))
    own = [] if at < len(kept) else [F.col(f"`{text_col}`").cast("string").alias("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = shared.value
        to_ids, to_text = tokenizer.packed_encoder(memo_size), tokenizer.decode
        for batch in batches:
            for rows in _by_size(batch, at):
                ids = [to_ids(t) for t in rows.column(at).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)]) // np.dtype(np.int32).itemsize
                new = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(_unpacked(b"".join(ids))))]
                if decoded_col:
                    texts = [to_text(_unpacked(i).tolist()) for i in ids]
                    new.append(pa.array(texts, rows.column(at).type))
                yield pa.RecordBatch.from_arrays([*rows.columns[: len(copied)], *new], schema.names)

    rows = docs.select(*[F.col(f"`{f.name}`").alias(c) for f, c in zip(kept, copied, strict=True)], *own)
    return rows.mapInArrow(run, schema).toDF(*[f.name for f in [*kept, *added]])


def _by_size(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Rows in a row whose texts have OUTPUT_CHARS characters together, or one text that has more."""
    sizes = pc.fill_null(pc.utf8_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    block = sizes.cumsum(dtype=np.int64) // OUTPUT_CHARS
    starts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
    for first, last in pairwise(starts):
        if first < last:
            yield batch.slice(first, last - first)


def decode(encoded: DataFrame, bpe: WordBpe, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """Add the text of each row's ids; null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(bpe)

    @F.pandas_udf("string")
    def text_of(ids: pd.Series) -> pd.Series:
        return ids.map(lambda row: "" if row is None else shared.value.decode(row))

    return encoded.withColumn(text_col, text_of(F.col(f"`{ids_col}`")))
