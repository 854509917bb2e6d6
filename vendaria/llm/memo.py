"""A memo of bounded size for what a Python worker computes again and again."""

from __future__ import annotations

from collections.abc import Callable


#: Longer keys are computed each time, so that the entries' number bounds the memory.
LONGEST_KEY = 64


class Memo(dict):
    """`memo[key]` is `compute(key)`. At most two generations of `size` entries are held.

    When the younger generation is full, the older is dropped. What is asked for again moves to the younger one, so
    frequent keys stay. The memo saves work and never changes a result.
    """

    def __init__(self, compute: Callable, size: int):
        super().__init__()
        self._compute, self._size, self._older = compute, size, {}

    def __missing__(self, key):
        if len(key) > LONGEST_KEY:
            return self._compute(key)
        if len(self) >= self._size:
            self._older = dict(self)
            self.clear()
        value = self._older.get(key)
        if value is None:
            value = self._compute(key)
        self[key] = value
        return value
