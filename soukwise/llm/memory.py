"""A bounded memory of computed values, for Python workers."""

from __future__ import annotations

from collections.abc import Callable
from typing import Generic, TypeVar

K, V = TypeVar("K"), TypeVar("V")


class Remembered(dict, Generic[K, V]):
    """Computes a missing value and keeps it. Once ``size`` values are held, the
    least recently computed half-generation is dropped, except for what is asked again.

    As a ``dict`` it answers ``memory[key]`` without a Python call where the value is known.
    """

    def __init__(self, compute: Callable[[K], V], size: int) -> None:
        super().__init__()
        self.compute, self.size, self.older = compute, size, {}

    def __missing__(self, key: K) -> V:
        if key in self.older:
            value = self.older[key]
        else:
            value = self.compute(key)
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value
