"""A bounded table of results in a Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any


class Remembered:
    """Results by key in two generations; when the new one is full, the old one is forgotten.

    Keys in use move to the new generation, so frequent ones stay.
    """

    def __init__(self, size: int):
        self.size = size
        self.new: dict[Any, Any] = {}
        self.old: dict[Any, Any] = {}

    def get(self, key: Any) -> Any:
        found = self.new.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: Any, value: Any) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value

    def missing(self, keys: Iterable[Any]) -> Iterator[Any]:
        """Keys without a result; those of the old generation move on. Put results while iterating."""
        for key in keys:
            if key not in self.new:
                found = self.old.get(key)
                if found is None:
                    yield key
                else:
                    self.new[key] = found

    def turn(self) -> None:
        """Start a new generation if the current one is full; between texts, so that one text finds all its keys."""
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}


class Made(dict):
    """Results by key, each made when first asked for, in two generations as above; ``made[key]`` is all that it takes.

    Those of keys longer than ``LONG`` are not kept.
    """

    LONG = 64

    def __init__(self, size: int, make: Callable[[str], Any]):
        self.size, self.make = size, make
        self.old: dict[str, Any] = {}

    def __missing__(self, key: str) -> Any:
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= self.LONG:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found

    def forget(self) -> None:
        self.clear()
        self.old = {}
