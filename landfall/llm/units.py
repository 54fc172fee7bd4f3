"""Texts cut into units that are encoded apart, each distinct one once in a Python worker."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd

from landfall.llm.arrays import U64, Rolling, flat, mixed, ranges


def points_of(column) -> tuple[str, np.ndarray, np.ndarray]:
    """All texts in a row, their code points, and where each text starts, with the end."""
    data, offsets = flat(column)
    text = data.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return text, points, np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]


class UnitCache:
    """Ids of units, kept by a hash of the unit; emptied when it holds ``most`` units."""

    def __init__(self, encode: Callable[[list[str]], list[np.ndarray]], most: int = 1_000_000):
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.slots: dict[int, int] = {}
        self.first = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.int32)
        self.used = 0

    def _add(self, keys: list[int], lists: list[np.ndarray]) -> None:
        n, total = len(self.slots), sum(map(len, lists))
        while n + len(keys) > len(self.first):
            self.first, self.count = np.append(self.first, self.first * 0), np.append(self.count, self.count * 0)
        while self.used + total > len(self.ids):
            self.ids = np.append(self.ids, self.ids * 0)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        self.first[n : n + len(keys)] = self.used + np.cumsum(sizes) - sizes
        self.count[n : n + len(keys)] = sizes
        if total:
            self.ids[self.used : self.used + total] = np.concatenate(lists)
        self.used += total
        self.slots.update(zip(keys, range(n, n + len(keys))))

    def encoded(self, text: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units ``starts`` to ``ends`` of ``text``, one after the other, and how many each has."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        values = mixed(points.astype(U64) + U64(0x51))
        keys = Rolling(values).of(starts, ends) ^ (ends - starts).astype(U64)
        which, distinct = pd.factorize(keys)
        if len(self.slots) + len(distinct) > self.most:
            self.clear()
        known = distinct.tolist()
        new = [k for k, key in enumerate(known) if key not in self.slots]
        if new:
            at = np.zeros(len(distinct), np.int64)
            at[which[::-1]] = np.arange(len(which))[::-1]
            units = [text[s:e] for s, e in zip(starts[at[new]].tolist(), ends[at[new]].tolist())]
            self._add([known[k] for k in new], self.encode(units))
        slots = np.fromiter(map(self.slots.__getitem__, known), np.int64, len(known))[which]
        counts = self.count[slots]
        return self.ids[ranges(self.first[slots], counts)], counts
