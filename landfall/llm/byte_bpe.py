"""Byte-level BPE ids of texts: texts are cut as the tokenizer cuts them, and each distinct piece is encoded once."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from landfall.llm.units import UnitCache, points_of

TOKENIZER = "byte_bpe_50k.json"
UNIT_CACHE = 600_000
UNSEEN, SPACE, LETTER, NUMBER, OTHER = 255, 0, 1, 2, 3
# Endings that the tokenizer's pattern takes apart after an apostrophe.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class Cutter:
    """The tokenizer of a file, and the class its pattern puts each character into, asked when one is first seen."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.classes = np.full(0x110000, UNSEEN, np.uint8)
        self.line = self._ids("\n")
        self.cache = UnitCache(self.encode_units, UNIT_CACHE)
        self.size = self.tokenizer.get_vocab_size()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _class_of(self, char: str) -> int:
        for known, kind in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
            if self.tokenizer.pre_tokenizer.pre_tokenize_str(f"{known}{char}")[0][1][1] == 2:
                return kind
        return SPACE

    def classes_of(self, points: np.ndarray) -> np.ndarray:
        kinds = self.classes[points]
        if (kinds == UNSEEN).any():
            for point in np.unique(points[kinds == UNSEEN]).tolist():
                self.classes[point] = self._class_of(chr(point))
            kinds = self.classes[points]
        return kinds

    def starts(self, points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pieces of all texts start.

        Letters, numbers and other signs make runs, each with one space before it.  Other
        white space is a piece of its own, and so is the last of a run before a sign that
        is no white space.  After an apostrophe that starts a piece some endings are cut off.
        """
        n = len(points)
        kinds = self.classes_of(points)
        space = kinds == SPACE
        first = np.zeros(n + 1, bool)
        border = np.zeros(n + 1, bool)
        border[offsets] = True
        changed = kinds[1:] != kinds[:-1]
        first[1:n] = changed & ~(space[:-1] & (points[:-1] == 0x20))
        # The last white space before a sign starts a piece, with the sign if it is a space.
        first[: n - 1] |= space[:-1] & ~space[1:] & ~border[1:n]
        first[1:n] |= space[1:] & ~space[:-1]
        first |= border
        self._cut_endings(points, kinds, first, border)
        return np.flatnonzero(first[:n])

    def _cut_endings(self, points, kinds, first, border) -> None:
        at = np.flatnonzero((points == 0x27) & first[: len(points)])
        for start in at.tolist():
            following = "".join(map(chr, points[start + 1 : start + 3].tolist()))
            for ending in ENDINGS:
                end = start + 1 + len(ending)
                if following.startswith(ending) and not border[start + 1 : end].any():
                    first[start + 1] = False
                    first[end] = True
                    break

    def encode_units(self, units: list[str]) -> list[np.ndarray]:
        """Ids of pieces: those that are no white space are encoded as lines of one text."""
        ids: list = [None] * len(units)
        lines = [k for k, unit in enumerate(units) if not unit.isspace() and "\n" not in unit]
        if lines and len(self.line) == 1:
            all_ids = np.array(self._ids("\n".join([units[k] for k in lines])), np.int32)
            cuts = np.flatnonzero(all_ids == self.line[0])
            if len(cuts) == len(lines) - 1:
                for k, s, e in zip(lines, np.append(0, cuts + 1).tolist(), np.append(cuts, len(all_ids)).tolist()):
                    ids[k] = all_ids[s:e]
        for k, unit in enumerate(units):
            if ids[k] is None:
                ids[k] = np.array(self._ids(unit), np.int32)
        return ids

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has; null is empty."""
        text, points, offsets = points_of(column)
        starts = self.starts(points, offsets)
        ids, sizes = self.cache.encoded(text, points, starts, np.append(starts[1:], len(points)))
        counts = np.diff(np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, offsets)])
        if not any(token in text for token in self.special):
            return ids, counts
        # A text with a special token is left to the tokenizer.
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for k, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            if any(token in text[s:e] for token in self.special):
                parts[k] = np.array(self._ids(text[s:e]), np.int32)
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))


@lru_cache(maxsize=2)
def cutter(path: str) -> Cutter:
    return Cutter(path)
