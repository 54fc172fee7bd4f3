"""Language of documents by cross-parsing entropy against labelled text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.arrays import flat, pieces, ranges, slices
from landfall.llm.tables import held_out, learnable, share_of_hash

# Bounds of what is learned from: documents of a language, characters of one of them,
# letters of a language in all, languages, and letters that are a symbol of their own; if
# there are more, the others are spelled as their UTF-8 bytes.
SAMPLE_DOCS = 64
PIECE_CHARS = 1_000
TRAIN_SYMBOLS = 32_768
LANGUAGES = 64
LETTERS = 62
# Texts are parsed in stretches of so many symbols, each starting a new phrase.
STRETCH = 1_024
SLICE_BYTES = 1 << 20
UNKNOWN = "und"
# A text that costs more bits a symbol than naming each of the letters would is in none of the languages.
MOST_BITS = float(np.log2(LETTERS + 2))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions, by state, of the smallest automaton of all substrings; the first state is the root."""
    step, link, length, last = [{}], [-1], [0], 0
    for symbol in symbols:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and symbol not in step[p]:
            step[p][symbol] = new
            p = link[p]
        if p >= 0:
            q = step[p][symbol]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(symbol) == q:
                    step[p][symbol] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


def parsing_table(symbols: list[int], alphabet: int) -> np.ndarray:
    """For each state and symbol twice the place of the next state's row, plus one where the longest match ends.

    Where no match goes on, the symbol begins the next phrase at the root; the last
    symbol of the alphabet, for unknown letters, never matches.
    """
    steps = suffix_automaton(symbols)
    root = np.zeros(alphabet, np.int32)
    for symbol, state in steps[0].items():
        root[symbol] = state
    table = np.tile(root * alphabet * 2 + 1, (len(steps), 1)).astype(np.int32)
    at = [(state, symbol, nxt) for state, step in enumerate(steps) for symbol, nxt in step.items()]
    states, symbols_, nexts = np.array(at, np.int32).reshape(-1, 3).T
    table[states, symbols_] = nexts * alphabet * 2
    table[:, alphabet - 1] = 1
    return table.ravel()


@lru_cache(maxsize=1)
def letter_codes() -> np.ndarray:
    """For each code point its lower-case form if it is a letter, else 0."""
    codes = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        if (char := chr(point)).isalpha():
            low = char.lower()
            codes[point] = ord(low) if len(low) == 1 else point
    return codes


def letters_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of the texts with 0 for each run of other characters, and where each text starts."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    letters, starts = letter_codes()[points], before[offsets]
    keep = np.ones(len(letters), bool)
    keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0)
    keep[starts[:-1][starts[:-1] < len(keep)]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return letters[keep], kept[starts]


class Languages:
    """Labelled text of each language, turned into automata on first use, in each Python worker."""

    def __init__(self, texts: dict[str, str]):
        self.names = sorted(texts)
        self.texts = [texts[name] for name in self.names]

    def tables(self) -> tuple[Alphabet, list[np.ndarray], np.ndarray, int]:
        return _tables(tuple(self.texts))


class Alphabet:
    """Symbols of letters: the most frequent have one each, the others one for each byte, if any of them is labelled.

    The last symbol is for what is in no labelled text.
    """

    def __init__(self, letters: Counter):
        known = sorted(sorted(letters), key=lambda c: -letters[c])
        spelled = sorted(set("".join(known[LETTERS:]).encode()))
        known = known[:LETTERS]
        self.size = len(known) + len(spelled) + 2
        self.symbol = np.full(0x110000, self.size - 1, np.uint8)
        self.symbol[0] = 0
        for k, char in enumerate(known, 1):
            self.symbol[ord(char)] = k
        self.byte = np.full(256, self.size - 1, np.uint8)
        self.byte[spelled] = np.arange(len(known) + 1, self.size - 1)
        self.spells = bool(spelled)

    def symbols(self, letters: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts in a row, and where each text starts, with the end."""
        symbols = self.symbol[letters]
        rest = symbols == self.size - 1
        if not self.spells or not rest.any():
            return symbols, starts
        points = letters[rest]
        counts = np.ones(len(letters), np.int64)
        counts[rest] = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        place = np.concatenate([[0], np.cumsum(counts)])
        out = np.repeat(symbols, counts)
        held = np.frombuffer(points.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        out[ranges(place[:-1][rest], counts[rest])] = self.byte[held]
        return out, place[starts]


@lru_cache(maxsize=1)
def _tables(texts: tuple[str, ...]):
    counts = Counter("".join(texts))
    counts.pop("\0", None)
    alphabet = Alphabet(counts)
    letters = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
    trained = [alphabet.symbols(own, np.zeros(1, np.int64))[0].tolist() for own in letters]
    bits = np.log2([max(2, len(t)) for t in trained])
    return alphabet, [parsing_table(t, alphabet.size) for t in trained], bits, alphabet.size


def phrases(symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, table: np.ndarray) -> np.ndarray:
    """How many longest matches with the labelled text each stretch is parsed into, besides the last.

    Stretches must be in order of falling length; all advance together by one symbol.
    """
    ended = np.zeros(len(starts), np.int64)
    place = np.zeros(len(starts), np.int64)
    if not len(starts):
        return ended
    active = np.searchsorted(-lengths, -np.arange(int(lengths[0])), "left")
    for k, n in enumerate(active.tolist()):
        found = table[place[:n] + symbols[starts[:n] + k]]
        np.right_shift(found, 1, out=place[:n], casting="unsafe")
        ended[:n] += found & 1
    return ended


def _predict(column, languages: Languages) -> tuple[list[str], np.ndarray, np.ndarray]:
    alphabet, tables, bits, _ = languages.tables()
    data, offsets = flat(column)
    letters, starts = letters_of(data, offsets)
    wordy = np.concatenate([[0], np.cumsum(letters != 0)])
    some = (wordy[starts[1:]] - wordy[starts[:-1]]) > 0
    symbols, starts = alphabet.symbols(letters, starts)
    sizes = np.diff(starts)
    parts = -(-sizes // STRETCH)
    owner = np.repeat(np.arange(len(sizes)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = starts[:-1][owner] + nth * STRETCH
    length = np.minimum(STRETCH, starts[1:][owner] - first)
    order = np.argsort(-length, kind="stable")
    code = np.zeros((len(tables), len(sizes)))
    for k, table in enumerate(tables):
        ended = phrases(symbols, first[order], length[order], table)
        code[k] = np.bincount(owner[order], ended, len(sizes)) * bits[k]
    if not len(tables):
        return [UNKNOWN] * len(sizes), np.zeros(len(sizes)), np.zeros(len(sizes))
    best = code.argmin(axis=0)
    least = code.min(axis=0)
    share = 1 / np.exp2(np.maximum(least - code, -1000)).sum(axis=0)
    names = [languages.names[b] if s else UNKNOWN for b, s in zip(best, some)]
    return names, np.where(some, share, 0.0), np.where(some, least / np.maximum(1, sizes), 0.0)


def learn(docs: DataFrame) -> Languages:
    """Labelled text of each language from at most about ``SAMPLE_DOCS`` documents of it.

    Documents are chosen by a hash of the doc_id, and so is the piece taken of a long one.
    Of all documents only counts by language and that sample reach the driver.
    """
    known = docs.where(learnable(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().limit(LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not counts:
        return Languages({})
    share = share_of_hash(F.col("doc_id"))
    wanted = F.lit(False)
    for lang, n in counts.items():
        wanted = wanted | ((F.col("lang") == lang) & (share < 2 * SAMPLE_DOCS / n))
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.length("text") - PIECE_CHARS + 1)).cast("int") + 1
    rows = (
        known.where(wanted)
        .select("lang", F.substring(F.col("text"), place, F.lit(PIECE_CHARS)).alias("piece"), share.alias("share"), "doc_id")
        .orderBy("share", "doc_id")
        .collect()
    )
    pieces: dict[str, list[str]] = {}
    for row in rows:
        pieces.setdefault(row["lang"], []).append(row["piece"])
    texts = {}
    for lang, own in pieces.items():
        data, offsets = flat(pa.array(own[:SAMPLE_DOCS]))
        letters, _ = letters_of(data, offsets)
        texts[lang] = letters[:TRAIN_SYMBOLS].astype("<u4").tobytes().decode("utf-32-le")
    return Languages(texts)


def languages_of(docs: DataFrame, learned_from: DataFrame | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` (0 to 1) and ``bits`` for every row.

    The whole text is parsed, for each language, into the longest stretches found in its
    labelled text; the language with the fewest phrases, each at the cost of a place
    in that text, wins, the first by name of equal ones.  ``bits`` is that cost for each
    symbol, a letter or one byte of a rare one.  Texts that are null, empty or without a letter are ``und`` with score 0, as are
    all if no language is known.  A null doc_id is predicted, never learned from; repeated
    rows give repeated rows; other columns do not matter.
    """
    held = docs.sparkSession.sparkContext.broadcast(learn(docs if learned_from is None else learned_from))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            names, share, bits = _predict(batch.column("text"), held.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(share), pa.array(bits)],
                ["doc_id", "lang_pred", "score", "bits"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(predict, "doc_id bigint, lang_pred string, score double, bits double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits"
    )


def in_a_language(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows in no language: those that are ``und``, or that no language explains better than chance.

    Languages are learned from ``lang`` of ``docs`` itself; if none is known, all rows stay that have a letter.
    """
    held = docs.sparkSession.sparkContext.broadcast(learn(docs))

    def kept(text: pa.Array) -> pa.Array:
        found = []
        for part in pieces(text, SLICE_BYTES):
            if held.value.names:
                names, _, bits = _predict(part, held.value)
                found += [n != UNKNOWN and b <= MOST_BITS for n, b in zip(names, bits.tolist())]
            else:
                found += [any(map(str.isalpha, t or "")) for t in part.to_pylist()]
        return pa.array(found, pa.bool_())

    # Only the texts go to Python, and one answer a row comes back.
    return docs.where(F.arrow_udf(kept, "boolean")(F.col("text").cast("string")))
