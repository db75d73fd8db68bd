"""Counts of runs of symbols, packed and sorted by number before any row is made."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 23  # symbols that are sorted at once
_TAG = re.compile("<[^>]*>")


def _symbols(text: str, numbers: dict[str, int]) -> np.ndarray:
    """A text's symbols as numbers: a character's code point, for ``<...>`` a number above all of those; spaces are none."""
    end = text.rfind(">") + 1
    parts, at = [], 0
    for found in _TAG.finditer(text, 0, end):
        parts += [_points(text[at:found.start()]), np.array([0x110000 + numbers.setdefault(found.group(), len(numbers))], np.uint32)]
        at = found.end()
    parts.append(_points(text[at:]))
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


def _points(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return points[points != 32]


def _summed(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different keys of sorted ones, and how often each occurs."""
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.diff(np.append(at, len(keys))) if n is None else np.add.reduceat(n, at)


def _runs(symbols: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows of symbols, n) of the runs of up to ``longest`` symbols; 0 ends a text, and no run crosses it."""
    there = np.zeros(int(symbols.max()) + 1, bool)
    there[symbols] = True
    alphabet = np.flatnonzero(there)  # 0 comes first, as the last text has an end too
    place = np.zeros(len(there), np.uint64)
    place[alphabet] = np.arange(len(alphabet))
    code = np.concatenate([place[symbols], np.zeros(longest, np.uint64)])
    bits = max(1, int(len(alphabet) - 1).bit_length())
    count = len(symbols)
    if bits * longest <= 64:
        key = np.zeros(count, np.uint64)
        for k in range(longest):
            key = key << np.uint64(bits) | code[k:k + count]
        key.sort()
        key, n = _summed(key)
        for length in range(longest, 0, -1):
            digits = np.stack([(key >> np.uint64(bits * (length - 1 - k))).astype(np.uint64) & np.uint64((1 << bits) - 1) for k in range(length)], 1)
            whole = (digits > 0).all(1)
            yield length, alphabet[digits[whole].astype(np.int64)], n[whole]
            key, n = _summed(key >> np.uint64(bits), n)
        return
    place = np.arange(count)  # more symbols than fit a key: runs get numbers, which the next symbol makes longer
    rank = np.zeros(count, np.uint64)
    for length in range(1, longest + 1):
        more = code[place + length - 1]
        place, rank, more = place[more > 0], rank[more > 0], more[more > 0]
        _, first, rank, n = np.unique(rank * np.uint64(len(alphabet)) + more, return_index=True, return_inverse=True, return_counts=True)
        rank = rank.astype(np.uint64)
        yield length, alphabet[np.stack([code[place[first] + k] for k in range(length)], 1).astype(np.int64)], n


def _strings(rows: np.ndarray, names: list[str]) -> list[str]:
    """The symbols of each row joined."""
    tags = (rows >= 0x110000).any(1)
    plain = np.ascontiguousarray(rows[~tags]).astype(np.uint32)
    out = np.empty(len(rows), object)
    joined, size = plain.tobytes().decode("utf-32-le"), rows.shape[1]
    out[~tags] = [joined[k:k + size] for k in range(0, len(joined), size)]
    out[tags] = ["".join(names[x - 0x110000] if x >= 0x110000 else chr(x) for x in row) for row in rows[tags].tolist()]
    return out.tolist()


def _counted(batches: Iterable[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    numbers: dict[str, int] = {}
    texts: list[np.ndarray] = []
    size = 0

    def counted() -> Iterator[pa.RecordBatch]:
        nonlocal size
        symbols, names = np.concatenate(texts), list(numbers)
        texts.clear()
        numbers.clear()
        size = 0
        for length, rows, n in _runs(symbols, longest):
            for k in range(0, len(n), 1 << 16):
                part = n[k:k + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), length)), pa.array(_strings(rows[k:k + len(part)], names), pa.string()), pa.array(part.astype(np.int64))], ["length", "ngram", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                texts += [_symbols(text, numbers), np.zeros(1, np.uint32)]
                size += len(text)
                if size >= CHUNK:
                    yield from counted()
    if texts:
        yield from counted()


def symbol_runs(df: DataFrame, text: str, longest: int, least: int) -> DataFrame:
    """(length, ngram, n) of runs of 1 to ``longest`` symbols, as ``text.symbol_ngrams`` has them, that occur ``least`` times in all rows.

    A task counts runs of some millions of symbols at a time, so what is
    shuffled are its different runs. Exact whatever symbols there are.
    """
    counted = df.select(text).mapInArrow(lambda batches: _counted(batches, longest), "length long, ngram string, n long")
    return counted.groupBy("length", "ngram").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
