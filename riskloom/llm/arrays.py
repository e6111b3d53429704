"""Words, shingles and 64-bit hashes of Arrow string columns, without a loop over rows.

A word is what ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` finds once A-Z is lower case: runs of
ASCII letters and digits and of everything beyond ASCII. In UTF-8 that is decided byte by
byte, so the functions below work on the value buffer of a column as it is. Hashes are
polynomials over random 64-bit values of the bytes; equal words have equal hashes on every
machine. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_U64 = np.uint64
_GOLDEN = _U64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
# Bytes hashed at once; bounds the scratch arrays whatever the length of a text.
BLOCK = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    with np.errstate(over="ignore"):
        x = x + _GOLDEN
        x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
        return x ^ (x >> _U64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_VALUE = mixed(np.arange(1, 257, dtype=_U64))[_LOWER]


def _powers(of: int) -> np.ndarray:
    out = np.empty(BLOCK + 1, dtype=_U64)
    out[0] = 1
    done = 1
    while done <= BLOCK:
        step = min(done, BLOCK + 1 - done)
        out[done : done + step] = out[:step] * _U64(pow(of, done, 1 << 64))
        done += step
    return out


_POWER, _POWER_BACK = _powers(_BASE), _powers(_INVERSE)


class Words(NamedTuple):
    """Words of several texts: hash and bytes of each, and where each text begins."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # words of text i are bounds[i]:bounds[i + 1]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of every text; null reads as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    values = column.buffers()[2]
    data = np.frombuffer(values, dtype=np.uint8) if values else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    hashes = np.empty(len(starts), dtype=_U64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(int(np.searchsorted(ends, low + BLOCK, side="right")), at + 1)
        high = ends[to - 1]
        if high - low > BLOCK:  # one word longer than a block
            hashes[at] = _long_word(data[low:high])
        else:
            total = np.zeros(high - low + 1, dtype=_U64)
            np.cumsum(_VALUE[data[low:high]] * _POWER[: high - low], out=total[1:])
            s, e = starts[at:to] - low, ends[at:to] - low
            hashes[at:to] = (total[e] - total[s]) * _POWER_BACK[s]
        at = to
    return mixed(hashes ^ (ends - starts).astype(_U64))


def _long_word(data: np.ndarray) -> np.uint64:
    total = 0
    for at in range(0, len(data), BLOCK):
        part = data[at : at + BLOCK]
        value = int((_VALUE[part] * _POWER[: len(part)]).sum(dtype=_U64))
        total += value * pow(_BASE, at, 1 << 64)
    return _U64(total % (1 << 64))


def spans_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every word, and the byte after its last, of all texts."""
    inside = _IS_WORD[data]
    if not len(inside):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < len(data))]  # words end where a text ends
    begins[cut] |= inside[cut]
    stops[cut - 1] |= inside[cut - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """All words of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    starts, ends = spans_of(data, offsets)
    return Words(
        _word_hashes(data, starts, ends), starts, ends, np.searchsorted(starts, offsets)
    )


def combined(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of several hash columns, in order."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(columns[0]), dtype=_U64)
        for column in columns:
            total = mixed(total * _U64(3) + column)
    return total


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` neighbouring values; shorter by size - 1."""
    n = max(0, len(hashes) - size + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n, dtype=_U64)
        for i in range(size):
            total += hashes[i : i + n] * _U64(pow(_BASE, i + 1, 1 << 64))
    return mixed(total)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and the bounds per text.

    A text of fewer words, but not none, has one shingle: all its words.
    """
    runs = run_hashes(words.hashes, size)
    counts = np.diff(words.bounds)
    short = (counts > 0) & (counts < size)
    per_text = np.where(short, 1, np.maximum(counts - size + 1, 0))
    bounds = np.concatenate(([0], np.cumsum(per_text)))
    out = np.empty(bounds[-1], dtype=_U64)
    long_ones = np.flatnonzero(counts >= size)
    take = ragged(words.bounds[:-1][long_ones], per_text[long_ones])
    put = ragged(bounds[:-1][long_ones], per_text[long_ones])
    out[put] = runs[take]
    for i in np.flatnonzero(short):
        own = words.hashes[words.bounds[i] : words.bounds[i + 1]]
        out[bounds[i]] = combined([own[j : j + 1] for j in range(len(own))])[0]
    return out, bounds


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All of start, start + 1, ... start + length - 1, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    out = np.arange(total, dtype=np.int64)
    return out + np.repeat(starts - (ends - lengths), lengths)


def distinct_runs(values: np.ndarray, bounds: np.ndarray):
    """Distinct values of every text, sorted within it: owner, value, and times seen."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    first = np.ones(len(values), dtype=bool)
    first[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    return owner[at], values[at], np.diff(np.append(at, len(values)))


def chunks(column: pa.Array, most: int = 2 * BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text, or of one row."""
    _, offsets = text_buffer(column)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = max(to, at + 1)
        yield at, to
        at = to


def signed(values: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark's bigint."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))
