"""Words of many texts at once: spans and 64-bit hashes straight from the UTF-8 bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)

# Word separators: ASCII white space, or every ASCII byte that is no letter or digit.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.uint64), np.empty(0, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            factors = np.full(max(n, _CHUNK), base, np.uint64)
            factors[0] = 1
            tables.append(np.multiply.accumulate(factors))
        if n > 4 * _CHUNK:  # a huge word: not kept
            return tables[0], tables[1]
        _powers = (tables[0], tables[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def utf8_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and the n + 1 offsets between them; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of a batch of texts; text k has words first[k] to first[k + 1]."""

    hashes: np.ndarray
    prefixes: np.ndarray | None
    lengths: np.ndarray
    ends_with: np.ndarray
    first: np.ndarray


def words_of(texts: pa.Array, separators: np.ndarray = SPACES, prefix: int = 0) -> Words:
    """Hash every word, A-Z lower-cased; `prefix` also hashes its first bytes.

    Texts are worked through in pieces of about a megabyte that end between words, so memory
    does not follow the longest text.
    """
    data, offsets = utf8_buffers(texts)
    is_start = np.zeros(len(data) + 1, bool)
    is_start[offsets] = True
    parts, at = [], 0
    while at < len(data):
        end = _piece_end(data, is_start, at, separators)
        parts.append(_piece(data[at:end], is_start[at:end + 1], separators, prefix, at))
        at = end
    if not parts:
        none = np.empty(0, np.uint64)
        return Words(none, none if prefix else None, np.empty(0, np.int64), np.empty(0, np.uint8),
                     np.zeros(len(offsets), np.int64))
    hashes, prefixes, lengths, lasts, starts = (np.concatenate(x) if x[0] is not None else None for x in zip(*parts))
    return Words(hashes, prefixes, lengths, lasts, np.searchsorted(starts, offsets).astype(np.int64))


def _piece_end(data, is_start, at, separators) -> int:
    end = at + _CHUNK
    if end >= len(data):
        return len(data)
    for here in (slice(at + 1, end), slice(end, len(data))):
        breaks = np.flatnonzero(separators[data[here]] | is_start[here])
        if len(breaks):
            return here.start + int(breaks[-1 if here.start == at + 1 else 0])
    return len(data)


def _piece(data, is_start, separators, prefix, at):
    inside = ~separators[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, ~inside[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, ~inside[1:]
    starts = np.flatnonzero(inside & (before | is_start[:-1]))
    ends = np.flatnonzero(inside & (after | is_start[1:])) + 1
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[_LOWER[data]] * power[:len(data)], out=sums[1:])
    lengths = ends - starts
    unshift = inverse[starts]
    hashes = mix((sums[ends] - sums[starts]) * unshift + lengths.astype(np.uint64))
    heads = None
    if prefix:
        cut = np.minimum(ends, starts + prefix)
        heads = mix((sums[cut] - sums[starts]) * unshift + np.uint64(0x51))
    return hashes, heads, lengths, _LOWER[data[ends - 1]], starts + at
