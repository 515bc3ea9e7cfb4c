"""Words and rolling word hashes of Arrow text columns, vectorised in numpy.

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09-\\x0D`` (UTF-8
sequences never hold those bytes).  Words are hashed by their bytes through a finaliser, runs of words by
polynomials modulo a prime (modulo a power of two, some repetitive sequences would share a hash), so
the same word has the same hash in every batch, task and run.  Texts are taken in chunks of about ``CHUNK`` bytes; one
longer text is a chunk of its own, so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK = 1 << 18
_U = np.uint64
CHAINED = 6
_WORD_BASE = _U(0xD1342543DE82EF95)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_ALNUM = ~NOT_ALNUM & (np.arange(256) < 128)
_PUNCTUATION = NOT_ALNUM & ~IS_SPACE & (np.arange(256) > 0x20) & (np.arange(256) < 0x7F) & (np.arange(256) != ord("'"))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (spreads polynomial hashes over all bits)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Runs of more bytes go through xxhash one by one.
LONG = 64
_LENGTH = _U(0x9E3779B97F4A7C15)
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``, eight bytes at a time through a bijective finaliser.

    Runs of at most eight bytes and the same length never share a hash, and longer ones have no structure to build on."""
    size = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    out = mix(mix(size.astype(_U) * _LENGTH) ^ (eight[starts] & _MASK[np.minimum(size, 8)]))
    live = np.flatnonzero(size > 8)
    done = 8
    while len(live) and done < LONG:
        at, left = starts[live] + done, size[live] - done
        out[live] = mix(out[live] ^ (eight[at] & _MASK[np.minimum(left, 8)]))
        live = live[left > 8]
        done += 8
    for i in live.tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].tobytes())
    return out


# --- runs of words: polynomials modulo the prime 2**61 - 1 -------------------------

_P = _U((1 << 61) - 1)
_BASE = int(_WORD_BASE) % int(_P)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _U(61))
    return np.where(x >= _P, x - _P, x)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a * b`` modulo the prime, of reduced factors, by halves of 32 bits."""
    low = _U(0xFFFFFFFF)
    a1, a0, b1, b0 = a >> _U(32), a & low, b >> _U(32), b & low
    middle, last = a1 * b0 + a0 * b1, a0 * b0
    return _reduced(a1 * b1 * _U(8) + (middle >> _U(29)) + ((middle & _U((1 << 29) - 1)) << _U(32)) + (last >> _U(61)) + (last & _P))


class _Powers:
    """Powers of a base modulo the prime, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.table = base, np.ones(1, _U)

    def upto(self, n: int) -> np.ndarray:
        while len(self.table) <= n:
            step = _U(pow(self.base, len(self.table), int(_P)))
            self.table = np.concatenate([self.table, _product(self.table, np.full(len(self.table), step))])
        return self.table


_UP, _DOWN = _Powers(_BASE), _Powers(pow(_BASE, -1, int(_P)))


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent polynomial hash of each ``values[start:end]``."""
    terms = _product(_reduced(values), _UP.upto(len(values))[:len(values)])
    # Sums of halves stay below 2**64 for any text; the prime takes their higher half back.
    sums = np.zeros((2, len(values) + 1), _U)
    np.cumsum(terms >> _U(31), out=sums[0, 1:])
    np.cumsum(terms & _U((1 << 31) - 1), out=sums[1, 1:])
    high = _reduced(sums[0])
    upto = _reduced((high >> _U(30)) + ((high & _U((1 << 30) - 1)) << _U(31)) + _reduced(sums[1]))
    return _product(_reduced(upto[ends] + (_P - upto[starts])), _DOWN.upto(len(values))[starts])


@dataclass
class Chunk:
    """Rows ``lo:hi`` of a column: their bytes, and where each row's bytes begin."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, start: int, end: int) -> bytes:
        return self.data[start:end].tobytes()


@dataclass
class Words:
    """Words of a chunk in order; row ``r`` has words ``first[r]:first[r + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[Chunk]:
    """Slices of a string column (null: empty text) of about ``size`` bytes."""
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Chunk(lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def split_words(chunk: Chunk, lower: bool = False, separators: np.ndarray = IS_SPACE) -> Words:
    """The words of every row of a chunk, with their hashes."""
    data, rows = chunk.data, chunk.offsets
    inside = ~separators[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[rows] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[rows] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(starts, ends, np.searchsorted(starts, rows), run_hashes(_LOWER[data] if lower else data, starts, ends))


def prefix_hashes(chunk: Chunk, words: Words, length: int, lower: bool = False) -> np.ndarray:
    """Hash of the first ``length`` bytes of each word; a word that is no longer keeps its own."""
    cut = words.starts + length
    longer = cut < words.ends
    out = words.hashes.copy()
    # A stem isn't the word of the same letters.
    out[longer] = mix(run_hashes(_LOWER[chunk.data] if lower else chunk.data, words.starts[longer], cut[longer]) ^ _LENGTH)
    return out


def split_pieces(chunk: Chunk) -> Words:
    """Each row cut before every run of white space, and before ASCII punctuation (but ``'``) after an ASCII letter or digit."""
    data, rows = chunk.data, chunk.offsets
    space = IS_SPACE[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = space
    head = space & ~before[:-1]
    head[1:] |= _ALNUM[data[:-1]] & _PUNCTUATION[data[1:]]
    head[rows[:-1][np.diff(rows) > 0]] = True
    starts = np.flatnonzero(head)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    return Words(starts, ends, np.searchsorted(starts, rows), run_hashes(data, starts, ends))


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive words; entry ``i`` covers words ``i:i + k``.  A few words are chained one by one."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, _U)
    if k <= CHAINED:
        out = mix(hashes[:n] ^ _U(k * int(_LENGTH) % (1 << 64)))
        for i in range(1, k):
            out = mix(out ^ hashes[i:n + i])
        return out
    return span_hashes(hashes, np.arange(n), np.arange(k, n + k))


def span_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run of words ``starts:ends`` (length included)."""
    return mix(_ranges(hashes, starts, ends) + (ends - starts).astype(_U) * _LENGTH)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return x.view(np.int64)
