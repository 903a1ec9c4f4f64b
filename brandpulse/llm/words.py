"""Words of many texts at once, as numpy arrays over one byte buffer."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


def trim() -> None:
    """Gives memory that a task has freed back to the machine; workers live on after a task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


_MUL = np.uint64(0x9E3779B97F4A7C15)
_EIGHT = np.uint64(8)
#: Spans above so many bytes are hashed one by one.
LONG = 64
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def lanes(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on, as one number (zeros past the end)."""
    wide = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ndarray((len(buf) + 1,), np.dtype("<u8"), wide.data, 0, (1,))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes.

    Eight bytes at a time are mixed into a state that every step permutes, so that spans of up to
    eight bytes never meet another of their length, and no pattern of letters makes longer ones
    meet more often than random numbers do (a polynomial modulo a power of two has such patterns).
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = (ends - starts).astype(np.uint64)
    lane = lanes(buf)
    h = mix(size * _MUL)
    at, left, of = starts, size, None
    big = size > LONG
    if big.any():
        of = np.flatnonzero(~big)
        at, left = starts[of], size[of]
    while len(at):
        part = lane[at]
        tail = left < _EIGHT
        if tail.any():
            part[tail] &= (np.uint64(1) << (left[tail] * _EIGHT)) - np.uint64(1)
        if of is None:
            h = mix((h ^ part) * _MUL)
        else:
            h[of] = mix((h[of] ^ part) * _MUL)
        more = left > _EIGHT
        of = np.flatnonzero(more) if of is None else of[more]
        at, left = at[more] + 8, left[more] - _EIGHT
    if big.any():
        raw = buf.tobytes()
        h[big] = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(starts[big].tolist(), ends[big].tolist(), strict=True)]
    return h


class Runs:
    """Hashes of runs of a sequence of 64-bit numbers. A run is the two runs of the largest power of
    two that begin and end it, hashed with its length; those are hashes of their halves."""

    def __init__(self, h: np.ndarray):
        self.levels = [h]

    def level(self, k: int) -> np.ndarray:
        """Hashes of all runs of 2**k numbers."""
        while len(self.levels) <= k:
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(mix(last[:-step] * _MUL + last[step:]) if len(last) > step else last[:0])
        return self.levels[k]

    def every(self, n: int) -> np.ndarray:
        """Hashes of all runs of n numbers."""
        return self.of(np.arange(max(len(self.levels[0]) - n + 1, 0)), n)

    def of(self, start: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Hashes of the runs of ``n`` (at least 1) numbers from each ``start`` on."""
        n = np.broadcast_to(np.asarray(n, np.int64), start.shape)
        out = np.zeros(len(start), np.uint64)
        power = np.frexp(n.astype(float))[1] - 1
        for k in np.unique(power).tolist():
            some = power == k
            a, m, level = start[some], n[some], self.level(k)
            out[some] = mix((level[a] * _MUL + level[a + m - (1 << k)]) ^ (m.astype(np.uint64) * _MUL))
        return out


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of an Arrow column (null: empty), and where each begins
    (one more for the end)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = np.int64 if pa.types.is_large_string(col.type) else np.int32
    at = np.frombuffer(col.buffers()[1], wide)[col.offset:col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data else np.zeros(0, np.uint8)
    return buf, at - at[0]


def runs(buf: np.ndarray, at: np.ndarray, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that aren't blank, and the number of runs before each text."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    full = ~blank[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[at] = True
    first, last = full.copy(), full.copy()
    first[1:] &= ~full[:-1] | edge[1:-1]
    last[:-1] &= ~full[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, at)


def chunks(col: pa.Array, size: int = 1 << 21):
    """(first row, rows, buffer, offsets) of stretches of a column of about ``size`` bytes."""
    buf, at = text_buffer(col)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, "right")) - 1)
        yield i, j - i, buf[at[i]:at[j]], at[i:j + 1] - at[i]
        i = j


def word_hashes(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without ASCII white space), and where each text's begin."""
    starts, ends, before = runs(buf, at)
    return span_hashes(buf, starts, ends), before
