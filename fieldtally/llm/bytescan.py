"""Vectorised scans over the bytes of many texts at once: runs of bytes, hashes of spans, windows.

Every function works on the data buffer of an Arrow string column, so no Python object is made per word.
Span hashes are polynomials over random byte values modulo 2^64 with a final mix; two different spans of
n in all collide with a probability of about n^2 / 2^64. There are words, such as the Thue-Morse word and its
complement, whose polynomials agree modulo 2^64 whatever the base. Where spans that collide would count as equal, `safe`
adds a polynomial modulo a prime, which has no such words; other operators compare bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are scanned together; a longer text is scanned alone.
SLICE_BYTES = 2_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**64, size=256, dtype=np.uint64)


VALUES = _byte_values(7)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32
#: The same value for a letter in either case: hashes of lower-cased spans without a lower-cased copy.
FOLDED = VALUES[LOWER]

_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """1, b, b^2 ... (up) or the powers of b's inverse (down), n of them at least."""
    if len(_powers[kind]) < n:
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind]


#: A prime whose remainders are taken by shifts: 2^31 - 1.
_PRIME = np.uint64((1 << 31) - 1)
_PRIME_BASE = 1_103_515_245
_prime_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint32), "down": np.ones(1, np.uint32)}


def _folded(x: np.ndarray) -> np.ndarray:
    """A smaller number with the same remainder modulo the prime."""
    return (x & _PRIME) + (x >> np.uint64(31))


def _prime_power(kind: str, n: int) -> np.ndarray:
    """`_power` modulo the prime."""
    prime = int(_PRIME)
    base = _PRIME_BASE if kind == "up" else pow(_PRIME_BASE, -1, prime)
    known = _prime_powers[kind]
    if len(known) < n:
        n = max(n, 1 << 16)
        while len(known) < n:
            further = _folded(_folded(known[: n - len(known)] * np.uint64(pow(base, len(known), prime))))
            known = np.concatenate([known, (further % _PRIME).astype(np.uint32)])
        _prime_powers[kind] = known  # four bytes each, no more than were asked for
    return known


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class Hashed:
    """Hashes of any spans of one buffer; `safe` ones have no constructed collisions."""

    def __init__(self, data: np.ndarray, values: np.ndarray = VALUES, safe: bool = False):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data] * _power("up", n + 1)[:n], out=self.sums[1:])
        self.down = _power("down", n + 1)
        self.safe = safe
        if safe:
            self.remainders = np.zeros(n + 1, np.uint64)
            # remainders below 2^31, of which 2^33 at most are added up
            term = (values % _PRIME)[data]
            term *= _prime_power("up", n + 1)[:n]
            high = term >> np.uint64(31)
            term &= _PRIME
            term += high
            np.cumsum(term, out=self.remainders[1:])

    def every(self, size: int) -> np.ndarray:
        """The hashes that `spans` gives of all spans of `size` bytes, without the safe part."""
        h = self.sums[size:] - self.sums[: len(self.sums) - size]
        h *= self.down[: len(h)]
        h += np.uint64(size * 0xA24BAED4963EE407 & _MASK)
        return mix(h)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        h = mix(h + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        if not self.safe:
            return h
        rest = _folded(_folded(self.remainders[end] - self.remainders[start]))
        rest = _folded(_folded(rest * _prime_power("down", len(self.sums))[start]))
        rest[rest >= _PRIME] -= _PRIME
        return mix(h + rest * np.uint64(0x9FB21C651E98DF25))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, nulls as empty, and where each text starts and the last one ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string() if pa.types.is_large_string(column.type) else pa.string())
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0]: at[-1]], at - at[0]


def release() -> None:
    """Give freed memory back to the system at the end of a task: Python workers live on, and the next stage's tasks
    may run beside them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut into parts of about `limit` bytes of text, each with the bytes and offsets of its texts."""
    scanned = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        data, at = buffers(batch.column(batch.schema.get_field_index(column)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first), data[at[first]: at[last]], at[first: last + 1] - at[first]
            first = last
        scanned += len(data)
    if scanned > SLICE_BYTES:
        release()


def runs(member: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of true bytes that do not cross from one text into the next."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(n, bool)
    before[0], before[1:] = False, member[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, member[1:]
    inner = at[(at > 0) & (at < n)]
    before[inner] = False
    after[inner - 1] = False
    return np.flatnonzero(member & ~before), np.flatnonzero(member & ~after) + 1


def table(pairs: list[tuple[int, int]]) -> np.ndarray:
    """Which bytes are in any of the closed ranges."""
    t = np.zeros(256, bool)
    for lo, hi in pairs:
        t[lo: hi + 1] = True
    return t


#: Words: letters and digits of ASCII and all other characters beyond it.
WORD = table([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
#: Everything but ASCII white space.
VISIBLE = ~table([(0x20, 0x20), (0x09, 0x0D)])


def words(data: np.ndarray, at: np.ndarray, member: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (one more at the end)."""
    start, end = runs(member[data], at)
    return start, end, np.searchsorted(start, at)


def windows(h: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` consecutive words inside a text, and the index of each run's first word.

    A text of fewer words, but not none, has one run of all its words.
    """
    n = len(h)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = np.diff(first)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(h * _power("up", n + 1)[:n], out=sums[1:])
    owner_end = np.repeat(first[1:], count)
    begin = np.arange(n, dtype=np.int64)
    whole = begin + size <= owner_end
    short = (count > 0) & (count < size)
    whole[first[:-1][short]] = True
    begin = begin[whole]
    stop = np.minimum(begin + size, owner_end[whole])
    out = (sums[stop] - sums[begin]) * _power("down", n + 1)[begin]
    return mix(out + (stop - begin).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)), begin


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start + 1 ... of every span, one span after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    step = np.ones(total, np.int64)
    step[0] = starts[0]
    ends = np.cumsum(lengths)[:-1]
    step[ends] = starts[1:] - (starts[:-1] + lengths[:-1] - 1)
    return np.cumsum(step)
