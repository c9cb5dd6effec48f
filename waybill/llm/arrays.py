"""Words of an Arrow text column as numpy arrays: boundaries, 64-bit hashes, sliding windows.

A word's hash is a polynomial over a random table of byte values modulo 2**64, mixed; sums over a
prefix give every word's polynomial without a Python loop. Equal words have equal hashes, and
different ones collide with probability about 2**-64 a pair.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = tuple(b" \t\n\x0b\x0c\r")


def spaces() -> np.ndarray:
    """True for the bytes that part words: blanks, tabs and line ends."""
    out = np.zeros(256, bool)
    out[list(SPACE)] = True
    return out


def non_alphanumeric() -> np.ndarray:
    """True for every ASCII byte but digits and letters."""
    out = np.zeros(256, bool)
    out[:128] = True
    for low, high in ((48, 58), (65, 91), (97, 123)):
        out[low:high] = False
    return out


def byte_values(lower: bool, seed: int = 11) -> np.ndarray:
    """A random 64-bit value for each byte, the same for A-Z as for a-z if lower."""
    values = np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if lower:
        values[65:91] = values[97:123]
    return values


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []
#: Bytes whose polynomials are summed at once: the sums and powers of a block take some 2 MB.
_BLOCK = 1 << 16


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, _BLOCK)
        out = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each row starts (one more than rows); null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return values[starts[0] : starts[-1]], starts - starts[0]


class Words:
    """Words of some rows: byte bounds, the row of each, and where each row's words start."""

    def __init__(self, column: pa.Array, parting: np.ndarray) -> None:
        self.data, self.rows_at = flat(column)
        n = len(self.data)
        inside = np.zeros(n + 1, bool)
        inside[:n] = ~parting[self.data] if n else False
        before = np.empty(n + 1, bool)
        before[0] = False
        before[1:] = inside[:n]
        edge = np.zeros(n + 1, bool)
        edge[self.rows_at] = True  # a word never runs over into the next row
        self.starts = np.flatnonzero(inside & (~before | edge))
        self.ends = np.flatnonzero(before & (~inside | edge))
        self.first = np.searchsorted(self.starts, self.rows_at)
        self.row = np.repeat(np.arange(len(self.rows_at) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, values: np.ndarray) -> np.ndarray:
        """Hashes of the words, in blocks of whole words: no sums or powers as long as all the texts."""
        out, low = np.empty(len(self), np.uint64), 0
        while low < len(self):
            at = self.starts[low]
            high = max(low + 1, int(np.searchsorted(self.ends, at + _BLOCK, "right")))
            starts, ends = self.starts[low:high] - at, self.ends[low:high] - at
            up, down = _powers(int(ends[-1]))
            total = np.zeros(ends[-1] + 1, np.uint64)
            np.cumsum(values[self.data[at : at + ends[-1]]] * up[: ends[-1]], out=total[1:])
            out[low:high] = (total[ends] - total[starts]) * down[starts]
            low = high
        return mixed(out)


def rolling(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of each run of so many words, by doubling; shorter than the input by width - 1."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    out, done, power = None, 0, 1
    block, size, step = hashes, 1, base  # powers as Python integers, reduced by hand
    while size <= width:
        if width & size:
            if out is None:
                out, done, power = block, size, step
            else:
                n = min(len(out), len(block) - done)
                out = out[:n] + np.uint64(power) * block[done : done + n]
                done, power = done + size, power * step % 2**64
        if size * 2 <= width:
            block = block[:-size] + np.uint64(step) * block[size:]
            step = step * step % 2**64
        size *= 2
    return out[: len(hashes) - width + 1]


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Least (np.minimum) or greatest (np.maximum) of each run of so many values."""
    size = 1
    while size * 2 <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    return best(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have about so many bytes together, at least one row each."""
    _, at = flat(column)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(at, at[low] + most, "right")) - 1)
        yield low, high
        low = high


def released() -> None:
    """Gives freed memory back to the system: a Python worker stays after its task and runs others."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc keeps some 100 MB otherwise
        trim(0)


def gathered(batches: Iterator[pa.RecordBatch], name: str, most: int) -> Iterator[pa.Table]:
    """Rows of the batches in tables of about so many text bytes, split or put together as needed.

    After the last one, memory that is not used any more is given back.
    """
    held, size = [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.schema.names.index(name))
        for low, high in slices(column, most):
            part = batch.slice(low, high - low)
            held.append(part)
            size += int(np.diff(flat(part.column(batch.schema.names.index(name)))[1][[0, -1]])[0])
            if size >= most:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
        held = []
    released()


def column_of(table: pa.Table, name: str) -> pa.Array:
    """A column of a table as one array."""
    chunks = table.column(name)
    return chunks.chunk(0) if chunks.num_chunks == 1 else pa.concat_arrays(chunks.chunks) if chunks.num_chunks else pa.array([], chunks.type)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges that cover the same numbers, without overlap."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def cut_out(column: pa.Array, spans: list[list[tuple[int, int]]], parting: np.ndarray) -> pa.Array:
    """Texts without their spans of words; what stands between the words of a span goes with them."""
    if not any(spans):
        return column
    words, texts = Words(column, parting), column.to_pylist()
    for r in (r for r, x in enumerate(spans) if x):
        raw, at, parts = texts[r].encode(), 0, []
        first, zero = words.first[r], words.rows_at[r]
        for low, high in spans[r]:
            parts.append(raw[at : words.starts[first + low] - zero])
            at = int(words.ends[first + high - 1] - zero)
        texts[r] = b"".join([*parts, raw[at:]]).decode()
    return pa.array(texts, column.type)
