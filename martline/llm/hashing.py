"""Word hashes of many texts at once, on the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_tables: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the multiplier and of its inverse, modulo 2^64."""
    if len(_tables.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps)
    return _tables["up"][:n], _tables["down"][:n]


def byte_values() -> np.ndarray:
    if "bytes" not in _tables:
        _tables["bytes"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))
    return _tables["bytes"]


def prefix_hash(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix sums, inverse powers): the hash of buf[a:b] is (sums[b] - sums[a]) * inverse[a], modulo 2^64."""
    up, down = powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(byte_values()[buf] * up[: len(buf)], out=sums[1:])
    return sums, down


def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the first text, bytes, offsets) of consecutive texts of about ``block_bytes`` together. NULL is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if pa.types.is_binary(column.type) or pa.types.is_string(column.type):
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
        kind = np.int32
    else:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
        kind = np.int64
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + block_bytes, "right")) - 1)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def separators(chars: bytes) -> np.ndarray:
    out = np.ones(256, np.bool_)
    out[list(chars)] = False
    return out


#: True for bytes of words: anything but ASCII white space.
WORD_BYTES = separators(b" \t\n\x0b\x0c\r")


def lower_bytes() -> np.ndarray:
    """ASCII A-Z to a-z."""
    if "lower" not in _tables:
        t = np.arange(256, dtype=np.uint8)
        t[65:91] += 32
        _tables["lower"] = t
    return _tables["lower"]


def word_hashes(buf: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = WORD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, start, end) of every word in order. Words do not cross texts."""
    inside = word_bytes[buf]
    edge = offsets[1:-1]
    edge = edge[edge < len(buf)]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(buf):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        before[edge] = False
        after[edge[edge > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    sums, down = prefix_hash(buf)
    h = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return h, np.searchsorted(offsets, start, "right") - 1, start, end
