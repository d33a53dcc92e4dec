"""Words and their 64-bit hashes for whole Arrow batches, with numpy only.

The bytes of all texts of a batch lie in one buffer. Words are runs of bytes of
a class; multi-byte characters consist of bytes from 128 upwards, so classes
made of ASCII characters can be tested on bytes.
"""

import numpy as np
import pyarrow as pa

U = np.uint64
# Texts are handled in slices of about this many bytes; a longer text is a slice alone.
SLICE_BYTES = 1 << 21


def mix(h):
    """Finalizer of splitmix64 on an array of uint64."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def byte_values():
    """256 fixed odd-looking values, one for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))


def lower_table():
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def not_white():
    """Bytes of `[^\\x20\\x09-\\x0D]`."""
    t = np.ones(256, dtype=bool)
    t[[32, *range(9, 14)]] = False
    return t


def alnum():
    """Bytes of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`, after lower-casing."""
    t = np.zeros(256, dtype=bool)
    t[48:58] = t[97:123] = t[128:] = True
    return t


def buffers(column):
    """(bytes, offsets) of an Arrow string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offs, data = column.buffers()
    n = len(column)
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def slices(offs, most=SLICE_BYTES):
    """Ranges [a, b) of texts with at most `most` bytes, or one text."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = int(np.searchsorted(offs, offs[a] + most, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def word_hashes(data, offs, member, lower=None, values=None):
    """(hash, text number, first byte, end byte) of every word of a slice."""
    if lower is not None:
        data = lower[data]
    values = byte_values() if values is None else values
    m = member[data]
    if not m.any():
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offs] = True
    start = m.copy()
    start[1:] &= ~m[:-1] | edge[1:-1]
    end = m.copy()
    end[:-1] &= ~m[1:] | edge[1:-1]
    starts = np.flatnonzero(start)
    ends = np.flatnonzero(end) + 1
    size = ends - starts
    first = np.cumsum(size) - size
    power = np.full(int(size.max()), 0x9E3779B97F4A7C15 | 1, dtype=np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    inside = np.arange(int(size.sum())) - np.repeat(first, size)
    h = np.add.reduceat(values[data[m]] * power[inside], first)
    h = mix(h ^ (size.astype(np.uint64) * U(0xD6E8FEB86659FD93)))
    return h, np.searchsorted(offs[1:], starts, side="right"), starts, ends


def chain(hashes, n):
    """Hash of the n words that begin at each place; the last n - 1 places are cut."""
    k = len(hashes) - n + 1
    if k <= 0:
        return np.zeros(0, np.uint64)
    h = mix(hashes[:k] + U(n))
    for j in range(1, n):
        h = mix(h * U(3) + hashes[j : j + k])
    return h
