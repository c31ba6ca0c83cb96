"""Words, hashes and shingles of many texts at once, with numpy over Arrow buffers.

A chunk holds whole texts only. Word hashes are multilinear over bytes (random
tables, 64 bits), so equal words have equal hashes on every machine.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; a longer text is a chunk of its own.
CHUNK = 1 << 20
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=_U) + _U(seed << 32)) * _U(0x9E3779B97F4A7C15))


_BYTE = stream(1, 256)
_PLACE = stream(2, 1 << 12) | _U(1)

#: Separators of words: ASCII white space only.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of alphanumeric words: all ASCII but letters and digits.
PUNCT = np.ones(256, bool)
PUNCT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _places(n: int) -> np.ndarray:
    global _PLACE
    if n > len(_PLACE):
        _PLACE = stream(2, 1 << int(n - 1).bit_length()) | _U(1)
    return _PLACE


def buffers(texts: pa.Array, latin: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with A-Z (and the accented Latin-1 letters, if latin) lower-cased, and the bounds of each text; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    data = _LOWER[data]
    if latin and len(data):
        lead = np.flatnonzero(data[:-1] == 0xC3) + 1
        upper = lead[(data[lead] >= 0x80) & (data[lead] <= 0x9E) & (data[lead] != 0x97)]
        data[upper] += 0x20
    return data, bounds - bounds[0]


def chunks(texts: pa.Array, latin: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, bytes, bounds) of runs of whole texts of about CHUNK bytes."""
    data, bounds = buffers(texts, latin)
    at, n = 0, len(bounds) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + CHUNK, "right")) - 1)
        yield at, end, data[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at]
        at = end


def words(data: np.ndarray, bounds: np.ndarray, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the bounds of each text in them."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece data[start:end]; pieces are not empty and do not overlap."""
    if not len(starts):
        return np.zeros(0, _U)
    lens = ends - starts
    firsts = np.cumsum(lens) - lens
    within = np.arange(int(lens.sum())) - np.repeat(firsts, lens)
    at = within + np.repeat(starts, lens)
    with np.errstate(over="ignore"):
        terms = _BYTE[data[at]] * _places(int(lens.max()))[within]
        return mix(np.add.reduceat(terms, firsts) + lens.astype(_U))


def shingles(h: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of width words (of all words of a shorter text), and the bounds of each text in them."""
    n = np.diff(bounds)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(n.dtype))
    out_bounds = np.concatenate([[0], np.cumsum(count)])
    first = np.arange(int(out_bounds[-1])) + np.repeat(bounds[:-1] - out_bounds[:-1], count)
    limit = np.repeat(bounds[1:], count)
    total = np.zeros(len(first), _U)
    factors = stream(3, width) | _U(1)
    with np.errstate(over="ignore"):
        for k in range(width):
            at = first + k
            ok = at < limit
            total[ok] += h[at[ok]] * factors[k] + factors[k]
    return mix(total), out_bounds


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and their bounds."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    values = values.copy()
    for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        values[a:z].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[keep], owner[keep]
    return values, np.searchsorted(owner, np.arange(len(bounds)))


def list_array(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, type=kind))
