"""Word hashes of whole texts, in numpy over the Arrow buffers of a batch.

Words are runs of bytes that are not separators, so words are found and hashed
without making a Python object for each. A word's hash is a polynomial over
random 64-bit values of its bytes, mixed; equal words have equal hashes
everywhere, and different ones differ but for one pair in 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2_000_000  # texts are worked on in chunks of about this size; a longer text is a chunk of its own


def mix(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257))
BASE = 0x2545F4914F6CDD1D  # odd, so that it has an inverse modulo 2^64
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to n."""
    if len(_POWERS[0]) <= n:
        size = 1 << (n + 1).bit_length()
        for k, step in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            with np.errstate(over="ignore"):
                _POWERS[k] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, step, np.uint64))])
    return _POWERS[0], _POWERS[1]


def spaces_table() -> tuple[np.ndarray, np.ndarray]:
    """Separators 0x20 and 0x09-0x0D; A-Z lower-cased."""
    separators = np.zeros(256, bool)
    separators[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    values = np.arange(256, dtype=np.uint8)
    values[65:91] += 32
    return separators, values


def letters_table() -> tuple[np.ndarray, np.ndarray]:
    """All but letters and non-ASCII bytes separate; A-Z lower-cased."""
    _, values = spaces_table()
    letters = np.zeros(256, bool)
    letters[65:91] = letters[97:123] = letters[128:] = True
    return ~letters, values


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n + 1 offsets of a string column; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive rows of about ``size`` bytes."""
    data, at = buffers(column)
    row = 0
    while row < len(at) - 1:
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, side="right")) - 1)
        yield row, end, data[at[row]:at[end]], at[row:end + 1] - at[row]
        row = end


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: tuple[np.ndarray, np.ndarray],
                prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """Hashes of all words in order, and for each text (plus one) the number of words before it.

    With ``prefixes``, also for each length the hash of a word's first so many bytes, or 0 for a shorter word.
    """
    separators, values = table
    n = len(data)
    inside = ~separators[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[(offsets > 0) & (offsets < n)]  # a text's first byte never continues the word before it
    first[edge] = inside[edge]
    starts = np.flatnonzero(first)
    if not len(starts):
        return (np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), *[np.zeros(0, np.uint64) for _ in prefixes])
    power, inverse = _powers(n)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(np.where(inside, BYTE_VALUES[values[data]] * power[:n], np.uint64(0)), out=sums[1:])
        ends = np.append(starts[1:], n)  # the separators in between add nothing
        hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
        found = []
        if prefixes:
            stop = np.flatnonzero(~inside | first)  # where a word may end
            stop = np.append(stop, n)
            length = stop[np.searchsorted(stop, starts, side="right")] - starts
            for size in prefixes:
                at = np.minimum(starts + size, n)
                found.append(np.where(length > size, mix((sums[at] - sums[starts]) * inverse[starts] + np.uint64(size)), np.uint64(0)))
    return (hashes, np.searchsorted(starts, offsets).astype(np.int64), *found)


def windows(hashes: np.ndarray, before: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of n words, none across texts, and the number of windows before each text.

    A text with fewer words, but at least one, has its whole sequence as one window.
    """
    words = np.diff(before)
    count = np.where(words >= n, words - n + 1, (words > 0).astype(np.int64))
    ahead = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    text = np.repeat(np.arange(len(words)), count)
    at = before[:-1][text] + (np.arange(ahead[-1]) - ahead[:-1][text])
    end = before[1:][text]
    out = np.zeros(len(at), np.uint64)
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    with np.errstate(over="ignore"):
        for k in range(n):
            out = mix(out * np.uint64(BASE) + np.where(at + k < end, padded[at + k], np.uint64(k + 1)))
    return out, ahead
