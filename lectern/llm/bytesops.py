"""Vectorised hashing of words and byte strings inside tasks (numpy over Arrow buffers)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes that one step works on at once; a longer text is a step of its own.
BLOCK = 1 << 18
#: Span hashes are polynomials modulo this prime, two of them with bases of their own to each hash.
PRIME = (1 << 31) - 1
_BASES = ((1_270_634_339, 1_911_520_717), (693_724_181, 2_035_175_333))
_SEPARATOR = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_powers: dict[int, np.ndarray] = {}
_LOW = U64(PRIME)


def randoms(seed: int, n: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=U64) * U64(2) + U64(1)


_BYTE, _BYTE2 = randoms(1, 256), randoms(2, 256)
_FOLD = np.arange(256)
_FOLD[65:91] += 32


def powers(base: int, n: int) -> np.ndarray:
    """base**i mod PRIME for i < n, kept between calls up to a few blocks' length."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, U64)
        while len(have) < max(n, BLOCK + 1):
            have = np.concatenate([have, have * U64(pow(base, len(have), PRIME)) % _LOW])
        if n <= 8 * BLOCK:
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(29)
    h *= U64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> U64(32))


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def blocks(offsets: np.ndarray, most: int = BLOCK, rows: int = 4096) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes and at most `rows` rows each."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        end = min(end, at + rows, n)
        yield at, end
        at = end


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, second: bool = False) -> np.ndarray:
    """A hash of values[start:end] for each span; values are 64-bit codes of the symbols.

    Two polynomials modulo a prime, each over 31 bits of the codes and with a base of its own; `second`
    has two other bases.
    """
    lanes = []
    for base, shift in zip(_BASES[second], (0, 33), strict=True):
        terms = ((values >> U64(shift)) & _LOW) * powers(base, len(values))
        sums = np.zeros(len(values) + 1, U64)
        np.cumsum((terms & _LOW) + (terms >> U64(31)), out=sums[1:])
        inverse = powers(pow(base, -1, PRIME), len(values) + 1)[starts]
        lanes.append((sums[ends] - sums[starts]) % _LOW * inverse % _LOW)
    return mix((lanes[0] << U64(32) | lanes[1]) + (ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))


def byte_codes(data: np.ndarray, second: bool = False) -> np.ndarray:
    return (_BYTE2 if second else _BYTE)[data]


def words(data: np.ndarray, bounds: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row, start and end of every word in `data`; row r is data[bounds[r]:bounds[r + 1]].

    Words are runs of bytes other than blank and 0x09-0x0D; with `fold`, A-Z count as a-z.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return np.zeros(0, U64), none, none, none
    inside = ~_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    left, right = np.empty_like(inside), np.empty_like(inside)
    left[0], left[1:] = True, ~inside[:-1]
    right[-1], right[:-1] = True, ~inside[1:]
    starts = np.flatnonzero(inside & (left | edge[:-1]))
    ends = np.flatnonzero(inside & (right | edge[1:])) + 1
    hashes = span_hashes((_BYTE[_FOLD] if fold else _BYTE)[data], starts, ends)
    return hashes, np.searchsorted(bounds, starts, "right") - 1, starts, ends


_SHINGLE = randoms(3, 8)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """For each row its set of `size`-word shingles as sorted distinct 64-bit hashes.

    A row of fewer words has its whole word sequence as the only one; a row without words has none.
    """
    hashes, rows, _, _ = words(data, bounds)
    n = len(bounds) - 1
    first = np.searchsorted(rows, np.arange(n + 1))
    if len(hashes) >= size:
        m = len(hashes) - size + 1
        grams = np.zeros(m, U64)
        for k in range(size):
            grams += hashes[k : k + m] * _SHINGLE[k]
        grams = mix(grams)
    out = []
    for r in range(n):
        a, b = first[r], first[r + 1]
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            out.append(mix(np.array([(hashes[a:b] * _SHINGLE[: b - a]).sum(dtype=U64) + U64(b - a)], U64)))
        else:
            out.append(np.zeros(0, U64))
    return out


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark longs."""
    return values.view(np.int64)
