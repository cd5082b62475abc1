"""Words and word shingles of many texts at once, as 64-bit hashes.

Words are runs of bytes other than space and U+0009 to U+000D, A to Z made small; no byte of a longer UTF-8 character is
among them. All texts of a slice are hashed as one array of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
#: Bytes of text worked on at a time; a longer text stands alone.
SLICE_BYTES = 2_000_000

ODD = np.uint64(0x9E3779B97F4A7C15)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of each run of values: every value is mixed with its place in the run before they are summed.

    Powers of one factor instead of the mixing would give some pairs of runs one hash whatever the factor.
    """
    if not len(begins):
        return np.empty(0, np.uint64)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(starts, sizes)
    at = place if len(begins) == 1 and not begins[0] else place + np.repeat(begins, sizes)
    value = (data[at].astype(np.uint64) << np.uint64(40)) + place.astype(np.uint64) + np.uint64(1)
    return mix(np.add.reduceat(mix(value * ODD), starts) + sizes.astype(np.uint64) * ODD)


def same_runs(
    data: np.ndarray, begins: np.ndarray, sizes: np.ndarray, others: np.ndarray, other_begins: np.ndarray, other_sizes: np.ndarray
) -> np.ndarray:
    """Whether each run of ``data`` has the values of its run of ``others``."""
    same = sizes == other_sizes
    kept = np.flatnonzero(same & (sizes > 0))
    if len(kept):
        n = sizes[kept]
        starts = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(starts, n)
        equal = data[step + np.repeat(begins[kept], n)] == others[step + np.repeat(other_begins[kept], n)]
        same[kept] = np.logical_and.reduceat(equal, starts)
    return same


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * ODD)
BYTE_VALUES[ord("A") : ord("Z") + 1] = BYTE_VALUES[ord("a") : ord("z") + 1]


def text_slices(batches: Iterator[pa.RecordBatch], column: int = 1) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batches with the bytes of their texts end to end and the borders between them."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets, data = text_bytes(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, side="right")) - 1)
            yield batch.slice(lo, hi - lo), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            lo = hi


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return ends, np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)


def words(data: np.ndarray, borders: np.ndarray, mark_wide: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and for each text the end of its words.

    With ``mark_wide`` the last bit of a hash tells whether the word has a byte beyond ASCII.
    """
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(borders) - 1, np.int64)
    inside = ~IS_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts_of_text = borders[:-1][borders[:-1] < len(data)]
    first[starts_of_text] = inside[starts_of_text]
    begins = np.flatnonzero(first)
    if not len(begins):
        return np.empty(0, np.uint64), np.zeros(len(borders) - 1, np.int64)
    # up to the next word's first byte; the spaces there count nothing
    sizes = np.diff(np.append(begins, len(data)))
    place = np.arange(begins[0], len(data)) - np.repeat(begins, sizes)
    value = mix(BYTE_VALUES[data[begins[0] :]] + place.astype(np.uint64) * ODD) * inside[begins[0] :]
    hashes = mix(np.add.reduceat(value, begins - begins[0]))
    if mark_wide:
        wide = np.maximum.reduceat(data[begins[0] :], begins - begins[0]) >= 0x80
        hashes = (hashes & ~np.uint64(1)) | wide
    return hashes, np.searchsorted(begins, borders[1:])


def shingle_sets(word_hashes: np.ndarray, ends: np.ndarray, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; of fewer words the whole sequence is one."""
    n = len(word_hashes)
    rolling = np.zeros(max(0, n - size + 1), dtype=np.uint64)
    for i in range(size):
        rolling = rolling * ODD + word_hashes[i : i + len(rolling)]
    rolling = mix(rolling)
    out, at = [], 0
    for end in ends.tolist():
        if end - at >= size:
            found = np.sort(rolling[at : end - size + 1])
            keep = np.ones(len(found), dtype=bool)
            keep[1:] = found[1:] != found[:-1]
            out.append(found[keep])
        elif end > at:
            value = np.array([end - at], dtype=np.uint64)
            for k in range(at, end):
                value = mix(value * ODD + word_hashes[k : k + 1])
            out.append(value)
        else:
            out.append(np.empty(0, np.uint64))
        at = end
    return out


def set_hash(shingles: np.ndarray) -> int:
    """One signed 64-bit number for a set."""
    total = mix(shingles + ODD).sum(dtype=np.uint64, keepdims=True) + np.array([len(shingles)], dtype=np.uint64) * ODD
    return int(mix(total).view(np.int64)[0])
