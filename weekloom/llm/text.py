"""Words of whole texts as arrays: what the text operators share inside their tasks.

A word is a run of characters other than space and U+0009 to U+000D. Words become 64-bit
hashes, and runs of words become hashes built by doubling, so the work per text is a few
array operations. Batches are cut into pieces of bounded text size, so a task's memory does
not depend on how many long documents follow each other; only a single text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE_BYTES = 4 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES, times: str | None = None
) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices of at most ``limit`` bytes of text (or of one row).

    With ``times`` a text counts as often as that list of its row is long.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if times is not None:
            sizes *= pc.fill_null(pc.list_value_length(batch.column(times)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of each row's text; NULL counts as empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def longs(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False)


def mixed(a: np.ndarray) -> np.ndarray:
    """A 64-bit permutation that spreads every bit."""
    a = a ^ (a >> np.uint64(29))
    a *= _MIX
    return a ^ (a >> np.uint64(32))


def word_hashes(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in one array, and the number of words of each text."""
    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    every = [w for words in texts for w in words]
    return np.fromiter(map(xxhash.xxh3_64_intdigest, every), np.uint64, len(every)), counts


def runs(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each place on; built by doubling."""
    out, have, power, size = None, 0, h, 1
    rest = length
    while True:
        if rest & 1:
            if out is None:
                out, have = power, size
            else:
                n = max(0, len(h) - have - size + 1)
                out = mixed(out[:n]) * _ODD + power[have : have + n]
                have += size
        rest >>= 1
        if not rest:
            return out[: max(0, len(h) - length + 1)]
        n = max(0, len(h) - 2 * size + 1)
        power = mixed(power[:n]) * _ODD + power[size : size + n]
        size *= 2


def owners(counts: np.ndarray) -> np.ndarray:
    """The text each word belongs to."""
    return np.repeat(np.arange(len(counts)), counts)


def inside(owner: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` words from each place on belong to one text."""
    n = max(0, len(owner) - length + 1)
    return owner[:n] == owner[length - 1 : length - 1 + n]


def sliding(a: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` places, by doubling."""
    size = 1
    while size * 2 <= width:
        a = pick(a[:-size], a[size:])
        size *= 2
    return pick(a[: len(a) - (width - size)], a[width - size :]) if size < width else a


def sampled(h: np.ndarray, owner: np.ndarray, words: int, length: int, alive=None):
    """Minimizers: the least-hashed ``length``-word run within each window of ``words`` words.

    Equal windows have equal minimizers at equal places, so a window can only repeat if its
    minimizer does. ``alive`` limits the windows. Returns the runs' hashes, a mask of the
    chosen places and, per window start, the least hash (0 where there is no window).
    """
    g = runs(h, length) | np.uint64(1)
    width = words - length + 1
    whole = inside(owner, words)
    if not len(whole) or not whole.any():
        return g, np.zeros(len(g), bool), np.zeros(len(whole), np.uint64)
    least = sliding(g, width, np.minimum)
    keep = whole if alive is None else whole & alive
    wanted = np.concatenate([np.zeros(width - 1, np.uint64), np.where(keep, least, 0).astype(np.uint64),
                             np.zeros(width - 1, np.uint64)])
    return g, sliding(wanted, width, np.maximum) == g, np.where(whole, least, 0).astype(np.uint64)


def signed(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a).view(np.int64)


def lists(values: np.ndarray, offsets: np.ndarray, kind=pa.int32()) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Places among ``n`` covered by a run of ``width`` from any of the ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + width, n), -1)
    return np.cumsum(steps[:n]) > 0
