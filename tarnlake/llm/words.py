"""Words of whole texts as hashes, in batches: the vectorised base of the text operators.

A word is a maximal run of characters other than space and the ASCII controls
``\\t \\n \\v \\f \\r``. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from tarnlake.llm.hashing import mix64

#: The word pattern for Spark's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes handled at once; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of each part take about ``size`` bytes together."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // size
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    for start, end in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
        yield batch.slice(start, end - start)
    pa.default_memory_pool().release_unused()  # an idle worker would keep it for a minute


def split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Word codes of all texts in order, the bounds of each text in them, and the distinct words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten()
    bounds = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    distinct = coded.dictionary
    if len(distinct):
        empty = pc.index(distinct, "").as_py()
        if empty >= 0:
            full = codes != empty
            bounds = np.r_[0, np.cumsum(full)][bounds]
            codes = codes[full]
    return codes, bounds, distinct


def hashed(distinct: pa.Array, of: Callable[[str], int] = xxhash.xxh3_64_intdigest) -> np.ndarray:
    """A 64-bit hash of each distinct word."""
    return np.fromiter(map(of, distinct.to_pylist()), dtype=np.uint64, count=len(distinct))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts in order, and the bounds of each text in them."""
    codes, bounds, distinct = split(texts)
    return (hashed(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)), bounds


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``k`` words, and the bounds of each text in these.

    A text of fewer than ``k`` words has one shingle of all of them, an empty text none.
    """
    n = np.diff(bounds)
    counts = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    out_bounds = np.r_[0, np.cumsum(counts)]
    at = np.repeat(bounds[:-1] - out_bounds[:-1], counts) + np.arange(out_bounds[-1])
    room = np.repeat(bounds[1:], counts) - at
    value = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            there = room > i
            if there.all():
                value = mix64(value ^ hashes[at + i])
            else:
                value[there] = mix64(value[there] ^ hashes[at[there] + i])
    return value, out_bounds
