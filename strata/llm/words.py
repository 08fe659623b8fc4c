"""Arrow and numpy helpers: split texts into words, handle each distinct word
once, and spread the per-word results back over the documents.

A word is a maximal run of characters other than ASCII white space
(``[^\\x20\\x09-\\x0D]+``).  Work per batch is bounded by ``MAX_BYTES`` of
text (one longer text forms a batch of its own; texts are never cut)."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

MAX_BYTES = 3 << 20


def texts_of(column: pa.Array) -> pa.Array:
    """The column as plain Arrow strings; null reads as the empty text."""
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "")


def give_back() -> None:
    """Return freed memory to the system: Python workers are used again by
    later stages, and would otherwise keep the most that any task needed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # no glibc
        pass


def bounded(batches: Iterable[pa.RecordBatch], text: str = "text", max_bytes: int = MAX_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut at row boundaries so that each holds at most
    ``max_bytes`` of text, or one row.  After each of Spark's batches, what
    the work on it held is given back."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(size)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
            yield batch.slice(first, last - first)
            first = last
        del batch
        give_back()


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(offsets, codes, words): text ``i`` is ``codes[offsets[i]:offsets[i+1]]``,
    each code an index into the distinct ``words``."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    encoded = lists.flatten().dictionary_encode()
    offsets = offsets - offsets[0]
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    words = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
    if "" in (seen := set(words)) and seen:  # white space at either end of a text gives an empty word
        keep = codes != words.index("")
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return offsets, codes, words


def spread(codes: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace every word by its own sequence.

    Word ``c`` stands for the ``lengths[c]`` values of ``flat`` that follow
    those of the words before it.  Returns the documents' new offsets and values."""
    if len(codes) == 0:
        return np.zeros(len(offsets), np.int64), flat[:0]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    per_word = lengths[codes]
    ends = np.concatenate([[0], np.cumsum(per_word)])
    at = np.repeat(starts[codes] - ends[:-1], per_word) + np.arange(ends[-1])
    return ends[offsets], flat[at]


def hash_words(words: list[str]) -> np.ndarray:
    """64-bit fingerprints of the words, the same on every machine."""
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), element by element."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of each text's distinct ``n``-word shingles, sorted inside
    the text; a text of fewer words gives its whole sequence as one, an empty
    text none.  ``hashes`` are word fingerprints.  Returns (offsets, values)."""
    counts = np.diff(offsets)
    rows = len(counts)
    value = np.zeros(len(hashes), np.uint64)
    left = np.repeat(offsets[1:], counts) - np.arange(len(hashes))  # words from here to the end of the text
    for i in range(n):
        inside = left > i
        step = np.zeros(len(hashes), np.uint64)
        step[: len(hashes) - i] = hashes[i:]
        value = np.where(inside, mix(value ^ step) + np.uint64(i + 1), value)
    short = np.repeat(counts < n, counts)
    first = np.zeros(len(hashes), bool)
    first[offsets[:-1][counts > 0]] = True
    keep = (left >= n) | (short & first)
    doc = np.repeat(np.arange(rows), counts)[keep]
    value = value[keep]
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[new], value[new]
    return np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=rows))]).astype(np.int64), value
