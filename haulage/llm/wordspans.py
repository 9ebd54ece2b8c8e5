"""Words of a batch of texts as arrays: places found on the UTF-8 bytes, no Python object per word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Tables of byte classes for `spans`: bytes that end a word.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Words:
    """Words in the order of the texts: dictionary code, text number and, at each border, the place in `codes`."""

    codes: np.ndarray  # code of each word in `distinct`
    distinct: pa.Array  # binary
    texts: np.ndarray  # number of its text, ascending
    starts: np.ndarray  # first byte in the joined bytes
    ends: np.ndarray


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts with one line feed behind each, and where each text starts in them (one more at the end)."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None and len(body) else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    whole = np.full(starts[-1], 0x0A, np.uint8)
    inside = np.ones(starts[-1], bool)
    inside[starts[1:] - 1] = False
    whole[inside] = data
    return whole, starts


def spans(whole: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each maximal run of bytes outside `blank`; the last byte has to be in it."""
    word = np.concatenate([[False], ~blank[whole]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    return edge[0::2], edge[1::2]


def coded(whole: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Each word's code and the distinct words."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    marks = np.zeros(len(whole) + 1, np.int8)
    marks[starts] += 1
    marks[ends] -= 1
    body = whole[np.cumsum(marks[:-1], dtype=np.int8).astype(bool)]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body))])
    found = words.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary


def words_of(column: pa.Array, blank: np.ndarray = BLANKS) -> Words:
    whole, text_starts = joined(column)
    starts, ends = spans(whole, blank)
    codes, distinct = coded(whole, starts, ends)
    texts = np.searchsorted(text_starts, starts, side="right") - 1
    return Words(codes, distinct, texts, starts, ends)


def slices(column: pa.Array, most: int) -> list[tuple[int, int]]:
    """(first text, length) of neighbouring texts of about `most` bytes together; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // most
    cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    return [(int(a), int(b - a)) for a, b in zip(cuts, np.append(cuts[1:], len(group)))]
