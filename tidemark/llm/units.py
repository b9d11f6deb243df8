"""Texts cut into short units, each distinct unit handled once.

A unit runs from one cut to the next; a cut lies before every space that follows a
character which is no white space.  Tokenizers that part words at such places treat
each unit by itself, so a unit's result is found once and gathered by its index.
All work here is on Arrow buffers: no Python object per occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
# Last and next-to-last byte of every white space character beyond ASCII in UTF-8.
# Letters that share both are taken for white space too: fewer cuts, never a wrong one.
_TAIL, _LEAD = np.zeros(256, bool), np.zeros(256, bool)
_TAIL[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_LEAD[[0xC2, 0x80, 0x81, 0x9A]] = True


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, UTF-8 bytes) of an array of texts; nulls are empty."""
    a = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if not len(a):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, off, data = a.buffers()
    off = np.frombuffer(off, np.int64)[a.offset:a.offset + len(a) + 1]
    data = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return off - off[0], data


def binaries(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """The binary values between consecutive offsets of ``data``."""
    offsets = np.ascontiguousarray(offsets, np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def cut(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(units, first): the units of all texts in order, as a dictionary array of
    bytes, and where each text's units begin (one entry more than texts)."""
    off, data = buffers(texts)
    at = np.flatnonzero(data == 32)
    at = at[at > 0]
    before = data[at - 1]
    odd = _TAIL[before] & _LEAD[data[at - 2]]
    first = np.zeros(len(data), bool)
    first[at[~(_BLANK[before] | odd)]] = True
    first[off[:-1][np.diff(off) > 0]] = True
    starts = np.flatnonzero(first)
    units = binaries(np.append(starts, len(data)), data) if len(starts) else pa.array([], pa.large_binary())
    return units.dictionary_encode(), np.searchsorted(starts, off)


def words(texts: pa.Array, apart: np.ndarray, swap: np.ndarray | None = None) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(words, first) like ``cut``: the maximal runs of bytes not in ``apart`` (256 flags),
    each byte replaced by its entry in ``swap``."""
    off, data = buffers(texts)
    inner = ~apart[data]
    start = inner.copy()
    start[1:] &= ~inner[:-1]
    at = off[:-1][np.diff(off) > 0]
    start[at] = inner[at]
    kept = data[inner] if swap is None else swap[data[inner]]
    begin = np.flatnonzero(start[inner])
    first = np.searchsorted(np.flatnonzero(start), off)
    found = binaries(np.append(begin, len(kept)), kept) if len(begin) else pa.array([], pa.large_binary())
    return found.dictionary_encode(), first


def gather(flat: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices ``flat[offsets[w]:offsets[w + 1]]`` one after another, for all ``which``;
    and where each begins in the result (one entry more than slices)."""
    sizes = (offsets[1:] - offsets[:-1])[which]
    begin = np.zeros(len(which) + 1, np.int64)
    np.cumsum(sizes, out=begin[1:])
    place = np.arange(begin[-1]) + np.repeat(offsets[:-1][which] - begin[:-1], sizes)
    return flat[place], begin


def packed(items: list[bytes], dtype) -> tuple[np.ndarray, np.ndarray]:
    """(flat, offsets) of byte strings that hold numbers of ``dtype``."""
    width = np.dtype(dtype).itemsize
    offsets = np.zeros(len(items) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, items), np.int64, len(items)), out=offsets[1:])
    return np.frombuffer(b"".join(items), dtype), offsets // width


def spans(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``size`` bytes."""
    off, _ = buffers(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(off, off[at] + size, side="right")) - 1)
        yield at, to
        at = to
