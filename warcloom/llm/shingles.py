"""Word shingles of whole texts as sorted 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .common import mix64

WIDTH = 5

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_SLOT = mix64(np.arange(101, 101 + WIDTH, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
#: Texts are hashed in blocks of about this many bytes, which bounds memory.
BLOCK_BYTES = 500_000


def _position(n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)


def _block(encoded: list[bytes]) -> list[np.ndarray]:
    data = np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)
    starts = np.cumsum([0] + [len(e) + 1 for e in encoded])[:-1]
    separator = _SEPARATOR[data]
    inside = np.flatnonzero(~separator)
    if not len(inside):
        return [np.zeros(0, np.uint64)] * len(encoded)
    # Compact index of the first byte of each word.
    first = np.flatnonzero(np.diff(inside, prepend=-2) > 1)
    length = np.diff(first, append=len(inside))
    offset = np.arange(len(inside)) - np.repeat(first, length)
    value = _BYTE[_LOWER[data[inside]]] * _position(int(length.max()))[offset]
    word = mix64(np.add.reduceat(value, first) + length.astype(np.uint64))
    owner = np.searchsorted(starts, inside[first], "right") - 1
    counts = np.bincount(owner, minlength=len(encoded))
    if len(word) >= WIDTH:
        joined = sum(word[j:len(word) - WIDTH + 1 + j] * _SLOT[j] for j in range(WIDTH))
        joined = mix64(joined)
    else:
        joined = np.zeros(0, np.uint64)
    out, at = [], 0
    for n in counts:
        if n >= WIDTH:
            out.append(np.unique(joined[at:at + n - WIDTH + 1]))
        elif n:
            # Fewer words: the whole sequence is the one shingle, told apart by its length.
            out.append(mix64((word[at:at + n] * _SLOT[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, in ascending order; empty without words or text."""
    block: list[bytes] = []
    size = 0
    for text in texts:
        encoded = (text or "").encode()
        if block and size + len(encoded) > BLOCK_BYTES:
            yield from _block(block)
            block, size = [], 0
        block.append(encoded)
        size += len(encoded)
    if block:
        yield from _block(block)


def set_name(shingles: np.ndarray) -> int:
    """Signed 64-bit name of a set; equal sets share it."""
    total = mix64(shingles).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(shingles))
    return int(mix64(total).view(np.int64)[0])
