"""Word shingles as 64-bit hashes, for a whole batch of texts at once."""

from __future__ import annotations

from itertools import chain

import numpy as np
import xxhash

#: One odd multiplier for each place of a word in a shingle.
PLACES = np.asarray([xxhash.xxh3_64_intdigest(b"place %d" % i) | 1 for i in range(64)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit sums."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def hashed_words(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts in a row, and where each text starts (one more at the end)."""
    flat = list(chain.from_iterable(texts))
    place = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, place), np.uint64, len(place))
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    if not flat:
        return np.zeros(0, np.uint64), starts
    return hashes[np.fromiter(map(place.__getitem__, flat), np.int64, len(flat))], starts


def rolled(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total += words[i : i + n] * PLACES[i]
    return mix(total)


def shingle_sets(texts: list[list[bytes]], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text in a row, and how many each has.

    A text with fewer words than ``width`` is one shingle, one without words has none.
    """
    words, starts = hashed_words(texts)
    runs = rolled(words, width)
    sets = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= width:
            own = runs[a : b - width + 1]
            own.sort()
        else:
            own = rolled(words[a:b], b - a) if b > a else words[:0]
        sets.append(own)
    sizes = np.asarray([len(x) for x in sets], np.int64)
    if not sizes.sum():
        return np.zeros(0, np.uint64), sizes
    flat = np.concatenate(sets)
    text = np.repeat(np.arange(len(sets)), sizes)
    fresh = np.ones(len(flat), bool)
    fresh[1:] = (flat[1:] != flat[:-1]) | (text[1:] != text[:-1])
    return flat[fresh], np.bincount(text[fresh], minlength=len(sets))


def cut_by(flat: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The parts of a row of arrays."""
    return np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []
