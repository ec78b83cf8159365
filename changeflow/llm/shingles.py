"""Sets of hashed word shingles of whole texts, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5

#: Multiplier of the rolling polynomial; odd, so that it can be divided out.
BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: A random number for every byte, so that the polynomial is not over small numbers; powers are made as needed.
BYTES = mixed(np.arange(1, 257, dtype=np.uint64))
POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global POWERS
    if len(POWERS) < n:
        with np.errstate(over="ignore"):
            POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, BASE)]), dtype=np.uint64)
    return POWERS[:n]


INVERSE = np.ones(1, np.uint64)
BACK = np.uint64(pow(int(BASE), -1, 2**64))


def inverse_powers(n: int) -> np.ndarray:
    global INVERSE
    if len(INVERSE) < n + 1:
        with np.errstate(over="ignore"):
            INVERSE = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n + 1, BACK)]), dtype=np.uint64)
    return INVERSE


#: Bytes of text whose shingles are made at once.
CHUNK = 1 << 18


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, A-Z as a-z, and where it starts; words are runs of anything but ASCII white space."""
    upper = (raw >= 65) & (raw <= 90)
    raw = np.where(upper, raw + np.uint8(32), raw)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    with np.errstate(over="ignore"):
        # sum of byte * BASE^place within a word, by Horner's rule over the places of all words at once
        values = BYTES[raw] * powers(len(raw))[::-1]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        found = (sums[ends] - sums[starts]) * inverse_powers(len(raw))[len(raw) - ends]
        return mixed(found ^ (ends - starts).astype(np.uint64)), starts


def rolled(hashes: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """The hash of ``width`` words from each of ``first`` on."""
    total = np.full(len(first), np.uint64(width))
    with np.errstate(over="ignore"):
        for i in range(width):
            total = mixed(total * BASE + hashes[first + i])
    return total


def shingle_sets(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The sets of some texts one after the other, and where each begins and the last ends.

    A set holds the sorted distinct hashes of all runs of ``words`` words; fewer words are one run; no words, an
    empty set.
    """
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    begins = np.cumsum([0, *(len(e) + 1 for e in encoded)])
    hashes, starts = word_hashes(np.frombuffer(b" ".join(encoded), np.uint8))
    counts = np.diff(np.searchsorted(starts, begins))
    at = np.concatenate([[0], np.cumsum(counts)])
    sizes = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    edges = np.concatenate([[0], np.cumsum(sizes)])
    # the place of a run is its word, less the words at the ends of texts before that begin none
    first = np.arange(edges[-1]) + np.repeat(at[:-1] - edges[:-1], sizes)
    if (counts[counts > 0] >= words).all():
        flat = rolled(hashes, first, words)
    else:
        flat = np.empty(edges[-1], np.uint64)
        widths = np.repeat(np.minimum(counts, words), sizes)
        for width in range(1, words + 1):
            flat[widths == width] = rolled(hashes, first[widths == width], width)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        flat[a:b].sort()
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[edges[:-1][sizes > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return flat[new], kept[edges]


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    return shingle_sets([text], words)[0]


def in_chunks(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """:func:`shingle_sets` of some texts at a time, with the number of the first."""
    at = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= CHUNK or i + 1 == len(texts):
            yield at, *shingle_sets(texts[at : i + 1])
            at, size = i + 1, 0
