"""Hashes of words, and of runs of words, of many texts at once.

A word is read in lanes of eight bytes, each mixed with the number of its place
before the lanes are added up, and the sum is mixed with the word's length. So
no words are known whose hashes are equal, as there are for sums over bytes, and
all words of a block of texts are hashed by a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

from tidemark.llm.common import turn

BLOCK_BYTES = 512 * 1024  # of texts that are hashed together, or one text

_ODD = 0x9E3779B97F4A7C15
LANE = 8
# Which bytes of a lane belong to the word, by how many are left of it.
MASKS = np.array([(1 << (8 * n)) - 1 for n in range(LANE + 1)], np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


# Bytes that separate words: white space of ASCII.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
INSIDE = (~SPACES).tobytes()  # as a table to translate by


def blocks(rows: Iterable, size) -> Iterator[list]:
    """Lists of rows that together have about ``BLOCK_BYTES``."""
    turn(__name__)
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row) + 1
        if total >= BLOCK_BYTES:
            yield held
            held, total = [], 0
    if held:
        yield held


def _lane_sums(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each word the sum of its mixed lanes."""
    padded = np.concatenate([data, np.zeros(LANE, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    sums = mix((lanes[starts] & MASKS[np.minimum(sizes, LANE)]) + np.uint64(_ODD))
    longer = np.flatnonzero(sizes > LANE)
    if not len(longer):
        return sums
    starts, left = starts[longer] + LANE, sizes[longer] - LANE
    count = -(-left // LANE)
    first = np.cumsum(count) - count
    place = np.arange(count.sum()) - np.repeat(first, count)
    left = np.minimum(np.repeat(left, count) - LANE * place, LANE)
    held = lanes[np.repeat(starts, count) + LANE * place] & MASKS[left]
    mixed = mix(held + (place + 2).astype(np.uint64) * np.uint64(_ODD))
    sums[longer] += np.add.reduceat(mixed, first)
    return sums


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of the texts, A to Z lower-cased: hash, first byte, number of the text.

    First bytes count in the texts joined by one byte.
    """
    joined = b"\n".join(texts).lower()
    data = np.frombuffer(joined, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends_of_texts = np.cumsum(sizes + 1)
    inside = np.frombuffer(b"\0" + joined.translate(INSIDE) + b"\0", bool)
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns.reshape(-1, 2).T.copy()
    hashes = mix(_lane_sums(data, starts, ends - starts) ^ (ends - starts).astype(np.uint64))
    counts = np.diff(np.searchsorted(starts, ends_of_texts), prepend=0)
    return hashes, starts, np.repeat(np.arange(len(texts)), counts)


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``size``-word shingles of all texts and where those of each text end.

    A text with fewer words has its whole sequence as one; one without words none.
    """
    hashes, _, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    firsts = np.cumsum(counts) - counts
    whole = hashes[: max(0, len(hashes) - size + 1)]
    for n in range(1, size):
        whole = mix(whole * np.uint64(_ODD) + hashes[n : len(hashes) - size + 1 + n])
    found, ends, total = [], [], 0
    for first, count in zip(firsts.tolist(), counts.tolist()):
        if count >= size:
            own = np.unique(whole[first : first + count - size + 1])
        elif count:
            own = np.array([count], np.uint64)
            for n in range(first, first + count):
                own = mix(own * np.uint64(_ODD) + hashes[n : n + 1])
        else:
            own = hashes[:0]
        total += len(own)
        found.append(own)
        ends.append(total)
    return np.concatenate(found) if found else hashes[:0], np.array(ends, np.int64)
