"""Cutting the bytes of many texts into words at once, and finding the distinct ones."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

#: Punctuation that is cut from the ASCII letters before it.
TAIL = b".,;:!?$*&%#|"


def cut_words(data: np.ndarray, blanks: bytes = b" \n", tail: bytes = TAIL) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and how long they are; the data ends in a blank."""
    kind = np.zeros(256, np.uint8)
    kind[list(blanks)] = 1
    kind[list(tail)] = 2
    kind[97:123] = 3
    kinds = kind[data]
    blank = kinds == 1
    begins = ~blank
    begins[1:] &= blank[:-1] | ((kinds[1:] == 2) & (kinds[:-1] == 3))
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(blank)
    # a word ends at the next blank, or where the next word starts
    stop = ends[np.searchsorted(ends, starts)]
    stop[:-1] = np.minimum(stop[:-1], starts[1:])
    return starts, stop - starts


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Words of more bytes are hashed and compared one by one.
LONG = 64

#: What eight bytes of a word are cut to by its length.
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of the data on, as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def _blocks(eights: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray | slice, np.ndarray]]:
    """Eight bytes after eight of the words that have them: which words, and the bytes."""
    yield slice(None), eights[starts] & MASKS[np.minimum(lengths, 8)]
    for k in range(8, LONG, 8):
        rows = np.flatnonzero(lengths > k)
        if not len(rows):
            return
        yield rows, eights[starts[rows] + k] & MASKS[np.minimum(lengths[rows] - k, 8)]


def word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    return _hashes(data, _eights(data), starts, lengths)


def _hashes(data: np.ndarray, eights: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    hashes = lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for rows, block in _blocks(eights, starts, lengths):
        hashes[rows] = mix(hashes[rows] + block)
    for i in np.flatnonzero(lengths > LONG).tolist():
        word = data[starts[i] : starts[i] + lengths[i]].tobytes()
        hashes[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return hashes


def distinct_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One occurrence of each distinct word, and per word which it is.

    Words are told apart by their hash; every word is then compared
    with its representative, and a collision falls back to comparing all.
    """
    eights = _eights(data)
    hashes = _hashes(data, eights, starts, lengths)
    for by_hash in (_distinct_ends, _distinct):
        one, same = by_hash(hashes)
        twins = one[same]
        if not np.array_equal(lengths[twins], lengths):
            continue
        if all(
            np.array_equal(eights[starts[twins[rows]] + 8 * k] & MASKS[np.minimum(lengths[rows] - 8 * k, 8)], block)
            for k, (rows, block) in enumerate(_blocks(eights, starts, lengths))
        ) and all(_bytes(data, starts, lengths, i) == _bytes(data, starts, lengths, twins[i]) for i in np.flatnonzero(lengths > LONG)):
            return one, same
    seen: dict[bytes, int] = {}
    same = np.array([seen.setdefault(_bytes(data, starts, lengths, i), len(seen)) for i in range(len(starts))])
    return np.unique(same, return_index=True)[1], same


def _distinct_ends(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By as many bits of the hashes as leave room for a place beside them: plain numbers sort far faster than places do."""
    room = np.uint64(len(hashes).bit_length())
    keys = (hashes << room) | np.arange(len(hashes), dtype=np.uint64)
    keys.sort()
    order = (keys & ((np.uint64(1) << room) - np.uint64(1))).astype(np.int64)
    keys >>= room
    new = np.append(True, keys[1:] != keys[:-1])
    same = np.empty(len(hashes), np.int64)
    same[order] = np.cumsum(new) - 1
    return order[new], same


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(hashes, return_index=True, return_inverse=True)[1:]


def _bytes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, i: int) -> bytes:
    return data[starts[i] : starts[i] + lengths[i]].tobytes()
