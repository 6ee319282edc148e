"""Hashed text features, computed on whole texts with numpy inside tasks."""

from __future__ import annotations

import numpy as np

_PRIME = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
LONGEST_WORD = 24        # longer runs are read as words of this many bytes, one after the other


def _spread(h: np.ndarray, seed: int) -> np.ndarray:
    h = (h + np.uint64(seed * 0x51_7C_C1_B7 + 1)) * _MIX
    h ^= h >> np.uint64(29)
    h *= _MIX
    return h ^ (h >> np.uint64(32))


def _fold(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int32)


def gram_hashes(b: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashes of the n-byte windows of ``b``."""
    m = len(b) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h *= _PRIME
        h += b[k:k + m]
    return _spread(h, seed * 31 + n)


def runs(member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the maximal runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], member, [False]))))
    return edge[::2], edge[1::2] - edge[::2]


def windowed(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs, those above ``LONGEST_WORD`` cut into windows: no part of a text goes unread."""
    pieces = -(-lengths // LONGEST_WORD)
    if not len(pieces) or pieces.max() <= 1:
        return starts, lengths
    run = np.repeat(np.arange(len(starts)), pieces)
    at = LONGEST_WORD * (np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    return starts[run] + at, np.minimum(LONGEST_WORD, lengths[run] - at)


def word_hashes(b: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
                prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, list[np.ndarray]]:
    """(hash of each word, for each prefix length the hashes of longer words' prefixes)."""
    h = np.zeros(len(starts), np.uint64)
    heads = []
    active = np.arange(len(starts))
    for k in range(min(LONGEST_WORD, int(lengths.max(initial=0)))):
        active = active[lengths[active] > k]
        h[active] = h[active] * _PRIME + b[starts[active] + k] + np.uint64(1)
        if k + 1 in prefixes:
            heads.append(_spread(h[active[lengths[active] > k + 1]], 977 + k))
    return _spread(h + lengths.astype(np.uint64) * _PRIME, 7), heads


class Distinct:
    """Distinct values of an index array below 2^bits, without sorting."""

    def __init__(self, bits: int):
        self.last = np.empty(1 << bits, np.int32)

    def __call__(self, idx: np.ndarray) -> np.ndarray:
        order = np.arange(len(idx), dtype=np.int32)
        self.last[idx] = order
        return idx[self.last[idx] == order]


LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# shapes: capital, other letter, digit; spaces and signs stay themselves
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[65:91] = 65
SHAPE[97:123] = 97
SHAPE[128:] = 97
SHAPE[48:58] = 57


def letters_of(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").lower().encode("utf-8", "replace"), np.uint8)


def word_features(text: str | None, bits: int) -> np.ndarray:
    """Words (runs of letters, lower-cased) and the 4, 5 and 6 first bytes of longer words."""
    b = letters_of(text)
    starts, lengths = windowed(*runs(LETTER[b]))
    whole, heads = word_hashes(b, starts, lengths, (4, 5, 6))
    return _fold(np.concatenate([whole, *heads]), bits)


def quality_features(text: str | None, bits: int) -> np.ndarray:
    """n-grams that tell prose from junk, of characters, shapes, and repeated words.

    Characters by 2 and 3; shapes by 3 and 6; shapes with runs collapsed by 4 and 8; words by two
    and three, where a word equal to the one before is written as "same".
    """
    b = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    shape = SHAPE[b]
    flat = shape[np.concatenate(([True], shape[1:] != shape[:-1]))] if len(shape) else shape
    parts = [gram_hashes(b, 2, 1), gram_hashes(b, 3, 2), gram_hashes(shape, 3, 3),
             gram_hashes(shape, 6, 4), gram_hashes(flat, 4, 5), gram_hashes(flat, 8, 6)]
    starts, lengths = windowed(*runs(~SPACE[b]))
    words, _ = word_hashes(b, starts, lengths)
    if len(words) > 1:
        same = (words[1:] == words[:-1]).astype(np.uint8)
        parts += [gram_hashes(same, n, 8) for n in (1, 2, 4)]
    return _fold(np.concatenate(parts), bits)


def language_features(text: str | None, bits: int) -> np.ndarray:
    """1- to 4-byte windows of the lower-cased text, all but letters as one blank."""
    b = letters_of(text)
    member = LETTER[b]
    b = np.where(member, b, np.uint8(32))
    b = b[member | np.concatenate(([False], member[:-1]))] if len(b) else b
    return _fold(np.concatenate([gram_hashes(b, n, 9) for n in (1, 2, 3, 4)]), bits)
