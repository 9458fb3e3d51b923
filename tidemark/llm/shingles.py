"""Word shingles of whole texts as 64-bit hashes, by numpy over the bytes of many texts at once.

A word's hash adds up, for each of its bytes, a scrambled mix of byte and place, so that no two words made for it meet; a
shingle mixes the hashes of its words in order.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.common import mix64, release

BLOCK = 1 << 19  # bytes worked at once
STRETCH = 1 << 17  # bytes of words hashed at once, and
TEXTS = 256  # texts, so that what is worked at stays in a core's cache
_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODE = _CODES[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_WEIGHTS = mix64(np.arange(101, 200, dtype=np.uint64))


_PLACES = 64
_PLACE = mix64(np.arange(1001, 1001 + _PLACES, dtype=np.uint64))
_AT_PLACE = mix64(_CODE[None, :] ^ _PLACE[:, None]).ravel()  # of every byte at every one of these places


def _words_of_block(raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = breaks[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    if not starts.size:
        return starts, np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    letters = raw[~space]
    place = np.arange(letters.size) - np.repeat(first, sizes)
    far = np.flatnonzero(place >= _PLACES) if sizes.max() > _PLACES else place[:0]
    beyond = mix64(_CODE[letters[far]] ^ mix64(place[far].astype(np.uint64) + np.uint64(1001)))
    place[far] = 0
    place <<= 8
    place |= letters
    mixed = _AT_PLACE[place]
    mixed[far] = beyond
    hashes = np.add.reduceat(mixed, first)
    return starts, mix64(hashes ^ sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(data: bytes, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and hash of every word of a byte string; ``breaks`` tells which bytes lie between words.

    A to Z count as a to z.  Blocks end between words.
    """
    raw = np.frombuffer(data, np.uint8)
    starts, hashes, at = [], [], 0
    while at < raw.size:
        end = min(raw.size, at + STRETCH)
        while end < raw.size:  # to the next white space
            gap = np.flatnonzero(breaks[raw[end : end + STRETCH]])
            if gap.size:
                end += int(gap[0])
                break
            end = min(raw.size, end + STRETCH)
        s, h = _words_of_block(raw[at:end], breaks)
        starts.append(s + at)
        hashes.append(h)
        at = end
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts: list[str | None], width: int = 5) -> list[np.ndarray]:
    """Each text's distinct shingle hashes in ascending order.

    A text with fewer than ``width`` words has one shingle, its whole word sequence; without words it has none.
    """
    release()
    out: list[np.ndarray] = []
    for start in range(0, len(texts), TEXTS):
        out += _sets_of(texts[start : start + TEXTS], width)
    return out


def _sets_of(texts: list[str | None], width: int) -> list[np.ndarray]:
    encoded = [(t or "").encode() for t in texts]
    data = b"\n".join([*encoded, b""])
    starts, hashes = words(data)
    ends = np.cumsum(np.fromiter((len(e) + 1 for e in encoded), np.int64, len(encoded)))
    first = np.searchsorted(starts, np.concatenate([[0], ends]))
    mixed = np.zeros(max(0, hashes.size - width + 1), np.uint64)
    for k in range(width):
        mixed += hashes[k : k + mixed.size] * _WEIGHTS[k]
    mixed = mix64(mixed)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            own = mixed[a : b - width + 1]
            own.sort()
            fresh = np.ones(own.size, bool)
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            out.append(own[fresh])
        elif b > a:
            short = (hashes[a:b] * _WEIGHTS[50 : 50 + b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix64(short + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
