"""Word shingles of many texts at once, as 64-bit hashes in numpy."""

from __future__ import annotations

import numpy as np

#: Bytes of text that are hashed together (a longer text is hashed alone, whole).
CHUNK_BYTES = 1 << 20

_rng = np.random.default_rng(20240817)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[_SPACE] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BASE = int(_rng.integers(1 << 62, 1 << 63)) * 2 + 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _POWERS[name] = np.multiply.accumulate(table)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))  # a new array, the rest is done in place
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and how many words each text has.  Words are runs of bytes other
    than space and 0x09-0x0D, with A-Z in lower case."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    solid = ~_SPACE[data]
    edge = np.diff(solid.view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * up[:-1], out=total[1:])
    words = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    stops = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, stops), prepend=0)
    return words, counts


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Per text its sorted distinct shingle hashes.  A text with fewer than ``width`` words has
    the whole sequence as one shingle, a text without words none."""
    words, counts = word_hashes(texts)
    step = np.uint64(0x9E3779B97F4A7C15)
    rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        rolled = rolled * step + words[k:k + len(rolled)]
    rolled = mix(rolled)
    out, at = [], 0
    for n in counts.tolist():
        if n >= width:
            out.append(np.unique(rolled[at:at + n - width + 1]))
        elif n:
            short = np.uint64(n)
            with np.errstate(over="ignore"):
                for w in words[at:at + n]:
                    short = short * step + w
            out.append(mix(np.array([short])))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def in_chunks(texts: list[bytes], size: int = CHUNK_BYTES):
    """Slices of ``texts`` with about ``size`` bytes each."""
    begin = held = 0
    for k, t in enumerate(texts):
        held += len(t) + 1
        if held >= size or k == len(texts) - 1:
            yield begin, texts[begin:k + 1]
            begin, held = k + 1, 0
