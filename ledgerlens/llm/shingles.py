"""Sets of word shingles as sorted 64-bit hashes, a batch of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from .common import release

_BASE = 0x9E3779B97F4A7C15                      # odd: invertible modulo 2 ** 64
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BATCH_BYTES = 400_000
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_BYTES = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64, endpoint=False)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = (np.full(n, x, np.uint64) for x in (_BASE, _INVERSE))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * _MIX
    return h ^ (h >> np.uint64(32))


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word: a polynomial over its bytes, taken as a
    difference of prefix sums."""
    raw = np.frombuffer(data, np.uint8)
    size = 1 << max(19, int(len(raw) + 1).bit_length())
    up, down = _powers(size)
    solid = ~_SPACE[raw]
    edge = np.diff(solid.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[raw] * up[:len(raw)], dtype=np.uint64)])
    h = (sums[ends] - sums[starts]) * down[starts]
    return _mixed(h + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: list[str], width: int = 5) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``width``-word shingles (the
    whole sequence when it has fewer words; empty without words). A-Z are
    lower-cased, words are runs of ``[^\\x20\\x09-\\x0D]``."""
    release()
    group, size = [], 0
    for text in [*texts, None]:
        data = None if text is None else text.encode("utf-8", "surrogatepass").lower()
        if group and (data is None or size + len(data) > _BATCH_BYTES):
            yield from _group(group, width)
            group, size = [], 0
        if data is not None:
            group.append(data)
            size += len(data)


def _group(group: list[bytes], width: int) -> Iterator[np.ndarray]:
    words, starts = _words(b"\n".join(group))
    cuts = np.searchsorted(starts, np.cumsum([0, *(len(d) + 1 for d in group)]))
    many = len(words) - width + 1
    rolled = np.zeros(max(many, 0), np.uint64)
    for k in range(width):
        if many > 0:
            rolled = rolled * np.uint64(_BASE) + words[k:k + many]
    rolled = _mixed(rolled)
    for a, b in zip(cuts, cuts[1:]):
        if b - a >= width:
            yield np.unique(rolled[a:b - width + 1])
        elif b > a:
            h = np.array([b - a], np.uint64)
            for w in words[a:b]:
                h = h * np.uint64(_BASE) + w
            yield _mixed(h)
        else:
            yield np.zeros(0, np.uint64)
