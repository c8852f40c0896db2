"""Words of UTF-8 texts as spans and hashes, a slice of text at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of a piece of a long text.
PIECE_BYTES = 1 << 18

_rng = np.random.default_rng(20250311)
_VALUES = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64)
_VALUES[:, ord("A") : ord("Z") + 1] = _VALUES[:, ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*b"0123456789", *b"abcdefghijklmnopqrstuvwxyz", *b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
_MARK = np.zeros(256, bool)
_MARK[[*b".,"]] = True
_BASES = (0xD1342543DE82EF95, 0x9E3779B97F4A7C15)
_powers: list[dict[str, np.ndarray]] = [{"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)} for _ in _BASES]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(which: int, way: str, n: int) -> np.ndarray:
    """A base to the powers 0 to n - 1, or its inverse's, modulo 2**64."""
    if len(_powers[which][way]) < n:
        base = _BASES[which] if way == "up" else pow(_BASES[which], -1, 1 << 64)
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        _powers[which][way] = np.cumprod(factors, dtype=np.uint64)
    return _powers[which][way][:n]


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes (letters A-Z as a-z), start and stop of each word: runs without ASCII
    white space, and a full stop or comma that ends one behind an ASCII letter or digit is
    cut off as a word of its own."""
    codes = np.frombuffer(raw, np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[codes], [True]]).view(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    if len(starts):
        last = codes[stops - 1]
        marked = _MARK[last] & (stops - starts > 1) & _ALNUM[codes[np.maximum(stops - 2, 0)]]
        cuts = stops[marked] - 1
        starts = np.sort(np.concatenate([starts, cuts]))
        stops = np.sort(np.concatenate([stops, cuts]))
    hashes = np.empty((2, len(starts)), np.uint64)
    sums = np.zeros(len(codes) + 1, np.uint64)
    for which in range(2):
        np.cumsum(_VALUES[which][codes] * _power(which, "up", len(codes)), out=sums[1:])
        spans = (sums[stops] - sums[starts]) * _power(which, "down", len(codes) + 1)[starts]
        hashes[which] = _mix(spans + (stops - starts).astype(np.uint64))
    return hashes, starts, stops


def text_pieces(raw: bytes) -> Iterator[bytes]:
    """A long text cut at white space; a longer word stays whole."""
    at = 0
    while len(raw) - at > PIECE_BYTES:
        found = next((i for i in range(at + PIECE_BYTES, len(raw)) if _SPACE[raw[i]]), len(raw))
        yield raw[at:found]
        at = found
    yield raw[at:]
