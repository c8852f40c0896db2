"""Sets of hashed word shingles, whole batches of texts at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

WORDS = 5
#: Bytes of text that are hashed at once.
SLICE = 1 << 20

_rng = np.random.default_rng(20240607)
_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_VALUES[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE, _STEP = 0xD1342543DE82EF95, np.uint64(0x9E3779B97F4A7C15)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(way: str, n: int) -> np.ndarray:
    """_BASE to the powers 0 to n - 1, or its inverse's, modulo 2**64."""
    if len(_powers[way]) < n:
        base = _BASE if way == "up" else pow(_BASE, -1, 1 << 64)
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        _powers[way] = np.cumprod(factors, dtype=np.uint64)
    return _powers[way][:n]


def _words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word: a polynomial over its bytes from prefix sums."""
    codes = np.frombuffer(raw, np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[codes], [True]]).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_VALUES[codes] * _power("up", len(codes)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _power("down", len(codes) + 1)[starts]
    return mix(hashes + (ends - starts).astype(np.uint64)), starts


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A long text cut at white space; a longer word stays whole."""
    while len(raw) > SLICE:
        at = next((i for i in range(SLICE, len(raw)) if _SPACE[raw[i]]), len(raw))
        yield raw[:at]
        raw = raw[at:]
    yield raw


def word_hashes(texts: Iterable[str]) -> Iterator[np.ndarray]:
    """The hashes of each text's words, letters A-Z as a-z."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass")
        if len(raw) > SLICE:
            yield from _split(held)
            held, size = [], 0
            yield np.concatenate([_words(piece)[0] for piece in _pieces(raw)])
            continue
        held.append(raw)
        size += len(raw)
        if size > SLICE:
            yield from _split(held)
            held, size = [], 0
    yield from _split(held)


def _split(held: list[bytes]) -> list[np.ndarray]:
    if not held:
        return []
    hashes, starts = _words(b"\n".join(held))
    ends = np.cumsum([len(raw) + 1 for raw in held])
    return np.split(hashes, np.searchsorted(starts, ends[:-1]))


def shingle_set(words: np.ndarray) -> np.ndarray:
    """The distinct hashes of runs of ``WORDS`` words, rising; of fewer words, the one of
    the whole run; of none, nothing."""
    if not len(words):
        return words
    length = min(len(words), WORDS)
    runs = len(words) - length + 1
    hashed = np.full(runs, length, np.uint64)
    for i in range(length):
        hashed = hashed * _STEP + words[i : i + runs]
    return np.unique(mix(hashed))


def shingle_sets(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    for words in word_hashes(text or "" for text in texts):
        yield shingle_set(words)
