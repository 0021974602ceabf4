"""Content anchors of byte strings: where equal strings of one length, 400 bytes by default, can be told from few positions.

Each string of ``length`` bytes has length - gram + 1 grams; the one with the least hash (the first of
those) is its anchor.  Equal strings have equal anchors at equal offsets, wherever they stand, so strings
can only be equal if they share their anchor's gram.  Neighbouring strings mostly share one anchor: it *owns* the
run of string starts that chose it, and about one position in (length - gram) / 2 is an anchor.
"""

from __future__ import annotations

import numpy as np

LENGTH, GRAM = 400, 150
#: String starts handled at a time; longer texts are handled in pieces that overlap by a string.
PIECE = 1 << 20
POSITION = np.uint64((1 << 24) - 1)

_random = np.random.default_rng(424_242)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_random.integers(1, 1 << 60)) * 8 + 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(base: int, name: str, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = 1 << max(12, n - 1).bit_length() if n > 4096 else 4096
        steps = np.full(size, np.uint64(base), np.uint64)
        steps[0] = 1
        _powers[name] = have = np.multiply.accumulate(steps)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Hashes of any substrings of a byte string, or of words told by their hashes, from sums of powers modulo 2 ** 64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_BYTE[data] if data.dtype == np.uint8 else data) * _power(_BASE, "up", n), out=self.sums[1:])
        self.down = _power(_INVERSE, "down", n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each width successive entries."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def of_texts(units: np.ndarray, sizes: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> list[np.ndarray]:
    """text, position, first, last (of the owned starts), gram hash and context hash of each anchor.

    units are the bytes of texts, or their words' hashes, one text after the other; sizes says how many each text has.  Positions count
    from the text's first unit.  The context is all that the owned strings cover; equal context hashes mean equal owned strings.
    """
    out = []
    ends = np.cumsum(sizes)
    begins = ends - sizes
    for lo in range(0, max(0, len(units) - length + 1), PIECE):
        piece = units[lo : lo + PIECE + length - 1]
        h = Hashes(piece)
        starts = np.arange(len(piece) - gram + 1)
        grams = h.of(starts, starts + gram)
        key = (grams & ~POSITION) | starts.astype(np.uint64)
        own = (sliding_least(key, length - gram + 1) & POSITION).astype(np.int64)
        fresh = np.diff(own, prepend=-1) != 0
        edges = np.concatenate([begins, np.maximum(begins, ends - length + 1)]) - lo  # from the second on, strings would leave the text
        fresh[edges[(edges >= 0) & (edges < len(own))]] = True
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(own)) - 1
        text = np.searchsorted(ends, first + lo, side="right")
        inside = first + lo + length <= ends[text]
        first, last, text = first[inside], last[inside], text[inside]
        at = own[first]
        extent = ((at - first).astype(np.uint64) << np.uint64(32)) | (last - first).astype(np.uint64)
        e = mixed(h.of(first, last + length) ^ mixed(extent))
        out.append((text, at + lo - begins[text], first + lo - begins[text], last + lo - begins[text], grams[at], e))
    if not out:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2
    return [np.concatenate(x) for x in zip(*out, strict=True)]
