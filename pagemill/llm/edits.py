"""Edit distances up to a small threshold: candidate keys by segments, and the distance itself."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import xxhash

INDEX, PROBE = 1, 2


@lru_cache(maxsize=100_000)
def places(length: int, most: int) -> list[tuple[int, int, int, int, int]]:
    """``role, length of the indexed string, segment, start, stop`` of all keys of a string of ``length``.

    A string is cut into ``most + 1`` segments; if at most ``most`` edits lead
    to a longer or equally long string, one segment is found there unchanged.
    A longer string is probed for the segments of every length it can come
    from, only at starts that leave enough edits to the left and to the right.
    """
    found = []
    for shorter in range(max(0, length - most), length + 1):
        size, extra = divmod(shorter, most + 1)
        start = 0
        for i in range(most + 1):
            width = size + (i > most - extra)
            shift = length - shorter
            low = max(-i, shift - (most - i), -start)
            high = min(i, shift + (most - i), length - width - start)
            for move in range(low, high + 1):
                both = INDEX | PROBE if shift == 0 and move == 0 else PROBE
                found.append((both, shorter, i, start + move, start + move + width))
            start += width
    return found


def keys(text: str, most: int, parent: int = 0) -> Iterator[tuple[int, int, int, int]]:
    """``key, role, start, stop`` of all keys of a string; keys below different ``parent`` never meet."""
    digest = xxhash.xxh64_intdigest
    for role, length, segment, start, stop in places(len(text), most):
        seed = (parent * 31 + length * (most + 1) + segment) & 0xFFFFFFFFFFFFFFFF
        value = digest(text[start:stop].encode("utf-8", "replace"), seed)
        yield value - (1 << 64) if value >> 63 else value, role, start, stop


def distances(first: list[str], second: list[str], most: int) -> np.ndarray:
    """Edit distance of every pair, or ``most + 1`` if it is larger.

    A band of ``2 * most + 1`` diagonals is one machine word; a column of the
    table is a few bit operations, done for all pairs at once.
    """
    result = np.full(len(first), most + 1, np.int64)
    longer = [a if len(a) >= len(b) else b for a, b in zip(first, second, strict=True)]
    shorter = [b if len(a) >= len(b) else a for a, b in zip(first, second, strict=True)]
    sizes = np.array([(len(a), len(b)) for a, b in zip(longer, shorter, strict=True)], np.int64).reshape(-1, 2)
    possible = np.flatnonzero(sizes[:, 0] - sizes[:, 1] <= most)
    possible = possible[np.argsort(sizes[possible, 1], kind="stable")]
    held: list[int] = []
    for i in possible.tolist():
        if held and (len(held) + 1) * (int(sizes[i, 0]) + 2 * most) > 4_000_000:
            result[held] = _band([longer[k] for k in held], [shorter[k] for k in held], most)
            held = []
        held.append(i)
    if held:
        result[held] = _band([longer[k] for k in held], [shorter[k] for k in held], most)
    return np.minimum(result, most + 1)


def _points(texts: list[str], width: int, before: int, filler: int) -> np.ndarray:
    matrix = np.full((width, len(texts)), filler, np.uint32)
    for k, text in enumerate(texts):
        raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        matrix[before : before + len(raw), k] = raw
    return matrix


def _band(longer: list[str], shorter: list[str], most: int) -> np.ndarray:
    m, n = np.array([len(a) for a in longer]), np.array([len(b) for b in shorter])
    columns, width = int(n.max(initial=0)), 2 * most + 1
    rows = _points(longer, columns + 2 * width + 1, most, 0xFFFFFFFF)
    letters = _points(shorter, columns, 0, 0xFFFFFFFE)
    every = np.uint32((1 << width) - 1)
    plus = np.full(len(longer), ((1 << (most + 1)) - 1) << most, np.uint32)
    minus = np.zeros(len(longer), np.uint32)
    last = (m - n + most).astype(np.uint32)  # the diagonal on which the table ends
    score = (m - n).copy()
    for j in range(columns):
        match = np.zeros(len(longer), np.uint32)
        for b in range(width):
            match |= (rows[j + b] == letters[j]).astype(np.uint32) << np.uint32(b)
        zero = ((((match & plus) + plus) ^ plus) | match | minus) & every
        up = (minus | ~(zero | plus)) & every
        down = zero & plus
        score += np.where(j < n, 1 - ((zero >> last) & 1).astype(np.int64), 0)
        plus = (down | ~((zero >> np.uint32(1)) | up)) & every
        minus = (zero >> np.uint32(1)) & up
    return score
