"""Greedy string tiling of two word sequences by running Karp-Rabin."""

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_MODULUS = 1 << 64


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin number of each window of ``length`` words, modulo 2**64."""
    count = len(words) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    found = np.zeros(count, np.uint64)
    # Windows of doubling length are joined: as many steps as the length has bits.
    power, done, size = _BASE, 0, 1
    block = words.astype(np.uint64)
    while True:
        if length & size:
            found = found * np.uint64(power) + block[done : done + count]
            done += size
        size *= 2
        if size > length:
            return found
        block = block[: len(block) - size // 2] * np.uint64(power) + block[size // 2 :]
        power = power * power % _MODULUS


def _clear_windows(marked, length):
    """Whether each window of ``length`` words is free of marked ones."""
    sums = np.concatenate([[0], np.cumsum(marked)])
    return sums[length:] == sums[:-length]


def _matches(left, right, left_marked, right_marked, length):
    """Maximal matches (length, left, right) of at least ``length`` unmarked words."""
    found = []
    if min(len(left), len(right)) < length:
        return found
    places = {}
    clear = _clear_windows(right_marked, length)
    for at, number in enumerate(window_hashes(right, length).tolist()):
        if clear[at]:
            places.setdefault(number, []).append(at)
    clear = _clear_windows(left_marked, length)
    for at, number in enumerate(window_hashes(left, length).tolist()):
        if not clear[at]:
            continue
        for to in places.get(number, ()):
            # Only where a match begins.
            if at and to and left[at - 1] == right[to - 1]:
                if not (left_marked[at - 1] or right_marked[to - 1]):
                    continue
            size = 0
            while (
                at + size < len(left)
                and to + size < len(right)
                and left[at + size] == right[to + size]
                and not left_marked[at + size]
                and not right_marked[to + size]
            ):
                size += 1
            if size >= length:
                found.append((size, at, to))
    return found


def tiles(left: np.ndarray, right: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Longest matches first, none overlapping another on either side, each of at least
    ``least`` words: (length, start in left, start in right).

    The length searched for starts at 20 words, jumps up to a match of more than twice its
    size, and is halved when its matches are marked. Of equally long matches the first
    by position is taken.
    """
    left_marked, right_marked = np.zeros(len(left), bool), np.zeros(len(right), bool)
    length, found = max(least, 20), []
    while True:
        matches = _matches(left, right, left_marked, right_marked, length)
        longest = max((size for size, _, _ in matches), default=0)
        if longest > 2 * length:
            length = longest
            continue
        for size, at, to in sorted(matches, key=lambda match: (-match[0], match[1:])):
            taken = left_marked[at : at + size] | right_marked[to : to + size]
            if not taken.any():
                left_marked[at : at + size] = right_marked[to : to + size] = True
                found.append((size, at, to))
        # What a marked tile cut short may still be long enough.
        if any(
            size >= length
            for size, _, _ in _matches(left, right, left_marked, right_marked, length)
        ):
            continue
        if length == least:
            return found
        length = max(length // 2, least)
