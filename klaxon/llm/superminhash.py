"""SuperMinHash signatures of many sets at once, in numpy.

Each element draws a random permutation of the components together with a fraction per
rank; its value in the component at rank ``j`` is ``j`` plus the fraction, and a component
keeps its smallest value. The ranks of an element are correlated, so small sets spread
evenly over the components and the estimate of a similarity varies less than with
independent hashes. Going rank by rank, a set is finished once every component holds a
value: all later ranks are larger. Large sets finish after one to three ranks.
"""

import numpy as np

from klaxon.llm.words import mixed

_ELEMENTS_AT_ONCE = 100_000
_EMPTY = np.iinfo(np.int64).max
_STEP = 0x9E3779B97F4A7C15
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def _draws(state, rank, places):
    """Position in 0..places-1 and fraction of each element."""
    step = np.uint64((rank + 1) * _STEP & 0xFFFFFFFFFFFFFFFF)
    random = mixed(state + step)
    return ((random >> _HALF) * np.uint64(places) >> _HALF).astype(np.int64), (
        random & _LOW
    ).astype(np.int64)


def _signatures(elements, owner, sets, size):
    values = np.full(sets * size, _EMPTY, np.int64)
    state = mixed(elements)
    first, fraction = _draws(state, 0, size)
    np.minimum.at(values, owner * size + first, fraction)
    table = values.reshape(sets, size)
    order = None
    for rank in range(1, size):
        active = (table.max(axis=1) == _EMPTY)[owner]
        if not active.any():
            break
        state, owner = state[active], owner[active]
        each = np.arange(len(state))
        if order is None:
            first = first[active]
            order = np.tile(np.arange(size, dtype=np.int16), (len(state), 1))
            order[each, first] = 0
            order[:, 0] = first
        else:
            order = order[active]
        place, fraction = _draws(state, rank, size - rank)
        place += rank
        component = order[each, place]
        order[each, place] = order[:, rank]
        np.minimum.at(values, owner * size + component, (rank << 32) + fraction)
    return table


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """A row of ``size`` components per set; an empty set has the largest value everywhere."""
    found = np.full((len(sets), size), _EMPTY, np.int64)
    lengths = np.array([len(one) for one in sets], np.int64)
    start = 0
    while start < len(sets):
        end, total = start, 0
        while end < len(sets) and (end == start or total + lengths[end] <= _ELEMENTS_AT_ONCE):
            total += lengths[end]
            end += 1
        if total:
            owner = np.repeat(np.arange(end - start), lengths[start:end])
            elements = np.concatenate(sets[start:end])
            # Empty sets have no elements and would never finish; they stay as they are.
            filled = np.flatnonzero(lengths[start:end])
            position = np.zeros(end - start, np.int64)
            position[filled] = np.arange(len(filled))
            table = _signatures(elements, position[owner], len(filled), size)
            found[start + filled] = table
        start = end
    return found


def band_numbers(table: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One number per band of ``rows`` components; different bands share no numbers on purpose."""
    out = np.empty((len(table), bands), np.uint64)
    for band in range(bands):
        number = np.full(len(table), band + 1, np.uint64)
        for row in range(rows):
            number = mixed(number * np.uint64(_STEP) + table[:, band * rows + row].view(np.uint64))
        out[:, band] = number
    return out.view(np.int64)
