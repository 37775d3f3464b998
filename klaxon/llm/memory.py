"""What a worker process remembers from one task to the next.

Workers outlive tasks and serve one stage after another. What a stage remembers spares its
next tasks work; it goes when a task of another kind begins, so that a worker never holds
more than one kind.
"""

import pyarrow as pa

_kept = {}


def remembered(key, make):
    """The object that ``make`` gave for ``key`` in this process, or a new one."""
    if key not in _kept:
        forget()
        _kept[key] = make()
    return _kept[key]


def forget():
    """Let go of everything, at the start of a task that remembers nothing."""
    _kept.clear()
    pa.default_memory_pool().release_unused()
