"""What Python workers keep between tasks, and how they give memory back.

A worker serves task after task of any query. It keeps one thing at most (`kept`), whose size its maker bounds, and hands freed
memory back to the system (`tidy`), for the allocators would hold on to it.
"""

from __future__ import annotations

import ctypes
import functools
import os
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa

#: Resident bytes of a worker below which nothing is handed back.
QUIET = 120 << 20
_kept: dict[Any, Any] = {}


def kept(key: Any, make: Callable[[], Any]) -> Any:
    """What `make` gave for this key before, if nothing else was kept since; else what it gives now."""
    if key not in _kept:
        _kept.clear()
        tidy()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Let go of what is kept."""
    _kept.clear()


@functools.cache
def _trim() -> Callable[[int], Any]:
    return getattr(ctypes.CDLL(None), "malloc_trim", None) or (lambda _: None)


def resident() -> int:
    """Resident bytes of this process; 0 where the system does not say."""
    try:
        with open("/proc/self/statm", encoding="ascii") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")
    except OSError:
        return 0


def tidy() -> None:
    """Give freed memory back to the system if this worker holds much."""
    if resident() > QUIET:
        pa.default_memory_pool().release_unused()
        _trim()(0)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow or mapInPandas that tidies when its task ends."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        try:
            yield from run(batches)
        finally:
            tidy()

    return task


def keeping(key: Any, make: Callable[[], Any]) -> Callable:
    """As `tidied`, for a function whose first argument is a thing that the worker keeps between its tasks."""

    def wrap(run: Callable[[Any, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            try:
                yield from run(kept(key, make), batches)
            finally:
                tidy()

        return task

    return wrap


def tidied_group(f: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """A function of one group for applyInArrow that tidies after it."""

    def task(rows: pa.Table) -> pa.Table:
        forget()
        out = f(rows)
        tidy()
        return out

    return task


def tidied_pair(f: Callable[[Any, pa.Table], pa.Table]) -> Callable[[Any, pa.Table], pa.Table]:
    """As `tidied_group`, for functions of a key and its group, or of two groups."""

    def task(first: Any, second: pa.Table) -> pa.Table:
        forget()
        out = f(first, second)
        tidy()
        return out

    return task
