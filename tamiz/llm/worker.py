"""What a Python worker keeps between tasks: one model at a time, so that memory stays bounded
when workers are used again by another operator."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa

_SLOT: dict = {}


def trim() -> None:
    """Give freed memory back to the system, which the C library and Arrow else keep for later."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function over batches, with ``trim`` at the end of each task: workers stay between tasks."""

    @functools.wraps(run)
    def wrapped(parts: Iterator) -> Iterator:
        yield from run(parts)
        trim()

    return wrapped


def kept(name: str, of, make: Callable):
    """The value made for ``of``, made again when another operator or model had the slot meanwhile."""
    same = _SLOT.get("of") is of or (isinstance(of, str) and _SLOT.get("of") == of)
    if _SLOT.get("name") != name or not same:
        _SLOT.clear()
        trim()
        _SLOT.update(name=name, of=of, value=make())
    return _SLOT["value"]


def release() -> None:
    """Drop what another operator kept."""
    if _SLOT:
        _SLOT.clear()
        trim()
