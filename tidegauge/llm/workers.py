"""State that a Python worker keeps between tasks: of one operator at a time, so that a chain of operators doesn't add up."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

_slot: list = []


def kept(owner: object, make: Callable[[], object]) -> object:
    """What ``make()`` gave when this worker last asked for ``owner``, if nothing else was kept or released since."""
    if not _slot or _slot[0] is not owner:
        release()  # the old state goes before the new one is made
        _slot[:] = [owner, make()]
    return _slot[1]


def release() -> None:
    """Forget what another operator kept, and give memory that Arrow holds unused back to the system."""
    _slot.clear()
    pa.default_memory_pool().release_unused()
