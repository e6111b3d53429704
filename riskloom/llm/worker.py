"""What a Python worker keeps from one task to the next: one thing at most.

Spark gives a worker the tasks of one operator after the other. What one of them has built
would stay beside the arrays of all later ones, so their tasks clear it first.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable
from typing import Any

_KEPT: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gave for this key, made once while nothing else is asked for."""
    if key not in _KEPT:
        clear()
        _KEPT[key] = make()
    return _KEPT[key]


def clear() -> None:
    """Let go of what is kept."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()  # it may refer to itself
