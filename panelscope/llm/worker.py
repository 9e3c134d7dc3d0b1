"""Objects that a Python worker keeps from one task to the next.

Functions travel to the workers by value, so each task has module variables of its own; what is dear to make is held by a module that
only the worker knows.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

_PLACE = "panelscope_worker_objects"


def kept(kind: str, key: Any, make: Callable[[], Any]) -> Any:
    """The worker's object of a kind, made anew if the key is not that of the last one: one of a kind is held."""
    held = sys.modules.setdefault(_PLACE, types.ModuleType(_PLACE)).__dict__
    if kind not in held or held[kind][0] != key:
        held.pop(kind, None)
        held[kind] = (key, make())
    return held[kind][1]
