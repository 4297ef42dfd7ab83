"""What a Python worker remembers from task to task, of one kind at a time.

Spark uses a worker again for later stages. What an earlier stage has
remembered there is forgotten where another one begins to remember."""

from __future__ import annotations

from collections.abc import Callable

_HELD: dict[str, Callable[[], None]] = {}


def hold(kind: str, forget: Callable[[], None]) -> None:
    """``kind`` is in use, and ``forget`` empties it; all others go."""
    if len(_HELD) != 1 or kind not in _HELD:
        release(but=kind)
        _HELD[kind] = forget


def release(but: str = "") -> None:
    for kind in [k for k in _HELD if k != but]:
        _HELD.pop(kind)()
