"""Plugged-in models, kept for the life of a Python worker."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

_kept: dict[str, Any] = {}


def kept(name: str | None, load: Callable[[], Any]) -> Any:
    """What ``load`` gives.  Under a name it is loaded once for each worker
    process, however many tasks the process runs; without, once for each call."""
    if name is None:
        return load()
    if name not in _kept:
        _kept[name] = load()
    return _kept[name]
