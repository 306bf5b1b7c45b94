"""Names to readers, adapters and writers. Keys are case-insensitive; the last registration wins, with a warning."""

from __future__ import annotations

import logging
from collections.abc import Callable

log = logging.getLogger(__name__)


class Registry:
    def __init__(self, kind: str) -> None:
        self.kind, self._held = kind, {}

    def register(self, *keys: str) -> Callable:
        def keep(thing):
            for key in map(str.lower, keys):
                if key in self._held and self._held[key] is not thing:
                    log.warning("%s %r is replaced", self.kind, key)
                self._held[key] = thing
            return thing

        return keep

    def get(self, key: str):
        return self._held.get(key.lower())

    def keys(self) -> list[str]:
        return sorted(self._held)

    def __contains__(self, key: str) -> bool:
        return key.lower() in self._held


readers, adapters, writers = Registry("reader"), Registry("adapter"), Registry("writer")
register_reader, register_adapter, register_writer = readers.register, adapters.register, writers.register
