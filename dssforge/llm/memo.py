"""A bounded memo of recent keys in two generations."""

from __future__ import annotations

from collections.abc import Hashable, Sequence


class Memo:
    """Keeps what was used since the generation before last: at most ``2 * limit`` entries and the last batch, hot ones always."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def put(self, key: Hashable, value) -> None:
        if len(self.new) >= self.limit:
            self.new, self.old = {}, self.new
        self.new[key] = value

    def put_all(self, entries: dict) -> None:
        """Many entries at once: a generation grows beyond the limit by one batch at most."""
        if len(self.new) >= self.limit:
            self.new, self.old = {}, self.new
        self.new.update(entries)

    def all(self, keys: Sequence) -> list:
        """Values of the keys, None where unknown."""
        found = list(map(self.new.get, keys))
        if None in found:
            for i, value in enumerate(found):
                if value is None and (value := self.old.get(keys[i])) is not None:
                    found[i] = value
                    self.put(keys[i], value)
        return found
