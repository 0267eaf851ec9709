"""Ids of whole texts from the ids of their space-separated units, which repeat a lot."""

from __future__ import annotations

from collections.abc import Callable

LIMIT, LONGEST = 250_000, 64  # units kept at a time, characters of a unit that is kept


class UnitCache:
    """What a tokenizer makes of units; a bounded number is kept, and an unknown unit is computed anew."""

    def __init__(self, compute: Callable[[list[str]], list], limit: int = LIMIT) -> None:
        self.compute, self.limit, self.known = compute, limit, {}

    def get(self, units: list[str]) -> list:
        found = list(map(self.known.get, units))
        if None in found:
            missing = list({u: None for u, x in zip(units, found, strict=True) if x is None})
            made = dict(zip(missing, self.compute(missing), strict=True))
            found = [made[u] if x is None else x for u, x in zip(units, found, strict=True)]
            if len(self.known) + len(made) > self.limit:
                self.known.clear()
            if len(made) <= self.limit:
                self.known.update((u, x) for u, x in made.items() if len(u) <= LONGEST)
        return found
