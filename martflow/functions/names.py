"""Column names that do not clash."""

from __future__ import annotations

from collections.abc import Iterable


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """The wanted column names, with underscores in front where they are taken."""
    lower = {name.lower() for name in taken}
    names = []
    for name in wanted:
        while name.lower() in lower:
            name = f"_{name}"
        lower.add(name.lower())
        names.append(name)
    return names
