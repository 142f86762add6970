"""Header names as stable snake_case identifiers (driver-side, schema only)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

_NON_WORD = re.compile("[^a-z0-9]+")


def snake_case(name: str) -> str:
    """Lower-case, drop ``*``, turn every other run of punctuation into ``_``."""
    return _NON_WORD.sub("_", str(name).strip().lower().replace("*", "")).strip("_")


def snake_case_all(names: Sequence[str]) -> list[str]:
    normalized = [snake_case(n) for n in names]
    clashes = sorted(n for n, times in Counter(normalized).items() if times > 1)
    if clashes:
        raise ValueError(f"Two headers have one name after normalization: {clashes}")
    return normalized


def fill_header(cells: Sequence[str | None]) -> list[str]:
    """Name blank header cells by position and number repeated ones."""
    seen: Counter[str] = Counter()
    names = []
    for position, cell in enumerate(cells):
        name = (cell or "").strip() or f"Unnamed: {position}"
        names.append(f"{name}.{seen[name]}" if seen[name] else name)
        seen[name] += 1
    return names
