"""Column selection by name, glob, range and exclusion."""

from __future__ import annotations

from collections.abc import Sequence
from fnmatch import fnmatchcase


def matching(patterns: Sequence[str], names: Sequence[str]) -> list[str]:
    """Names by pattern order, then by their own order; each once. A plain name that does not exist raises KeyError."""
    out: dict[str, None] = {}
    for p in patterns:
        found = [n for n in names if fnmatchcase(n, p)]
        if not found and not any(c in p for c in "*?["):
            raise KeyError(f"no column {p!r}")
        out.update(dict.fromkeys(found))
    return list(out)


def selected(spec: Sequence[str] | str, names: Sequence[str]) -> list[str]:
    """``a:c`` is a range, a leading minus excludes (a name, glob or range); only exclusions start from all columns."""
    items = [spec] if isinstance(spec, str) else list(spec)

    def span(item: str) -> list[str]:
        if ":" in item:
            a, b = item.split(":")
            i, j = names.index(a), names.index(b)
            return list(names[i : j + 1]) if i <= j else list(names[j : i + 1])[::-1]
        return matching([item], names)

    plus = [n for item in items if not item.startswith("-") for n in span(item)]
    minus = {n for item in items if item.startswith("-") for n in span(item[1:].strip("()"))}
    base = list(dict.fromkeys(plus)) if any(not i.startswith("-") for i in items) else list(names)
    return [n for n in base if n not in minus]
