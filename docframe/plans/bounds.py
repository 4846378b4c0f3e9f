"""Composition of head, tail and window into one slice."""

from __future__ import annotations

from collections.abc import Callable, Sequence


def needs_count(ops: Sequence[tuple]) -> bool:
    return any((kind == "head" and n < 0) or (kind == "tail" and n >= 0) for kind, n, *_ in ops)


def fold(ops: Sequence[tuple], count: Callable[[], int]) -> tuple[int, int | None]:
    """(offset, limit or None) of ops read left to right; ``count`` is called only if an op depends on the number of rows.

    ``("head", n)`` keeps the first n rows or drops the last -n; ``("tail", n)`` keeps the last n or drops the first -n;
    ``("window", a, b)`` keeps rows a to b, counted from 1.
    """
    low, high = 0, count() if needs_count(ops) else None
    for kind, n, *rest in ops:
        if kind == "head":
            high = (low + n if high is None else min(high, low + n)) if n >= 0 else max(low, high + n)
        elif kind == "tail":
            low = max(low, high - n) if n >= 0 else (low - n if high is None else min(high, low - n))
        elif kind == "window":
            start, end = max(1, n), rest[0]
            new_high = low + max(0, end)
            low = low + start - 1
            high = new_high if high is None else min(high, new_high)
            low = min(low, high)
        else:
            raise ValueError(f"unknown bound {kind}")
        if high is not None and high < low:
            high = low
    return low, None if high is None else high - low
